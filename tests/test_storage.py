"""Partitioned and bucketed storage, tolerant inference, catalog scope, lifetimes, Arrow functions."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.functions.geo import haversine
from tessera.functions.udfs import haversine_arrow_udf, hour_of_day_arrow_udf
from tessera.lifetimes import Scope, kept, note_folder, scope
from tessera.session import scratch_path, stored
from tessera.sources import inspect as I
from tessera.sources import readers as R
from tessera.sources import writers as W
from tessera.sources.inference import infer_types, read_with_rejects
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exists(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# --- partitioned and bucketed ---------------------------------------------------

def test_partition_filter_reaches_the_scan(spark):
    text = plan(E.queries()["s5_partition_pruning"](spark, SF_SMALL))
    found = text[text.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "c_nationkey" in found and ">= 3" in found and "<= 5" in found


def test_join_prunes_partitions_at_run_time(spark):
    assert "dynamicpruning" in plan(E.queries()["s5_dynamic_pruning_join"](spark, SF_SMALL)).lower()


def test_overwrite_touches_only_the_values_it_brings(spark):
    path = scratch_path(spark, "part")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a b/c")], "v long, k string")
    W.write_partitioned(df, path, ["k"])
    W.write_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), path, ["k"])
    assert {(r.v, r.k) for r in R.read_parquet(spark, path).collect()} == {(1, "a"), (9, "b"), (3, None), (4, "a b/c")}
    W.write_partitioned(df.limit(0), path, ["k"])  # brings nothing, replaces nothing
    assert R.read_parquet(spark, path).count() == 4
    W.write_partitioned(df.where("v = 1"), path, ["k"], only_touched=False)
    assert [(r.v, r.k) for r in R.read_parquet(spark, path).collect()] == [(1, "a")]


def test_bucketed_join_has_no_exchange(spark):
    with scope(spark):
        out = E.queries()["j1_bucketed_join"](spark, SF_SMALL)
        text = plan(out)
        assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
        assert out.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


# --- inference ----------------------------------------------------------------------

def csv_of(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_a_few_bad_values_do_not_widen_a_column(spark):
    lines = ["id,n,x,ok,day,at,name"] + [f"{i},{i * 10 ** 8},{i / 4},true,2024-01-0{i % 9 + 1},2024-01-01 0{i % 9}:00:00,\"n, {i}\""
                                         for i in range(200)]
    lines[5:8] = ["x,1,1.5,true,2024-01-01,2024-01-01 00:00:00,bad id", "7,1", ""]
    rows, rejects, schema = read_with_rejects(spark, csv_of(spark, lines), max_bad=0.02)
    assert [f.dataType.simpleString() for f in schema] == ["int", "bigint", "double", "boolean", "date", "timestamp_ntz", "string"]
    assert {r.line for r in rejects.collect()} == {lines[5], "7,1"} and rejects.count() == 2
    assert rows.count() == 197 == rows.select("name").where("name is not null").count() == rows.select("id").count()
    assert rows.where("id = 100").first().name == "n, 100"
    strict = read_with_rejects(spark, csv_of(spark, lines), max_bad=0.0)[2]
    assert strict["id"].dataType.simpleString() == "string" and strict["x"].dataType.simpleString() == "double"


def test_inference_of_odd_columns(spark):
    df = spark.createDataFrame([("1", None, " 1", "1d", "007", "", "TRUE")] * 3, "a string, b string, c string, d string, e string, `f.g` string, h string")
    assert [f.dataType.simpleString() for f in infer_types(df)] == ["int", "string", "string", "string", "int", "string", "boolean"]
    assert [f.dataType.simpleString() for f in infer_types(df.limit(0))] == ["string"] * 7
    empty = csv_of(spark, [])
    rows, rejects, schema = read_with_rejects(spark, empty, header=False, names=["a"])
    assert rows.count() == 0 and rejects.count() == 0 and schema.names == ["a"]


# --- catalog scope --------------------------------------------------------------------

def test_database_is_restored_also_after_an_error(spark):
    before = spark.catalog.currentDatabase()
    with pytest.raises(RuntimeError), I.database(spark, "tessera_test_db"):
        assert spark.catalog.currentDatabase() == "tessera_test_db"
        raise RuntimeError
    assert spark.catalog.currentDatabase() == before
    with scope(spark):
        W.create_external(spark, "tessera_test_db.n", f"{SF_SMALL}/nation.parquet")
        assert [r.tableName for r in I.list_tables(spark, "tessera_test_db").collect()] == ["n"]
    assert I.list_tables(spark, "tessera_test_db").count() == 0  # the entry is gone, the files are not
    assert spark.read.parquet(f"{SF_SMALL}/nation.parquet").count() == 25
    spark.sql("DROP DATABASE tessera_test_db")


def test_temporary_views_are_in_no_database(spark):
    spark.range(1).createOrReplaceTempView("of_the_session")
    try:
        assert I.list_tables(spark, "default").where("tableName = 'of_the_session'").count() == 0
        assert I.list_tables(spark).where("tableName = 'of_the_session' and isTemporary").count() == 1
    finally:
        spark.catalog.dropTempView("of_the_session")


# --- lifetimes --------------------------------------------------------------------------

def persistent(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_scope_releases_frames_tables_and_folders(spark):
    before = persistent(spark)
    with scope(spark) as own:
        df = kept(spark.range(100))
        assert df.count() == 100 and persistent(spark) == before + 1
        back = stored(df, "lifetime")
        name = W.save_as_table(df, path=scratch_path(spark, "lifetime"))
        folders = list(own.folders)
        assert back.count() == 100 and len(folders) == 2 and all(exists(spark, f) for f in folders)
        with scope(spark) as inner:
            kept(spark.range(7)).count()
            assert len(inner.frames) == 1 and len(own.frames) == 1
        assert persistent(spark) == before + 1
    assert persistent(spark) == before and not spark.catalog.tableExists(name)
    assert not any(exists(spark, f) for f in folders)


def test_scope_releases_after_an_error_and_twice(spark):
    before = persistent(spark)
    with pytest.raises(RuntimeError), scope(spark) as own:
        kept(spark.range(5)).count()
        folder = note_folder(spark, scratch_path(spark, "never-written"))
        raise RuntimeError
    assert persistent(spark) == before and not exists(spark, folder)
    own.release()
    Scope(spark).release()


def test_without_a_scope_frames_stay(spark):
    before = persistent(spark)
    df = kept(spark.range(5))
    assert df.count() == 5 and persistent(spark) == before + 1
    df.unpersist(blocking=True)


# --- Arrow functions -----------------------------------------------------------------------

def test_arrow_functions_equal_native(spark):
    rows = [(i, float(i % 180 - 90), float(i % 360 - 180), float(-i % 170 - 85), float(i * 7 % 360 - 180)) for i in range(300)]
    rows += [(900, None, 1.0, 1.0, 1.0), (901, 0.0, 0.0, 0.0, 0.0), (902, 90.0, 0.0, -90.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double")
    out = df.select("id", haversine("a", "b", "c", "d").alias("native"), haversine_arrow_udf("a", "b", "c", "d").alias("arrow"))
    for r in out.collect():
        assert (r.native is None and r.arrow is None) or math.isclose(r.native, r.arrow, rel_tol=1e-9, abs_tol=1e-6)
    hours = (spark.read.parquet(f"{SF_SMALL}/events.parquet")
             .select(F.hour("ts").alias("native"), hour_of_day_arrow_udf("ts").alias("arrow")))
    assert hours.where("native <> arrow or arrow is null").count() == 0
    assert spark.sql("select cast(null as timestamp_ntz) t").select(hour_of_day_arrow_udf("t").alias("h")).first().h is None
    assert hours.limit(0).count() == 0


def test_arrow_plan_has_no_pickled_rows(spark):
    text = plan(E.queries()["u2_haversine_arrow_udf"](spark, SF_SMALL)) + plan(E.queries()["u1_rides_per_hour_arrow_udf"](spark, SF_SMALL))
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text
