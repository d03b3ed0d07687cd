import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources import readers as R
from tessera.sources import writers as W
from tessera.sources.inspect import head_rows, schema_frame


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(
        [(1, "a\tb", 1.5, None), (2, "plain", None, "x"), (3, "", 2.25, "y")],
        "id int, s string, v double, n string")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_roundtrip_declared_schema(spark, frame):
    path = scratch_path(spark, "test-csv")
    W.write_delimited(frame.select("id", "v"), path)
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("value", T.DoubleType())])
    back = R.read_delimited(spark, path, schema=schema)
    assert back.columns == ["key", "value"]
    assert _rows(back) == _rows(frame.select("id", "v"))


def test_csv_inferred_types(spark, frame):
    path = scratch_path(spark, "test-csv")
    W.write_delimited(frame.select("id", "v"), path)
    assert dict(R.read_delimited(spark, path).dtypes) == {"id": "int", "v": "double"}


def test_tsv_bzip2_overwrite(spark, frame):
    path = scratch_path(spark, "test-tsv")
    W.write_delimited(frame, path, sep="\t", compression="bzip2")
    W.write_delimited(frame.where("id > 1"), path, sep="\t", mode="overwrite", compression="bzip2")
    back = R.read_delimited(spark, path, sep="\t")
    assert back.count() == 2


def test_parquet_orc_json_roundtrip(spark, frame):
    for fmt in ("parquet", "orc", "json"):
        path = scratch_path(spark, f"test-{fmt}")
        W.write_format(frame, fmt, path)
        back = R.read_format(spark, fmt, path, schema=frame.schema if fmt == "json" else None)
        assert _rows(back.select(*frame.columns)) == _rows(frame), fmt


def test_text_sink_needs_one_string_column(spark, frame):
    path = scratch_path(spark, "test-text")
    W.write_lines(frame.select("s"), path)
    assert sorted(r.value for r in R.read_lines(spark, path).collect()) == sorted(["a\tb", "plain", ""])
    with pytest.raises(ValueError):
        W.write_lines(frame.select("id"), scratch_path(spark, "test-text"))


def test_save_table_and_drop(spark, frame):
    path = scratch_path(spark, "test-table")
    name = W.save_as_table(frame, path=path)
    assert _rows(R.read_table(spark, name)) == _rows(frame)
    W.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_head_rows_and_schema_frame(spark, frame):
    assert [r.id for r in head_rows(frame, 2, "id").collect()] == [1, 2]
    sf = schema_frame(frame).collect()
    assert [(r.position, r.col_name, r.data_type) for r in sf] == [
        (1, "id", "int"), (2, "s", "string"), (3, "v", "double"), (4, "n", "string")]


def test_empty_frame_roundtrip(spark, frame):
    path = scratch_path(spark, "test-empty")
    W.write_parquet(frame.where(F.lit(False)), path)
    assert R.read_parquet(spark, path).count() == 0


def test_catalog_use_show_describe(spark, frame):
    spark.sql("USE default")
    name = W.save_as_table(frame, path=scratch_path(spark, "test-table"))
    names = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    assert name in names
    from tessera.sources.inspect import describe_table

    assert [r.col_name for r in describe_table(spark, name).collect()] == ["id", "s", "v", "n"]
    W.drop_table(spark, name)


def test_crosstab_has_no_width_limit(spark):
    from tessera.operators import stats as S

    df = spark.range(0, 300).withColumn("k", F.lit(1))
    assert len(S.typed_crosstab(df, "k", "id").first()) == 301
    assert S.crosstab_counts(df, "k", "id").count() == 300


def test_crosstab_tells_null_from_its_text(spark):
    from tessera.operators import stats as S

    df = spark.createDataFrame([(1, None), (1, "null"), (1, "null"), (2, "a.b")], "k int, c string")
    out = {r.k_c: r.asDict() for r in S.typed_crosstab(df, "k", "c").collect()}
    assert out[1] == {"k_c": 1, "null (missing)": 1, "a.b": 0, "null": 2}
    assert out[2] == {"k_c": 2, "null (missing)": 0, "a.b": 1, "null": 0}


def test_checkpoint_dir_is_kept_when_set(spark):
    from tessera.session import ensure_checkpoint_dir

    before = spark.sparkContext.getCheckpointDir()
    assert before and ensure_checkpoint_dir(spark) == before
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "probe")
    assert "tessera-scratch/probe/" in path and (base is None or path.startswith(base.rstrip("/")))
