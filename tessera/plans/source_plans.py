"""Readers, writers, catalog and inspection.

Each sink query writes a test table to a fresh folder under the session's
shared checkpoint location, reads it back with the matching reader and
returns what was read; the oracle is the original table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import log_request
from ..session import scratch_path
from ..sources import readers as R
from ..sources import writers as W
from ..sources.inference import read_with_rejects
from ..sources.inspect import database, describe_table, list_tables, schema_frame
from ..sources.local import to_local
from .registry import query, table

_LI_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
_LI_SQL = "SELECT " + ", ".join(_LI_COLS) + " FROM lineitem"


# what text gives back: whole numbers are inferred as narrow as they fit
_LI_INFERRED_SQL = """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_quantity,
    l_extendedprice, l_returnflag FROM lineitem"""
_CUSTOMER_INFERRED_SQL = """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
    c_acctbal, c_mktsegment FROM customer"""


@query("s1_csv_header_infer_schema", _LI_INFERRED_SQL, "S1")
def s1_csv_header_infer_schema(spark, d):
    src = table(spark, d, "lineitem").select(*_LI_COLS)
    path = scratch_path(spark, "csv")
    W.write_delimited(src, path)
    return R.read_delimited(spark, path, header=True)


_BROKEN = "l_linenumber = 7 AND l_returnflag = 'A'"
_TYPES = {"l_orderkey": "int", "l_linenumber": "int", "l_quantity": "double", "l_returnflag": "string",
          "l_shipdate": "timestamp_ntz"}


@query("s1_inferred_types_and_rejects", f"""
SELECT t.col_name, t.data_type, (SELECT count(*) FROM lineitem WHERE NOT ({_BROKEN})) AS n_rows,
       (SELECT count(*) FROM lineitem WHERE {_BROKEN}) AS n_rejects,
       CASE t.col_name {" ".join(f"WHEN '{c}' THEN (SELECT count(DISTINCT {c}) FROM lineitem WHERE NOT ({_BROKEN}))" for c in _TYPES)}
       END AS n_values
FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in _TYPES.items())}) t(col_name, data_type)""", "S1 S2")
def s1_inferred_types_and_rejects(spark, d):
    """Some lines hold a word where a number belongs, some lack their last fields: types stay, lines are set apart."""
    src = table(spark, d, "lineitem").select(*_TYPES)
    broken = F.expr(_BROKEN)
    values = [F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss") if c == "l_shipdate" else
              F.when(broken & (F.col("l_orderkey") % 2 == 0), F.lit("n/a")).otherwise(F.col(c).cast("string"))
              if c == "l_quantity" else F.col(c).cast("string") for c in _TYPES]
    whole, part = F.concat_ws(",", *values), F.concat_ws(",", *values[:3])
    line = F.when(broken & (F.col("l_orderkey") % 2 == 1), part).otherwise(whole)
    path = scratch_path(spark, "broken-csv")
    W.write_lines(src.select(line.alias("value")), path)
    rows, rejects, types = read_with_rejects(spark, path, header=False, names=list(_TYPES), max_bad=0.05)
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_distinct(c).alias(c) for c in _TYPES])
    listed = F.array(*[F.struct(F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                F.col(f.name).alias("n_values")) for f in types.fields])
    return (counts.select("n_rows", F.explode(listed).alias("c"))
            .select("c.*", "n_rows", F.lit(rejects.count()).cast("long").alias("n_rejects")))


@query("s2_generic_format_options", _LI_INFERRED_SQL, "S2")
def s2_generic_format_options(spark, d):
    src = table(spark, d, "lineitem").select(*_LI_COLS)
    path = scratch_path(spark, "csv")
    W.write_format(src, "csv", path, header="true", sep=",")
    return R.read_format(spark, "csv", path, header="true", inferSchema="true", sep=",")


@query("s2_json_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""", "S2")
def s2_json_roundtrip(spark, d):
    src = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderpriority")
    path = scratch_path(spark, "json")
    W.write_format(src, "json", path)
    return R.read_format(spark, "json", path).select(*src.columns)


RIDER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("nation", T.IntegerType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("segment", T.StringType()),
])


@query("s3_declared_schema", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
FROM customer""", "S3")
def s3_declared_schema(spark, d):
    src = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "csv")
    W.write_delimited(src, path, header=True)
    # the declared schema renames by position; header=True keeps the header line out of the rows
    return R.read_delimited(spark, path, header=True, schema=RIDER_SCHEMA)


_LOG_LINE_SQL = """CAST(user_id AS VARCHAR) || ' - - [' || CAST(ts AS VARCHAR) || '] "'
    || CASE WHEN event_type = 'error' THEN 'POST' ELSE 'GET' END || ' /' || event_type || '?k='
    || CAST(event_id AS VARCHAR) || ' HTTP/1.1" 200 512'"""


@query("s4_x8_text_lines_log_request", f"""
SELECT {_LOG_LINE_SQL} AS value, regexp_extract({_LOG_LINE_SQL}, '^.*"(GET.*?)".*$', 1) AS request
FROM events""", "S4 S12 X8")
def s4_x8_text_lines_log_request(spark, d):
    ev = table(spark, d, "events")
    method = F.when(F.col("event_type") == "error", F.lit("POST")).otherwise(F.lit("GET"))
    line = F.concat(ev["user_id"].cast("string"), F.lit(" - - ["), ev["ts"].cast("string"), F.lit('] "'),
                    method, F.lit(" /"), ev["event_type"], F.lit("?k="), ev["event_id"].cast("string"),
                    F.lit(' HTTP/1.1" 200 512'))
    path = scratch_path(spark, "text")
    W.write_lines(ev.select(line.alias("value")), path)
    logs = R.read_lines(spark, path)
    return logs.select("value", log_request("value").alias("request"))


@query("s5_parquet_scan_pushdown", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'""", "S5")
def s5_parquet_scan_pushdown(spark, d):
    li = R.read_parquet(spark, f"{d.rstrip('/')}/lineitem.parquet")
    return li.where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("l_orderkey", "l_partkey", "l_quantity")


@query("s6_s14_orc_sink_and_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
       "S6 S14")
def s6_s14_orc_sink_and_scan(spark, d):
    src = table(spark, d, "orders")
    path = scratch_path(spark, "orc")
    W.write_orc(src, path)
    return R.read_orc(spark, path)


def _catalog_name(d: str, name: str) -> str:
    """One catalog entry per (dataset, table): reruns replace it instead of
    adding tables."""
    import hashlib

    return f"tessera_{name}_{hashlib.md5(d.rstrip('/').encode()).hexdigest()[:10]}"


@query("s7_catalog_table_scan", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""", "S7 S15")
def s7_catalog_table_scan(spark, d):
    src = table(spark, d, "customer")
    name = W.save_as_table(src, _catalog_name(d, "customer"), path=scratch_path(spark, "table"),
                           mode="overwrite")
    return R.read_table(spark, name)


_SPARK_TYPE_SQL = """CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower({t}) END"""


@query("s8_describe_table", f"""
SELECT column_name AS col_name, {_SPARK_TYPE_SQL.format(t='column_type')} AS data_type
FROM (DESCRIBE customer)""", "S8")
def s8_describe_table(spark, d):
    name = W.create_external(spark, _catalog_name(d, "customer_described"), R.table_dir(d, "customer"))
    return describe_table(spark, name).select("col_name", "data_type")


_SHOWN = ("customer", "nation", "supplier")


@query("s8_use_and_show_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _SHOWN), "S8 S7")
def s8_use_and_show_tables(spark, d):
    """Three tables of a database of their own, as SHOW TABLES lists them, with their rows; the session's database comes back."""
    before, parts = spark.catalog.currentDatabase(), []
    with database(spark, _catalog_name(d, "shop")) as shop:
        for t in _SHOWN:
            W.create_external(spark, f"{shop}.{t}", R.table_dir(d, t))
        for r in list_tables(spark).where("not isTemporary").orderBy("tableName").collect():  # the names in one database
            # an unqualified name is found in the database in use
            parts.append(spark.table(r["tableName"]).agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit(r["tableName"]).alias("table_name"), "n"))
    if spark.catalog.currentDatabase() != before:
        raise RuntimeError("the session's database was not restored")
    return reduce(DataFrame.unionByName, parts)


@query("s9_sql_select_limit", """
SELECT * FROM customer ORDER BY c_custkey LIMIT 10""", "S9 O4")
def s9_sql_select_limit(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("customer")
    return spark.sql("SELECT * FROM customer ORDER BY c_custkey LIMIT 10")


@query("s10_s16_tab_delimited_sink_scan", _CUSTOMER_INFERRED_SQL, "S10 S16")
def s10_s16_tab_delimited_sink_scan(spark, d):
    src = table(spark, d, "customer")
    path = scratch_path(spark, "tsv")
    W.write_delimited(src, path, sep="\t", header=True)
    return R.read_delimited(spark, path, sep="\t", header=True)


@query("s17_s16_bounded_local_frame", """
SELECT l_returnflag, count(*) AS n, CAST(max(l_linenumber) AS BIGINT) AS last_line FROM lineitem GROUP BY l_returnflag""",
       "S17 S16")
def s17_s16_bounded_local_frame(spark, d):
    """A small aggregate handed over as a local frame, and that frame read into Spark."""
    li = table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_linenumber").cast("long").alias("last_line"))
    return spark.createDataFrame(to_local(li, max_rows=1000), li.schema)


@query("s11_bzip2_overwrite_sink", _CUSTOMER_INFERRED_SQL, "S11")
def s11_bzip2_overwrite_sink(spark, d):
    src = table(spark, d, "customer")
    path = scratch_path(spark, "tsv-bz2")
    W.write_delimited(src, path, sep="\t", header=True, compression="bzip2")
    # second write replaces the first (mode overwrite) instead of adding files
    W.write_delimited(src, path, sep="\t", header=True, mode="overwrite", compression="bzip2")
    return R.read_delimited(spark, path, sep="\t", header=True)


@query("s12_text_sink", "SELECT url AS value FROM pages", "S12 S4")
def s12_text_sink(spark, d):
    path = scratch_path(spark, "text")
    W.write_lines(table(spark, d, "pages").select(F.col("url").alias("value")), path)
    return R.read_lines(spark, path)


@query("s13_parquet_sink_overwrite", _LI_SQL, "S13")
def s13_parquet_sink_overwrite(spark, d):
    src = table(spark, d, "lineitem").select(*_LI_COLS)
    path = scratch_path(spark, "parquet")
    W.write_parquet(src, path)
    W.write_parquet(src, path, mode="overwrite")
    return R.read_parquet(spark, path)


@query("s13_partitioned_overwrite", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderpriority
FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0""", "S13 S5")
def s13_partitioned_overwrite(spark, d):
    """A second write of one priority's rows replaces that folder and leaves the others."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "by-priority")
    W.write_partitioned(orders, path, ["o_orderpriority"])
    urgent = orders.where("o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0))
    W.write_partitioned(urgent, path, ["o_orderpriority"])
    return R.read_parquet(spark, path)


def _customers_by_nation(spark, d):
    path = scratch_path(spark, "by-nation")
    W.write_partitioned(table(spark, d, "customer"), path, ["c_nationkey"])
    return R.read_parquet(spark, path)


@query("s5_partition_pruning", """
SELECT c_custkey, c_acctbal, c_nationkey FROM customer WHERE c_nationkey BETWEEN 3 AND 5""", "S5 S13")
def s5_partition_pruning(spark, d):
    """Only the folders of three nations are listed and read."""
    return _customers_by_nation(spark, d).where("c_nationkey BETWEEN 3 AND 5").select("c_custkey", "c_acctbal", "c_nationkey")


@query("s5_dynamic_pruning_join", """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1""", "S5 S13 J1")
def s5_dynamic_pruning_join(spark, d):
    """Which folders are read follows at run time from the other side of the join."""
    nation = table(spark, d, "nation").where("n_regionkey = 1")
    customers = _customers_by_nation(spark, d)
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


BUCKETS = 16


@query("j1_bucketed_join", """
SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""", "J1 S15 S7")
def j1_bucketed_join(spark, d):
    """Both tables are stored in buckets of the key, so the join reads them without a shuffle."""
    names = {}
    for t, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        names[t] = W.save_bucketed(table(spark, d, t), _catalog_name(d, f"{t}_bucketed"), [key], BUCKETS,
                                   scratch_path(spark, "bucketed"))
    orders, customer = (R.read_table(spark, names[t]) for t in ("orders", "customer"))
    # the merge join is asked for so that the plan is the one of tables too large to broadcast
    return (orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_totalprice", "c_custkey", "c_name"))


@query("s15_save_unique_table_then_drop", """
SELECT n_nationkey, n_name, n_regionkey FROM nation""", "S15")
def s15_save_unique_table_then_drop(spark, d):
    path = scratch_path(spark, "table")
    name = W.save_as_table(table(spark, d, "nation"), path=path)
    W.drop_table(spark, name)
    if spark.catalog.tableExists(name):
        raise RuntimeError(f"table {name} still exists after DROP")
    # an external table's files outlive the catalog entry
    return R.read_parquet(spark, path)


@query("i2_schema_listing", f"""
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name AS col_name,
       {_SPARK_TYPE_SQL.format(t='column_type')} AS data_type
FROM (DESCRIBE lineitem)""", "I2")
def i2_schema_listing(spark, d):
    return schema_frame(table(spark, d, "lineitem")).select("position", "col_name", "data_type")
