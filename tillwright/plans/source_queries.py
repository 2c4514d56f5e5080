"""Reader and sink queries: write a table to the scratch folder and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import quality as Q
from tillwright.plans.quality_queries import FAULTY, ORDERS_REPORT, faulty
from tillwright.plans.registry import query
from tillwright.plans.shop import Shop
from tillwright.session import scratch_dir
from tillwright.sources import readers, writers


def _path(s: Shop, suffix: str) -> str:
    return f"{scratch_dir(s.spark, 'sink')}/table{suffix}"


@query("src_parquet", "SELECT * FROM part")
def src_parquet(s):
    return readers.read_table(s.spark, f"{s.sf_dir}/part.parquet")


@query("src_csv", "SELECT * FROM customer")
def src_csv(s):
    df = s.table("customer")
    writers.save_csv(df, path := _path(s, ".csv"))
    return readers.read_csv(s.spark, path, df.schema)


@query("src_by_extension", """SELECT 'csv' AS kind, p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_name FROM part
UNION ALL SELECT 'json lines', p_partkey, CAST(p_size AS VARCHAR), p_name FROM part
UNION ALL SELECT 'json arrays', p_partkey, CAST(p_size AS VARCHAR), p_name FROM part""")
def src_by_extension(s):
    """A feed as CSV without a schema (every column is text), as JSON lines and as files of JSON arrays."""
    df = s.table("part").select("p_partkey", "p_size", "p_name")
    writers.save_csv(df, csv := _path(s, ".csv"))
    writers.save_json_lines(df, lines := _path(s, ".json"))
    writers.write_json_arrays(df, arrays := _path(s, ".json"), 10_000)
    found = {"csv": readers.read_feed(s.spark, csv), "json lines": readers.read_feed(s.spark, lines, df.schema),
             "json arrays": readers.read_feed(s.spark, arrays, df.schema, json_arrays=True)}
    rows = [f.select(F.lit(kind).alias("kind"), F.col("p_partkey").cast("bigint"), F.col("p_size").cast("string"), "p_name")
            for kind, f in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("src_json_multiline", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def src_json_multiline(s):
    """A folder of files with one JSON array each; the schema is inferred and then made the table's."""
    df = s.table("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = writers.write_json_arrays(df, _path(s, ".json"), 20_000)
    return readers.read_json_array(s.spark, path).select(*[F.col(c).cast(t) for c, t in df.dtypes])


@query("sink_parquet_overwrite", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def sink_parquet_overwrite(s):
    """The second write replaces the first."""
    path = _path(s, ".parquet")
    for status in ("F", "O"):
        writers.save_parquet(s.table("orders").where(F.col("o_orderstatus") == status), path)
    return readers.read_table(s.spark, path)


@query("sink_json", "SELECT doc_id, text, lang, source FROM documents")
def sink_json(s):
    df = s.table("documents").select("doc_id", "text", "lang", "source")
    writers.save_json_lines(df, path := _path(s, ".json"))
    return readers.read_json_lines(s.spark, path, df.schema)


@query("sink_generic", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag <> 'A'")
def sink_generic(s):
    """CSV in one folder per return flag; the filter reads two of the three."""
    df = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    writers.save_table(df, path := _path(s, ""), "csv", folders_by=["l_returnflag"])
    return readers.read_csv(s.spark, path, df.schema).where("l_returnflag <> 'A'")


@query("sink_report_json", f"""WITH {FAULTY} SELECT "check", requested, issue_count, row_count FROM ({ORDERS_REPORT})""")
def sink_report_json(s):
    report = Q.prevalidation_report(faulty(s), "orders", Q.DEFAULT_EXPECTATIONS["orders"])
    path = writers.write_report(report.select("check", "requested", "issue_count", "row_count"), _path(s, ".json"))
    return s.spark.read.schema("check string, requested string, issue_count bigint, row_count bigint").json(path)
