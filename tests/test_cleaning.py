import pytest
from pyspark.sql import functions as F

from tillwright.operators import cleaning as C

RULES = {
    "rename_columns": {"id": "item_id", "absent": "x"},
    "type_conversions": {"item_id": "long", "price": "float", "when": "TimestampType", "id": "string", "kind": "decimal"},
    "null_replacements": {"kind": "UNKNOWN", "price": 0, "item_id": "none"},
    "case_formatting": {"kind": "title"},
    "standardize_units": {"size": {"from": "(?i)kg$", "to": "e0", "factor": 1000}},
    "drop_columns": ["junk", "absent"],
    "filters": ["price >= 0", "item_id <> '3'"],
}
DATA = [("1", "9.5", "2024-01-01 10:00:00", "big box", " 2 KG", "j"), ("2", "free", "soon", None, "3 lb", "j"),
        ("3", "1", None, "x", "1kg", "j"), ("bad", "-1", None, "x", "1kg", "j"), ("x", "4", None, "x", None, "j")]
SCHEMA = "id string, price string, when string, kind string, size string, junk string"


def test_whole_chain(spark):
    out = C.clean_by_rules(spark.createDataFrame(DATA, SCHEMA), RULES)
    assert out.columns == ["item_id", "price", "when", "kind", "size"]
    got = [(r["item_id"], r["price"], r["kind"], r["size"]) for r in out.collect()]
    assert got == [("1", 9.5, "Big Box", 2000.0), ("2", 0.0, "Unknown", None), ("none", 4.0, "X", None)]


def test_no_rules_no_change(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert C.clean_by_rules(df, {}) is df


def test_cleaning_twice_changes_nothing(spark):
    rules = {k: v for k, v in RULES.items() if k not in ("rename_columns", "standardize_units", "filters")}
    once = C.clean_by_rules(spark.createDataFrame(DATA, SCHEMA), rules)
    assert C.clean_by_rules(once, rules).collect() == once.collect()


def test_one_projection(spark):
    plan = C.clean_by_rules(spark.range(5).selectExpr("cast(id as string) id", "'a' kind"), {
        "type_conversions": {"id": "int"}, "null_replacements": {"kind": "b"}, "case_formatting": {"kind": "upper"}})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Project") == 1


@pytest.mark.parametrize("config", [{"tables": {"t": {"filters": ["a > 1"]}}}, {"t": {"filters": ["a > 1"]}}])
def test_both_config_shapes(tmp_path, config):
    import yaml
    (tmp_path / "rules.yaml").write_text(yaml.safe_dump(config))
    assert C.load_rules(str(tmp_path / "rules.yaml"), "t") == {"filters": ["a > 1"]}
    assert C.load_rules(str(tmp_path / "rules.yaml"), "other") == {}


def test_unknown_types_are_reported():
    assert C.unknown_types({"a": "int", "b": "decimal"}) == {"b": "decimal"}


def test_bookmark(spark):
    df = spark.createDataFrame([(1, "a"), (5, None), (3, "b"), (7, None)], "id long, v string")
    kept = C.dropna_subset(C.rows_after(df, 2), ["v"])
    assert C.next_bookmark(kept, 2).first()[0] == 3
    assert C.next_bookmark(C.rows_after(df, 9), 9).first()[0] == 9


def test_strings_and_timestamps(spark):
    df = spark.createDataFrame([("  a \t b\n", "0000-00-00 00:00:00"), ("   ", "2024-02-03 04:05:06"), (None, "x")],
                               "name string, created_at string")
    got = C.clean_strings_timestamps(df, ["name", "model"], ["created_at"]).collect()
    assert [r["name"] for r in got] == ["a b", None, None]
    assert [str(r["created_at"]) for r in got] == ["None", "2024-02-03 04:05:06", "None"]


def test_incremental_runs(spark, tmp_path):
    """Each run loads what came since the last; a run whose bookmark is missing is done again."""
    out, marks = str(tmp_path / "rows"), str(tmp_path / "marks")
    load = lambda n: sorted(r["id"] for r in C.incremental_load(
        spark.range(n).withColumn("x", F.when(F.col("id") % 4 != 3, 1)), lambda df: df.dropna(), out, marks, default=-1).collect())
    assert C.load_bookmark(spark, marks, -1) == (-1, -1)
    assert load(4) == [0, 1, 2] and C.load_bookmark(spark, marks) == (0, 2)
    assert load(6) == [4, 5] and load(6) == [] and C.load_bookmark(spark, marks) == (2, 5)
    spark.range(1).write.parquet(f"{out}/run=3")  # left by a run that broke off
    assert load(10) == [6, 8, 9] and sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 4, 5, 6, 8, 9]


def test_incremental_stream(spark, tmp_path, monkeypatch):
    """Three exports that overlap; the second run stops between its rows and its bookmark and is done again."""
    out, marks, source = str(tmp_path / "rows"), str(tmp_path / "marks"), str(tmp_path / "in")

    def run(n):
        if n:
            spark.range(n).withColumn("x", F.when(F.col("id") % 4 != 3, 1)).write.mode("append").parquet(f"{source}/export={n}")
        stream = spark.readStream.schema("id long, x int").parquet(f"{source}/export=*")
        C.start_incremental(stream, lambda df: df.dropna(), out, marks, str(tmp_path / "state"), default=-1).awaitTermination()

    def broken(*_):
        raise RuntimeError("stopped before the bookmark")

    run(4)
    assert C.load_bookmark(spark, marks) == (0, 2)
    with monkeypatch.context() as patch, pytest.raises(Exception, match="stopped"):
        patch.setattr(C, "_save_bookmark", broken)
        run(6)
    assert C.load_bookmark(spark, marks) == (0, 2)
    run(0)
    assert C.load_bookmark(spark, marks) == (1, 5)
    run(10)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 4, 5, 6, 8, 9]
