import json

import pytest

from tillwright import session
from tillwright.sources import readers, writers


class FakeReader:
    """Stands in for ``spark.read``: no database is run in the tests."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    def jdbc(self, url, table, **kw):
        self.calls.append((table, kw))
        return self

    def first(self):
        return self.bounds


class FakeSpark:
    def __init__(self, bounds=(1, 900, 750)):
        self.read = FakeReader(bounds)


def test_jdbc_reads_in_ranges():
    spark = FakeSpark()
    readers.read_jdbc_table(spark, "jdbc:x", "users", {"user": "u"}, split_by="id", rows_per_task=100)
    (extent, _), (table, kw) = spark.read.calls
    assert extent == "(SELECT MIN(id) AS lo, MAX(id) AS hi, COUNT(*) AS n FROM users) extent"
    assert table == "users" and kw == {
        "column": "id", "lowerBound": 1, "upperBound": 900, "numPartitions": 8, "properties": {"user": "u"}}


@pytest.mark.parametrize("spark,split", [(FakeSpark(), None), (FakeSpark((None, None, 0)), "id")])
def test_jdbc_reads_whole_table(spark, split):
    readers.read_jdbc_table(spark, "jdbc:x", "users", {}, split_by=split, single_task=True)
    assert spark.read.calls[-1] == ("users", {"properties": {}})


def test_lower_case_tables(spark):
    names = spark.createDataFrame([("users",), ("Orders",), ("cart",)], "table_name string")
    assert [r[0] for r in readers.lower_case_tables(names).collect()] == ["cart", "users"]


def test_catalog_tables(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    assert "some_view" in [r[0] for r in readers.list_catalog_tables(spark).collect()]


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "tags": ["x"]}, {"id": 2, "tags": []}], indent=1))
    df = readers.read_feed(spark, str(tmp_path / "a.json"), "id long, tags array<string>", json_arrays=True)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, ["x"]), (2, [])]


def test_unsupported_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported file format: .xlsx"):
        readers.read_feed(spark, "feed.xlsx")
    with pytest.raises(ValueError, match="Unsupported output format: xlsx"):
        writers.save_table(spark.range(1), str(tmp_path / "x"), "xlsx")


@pytest.mark.parametrize("suffix,format", [(".csv", "csv"), (".json", "json"), (".parquet", "parquet"), ("", "parquet")])
def test_round_trip_by_extension(spark, tmp_path, suffix, format):
    df = spark.createDataFrame([("1", 'a "quoted", text'), ("2", None)], "id string, text string")
    writers.save_table(df, path := str(tmp_path / f"t{suffix}"), format)
    got = readers.read_table(spark, path).orderBy("id").select("id", "text").collect()
    assert [tuple(r) for r in got] == [("1", 'a "quoted", text'), ("2", None)]


def test_partition_folders(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS part")
    writers.save_parquet(df, path := str(tmp_path / "t"), ["part"])
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"part=0", "part=1"}
    assert readers.read_table(spark, path).where("part = 1").count() == 5


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    assert first.startswith(shared) and first != second


def test_json_array_files(spark, tmp_path):
    """Every file is one JSON array; NULLs, quotes and line breaks survive."""
    df = spark.range(25).selectExpr("id", "if(id % 3 = 0, null, concat('a\"b\n', id)) text").repartition(3)
    path = writers.write_json_arrays(df, str(tmp_path / "arrays"))
    files = [json.loads(p.read_text()) for p in (tmp_path / "arrays").glob("part-*")]
    assert sum(len(rows) for rows in files) == 25 and all(isinstance(rows, list) for rows in files)
    back = readers.read_json_array(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_jdbc_needs_a_column_or_leave():
    with pytest.raises(ValueError, match="split"):
        readers.read_jdbc_table(FakeSpark(), "jdbc:x", "users", {})


def test_json_lines_and_arrays_are_not_mistaken(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('t', id) text").repartition(3)
    writers.save_json_lines(df, lines := str(tmp_path / "lines.json"))
    arrays = writers.write_json_arrays(df, str(tmp_path / "arrays.json"), 500)
    assert readers.read_feed(spark, lines, df.schema).count() == readers.read_table(spark, lines).count() == 100
    assert readers.read_feed(spark, arrays, df.schema, json_arrays=True).count() == 100
    assert readers.read_table(spark, arrays, "json_array").count() == 100
    with pytest.raises(Exception, match="no JSON array"):
        readers.read_feed(spark, lines, df.schema, json_arrays=True).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_feed(spark, arrays, df.schema).collect()


def test_json_array_files_are_bounded(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "'same' text")
    writers.write_json_arrays(df, str(tmp_path / "one"))
    writers.write_json_arrays(df, str(tmp_path / "many"), 20_000)
    sizes = [p.stat().st_size for p in (tmp_path / "many").glob("part-*")]
    assert len(list((tmp_path / "one").glob("part-*"))) == 1 and len(sizes) > 5 and max(sizes) < 40_000


def test_csv_splits_and_keeps_nested_values_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, {"a": "x"}, ["p", "q"])], "id long, specs map<string,string>, errors array<string>")
    writers.save_csv(df, path := str(tmp_path / "feed.csv"))
    assert [tuple(r) for r in readers.read_csv(spark, path).collect()] == [("1", '{"a":"x"}', '["p","q"]')]
    (tmp_path / "breaks.csv").write_text('id,text\n1,"two\nlines"\n')
    assert readers.read_csv(spark, str(tmp_path / "breaks.csv"), line_breaks=True).first()["text"] == "two\nlines"
    big = spark.range(200_000).selectExpr("id", "repeat('x', 50) text").coalesce(1)
    writers.save_csv(big, path := str(tmp_path / "big.csv"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    assert readers.read_csv(spark, path).rdd.getNumPartitions() > 5
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_keeps_blanks_and_empty_texts(spark, tmp_path):
    from tillwright.sources.readers import read_csv
    from tillwright.sources.writers import save_csv
    rows = [("  x ", ""), ("", None), (None, 'a "quoted", text'), ("\ttab", " "), ("null", '""')]
    save_csv(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "t.csv"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t.csv")).collect()), key=str) == sorted(rows, key=str)


def test_schema_of_many_small_array_files_takes_several_tasks(spark, tmp_path):
    df = spark.range(2_000).selectExpr("id", "concat('é \"', id) name", "id / 2 price", "if(id % 2 = 0, null, array(id)) tags")
    path = writers.write_json_arrays(df, str(tmp_path / "arrays.json"), 1_000)
    spark.sparkContext.setJobGroup("infer", "schema of arrays")
    try:
        back = readers.read_json_array(spark, path)
        status = spark.sparkContext.statusTracker()
        stages = [i for job in status.getJobIdsForGroup("infer") for i in status.getJobInfo(job).stageIds]
        assert max(status.getStageInfo(i).numTasks for i in stages if status.getStageInfo(i)) > 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert back.schema == spark.read.option("multiLine", True).json(path).schema
    assert sorted(back.select("id", "name").collect()) == sorted(df.select("id", "name").collect())


def test_schema_of_arrays_behind_byte_order_marks(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b"\xef\xbb\xbf" + b'[{"id": 1}, {"id": 2.5, "x": "y"}]')
    assert readers.read_json_array(spark, str(tmp_path)).schema == spark.read.option("multiLine", True).json(str(tmp_path)).schema
