import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tillwright.functions.numbers import two_decimals
from tillwright.operators import feeds as V
from tillwright.sources import writers

SCHEMA = ("product_id string, name string, category string, brand string, description string, price double, "
          "currency string, in_stock string, specifications map<string,string>, images array<string>")
FEED = [
    ("LMP-20417", "Desk lamp", "GPUs", "Nordlys", "for desks", 59.5, "EUR", "true",
     {"memory": "3 GB", "clock_speed": "0.4 GHz", "power_consumption": "12 W", "cores": "6"}, ["front", "back"]),
    ("RCK-3308", "Rack", "AI Hardware", "Stahl", "holds six", 640.0, "GBP", "true",
     {"shelves": "6", "memory": "0.5 TB", "storage": "1.5 TB", "load": "90 kg"}, ["side"]),
    ("no id at all!", "Puzzle", "Toys", "Spiel", "in pieces", -1.0, "SEK", "yes",
     {"memory": "8GB", "clock_speed": "650 MHz", "power_consumption": "2 W"}, []),
]
SPECS = [
    {"memory": "3.00 GB", "clock_speed": "0.40 GHz", "power_consumption": "12.00 W", "cores": "6"},
    {"shelves": "6", "memory": "512.00 GB", "storage": "1536.00 GB", "load": "90 kg"},
    {"memory": "8.00 GB", "clock_speed": "0.65 GHz", "power_consumption": "2.00 W"},
]


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(FEED, SCHEMA)


def test_golden_feed(feed):
    got = V.validate_feed(feed).collect()
    assert [r["specifications"] for r in got] == SPECS
    assert [len(r["errors"]) for r in got] == [0, 0, 5]
    errors = got[2]["errors"]
    assert errors[0] == "Field 'in_stock' must be of type bool"
    assert errors[1] == "Invalid product_id format: no id at all!"
    assert errors[2].startswith("Invalid category: Toys. Must be one of: GPUs, AI Hardware")
    assert errors[3] == "Price out of valid range (0-1000000): -1.0"
    assert errors[4] == "Invalid currency: SEK. Must be one of: USD, EUR, GBP, JPY, CNY"
    assert got[2]["in_stock"] is True


@pytest.mark.parametrize("key,value,want", [
    ("memory_clock", "800 MHz", "0.80 GB"), ("memory", "16 gb", "16 gb"), ("weight", "5 W", "5 W"),
    ("memory", "128 MB", "0.12 GB"), ("memory", "1.2.3 GB", "1.2.3 GB"), ("Clock", " 1005 MHz ", f"{1005 * (1 / 1000):.2f} GHz"),
    ("storage", None, None),
])
def test_units(spark, key, value, want):
    df = spark.createDataFrame([(key, value)], "k string, v string")
    assert df.select(V.standard_unit(F.col("k"), F.col("v"))).first()[0] == want


def test_two_decimals_agrees_with_exact_formatting(spark):
    values = [i / 1000 for i in range(0, 4000, 5)] + [i / 8 for i in range(200)] + [1e9 / 3, 0.0, 123456.785]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(two_decimals(F.col("x"))).collect()] == [f"{v:.2f}" for v in values]


def test_price_and_id_limits(spark):
    rows = [("A" * n, "GPUs", p) for n, p in ((5, 0.0), (6, 1000000.0), (50, 1000000.5), (51, 1.0))] + [("", "", None)]
    df = spark.createDataFrame(rows, "product_id string, category string, price double")
    got = df.select(V.product_id_error().isNotNull(), V.price_error().isNotNull(), V.category_error().isNotNull()).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False), (False, False, False), (False, True, False), (True, False, False), (False, True, False)]


def test_rules_can_be_overridden(feed):
    rules = V.FeedRules(categories=["Toys"], currencies=["SEK", "EUR"], product_id=".*", prices=(-200, 10**6))
    errors = {r["product_id"]: r["errors"] for r in V.validate_feed(feed, rules).collect()}
    assert errors["no id at all!"] == ["Field 'in_stock' must be of type bool"]
    assert errors["LMP-20417"][0].startswith("Invalid category: GPUs")


def test_markdown_report(spark, feed, tmp_path):
    report = V.error_report(V.validate_feed(feed))
    assert V.products_with_errors(report).first()[0] == 1
    writers.write_error_report(report, str(tmp_path / "r"), "Feed report", "2025-01-01")
    parts = sorted(p for p in (tmp_path / "r").iterdir() if p.name.startswith("part"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines[:6] == ["# Feed report", "Generated on: 2025-01-01", "", "Found validation errors in 1 products:", "",
                         "## Product ID: no id at all!"]
    assert lines[6] == "- Field 'in_stock' must be of type bool" and len(lines) == 12

    writers.write_error_report(report.limit(0), str(tmp_path / "e"), "Feed report", "2025-01-01")
    text = "".join(p.read_text() for p in sorted((tmp_path / "e").iterdir()) if p.name.startswith("part"))
    assert "No validation errors found. All products passed validation." in text


def test_repeated_and_missing_ids(spark, feed):
    twice = feed.unionByName(feed).withColumn("row", F.monotonically_increasing_id())
    assert {r["rows"] for r in V.error_report(V.validate_feed(twice)).collect()} == {2}
    nameless = feed.drop("product_id").withColumn("row", F.lit(7))
    report = V.error_report(V.validate_feed(nameless), "row")
    assert {r["product_id"] for r in report.collect()} == {"unknown_7"}
    assert "Missing required field: product_id" in {r["error"] for r in report.collect()}


def test_tasks(spark):
    bad_time = "Invalid Estimated Time format (expected e.g., '2h')"
    rows = [("2h", "o", ""), ("3 h", "o", ""), (" 10H ", "o", ""), ("2.5h", "o", bad_time), ("2 hours", "o", bad_time),
            (None, "o", f"Missing Estimated Time; {bad_time}"), ("1h", "nan", "Missing Owner"), ("\t4h\n", "o", "")]
    df = spark.createDataFrame([("1", "t", "d", o, t, w) for t, o, w in rows],
                               "`Task ID` string, `Task Name` string, Description string, Owner string, "
                               "`Estimated Time` string, want string")
    assert [r["Issues"] for r in V.check_tasks(df).collect()] == [w for _, _, w in rows]
    clean, errors = V.split_tasks(df)
    assert (clean.count(), errors.count()) == (4, 4) and "Issues" not in clean.columns


def test_records_tell_absent_keys_from_nulls(spark, tmp_path):
    whole = ('{"product_id": "ABC-123", "name": "n", "category": "GPUs", "brand": "b", "description": "d", "price": 1.5, "currency": "USD",'
             ' "in_stock": true, "specifications": {"memory": "2 TB"}, "images": ["a"]}')
    lines = [whole, whole.replace('"brand": "b", ', ""), whole.replace('"b"', "null"), whole.replace("1.5", "7"), whole.replace("1.5", "null"),
             whole.replace('"price": 1.5, ', ""), whole.replace("true", '"Yes"'), whole.replace('["a"]', '"a"'), "no json", whole.replace("GPUs", "x")]
    (tmp_path / "feed.json").write_text("\n".join(lines))
    from tillwright.sources.readers import read_variants
    records = read_variants(spark, str(tmp_path / "feed.json"))
    rows = V.validate_records(records).collect()
    assert [r["line"] for r in rows] == lines
    wrong = [r["errors"] for r in rows]
    assert wrong[0] == [] and wrong[1] == ["Missing required field: brand"] and wrong[2] == ["Field 'brand' must be of type str"]
    # a whole number is no float, but is read as one; a null price is not out of range, an absent one is only missing
    assert wrong[3] == ["Field 'price' must be of type float"] and rows[3]["price"] == 7.0
    assert wrong[4] == ["Field 'price' must be of type float"] and wrong[5] == ["Missing required field: price"]
    assert wrong[6] == ["Field 'in_stock' must be of type bool"] and rows[6]["in_stock"] is True
    assert wrong[7] == ["Field 'images' must be of type list"] and wrong[8] == ["Not a JSON record"] and len(wrong[9]) == 1
    assert rows[0]["specifications"] == {"memory": "2048.00 GB"} and rows[0]["images"] == ["a"]
    assert "price: DECIMAL" in V.feed_schema(records.limit(1)).first()[0]


def test_specs_are_standardised_once(spark, tmp_path, capsys):
    spark.createDataFrame([(7, "a b", "Brand#1", "TYPE", 2, 9.5), (8, None, None, None, None, None)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    specs = queries()["feed_spec_units"](spark, str(tmp_path))
    specs.explain()
    assert capsys.readouterr().out.count("transform_values(") == 1
    rows = {(r.row_id, r.spec_key): r.spec_value for r in specs.collect()}
    assert len(rows) == 14 and rows[7, "power"] == "2000.00 W" and rows[8, "power"] is None
