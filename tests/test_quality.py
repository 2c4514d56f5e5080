import pytest
from pyspark.sql import functions as F

from tillwright.operators import contracts as K
from tillwright.operators import profiling as P
from tillwright.operators import quality as Q
from tillwright.operators import sales as S


@pytest.fixture(scope="module")
def column(spark):
    return spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "v int")


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_three_ways_of_counting_repeats(column):
    assert pairs(Q.not_null(column, ["v", "absent"])) == {"v": 2}
    assert pairs(Q.unique(column, ["v"])) == {"v": 2}
    assert Q.duplicate_keys(column, ["v"]).first()[0] == 2
    assert pairs(P.distinct_counts(column)) == {"v": 2}
    top = P.value_frequencies(column).orderBy("rank").collect()
    assert [(r["value"], r["n"]) for r in top] == [("1", 2), (None, 2), ("2", 1)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id int, name string")
    assert Q.unique(empty, ["id"]).count() == 0
    report = Q.prevalidation_report(empty, "users", Q.DEFAULT_EXPECTATIONS["users"]).collect()
    assert {(r["requested"], r["column"], r["issue_count"]) for r in report} == {("id", "id", 0), ("email", None, None)}
    assert P.column_stats(empty.select("name")).count() == 0


def test_zeroes_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "v double")
    assert pairs(P.distinct_counts(df)) == {"v": 2}


def test_column_resolution():
    columns = ["id", "users_id", "email"]
    assert Q.resolve_columns(columns, "users", ["users_id", "email", "nick"], {"id": "users_id"}) == {
        "users_id": "id", "email": "email", "nick": None}
    assert Q.resolve_columns(columns, "users", ["nick"], legacy=True) == {"nick": "users_id"}
    assert Q.resolve_columns(["users_id"], "users", ["id"]) == {"id": "users_id"}


def test_null_checks_do_not_quarantine(spark):
    df = spark.createDataFrame([(1, 6.0), (2, None), (0, 1.0), (3, 4.0)], "id int, rating double")
    checks = [Q.is_positive("id"), Q.is_in_range("rating", 0, 5)]
    held = {r["id"]: r["failed_checks"] for r in Q.quarantine(df, checks).collect()}
    assert held == {1: ["rating_in_range"], 0: ["id_positive"]}
    assert Q.quarantine(df, checks, strict=True).count() == 3


CONTRACT = K.Contract(["id", "first_name", "last_name", "email"], ["username"], ["temp_flag", "legacy_user"])


def test_contract_by_schema_and_by_data(spark):
    df = spark.createDataFrame([(1, "a", None, 1, "n")], "id int, first_name string, email string, temp_flag int, nick string")
    found = K.check_contract(df, "users", CONTRACT).collect()
    kinds = {k: sorted(r["column"] for r in found if r["kind"] == k) for k in ("missing", "disallowed", "nullable", "unexpected")}
    assert kinds == {"missing": ["last_name"], "disallowed": ["temp_flag"], "unexpected": ["nick"],
                     "nullable": ["email", "first_name", "id", "last_name"]}
    by_data = K.check_contract(df, "users", CONTRACT, use_data=True).where("kind = 'nullable'").collect()
    assert sorted(r["column"] for r in by_data) == ["email", "last_name"]
    with pytest.raises(K.ContractError, match=r"users: Missing required columns: \['last_name'\] \| Disallowed"):
        K.require_contract(df, "users", CONTRACT)
    assert K.require_contract(df, "users", K.Contract(optional=df.columns)) is df


def test_contract_from_schema(spark):
    df = spark.range(1).selectExpr("id", "cast(null as string) name")
    assert K.contract_from_schema(df) == K.Contract(["id"], ["name"], ())


def test_newest_versions_per_table(spark):
    rows = [("a", v, "c", "optional") for v in range(7)] + [("b", 1, "c", "optional")]
    df = spark.createDataFrame(rows, "table_name string, version int, column string, bucket string")
    kept = {(r[0], r[1]) for r in K.newest_versions(df, 5).collect()}
    assert kept == {("a", v) for v in range(2, 7)} | {("b", 1)}


def test_given_rules_win(spark):
    df = spark.createDataFrame([(1, "yes", None), (2, "no", None)], "id int, flag string, note string")
    given = spark.createDataFrame([("t", "type_conversions", "flag", "StringType")], K.RULE)
    rules = {(r["section"], r["column"]): r["value"] for r in K.master_rules({"t": df}, given).collect()}
    assert rules == {("rename_columns", "id"): "t_id", ("type_conversions", "flag"): "StringType",
                     ("null_replacements", "note"): "UNKNOWN"}


WEEKS = [("GeForce RTX 4070 Family", 2025, 36, 2, 1999.98), ("NVIDIA L4 GPU", 2025, 36, 1, 23.5),
         ("Jetson Orin Nano Super Developer Kit", 2025, 42, 1, 1499.99)]


def test_sales_golden(spark):
    weekly = spark.createDataFrame(WEEKS, "product string, year int, week_number int, total_quantity long, total_revenue double")
    assert tuple(S.kpis(weekly).first()) == (3523.47, 4)
    assert [r["product"][:6] for r in S.top_products(weekly).collect()] == ["GeForc", "Jetson", "NVIDIA"]
    trend = S.revenue_trend(weekly).groupBy("week_number").agg(F.round(F.sum("total_revenue"), 2))
    assert pairs(trend) == {36: 2023.48, 42: 1499.99}
    assert S.kpis(weekly, "NVIDIA L4 GPU").first()["total_revenue"] == 23.5


def test_iso_weeks(spark):
    sales = spark.sql("SELECT 'p' product, date'2024-12-30' sold_at, 1L quantity, 2.0D revenue")
    assert tuple(S.weekly_sales(sales).first()) == ("p", 2025, 1, 1, 2.0)


def test_value_counts_of_every_kind(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 2L, -0.0D, 'a', true, DATE'2024-01-01', TIMESTAMP'2024-01-01 01:00:00', 1.50BD, array(1)),
        (1, 3L, 0.0D, NULL, false, NULL, TIMESTAMP'2024-01-01 01:00:00', 1.50BD, array(1)),
        (NULL, 3L, double('NaN'), 'a', NULL, DATE'2024-01-02', NULL, 2.00BD, NULL) AS t(i, `l.ong`, d, s, b, day, at, dec, arr)""")
    got = {(r["column"], r["value"]): r["n"] for r in P.value_counts(df).collect()}
    assert got == {
        ("i", "1"): 2, ("i", None): 1, ("l.ong", "2"): 1, ("l.ong", "3"): 2, ("d", "0.0"): 2, ("d", "NaN"): 1,
        ("s", "a"): 2, ("s", None): 1, ("b", "true"): 1, ("b", "false"): 1, ("b", None): 1,
        ("day", "2024-01-01"): 1, ("day", None): 1, ("day", "2024-01-02"): 1,
        ("at", "2024-01-01 01:00:00"): 2, ("at", None): 1, ("dec", "1.50"): 2, ("dec", "2.00"): 1,
        ("arr", "[1]"): 2, ("arr", None): 1}


def test_no_listed_column_is_present(spark):
    df = spark.range(3)
    assert Q.not_null(df, ["nope"]).collect() == [] and Q.unique(df, ["nope"]).collect() == []


def test_nested_values_are_told_apart(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],), (None,)], "tags array<string>")
    assert [tuple(r) for r in P.distinct_counts(df).collect()] == [("tags", 2)]
    assert [(r["value"], r["n"]) for r in P.value_frequencies(df, 1).collect()] == [('["a","b"]', 2)]


def test_snapshots_are_appended(spark, tmp_path):
    rows = K.contract_rows(spark, {"t": K.Contract(required=["a"], optional=["b"])})
    K.append_snapshot(spark, str(tmp_path / "h"), rows, 1)
    K.append_snapshot(spark, str(tmp_path / "h"), rows, 2)
    got = K.append_snapshot(spark, str(tmp_path / "h"), rows.where("column = 'a'"), 2)
    assert sorted((r["version"], r["column"]) for r in got.collect()) == [(1, "a"), (1, "b"), (2, "a")]


def test_small_amounts_add_up(spark):
    sales = spark.range(1000).selectExpr("'p' product", "date'2024-03-01' sold_at", "1L quantity", "0.004D revenue")
    assert S.kpis(S.weekly_sales(sales)).first()["total_revenue"] == 4.0
