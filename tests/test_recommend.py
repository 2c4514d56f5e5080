import random
import re

import pytest
from pyspark.sql import functions as F

from tillwright.operators import recommend as R
from tillwright.operators.features import feature_candidates, feature_texts, rarest_pieces, with_features
from tillwright.operators.ordering import running_totals
from tillwright.plans.catalog import QUERIES

# (id, category, description); the order is that of the ids
CATALOGUE = [
    (1, "lamps", "A warm bedside light"), (2, "lamps", "Bright work light with a clamp"), (3, "rugs", "Woven wool"),
    (4, "chairs", "Folding chair, light and strong"), (5, "chairs", "Oak chair"), (6, "shelves", "Oak shelf for books"),
    (7, "rugs", "Wool and linen runner"), (8, "lamps", "Paper shade"), (9, "shelves", "Steel rack"), (10, "tables", "Round oak table"),
    (11, "tables", "Work bench"), (12, "chairs", "Stool")]
USERS = {1: (["lamps", "rugs"], ["OAK", "work"]), 4: (["tables"], ["light", "velvet"])}
VIEW = ("event_id long, timestamp double, user_id long, product_id long, category string, "
        "preferred_categories array<string>, preferred_features array<string>")


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([(i, i, c, d) for i, c, d in CATALOGUE],
                                 "id long, pos long, category string, description string")


def views(spark, events, categories):
    rows = [(i, float(i), u, p, categories.get(p), *(USERS.get(u) or (None, None))) for i, (u, p) in enumerate(events)]
    return spark.createDataFrame(rows, VIEW)


def recommended(df):
    return {r["event_id"]: r["recs"] for r in df.collect()}


def categories_of(catalogue):
    return {r["id"]: r["category"] for r in catalogue.collect()}


def counters(spark, catalogue, events, k=5):
    v = views(spark, events, categories_of(catalogue))
    profiles = R.distinct_profiles(v)
    recs = R.recommend(v, R.catalogue_heads(catalogue, k), profiles)
    return R.event_counters(recs, R.relevant_counts(profiles, catalogue))


def test_goldens(spark, catalogue):
    """User 1 likes lamps and rugs, then oak and work; user 4 tables, then light things; nobody sees chairs first."""
    v = views(spark, [(1, 1), (4, 10), (None, 4)], categories_of(catalogue))
    nine = recommended(R.recommend(v, R.catalogue_heads(catalogue, 9)))
    assert nine[0] == [2, 3, 7, 8, 5, 6, 10, 11, 4] and nine[1] == [11, 1, 2, 4, 3, 5, 6, 7, 8]
    three = recommended(R.recommend(v, R.catalogue_heads(catalogue, 3)))
    assert three[2] == [5, 12, 1]
    assert recommended(R.same_category(v, R.catalogue_heads(catalogue, 3)))[1] == [11, 1, 2]


def test_repeated_ids_are_one_product(spark, catalogue):
    """A catalogue that lists products several times recommends each once and still fills the lists."""
    v = views(spark, [(1, 1), (4, 10), (None, 4)], categories_of(catalogue))
    once = recommended(R.recommend(v, R.catalogue_heads(catalogue, 5)))
    again = catalogue.unionByName(catalogue).unionByName(catalogue.where("id < 6"))
    assert recommended(R.recommend(v, R.catalogue_heads(again, 5))) == once


def test_metric_goldens(spark, catalogue):
    # 8 products suit user 1 (5 lamps and rugs, 4 oak or work of which one is a lamp), 5 suit user 4
    one = {r["user_id"]: r for r in R.metrics_by_user(counters(spark, catalogue, [(1, 1), (4, 10)])).collect()}
    assert (one[1]["precision"], one[1]["recall"]) == (1.0, 5 / 9) and one[1]["f1"] == pytest.approx(10 / 14)
    assert (one[4]["precision"], one[4]["recall"]) == (0.8, 4 / 5) and one[4]["f1"] == pytest.approx(0.8)
    twice = R.metrics_overall(counters(spark, catalogue, [(1, 1), (1, 1)])).first()
    assert (twice["precision"], twice["recall"]) == (1.0, 10 / 9)
    nobody = R.metrics_overall(counters(spark, catalogue, [(None, 1)])).first()
    assert (nobody["precision"], nobody["recall"], nobody["f1"]) == (0.0, 0.0, 0.0)


def test_user_zero_is_anonymous(spark, catalogue):
    v = views(spark, [(1, 1)], categories_of(catalogue)).withColumn("user_id", F.lit(0).cast("long"))
    assert R.recommend(v, R.catalogue_heads(catalogue, 3)).first()["has_profile"] is False


def brute(products, view, k):
    """Rank every product for one view."""
    _, _, user, seen, category, cats, feats = view
    known = cats is not None and bool(user)

    def tier(p):
        if known and p[2] in cats:
            return 1
        if known and any(f.lower() in p[3].lower() for f in feats or []):
            return 2
        return 3 if p[2] == category else 4

    ranked = sorted((p for p in products if p[0] != seen), key=lambda p: (tier(p), p[1]))
    return [p[0] for p in ranked][:k]


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = ["ab", "abc", "bca", "c", "dab", "Ad", "d", "xyz"]
    products = [(i, (i * 7) % 40, rnd.choice("PQRST"), " ".join(rnd.choices(words, k=rnd.randint(0, 3))))
                for i in range(rnd.choice([4, 40]))]
    stream = []
    for e in range(60):
        seen = rnd.randrange(len(products) + 1)
        category = products[seen][2] if seen < len(products) else None
        has = rnd.random() < 0.8
        cats = rnd.sample("PQRSTU", rnd.randint(0, 2)) if has else None
        feats = rnd.choices([*words, "b c", "B", "", "no"], k=rnd.randint(0, 2)) if has else None
        stream.append((e, float(e), rnd.choice([None, 0, 1, 2, 3]), seen, category, cats, feats))
    catalogue = spark.createDataFrame(products, "id long, pos long, category string, description string")
    v = spark.createDataFrame(stream, VIEW)
    for k in (1, 3, 6):
        got = recommended(R.recommend(v, R.catalogue_heads(catalogue, k)))
        for view in stream:
            want = brute(products, view, k)
            assert got[view[0]] == want
            assert len(want) == min(k, len([p for p in products if p[0] != view[3]]))

    profiles = R.distinct_profiles(v)
    found = {(tuple(r[0]), tuple(r[1])): r[2] for r in R.relevant_counts(profiles, catalogue).collect()}
    for view in stream:
        if view[5] is not None and view[2]:
            feats = tuple(f.lower() for f in view[6])
            want = sum(p[2] in view[5] or any(f in p[3].lower() for f in feats) for p in products)
            assert found.get((tuple(view[5]), feats), 0) == want


def test_feature_search(spark):
    rnd = random.Random(3)
    texts = sorted({"".join(rnd.choices("ab c", k=rnd.randint(0, 9))) for _ in range(80)})
    features = ["", "a", " ", "b c", "ab", "abab", "zz", "c a", "bb"]
    t, f = spark.createDataFrame([(x,) for x in texts], "text string"), spark.createDataFrame([(x,) for x in features], "feature string")
    want = {y: sorted(x for x in features if x in y) for y in texts}
    want = {y: found for y, found in want.items() if found}
    rows = t.withColumn("extra", F.lit(1)).unionByName(t.withColumn("extra", F.lit(2))).unionByName(
        spark.createDataFrame([(None, 1)], "text string, extra int"))
    got = with_features(rows, f).collect()
    assert {r["text"]: r["found"] for r in got} == want and len(got) == 2 * len(want)
    for prefix in (1, 3, 6):
        pairs = feature_texts(f, t, prefix).collect()
        assert sorted(tuple(r) for r in pairs) == sorted((x, y) for y, found in want.items() for x in found)


def test_no_join_of_the_feature_search_carries_texts(spark, tmp_path):
    texts = ["See Internationally known, (internationalization) " + "x y " * 50, "internationally", "no long word", None, "Internationally",
             "internationalizationx internationally"]
    rows = [(i, t) for i, t in enumerate(texts + texts[:2])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["rec_feature_search"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    lowered = [(i, t.lower()) for i, t in rows if t]
    features = {w for _, t in lowered for w in re.findall("[a-z]{12,}", t)}
    found = {f: [i for i, t in lowered if f in t] for f in features}
    assert {tuple(r) for r in got.collect()} == {(f, len(ids), min(ids)) for f, ids in found.items()} and len(features) == 3
    assert "Join" in plan and "hashpartitioning(text" not in plan


def test_a_feature_is_looked_up_by_its_rarest_piece(spark):
    """Every text begins as the features do; each feature still meets the one text that has it."""
    texts = spark.createDataFrame([(f"common start {i:04d}",) for i in range(300)], "text string")
    features = spark.createDataFrame([(f"common start {i:04d}",) for i in range(0, 300, 3)] + [("common",)], "feature string")
    cut = F.transform(F.sequence(F.lit(1), F.length("text") - 3), lambda i: F.substring("text", i, 4))
    pieces = texts.select(F.xxhash64("text").alias("mark"), F.explode(F.array_distinct(cut)).alias("piece"))
    chosen = {r.feature: r.n for r in rarest_pieces(features, pieces).collect()}
    assert chosen.pop("common") == 300 and max(chosen.values()) <= 30
    pairs = feature_texts(features, texts).groupBy("feature").count().collect()
    assert {r.feature: r["count"] for r in pairs} == {**dict.fromkeys(chosen, 1), "common": 300}


def test_long_features_of_common_syllables_meet_few_texts(spark):
    """Every text has every four characters of a feature somewhere; candidates stay near the texts that have the feature."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices(["tion", "ande", "erst", "zung"], k=5)) for _ in range(120)]
    pairs = sorted(x + y for x in ("tion", "ande", "erst", "zung") for y in ("tion", "ande", "erst", "zung"))
    texts = spark.createDataFrame([(f"{' '.join(pairs)} {w}",) for w in set(words)], "text string")
    features = spark.createDataFrame([(w,) for w in set(words)], "feature string")
    marked = texts.select("text", F.xxhash64("text").alias("mark"))
    assert feature_candidates(features, marked).count() <= 10 * len(set(words))
    assert feature_texts(features, texts).count() == len(set(words))


def test_one_feature_in_all_profiles_and_products(spark):
    """Rows of the joins stay near the sum of the inputs: a key costs a row per 32,768 products."""
    catalogue = spark.range(4000).selectExpr("id", "id pos", "concat('c', id % 50) category", "concat('oak ', id % 7) description")
    profiles = spark.range(500).selectExpr(
        "array(concat('c', id % 50)) preferred_categories", "array('oak', concat('x', id)) preferred_features")
    numbered = R.numbered_products(catalogue)
    pairs = feature_texts(R._distinct_features(profiles), numbered.select("text").distinct())
    bitmaps = R.feature_bitmaps(numbered, pairs)
    assert bitmaps.count() <= max(1, numbered.rdd.getNumPartitions()) + 1
    counts = R.relevant_counts(profiles, catalogue).collect()
    assert len(counts) == 500 and {r.relevant_products for r in counts} == {4000}


def test_whole_products(spark, catalogue):
    v = views(spark, [(1, 1), (4, 10), (None, 4)], categories_of(catalogue))
    rows = catalogue.unionByName(catalogue.withColumn("pos", F.col("pos") + 50))
    got = R.recommend(v, R.catalogue_heads(rows, 5, ("id", "category", "description"))).collect()
    want = recommended(R.recommend(v, R.catalogue_heads(catalogue, 5)))
    names = {i: (i, c, d) for i, c, d in CATALOGUE}
    for r in got:
        assert r.recs == want[r.event_id] and [tuple(p) for p in r.products] == [names[i] for i in r.recs]


def test_running_totals_with_a_hot_key(spark):
    """One key holds most rows and spans several partitions."""
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b"]), i, rnd.randint(-5, 5)) for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, seq long, x long").repartition(5)
    out = running_totals(df, ["key"], ["seq"], {"n": F.lit(1), "total": F.col("x")})
    assert out.groupBy("key").agg(F.max("n")).count() == 3
    want, state = {}, {}
    for key, seq, x in sorted(rows, key=lambda r: r[1]):
        n, total = state.get(key, (0, 0))
        state[key] = want[seq] = (n + 1, total + x)
    assert {r["seq"]: (r["n"], r["total"]) for r in out.collect()} == want


def test_running_totals_over_everything(spark):
    out = running_totals(spark.range(500).repartition(6), [], ["id"], {"n": F.lit(1)})
    assert all(r["n"] == r["id"] + 1 for r in out.collect())


def test_history_rows_stay_short(spark):
    events = spark.range(1000).selectExpr(
        "if(id % 3 = 0, 1, id) user_id", "'viewed' kind", "cast(id as double) timestamp", "id event_id", "id * 2 product_id")
    chunks = R.history_chunks(events, 50).where("user_id = 1").orderBy("chunk").collect()
    assert max(len(r["product_ids"]) for r in chunks) == 50
    assert [p for r in chunks for p in r["product_ids"]] == sorted({0, 2} | {i * 2 for i in range(0, 1000, 3)})
