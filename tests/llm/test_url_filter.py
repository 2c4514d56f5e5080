import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillwright.llm.url_filter import CHARACTERS, ORDER, Rule, address_scores, filter_urls, folded, gram_counts, gram_weights, ruled

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
EDGES = [
    ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
    ("https://a.example.com/en/1?x=/es/", "a.example.com", "/en/1", "example.com/en/"),
    ("https://example.com/EN/1", "example.com", "/EN/1", "com/"), ("https://badexample.com/en/", "badexample.com", "/en/", "com/"),
    ("x://com/", "com", "/", "com/"), ("http://a.com", "a.com", "", None), ("http://a.com?x=://b.net/es/", "a.com", "", None),
    ("http://net/es/", "net", "/es/", "net/es/"), ("http://planet/es/", "planet", "/es/", None), ("http://a.net/es", "a.net", "/es", None),
    ("http://a.net#/es/", "a.net", "", None), ("http:/a.net/es/", "", "", None), ("", "", "", None), (None, "", "", None),
    ("http://", "", "", None), ("http://É.NET/fr/#x", "É.net", "/fr/", "net/fr/"), ("http://" + "a" * 50_000 + ".net/es/" + "b" * 50_000,
                                                                                   "a" * 50_000 + ".net", "/es/" + "b" * 50_000, "net/es/"),
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "h", "v", 1) for i, u in urls], "page_id long, url string, host string, verdict string, number int")


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in ruled(frame(spark, enumerate(e[0] for e in EDGES))).collect()}
    for i, (_, host, path, rule) in enumerate(EDGES):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == dict(RULES).get(rule)


def test_everything_has_a_verdict(spark):
    rows = [*enumerate(e[0] for e in EDGES), (None, None), (0, EDGES[0][0])]
    got = filter_urls(frame(spark, rows)).collect()
    assert len(got) == len(rows) and {r.verdict for r in got} <= {"allow", "block"}
    assert all(r.verdict == "allow" for r in got if r.host == "")
    assert filter_urls(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_no_examples_of_a_class(spark):
    urls = [(i, f"http://site{'abcdefgh'[i]}.com/a") for i in range(8)] + [(9, "http://other.org/a")]
    assert {r.verdict for r in filter_urls(frame(spark, urls)).collect()} == {"allow"}


def test_probabilities(spark):
    """Against a plain model in Python, for all grams of some addresses."""
    addresses = [("abc/ab", 3, 0), ("abd", 1, 2), ("xx/ab", 0, 5), ("a", 1, 1), ("", 2, 0)]
    rows = spark.createDataFrame(addresses, "address string, accepted long, rejected long")
    asked = ["abc/xq", "zzz", "ab"]
    grams = [("^" * ORDER + a + "$")[i:i + ORDER + 1] for a in asked for i in range(len(a) + 1)]
    got = {r.gram: r.weight for r in gram_weights(gram_counts(rows), spark.createDataFrame([(g,) for g in set(grams)], "gram string")).collect()}
    logs = {}
    for column, name in ((1, "accepted"), (2, "rejected")):
        seen, followers = Counter(), defaultdict(set)
        for row in addresses:
            padded = "^" * ORDER + row[0] + "$"
            for i in range(ORDER, len(padded)):
                for n in range(ORDER + 1):
                    seen[padded[i - n:i], padded[i]] += row[column]
                    if row[column]:
                        followers[padded[i - n:i]].add(padded[i])
        totals = Counter()
        for (context, _), n in seen.items():
            totals[context] += n
        for gram in set(grams):
            p = 1 / CHARACTERS
            for n in range(ORDER + 1):
                context = gram[ORDER - n:ORDER]
                if totals[context]:
                    kinds = len(followers[context])
                    p = (seen[context, gram[-1]] + kinds * p) / (totals[context] + kinds)
            logs[name, gram] = math.log(p)
    assert got == {g: round((logs["rejected", g] - logs["accepted", g]) * 1e6) for g in set(grams)}


@pytest.mark.parametrize("text,want", [("A12b/3", "a0b/0"), ("é!x", "??x"), ("", "")])
def test_folded(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(folded(F.col("t"))).first()[0] == want


def test_bad_hosts_are_found(spark):
    """The rules know some casino and some garden sites; the others are told apart by their characters."""
    words = {"block": ["casino", "jackpot", "pokerwin", "betslots"], "allow": ["garden", "flowers", "treecare", "seedlings"]}
    rules = (Rule("block", "bad.net/"), Rule("allow", "good.net/"))
    urls, want = [], {}
    for kind, names in words.items():
        for i in range(40):
            name = names[i % 4] + "-" + names[i // 4 % 4]
            known = {"block": "bad.net", "allow": "good.net"}[kind] if i % 2 else "org"
            page = len(urls)
            urls.append((page, f"http://{name}{'abcdefghij'[i // 4]}.{known}/{names[i % 3]}/{i}"))
            if known == "org":
                want[page] = kind
    got = {r.page_id: r.verdict for r in filter_urls(frame(spark, urls), rules).collect()}
    assert sum(got[p] == k for p, k in want.items()) >= 0.9 * len(want)


def test_scores_are_per_character(spark):
    names = [("a" * n, 5, 0, 0) for n in range(3, 9)] + [("b" * n, 0, 5, 0) for n in range(3, 9)]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate([*names, ("ab", 0, 0, 1), ("a" * 40, 0, 0, 1), ("", 0, 0, 1)])],
                                 "number long, address string, accepted long, rejected long, open long")
    got = {r.address: r.score for r in address_scores(rows).collect()}
    assert -10 < got["a" * 40] < 0 and got["a" * 40] < got["ab"] and got[""] is None
