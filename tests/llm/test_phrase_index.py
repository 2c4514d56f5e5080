import random

import numpy as np
import pytest
from helpers import EDGES, docs, empty

from tillwright.llm.phrase_index import (
    FMIndex, PhraseSet, cut, find_phrases, items_digest, judged, phrases_of, search_shard, suffix_array, without_spans)


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(50):
        text = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_index_locates_all_occurrences():
    rng = random.Random(4)
    for _ in range(50):
        text = [rng.randint(1, 4) for _ in range(rng.randint(1, 80))]
        phrase = [rng.randint(1, 5) for _ in range(rng.randint(1, 4))]
        index = FMIndex(np.array(text))
        low, high = index.search(np.array([phrase]), np.array([len(phrase)]))
        found = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
        assert found == [i for i in range(len(text)) if text[i:i + len(phrase)] == phrase]


def test_shards_against_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        known = [b"a", b"b", b"c", b"dd"][:rng.randint(1, 4)]
        texts = [b" ".join(rng.choice([*known, b"x"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        phrases = list({(b" ".join(rng.choice(known) for _ in range(rng.randint(1, 4))), str(rng.randint(0, 3)))
                        for _ in range(rng.randint(0, 6))})
        for text, (n, spans, items) in zip(texts, search_shard(texts, PhraseSet(phrases))):
            words, hit, want = text.split(), set(), set()
            for phrase, item in phrases:
                p = phrase.split()
                for k in range(len(words) - len(p) + 1):
                    if words[k:k + len(p)] == p:
                        hit |= set(range(k, k + len(p)))
                        want.add(item)
            assert (n, items) == (len(words), sorted(want))
            assert hit == {x for a, b in spans for x in range(a, b)}


ITEM = " ".join(f"w{i}" for i in range(20))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_operator(spark, block):
    benchmark = spark.createDataFrame([(2, ITEM), (10, "Short, item"), (3, None), (None, "alpha beta"), (4, "..."), (2, ITEM)],
                                      "item_id long, text string")
    rows = [*EDGES, (7, "start " + ITEM.upper() + " end"), (8, "A SHORT-ITEM here, alpha beta"), (9, " ".join(ITEM.split()[:12]))]
    found = judged(find_phrases(docs(spark, rows), phrases_of(benchmark), block=block))
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    assert (got[7].n_words, got[7].n_hit, got[7].n_items, got[7].contaminated) == (22, 20, 1, True)
    assert [tuple(s) for s in got[7].spans] == [(1, 21)] and got[7].items_sha256 == items_digest(["2"])
    # the item without an id hits its words and is not in the list
    assert (got[8].n_hit, got[8].n_items, got[8].items_sha256) == (4, 1, items_digest(["10"]))
    assert all((got[i].n_hit, got[i].contaminated) == (0, False) for i in (None, 1, 2, 3, 4, 5, 9))
    texts = {r.doc_id: r.text for r in without_spans(found).collect()}
    assert texts[7] == "start  end" and texts[8] == "A  here, " and texts[1] is None


def test_empty_tables(spark):
    none = phrases_of(spark.createDataFrame([], "item_id long, text string"))
    assert judged(find_phrases(docs(spark, EDGES), none)).where("contaminated").count() == 0
    assert find_phrases(empty(spark), none).count() == 0


def test_cut_keeps_what_is_outside():
    assert cut("Ab-cd, éf gh!", [(1, 3)]) == "Ab- gh!" and cut("a b", []) == "a b"
