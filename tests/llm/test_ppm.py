import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EDGES, docs, empty

from tillwright.llm import ppm
from tillwright.llm.ppm import EDGE, ORDER, Model, Trie, grams_of, runs, score, tokens_of


def plain(training, order):
    """Counts of every context as dictionaries."""
    counts = defaultdict(Counter)
    for t in training:
        data = EDGE * order + t + EDGE
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k:i]][data[i]] += 1
    return counts


def plain_log10(counts, order, text):
    """Escape method D with exclusion, symbol by symbol."""
    data, total = EDGE * order + text + EDGE, 0.0
    for i in range(order, len(data)):
        excluded = set()
        for k in range(order, -1, -1):
            left = {s: n for s, n in counts.get(data[i - k:i], {}).items() if s not in excluded}
            seen = set(counts.get(data[i - k:i], {}))
            n = sum(left.values())
            if data[i] in left:
                total += math.log10((left[data[i]] - 0.5) / n)
                break
            if n:
                total += math.log10(len(left) / 2 / n)
            excluded |= seen
        else:
            total -= math.log10(256 - len(excluded))
    return total


def trie_of(training, order=ORDER):
    keys, n = runs(grams_of(training, order)[0])
    grams = []
    for k in range(order + 1):
        short, where = np.unique(keys >> np.uint64(8 * (order - k)), return_inverse=True)
        grams.append((short, np.bincount(where, n, len(short)).astype(np.int64)))
    return Trie(grams)


@pytest.mark.parametrize("order", [1, 3, ORDER])
def test_scores_against_plain_ppm(order):
    rng = random.Random(order)
    training = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 40))).encode() for _ in range(30)]
    trie, counts = trie_of(training, order), plain(training, order)
    for text in [b"", b"abcabc", "caé bz\n".encode(), *training[:5]]:
        keys, sizes = grams_of([text], order)
        assert sizes.tolist() == [len(text) + 1]
        assert trie.log10(keys).sum() == pytest.approx(plain_log10(counts, order, text), rel=1e-5)


@pytest.mark.parametrize("least", [1, 3])
def test_probabilities_sum_to_one(least):
    rng = random.Random(9)
    training = ["".join(rng.choice("abcd ") for _ in range(60)).encode() for _ in range(40)]
    keys, n = runs(grams_of(training)[0])
    grams = []
    for k in range(ORDER + 1):
        short, where = np.unique(keys >> np.uint64(8 * (ORDER - k)), return_inverse=True)
        times = np.bincount(where, n, len(short)).astype(np.int64)
        kept = times >= (least if k > 2 else 1)  # a pruned trie is still a distribution
        grams.append((short[kept], times[kept]))
    trie = Trie(grams)
    for key in grams_of([b"abcd zz a"])[0]:
        context = key & np.uint64((1 << 8 * ORDER) - 1)
        every = context | (np.arange(256, dtype=np.uint64) << np.uint64(8 * ORDER))
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1, abs=1e-5)


def test_untrained_trie_is_uniform():
    none = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * (ORDER + 1)
    assert Trie(none).log10(grams_of([b"ab"])[0]).tolist() == pytest.approx([-math.log10(256)] * 3)


def test_base_and_counts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [*EDGES, *[(i, " ".join(rng.choice(["The", "cat", "CAT", "x1", "é", "rare%d" % rng.randint(0, 40)]) for _ in range(20)))
                      for i in range(10, 40)]]
    train = [r for r in rows if r[0] is None or r[0] % 3]
    counts = Counter(t for _, text in train for t in [*tokens_of((text or "").encode()), b""])
    n, v = sum(counts.values()), len(counts)
    model = Model(docs(spark, train), frequent=4)  # nearly all tokens meet their counts in the join
    assert (model.n_tokens, model.n_distinct) == (n, v) and len(model.tokens[0]) <= 4
    got = score(docs(spark, rows), model).collect()
    assert len(got) == len(rows)
    texts = {i: (t or "").encode() for i, t in rows}
    plain_counts = plain([(t or "").encode() for _, t in train], ORDER)
    for r in got:
        tokens = [*tokens_of(texts[r.doc_id]), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
        assert r.score == pytest.approx(plain_log10(plain_counts, ORDER, texts[r.doc_id]), rel=1e-4)


def test_empty_tables(spark):
    model = Model(empty(spark))
    got = {r.doc_id: r for r in score(docs(spark, EDGES), model).collect()}
    assert got[2].score == pytest.approx(-math.log10(256)) and got[2].n_known == 0 and got[2].train_tokens == 0
    assert score(empty(spark), model).count() == 0
    with pytest.raises(ValueError):
        Model(empty(spark), order=2)


def test_limit_keeps_at_most():
    assert ppm._limit([(0, 10), (5, 3), (9, 2)], 5) == 5 and ppm._limit([(0, 10)], 10) == 0
    assert ppm._limit([(7, 10)], 9) > 7


def test_all_counted_grams_take_part(spark):
    rng = random.Random(11)
    train = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1500)) for _ in range(250)]  # rare grams, over 2^18 per order
    rows = [(i, t) for i, t in enumerate(train)]
    plain_counts = plain([t.encode() for t in train], ORDER)
    got = score(docs(spark, rows[:3] + [(900, train[5][:700] + train[9][:700])]), Model(docs(spark, rows))).collect()
    for r in got:
        text = train[r.doc_id] if r.doc_id < 900 else train[5][:700] + train[9][:700]
        assert r.score == pytest.approx(plain_log10(plain_counts, ORDER, text.encode()), rel=1e-4)


def test_buckets_give_the_scores_of_the_whole_trie(spark, monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 5)
    monkeypatch.setattr(ppm, "SCORED_BYTES", 100)
    rows = [(i, "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    model = Model(docs(spark, rows[:40]))
    assert model.buckets > ppm.LEAST_BUCKETS
    trie = trie_of([t.encode() for _, t in rows[:40]])
    got = {r.doc_id: r.score for r in score(docs(spark, rows), model).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(trie.log10(grams_of([t.encode()])[0]).sum(), rel=1e-5)


def test_packed_blocks():
    keys = np.unique(np.array([0, 1, 1 << 55, 77, 300], np.uint64))
    n = np.array([1, 254, 255, 256, 1 << 40])
    assert ppm.unpack_keys(ppm.pack_keys(keys)).tolist() == keys.tolist() and ppm.unpack_counts(ppm.pack_counts(n)).tolist() == n.tolist()
    assert ppm.unpack_values(ppm.pack_values(np.array([-0.5, -3.25]))).tolist() == [-0.5, -3.25]
    many = np.random.default_rng(1).normal(size=70_000).astype(np.float32)
    assert ppm.unpack_values(ppm.pack_values(many)).tolist() == many.tolist() and len(ppm.unpack_values(ppm.pack_values(many[:0]))) == 0
    assert ppm.unpack_texts(ppm.pack_texts([b"ab", None, b"", b"c" * 1000])) == [b"ab", b"", b"", b"c" * 1000]
    for pack, unpack in ((ppm.pack_keys, ppm.unpack_keys), (ppm.pack_counts, ppm.unpack_counts)):
        assert unpack(pack(keys[:0])).tolist() == []


def test_blocks_on_disk_are_small():
    rng = np.random.default_rng(3)
    # as a bucket answers: logarithms of few counts over totals, most of them more than once
    values = np.log10((rng.geometric(0.3, 20_000) - 0.5) / rng.integers(1, 4_000, 20_000)).astype(np.float32)
    block = ppm.pack_values(values)
    assert ppm.unpack_values(block).tolist() == values.tolist()
    assert len(block) < 2.9 * len(values)  # 3.4 bytes each as plain floats, compressed
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 10, 3_000)]
    texts = [" ".join(words[min(int(i), 2_999)] for i in rng.zipf(1.3, 200)).encode() for _ in range(300)]
    packed = ppm.pack_texts(texts)
    assert ppm.unpack_texts(packed) == texts and len(packed) < 0.95 * len(ppm.pa.compress(b"".join(texts), "zstd", asbytes=True))


def test_odd_values_come_back():
    values = np.array([0.0, -0.0, np.inf, -np.inf, np.nan, 1e-40, -3.5, -3.5], np.float32)
    assert ppm.unpack_values(ppm.pack_values(values)).tobytes() == values.tobytes()


def test_exchanged_blocks_go_before_the_rare_tokens(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(ppm, "released", lambda *tables: gone.extend(t.columns for t in tables))
    rows = docs(spark, [(1, "a b"), (2, "c")])
    assert score(rows, Model(rows)).count() == 2 and gone == [["chunk", "ids", "texts"]]
