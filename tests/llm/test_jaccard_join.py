import random
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, docs, empty

from tillwright.llm import jaccard_join
from tillwright.llm.common import hashed_words
from tillwright.llm.components import components
from tillwright.llm.jaccard_join import near_duplicates, prefix_length, shingle_sets


def plain_sets(texts):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    return out


def plain_components(rows):
    sets, parent = plain_sets([t for _, t in rows]), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 90 * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root(i), []).append(d)
    return sorted(((d, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None))
                   for i, (d, _) in enumerate(rows)), key=str)


def test_hashed_words():
    texts = [None, b"", b" ", b"a A\tb\nab", "É é x".encode(), b"a"]
    values, counts = hashed_words(texts)
    words = [w for t in texts for w in (t or b"").lower().split()]
    assert counts.tolist() == [len((t or b"").split()) for t in texts]
    assert len(set(zip(words, values.tolist()))) == len(set(words)) == len(set(values.tolist()))


def test_sets_and_prefixes():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(80)]
    assert [len(s) for s in shingle_sets([t.encode() for t in texts])] == [len(s) for s in plain_sets(texts)]
    # two sets that reach the threshold share an element of their prefixes, in any common order
    for n in range(9, 60):
        drop = max(d for d in range(n) if 100 * (n - d) >= 90 * n)
        assert prefix_length(n) == drop + 1


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 10 ** 9)}"
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = [rng.choice(vocabulary) for _ in range(40)]
    rows = [*EDGES, (6, "two words"), (7, "TWO words")]
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([9, 10, 11, 30, 120, 300]))] + (common if base % 3 == 0 else [])
        chain = words
        for _ in range(rng.randint(1, 8)):
            rows.append((len(rows) + 100, " ".join(chain)))
            # copies of the base and chains of copies, around the threshold
            chain = edited(rng, chain if rng.random() < 0.5 else words, rng.randint(0, max(1, len(words) // 50)))
    rng.shuffle(rows)
    got = sorted(map(tuple, near_duplicates(docs(spark, rows)).collect()), key=str)
    assert got == plain_components(rows)


def test_large_group_is_not_paired(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
    rows = [(i, " ".join(edited(rng, base, i % 3))) for i in range(300)] + [(1000 + i, " ".join(base)) for i in range(50)]
    join = jaccard_join.JaccardJoin(docs(spark, rows))
    assert join.found.count() < 4 * len(rows)
    assert sorted(map(tuple, join.result().collect()), key=str) == plain_components(rows)


def test_empty_and_bad_threshold(spark):
    assert near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        near_duplicates(empty(spark), percent=50)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(40)] + [(500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in range(60):
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_parities_bound_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a = np.unique(rng.integers(0, 3000, rng.integers(1, 900))).astype(np.uint64)
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.95], rng.integers(0, 3000, 20).astype(np.uint64))))
        apart = sum(bin(int(x) & (2**64 - 1)).count("1") for x in jaccard_join._parities(a) ^ jaccard_join._parities(b))
        assert apart <= len(np.setxor1d(a, b))


def test_loads_beyond_16_bits_stay_the_largest():
    text = pa.array(["a b c " * 50_000] * 2, pa.string())
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    (found,) = jaccard_join._load_batches(3)(iter([batch, batch]))
    loads = np.concatenate([jaccard_join._unpacked(b, "<u2") for b in found.column(1).to_pylist()])
    assert sorted(loads[loads > 0]) == [65_535] * 3


def test_loads_take_two_bytes_a_bucket():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d"], pa.string())], names=["text"])
    hashed_words([b"a"])  # makes the powers, which stay
    tracemalloc.start()
    list(jaccard_join._load_batches(3)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
