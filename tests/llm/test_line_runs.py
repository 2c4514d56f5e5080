import random

import pytest
from helpers import EDGES, docs, empty

from tillwright.llm import line_runs
from tillwright.llm.line_runs import delete_repeated_runs, line_ranks, lines_of, numbered, suffix_ranks


def plain(rows, min_chars):
    """Kept texts: of every run of so many characters all but the first copy is deleted; runs are tried at any length."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        worded = [k for k, x in enumerate(lines) if x.strip(" \t")]
        gone = set()
        # a run that overlaps itself has its first copy at the lower line
        for s in range(len(worded)):
            for e in range(s + 1, len(worded) + 1):
                run = tuple(lines[k] for k in worded[s:e])
                if sum(map(len, run)) >= min_chars:
                    if run in seen:
                        gone |= set(worded[s:e])
                    seen.add(run)
        text = rows[i][1]
        out[i] = (rows[i][0], text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone),
                  len(worded) if text is not None else 0, len(gone))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,min_chars", [(1, 1), (2, 2), (3, 4), (4, 9), (5, 20)])
def test_against_all_runs(spark, seed, min_chars):
    rng = random.Random(seed)
    lines = ["a", "b", "c d", "", "  ", "a longer line"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(60 + i, "\n".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))) for i in range(12)]
    rows += [(100 + i, "all\nthe same\n\ntext\nhere\nonce") for i in range(20)] + [*EDGES, (None, "all\nthe same")]
    df = docs(spark, rows).coalesce(1)
    got = delete_repeated_runs(df, min_chars=min_chars)
    assert got.columns == [*df.columns, "_n_lines", "_n_deleted"]
    assert sorted(((r.doc_id, r.text, r._n_lines, r._n_deleted) for r in got.collect()), key=str) == plain(rows, min_chars)


def test_a_footer_between_lines_of_their_own(spark):
    rows = [(i, f"text {i} of its own\nAll rights reserved, 2024.\nmore {i} of it\n}}") for i in range(50)]
    got = delete_repeated_runs(docs(spark, rows)).collect()
    assert sum(r._n_deleted for r in got) == 49 and all("rights" not in r.text and r.text.endswith("}") for r in got if r.doc_id)


def test_a_hot_line(spark, monkeypatch):
    """An interval of many members meets its first in several tasks."""
    monkeypatch.setattr(line_runs, "SPREAD", 7)
    rows = [(i, f"own {i} line here now\nthe same line in all of them") for i in range(200)]
    assert sum(r._n_deleted for r in delete_repeated_runs(docs(spark, rows)).collect()) == 199


def test_names_that_are_taken(spark):
    df = docs(spark, [(1, "a line that occurs twice\na line that occurs twice")]).withColumnRenamed("n", "_n_lines").withColumnRenamed("score", "_row")
    r = delete_repeated_runs(df).first()
    assert (r._n_lines, r['__n_lines'], r._n_deleted, r._row) == (7, 2, 1, 0.5)


def test_suffix_ranks_are_in_suffix_order(spark):
    rows = [(1, "x\ny\nz\nx\ny"), (2, "y\nz\nx\ny\nz"), (3, "x\ny\nz")]
    ranks = line_ranks(lines_of(numbered(docs(spark, rows), "doc_id"), "text"))
    single = {(r._id, r._k): r._rank for r in ranks.collect()}
    texts = {i: t.split("\n") for i, t in rows}
    for n in (2, 3, 4, 8):
        got = {(r._id, r._k): r._rank for r in suffix_ranks(ranks, n).collect()}
        key = {(i, k): tuple(single[i, j] for j in range(k, k + n)) for i, t in texts.items() for k in range(len(t) - n + 1)}
        tied = {p: v for p, v in key.items() if list(key.values()).count(v) > 1}
        assert set(got) == set(tied)
        assert all((got[p] < got[q]) == (tied[p] < tied[q]) and (got[p] == got[q]) == (tied[p] == tied[q]) for p in got for q in got)


def test_empty(spark):
    assert delete_repeated_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        delete_repeated_runs(empty(spark), min_chars=0)
