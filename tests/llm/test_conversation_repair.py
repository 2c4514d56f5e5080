import hashlib
import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm.conversation_repair import Repair, Spool, damage, repair_edits, repair_reports, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
SOUND = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired rows) over every way to edit: up to two insertions of either role anywhere."""
    gaps = [g for n in range(3) for g in itertools.product(("user", "assistant"), repeat=n)]
    ways = []
    for (role, text), fault in zip(rows, faults_of(rows)):
        own = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            own += [(e, c + (fault == "truncated"), (r, text)) for e, c, r in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant"))]
        ways.append([("I" * len(g) + e, 2 * len(g) + c, [*[(r, "") for r in g], *([row] if row else [])])
                     for g in gaps for e, c, row in own])
    ways.append([("I" * len(g), 2 * len(g), [(r, "") for r in g]) for g in gaps])
    best = None
    for path in itertools.product(*ways):
        out = [r for p in path for r in p[2]]
        if all(r[:1] for r, _ in out) and SOUND.fullmatch("".join(r[:1] for r, _ in out)):
            found = (sum(p[1] for p in path), "".join(p[0] for p in path), out)
            best = min(best or found, found, key=lambda f: f[:2])
    return best


ROWS = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "strict"]), st.sampled_from(["Yes.", "no", " ", "", "what?\n"]))


@settings(deadline=None, max_examples=60)
@given(st.lists(ROWS, max_size=3))
def test_cheapest_edits_against_all(rows):
    repair = Repair()
    for at, ((role, text), fault) in enumerate(zip(rows, faults_of(rows))):
        repair.feed(at, role, text, fault == "duplicate")
    edits = list(repair.edits())
    cost, audit, out = brute(rows)
    assert (repair.cost, "".join(e for e, _, _ in edits)) == (cost, audit)
    assert [(r, t) for e, r, t in edits if e != "D"] == out


@given(st.lists(ROWS, max_size=60), st.sampled_from([1, 40, 1 << 20]))
def test_spilled_pointers_change_nothing(rows, spool_bytes):
    def run(size):
        repair = Repair(size)
        for at, (role, text) in enumerate(rows):
            repair.feed(at, role, text, False)
        return repair.cost, list(repair.edits())
    assert run(spool_bytes) == run(1 << 24)


def test_spool():
    spool = Spool(4)
    for block in (b"abc", b"", b"defgh", b"i"):
        spool.add(block)
    assert list(spool.blocks()) == [b"abc", b"", b"defgh", b"i"]
    assert list(spool.blocks(backwards=True)) == [b"i", b"defgh", b"", b"abc"]
    assert spool.file._rolled


CASES = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 5, "user", "Why?"),
    (2, None, "system", "Be short."), (2, 0, "user", "a."), (2, 0, "user", "a."), (2, 2, "assistant", "cut off"),
    (3, 0, None, None), (4, None, "user", "x" * 300_000 + "!"), (4, 0, "assistant", "ok."),
    (None, 1, "user", "q."), (None, 2, "assistant", "r."), (5, 3, "Tool", "out."),
]


def test_reports(spark):
    df = spark.createDataFrame([(*r, "x", 7, True) for r in CASES], SCHEMA + ", audit string, place long, seen boolean")
    got = {r.conv_id: r for r in repair_reports(df, spark.createDataFrame([(1,), (9,), (9,), (None,)], "conv_id long")).collect()}
    assert (got[1].gaps, got[1].cost, got[1].audit, got[1].illegal) == (3, 2, "KKKI", 0)
    assert got[1].repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes.\nuser:Why?\nassistant:").hexdigest()
    assert (got[2].gaps, got[2].duplicate, got[2].truncated, got[2].illegal, got[2].cost, got[2].audit) == (1, 1, 1, 1, 4, "KKDK")
    assert (got[3].blank, got[3].cost, got[3].audit, got[3].repaired_sha256) == (1, 3, "D", EMPTY)
    assert (got[4].gaps, got[4].cost, got[4].audit) == (0, 0, "KK")
    assert (got[None].cost, got[None].audit) == (0, "KK")
    assert (got[5].cost, got[5].audit, got[5].gaps) == (3, "D", 0)
    assert tuple(got[9])[1:] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert len(got) == 7


def test_edits_and_repaired_rows(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    edits = [(r.edit, r.role) for r in repair_edits(df).where("conv_id = 2").orderBy("place").collect()]
    assert edits == [("K", "system"), ("K", "user"), ("D", "user"), ("K", "assistant")]
    reports = {r.conv_id: r.repaired_sha256 for r in repair_reports(df).collect()}
    said = {}
    for r in repaired(df).orderBy("conv_id", "turn").collect():
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, digest in reports.items():
        assert hashlib.sha256("\n".join(said.get(conv, [])).encode()).hexdigest() == digest
    assert repair_reports(df.limit(0)).count() == repaired(df.limit(0)).count() == 0


def test_a_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(100)] + [(2, 0, "user", "a.")]
        got = {r.conv_id: r for r in repair_reports(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (got[1].audit, got[1].cost, got[1].gaps) == ("K" * 100, 0, 0)
    assert got[2].audit == "D" or got[2].cost == 2


def test_damage(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two!") for c in range(6) for t in range(12)] + [(None, None, None, None)]
    got = {}
    for r in damage(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: None, 1: [(role, "")], 2: [(role, text.translate({46: None, 33: None, 63: None}))],
                3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert got.get((c, t)) == want


@pytest.mark.parametrize("n", [200_000])
def test_a_giant_conversation_is_quick(n):
    repair = Repair(1 << 16)
    for i in range(n // 10):
        repair.feed(i, ("user", "assistant", "user")[i % 3], "Some words here.", False)
    assert sum(1 for e, _, _ in repair.edits() if e != "D") >= n // 20
