from collections import Counter

from helpers import EDGES, docs, empty
from hypothesis import given
from hypothesis import strategies as st

from tillwright.llm.quality_rules import BASE, CURRENT, POLICIES, RULES, ablations, failed_rules, ledger, measure, passes


@given(st.text(alphabet="ab é\n\t#|", max_size=60))
def test_measures(text):
    words = text.replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    times = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if times[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t")]
    got = measure(text.encode())
    assert got == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#|"), len(lines),
                   len(lines) - len(set(lines)), len(hit), max((len(w.encode()) for w in words), default=0))


def test_edges_and_policies(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = ledger(docs(spark, [*EDGES, (6, good), (7, good + " ###############")])).withColumns(
        {"base": passes(BASE), "current": passes(CURRENT), "failed": failed_rules()}).collect()
    assert len(rows) == 9
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].n_words == 3 and by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0
    assert not by_id[1].base and by_id[1].failed == ["too_few_words"]
    assert by_id[6].current and by_id[7].base and not by_id[7].current and by_id[7].failed == ["symbols"]
    assert ledger(empty(spark)).count() == 0 and ablations(ledger(empty(spark))).count() == 0


def test_ablations_count_what_a_rule_alone_rejects(spark):
    good = " ".join(f"word{i}" for i in range(60))
    found = ablations(ledger(docs(spark, [(1, good), (2, "#"), (3, good + " " + "#" * 20), (4, "few words")]))).collect()
    assert len(found) == sum(len(p.rules) for p in POLICIES)
    prose = {r.rule: r for r in found if (r.policy, r.version) == ("prose", 1)}
    assert {(r.n_docs, r.n_rejected) for r in prose.values()} == {(4, 3)}
    assert (prose["symbols"].n_failed_rule, prose["symbols"].n_rejected_by_it_alone) == (2, 1)
    assert (prose["too_few_words"].n_failed_rule, prose["too_few_words"].n_rejected_by_it_alone) == (2, 1)


def test_masks_are_positions_in_the_rules():
    assert CURRENT.mask == (1 << len(RULES)) - 1 and BASE.mask == 0b11
