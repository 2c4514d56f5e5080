import hashlib
from itertools import groupby

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tillwright.llm import chat_format
from tillwright.llm.chat_format import format_conversations, read_back, whole_conversations
from tillwright.llm.chat_template import (
    CLOSE, OPEN, TURNS, TURNS_CONSTANTS, TemplateError, compile_template, fold, guard, guard_line, parse, unguard)


def text_of(source, messages, constants=None):
    return "".join(t for t, _ in compile_template(source, constants)(messages))


def test_language():
    messages = [{"role": "user", "text": "Hi"}, {"role": "assistant", "text": "Yo"}]
    source = ("{% for m in messages %}{% if loop.first %}^{% elif m.role == 'assistant' and not loop.first %}A:{% else %}?"
              "{% endif %}{{ m.text|upper }}{% if not loop.last %}, {% endif %}{{ loop.index + 1 }}{% endfor %}")
    assert text_of(source, messages) == "^HI, 2A:YO3"
    assert text_of("{{ a.b }}{{ missing }}{{ ('x' in 'axb') }}{{ 'a' + 1 }}", [], {"a": {"b": 3}}) == "3Truea1"
    assert text_of("{{ m.__class__ }}{{ messages.append }}", []) == ""


@pytest.mark.parametrize("source", ["{% for m in x %}", "{% if a %}", "{{ a b }}", "{{ a|exec }}", "{% include x %}", "{{ f(1) }}",
                                    "{{ 'a }}", "{{ (a }}", "{{ }}"])
def test_errors(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_folding():
    tree = fold(parse("a{{ open }}{{ 'b' + 'c' }}{% if false %}x{% elif 1 == 1 %}d{% else %}e{% endif %}{{ v }}"), {"open": "<"})
    assert tree == [("text", "a<bcd"), ("out", ("name", "v"))]
    assert fold(parse("{% for open in xs %}{{ open }}{% endfor %}"), {"open": "<"})[0][3] == [("out", ("name", "open"))]
    assert ("text", "\n") not in fold(parse(TURNS), TURNS_CONSTANTS)[0][3][:1]


@given(st.lists(st.sampled_from(["\\", OPEN, CLOSE, "l", "n", "\n", "<", "x", "é"]), max_size=12).map("".join))
def test_guard_is_reversible(text):
    assert unguard(guard(text)) == unguard(guard_line(text)) == text
    assert OPEN not in guard(text) and CLOSE not in guard(text) and "\n" not in guard_line(text)


TRICKY = r"\### Assistant: </turn> ok"
ROWS = [(1, 1, "assistant", TRICKY), (1, 0, "user", TRICKY), (2, 0, "assistant", "a" * 50 + "\\" * 31), (2, 1, "assistant", None),
        (2, 1, "assistant", None), (3, None, None, "x"), (3, 0, "role\nwith line", CLOSE + "\n" + OPEN), (None, 0, "user", "q"),
        (4, 0, "user", ""), *[(5, i, ["user", "assistant"][i % 2], f"turn {i} \\ {CLOSE}") for i in range(40)]]


@pytest.mark.parametrize("piece", [7, 64 * 1024])
def test_read_back(spark, monkeypatch, piece):
    # pieces are cut in the tasks: the size goes along in the closure of a patched formatter
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "conv_id long, turn long, role string, text string, formatted string, piece int")

    def small(chunks):
        chat_format.PIECE_CHARS = piece
        return original(chunks)

    original = chat_format._pieces
    monkeypatch.setattr(chat_format, "_pieces", small)
    got = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, turns in groupby(order, key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got.pop(conv)
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(OPEN + CLOSE) + 2 + len(guard_line(a)) + len(guard(b)) for a, b in turns)
    assert not got


def test_whole_conversations_and_empty(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    r = {r.conv_id: r for r in whole_conversations(format_conversations(df)).collect()}[1]
    escaped = guard(TRICKY)
    assert r.formatted == f"{OPEN}user\n{escaped}{CLOSE}\n{OPEN}assistant\n{escaped}{CLOSE}\n"
    assert [r.formatted[s.start:s.stop] for s in r.trained] == [escaped]
    assert read_back(format_conversations(df.limit(0))).count() == 0
    with pytest.raises(TemplateError):
        format_conversations(df, "{% for %}")


def test_ids_of_text(spark):
    df = spark.createDataFrame([("a", 0, "user", "x"), ("b", 0, "user", "y"), (None, 0, "user", "z")], "conv_id string, turn long, role string, text string")
    assert {r.conv_id: r.n_turns for r in read_back(format_conversations(df)).collect()} == {"a": 1, "b": 1, None: 1}


def test_a_long_turn_is_read_in_proportion():
    """Pieces of one open turn are kept as they come: 400 pieces take about four times as long as 100."""
    import time

    def seconds(n):
        reader, piece = chat_format.TurnReader(), "a <tur" * 10_000
        start = time.perf_counter()
        reader.feed(OPEN + "user\n", [])
        for _ in range(n):
            reader.feed(piece, [])
        reader.feed(CLOSE[:3], [])
        reader.feed(CLOSE[3:] + "\n", [])
        assert reader.row()[0] == 1
        return time.perf_counter() - start
    seconds(50)
    assert seconds(1600) < 12 * seconds(400) + 0.05
