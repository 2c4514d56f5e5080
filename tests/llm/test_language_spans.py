import itertools

import numpy as np
from helpers import EDGES, docs, empty

from tillwright.llm.language_spans import Labeller, Model, fit, identify, scripts_of, viterbi, words_of

EN = "the cat and the dog went with their friends through that old garden when night came"
DE = "der hund und die katze gingen durch den alten garten als schon nacht wurde und schliefen"
RU = "кошка и собака гуляли по старому саду когда наступила ночь и все спали"


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 3, 5, 1, 4])
    scores = rng.normal(size=(int(lengths.sum()), 3)).astype(np.float32)
    labels = viterbi(scores, lengths, 0.7)
    start = 0
    for n, got in zip(lengths, labels):
        part = scores[start:start + n]
        value = lambda p: sum(part[i, a] for i, a in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert len(got) == n and abs(value(best) - value(got.tolist())) < 1e-5
        start += n


def test_scripts():
    from tillwright.llm.language_spans import _NAMES
    assert [_NAMES[i] for i in scripts_of(["abc", "кот", "猫", "ねこ", "ελ", "éa"])] == ["latin", "cyrillic", "han", "kana", "greek", "latin"]


def test_words_are_letters_and_their_marks():
    assert words_of("² ½ ① x² 3rd_place") == ["x", "rd", "place"]
    assert words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"] and words_of("e\u0301te\u0301") == ["e\u0301te\u0301"] and words_of("\u0301 _") == []


def test_texts_without_a_letter(spark):
    model = fit(docs(spark, [(1, EN, "en"), (2, DE, "de")]))
    assert {r.lang_pred for r in identify(docs(spark, [(1, "² ½ ①"), (2, "\u0301"), (3, "12 _")]), model).collect()} == {"und"}


def test_fit_and_identify(spark):
    train = docs(spark, [(i, t, la) for i, (t, la) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 3)] + [(90, None, "en"), (91, EN, None)])
    model = fit(train)
    assert model.languages == ["de", "en", "ru"]
    mixed = f"{EN} {EN} {DE} {RU}"
    rows = [*EDGES, (10, EN), (11, DE), (12, RU.upper()), (13, mixed), (14, "123 ... !"), (15, f"{RU} cat")]
    got = {r.doc_id: r for r in identify(docs(spark, rows), model).collect()}
    assert [got[i].lang_pred for i in (10, 11, 12, 13, 15)] == ["en", "de", "ru", "en", "ru"]
    assert [s.lang for s in got[13].spans] == ["en", "de", "ru"]
    n = len(words_of(EN))
    assert [abs(s.start - want) <= 1 for s, want in zip(got[13].spans, (0, 2 * n, 2 * n + len(words_of(DE))))] == [True] * 3
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1, 2, 3, 14))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert identify(docs(spark, rows), model).count() == len(rows) and identify(empty(spark), model).count() == 0


def test_untrained(spark):
    model = fit(empty(spark))
    assert {r.lang_pred for r in identify(docs(spark, EDGES), model).collect()} == {"und"}


def test_forgetting_words_changes_nothing(monkeypatch):
    from tillwright.llm import language_spans
    rng = np.random.default_rng(2)
    model = Model(["a", "b"], rng.normal(size=(1 << 16, 2)).astype(np.float32), np.ones((len(language_spans._NAMES), 2), bool))
    texts = [" ".join(rng.choice(list(EN.split() + DE.split()), 8)) for _ in range(20)]
    whole = Labeller(model).label(texts)
    monkeypatch.setattr(language_spans, "KNOWN_WORDS", 5)
    labeller = Labeller(model)
    assert [labeller.label([t])[0] for t in texts] == whole
