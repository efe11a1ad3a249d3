"""Problem 8: the forward algorithm against enumeration, held-out accuracy, segments."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import langid
from parley.session import table


@pytest.fixture(scope="module")
def labelled(spark, small):
    return [(r["lang"], r["text"]) for r in table(spark, small, "lang_samples").orderBy("sample_id").collect()]


@pytest.fixture(scope="module")
def model(labelled):
    return langid.fit([(langid.state_of_sample(a, b), b) for a, b in labelled], langid.load_vocabulary())


def test_forward_sums_all_segmentations():
    table_ = {"▁": 0, "▁a": 1, "a": 2, "ab": 3, "b": 4, "▁ab": 5}
    p = np.random.default_rng(1).dirichlet(np.ones(6), len(langid.STATES)).T
    m = langid.PieceModel(table_, np.log(p), 3)

    def total(s, k):
        return 1.0 if not s else sum(p[table_[s[:n]], k] * total(s[n:], k) for n in range(1, min(3, len(s)) + 1) if s[:n] in table_)

    got = m.word("abab")
    assert np.allclose(got, [math.log(total("▁abab", k)) for k in range(len(langid.STATES))])


def test_held_out_accuracy(labelled):
    pieces = langid.load_vocabulary()
    right = n = 0
    for fold in range(4):
        m = langid.fit([(langid.state_of_sample(a, b), b) for i, (a, b) in enumerate(labelled) if i % 4 != fold], pieces)
        held = [x for i, x in enumerate(labelled) if i % 4 == fold]
        for change in (str, str.upper, lambda t: langid.unaccented(t)):
            got = langid.segments_of([change(t) for _, t in held], m)
            right += sum(len(g) == 1 and g[0][0] == a for g, (a, _) in zip(got, held))
            n += len(held)
    assert right / n >= 0.99


def test_segments(model):
    de = "Die Finanzleitung rechnet mit einer Marge zwischen 7 und 9 Prozent, obwohl die Rohstoffpreise weiter schwanken."
    en = "Our retail pump range should grow by 34% by March 2028. The line starts at 10:30 every morning and runs in two shifts."
    hi = "प्रबंधन का मानना है कि मार्जिन 22 से 26 प्रतिशत के बीच रहेगा।"
    latn = "Management ka maanna hai ki nayi line par kareeb 537 crore rupaye ka nivesh hoga."
    s = lambda t: [x[0] for x in langid.segments_of([t], model, langid.SWITCH)[0]]
    assert s(f"{de} {en}") == ["de", "en"] and s(f"{en}\n{hi} {latn}\n{en}") == ["en", "hi", "en"]
    assert s(f"Asha Pumps Limited (880109)\n\n{de}") == ["de"] and s(f"Ravi Mehta: {hi}\n\nASHA RAO : {hi}") == ["hi"]
    assert s(f"{en} »{de}« “{en}”") in (["en", "de", "en"], ["en", "de"]) and s("Asha Works Limited | Q2 FY26") == [] and s("1.5 | 2.5\n3.5 | 4.5") == []
    assert s("") == [] and langid.segments_of([None], model) == [[]] and s(de.replace("Marge", "(EBITDA margin)")) == ["de"]
    assert s((en + " ") * 2000 + de) == ["en", "de"]
    conf = langid.segments_of([de], model)[0][0][1]
    assert 0.9 < conf <= 1.0


def test_labels(spark):
    rows = [("EN", "en"), ("en-IN", "en"), ("hin", "hi"), ("German", "de"), ("pt_BR", "pt"), ("es-419", "es"), (" ", None), ("und", None), (None, None), ("unknown", None), ("xx", None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "l string")
    assert [r[0] for r in df.select(langid.canonical_label(F.col("l"))).collect()] == [b for _, b in rows]


def test_rows(spark, model):
    en, de = "Our retail pump range should grow by 34% by March 2028.", "Die Finanzleitung rechnet mit einer Marge zwischen 7 und 9 Prozent."
    rows = [(1, en, "en", 0), (1, en, "en", 0), (2, en, "de", 0), (3, f"{en} {de}", "eng", 0), (4, en, None, 0), (5, None, None, 0), (6, "", "x", 0), (None, de, "fr", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, segments int")
    found = langid.wrong_or_mixed(langid.segments(df, model))
    assert sorted(((r["doc_id"] or 0), r["seg_no"], r["lang"]) for r in found.collect()) == [(0, 1, "de"), (2, 1, "en"), (3, 1, "en"), (3, 2, "de"), (4, 1, "en")]
    assert langid.segments(df, model).where("doc_id = 1").count() == 2 and langid.segments(df.limit(0), model).count() == 0


def test_documents(spark, model):
    de, en = "Die Finanzleitung rechnet mit einer Marge zwischen 7 und 9 Prozent.", "Our range should grow."
    df = spark.createDataFrame([(1, f"{en} {de}"), (2, "Q2 FY26"), (3, None), (None, de)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang"], r["segments"]) for r in langid.documents_of(df, langid.segments(df, model, label=None)).collect()}
    assert got == {1: ("de", 2), 2: (None, 0), 3: (None, 0), None: ("de", 1)}


def test_sentences_without_end_marks():
    line = "unsere neue linie in jaipur soll ab april laufen"
    assert langid.units_of(line) == [line] and langid.units_of("Asha Works Limited Q2 FY26") == [] and langid.units_of("Asha Works", 2) == ["Asha Works"]
    assert langid.units_of("\n".join([line] * 3000)) == [line] * 3000


def test_confidence_is_calibrated(labelled):
    """Parts of held-out samples, from one word up: what is said with a confidence is right so often."""
    pieces = langid.load_vocabulary()
    said, right = [], []
    for fold in range(4):
        m = langid.fit([(langid.state_of_sample(a, b), b) for i, (a, b) in enumerate(labelled) if i % 4 != fold], pieces)
        for a, b in labelled[fold::4]:
            words = langid.words_of(b)
            parts = [" ".join(words[k : k + n]) + "." for n in (1, 2, 3, 5) for k in range(0, len(words) - n + 1, n)]
            for (lang, confidence, _), *_rest in langid.segments_of(parts, m):
                said.append(confidence)
                right.append(lang == a)
    said, right = np.array(said), np.array(right)
    bins = np.digitize(said, np.arange(0.2, 1, 0.1))
    error = sum(abs(said[bins == k].mean() - right[bins == k].mean()) * (bins == k).mean() for k in np.unique(bins))
    assert error < 0.03 and abs(said.mean() - right.mean()) < 0.02


def test_very_long_words(model):
    """Words are scored whole, however long."""
    a, b = (model.word("a" * 70 + end) for end in ("ung", "ção"))
    assert not np.allclose(a - a.max(), b - b.max())
