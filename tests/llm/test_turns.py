"""Problem 1: labels, cleaning, and turns against a plain reading of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from parley.llm import turns

PEOPLE = [(1, "Ruvi Ophalvaro", "moderator"), (2, "Nori Mavaytova", "management"), (3, "Kelirsh Ishortova", "analyst"), (4, "Pelov Ishortova", "management")]


@pytest.mark.parametrize(
    "label,kind,ids",
    [
        ("Nori Mavaytova", "known", [2]), ("MAVAYTOVA, NORI", "known", [2]), ("[Nori Mavaytova] :", "known", [2]), ("Mr. Mavaytova", "known", [2]), ("N. Mavaytova", "known", [2]), ("Nori M.", "known", [2]),
        ("Nori Mavaytova – CEO", "known", [2]), ("Nori Mavaytova (Some Firm Limited)", "known", [2]), ("Nori Mavaytvoa", "known", [2]), ("NNori Mavaytova", "known", [2]), ("Nori Mavaytova 01:30:49", "known", [2]), ("Nori Mavaytova [34m47s]", "known", [2]),
        ("Operator", "known", [1]), ("Host:", "known", [1]), ("Ishortova", "known", [3, 4]), ("P Ishortova", "known", [4]),
        ("", "same", []), ("—", "same", []), ("(contd.)", "same", []), ("12:30", "same", []), ("Total Stranger", "unknown", []),
    ],
)
def test_labels(label, kind, ids):
    words = turns.label_words(label)
    k, _, got = turns.resolve([words], PEOPLE)[0] if words else ("same", "", [])
    assert (k, got) == (kind, ids)


def resolved(labels, people):
    return dict(zip(labels, turns.resolve([turns.label_words(x) for x in labels], people)))


def test_variants_reach_their_speaker_through_others():
    people = [(1, "Rajesh Krishnamurthy", "management"), (2, "Rakesh Iyer", "analyst")]
    labels = ["Rajesh Krishnamurty", "Rajish Krishnamuty", "R Krishnamurty", "R. Krishnamuty", "Rajish Krishnamut"]
    assert all(r == ("known", "Rajesh Krishnamurthy", [1]) for r in resolved(labels, people).values())
    assert resolved(["Rajish Krishnamuty"], people)["Rajish Krishnamuty"][0] == "unknown"
    # a variant between two people stays open between them, and joins neither
    two = [(1, "Ravi Sharma", "management"), (2, "Rani Sharma", "analyst")]
    assert [r[2] for r in resolved(["R Sharma", "Rabi Sharma", "Raxi Sharma"], two).values()] == [[1, 2], [1, 2], [1, 2]]


def test_index_meets_all_that_fit():
    rng = random.Random(4)
    names = [(f"{a}{b}", f"{c}{d}") for a in ("ra", "kali", "mo") for b in ("vish", "nder") for c in ("sharm", "ophalva", "iyeng") for d in ("a", "ro", "arkar")]
    labels = []
    for n in names:
        w = list(" ".join(n))
        for _ in range(2):
            k = rng.randrange(len(w) - 1)
            kind = rng.randrange(4)
            w[k : k + 2] = [[w[k + 1], w[k]], [w[k]], [w[k], "x", w[k + 1]], ["y", w[k + 1]]][kind]
        labels += [tuple("".join(w).split()), (n[0][0], n[1]), (n[0], n[1][0]), n[::-1], (n[1],), (n[1][1:],)]
    index = turns.Names()
    for i, n in enumerate(names):
        index.add(i, n)
    for w in filter(None, labels):
        assert {i for i, n in enumerate(names) if turns.fits_name(w, n)} <= index.same(w) and {i for i, n in enumerate(names) if turns.fits_spelling(w, n)} <= index.spelled(w)


def test_strangers_cluster():
    r = resolved(["Total Stranger", "T. Stranger", "Other Person"], PEOPLE)
    assert r["Total Stranger"][1] == r["T. Stranger"][1] != r["Other Person"][1]


CLEAN = [
    ("[00:05:26] We *coughs* grew (12:30) by um, 5%.", "We grew by 5%."),
    ("The line starts at 10:30 every morning (including exports).", "The line starts at 10:30 every morning (including exports)."),
    ("At , you know, this stage {music} we basically... sort of, wait <noise/> [ph] uh-huh here.", "At this stage we wait here."),
    ("01:22:05 - Thank you. ((line (12:33) breaks)) ♪", "Thank you."),
    ("What sort of margin do you know?", "What sort of margin do you know?"),
    ("<01:27:53.530> @05:23 [34m47s] Er, um.", "."),
    (f"Yes. [{'a long note ' * 30}] <{'b' * 90}> No.", "Yes. No."),
]


def test_cleaning(spark):
    df = spark.createDataFrame([(a,) for a, _ in CLEAN], "t string")
    got = [r[0] for r in df.select(turns.tidy(turns.without_marks(F.col("t")))).collect()]
    assert [g for g, (_, e) in zip(got, CLEAN) if e != "."] == [e for _, e in CLEAN if e != "."]


TURNS = "turn_id long, call_id long, char_start int, speaker string, role string, text string, block string, id string, said_by string"
PARTICIPANTS = "participant_id long, call_id long, name string, role string, text string"


def run(spark, rows, blocks):
    t = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)
    p = spark.createDataFrame([(i, 1, n, r, "extra") for i, n, r in PEOPLE], PARTICIPANTS)
    c = turns.clean_turns(t, p, blocks).orderBy("turn_no").collect()
    roles = {i: (n, r) for i, n, r in PEOPLE}
    assert all((r["speaker"], r["role"]) == roles[r["participant_id"]] for r in c if r["participant_id"] is not None)
    return [(r["first_turn_id"], r["last_turn_id"], r["participant_id"], r["text"]) for r in c]


ROWS = [
    (10, 1, 0, "Operator", "moderator", "Welcome."),
    (9, 1, 50, "Nori Mavaytova", None, "We grew."),
    (12, 1, 50, "NORI MAVAYTOVA", None, "We grew."),  # delivered twice
    (13, 1, 60, "Pelov Ishortova", "management", "Um, [ph] (inaudible)"),  # no speech: breaks nothing
    (14, 1, 70, "(contd.)", None, "And more."),
    (15, 1, 80, None, "analyst", "Still me. KELIRSH ISHORTOVA: My question. Why?"),
    (16, 1, 90, "", None, "Please."),
    (17, 1, 100, "Ishortova", "management", "Because."),
    (18, 1, 110, "Nobody Known", None, "Right? India - a country."),
    (19, 1, 120, "Host", None, None),
    (20, 1, None, "Host", None, "Late."),
]


@pytest.mark.parametrize("blocks", [1 << 20, 30, 1])
def test_turns(spark, blocks):
    assert run(spark, ROWS, blocks) == [
        (10, 10, 1, "Welcome."), (9, 15, 2, "We grew. And more. Still me."), (15, 16, 3, "My question. Why? Please."), (17, 17, 4, "Because."), (18, 18, None, "Right? India - a country."), (20, 20, 1, "Late."),
    ]


def test_nothing_and_very_long(spark):
    t = spark.createDataFrame([], TURNS)
    p = spark.createDataFrame([], PARTICIPANTS)
    assert turns.clean_turns(t, p).count() == 0
    long = "word um, " * 100_000
    got = run(spark, [(1, 1, 0, "Nori Mavaytova", None, long), (2, 1, 5, None, None, "end")], 1 << 20)
    assert got[0][:3] == (1, 2, 2) and " um" not in got[0][3]
