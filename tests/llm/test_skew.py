"""A third of all rows in one group: results stay whole."""

import random
from collections import Counter

from pyspark.sql import functions as F

from parley.llm import confusables, mixing, neardup, turns


def test_copies_of_one_record(spark):
    rng = random.Random(3)
    rows = [(i, "the same words said again and again in one text", "m") for i in range(0, 3000, 3)]
    rows += [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(30)), "m") for i in range(3000) if i % 3]
    df = spark.createDataFrame(rows, "item_id long, passage string, metric_description string")
    found = {r["item_id"]: r["class_id"] for r in neardup.classes(df, "item_id", ["passage", "metric_description"]).collect()}
    assert len(found) == 3000 and all(found[i] == 0 for i in range(0, 3000, 3))
    assert Counter(found.values())[0] == 1000


def test_copies_of_one_passage(spark):
    rows = [(i, "plan" if i % 3 else "рlаn" if i == 0 else "same") for i in range(900)]
    df = spark.createDataFrame(rows, "guidance_id long, passage string")
    got = {tuple(r) for r in confusables.lookalike_pairs(df, "guidance_id", "passage").collect()}
    assert got == {(0, i) for i in range(900) if i % 3}


def test_one_source_and_one_size(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 30).cast("string"))).alias("source"), F.lit(100).alias("n_tokens"))
    targets = spark.createDataFrame([("hot", 0.5, 1), ("s0", 0.5, 4)], "source string, target_share double, max_repeats int")
    report = {r["source"]: r for r in mixing.shares(mixing.copies(docs, targets, "doc_id"), targets).collect()}
    assert abs(report["hot"]["actual_share"] - 0.5) < 0.01 and report["s0"]["most_copies"] == 4


def test_one_long_call(spark):
    n = 3000
    who = ["Nori Mavaytova", "Kelirsh Ishortova", "(contd.)", None]
    rows = [(i, 1 if i % 3 == 0 else 10_000 + i, 10 * i, who[i // 3 % 4], None, "Some words here.") for i in range(n)]
    t = spark.createDataFrame(rows, "turn_id long, call_id long, char_start int, speaker string, role string, text string")
    p = spark.createDataFrame([(7, 1, who[0], "management"), (8, 1, who[1], "analyst")], "participant_id long, call_id long, name string, role string")
    hot = turns.clean_turns(t, p, 500).where("call_id = 1").orderBy("first_turn_id").collect()
    expected, last, speaker = [], None, None
    for i in range(0, n, 3):
        label = who[i // 3 % 4]
        speaker = {who[0]: 7, who[1]: 8}.get(label, speaker)
        if speaker == last:
            expected[-1][1] = i
        else:
            expected.append([i, i, speaker])
            last = speaker
    assert [[r["first_turn_id"], r["last_turn_id"], r["participant_id"]] for r in hot] == expected
