"""Problem 2: signatures are unbiased, groups equal brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.llm import graph, neardup


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.mark.parametrize("seed", range(4))
def test_signature_estimates_weighted_jaccard(seed):
    rng = random.Random(seed)
    registers = neardup.Registers(4096)
    a = Counter({w: rng.randint(1, 9) for w in "abcdefgh"})
    b = +Counter({w: rng.randint(0, 9) for w in "cdefghij"})
    estimate = (neardup.signature(a, registers) == neardup.signature(b, registers)).mean()
    assert abs(estimate - jaccard(a, b)) < 0.035  # over four standard errors


@pytest.mark.parametrize("a,b", [({"y": 50_000}, {"y": 40_000, "z": 7}), ({"x": 3, "y": 1000}, {"x": 1, "y": 1000}), ({"one": 1}, {"one": 1, "two": 1})])
def test_large_weights(a, b):
    registers = neardup.Registers(4096)
    a, b = Counter(a), Counter(b)
    assert abs((neardup.signature(a, registers) == neardup.signature(b, registers)).mean() - jaccard(a, b)) < 0.035


def test_words_that_recur_give_the_same_registers():
    used = neardup.Registers(512)
    bags = [Counter({f"w{i % 7}": i % 3 + 1, "all": 2, f"only{i}": 1}) for i in range(80)]
    assert all((fresh_ == used_).all() for fresh_, used_ in zip((neardup.signature(b, neardup.Registers(512)) for b in bags), used(bags)[0]))
    assert len(used.rows) > 80


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    while len(out) < n:
        base = [rng.choice(words) for _ in range(rng.randint(30, 60))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            t = list(base)
            for _ in range(rng.randint(1, 12)):
                k = rng.randrange(len(t))
                if rng.random() < 0.4:
                    t[k] = rng.choice(words)
                elif rng.random() < 0.5:
                    t.insert(k, rng.choice(words))
                else:
                    t.append(t.pop(k))
            out.append(" ".join(t))
    return out[:n]


def brute(rows, threshold=0.75):
    bags = [(i, Counter(t.split())) for i, t in rows]
    up = {i: i for i, _ in bags}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(bags):
        for j, b in bags[:n]:
            if a and b and jaccard(a, b) >= threshold or a == b:
                up[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, _ in bags:
        groups.setdefault(find(i), []).append(i)
    return {(a, b) for g in groups.values() for a in g for b in g if a < b}


def test_groups_equal_brute_force(spark):
    rows = list(enumerate(texts(300, 1)))
    df = spark.createDataFrame([(i, t, None, "clash", 0) for i, t in rows], "item_id long, passage string, metric_description string, text string, n int")
    found = neardup.pairs(neardup.classes(df, "item_id", ["passage", "metric_description"]), "item_id")
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_case_nulls_copies_and_empty(spark):
    rows = [(1, "One two three four five", "x"), (2, "five FOUR three two one", "X"), (3, None, None), (4, "", "!?"), (5, "lone words here", None), (None, "One two three four five", "x"), (7, "y " * 50_000, None), (8, "y " * 50_000, "y")]
    df = spark.createDataFrame(rows, "item_id long, passage string, metric_description string")
    got = {(r["item_id"], r["class_id"]) for r in neardup.classes(df, "item_id", ["passage", "metric_description"]).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (7, 7), (8, 7)}
    assert neardup.classes(df.limit(0), "item_id", ["passage", "metric_description"]).count() == 0


def test_a_large_family_and_its_neighbours(spark):
    """Members of a large class are compared with the records of other classes, and so join them."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(40)]
    family = [(i, " ".join([*base[: 40 - i % 3], f"x{i}"])) for i in range(0, 120)]
    far = [(1000 + i, " ".join([*base[: 29 + i % 4], *(f"y{i}q{k}" for k in range(rng.randint(6, 10)))])) for i in range(40)]
    rows = family + far + [(2000 + i, t) for i, t in enumerate(texts(60, 3))]
    df = spark.createDataFrame([(i, t, None) for i, t in rows], "item_id long, passage string, metric_description string")
    signed = neardup.signatures(df.select(F.col("item_id").alias("id"), F.col("passage").alias("text")))
    first = graph.components(neardup.verified(neardup.stars(signed), signed, 0.75))
    assert first.groupBy("component").count().where(F.col("count") > neardup.FAMILY).count() == 1
    found = {tuple(r) for r in neardup.pairs(neardup.classes(df, "item_id", ["passage", "metric_description"]), "item_id").collect()}
    assert found == brute(rows)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(300)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["id"]: r["component"] for r in graph.components(df).collect()}
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            up[b] = a
    assert got == {x: find(x) for x in up}
    assert graph.components(df.limit(0)).count() == 0
