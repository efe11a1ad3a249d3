"""Matching of items against a reference, and the scores of it.

Similarity is that of difflib: it depends on the order of its arguments and
discounts popular characters of long texts, so no built-in function equals it.
Greedy matching is a sequential fold within a document; a document's items, a
handful, meet in one group and nothing else does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

TAGS = ("metric", "horizon", "level", "track", "credibility_scorable")


def similarity(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, a or "", b or "").ratio()


def similarity_above(a: str | None, b: str | None, floor: float) -> float:
    """The similarity if it is above `floor`, else 0: cheap upper bounds rule most pairs out before the full comparison."""
    if a == b:
        return 1.0 if floor < 1 else 0.0
    m = SequenceMatcher(None, a or "", b or "")
    if m.real_quick_ratio() <= floor or m.quick_ratio() <= floor:
        return 0.0
    s = m.ratio()
    return s if s > floor else 0.0


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def fold_groups(rows: DataFrame, keys: list[str], columns: list[str], fold: Callable[[list[dict]], Iterable[tuple]], out: dict[str, str]) -> DataFrame:
    """(keys, out): the tuples that fold(items) yields for each group, its items in the order of `columns`.

    A group is one row with an array, so many small groups share a batch on their way
    to Python. For groups that are small by nature: the items of a chunk, of a
    document, or of its metric and timeline.
    """
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("__items"))
    kinds = dict(packed.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"`{k}` {v}" for k, v in out.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, r) for i, items in enumerate(batch.column(len(keys)).to_pylist()) for r in fold(items)]
            take = pa.array([i for i, _ in found], pa.int64())
            made = [pa.array([r[j] for _, r in found], _ARROW[t]) for j, t in enumerate(out.values())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(len(keys))), *made], [*keys, *out])

    return packed.mapInArrow(run, schema)


def passage_similarity(a: Column, b: Column, lower: bool = False) -> Column:
    """difflib ratio of two texts, null as an empty text; texts that are equal never reach Python's matcher."""

    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([1.0 if p == q else similarity(p, q) for p, q in zip(x, y)], dtype="float64")

    prepare = (lambda c: F.lower(F.coalesce(c, F.lit("")))) if lower else (lambda c: F.coalesce(c, F.lit("")))
    return pandas_udf(ratio, "double")(prepare(a), prepare(b))


def greedy_pairs(reference: DataFrame, found: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """(doc, ref_ord, found_ord): each reference item in its order takes the first free item of the same metric and timeline whose value is within the tolerance.

    Both tables: doc, ord, metric, timeline, mid. A join yields the candidates of
    (doc, metric, timeline); only the choice among them is sequential.
    """
    r = reference.select("doc", "metric", "timeline", F.col("ord").alias("ref_ord"), F.col("mid").alias("ref_mid"))
    f = found.select(F.col("doc").alias("__d"), F.col("metric").alias("__m"), F.col("timeline").alias("__t"), F.col("ord").alias("found_ord"), F.col("mid").alias("found_mid"))
    from .values import within

    same = F.col("doc").eqNullSafe(F.col("__d")) & F.col("metric").eqNullSafe(F.col("__m")) & F.col("timeline").eqNullSafe(F.col("__t"))
    candidates = r.join(f, same).where(within(F.col("ref_mid"), F.col("found_mid"), tolerance))

    def choose(items: list[dict]) -> Iterator[tuple]:
        used: set = set()
        done = None
        for x in items:
            if x["ref_ord"] != done and x["found_ord"] not in used:
                used.add(x["found_ord"])
                done = x["ref_ord"]
                yield x["ref_ord"], x["found_ord"]

    t = dict(candidates.dtypes)
    chosen = fold_groups(candidates, ["doc", "metric", "timeline"], ["ref_ord", "found_ord"], choose, {"ref_ord": t["ref_ord"], "found_ord": t["found_ord"]})
    return chosen.select("doc", "ref_ord", "found_ord")


def two_pass_pairs(reference: DataFrame, found: DataFrame, tolerance: float = 0.15, least: float = 0.6) -> DataFrame:
    """(doc, ref_ord, found_ord, kind): strict matches (metric, a year in common, value within the tolerance) in order, then for the rest the most similar passage of at least `least`, the last among equals.

    Both tables: doc, ord, metric, lo, hi, years (array), passage.
    """
    columns = ["ord", "metric", "lo", "hi", "years", "passage"]

    def value_fits(x: dict, y: dict) -> bool:
        none = x["lo"] is None, y["lo"] is None
        if any(none):
            return all(none)
        m, n = (x["lo"] + x["hi"]) / 2, (y["lo"] + y["hi"]) / 2
        return n == 0 if m == 0 else abs(m - n) / m <= tolerance

    def match(items: list[dict]) -> Iterator[tuple]:
        ref, ex = ([x for x in items if x["side"] == s] for s in (0, 1))
        used, left = set(), []
        for x in ref:
            for j, y in enumerate(ex):
                if j not in used and (x["metric"] or "").strip() == (y["metric"] or "").strip() and set(x["years"]) & set(y["years"]) and value_fits(x, y):
                    used.add(j)
                    yield x["ord"], y["ord"], "strict"
                    break
            else:
                left.append(x)
        for x in left:
            best, score = None, least
            for j, y in enumerate(ex):
                if j not in used:
                    s = similarity_above((x["passage"] or "").lower(), (y["passage"] or "").lower(), score - 1e-9)
                    if s >= score:
                        best, score = j, s
            if best is not None:
                used.add(best)
                yield x["ord"], ex[best]["ord"], "soft"

    kind = dict(reference.dtypes)["ord"]
    both = reference.select("doc", F.lit(0).alias("side"), *columns).unionByName(found.select("doc", F.lit(1).alias("side"), *columns))
    return fold_groups(both, ["doc"], ["side", *columns], match, {"ref_ord": kind, "found_ord": kind, "kind": "string"})


def precision_recall(pairs: DataFrame, reference: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, reference_items, found_items, matched, recall, precision); 0 where there is nothing to divide by."""
    count = lambda t, name: t.groupBy("doc").agg(F.count("*").alias(name))
    rows = count(reference, "reference_items").join(count(found, "found_items"), "doc", "full").join(count(pairs, "matched"), "doc", "left")
    rows = rows.na.fill(0, ["reference_items", "found_items", "matched"])
    share = lambda n: F.coalesce(F.expr(f"try_divide(matched, {n})"), F.lit(0.0))
    return rows.withColumns({"recall": share("reference_items"), "precision": share("found_items")})


def tag_agreement(pairs: DataFrame, reference: DataFrame, found: DataFrame, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """(tag, agree, total) over matched pairs; two nulls agree. The tags become rows inside the JVM."""
    side = lambda t, s: t.select(F.col("doc").alias(f"__{s}doc"), F.col("ord").alias(f"__{s}ord"), *(F.trim(F.col(x).cast("string")).alias(f"__{s}_{x}") for x in tags))
    r, f = side(reference, "r"), side(found, "f")
    rows = pairs.join(r, (F.col("doc") == F.col("__rdoc")) & (F.col("ref_ord") == F.col("__rord"))).join(f, (F.col("doc") == F.col("__fdoc")) & (F.col("found_ord") == F.col("__ford")))
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(x).alias("tag"), F.col(f"__r_{x}").eqNullSafe(F.col(f"__f_{x}")).alias("same")) for x in tags))).alias("t"))
    return long.groupBy("t.tag").agg(F.count_if("t.same").alias("agree"), F.count("*").alias("total"))


def divergence(passage: Column, text: Column, anchor: int = 5, shown: int = 15) -> Column:
    """struct(at, expected, found): where a passage parts from a text, word by word after their first common run of `anchor` words.

    at: number of words before the first difference, -1 if the beginning isn't found;
    expected and found: the words from there on. A diagnostic for small results.
    """

    plain = str.maketrans({**dict(zip("‘’“”–—", "''\"\"--")), "…": "..."})

    def keys(t: str | None) -> list[str]:
        return (t or "").translate(plain).lower().split()

    def first_run(a: list[str], b: list[str]) -> int | None:
        """Where all of a begins in b."""
        i = -1
        try:
            while a:
                i = b.index(a[0], i + 1)
                if b[i : i + len(a)] == a:
                    return i
        except ValueError:
            pass
        return None

    def part(passage: str | None, text: str | None) -> tuple[int, str, str]:
        a, ka, kb = (passage or "").split(), keys(passage), keys(text)
        start = first_run(ka[:anchor], kb)
        if start is None:
            return -1, " ".join(a[:shown]), ""
        at = next((j for j, w in enumerate(ka) if start + j >= len(kb) or kb[start + j] != w), len(a))
        return at, " ".join(a[at : at + shown]), " ".join((text or "").split()[start + at : start + at + shown])

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in batches:
            yield pd.DataFrame([part(p, t) for p, t in zip(x, y)], columns=["at", "expected", "found"])

    return pandas_udf(run, "at int, expected string, found string")(passage, text)


def union_runs(items: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(chunk, ord, kept_as) of the items of two runs (chunk, run, ord, passage): an item of run 1 joins its most similar item if it is more than `threshold` similar, the longer passage standing for both."""

    def merge(group: list[dict]) -> Iterator[tuple]:
        places: list[list] = []
        for item in group:
            ord_, passage = item["ord"], item["passage"] or ""
            best, at = 0.0, None
            if item["run"]:
                for p in places:
                    s = similarity_above(passage, p[1], max(best, threshold))
                    if s > best:
                        best, at = s, p
            if at is not None and best > threshold:
                if len(passage) > len(at[1]):
                    at[0], at[1] = ord_, passage
                at[2].append(ord_)
            else:
                places.append([ord_, passage, [ord_]])
        for p in places:
            for m in p[2]:
                yield m, p[0]

    kind = dict(items.dtypes)["ord"]
    return fold_groups(items, ["chunk"], ["run", "ord", "passage"], merge, {"ord": kind, "kept_as": kind})


def anchors(part: Column, length: int = 80) -> Column:
    """The beginning of a part of a passage, by which it is looked up where its end was edited."""
    return F.substring(part, 1, length)


def containing_chunk(passages: DataFrame, chunks: DataFrame, anchor: int | None = None) -> DataFrame:
    """(doc, ord, chunk_no): for each passage the first chunk of its document that holds all its parts, null for none.

    anchor: a passage that no chunk holds whole is looked up by the first `anchor` characters of each part.
    passages: doc, ord, parts (array); chunks: doc, chunk_no, text. An equi-join on
    the document with the containment as its filter; partial minima before the shuffle.
    """
    p = passages.select("doc", "ord", "parts")
    c = chunks.select(F.col("doc").alias("__d"), "chunk_no", "text")
    holds = lambda part: F.forall("parts", lambda x: F.contains(F.col("text"), part(x)))
    found = holds(lambda x: x) if anchor is None else holds(lambda x: anchors(x, anchor))
    hits = p.join(c, F.col("doc") == F.col("__d")).where((F.size("parts") > 0) & found)
    whole = F.lit(True) if anchor is None else holds(lambda x: x)
    first = hits.groupBy(F.col("doc").alias("__d"), F.col("ord").alias("__o")).agg(F.coalesce(F.min(F.when(whole, F.col("chunk_no"))), F.min("chunk_no")).alias("chunk_no"))
    return p.join(first, (F.col("doc") == F.col("__d")) & (F.col("ord") == F.col("__o")), "left").select("doc", "ord", "chunk_no")


def _similar(a: Column, b: Column, floor: float) -> Column:
    """difflib ratio of two texts where it is above `floor`, else 0."""

    def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([similarity_above(p, q, floor) for p, q in zip(x, y)], dtype="float64")

    return pandas_udf(ratio, "double")(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def best_match(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, ord, found_ord, mode, score): the best of a document's extracted passages for each true one.

    Ladder: contained, contained without labels, similar above 0.65, similar above 0.85
    without labels; within a step the most similar, the first among equals. Only true
    passages that none contains, or is contained in, are compared by similarity, and
    pairs that bounds on it rule out are not compared in full.
    Both tables: doc, ord, text, bare (without labels).
    """
    f = found.select(F.col("doc").alias("__d"), F.col("ord").alias("found_ord"), F.col("text").alias("__text"), F.col("bare").alias("__bare"))
    both = truth.join(f, F.col("doc") == F.col("__d"))
    either = lambda a, b: F.contains(F.col(a), F.col(b)) | F.contains(F.col(b), F.col(a))
    held = both.withColumn("step", F.when(either("text", "__text"), 1).when(either("bare", "__bare"), 2))
    inside = held.where("step is not null").select("doc", "ord", "found_ord", "step", passage_similarity(F.col("text"), F.col("__text")).alias("score"))
    done = inside.select(F.col("doc").alias("__i"), F.col("ord").alias("__o")).distinct()
    rest = truth.join(done, (F.col("doc") == F.col("__i")) & (F.col("ord") == F.col("__o")), "left_anti").join(f, F.col("doc") == F.col("__d"))
    rest = rest.select("doc", "ord", "found_ord", "bare", "__bare", _similar(F.col("text"), F.col("__text"), 0.65).alias("score"), "text", "__text")
    near = rest.where("score > 0").select("doc", "ord", "found_ord", F.lit(3).alias("step"), "score")
    far = rest.where("score = 0").withColumn("bare_score", _similar(F.col("bare"), F.col("__bare"), 0.85)).where("bare_score > 0")
    far = far.select("doc", "ord", "found_ord", F.lit(4).alias("step"), passage_similarity(F.col("text"), F.col("__text")).alias("score"))
    pick = F.min_by(F.struct("found_ord", "step", "score"), F.struct("step", -F.col("score"), "found_ord"))
    best = inside.unionByName(near).unionByName(far).groupBy("doc", "ord").agg(pick.alias("m"))
    names = F.element_at(F.array(*map(F.lit, ("contained", "contained_bare", "similar", "similar_bare"))), F.col("m.step"))
    return best.select("doc", "ord", "m.found_ord", names.alias("mode"), "m.score")


def two_level_recall(best: DataFrame, pairs: DataFrame, reference: DataFrame, found: DataFrame, least: float = 0.85, tolerance: float = 0.10) -> DataFrame:
    """(doc, ord, passage_found, matched, reason): what became of each reference item.

    passage_found: its best passage (`best` of best_match) is contained or more than `least` similar;
    matched: it is in `pairs`, the full matches. reason of a miss: 'passage not found', else the first
    of metric, timeline and value in which the item of its best passage differs.
    """
    from .values import within

    tell = lambda t, s: t.select(F.col("doc").alias(f"__{s}d"), F.col("ord").alias(f"__{s}o"), *(F.col(c).alias(f"{s}_{c}") for c in ("metric", "timeline", "mid")))
    same = lambda d, o, s: (F.col(d) == F.col(f"__{s}d")) & F.col(o).eqNullSafe(F.col(f"__{s}o"))
    rows = reference.select("doc", "ord").join(tell(reference, "r"), same("doc", "ord", "r"))
    b = best.select(F.col("doc").alias("__bd"), F.col("ord").alias("__bo"), "found_ord", "mode", "score")
    rows = rows.join(b, (F.col("doc") == F.col("__bd")) & (F.col("ord") == F.col("__bo")), "left").join(tell(found, "f"), same("doc", "found_ord", "f"), "left")
    p = pairs.select(F.col("doc").alias("__pd"), F.col("ref_ord").alias("__po")).distinct()
    rows = rows.join(p, (F.col("doc") == F.col("__pd")) & (F.col("ord") == F.col("__po")), "left")
    got = F.coalesce(F.col("mode").startswith("contained") | (F.col("score") > least), F.lit(False))
    full = F.col("__po").isNotNull()
    differs = lambda c: ~F.col(f"r_{c}").eqNullSafe(F.col(f"f_{c}"))
    reason = F.when(full, F.lit(None).cast("string")).when(~got, "passage not found").when(differs("metric"), "metric mismatch").when(differs("timeline"), "timeline mismatch").when(~within(F.col("r_mid"), F.col("f_mid"), tolerance), "value mismatch").otherwise("taken by another")
    return rows.select("doc", "ord", got.alias("passage_found"), full.alias("matched"), reason.alias("reason"))


def recall_report(told: DataFrame, least: float = 0.70) -> DataFrame:
    """(doc, items, passage_recall, full_recall, gap, accepted) of two_level_recall; accepted: the recall of passages reaches `least`."""
    by = told.groupBy("doc").agg(F.count("*").alias("items"), F.avg(F.col("passage_found").cast("int")).alias("passage_recall"), F.avg(F.col("matched").cast("int")).alias("full_recall"), F.count_if(F.col("passage_found") & ~F.col("matched")).alias("gap"))
    return by.withColumn("accepted", F.col("passage_recall") >= least)
