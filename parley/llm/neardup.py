"""Problem 2 - groups of records that differ by small edits.

Method: BagMinHash. A record is a bag of words. The weight axis of each word is
discretised into the dyadic intervals [0,1), [1,2), [2,4), ... ; on each lies a
Poisson process whose points have a time, a register and a coordinate on the
interval, halved down to the single weight. A word of weight w owns the points
with a coordinate below w, and a register of the signature keeps the earliest
point of any word of the bag. Two bags agree in a register with a probability
equal to their weighted Jaccard similarity: an unbiased estimate.

The points of an interval come in the order of time, so the points beyond weight 1
are drawn only up to the largest register that the bag has so far. What a word and
weight give is kept by the worker where it recurs.

Signatures are cut into bands; records that agree in a whole band are candidates,
verified by the exact multiset overlap. Records are first hung on the smallest
record of a few bands (stars, linear in the rows); members of a large class found
so enter the pairing as one row for each band and class, and are compared one by
one only with records of other classes. So a family that holds a third of all
rows is never paired with itself. Components of the verified links are the groups.

Equal texts are first folded into one representative; only different texts are
compared, and the copies get their class back at the end.

Defined results: null in one text column counts as an empty text; a record without
words is alike to nothing and a class of its own. Rows with a null id are left out
of pairs and classes. Rows that share an id are one record, alike to whatever one
of its texts is alike to.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, discard, merge_join
from .graph import components

BANDS, ROWS = 64, 8
#: Bands whose stars are formed first.
STAR_BANDS = 8
#: Members up to which a class of the stars is paired row by row.
FAMILY = 32
#: Registers whose bits travel with a band; 0 switches the filter off.
SKETCH_BITS = 128
#: A word of a weight above 1 seen more often than that by a worker keeps its registers, one of weight 1 at once, up to _CACHE_LIMIT of both.
_RECURS, _CACHE_LIMIT = 2, 30_000
_CHUNK = 256
_WORDS = re.compile(r"[a-z0-9]+")


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, vectorised."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Registers:
    """Signatures of bags: for each register the time of the earliest point of the words' processes."""

    def __init__(self, registers: int) -> None:
        self.m = registers
        self.own = np.arange(registers, dtype=np.uint64)
        #: (word, weight) -> row of the table of its registers and of the hashes of its copies
        self.rows: dict[tuple[str, int], int] = {}
        self.table = np.empty((1024, registers), dtype=np.float32)
        self.hashes: list[list[int]] = []
        self.uses: Counter = Counter()

    @staticmethod
    def _times(bits: np.ndarray) -> np.ndarray:
        return -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0)

    def unit(self, word: str) -> np.ndarray:
        """Registers of a word of weight 1: the interval [0, 1) is owned whole, so only the earliest point of each register counts."""
        import xxhash

        return self._times(_mix(self.own + np.uint64(xxhash.xxh64_intdigest(word, 0)))).astype(np.float32)

    def lower(self, out: np.ndarray, word: str, weight: int) -> None:
        """Lower the registers `out` by the points of a word beyond weight 1, drawn up to the largest register."""
        import xxhash

        level, start, length, until = 1, 1, 1, float(out.max())
        while start < weight:
            seed = np.uint64(xxhash.xxh64_intdigest(word, level))
            n = int(self.m * length * until * 1.1) + 16
            while True:
                bits = _mix(np.arange(n, dtype=np.uint64) + seed)
                t = np.cumsum(self._times(bits) / (self.m * length))
                if t[-1] >= until:
                    break
                n *= 2
            t = t[: int(np.searchsorted(t, until, side="right"))]
            bits = _mix(bits[: len(t)])
            r = (((bits >> np.uint64(32)) * np.uint64(self.m)) >> np.uint64(32)).astype(np.int64)
            if weight < start + length:
                below = start + (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(length)) >> np.uint64(32)).astype(np.int64) < weight
                t, r = t[below], r[below]
            np.minimum.at(out, r, t.astype(np.float32))
            level, start, length, until = level + 1, 2 * start, 2 * length, float(out.max())

    def _row(self, word: str, weight: int) -> int:
        """A new row of the table for a word that is worth one, else -1."""
        key = word, weight
        if weight > 1:
            self.uses[key] += 1
            if self.uses[key] <= _RECURS:
                return -1
            del self.uses[key]
        if len(self.rows) >= _CACHE_LIMIT:
            return -1
        at = self.rows[key] = len(self.rows)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[at] = self.unit(word)
        self.lower(self.table[at], word, weight)
        self.hashes.append(copies_of(word, weight))
        return at

    def __call__(self, bags: list[Counter]) -> tuple[np.ndarray, list[list[int]]]:
        """Signatures (bags x registers) of bags of at least one word each, and the hashes of each bag's words with their copies."""
        if len(self.uses) > 20 * _CACHE_LIMIT:
            self.uses.clear()
        out = np.full((len(bags), self.m), np.inf, dtype=np.float32)
        every = []
        known = self.rows.get
        for own, bag in zip(out, bags):
            rows = [known(item, -1) for item in bag.items()]
            elements: list[int] = []
            rare = []
            if -1 in rows:
                for i, item in enumerate(bag.items()):
                    if rows[i] < 0:
                        rows[i] = self._row(*item)
                        if rows[i] < 0:
                            rare.append(item)
                            elements += copies_of(*item)
                rows = [at for at in rows if at >= 0]
            if rows:
                np.minimum.reduce(self.table.take(rows, axis=0), axis=0, out=own)
            for at in rows:
                elements += self.hashes[at]
            for word, _ in rare:
                np.minimum(own, self.unit(word), out=own)
            for word, weight in rare:
                self.lower(own, word, weight)
            every.append(elements)
        return out, every


def copies_of(word: str, weight: int) -> list[int]:
    """Hashes of (word, k) for each copy k of a word."""
    import xxhash

    return [xxhash.xxh64_intdigest(word, k) - (1 << 63) for k in range(weight)]


def signature(bag: Counter, registers: Registers) -> np.ndarray:
    """Registers of a bag of at least one word."""
    return registers([Counter(bag)])[0][0]


def bag_of(text: str) -> Counter:
    return Counter(_WORDS.findall(text))


def joined(*texts: Column) -> Column:
    """The texts in lower case, null as empty, with a space between."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(t, F.lit("")) for t in texts)))


def signatures(df: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, elements, s0, s1, bands) from (id, text): bag size, hashes of (word, k-th copy), sketch bits, band hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        registers = Registers(bands * rows)
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        powers = np.array([pow(0x100000001B3, k, 1 << 64) for k in range(rows)], dtype=np.uint64)
        for whole in batches:
            for at in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(at, _CHUNK)
                bags = [bag_of(t) for t in batch.column(1).to_pylist()]
                full = [i for i, b in enumerate(bags) if b]
                keys = np.zeros((len(full), bands), dtype=np.int64)
                sketch = np.zeros((len(bags), 2), dtype=np.int64)
                elements = [[] for _ in bags]
                if full:
                    own, hashes = registers([bags[i] for i in full])
                    for i, h in zip(full, hashes):
                        elements[i] = h
                    raw = _mix(own.view(np.uint32).astype(np.uint64))
                    keys = _mix((raw.reshape(-1, bands, rows) * powers).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                    bits = np.packbits((raw[:, :SKETCH_BITS] & np.uint64(1)).astype(np.uint8), axis=1)
                    sketch[full] = np.resize(bits.T, (16, len(full))).T.copy().view(np.int64) if bits.shape[1] else 0
                lengths = np.zeros(len(bags), dtype=np.int32)
                lengths[full] = bands
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([b.total() for b in bags], pa.int32()), pa.array(elements, pa.list_(pa.int64())), pa.array(sketch[:, 0]), pa.array(sketch[:, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))],
                    ["id", "n", "elements", "s0", "s1", "bands"],
                )

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "text").mapInArrow(sign, f"id {kind}, n int, elements array<bigint>, s0 bigint, s1 bigint, bands array<bigint>")


def verified(candidates: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """(u, v, similarity) of the candidates (u, v) whose exact multiset similarity reaches the threshold."""
    bags = signed.select("id", "elements")
    both = merge_join(candidates, bags.select(F.col("id").alias("u"), F.col("elements").alias("e_u")), "u")
    both = merge_join(both, bags.select(F.col("id").alias("v"), F.col("elements").alias("e_v")), "v")
    shared = F.size(F.array_intersect("e_u", "e_v"))  # an element is a word with the number of its copy: this is the multiset overlap
    both = both.withColumn("shared", shared).withColumn("union", F.size("e_u") + F.size("e_v") - F.col("shared"))
    return both.where(F.col("shared") >= F.lit(threshold) * F.col("union")).select("u", "v", (F.col("shared") / F.col("union")).alias("similarity"))


def stars(signed: DataFrame, bands: int = STAR_BANDS) -> DataFrame:
    """(u, v): each record with the smallest one of each of its first bands. Minima are pre-aggregated, so a hot band costs one row for each task."""
    flat = signed.where("n > 0").select(F.explode(F.slice("bands", 1, bands)).alias("band"), "id")
    least = flat.groupBy("band").agg(F.min("id").alias("v"), F.max("id").alias("most")).where("v < most").select("band", "v")
    return merge_join(flat, least, "band").where("id <> v").select(F.col("v").alias("u"), F.col("id").alias("v")).distinct()


def links(signed: DataFrame, classes: DataFrame, threshold: float, family: int = FAMILY) -> DataFrame:
    """(u, v) of all candidates, u < v, that share a band and belong to different classes so far.

    classes: (id, component) of the records that have a class with others.
    """
    size = classes.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("members")).where(F.col("members") > family)
    known = merge_join(classes, size, F.col("component") == F.col("c"), "left").select(F.col("id").alias("k_id"), "component", F.col("c").isNotNull().alias("large"))
    rows = merge_join(signed.where("n > 0").select("id", "n", "s0", "s1", "bands"), known, F.col("id") == F.col("k_id"), "left")
    rows = rows.select("id", "n", "s0", "s1", "bands", F.col("component").alias("class"), F.coalesce("large", F.lit(False)).alias("large"))
    flat = rows.where("not large").select(F.explode("bands").alias("band"), "class", "id", "n", "s0", "s1")  # class is null for a record that is alone so far
    inside = rows.where("large").select(F.explode("bands").alias("band"), "class", "id")
    side = lambda t, s: t.select("band", *(F.col(c).alias(f"{c}_{s}") for c in ("class", "id", "n", "s0", "s1")))
    near = F.lit(True)
    if SKETCH_BITS:
        # a true pair lies beyond with a chance of a few in a million
        spread = (SKETCH_BITS * (1 - threshold) / 2 * (1 - (1 - threshold) / 2)) ** 0.5
        apart = int(SKETCH_BITS * (1 - threshold) / 2 + 4.5 * spread)
        near = F.bit_count(F.col("s0_l").bitwiseXOR(F.col("s0_r"))) + F.bit_count(F.col("s1_l").bitwiseXOR(F.col("s1_r"))) <= apart
    near = near & (F.least("n_l", "n_r") >= F.lit(threshold) * F.greatest("n_l", "n_r"))
    apart_so_far = ~F.col("class_l").eqNullSafe(F.col("class_r"))
    pairs = merge_join(side(flat, "l"), side(flat, "r"), "band").where((F.col("id_l") < F.col("id_r")) & (F.col("class_l").isNull() | apart_so_far) & near).select("id_l", "id_r")
    # large classes: one row for each band, replaced by its members there where another class is met
    groups = inside.select("band", F.col("class").alias("class_l")).distinct()
    members = inside.select(F.col("band").alias("b"), F.col("class").alias("c"), "id")
    met = merge_join(groups, flat.select("band", F.col("class").alias("class_r"), F.col("id").alias("id_r")), "band").select("band", "class_l", "id_r").distinct()
    met = merge_join(met, members, (F.col("band") == F.col("b")) & (F.col("class_l") == F.col("c"))).select(F.col("id").alias("id_l"), "id_r")
    both = merge_join(groups, groups.select(F.col("band").alias("b"), F.col("class_l").alias("class_r")), (F.col("band") == F.col("b")) & (F.col("class_l") < F.col("class_r"))).select("band", "class_l", "class_r")
    both = merge_join(both, members, (F.col("band") == F.col("b")) & (F.col("class_l") == F.col("c"))).select("band", "class_r", F.col("id").alias("id_l"))
    both = merge_join(both, members, (F.col("band") == F.col("b")) & (F.col("class_r") == F.col("c"))).select("id_l", F.col("id").alias("id_r"))
    pairs = pairs.unionByName(met).unionByName(both)
    return pairs.select(F.least("id_l", "id_r").alias("u"), F.greatest("id_l", "id_r").alias("v")).distinct()


def classes(df: DataFrame, key: str, texts: list[str], threshold: float = 0.75, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, class_id): one row for each record; class_id is the smallest id of its group."""
    text = joined(*(F.col(c) for c in texts))
    every = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), text.alias("text"))
    worded = F.col("text").rlike("[a-z0-9]")
    records = every.where(worded).withColumns({"h0": F.xxhash64("text"), "h1": F.xxhash64(F.lit("2"), "text")})
    representatives = records.groupBy("h0", "h1").agg(F.min("id").alias("id"), F.min("text").alias("text"))
    signed = cut(signatures(representatives, bands, rows))
    starred = cut(verified(stars(signed, min(STAR_BANDS, bands)), signed, threshold).select("u", "v"))
    first = components(starred)
    more = cut(verified(links(signed, first, threshold), signed, threshold).select("u", "v"))
    group = components(first.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more))
    for done in (signed, starred, more):
        discard(done)
    copied = records.groupBy("h0", "h1").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").select("h0", "h1", "rep")
    members = merge_join(records.select("id", "h0", "h1"), copied, ["h0", "h1"], "left").select("id", F.coalesce("rep", "id").alias("rep"))
    members = members.unionByName(every.where(~worded).select("id", F.col("id").alias("rep")))
    out = merge_join(members, group.select(F.col("id").alias("g_id"), "component"), F.col("rep") == F.col("g_id"), "left")
    return out.select(F.col("id").alias(key), F.coalesce("component", "rep").alias("class_id"))


def pairs(classed: DataFrame, key: str) -> DataFrame:
    """(a, b) with a < b: all pairs of records of one class."""
    l = classed.select(F.col(key).alias("a"), "class_id")  # noqa: E741
    r = classed.select(F.col(key).alias("b"), F.col("class_id").alias("class_b"))
    return merge_join(l, r, (F.col("class_id") == F.col("class_b")) & (F.col("a") < F.col("b"))).select("a", "b")
