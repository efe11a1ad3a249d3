"""Problem 6 - filling containers of fixed capacity.

Method: exact-complement hashing. What matters of an item is its length, so the
plan is made on the histogram of lengths, at most `capacity` entries whatever
the number of items. For each length above half the capacity, from the longest,
the gap it leaves is looked up among the lengths, then the sums of pairs, then
the sums of triples; a combination that fills the gap exactly is consumed as often
as the counts allow. Smaller items fill each other in the same way as far as they
aren't needed beside large ones. What remains is packed best-fit, again in bulk.

The plan says, for each length, which item numbers go to which containers. Items
are numbered within their length by two levels (a salted block and a prefix sum
over the blocks), so a length that holds a third of all items is no hot task.

An item larger than the capacity fills containers of its own and leaves its
remainder as an item; no other item is divided.

Defined results: items of length 0, null or below need no space: they get container 0
with no length. An empty input gives no rows. Ties go by key; repeated keys are
items of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import merge_join

BLOCKS = 64


class Plan:
    """Runs of containers: pattern (lengths with multiplicity) and how many containers have it."""

    def __init__(self) -> None:
        self.runs: list[tuple[tuple[int, ...], int]] = []

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        if times:
            self.runs.append((lengths, times))


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Pack `counts[length]` items of each length 1..capacity."""
    c = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        c[length] += n
    plan = Plan()
    plan.add((capacity,), int(c[capacity]))
    c[capacity] = 0

    budget = sum(counts.values())  # containers that exact combinations may still fill

    def take(*lengths: int) -> bool:
        """Use the combination as often as possible."""
        nonlocal budget
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        times = min(budget, *(int(c[x]) // k for x, k in need.items()))
        if times:
            budget -= times
            for x, k in need.items():
                c[x] -= times * k
            plan.add(lengths, times)
        return times > 0

    def singles(length: int) -> None:
        if c[length]:
            take(length, capacity - length)

    def pairs(length: int) -> None:
        """x + y = gap, the larger first."""
        gap = capacity - length
        while c[length]:
            x = np.arange((gap + 1) // 2, gap)
            ok = x[(c[x] > 0) & (c[gap - x] > 0)]
            if not any(take(length, int(v), int(gap - v)) for v in ok[::-1]):
                break

    def triples(length: int) -> None:
        """x + y + z = gap, x the largest: the pair sums are looked up for each x."""
        gap = capacity - length
        for x in range(gap - 2, (gap + 2) // 3 - 1, -1):
            if not c[length]:
                break
            if c[x]:
                rest = gap - x
                y = np.arange((rest + 1) // 2, min(rest - 1, x) + 1)
                ok = y[(c[y] > 0) & (c[rest - y] > 0)]
                for v in ok[::-1].tolist():
                    if not c[length] or not c[x]:
                        break
                    take(length, x, v, rest - v)

    # Fewer parts first: large items that have a single complement don't use up the small ones.
    half = capacity // 2
    for fill in (singles, pairs, triples):
        for length in range(capacity - 1, half, -1):
            fill(length)
    # Small items fill each other only as far as they aren't needed beside the large ones that are left.
    at = np.arange(capacity + 1)
    beside = int((c[half + 1 :] * (capacity - at[half + 1 :])).sum())
    budget = max(0, int((c[: half + 1] * at[: half + 1]).sum()) - beside) // capacity
    for fill in (singles, pairs, triples):
        for length in range(half, 0, -1):
            if budget:
                fill(length)
    # best fit of the rest, longest first: open containers are kept as (free space -> pattern -> how many)
    space: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    open_at = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        while c[length]:
            fits = np.flatnonzero(open_at[length:])
            if len(fits):
                free = int(fits[0]) + length
                pattern, n = next(iter(space[free].items()))
                times = min(n, int(c[length]))
                if n == times:
                    del space[free][pattern]
                    open_at[free] = bool(space[free])
                else:
                    space[free][pattern] = n - times
                left, grown = free - length, (*pattern, length)
            else:
                each = capacity // length  # new containers, filled with this length alone as far as it goes
                times = int(c[length]) // each
                if not times:
                    each, times = int(c[length]), 1
                left, grown = capacity - each * length, (length,) * each
                c[length] -= times * (each - 1)
            c[length] -= times
            space[left][grown] += times
            open_at[left] = True
    for patterns in space.values():
        for pattern, n in patterns.items():
            plan.add(pattern, n)
    return plan


def slots(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first item number, first container and number of containers of each run of slots."""
    out: dict[int, list[tuple[int, int]]] = defaultdict(list)
    container = 1
    for lengths, times in plan.runs:
        for x in lengths:
            out[x].append((container, times))
        container += times
    made = {}
    for x, runs in out.items():
        n = np.array([t for _, t in runs], dtype=np.int64)
        made[x] = (np.concatenate([[0], np.cumsum(n)[:-1]]), np.array([a for a, _ in runs], dtype=np.int64), n)
    return made


def numbered(df: DataFrame, group: str, order: list[str], blocks: int = BLOCKS) -> DataFrame:
    """`item_no` from 0 within each group (not null), without a task that holds a whole group.

    Rows are numbered within (group, block), a block being a hash of the order
    columns; the few block sizes are summed up over the blocks and joined back.
    """
    rows = df.withColumn("__block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    within = F.row_number().over(Window.partitionBy(group, "__block").orderBy(*order)) - 1
    sizes = rows.groupBy(F.col(group).alias("__group"), F.col("__block").alias("__b")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__group").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    joined = merge_join(rows.withColumn("__within", within), offsets, (F.col(group) == F.col("__group")) & (F.col("__block") == F.col("__b")))
    return joined.withColumn("item_no", F.col("__within") + F.col("__before")).drop("__block", "__within", "__group", "__b", "__before")


def pack(df: DataFrame, key: str, length: str, capacity: int) -> DataFrame:
    """(key, part_no, length, container) of every item.

    The histogram that comes to the driver has at most `capacity` rows. An item
    over the capacity has one row for each container it fills and one for its
    remainder; their part_no counts from 1, part_no of an undivided item is 0.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    n = F.greatest(F.coalesce(F.col(length).cast("bigint"), F.lit(0)), F.lit(0))
    items = df.select(F.col(key).alias("item"), n.alias("n"))
    items = items.withColumn("full", F.when(F.col("n") > capacity, F.expr(f"n div {capacity}")).otherwise(F.lit(0)))
    items = items.withColumn("rest", F.col("n") - F.col("full") * capacity)
    histogram = {r["rest"]: r["c"] for r in items.where("rest > 0").groupBy("rest").agg(F.count("*").alias("c")).collect()}
    plan = make_plan(histogram, capacity)
    table = slots(plan)
    used = sum(t for _, t in plan.runs)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(table)  # bounded by the capacity

    small = numbered(items.where("rest > 0"), "rest", ["item"])
    kind = small.schema["item"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots_of = shared.value
        for batch in batches:
            rest, no = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 3))
            at = np.empty(len(rest), dtype=np.int64)
            for x in np.unique(rest).tolist():
                mine = rest == x
                first, container, _ = slots_of[x]
                run = np.searchsorted(first, no[mine], side="right") - 1
                at[mine] = container[run] + no[mine] - first[run]
            part = pa.array(np.where(batch.column(2).to_numpy(zero_copy_only=False) > 0, batch.column(2).to_numpy(zero_copy_only=False) + 1, 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), part, batch.column(1), pa.array(at)], ["item", "part_no", "length", "container"])

    placed = small.select("item", "rest", "full", "item_no").mapInArrow(place, f"item {kind}, part_no bigint, length bigint, container bigint")
    # whole containers of items over the capacity follow the planned ones
    over = items.where("full > 0").withColumn("one", F.lit(1))
    total = Window.partitionBy("block").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    over = over.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(BLOCKS * 16)).cast("int"))
    sums = over.groupBy("block").agg(F.sum("full").alias("s"))
    blocks = sums.withColumn("before", F.coalesce(F.sum("s").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("block", "before")
    over = over.withColumn("within", F.coalesce(F.sum("full").over(total), F.lit(0))).join(blocks, "block")
    whole = over.select("item", F.posexplode(F.sequence(F.lit(1).cast("bigint"), F.col("full"))).alias("p", "part_no"), (F.col("within") + F.col("before") + used).alias("base"))
    whole = whole.select("item", "part_no", F.lit(capacity).cast("bigint").alias("length"), (F.col("base") + F.col("part_no")).alias("container"))
    none = items.where("n = 0").select("item", F.lit(0).cast("bigint").alias("part_no"), F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("container"))
    return placed.unionByName(whole).unionByName(none).withColumnRenamed("item", key)
