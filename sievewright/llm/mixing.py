"""Problem 8: records of several sources mixed to target shares of the total size.

Each source's records, in random order and repeated where its share asks for it, form a stream that
is cut into blocks of ``block_tokens``.  Blocks are interleaved by Pfair scheduling: with weight w,
block i of a source is released in slot floor(i / w) and due by ceil((i + 1) / w), and every slot
goes to the released block with the earliest deadline.  At any point of the mixture a source is
then less than one block away from its share.

Weights are counted in parts of ``period`` (10,000; shares of four decimals are exact).  All
sources are exactly on their share after each period, so the schedule repeats, and one period of
slots, a table of fixed size, gives the slot of any block of any amount of data.
Where a source has less than one part, the period is a multiple of that, up to 50,000 slots.  The blocks
of a source that is smaller still take no slot of the schedule: each follows the slot of its release
time, so that none of its records is lost and the others are moved by less than a slot in 50,000.

How much to mix: without ``total_tokens`` the largest amount at which every source that has
records reaches its target with at most ``max_repeats`` passes.  With it, sources that would need
more passes give what they can and the others share the rest in proportion (water filling).

Scale: the position of a record in its source is a prefix sum; sources are cut into buckets of a
hash, summed by bucket and within a bucket, so that a source with a third of all rows is no single
task.  The last pass is broken off at the last record that fits the quota, and the gap that is left
is filled with further records of falling size, one of each size class.

Defined results: sources are compared without case and blanks; null, unlisted and zero-share
sources, and records without tokens, aren't chosen; a source listed twice counts with its first
row by name; a null max_repeats is 1; without any attainable source the mixture is empty.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.tokens import clean_label
from sievewright.session import BROADCAST_ROWS, materialize

PERIOD = 10_000
BLOCK_TOKENS = 2048
BUCKET_ROWS = 50_000
#: Listed sources that are held on the driver; more is an error rather than a silent cut.
MAX_SOURCES = 5_000


def whole_weights(shares: list[float], period: int = PERIOD) -> list[int]:
    """Shares as parts of ``period`` that add up to it, by largest remainder; a positive share has one part at least."""
    total = sum(shares)
    exact = [s / total * period for s in shares]
    floors = [max(math.floor(x + 1e-9), int(x > 0)) for x in exact]
    if sum(x > 0 for x in exact) > period:
        raise ValueError(f"more than {period} sources with a share")
    order = sorted(range(len(shares)), key=lambda i: (floors[i] - exact[i], i))
    for i in order[: max(0, period - sum(floors))]:
        floors[i] += 1
    for _ in range(sum(floors) - period):  # what the least parts took comes from the largest
        floors[max(range(len(floors)), key=lambda i: (floors[i], -i))] -= 1
    return floors


def period_for(shares: list[float], period: int = PERIOD) -> int:
    """The least multiple of ``period`` in which the smallest positive share is a whole part, up to ``BROADCAST_ROWS`` slots."""
    least = min(s for s in shares if s > 0) / sum(shares)
    return period * max(1, min(math.ceil(1 / (least * period) - 1e-9), BROADCAST_ROWS // period))


def pfair_schedule(weights: list[int], period: int = PERIOD) -> list[int]:
    """The source that has each slot of one period: earliest deadline first among released blocks."""
    # Whole numbers throughout: block i is released at floor(i * period / w), due at ceil((i + 1) * period / w).
    waiting = [(0, s, 0) for s, w in enumerate(weights) if w > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // weights[s]), s, i))
        if not ready:
            slots.append(-1)
            continue
        due, s, i = heapq.heappop(ready)
        if due < slot + 1:
            raise AssertionError("a block missed its deadline")
        slots.append(s)
        if i + 1 < weights[s]:
            heapq.heappush(waiting, ((i + 1) * period // weights[s], s, i + 1))
    return slots


def quotas(available: list[int], shares: list[float], repeats: list[int], total: int | None) -> list[float]:
    """Tokens to take from each source."""
    live = [i for i, (a, s, r) in enumerate(zip(available, shares, repeats)) if a > 0 and s > 0 and r > 0]
    out = [0.0] * len(shares)
    if not live:
        return out
    if total is None:
        weight = sum(shares[i] for i in live)
        reach = min(available[i] * repeats[i] * weight / shares[i] for i in live)
        for i in live:
            out[i] = reach * shares[i] / weight
        return out
    rest, open_ = float(total), set(live)
    while open_:
        weight = sum(shares[i] for i in open_)
        full = [i for i in open_ if rest * shares[i] / weight >= available[i] * repeats[i]]
        if not full:
            for i in open_:
                out[i] = rest * shares[i] / weight
            break
        for i in full:
            out[i] = float(available[i] * repeats[i])
        rest -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


def mix(
    sizes: DataFrame,
    sources: DataFrame,
    total_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    period: int = PERIOD,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """doc_id, source, copy (from 0), n_tokens, slot, place: the mixture in reading order.

    ``sizes``: doc_id, source, n_tokens.  ``sources``: source_id, target_share, max_repeats.
    """
    spark = sizes.sparkSession
    first = Window.partitionBy("source").orderBy("source_id")
    listed = (
        sources.withColumn("source", clean_label("source_id", "")).where("source != '' and target_share > 0")
        .withColumn("__r", F.row_number().over(first)).where("__r = 1")
        .select("source", F.col("target_share").cast("double").alias("share"), F.coalesce(F.col("max_repeats"), F.lit(1)).cast("int").alias("repeats"))
    )
    plan = listed.orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(plan) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = spark.createDataFrame([(r["source"], i) for i, r in enumerate(plan)], "source string, s int")
    rows = materialize(
        sizes.where("n_tokens > 0").withColumn("source", clean_label("source", "")).join(F.broadcast(names), "source")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "source", "s", F.col("n_tokens").cast("long").alias("n_tokens"), F.xxhash64("doc_id").alias("h")),
        "mix",
    )
    found = {r["s"]: (r["t"], r["n"]) for r in rows.groupBy("s").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    available = [found.get(i, (0, 0))[0] for i in range(len(plan))]
    take = quotas(available, [r["share"] for r in plan], [r["repeats"] for r in plan], total_tokens)
    buckets = [max(1, math.ceil(found.get(i, (0, 0))[1] / bucket_rows)) for i in range(len(plan))]
    numbers = spark.createDataFrame(
        [(i, float(q), int(a), int(b)) for i, (q, a, b) in enumerate(zip(take, available, buckets)) if q > 0], "s int, quota double, available long, buckets int"
    )

    # Place of each record in its source, as a prefix sum by buckets of the hash order.
    rows = rows.join(F.broadcast(numbers), "s").withColumn("bucket", F.pmod("h", F.col("buckets")).cast("int"))
    sums = rows.groupBy("s", "bucket").agg(F.sum("n_tokens").alias("t"))
    before = sums.withColumn(
        "before", F.sum("t").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("t")
    ).select("s", "bucket", "before")
    within = Window.partitionBy("s", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("run", F.sum("n_tokens").over(within)).join(before, ["s", "bucket"]).withColumn(
        "start", F.col("before") + F.col("run") - F.col("n_tokens")
    )
    # A copy in pass k starts at k * available + start and belongs to the mixture if it ends within the quota.
    passes = F.ceil(F.col("quota") / F.col("available")).cast("int")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), passes - 1)))).withColumn(
        "at", F.col("copy") * F.col("available") + F.col("start")
    )
    slack = 1e-6
    inside = F.col("at") + F.col("n_tokens") <= F.col("quota") + slack
    chosen = copies.where(inside).select("doc_id", "source", "s", "copy", "n_tokens", "at")
    # The gap that the first record too long for it leaves is filled with records of falling size.
    # One candidate for each source and size class, a table bounded by the sources, is enough.
    ends = {r["s"]: r["end"] for r in chosen.groupBy("s").agg(F.max(F.col("at") + F.col("n_tokens")).alias("end")).collect()}
    spare = (
        copies.where(~inside).groupBy("s", F.floor(F.log2("n_tokens") * 4).alias("size_class"))
        .agg(F.min(F.struct("h", "doc_id", "source", "copy", "n_tokens")).alias("x")).select("s", "x.*").collect()
    )
    extra = []
    for r in sorted(spare, key=lambda r: (r["s"], -r["n_tokens"], r["doc_id"])):
        end = ends.get(r["s"], 0)
        if end + r["n_tokens"] <= take[r["s"]]:
            extra.append((r["doc_id"], r["source"], r["s"], r["copy"], r["n_tokens"], end))
            ends[r["s"]] = end + r["n_tokens"]
    if extra:
        chosen = chosen.unionByName(spark.createDataFrame(extra, chosen.schema))

    total = sum(take)
    period = period_for(take, period) if total > 0 else period
    # Sources with less than a part of the period have no slot of their own: their blocks come at their release times.
    small = [0 < q / total * period < 1 - 1e-9 if total else False for q in take]
    regular = [0.0 if s else q for q, s in zip(take, small)]
    weights = whole_weights(regular, period) if sum(regular) > 0 else [0] * len(take)
    seen = [0] * len(plan)
    slots = []
    for slot, s in enumerate(pfair_schedule(weights, period) if sum(weights) else []):
        if s >= 0:
            slots.append((s, seen[s], slot))
            seen[s] += 1
    pattern = spark.createDataFrame(slots, "s int, i int, slot_in_period int")  # period rows, at most BROADCAST_ROWS
    per = spark.createDataFrame([(s, w, q / total) for s, (w, q) in enumerate(zip(weights, take)) if q > 0], "s int, w int, part double")
    blocks = chosen.withColumn("block", F.floor(F.col("at") / block_tokens)).join(F.broadcast(per), "s").withColumn("place", F.col("at") - F.col("block") * block_tokens)
    timed = blocks.where("w > 0").withColumn("i", F.pmod("block", "w").cast("int")).join(F.broadcast(pattern), ["s", "i"]).withColumn(
        "slot", F.floor(F.col("block") / F.col("w")) * period + F.col("slot_in_period")
    )
    released = blocks.where("w = 0").withColumn("slot", F.floor(F.col("block") / F.col("part"))).withColumn("place", F.col("place") + block_tokens)
    columns = ["doc_id", "source", "copy", "n_tokens", "slot", "place"]
    return timed.select(*columns).unionByName(released.select(*columns))


def shares(mixture: DataFrame, sources: DataFrame) -> DataFrame:
    """Target and actual share of each listed source, with its records and the most repeats."""
    got = mixture.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("doc_id").alias("n_documents"),
        F.max(F.col("copy") + 1).alias("repeats"), F.sum("n_tokens").alias("n_tokens"),
    )
    total = got.agg(F.sum("n_tokens").alias("all_tokens"))
    listed = sources.withColumn("source", clean_label("source_id", "")).groupBy("source").agg(
        F.min_by("target_share", "source_id").alias("target_share"), F.min_by("max_repeats", "source_id").alias("max_repeats")
    )
    zero = F.lit(0).cast("long")
    return listed.join(got, "source", "left").join(F.broadcast(total), F.lit(True), "left").select(
        "source", "target_share", "max_repeats", F.coalesce("n_records", zero).alias("n_records"), F.coalesce("n_documents", zero).alias("n_documents"),
        F.coalesce(F.col("repeats").cast("long"), zero).alias("repeats"), F.coalesce("n_tokens", zero).alias("n_tokens"),
        F.coalesce(F.col("n_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
    )
