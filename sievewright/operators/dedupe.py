"""Exact duplicates, duplicates against a ledger of earlier batches, and near-duplicates of a block."""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.operators.order import numbered
from sievewright.session import materialize


def first_of_each(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key, any one of equally early ones.  A grouped minimum finds it, combined
    before the shuffle, so that a key with a third of all rows is no problem; rows are not sorted."""
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*[F.col(key) if c == key else F.col(f"__first.{c}").alias(c) for c in df.columns])


def copy_counts(df: DataFrame, key: str, member: str) -> DataFrame:
    """Each key with its least member and the number of rows."""
    return df.groupBy(key).agg(F.min(member).alias(member), F.count(F.lit(1)).alias("n_copies"))


def not_in_ledger(df: DataFrame, ledger: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key no earlier batch had."""
    return df.join(ledger.select(*keys), list(keys), "left_anti")


def first_not_in_ledger(df: DataFrame, earlier: Column, key: str, member: str) -> DataFrame:
    """``key`` and the least ``member`` of the new rows of each key that no earlier row has.

    Earlier rows are those of the same table where ``earlier`` holds: one aggregation, combined before
    the shuffle, instead of a join of the table with itself.
    """
    by = df.groupBy(key).agg(F.bool_or(F.coalesce(earlier, F.lit(False))).alias("__old"), F.min(member).alias(member))
    return by.where("not __old").select(member, key)


def near_duplicates(
    df: DataFrame, block: list[str], order: str, prompt: str, answer: str, ratio: float = 0.96, window: int = 150, slice_rows: int = 5_000
) -> DataFrame:
    """``order`` and kept of every row: whether it is near none of the last ``window`` kept rows.

    Rows of a block are taken in order; a row is near another if the edit ratio of prompts and of
    answers both reach ``ratio``.  The look-back is a rule of the operator and reads kept rows, so
    it is a fold, and the result is that of the fold over the whole block.  A block of more than
    ``slice_rows`` rows is cut into slices by order, so that most of a hot block's work is many
    tasks: each slice is folded from a guess, what the 2 x ``window`` rows before it leave.  One
    pass over each block then carries the real look-back from slice to slice and judges rows again
    until it equals the guessed one, from where on the guess is right.
    """
    placed = numbered(df.select(*block, order, prompt, answer), [order], "__n", block)
    placed = materialize(placed.withColumn("__n", F.col("__n") - 1).withColumn("__slice", F.floor(F.col("__n") / slice_rows)), "near")
    lead = placed.where(F.col("__n") % slice_rows >= slice_rows - 2 * window).withColumn("__slice", F.col("__slice") + 1).withColumn("__lead", F.lit(True))
    rows = placed.withColumn("__lead", F.lit(False)).unionByName(lead)
    kinds = dict(df.dtypes)

    def judge(p: Seen, a: Seen, kept: deque) -> bool:
        return not any(p.near(q, ratio) and a.near(b, ratio) for _, q, b in kept)

    def guess(t: pa.Table) -> pa.Table:
        t = t.sort_by("__n")
        kept: deque = deque(maxlen=window)
        flags, start = [], None
        for n, p, a, is_lead in zip(*(t[c].to_pylist() for c in ("__n", prompt, answer, "__lead"))):
            p, a = Seen(p or ""), Seen(a or "")
            if not is_lead and start is None:
                start = [m for m, _, _ in kept]
            keep = judge(p, a, kept)
            if keep:
                kept.append((n, p, a))
            if not is_lead:
                flags.append(keep)
        t = t.slice(t.num_rows - len(flags))
        # A first slice is exact: only what it hands on is read again.
        last = {n for n, _, _ in kept}
        read = [s > 0 or n in last for s, n in zip(t["__slice"].to_pylist(), t["__n"].to_pylist())]
        texts = [pa.array([x if r else None for x, r in zip(t[c].to_pylist(), read)], pa.string()) for c in (prompt, answer)]
        starts = pa.array(([start] + [None] * (len(flags) - 1)) if flags else [], pa.list_(pa.int64()))
        fields = [*(t[c] for c in dict.fromkeys([*block, order])), t["__n"], *texts, pa.array(flags, pa.bool_()), starts]
        return pa.table(fields, names=guessed)

    guessed = [*dict.fromkeys([*block, order]), "__n", "__p", "__a", "kept", "__start"]
    types = [*(f"`{c}` {kinds[c]}" for c in dict.fromkeys([*block, order])), "__n long, __p string, __a string, kept boolean, __start array<long>"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        real: deque = deque(maxlen=window)
        places: deque = deque(maxlen=window)  # of the rows in real
        told: deque = deque(maxlen=window)  # of the rows that the guess holds
        same = True
        for batch in batches:
            flags = []
            for n, p, a, keep, start in zip(*(batch[c].to_pylist() for c in guessed[-5:])):
                p, a = Seen(p or ""), Seen(a or "")
                if n == 0:  # a new block
                    real.clear()
                    places.clear()
                if start is not None:
                    told = deque(start, maxlen=window)
                    same = told == places
                if not same:
                    if keep:
                        told.append(n)
                    keep = judge(p, a, real)
                if keep:
                    real.append((n, p, a))
                    places.append(n)
                same = same or told == places
                flags.append(keep)
            yield pa.record_batch([batch[order], pa.array(flags, pa.bool_())], [order, "kept"])

    first = rows.groupBy(*block, "__slice").applyInArrow(guess, ", ".join(types))
    return first.repartition(*block).sortWithinPartitions(*block, "__n").mapInArrow(settle, f"`{order}` {kinds[order]}, kept boolean")


class Seen:
    """A text of the look-back with what cheap bounds need."""

    __slots__ = ("text", "counts", "size")

    def __init__(self, text: str):
        self.text, self.counts, self.size = text, Counter(text), len(text)

    def near(self, other: Seen, ratio: float) -> bool:
        """Whether the edit ratio reaches ``ratio``; length and common characters bound it from above first."""
        whole = self.size + other.size
        if not whole:
            return True
        if 2 * min(self.size, other.size) < ratio * whole or 2 * (self.counts & other.counts).total() < ratio * whole:
            return False
        return self.text == other.text or SequenceMatcher(None, self.text, other.text).ratio() >= ratio
