"""Weights, whole-number allocation, token budgets and composition."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators.order import PART_ROWS, numbered, parts

# Target shares by category and modality, and how far a share may be off.
CATEGORY_TARGETS = {
    "polished_general_assistant": 0.30, "real_user_conversations": 0.20, "multilingual": 0.15, "utility_tasks": 0.15, "identity_behavior": 0.20,
}
MODALITY_TARGETS = {"text": 0.88, "image_text": 0.12}
ROW_TOLERANCE, TOKEN_TOLERANCE = 0.01, 0.015


def checked_weights(weights: dict[str, float]) -> dict[str, float]:
    """Weights as shares of their sum, by key; none may be negative and some must be positive."""
    if not weights:
        raise ValueError("no weights")
    if any(w < 0 for w in weights.values()):
        raise ValueError("a weight is negative")
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("the weights add up to nothing")
    return {k: float(weights[k]) / total for k in sorted(weights)}


def assert_targets(actual: dict[str, float], targets: dict[str, float], tolerance: float, label: str = "share") -> None:
    """An error that names each target from which the actual share is further off than the tolerance."""
    wrong = [f"{label} of {k}: {actual.get(k, 0.0):.6f} instead of {v:.6f}" for k, v in sorted(targets.items()) if abs(actual.get(k, 0.0) - v) > tolerance]
    if wrong:
        raise ValueError("; ".join(wrong))


def normalized(df: DataFrame, weight: str) -> DataFrame:
    """Weights as shares of their sum; the table is one row for each key."""
    total = df.agg(F.sum(weight).alias("__total"))
    return df.crossJoin(F.broadcast(total)).withColumn("share", F.col(weight) / F.col("__total")).drop("__total")


def allocate(df: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Whole numbers that add up to ``total``: largest remainder, ties by key."""
    shares = normalized(df, weight).withColumn("__exact", F.col("share") * total).withColumn("__floor", F.floor(F.round("__exact", 9)))
    rest = Window.orderBy((F.col("__floor") - F.round("__exact", 9)), key)
    left = shares.agg((F.lit(total) - F.sum("__floor")).alias("__left"))
    ranked = shares.withColumn("__r", F.row_number().over(rest)).crossJoin(F.broadcast(left))
    return ranked.select(key, (F.col("__floor") + (F.col("__r") <= F.col("__left")).cast("long")).alias("allocated"))


def derived_share(overall: float, identity: float, identity_part: float) -> float:
    """The part that the rest must have for the whole to reach ``overall``."""
    if not 0 <= identity < 1:
        raise ValueError("identity share must lie in [0, 1)")
    share = (overall - identity * identity_part) / (1 - identity)
    if not 0 <= share <= 1:
        raise ValueError("no share of the rest reaches the whole")
    return share


def derived_column(overall: Column, identity: Column, identity_part: Column) -> Column:
    """The same for columns; null where no share of the rest reaches the whole."""
    share = (overall - identity * identity_part) / (1 - identity)
    return F.when((identity >= 0) & (identity < 1) & (share >= 0) & (share <= 1), share)


def composition(df: DataFrame, tokens: str, category: str = "category", modality: str = "modality") -> DataFrame:
    """Rows and tokens, and their shares of all, by category and by modality, in one pass."""
    sets = df.groupingSets([[F.col(category)], [F.col(modality)]], category, modality).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(tokens).alias("n_tokens"), F.grouping(category).alias("__by_modality")
    )
    whole = F.sum("n_rows").over(Window.partitionBy("__by_modality"))
    all_tokens = F.sum("n_tokens").over(Window.partitionBy("__by_modality"))
    return sets.select(
        F.when(F.col("__by_modality") == 1, "modality").otherwise("category").alias("dimension"),
        F.coalesce(F.when(F.col("__by_modality") == 1, F.col(modality)).otherwise(F.col(category)), F.lit("unknown")).alias("value"),
        "n_rows", "n_tokens", (F.col("n_rows") / whole).alias("row_share"),
        F.when(all_tokens > 0, F.col("n_tokens") / all_tokens).otherwise(0.0).alias("token_share"),
    )


def drift(shares: DataFrame, targets: dict[str, float], value: str, share: str, tolerance: float) -> DataFrame:
    """Each target with its actual share and whether it is within the tolerance."""
    wanted = df_of(shares, targets)
    return wanted.join(shares.select(F.col(value).alias("target"), F.col(share).alias("actual")), "target", "left").select(
        "target", "wanted", F.coalesce("actual", F.lit(0.0)).alias("actual"),
        (F.abs(F.coalesce("actual", F.lit(0.0)) - F.col("wanted")) <= tolerance).alias("within"),
    )


def all_drift(shares: DataFrame) -> DataFrame:
    """Drift of row and token shares from the targets by category and by modality; ``shares`` as of :func:`composition`."""
    out = None
    for dimension, targets in (("category", CATEGORY_TARGETS), ("modality", MODALITY_TARGETS)):
        for measure, tolerance in (("row_share", ROW_TOLERANCE), ("token_share", TOKEN_TOLERANCE)):
            part = drift(shares.where(F.col("dimension") == dimension), targets, "value", measure, tolerance)
            part = part.select(F.lit(dimension).alias("dimension"), F.lit(measure).alias("measure"), "target", "wanted", "actual", "within")
            out = part if out is None else out.unionByName(part)
    return out


def df_of(like: DataFrame, targets: dict[str, float]) -> DataFrame:
    return F.broadcast(like.sparkSession.createDataFrame(sorted(targets.items()), "target string, wanted double"))


def budget_fill(df: DataFrame, order: str, tokens: str, budget: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``order`` and tokens of the rows taken: in order, each that still fits what is left of the budget."""
    return fill(df, order, tokens, budget, part_rows)[0]


def fill(df: DataFrame, order: str, tokens: str, budget: int, part_rows: int = PART_ROWS) -> tuple[DataFrame, int]:
    """The rows taken by :func:`budget_fill`, and what is left of the budget.

    Which rows fit depends on all rows before.  The rows are cut into parts of the order.  A part
    whose rows of at most the room that is left fit as a whole is taken by its sum; the first that
    doesn't is folded row by row in one task, and later parts are summed anew over the rows that can
    still fit.  The driver sees one sum a part, and what it keeps is the room at each part's start,
    from which all folds run side by side.
    """
    rows = parts(df.where(F.col(tokens) > 0).select(order, tokens), [order], part_rows, "fill")
    kind = dict(rows.dtypes)
    schema = f"{order} {kind[order]}, {tokens} {kind[tokens]}"
    room, at, plan = int(budget), 0, []
    while room > 0:
        able = rows.where((F.col("__part") >= at) & (F.col(tokens) <= room))
        sums = sorted((r["__part"], int(r["t"])) for r in able.groupBy("__part").agg(F.sum(tokens).alias("t")).collect())  # rows / part_rows numbers
        if not sums:
            break
        for part, total in sums:
            at = part + 1
            plan.append((part, room, total > room))
            if total <= room:
                room -= total
                if room == 0:
                    break
                continue
            taken = rows.where(F.col("__part") == part).coalesce(1).sortWithinPartitions(order).mapInPandas(_fold(order, tokens, {part: room}), schema)
            room -= int(taken.agg(F.sum(tokens)).first()[0])
            break
    if not plan:
        return rows.select(order, tokens).limit(0), room
    spark = rows.sparkSession
    steps = F.broadcast(spark.createDataFrame(plan, "__part int, __room long, __fold boolean"))  # at most one for each part
    planned = rows.join(steps, "__part").where(F.col(tokens) <= F.col("__room"))
    whole = planned.where(~F.col("__fold")).select(order, tokens)
    rooms = {part: left for part, left, folded in plan if folded}
    folds = planned.where("__fold").groupBy("__part").applyInPandas(lambda pdf: next(_fold(order, tokens, rooms)(iter([pdf.sort_values(order)]))), schema)
    return whole.unionByName(folds), room


def _fold(order: str, tokens: str, rooms: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for pdf in batches:
            if left is None and len(pdf):
                left = rooms[int(pdf["__part"].iloc[0])]
            taken = []
            for t in pdf[tokens].tolist():
                fits = t <= left
                left -= t if fits else 0
                taken.append(fits)
            yield pdf.loc[taken, [order, tokens]]

    return run


def select_open_rows(open_rows: DataFrame, order: str, tokens: str, identity_tokens: int, identity_share: float, small_sample: bool = False, part_rows: int = PART_ROWS) -> tuple[DataFrame, dict]:
    """Rows beside a fixed part so that this part has its share of all tokens exactly, and the figures of it.

    With ``small_sample`` all rows with tokens are taken, whatever the share.  Without, a budget that
    the rows can't meet exactly is an error.
    """
    if identity_tokens <= 0:
        raise ValueError("the fixed part has no tokens")
    if not 0 < identity_share < 1:
        raise ValueError("the share must lie between 0 and 1")
    needed = int(identity_tokens * ((1.0 - identity_share) / identity_share))
    if small_sample:
        taken = open_rows.where(F.col(tokens) > 0).select(order, tokens)
        got = int(taken.agg(F.sum(tokens)).first()[0] or 0)
        left = max(0, needed - got)
    else:
        taken, left = fill(open_rows, order, tokens, needed, part_rows)
        got = needed - left
        if left:
            raise ValueError(f"no exact fill: {needed} tokens wanted, {got} found, {left} left")
    return taken, {
        "identity_tokens": identity_tokens, "open_tokens": got, "required_open_tokens_exact": needed, "remaining_open_tokens": left,
        "full_tokens": identity_tokens + got, "identity_token_share_exact": not small_sample,
    }


def scan_prefix(df: DataFrame, source: str, order: str, accepted: Column, most_scanned: int, enough: int, least_scanned: int, most_unmapped: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows of each source that a capped scan would read: until enough were accepted after
    the least number scanned, never more than the cap, and no further once ``most_unmapped`` rows
    weren't accepted."""
    before = Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # Only the first rows of a source matter: numbered by parts, so that a source with a third of all rows is no single task.
    first = numbered(df, [order], "__n", [source], part_rows).where(F.col("__n") <= most_scanned)
    counted = first.withColumn("__ok", F.coalesce(F.sum(accepted.cast("int")).over(before), F.lit(0)))
    kept = ~((F.col("__ok") >= enough) & (F.col("__n") - 1 >= least_scanned))
    if most_unmapped is not None:
        counted = counted.withColumn("__bad", F.col("__n") - 1 - F.col("__ok"))
        kept = kept & (F.col("__bad") < most_unmapped)
    return counted.where(kept).drop("__n", "__ok", "__bad")


def bucket_counts(df: DataFrame, key: str, share: str, order: str, total: int) -> DataFrame:
    """Whole numbers from shares that need not add up to one: largest remainder, ties by order,
    going round again if more is missing than there are buckets."""
    exact = F.round(F.col(share) * total, 9)
    floors = df.withColumn("__floor", F.floor(exact)).withColumn("__rest", exact - F.floor(exact))
    left = floors.agg(F.greatest(F.lit(0), F.lit(total) - F.sum("__floor")).alias("__left"), F.count(F.lit(1)).alias("__n"))
    ranked = floors.withColumn("__r", F.row_number().over(Window.orderBy(F.col("__rest").desc(), order)) - 1).crossJoin(F.broadcast(left))
    extra = F.floor(F.col("__left") / F.col("__n")) + (F.col("__r") < F.col("__left") % F.col("__n")).cast("long")
    return ranked.select(key, (F.col("__floor") + extra).alias("allocated"))
