"""Review of generated chunks: ordered reasons for rejecting rows, duplicates among the accepted, and reports.

A row that is rejected for anything else registers neither its id nor its signature, so the
reasons that need one row only come first and duplicates are looked for among the rows that have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import text as T
from sievewright.operators import rubric


def forbidden_hit(text: Column, phrases: tuple[str, ...] = T.FORBIDDEN_PHRASES) -> Column:
    """The first listed phrase that a text holds; null if none."""
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for p in phrases])


def any_marker(text: Column, markers: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(low, F.lit(m.lower()))
    return out


def lacks_identity(text: Column, terms: tuple[str, str]) -> Column:
    low = F.lower(text)
    return ~(F.contains(low, F.lit(terms[0])) & F.contains(low, F.lit(terms[1])))


def block_text(blocks: Column) -> Column:
    """The texts of an array of blocks, of any type, joined by spaces and trimmed."""
    return T.strip(F.array_join(F.filter(F.transform(blocks, lambda b: b["text"]), lambda t: t.isNotNull()), " "))


def review_answers(rows: DataFrame, run_id: Column, terms: tuple[str, str], order: str, min_score: float = rubric.MIN_SCORE) -> DataFrame:
    """id, ``order`` and reason of each row, null if it is accepted.

    ``rows``: id, run_id, prompt, answer, n_messages, total (the rubric's, null passes) and ``order``.
    """
    phrase = forbidden_hit(F.col("answer"))
    answer = F.coalesce(T.strip(F.col("answer")), F.lit(""))
    reason = (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "invalid_id").when(~F.col("run_id").eqNullSafe(run_id), "run_id_mismatch")
        .when(F.coalesce(F.col("n_messages"), F.lit(0)) < 2, "messages_invalid").when(answer == "", "assistant_text_empty").when(lacks_identity(answer, terms), "identity_drift")
        .when(phrase.isNotNull(), F.concat(F.lit("forbidden:"), phrase))
    )
    low = F.col("total") < min_score
    return _with_duplicates(rows.withColumn("__reason", reason).withColumn("__low", F.coalesce(low, F.lit(False))), T.signature(F.col("prompt"), F.col("answer")), order)


def review_preferences(rows: DataFrame, run_id: Column, terms: tuple[str, str], order: str, min_margin: float = rubric.MIN_MARGIN) -> DataFrame:
    """The same for pairs: id, run_id, prompt, chosen, rejected, chosen_score, rejected_score, margin, failure_modes."""
    blank = lambda c: F.coalesce(T.strip(F.col(c)), F.lit("")) == ""
    phrase = forbidden_hit(F.col("chosen"))
    unknown = F.filter(F.array_sort(F.array_distinct("failure_modes")), lambda m: ~m.isin(*rubric.FAILURES))
    reason = (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "invalid_id").when(~F.col("run_id").eqNullSafe(run_id), "run_id_mismatch")
        .when(blank("chosen"), "chosen_top_level_empty").when(blank("rejected"), "rejected_top_level_empty").when(lacks_identity(F.col("chosen"), terms), "identity_drift")
        .when(phrase.isNotNull(), F.concat(F.lit("forbidden:"), phrase))
        .when(F.col("chosen_score").isNull() | F.col("rejected_score").isNull() | F.col("margin").isNull(), "score_invalid")
        .when(F.col("chosen_score") <= F.col("rejected_score"), "margin_invalid").when(F.col("margin") < min_margin, "margin_too_low")
        .when(F.coalesce(F.size("failure_modes"), F.lit(0)) < 1, "failure_modes_missing")
        .when(F.size(unknown) > 0, F.concat(F.lit("failure_mode_not_allowed:"), F.array_join(unknown, ",")))
    )
    return _with_duplicates(rows.withColumn("__reason", reason).withColumn("__low", F.lit(False)), T.signature(F.col("prompt"), F.col("chosen")), order)


def _with_duplicates(rows: DataFrame, signature: Column, order: str) -> DataFrame:
    """Of rows that nothing else speaks against, the first by order of each id and of each signature stays.

    A duplicate is one whether or not its first has a low score, unless that first was rejected, which
    registers nothing; low scores are therefore taken out before the first is looked for.
    """
    marked = rows.withColumn("__signature", signature)
    able = marked.where(F.col("__reason").isNull() & ~F.col("__low"))
    ids = able.groupBy("id").agg(F.min(order).alias("__first_id"))
    first_of_id = able.join(ids, "id").where(F.col(order) == F.col("__first_id"))
    signatures = first_of_id.groupBy("__signature").agg(F.min(order).alias("__first"))
    out = marked.join(ids, "id", "left").join(signatures, "__signature", "left")
    reason = (
        F.when(F.col("__reason").isNotNull(), F.col("__reason")).when(F.col("__first_id") < F.col(order), "duplicate_id")
        .when(F.col("__first") < F.col(order), "exact_duplicate").when(F.col("__low"), "low_score")
    )
    return out.select("id", order, reason.alias("reason"))


def shard_state(rows: DataFrame, run_id: str, expected: int, order: str) -> DataFrame:
    """One row: whether the first ``expected`` rows are enough, of the run, and with ids of their own."""
    from sievewright.operators.order import numbered

    first = numbered(rows.select("id", "run_id", order), [order], "__n").where(F.col("__n") <= expected)
    counts = first.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.count_if(~F.col("run_id").eqNullSafe(F.lit(run_id))).alias("n_other_run"))
    return counts.withColumn("valid", (F.col("n_rows") == expected) & (F.col("n_ids") == expected) & (F.col("n_other_run") == 0))


def review_report(answers: DataFrame, target: int) -> DataFrame:
    """One row: accepted and rejected rows, how much of the target is reached in percent, rates of duplicates and low
    scores of all rows, and distinct seeds.  ``answers``: reason and seed_id."""
    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    ok = F.col("reason").isNull()
    return answers.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_accepted"), (F.count_if(ok) * 100.0 / max(1, target)).alias("attainment"),
        (F.count_if(F.col("reason").isin("exact_duplicate", "duplicate_id")) / n).alias("duplicate_rate"), (F.count_if(F.col("reason") == "low_score") / n).alias("low_score_rate"),
        F.countDistinct("seed_id").alias("n_seeds"),
    )
