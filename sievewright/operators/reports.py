"""Histograms, manifests, length reports and validation reports; the names of their figures and checks are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import text as T


def histograms(df: DataFrame, *columns: str) -> DataFrame:
    """Rows by each of the columns, in one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("n_rows"))


def manifest(df: DataFrame, column: str) -> DataFrame:
    """Counts of a column with their share in percent."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("percent", F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy()))


def floor_percentiles(df: DataFrame, group: str, value: str, points: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Of each group count, least, greatest, mean, and the values at rank floor((n - 1) * p).

    Values are counted before they are ranked: what a task holds is bounded by the distinct values
    of a group, not by its rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    ranked = counts.withColumn("upto", F.sum("k").over(w)).withColumn("n", F.sum("k").over(whole))
    at = [F.min(F.when(F.col("upto") > F.floor((F.col("n") - 1) * F.lit(p)), F.col(value))).alias(f"p{round(p * 100)}") for p in points]
    return ranked.groupBy(group).agg(
        F.max("n").alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"),
        (F.sum(F.col(value) * F.col("k")) / F.sum("k")).alias("mean"), *at,
    )


def reasons(df: DataFrame, reason: str) -> DataFrame:
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


def majority(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each group; of equally frequent ones the first seen."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("k"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.min(F.struct((-F.col("k")).alias("k"), "first", value)).alias("x")).select(group, F.col(f"x.{value}").alias("answer"), (-F.col("x.k")).alias("votes"))


def validation(df: DataFrame, reason: str, tokens: str, marked: str) -> DataFrame:
    """One row: what a validation run reports of the rows."""
    ok = F.col(reason) == "ok"
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"), F.count_if(ok).alias("rows_valid"), F.count_if(~ok).alias("rows_invalid"),
        F.coalesce(F.sum(F.when(ok, F.col(tokens))), F.lit(0)).alias("tokens_valid"), F.count_if(F.col(marked) > 0).alias("rows_marked"),
        F.count_if(ok & (F.col("modality") == "image_text")).alias("rows_image_text"), F.countDistinct(F.when(ok, F.col("id"))).alias("ids"),
    )


def parity(pairs: DataFrame, reference: str, candidate: str, min_score: float = 0.25) -> DataFrame:
    """Each pair with its overlap, whether either text is garbled, whether the pair passes, and ok:
    whether all pairs do.  A null text is an empty one."""
    a, b = F.coalesce(reference, F.lit("")), F.coalesce(candidate, F.lit(""))
    rows = pairs.select(
        *[c for c in pairs.columns if c not in (reference, candidate)],
        T.jaccard(a, b).alias("score"), T.garbled(a).alias("reference_garbled"), T.garbled(b).alias("candidate_garbled"),
    ).withColumn("passes", (F.col("score") >= min_score) & ~F.col("candidate_garbled"))
    return rows.crossJoin(F.broadcast(rows.agg(F.bool_and("passes").alias("ok"))))


def full_report(rows: DataFrame, preferences: DataFrame, category_targets: dict[str, float], modality_targets: dict[str, float], tolerance: float, identity_share: float, identity_image_share: float, small_sample: bool = False) -> DataFrame:
    """One row: what a validation of both tables of a dataset reports, and whether it passes.

    ``rows``: reason, category, modality, tokens, markers.  ``preferences``: source_id, markers.  Only rows
    that are ok count.  A small sample needn't meet the shares of tokens, but must still meet the share of
    pictures outside the identity part.
    """
    ok = rows.where("reason = 'ok'")
    identity, image = F.col("category") == "identity_behavior", F.col("modality") == "image_text"
    tokens = lambda c: F.coalesce(F.sum(F.when(c, F.col("tokens"))), F.lit(0).cast("long"))
    whole = ok.agg(
        F.count(F.lit(1)).alias("sft_rows_total"), F.count_if(identity).alias("identity_sft_rows"), F.coalesce(F.sum("tokens"), F.lit(0).cast("long")).alias("sft_tokens_total"), tokens(identity).alias("identity_sft_tokens"),
        tokens(~identity & image).alias("__image_tokens"), F.coalesce(F.sum("markers"), F.lit(0).cast("long")).alias("__sft_markers"),
        *[tokens(F.col("category") == k).alias(f"__c{i}") for i, k in enumerate(sorted(category_targets))], *[tokens(F.col("modality") == k).alias(f"__m{i}") for i, k in enumerate(sorted(modality_targets))],
    )
    others = preferences.agg(
        F.count(F.lit(1)).alias("preferences_rows_total"), F.count_if(F.col("source_id").isin("identity_pack", "identity_pack_preferences")).alias("identity_preference_rows"),
        F.coalesce(F.sum("markers"), F.lit(0).cast("long")).alias("__preference_markers"),
    )
    bad = rows.agg(F.count_if(F.col("reason") != "ok").alias("invalid_sft_rows"))
    one = whole.crossJoin(F.broadcast(others)).crossJoin(F.broadcast(bad))  # a row each
    total = F.greatest(F.col("sft_tokens_total"), F.lit(1))
    share = lambda c: F.when(F.col("sft_tokens_total") > 0, c / total).otherwise(0.0)

    def within(prefix: str, targets: dict[str, float]):
        out = F.lit(True)
        for i, k in enumerate(sorted(targets)):
            out = out & (F.abs(share(F.col(f"{prefix}{i}")) - targets[k]) <= tolerance)
        return out

    required = (modality_targets["image_text"] - identity_share * identity_image_share) / (1 - identity_share)
    other_tokens = F.col("sft_tokens_total") - F.col("identity_sft_tokens")
    checks = {
        "cot_marker_count_zero": F.col("cot_marker_count") == 0, "no_invalid_rows": F.col("invalid_sft_rows") == 0,
        "token_category_targets_within_tolerance": F.lit(True) if small_sample else within("__c", category_targets),
        "token_modality_targets_within_tolerance": F.lit(True) if small_sample else within("__m", modality_targets),
        "identity_token_share_exact": F.abs(F.col("identity_token_share") - identity_share) <= 1e-12,
        "non_identity_multimodal_share_within_tolerance": F.abs(F.col("non_identity_multimodal_share") - required) <= tolerance, "preferences_nonempty": F.col("preferences_rows_total") > 0,
    }
    needed = ["cot_marker_count_zero", "no_invalid_rows", "non_identity_multimodal_share_within_tolerance", "preferences_nonempty"]
    if not small_sample:
        needed += ["token_category_targets_within_tolerance", "token_modality_targets_within_tolerance", "identity_token_share_exact"]
    passed = F.lit(True)
    for name in needed:
        passed = passed & checks[name]
    figures = one.withColumns({
        "open_sft_tokens": other_tokens, "identity_token_share": F.col("identity_sft_tokens") / total, "cot_marker_count": F.col("__sft_markers") + F.col("__preference_markers"),
        "required_non_identity_multimodal_share": F.lit(required), "non_identity_multimodal_share": F.col("__image_tokens") / F.greatest(other_tokens, F.lit(1)),
    })
    out = figures.withColumns({**checks, "pass": passed})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def identity_report(rows: DataFrame, preferences: DataFrame, order: list[str], sample: int = 2_000) -> DataFrame:
    """One row: what a validation of the identity pack reports.

    ``rows`` and ``preferences``: reason, markers and the order; rows also modality and tokens.  Reasons are
    looked at in the first ``sample`` rows of each only, by order; all else counts all rows.
    """
    from sievewright.operators.order import numbered

    def invalid(df: DataFrame) -> DataFrame:
        first = numbered(df.select(*order, "reason"), order, "__n")
        return first.agg(F.count_if((F.col("__n") <= sample) & (F.col("reason") != "ok")).alias("n"))

    image = F.col("modality") == "image_text"
    zero = F.lit(0).cast("long")
    a = rows.agg(
        F.count(F.lit(1)).alias("sft_rows"), F.coalesce(F.sum("tokens"), zero).alias("sft_tokens_total"), F.coalesce(F.sum(F.when(image, F.col("tokens"))), zero).alias("image_text_tokens"),
        F.count_if(image).alias("image_text_rows"), F.coalesce(F.sum("markers"), zero).alias("__a"),
    )
    b = preferences.agg(F.count(F.lit(1)).alias("preference_rows"), F.coalesce(F.sum("markers"), zero).alias("__b"))
    one = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(invalid(rows).withColumnRenamed("n", "invalid_sft"))).crossJoin(F.broadcast(invalid(preferences).withColumnRenamed("n", "invalid_preferences")))
    return one.select(
        "sft_rows", "preference_rows", "sft_tokens_total", (F.col("sft_tokens_total") - F.col("image_text_tokens")).alias("text_tokens"), "image_text_tokens",
        (F.col("image_text_tokens") / F.greatest(F.col("sft_tokens_total"), F.lit(1))).alias("image_text_share_tokens"), (F.col("sft_rows") - F.col("image_text_rows")).alias("text_rows"), "image_text_rows",
        (F.col("image_text_rows") / F.greatest(F.col("sft_rows"), F.lit(1))).alias("image_text_share"), (F.col("__a") + F.col("__b")).alias("cot_marker_count_detected"), "invalid_sft", "invalid_preferences",
    )


def dataset_manifest(report: dict, files: dict[str, str], hashes: dict[str, str], created: str) -> dict:
    """The manifest of a dataset: where it lies, its hashes, and the figures of its validation."""
    return {"schema_version": "2.0", "created_utc": created, "paths": dict(files), "sha256": dict(hashes), "figures": dict(report)}


def manifest_markdown(manifest: dict) -> str:
    """A manifest to read: its paths, its figures and its checks."""
    figures = manifest["figures"]
    checks = {k: v for k, v in figures.items() if isinstance(v, bool)}
    lines = ["# Dataset manifest", "", f"Made {manifest['created_utc']}. It describes the files named here and no run made with them.", "", "## Paths"]
    lines += [f"- {k}: `{v}`" + (f" (sha256 `{manifest['sha256'][k]}`)" if k in manifest["sha256"] else "") for k, v in manifest["paths"].items()]
    lines += ["", "## Figures", *[f"- {k}: `{v}`" for k, v in figures.items() if k not in checks], "", "## Checks", *[f"- {k}: `{v}`" for k, v in checks.items()], ""]
    return "\n".join(lines)
