"""Command line: validate a dataset or the identity pack, render a manifest, audit files for patterns."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.operators import filters, mixing, normalize, reports
from sievewright.sources import jsonl
from sievewright.sources.sinks import file_sha256, write_report


def _tokens():
    return F.coalesce(F.aggregate(F.transform(M.texts(F.col("messages")), T.token_estimate), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")


def _marks(*columns: str):
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(T.marker_total(F.coalesce(c, F.lit(""))), F.lit(0))
    return total.cast("long")


def validate_dataset(spark: SparkSession, args: argparse.Namespace) -> dict:
    rows = jsonl.read_limited(spark, args.sft)
    checked = rows.select(
        filters.compat_reason(F.col("id"), F.col("messages"), F.coalesce("modality", F.lit("text"))).alias("reason"), M.category(F.col("category"), F.col("bucket")).alias("category"),
        M.modality(F.col("modality"), F.col("messages")).alias("modality"), _tokens().alias("tokens"), F.coalesce(T.marker_total(filters.row_texts(F.col("messages"))), F.lit(0)).cast("long").alias("markers"),
    )
    pairs = normalize.preference_rows(jsonl.read_limited(spark, args.preferences)).select("source_id", _marks("prompt", "chosen").alias("markers"))
    found = reports.full_report(checked, pairs, mixing.CATEGORY_TARGETS, mixing.MODALITY_TARGETS, mixing.TOKEN_TOLERANCE, args.identity_share, args.identity_image_share, args.allow_small_sample)
    return found.first().asDict()


def validate_identity(spark: SparkSession, args: argparse.Namespace) -> dict:
    made = normalize.identity_rows(jsonl.read_limited(spark, args.sft)).withColumn("chat_template_kwargs", F.struct("enable_thinking"))
    made = made.withColumn("private_local_attestation", F.lit(None).cast("struct<provenance_attestation:string,license:string,redistribution_allowed:boolean,pii_policy:string>"))
    rows = made.select("id", filters.identity_reason(made).alias("reason"), "modality", _tokens().alias("tokens"), F.coalesce(T.marker_total(filters.row_texts(F.col("messages"))), F.lit(0)).cast("long").alias("markers"))
    pairs = normalize.preference_rows(jsonl.read_limited(spark, args.preferences), identity=True)
    blank = lambda c: T.strip(F.col(c)) == ""
    marked = pairs.select("id", F.when(blank("prompt") | blank("chosen") | blank("rejected"), "blank").otherwise("ok").alias("reason"), _marks("prompt", "chosen", "rejected").alias("markers"))
    return reports.identity_report(rows, marked, ["id"], args.sample_validate_rows).first().asDict()


def audit(spark: SparkSession, args: argparse.Namespace) -> dict:
    hits = jsonl.scan_patterns(spark, args.folder, json.loads(args.patterns))
    counted = jsonl.pattern_hits(hits, tuple(args.violations)).collect()
    return {"patterns": {r.pattern: {"lines": r.n_lines, "files": r.n_files} for r in counted}, "violations": sum(r.n_lines for r in counted if r.violation)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sievewright", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("validate-dataset", "validate-identity"):
        sub = commands.add_parser(name)
        sub.add_argument("--sft", required=True)
        sub.add_argument("--preferences", required=True)
        sub.add_argument("--output")
        sub.add_argument("--strict", action="store_true", help="end with 2 if the validation doesn't pass")
        if name == "validate-dataset":
            sub.add_argument("--allow-small-sample", action="store_true")
            sub.add_argument("--identity-share", type=float, default=0.2)
            sub.add_argument("--identity-image-share", type=float, default=0.0)
        else:
            sub.add_argument("--sample-validate-rows", type=int, default=2_000)
    sub = commands.add_parser("render-manifest")
    sub.add_argument("--report", required=True)
    sub.add_argument("--file", action="append", default=[], help="name=path of a file of the dataset")
    sub.add_argument("--output", required=True, help="a .json or .md file")
    sub = commands.add_parser("audit")
    sub.add_argument("--folder", required=True)
    sub.add_argument("--patterns", required=True, help="JSON of names and regular expressions")
    sub.add_argument("--violations", nargs="*", default=[])
    sub.add_argument("--output")
    args = parser.parse_args(argv)
    if args.command == "render-manifest":
        with open(args.report, encoding="utf-8") as data:
            report = json.load(data)
        files = dict(x.split("=", 1) for x in args.file)
        manifest = reports.dataset_manifest(report, files, {k: file_sha256(v) for k, v in files.items()}, datetime.now(UTC).isoformat())
        if args.output.endswith(".md"):
            with open(args.output, "w", encoding="utf-8") as out:
                out.write(reports.manifest_markdown(manifest))
        else:
            write_report(manifest, args.output)
        return 0
    spark = spark or SparkSession.builder.appName("sievewright").getOrCreate()
    report = {"validate-dataset": validate_dataset, "validate-identity": validate_identity, "audit": audit}[args.command](spark, args)
    print(json.dumps(report, indent=2, ensure_ascii=False, default=str))
    if args.output:
        write_report(report, args.output)
    if args.command == "audit":
        return 2 if report["violations"] else 0
    failed = not report["pass"] if args.command == "validate-dataset" else report["invalid_sft"] + report["invalid_preferences"] > 0
    return 2 if args.strict and failed else 0


if __name__ == "__main__":
    sys.exit(main())
