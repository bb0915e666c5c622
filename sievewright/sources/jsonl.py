"""JSON-lines sources: strict, tolerant, numbered, and by chunk files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright.operators.order import numbered
from sievewright.session import materialize

MESSAGE = "struct<role:string,content:string>"
ROW_SCHEMA = (
    f"schema_version string, id string, source_id string, source string, license string, category string, bucket string, modality string, "
    f"thinking string, chat_template_kwargs struct<enable_thinking:boolean>, messages array<{MESSAGE}>, prompt string, "
    f"prompt_messages array<{MESSAGE}>, chosen string, rejected string, language string, lang string"
)


def read_strict(spark: SparkSession, path: str | Sequence[str], schema: str = ROW_SCHEMA) -> DataFrame:
    """Rows of well-formed lines; a bad line fails the job, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_tolerant(spark: SparkSession, path: str | Sequence[str], schema: str = ROW_SCHEMA) -> DataFrame:
    """Rows with ``_corrupt_record`` holding a line that can't be parsed."""
    full = T._parse_datatype_string(schema).add("_corrupt_record", T.StringType())
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, line (from 1, blank ones counted) and value of every line."""
    return numbered_lines_of(spark.read.text(path))


def parsed_lines(spark: SparkSession, path: str | Sequence[str], schema: str = ROW_SCHEMA) -> DataFrame:
    """The lines that aren't blank: file, line, value, whether it is JSON, and the row; null for JSON that is no object."""
    lines = numbered_lines(spark, path).where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    good = F.try_parse_json("value").isNotNull()
    return lines.withColumn("good", good).withColumn("row", F.when(good & F.ltrim("value").startswith("{"), F.from_json("value", schema)))


def read_limited(spark: SparkSession, path: str | Sequence[str], limit: int | None = None, schema: str = ROW_SCHEMA) -> DataFrame:
    """Rows of the first ``limit`` physical lines of each file, blank lines counted; JSON that is no object
    is left out, a bad line is an error that names file and line."""
    rows = parsed_lines(spark, path, schema)
    if limit is not None:
        rows = rows.where(F.col("line") <= limit)
    bad = F.raise_error(F.concat(F.lit("invalid JSON at line "), F.col("line").cast("string"), F.lit(" in "), F.col("file")))
    # The check is part of the row, so that no optimisation can leave it out.
    checked = rows.withColumn("row", F.when(F.col("good"), F.col("row")).otherwise(bad.cast(rows.schema["row"].dataType)))
    return checked.where("row is not null").select("row.*")


def line_quality(spark: SparkSession, path: str | Sequence[str], schema: str = ROW_SCHEMA) -> DataFrame:
    """One row: good lines, bad lines and the first bad one as line:number; a missing file is one bad line."""
    rows = None
    try:
        rows = materialize(parsed_lines(spark, path, schema).select("file", "line", "value", "good"), "lines")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        name = str(path if isinstance(path, str) else path[0]).rstrip("/").split("/")[-1]
        return spark.createDataFrame([(0, 1, None, f"missing_file:{name}")], "n_good long, n_bad long, bad_line string, first_error string")
    bad = ~F.col("good")
    first = F.min_by(F.struct("value", "line"), F.when(bad, F.struct("file", "line")))
    return rows.agg(F.count_if("good").alias("n_good"), F.count_if(bad).alias("n_bad"), first.alias("x")).select(
        "n_good", "n_bad", F.when(F.col("n_bad") > 0, F.col("x.value")).alias("bad_line"),
        F.when(F.col("n_bad") > 0, F.concat(F.lit("line:"), F.col("x.line").cast("string"))).alias("first_error"),
    )


def count_lines(spark: SparkSession, path: str | Sequence[str]) -> int:
    return spark.read.text(path).count()


def read_chunks(spark: SparkSession, folder: str, pattern: str = "*_chunk_????.jsonl", schema: str = ROW_SCHEMA, name: str | None = None) -> DataFrame:
    """All chunk files of a folder with their file name, by which they are ordered; a bad line fails the job.

    ``pattern`` is a glob; a question mark stands for a digit.  ``name``: a regular expression for file names instead.
    """
    wanted = name or "^" + re.escape(pattern).replace(r"\?", "[0-9]").replace(r"\*", ".*") + "$"
    return (
        spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", pattern).json(folder)
        .withColumn("chunk", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).where(F.col("chunk").rlike(wanted)).orderBy("chunk")
    )


def scan_patterns(spark: SparkSession, folder: str, patterns: dict[str, str], extensions: tuple[str, ...] = (".py", ".md", ".yaml", ".yml", ".json", ".jsonl", ".txt", ".sh")) -> DataFrame:
    """pattern, path, line, text: the lines of all files of a folder, by their extensions, that match a pattern."""
    lines = numbered_lines_of(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*{" + ",".join(extensions) + "}").text(folder))
    hits = F.filter(F.array(*[F.when(F.col("value").rlike(p), F.lit(k)) for k, p in patterns.items()]), lambda x: x.isNotNull())
    return lines.select(F.explode(hits).alias("pattern"), F.col("file").alias("path"), "line", F.col("value").alias("text"))


def numbered_lines_of(text: DataFrame) -> DataFrame:
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    return numbered(rows, ["file", "start", "at"], "line", ["file"]).select("file", "line", "value")


def pattern_hits(hits: DataFrame, violations: tuple[str, ...] = ()) -> DataFrame:
    """Lines and files of each pattern, and whether it counts as a violation."""
    return hits.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("path").alias("n_files")).withColumn("violation", F.col("pattern").isin(*violations) if violations else F.lit(False))


def parse_payloads(df: DataFrame, payload: str = "payload", schema: str = ROW_SCHEMA) -> DataFrame:
    """JSON texts of a column as columns; parsed is null where a text is no JSON object."""
    return df.withColumn("parsed", F.from_json(payload, schema, {"mode": "PERMISSIVE"})).withColumn(
        "parsed", F.when(F.try_parse_json(payload).isNotNull() & F.trim(payload).startswith("{"), F.col("parsed"))
    )
