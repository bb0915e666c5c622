"""Sinks: JSON lines, reports with an atomic rename, ledgers and checksums."""

from __future__ import annotations

import hashlib
import json
import os
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Columns of a ledger; it is laid out by batch and by the head of the signature.
LEDGER = "signature string, batch long, head string"


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = True) -> int:
    """Rows as JSON lines, non-ASCII characters as they are; how many were written, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)
    return seen.get["n"]


def commit_chunk(df: DataFrame, path: str, tries: int = 2) -> int:
    """A chunk written beside its place and moved there, complete or not at all; one more try if that fails."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".commit.tmp")
    files = place.getFileSystem(conf)
    for attempt in range(tries):
        try:
            n = write_jsonl(df, aside.toString())
            files.delete(place, True)
            if not files.rename(aside, place):
                raise OSError(f"can't move {aside} to {place}")
            return n
        except Exception:
            files.delete(aside, True)
            if attempt == tries - 1:
                raise
    raise AssertionError


def write_report(report: dict, path: str) -> None:
    """A small report as JSON, complete or not at all."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path + ".tmp", "w", encoding="utf-8") as out:
        json.dump(report, out, indent=2, ensure_ascii=False, sort_keys=True, default=str)
    os.replace(path + ".tmp", path)


def append_ledger(df: DataFrame, path: str, key: str, batch: int) -> None:
    """Keys of a batch, in folders of that batch only: written again, a batch replaces itself."""
    rows = df.select(F.col(key).alias("signature"), F.substring(F.substring_index(F.col(key), ":", -1), 1, 2).alias("head")).distinct()
    rows.write.mode("overwrite").partitionBy("head").parquet(f"{path}/batch={batch}")


def heartbeat(spark: SparkSession, path: str, **fields: object) -> None:
    """One line of a log of what a run does, appended."""
    spark.createDataFrame([(json.dumps(fields, sort_keys=True, default=str),)], "value string").withColumn(
        "value", F.concat(F.lit('{"at":"'), F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss'Z'"), F.lit('","fields":'), "value", F.lit("}"))
    ).write.mode("append").text(path)


def checksums(spark: SparkSession, folder: str, size: int = 1 << 20) -> DataFrame:
    """Relative path, SHA-256 and length of every file below a folder, in order of the paths.

    The files are listed by Spark; each is read by one task in pieces of ``size`` bytes, so that its
    length doesn't matter, from a folder that the executors can reach as a path.
    """
    root = folder.removeprefix("file://").rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            paths = [unquote(p.split(":", 1)[-1]) if p.startswith("file:") else p for p in pdf["path"]]
            paths = ["/" + p.lstrip("/") for p in paths]
            yield pd.DataFrame({"path": [os.path.relpath(p, root) for p in paths], "sha256": [file_sha256(p) for p in paths], "length": pdf["length"]})

    return listed.mapInPandas(digests, "path string, sha256 string, length long").orderBy("path")


def bundle(paths: list[str], archive: str) -> list[str]:
    """The files among the paths in a ZIP archive under their own names; the names."""
    names = []
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in paths:
            if os.path.isfile(path):
                out.write(path, os.path.basename(path))
                names.append(os.path.basename(path))
    return names


def _hex(value: object) -> str:
    return hashlib.sha256(value.encode()).hexdigest()  # type: ignore[attr-defined]


def stable_json(value: object) -> str:
    """JSON that is the same for equal values: keys in order, no spaces, ASCII only."""
    return json.dumps(value, ensure_ascii=True, sort_keys=True, separators=(",", ":"))


def record_hash(source: str, messages: object) -> str:
    """Hash of a record's source and messages: keys in order, spaced, characters as they are."""
    return _hex(json.dumps({"source": source, "messages": messages}, ensure_ascii=False, sort_keys=True))


def object_hash(value: object) -> str:
    return _hex(stable_json(value))


def file_sha256(path: str, size: int = 1 << 20) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as data:
        while block := data.read(size):
            digest.update(block)
    return digest.hexdigest()
