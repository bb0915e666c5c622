"""Incremental ingestion: micro-batches deduplicated against a ledger, each batch written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievewright.functions.text import signature
from sievewright.operators.dedupe import first_of_each, not_in_ledger
from sievewright.sources.sinks import LEDGER, append_ledger


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Signatures of earlier batches, on any file system; an empty table where there are none yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def deduplicate_batch(batch: DataFrame, path: str, prompt: str, answer: str, order: str, number: int, kind: str = "") -> DataFrame:
    """The rows of a batch that are first of their signature and in no earlier batch.

    ``kind`` sets records of different sorts apart in one ledger.  The ledger is laid out by the head
    of the signature, so that a small batch reads only the folders that it can meet.
    """
    signed = batch.withColumn("signature", F.concat(F.lit(f"{kind}:" if kind else ""), signature(F.col(prompt), F.col(answer))))
    fresh = first_of_each(signed, "signature", order).withColumn("head", head("signature"))
    earlier = ledger(batch.sparkSession, path).where(F.col("batch") != number)
    return not_in_ledger(fresh, earlier, "head", "signature").drop("head")


def head(column: str):
    """The first two digits of a signature, behind its kind."""
    return F.substring(F.substring_index(F.col(column), ":", -1), 1, 2)


def ingest(
    spark: SparkSession, source: str, schema: StructType | str, target: str, state: str, prompt: str, answer: str, order: str,
    files_per_batch: int = 1, kind: str = "", before_commit=None,
) -> None:
    """Reads what is new in a folder of parquet files and writes its new records.

    A batch goes to a folder of its own number, so that one repeated after a failure replaces itself,
    and is read back from there for the ledger; the ledger, not the streaming state, remembers
    signatures and can grow on disk.  A batch fails between its two writes without harm: its rows are
    not in the ledger of other batches yet, and when it is run again it overwrites both.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{target}/batch={number}"
        deduplicate_batch(batch, f"{state}/ledger", prompt, answer, order, number, kind).write.mode("overwrite").parquet(folder)
        if before_commit:
            before_commit(number)
        append_ledger(spark.read.parquet(folder), f"{state}/ledger", "signature", number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by window and type; works on a stream, where late ones are dropped, and on a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")
    ).select(F.col("w.start").alias("window_start"), "event_type", "n_events", "total_value")


def stream_windowed_counts(spark: SparkSession, source: str, schema: StructType | str, target: str, state: str, files_per_batch: int = 1, size: str = "1 hour", late: str = "2 hours") -> None:
    """The counts of all windows that the watermark has closed, appended to a folder as they close."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        windowed_counts(events, size, late).writeStream.outputMode("append").format("parquet").option("path", target)
        .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
