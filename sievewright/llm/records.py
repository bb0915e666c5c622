"""Records and message texts, as Spark columns and as Arrow arrays."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCKS = "array<struct<type:string,text:string,image_path:string>>"


def content_text(content: Column) -> Column:
    """The text of a message: plain text, or the text blocks of a JSON block list joined by a space.

    A text that starts with ``[`` but is no block list stays as it is; null gives the empty text.
    """
    blocks = F.from_json(content, _BLOCKS)
    texts = F.transform(
        F.filter(blocks, lambda b: (b["type"] == "text") & b["text"].isNotNull()), lambda b: b["text"]
    )
    is_list = content.rlike(r"^\s*\[\s*\{") & blocks.isNotNull() & F.exists(blocks, lambda b: b["type"].isNotNull())
    return F.coalesce(F.when(is_list, F.array_join(texts, " ")).otherwise(content), F.lit(""))


def plain_text(content: str | None) -> str:
    """The same as :func:`content_text`, for one Python value."""
    if not content:
        return ""
    if content[0] == "[" or content[:8].lstrip()[:1] == "[":
        try:
            blocks = json.loads(content)
        except ValueError:
            return content
        if isinstance(blocks, list) and blocks and all(isinstance(b, dict) for b in blocks):
            if any(isinstance(b.get("type"), str) for b in blocks):
                return " ".join(
                    b["text"] for b in blocks if b.get("type") == "text" and isinstance(b.get("text"), str)
                )
    return content


def message_lists(column: pa.Array, field: str = "content") -> list[list[str]]:
    """Of each row of an array<struct<role, content>> column, the messages' texts or roles.

    A null row gives [], a null content or role the empty text.
    """
    offsets = column.offsets.to_pylist()
    low, high = (offsets[0], offsets[-1]) if offsets else (0, 0)
    # Only what belongs to these rows: a slice shares the values of its whole batch.
    values = column.values.field(field).slice(low, high - low).to_pylist()
    if field == "content":
        values = [plain_text(v) for v in values]
    else:
        values = [v or "" for v in values]
    return [values[i - low : j - low] if v else [] for i, j, v in zip(offsets, offsets[1:], column.is_valid().to_pylist())]


def lookup(left: DataFrame, right: DataFrame, key: str, hot_rows: int = 100_000) -> DataFrame:
    """A left join with a table that has one row for each key, which gathers at most ``hot_rows`` of
    ``left`` in a task: rows of keys with more, of which there are at most rows / ``hot_rows``, are
    joined by broadcast.  Rows with a null key are kept."""
    hot = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select(key).collect()
    null = left.where(F.col(key).isNull()).join(right.where(F.lit(False)).withColumnRenamed(key, "__none"), F.lit(False), "left").drop("__none")
    some = left.where(F.col(key).isNotNull())
    if not hot:
        return some.join(right, key, "left").unionByName(null)
    keys = F.broadcast(left.sparkSession.createDataFrame(hot, left.select(key).schema))
    few = F.broadcast(right.join(keys, key, "left_semi"))
    return some.join(keys, key, "left_anti").join(right, key, "left").unionByName(some.join(keys, key, "left_semi").join(few, key, "left")).unionByName(null)


def text_lists(batch: pa.RecordBatch, column: str) -> list[list[str]]:
    """Texts of each row: one for a string column, all messages for an array column."""
    values = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        return message_lists(values)
    return [[v] if v else [] for v in values.to_pylist()]
