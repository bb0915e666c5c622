"""Problem 1: exact token counts of every record under an existing tokenizer.

The tokenizer's normalisation and pre-splitting cut a text into pieces that it encodes apart, so
the length of a text is the sum of the lengths of its pieces.  The corpus has few distinct pieces
for its size; each is encoded once:

1. one pass over the texts writes blocks: up to ``BLOCK_RECORDS`` records with the block's distinct
   pieces and, for each record, which of them it holds how often (two sparse arrays);
2. the distinct pieces of all blocks are encoded, each once in the whole job;
3. the lengths are joined back to the blocks' piece lists and from there to the records.

Only the piece lists, which grow much slower than the text, are shuffled by piece.  A frequent
piece has one row for each block, not for each occurrence; the lengths of pieces that more than
``HOT_BLOCKS`` blocks hold, at most rows / ``HOT_BLOCKS`` of them, are broadcast, so that no task
gets all blocks.

Defined results: a null or blank text counts as its pieces (none for null and empty text); texts
that spell special tokens are ordinary text.  Very long texts are a block of their own.  Records
are not deduplicated here; ``totals`` counts a repeated id once.
"""

from __future__ import annotations

import base64
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright.llm.records import text_lists
from sievewright.session import materialize

BLOCK_RECORDS = 4096
#: Distinct pieces at which a block is closed, so that 16 bits number them.
BLOCK_PIECES = 40_000
#: Blocks that hold a piece from which its length is broadcast rather than joined by a shuffle.
HOT_BLOCKS = 100_000

#: Fixed value: the pre-splitting pattern published with the byte-level vocabularies.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters only, where the standard library's engine is faster.
_ASCII_PATTERN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)
_FULL_PATTERN = regex.compile(BYTE_LEVEL_PATTERN)


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file in a folder that all executors have: ``.tiktoken`` ranks of a byte-level BPE, or a ``.json`` tokenizer."""

    folder: str
    name: str = "byte_bpe_multi_50k.tiktoken"

    @property
    def path(self) -> str:
        return os.path.join(self.folder, self.name)

    def splitter(self) -> Callable[[str], list[str]]:
        if self.name.endswith(".tiktoken"):
            return byte_level_pieces
        return _json_splitter(self.path)

    def length(self) -> Callable[[str], int]:
        return _encoder(self.path)


def byte_level_pieces(text: str) -> list[str]:
    # \s of the two engines differs in the separators U+001C to U+001F only.
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return _ASCII_PATTERN.findall(text)
    return _FULL_PATTERN.findall(text)


@lru_cache(maxsize=4)
def _json(path: str):
    from tokenizers import Tokenizer as Json

    tokenizer = Json.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _json_splitter(path: str) -> Callable[[str], list[str]]:
    tokenizer = _json(path)

    def split(text: str) -> list[str]:
        if tokenizer.normalizer is not None:
            text = tokenizer.normalizer.normalize_str(text)
        return [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    return split


@lru_cache(maxsize=4)
def _encoder(path: str) -> Callable[[str], int]:
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("public", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda piece: len(encoding._encode_single_piece(piece))
    model = _json(path).model
    return lambda piece: len(model.tokenize(piece))


class _Ids(dict):
    """Numbers for pieces, in order of appearance."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


def _blocks(tokenizer: Tokenizer, keys: list[str], schema: pa.Schema, block_records: int, block_pieces: int):
    """mapInArrow function: records -> blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = tokenizer.splitter()
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        ids, parts, counts, numbers, freqs = _Ids(), [], [], [], []

        def close() -> pa.RecordBatch:
            nonlocal block, ids, parts, counts, numbers, freqs
            records = pa.Table.from_batches(parts).combine_chunks().to_struct_array()
            records = records.combine_chunks() if isinstance(records, pa.ChunkedArray) else records
            wide = len(ids) > 0xFFFF
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([list(ids)], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records).cast(schema.field("records").type),
                    pa.array([np.array(counts, np.int32).tobytes()], pa.binary()),
                    pa.array([np.array(numbers, np.uint32 if wide else np.uint16).tobytes()], pa.binary()),
                    pa.array([np.array(freqs, np.uint32).tobytes()], pa.binary()),
                    pa.array([wide], pa.bool_()),
                ],
                schema=schema,
            )
            block += 1
            ids, parts, counts, numbers, freqs = _Ids(), [], [], [], []
            return out

        for batch in batches:
            texts = text_lists(batch, "__text")
            plain = batch.select(keys)
            start = 0
            for row, messages in enumerate(texts):
                number = ids.__getitem__
                tally: Counter = Counter()
                for text in messages:
                    tally.update(map(number, split(text)))
                counts.append(len(tally))
                numbers.extend(tally.keys())
                freqs.extend(tally.values())
                if len(counts) >= block_records or len(ids) >= block_pieces:
                    parts.append(plain.slice(start, row + 1 - start))
                    start = row + 1
                    yield close()
            if start < plain.num_rows:
                parts.append(plain.slice(start))
        if parts:
            yield close()

    return run


def _lengths(tokenizer: Tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = tokenizer.length()
        for b in batches:
            pieces = b.column(0)
            yield pa.RecordBatch.from_arrays([pieces, b.column(1), pa.array([length(p) for p in pieces.to_pylist()], pa.int32())], ["piece", "blocks", "n"])

    return run


def _sums(fields: list[str]):
    """Blocks with the lengths of their pieces -> records with their number of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens, records, counts, numbers, freqs, wide = (b.column(b.schema.get_field_index(c)) for c in ("lens", "records", "counts", "numbers", "freqs", "wide"))
            for i in range(b.num_rows):
                n = np.asarray(lens[i].values if lens[i].is_valid else pa.array([], pa.int32()), dtype=np.int64)
                idx = np.frombuffer(numbers[i].as_buffer(), np.uint32 if wide[i].as_py() else np.uint16)
                share = n[idx] * np.frombuffer(freqs[i].as_buffer(), np.uint32) if len(idx) else np.zeros(0, np.int64)
                ends = np.cumsum(np.frombuffer(counts[i].as_buffer(), np.int32))
                total = np.concatenate(([0], np.cumsum(share)))[np.concatenate(([0], ends))]
                rows = records[i].values
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(f) for f in fields), pa.array(np.diff(total), pa.int64())], [*fields, "n_tokens"]
                )

    return run


def record_tokens(
    df: DataFrame,
    keys: list[str],
    text: str | Column,
    tokenizer: Tokenizer,
    block_records: int = BLOCK_RECORDS,
    block_pieces: int = BLOCK_PIECES,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """``keys`` and n_tokens of every row; ``text`` is a string or an array of messages."""
    source = df.select(*keys, (F.col(text) if isinstance(text, str) else text).alias("__text"))
    key_type = T.StructType([source.schema[k] for k in keys])
    fields = [f"{f.name}" for f in key_type]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()), T.StructField("pieces", T.ArrayType(T.StringType())),
            T.StructField("records", T.ArrayType(key_type)), T.StructField("counts", T.BinaryType()),
            T.StructField("numbers", T.BinaryType()), T.StructField("freqs", T.BinaryType()), T.StructField("wide", T.BooleanType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    # Written once: the split is the dear part, and both the pieces and the counts are read from it.
    blocks = materialize(
        source.mapInArrow(_blocks(tokenizer, fields, to_arrow_schema(schema), block_records, block_pieces), schema), "blocks"
    )
    listed = blocks.select("block", F.posexplode("pieces").alias("pos", "piece"))
    lengths = materialize(
        listed.groupBy("piece").agg(F.count(F.lit(1)).alias("blocks")).mapInArrow(_lengths(tokenizer), "piece string, blocks long, n int"), "lengths"
    )
    frequent = lengths.where(F.col("blocks") > hot_blocks).select("piece", "n").collect()  # at most rows / hot_blocks
    joined = listed.join(lengths.where(F.col("blocks") <= hot_blocks).select("piece", "n"), "piece")
    if frequent:
        hot = F.broadcast(df.sparkSession.createDataFrame(frequent, "piece string, n int"))
        joined = listed.join(hot, "piece", "left_anti").join(lengths.select("piece", "n"), "piece").unionByName(listed.join(hot, "piece"))
    known = joined.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "n"))), lambda x: x["n"]).alias("lens"))
    out = T.StructType([*key_type, T.StructField("n_tokens", T.LongType())])
    return blocks.select("block", "records", "counts", "numbers", "freqs", "wide").join(known, "block", "left").mapInArrow(_sums(fields), out)


def clean_label(name: str, missing: str = "unknown") -> Column:
    """A label in lower case without blanks and invisible characters; null and empty become ``missing``."""
    plain = F.lower(F.regexp_replace(F.col(name), r"[\s\p{Z}\p{C}]+", ""))
    return F.when(plain.isNull() | (plain == ""), F.lit(missing)).otherwise(plain)


def corpus_tokens(docs: DataFrame, sft: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """table_name, record_id, source, language, category, n_tokens of each record of both tables.

    A repeated id is one record, the latest delivered.
    """
    keys = ["table_name", "record_id", "source", "language", "category", "at"]
    labelled = docs.select(
        F.lit("documents").alias("table_name"), F.col("doc_id").cast("string").alias("record_id"), clean_label("source").alias("source"),
        clean_label("lang").alias("language"), clean_label("category").alias("category"), F.col("collected_at").cast("timestamp").alias("at"), "text",
    )
    rows = sft.select(
        F.lit("sft_rows").alias("table_name"), F.col("id").alias("record_id"), clean_label("source_id").alias("source"),
        clean_label("language").alias("language"), clean_label("category").alias("category"), F.col("ingested_at").cast("timestamp").alias("at"), "messages",
    )
    counted = record_tokens(labelled, keys, "text", tokenizer).unionByName(record_tokens(rows, keys, "messages", tokenizer))
    last = F.max(F.struct(F.coalesce(F.col("at"), F.lit(0).cast("timestamp")).alias("at"), "source", "language", "category", "n_tokens")).alias("x")
    return counted.groupBy("table_name", "record_id").agg(last).select(
        "table_name", "record_id", "x.source", "x.language", "x.category", "x.n_tokens"
    )


def totals(counted: DataFrame) -> DataFrame:
    """Records and tokens by source, by language, by category, by all three and in all."""
    names = ["source", "language", "category"]
    by = counted.groupingSets(
        [["table_name", *[F.col(n) for n in names]], ["table_name", "source"], ["table_name", "language"], ["table_name", "category"], ["table_name"]],
        "table_name", *names,
    ).agg(F.count(F.lit(1)).alias("n_records"), F.sum("n_tokens").alias("n_tokens"), F.grouping_id().alias("grouping"))
    return by


def against_reports(counted: DataFrame, reports: DataFrame) -> DataFrame:
    """Each earlier run's counted tokens beside the tokens of the conversation rows counted here.

    Of a run reported twice the latest report holds; a null total stays null.
    """
    from pyspark.sql import Window

    latest = Window.partitionBy("run_id").orderBy(F.col("generated_at").desc_nulls_last())
    runs = reports.withColumn("__r", F.row_number().over(latest)).where("__r = 1").select(
        "run_id", F.col("counts.sft_tokens_total").alias("reported_tokens")
    )
    here = counted.where(F.col("table_name") == "sft_rows").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("counted_tokens"))
    # One row of totals beside a handful of runs.
    return runs.join(F.broadcast(here), F.lit(True)).withColumn("ratio", F.col("counted_tokens") / F.col("reported_tokens"))
