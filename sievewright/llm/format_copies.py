"""Problem 2: records identical but for white space, letter case, punctuation or field order.

``canonical_records`` gives every record its canonical key: the roles and texts of its messages in
order, or its prompt and chosen answer, whatever the layout or key order of a JSON payload.
``collapse`` keeps one representative of each class with the exact number of copies.

Defined results: a record all of whose texts are null or blank, a record with a null id and a
payload that can't be parsed belong to no class and are left out; texts of punctuation only
count as blank.  Repeated deliveries of an id are one copy.  Ties: the representative is the least
id.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.copies import classes, pairs
from sievewright.llm.records import message_lists, plain_text
from sievewright.session import materialize

_UNIT, _FIELD = "\u001f", "\u001e"


def _marks() -> str:
    """Combining marks as ranges of a character class; they are no formatting."""
    points = [p for p in range(0x300, sys.maxunicode + 1) if unicodedata.category(chr(p))[0] == "M"]
    ranges, start = [], points[0]
    for a, b in zip(points, points[1:] + [None]):
        if b != a + 1:
            ranges.append(f"\\U{start:08x}-\\U{a:08x}")
            start = b
    return "".join(ranges)


_WORDS = re.compile(f"[\\w{_marks()}]+")
_ASCII_DROP = bytes(b for b in range(128) if not chr(b).isalnum())


def canonical(text: str) -> str:
    """The text without white space, punctuation, symbols, control characters and letter case."""
    if text.isascii():
        return text.lower().encode().translate(None, _ASCII_DROP).decode()
    # Composed first, as upper-casing and lower-casing may leave a letter composed or not.
    return "".join(_WORDS.findall(unicodedata.normalize("NFC", text.casefold()).replace("_", " ")))


def messages_key(messages: list[dict] | None) -> str | None:
    """Roles and canonical texts in order; null if no message has any letter or digit."""
    parts, some = ["m"], False
    for m in messages or ():
        m = m if isinstance(m, dict) else {}
        content, role = m.get("content"), m.get("role")
        text = canonical(plain_text(content if isinstance(content, str) else json.dumps(content) if content else ""))
        some = some or bool(text)
        parts.append(f"{(role if isinstance(role, str) else '').strip().lower()}{_UNIT}{text}")
    return _FIELD.join(parts) if some else None


def pair_key(prompt: object, chosen: object) -> str | None:
    a = canonical(prompt) if isinstance(prompt, str) else ""
    b = canonical(chosen) if isinstance(chosen, str) else ""
    return _FIELD.join(("p", a, b)) if a or b else None


def prompt_text(prompt: str | None, prompt_messages: list[dict] | None) -> str:
    """The prompt; where it is null, the texts of the user messages."""
    if prompt is not None:
        return prompt
    users = [m for m in prompt_messages or () if m and (m["role"] or "").strip().lower() == "user"]
    return "\n".join(plain_text(m["content"]) for m in users)


def payload_key(payload: str | None) -> str | None:
    """The key of a JSON payload, whatever its layout and key order; null if it can't be parsed."""
    try:
        value = json.loads(payload or "")
    except ValueError:
        return None
    if not isinstance(value, dict):
        return None
    messages = value.get("messages")
    key = messages_key(messages) if isinstance(messages, list) else None
    return key or pair_key(value.get("prompt"), value.get("chosen"))


def _sft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        # By flat columns: as lists of dicts the messages would take longer than their keys.
        texts, roles = message_lists(b.column(1)), message_lists(b.column(1), "role")
        keys = [
            messages_key([{"role": r, "content": t} for r, t in zip(rs, ts)]) for rs, ts in zip(roles, texts)
        ]
        yield pa.record_batch([b.column(0), pa.array(keys, pa.string())], ["id", "key"])


def _preferences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prompts, messages, chosen = (b.column(i).to_pylist() for i in (1, 2, 3))
        keys = [pair_key(prompt_text(p, m), c) for p, m, c in zip(prompts, messages, chosen)]
        yield pa.record_batch([b.column(0), pa.array(keys, pa.string())], ["id", "key"])


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.record_batch([b.column(0), pa.array([payload_key(p) for p in b.column(1).to_pylist()], pa.string())], ["id", "key"])


def canonical_records(sft: DataFrame, preferences: DataFrame, raw: DataFrame) -> DataFrame:
    """table_name, id, key of every record of the three tables."""

    def of(name: str, df: DataFrame, function) -> DataFrame:
        return df.mapInArrow(function, "id string, key string").select(F.lit(name).alias("table_name"), "id", "key")

    return (
        of("sft_rows", sft.select(F.col("id").cast("string").alias("id"), "messages"), _sft)
        .unionByName(of("preference_rows", preferences.select(F.col("id").cast("string").alias("id"), "prompt", "prompt_messages", "chosen"), _preferences))
        .unionByName(of("raw_records", raw.select(F.col("raw_id").cast("string").alias("id"), "payload"), _raw))
    )


def membership(sft: DataFrame, preferences: DataFrame, raw: DataFrame, **limits: int) -> DataFrame:
    """table_name, id, class_id: one row for each id, its class named by the least id."""
    labelled = classes(canonical_records(sft, preferences, raw), ["table_name"], "id", "key", **limits)
    return labelled.distinct()


def collapse(sft: DataFrame, preferences: DataFrame, raw: DataFrame, **limits: int) -> DataFrame:
    """table_name, representative_id, n_copies: one row for each class."""
    return (
        membership(sft, preferences, raw, **limits)
        .groupBy("table_name", F.col("class_id").alias("representative_id"))
        .agg(F.count(F.lit(1)).alias("n_copies"))
    )


def copy_pairs(sft: DataFrame, preferences: DataFrame, raw: DataFrame, **limits: int) -> DataFrame:
    """table_name, id_a, id_b: the pairs within the classes."""
    members = materialize(membership(sft, preferences, raw, **limits), "copies")  # both sides of the pairs read it
    return pairs(members, ["table_name"], "id")
