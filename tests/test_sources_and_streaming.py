import json

import pytest
from pyspark.sql import functions as F

from sievewright.sources import jsonl, sinks
from sievewright.streaming.ingest import ingest, windowed_counts


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_strict_and_tolerant(spark, tmp_path):
    good = json.dumps({"id": "a", "messages": [{"role": "user", "content": "é"}]}, ensure_ascii=False)
    path = write(tmp_path / "x.jsonl", [good, "", "{broken", good])
    with pytest.raises(Exception):
        jsonl.read_strict(spark, path).collect()
    quality = jsonl.line_quality(spark, path).first()
    assert (quality.n_good, quality.n_bad, quality.bad_line) == (2, 1, "{broken")
    only = write(tmp_path / "y.jsonl", [good, "", good])
    assert [r.messages[0].content for r in jsonl.read_strict(spark, only).collect()] == ["é", "é"]


def test_chunks_in_order(spark, tmp_path):
    for name in ("sft_chunk_0002.jsonl", "sft_chunk_0001.jsonl", "notes.jsonl"):
        write(tmp_path / name, [json.dumps({"id": name})])
    rows = jsonl.read_chunks(spark, str(tmp_path), "sft_chunk_????.jsonl").orderBy("chunk").collect()
    assert [r.id for r in rows] == ["sft_chunk_0001.jsonl", "sft_chunk_0002.jsonl"]


def test_payloads(spark):
    df = spark.createDataFrame([('{"prompt": "p", "lang": "en"}',), ("{oops",), ("[1]",), (None,)], "payload string")
    assert [r.parsed.prompt if r.parsed else None for r in jsonl.parse_payloads(df).collect()] == ["p", None, None, None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "k string, v string")
    sinks.write_jsonl(df, f"file://{tmp_path}/out")
    assert json.loads(spark.read.text(f"file://{tmp_path}/out").first()[0]) == {"k": "a", "v": None}
    sinks.write_report({"b": 1}, str(tmp_path / "r" / "report.json"))
    digest = sinks.file_sha256(str(tmp_path / "r" / "report.json"))
    assert [r.sha256 for r in sinks.checksums(spark, f"file://{tmp_path}/r").collect()] == [digest]


def test_ingest_once(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    schema = "id string, p string, a string"
    spark.createDataFrame([("1", "Q", "x"), ("2", "q ", "X")], schema).coalesce(1).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        ingest(spark, source, schema, f"file://{tmp_path}/out", f"file://{tmp_path}/state", "p", "a", "id")
    spark.createDataFrame([("3", "Q", "x"), ("4", "other", "x")], schema).coalesce(1).write.mode("append").parquet(source)
    ingest(spark, source, schema, f"file://{tmp_path}/out", f"file://{tmp_path}/state", "p", "a", "id")
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["1", "4"]


def test_windows(spark):
    df = spark.createDataFrame([("2025-01-01 00:10:00", "a", 1.0), ("2025-01-01 00:50:00", "a", 2.0), ("2025-01-01 01:00:00", "a", 4.0)], "t string, event_type string, value double").withColumn("ts", F.col("t").cast("timestamp"))
    assert sorted(r.total_value for r in windowed_counts(df).collect()) == [3.0, 4.0]


def test_a_failed_batch_is_repeated_once(spark, tmp_path):
    """A batch that fails between its two writes runs again and leaves no row twice and none out."""
    source, schema = f"file://{tmp_path}/in", "id string, p string, a string"
    out, state = f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    failing = {1}

    def fail(number):
        if number in failing:
            failing.discard(number)
            raise OSError("lost")

    for k in range(3):
        spark.createDataFrame([(f"{k}a", f"q{k}", "x"), (f"{k}b", f"q{max(0, k - 1)}", "x"), (f"{k}c", f"q{k}", "x")], schema).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, source, schema, out, state, "p", "a", "id", kind="pref", before_commit=fail)
    ingest(spark, source, schema, out, state, "p", "a", "id", kind="pref", before_commit=fail)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == ["0a", "1a", "2a"] and all(r.signature.startswith("pref:") for r in rows)
