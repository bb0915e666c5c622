import json

from pyspark.sql import functions as F

from sievewright.operators import mixing
from sievewright.sources import upstream

RECORDS = [
    {"conversations": [{"from": "human", "value": "Hi\n there"}, {"from": "gpt", "value": "Hello"}]},
    {"conversation": [{"role": "system", "content": "s"}, {"from": "human", "value": "  "}]},
    {"inputs": "ask", "targets": "tell"},
    {"context": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}, {"content": "c"}], "response1": "x\ny", "response2": "z", "overall_preference": -2},
    {"prompt": "q", "response1": "x", "response2": "y", "individual_preference": [{"score": 2}, {"score": -2}, {"score": -1}, {"score": "bad"}]},
    {"prompt": "q", "answer_a": "x", "answer_b": "y", "winner": "right"},
    {"prompt": "q", "response1": "x", "response2": "y", "overall_preference": 0},
    {"prompt": "q", "chosen": "c", "rejected": "r"},
    "broken", None, [1],
]


def parsed(spark):
    texts = [(i, r if r in ("broken", None) else json.dumps(r)) for i, r in enumerate(RECORDS)]
    return upstream.rows(spark.createDataFrame(texts, "i int, payload string"), "payload").orderBy("i").collect()


def test_conversations(spark):
    rows = [r.conversation and [(m.role, m.content) for m in r.conversation] for r in parsed(spark)]
    assert rows[0] == [("user", "Hi there"), ("assistant", "Hello")] and rows[1] is None
    assert rows[2] == [("user", "ask"), ("assistant", "tell")]
    assert rows[8] is None and rows[9] is None and rows[10] is None


def test_triplets(spark):
    rows = [r.triplet and tuple(r.triplet) for r in parsed(spark)]
    assert rows[3] == ("USER: a\nASSISTANT: b\nUSER: c", "x y", "z")
    assert rows[4] == ("q", "x", "y") and rows[5] == ("q", "y", "x") and rows[6] is None and rows[7] == ("q", "c", "r")
    assert rows[0] is None and rows[8] is None


def test_stream_plan(spark):
    df = spark.createDataFrame([("a", "dev"), ("b", None), ("c", None)], "source_id string, default_split string")
    got = {r.source_id: (r.subset, r.split, r.status, r.reason) for r in upstream.stream_plan(df, {"b": ("sub", "test")}, {"c": "why"}).collect()}
    assert got == {"a": ("default", "dev", "planned", None), "b": ("sub", "test", "planned", None), "c": (None, None, "skipped", "why")}


def test_bucket_counts(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("b", 0.1, 2)], "k string, s double, o int")
    assert {r.k: r.allocated for r in mixing.bucket_counts(df, "k", "s", "o", 7).collect()} == {"a": 4, "b": 3}
    assert mixing.bucket_counts(df.where(F.lit(False)), "k", "s", "o", 7).count() == 0
