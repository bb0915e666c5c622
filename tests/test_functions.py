import re

from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T


def values(spark, rows, column, schema="t string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_token_estimate_equals_python(spark):
    texts = ["hello world", "", None, "a  b c", "naïve café's 3.5%", "混合 text 12", "_x_ - y", " z\x1c!"]
    wanted = [0 if t is None else len(re.findall(r"\w+|[^\w\s]", t)) for t in texts]
    assert values(spark, texts, T.token_estimate(F.col("t"))) == wanted


def test_markers(spark):
    texts = ["Chain-of-thought: hidden", "Let's think step by step now", "<think>hidden</think> final answer", "plain", None]
    counts = values(spark, texts, T.marker_total(F.col("t")))
    assert counts[:4] == [1, 1, 2, 0] and counts[4] == 0
    assert values(spark, texts, T.scrub_markers(F.col("t")))[2] == "final answer"
    assert values(spark, texts, T.marker_names(F.col("t")))[2] == ["think_close", "think_open"]


def test_strings(spark):
    assert values(spark, ["Night Main 01", "--", None], T.slug(F.col("t"))) == ["night-main-01", "main", "main"]
    assert values(spark, ["  a 　b \n c "], T.squeeze(F.col("t"))) == ["a b c"]
    assert values(spark, ["", "   ", "ok", "x�", "\x01\x02ab", None], T.garbled(F.col("t"))) == [True, True, False, True, True, True]
    assert values(spark, ["ab cd", "中文 字", ""], T.length_check(F.col("t"))) == [2, 3, 0]
    pairs = spark.createDataFrame([("a b", "B c"), ("", ""), ("x", "")], "a string, b string")
    assert [r[0] for r in pairs.select(T.jaccard(F.col("a"), F.col("b"))).collect()] == [1 / 3, 1.0, 0.0]


def test_messages(spark):
    rows = [
        ([("user", "Hi there"), ("assistant", '[{"type": "text", "text": "Line one."}, {"type": "image", "image_path": "image://x"}, {"type": "text", "text": "Line two."}]')],),
        ([(None, "[not a block list"), ("user", None)],), (None,), ([],),
    ]
    df = spark.createDataFrame(rows, "messages array<struct<role:string,content:string>>")
    got = df.select(M.texts(F.col("messages")).alias("t"), M.modality(F.lit(None).cast("string"), F.col("messages")).alias("m"), M.render_history(F.col("messages")).alias("h"), M.last_assistant(F.col("messages")).alias("a")).collect()
    assert got[0].t == ["Hi there", "Line one. Line two."] and got[0].m == "image_text" and got[0].a == "Line one. Line two."
    assert got[1].t == ["[not a block list", ""] and got[1].m == "text" and got[1].h == "USER: [not a block list"
    assert got[2].t is None and got[3].t == []
    assert df.select(M.collapse_to_text(F.col("messages")).alias("c")).first().c[1].content == "Line one.\nLine two."


def test_hash_unit_is_uniform(spark):
    mean, least, most = spark.range(4000).select(T.hash_unit("id").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(mean - 0.5) < 0.03 and least >= 0 and most < 1
