"""Records of many upstream layouts as canonical conversations and preference triplets.

A record is JSON text.  It is parsed once with a schema that names every field of the known
layouts; which of them is filled decides, in a fixed order, what the record is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.messages import role
from sievewright.functions.text import squeeze

# Field names of the known layouts, in the order in which they are tried.
CONVERSATIONS = ("messages", "conversation", "conversations", "turns", "context")
PROMPTS = ("prompt", "instruction", "question", "input", "inputs")
RESPONSES = ("response", "output", "answer", "chosen", "targets")
PAIRS = (("response1", "response2"), ("answer1", "answer2"), ("candidate1", "candidate2"))
LETTER_PAIRS = (("response_a", "response_b"), ("answer_a", "answer_b"), ("candidate_a", "candidate_b"))
WINNERS = ("winner", "label", "preference")
FIRST, SECOND = ("A", "LEFT", "1", "CHOICE_A"), ("B", "RIGHT", "2", "CHOICE_B")

_TURN = "array<struct<role:string,from:string,content:string,text:string,value:string>>"
SCHEMA = "struct<" + ",".join(
    [f"{c}:{_TURN}" for c in CONVERSATIONS]
    + [f"{c}:string" for c in (*PROMPTS, *RESPONSES, "rejected", *WINNERS, *(x for p in (*PAIRS, *LETTER_PAIRS) for x in p), "overall_preference", "lang")]
    + ["individual_preference:array<struct<score:string>>"]
) + ">"


def parse(text: Column) -> Column:
    """The record as a struct; null if it is no JSON object."""
    return F.when(F.trim(text).startswith("{"), F.from_json(text, SCHEMA))


def first_text(*candidates: Column) -> Column:
    """The first that isn't blank, with its white space collapsed; empty if none."""
    return F.coalesce(*[F.nullif(squeeze(c), F.lit("")) for c in candidates], F.lit(""))


def conversation(record: Column) -> Column:
    """Turns of the first field that yields a user and an assistant, else prompt and response, else null."""
    options = []
    for name in CONVERSATIONS:
        turns = F.transform(
            record[name],
            lambda m: F.struct(role(F.coalesce(m["role"], m["from"])).alias("role"), squeeze(F.coalesce(m["content"], m["text"], m["value"], F.lit(""))).alias("content")),
        )
        kept = F.filter(turns, lambda m: (m["role"] != "") & (m["content"] != ""))
        both = F.exists(kept, lambda m: m["role"] == "user") & F.exists(kept, lambda m: m["role"] == "assistant")
        options.append(F.when(both, kept))
    prompt, answer = first_text(*[record[c] for c in PROMPTS]), first_text(*[record[c] for c in RESPONSES])
    pair = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    return F.coalesce(*options, F.when((prompt != "") & (answer != ""), pair))


def history(record: Column) -> Column:
    """The context turns as ROLE: text lines."""
    turns = F.filter(record["context"], lambda m: squeeze(F.coalesce(m["content"], m["text"], m["value"], F.lit(""))) != "")
    return F.array_join(
        F.transform(turns, lambda m: F.concat(F.upper(F.coalesce(m["role"], m["from"], F.lit("user"))), F.lit(": "), squeeze(F.coalesce(m["content"], m["text"], m["value"])))), "\n"
    )


def preferred(record: Column) -> Column:
    """The preferred answer of a record that has a pair of them; null if it has none."""
    return pair(record)[0]


def pair(record: Column) -> tuple[Column, Column]:
    """Preferred and other answer: chosen and rejected, else two numbered responses by their scores."""
    options = _scored(record)
    both = [F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b"))) for a, b in options]
    found = F.coalesce(*both)
    return found["a"], found["b"]


def triplet(record: Column) -> Column:
    """prompt, chosen, rejected; null where no answer is preferred.

    In order: chosen and rejected themselves; two numbered responses by the sign of the overall
    preference or of the summed individual scores, below zero for the first; lettered responses
    by the winner's name.
    """
    options = _scored(record)
    winner = F.upper(F.trim(F.coalesce(*[record[w] for w in WINNERS])))
    for a, b in LETTER_PAIRS:
        x, y = F.nullif(squeeze(record[a]), F.lit("")), F.nullif(squeeze(record[b]), F.lit(""))
        options.append((F.when(winner.isin(*FIRST), x).when(winner.isin(*SECOND), y), F.when(winner.isin(*FIRST), y).when(winner.isin(*SECOND), x)))
    prompt = F.coalesce(F.nullif(history(record), F.lit("")), F.nullif(first_text(*[record[c] for c in PROMPTS]), F.lit("")))
    found = [F.when(prompt.isNotNull() & c.isNotNull() & r.isNotNull(), F.struct(prompt.alias("prompt"), c.alias("chosen"), r.alias("rejected"))) for c, r in options]
    return F.coalesce(*found)


def _scored(record: Column) -> list[tuple[Column, Column]]:
    options = [(F.nullif(squeeze(record["chosen"]), F.lit("")), F.nullif(squeeze(record["rejected"]), F.lit("")))]
    summed = F.aggregate(F.coalesce(record["individual_preference"], F.array().cast("array<struct<score:string>>")), F.lit(0.0), lambda a, x: a + F.coalesce(x["score"].try_cast("double"), F.lit(0.0)))
    score = F.coalesce(record["overall_preference"].try_cast("double"), summed)
    for a, b in PAIRS:
        x, y = F.nullif(squeeze(record[a]), F.lit("")), F.nullif(squeeze(record[b]), F.lit(""))
        options.append((F.when(score < 0, x).when(score > 0, y), F.when(score < 0, y).when(score > 0, x)))
    return options


def rows(df: DataFrame, payload: str) -> DataFrame:
    """The table with record, conversation and triplet of each payload."""
    parsed = df.withColumn("record", parse(F.col(payload)))
    return parsed.withColumn("conversation", conversation(F.col("record"))).withColumn("triplet", triplet(F.col("record")))


def stream_plan(sources: DataFrame, overrides: dict[str, tuple[str, str]], skipped: dict[str, str], split: str = "train", subset: str = "default") -> DataFrame:
    """Each source's subset and split, or why it is skipped; the tables are literals."""
    spark = sources.sparkSession
    known = spark.createDataFrame([(k, *v) for k, v in overrides.items()], "source_id string, o_subset string, o_split string")
    left_out = spark.createDataFrame(list(skipped.items()), "source_id string, reason string")
    return (
        sources.join(F.broadcast(known), "source_id", "left").join(F.broadcast(left_out), "source_id", "left")
        .select(
            "source_id", F.when(F.col("reason").isNull(), F.coalesce("o_subset", F.lit(subset))).alias("subset"),
            F.when(F.col("reason").isNull(), F.coalesce("o_split", "default_split", F.lit(split))).alias("split"),
            F.when(F.col("reason").isNull(), "planned").otherwise("skipped").alias("status"), "reason",
        )
    )
