"""Rows made from seeds, and how batches of rows come together: cycles, merges, fills and packs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.operators import rubric
from sievewright.operators.dedupe import first_of_each, not_in_ledger
from sievewright.operators.order import numbered


def pick(values: list[str], key: Column, shift: int = 1) -> Column:
    """The value that a key's hash points to; other places of the hash give other picks."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (T.hash_index(key, len(values), shift) + 1).cast("int"))


def by_weight(weights: dict[str, float], key: Column, seed: int) -> Column:
    """A name drawn by weight from the hash of a key."""
    names, total, upto = sorted(weights), sum(weights.values()), 0.0
    u, bounds = T.hash_unit(key, seed), []
    for name in names[:-1]:
        upto += weights[name] / total
        bounds.append((upto, name))
    return reduce(lambda out, b: F.when(u < b[0], F.lit(b[1])).otherwise(out), reversed(bounds), F.lit(names[-1]))


def prompt(templates: dict[str, dict[str, str]], category: Column, language: Column, image: Column, fallback: str = "en", mark: str = "<IMAGE_CONTEXT>", context: str = "") -> Column:
    """The template of a category in a language, in the fallback's or in any; its image mark replaced where there is one."""
    table = {f"{c}/{lang}": t for c, by in templates.items() for lang, t in by.items()}
    usual = {c: by.get(fallback, next(iter(by.values()))) for c, by in templates.items() if by}
    text = F.coalesce(M.mapped(table, F.concat(category, F.lit("/"), F.coalesce(language, F.lit("")))), M.mapped(usual, category))
    return F.trim(F.when(image, F.replace(text, F.lit(mark), F.lit(context))).otherwise(F.replace(text, F.lit(mark), F.lit(""))))


def message_payload(user: Column, assistant: Column, image: Column, reference: Column) -> Column:
    """The two messages of a generated row as block lists, with a placeholder image before the user's text where there is one."""
    none = F.lit(None).cast("string")
    text = lambda t: F.struct(F.lit("text").alias("type"), t.alias("text"), none.alias("image"))
    shown = F.struct(F.lit("image").alias("type"), none.alias("text"), reference.alias("image"))
    turn = lambda role, blocks: F.struct(F.lit(role).alias("role"), blocks.alias("content"))
    return F.array(turn("user", F.when(image, F.array(shown, text(user))).otherwise(F.array(text(user)))), turn("assistant", F.array(text(assistant))))


def cycles(df: DataFrame, seed: str, order: str, name: str = "cycle") -> DataFrame:
    """How many rows of the same seed come before each row."""
    return numbered(df, [order], name, [seed]).withColumn(name, F.col(name) - 1)


def candidates(seeds: DataFrame, fragments: list[list[str]], variants: int = 3, cycle: Column | None = None) -> DataFrame:
    """The seeds with variant and answer: of each seed so many answers, put together of one fragment from each list."""
    rows = seeds.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    key = F.concat_ws("|", F.col("seed_id").cast("string"), F.col("variant").cast("string"), (F.lit(0) if cycle is None else cycle).cast("string"))
    # Each list reads another part of the hash.
    return rows.withColumn("answer", F.concat_ws(" ", *[pick(values, key, 1 + 8 * (i % 4)) for i, values in enumerate(fragments)]))


def generate(seeds: DataFrame, fragments: list[list[str]], scorer: rubric.Rubric, target: int, variants: int = 3, min_score: float = rubric.MIN_SCORE, row_id: str = "row-%07d") -> DataFrame:
    """id, seed_id, prompt, answer, score: the best answer of each seed that scores enough, each pair of prompt and
    answer once, the first ``target`` of them.  ``seeds``: seed_id, prompt, category, language."""
    scored = candidates(seeds, fragments, variants).withColumn("score", scorer.total(F.col("answer"), F.col("language"), F.col("category")))
    best = rubric.best_of(scored.select("seed_id", "variant", "score", "prompt", "answer"), ["seed_id"], "score", "variant").where(F.col("score") >= min_score)
    once = first_of_each(best.withColumn("__signature", T.signature(F.col("prompt"), F.col("answer"))), "__signature", "seed_id")
    rows = truncate(once, ["seed_id"], target, "__n")
    return rows.select(F.format_string(row_id, "__n").alias("id"), "seed_id", "prompt", "answer", "score")


def truncate(df: DataFrame, order: list[str], n: int, name: str = "__n") -> DataFrame:
    """The first rows by order, with their number."""
    return numbered(df, order, name).where(F.col(name) <= n)


def merge(parts: list[DataFrame], key: str, order: str) -> DataFrame:
    """All rows of the parts that are first of their key; earlier parts come first, then the order within."""
    tagged = [df.withColumn("__part", F.lit(i)) for i, df in enumerate(parts)]
    return first_of_each(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), key, "__part", order).drop("__part")


def fill_chunk(df: DataFrame, ledger: DataFrame, key: str, order: str, target: int) -> DataFrame:
    """The first ``target`` rows by order whose key is new, each key once: surplus rows stand in for duplicates."""
    return truncate(not_in_ledger(first_of_each(df, key, order), ledger, key), [order], target).drop("__n")


def stress_pack(df: DataFrame, categories: list[str], order: str, size: int = 60, languages: tuple[str, ...] = ("ar", "ru", "zh")) -> DataFrame:
    """place and the row: the first row of each category in the given order, then the first rows with pictures in
    languages of other scripts, up to ``size`` in all; a row may come twice."""
    places = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(categories)), "place int, category string"))  # one row a category
    first = first_of_each(df.where(F.col("category").isin(*categories)), "category", order).join(places, "category")
    found = first.count()  # at most one a category
    more = df.where(F.col("language").isin(*languages) & F.col("multimodal")).orderBy(order).limit(max(0, size - found)).withColumn("place", F.lit(len(categories)))
    return first.unionByName(more)


def spot_checks(df: DataFrame, key: str, n: int = 25, seed: int = 3407) -> DataFrame:
    """The same few rows every time, whatever their order."""
    return df.withColumn("__u", T.hash_unit(key, seed)).orderBy("__u", key).limit(n).drop("__u")


def seed_table(spark: SparkSession, n: int, weights: dict[str, float], languages: list[str], image_category: str, image_share: float = 0.95) -> DataFrame:
    """seed_id, category, language, multimodal of ``n`` seeds, from the hashes of their numbers."""
    rows = spark.range(n)
    key = F.col("id").cast("string")
    category = by_weight(weights, key, 1)
    language = pick(languages, F.concat(F.lit("language/"), key))
    return rows.select(F.format_string("seed-%05d", F.col("id") + 1).alias("seed_id"), category.alias("category"), language.alias("language"), ((category == image_category) & (T.hash_unit(key, 3) < image_share)).alias("multimodal"))
