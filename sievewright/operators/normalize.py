"""Rows of older and foreign layouts brought to canonical ones.

Contents are plain text, or the JSON text of a block list.  Fixed values: the defaults of missing fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.sources import upstream

NO_PROMPT, NO_RESPONSE = "No prompt provided", "No response provided"
NO_CHOSEN, NO_REJECTED = "No chosen response provided", "No rejected response provided"
LICENSE = "operator_provided"


def filled(c: Column) -> Column:
    """The text, null if it is blank."""
    return F.when(T.strip(c) != "", c)


def first_filled(*columns: Column | None, default: str = "unknown") -> Column:
    """The first that isn't blank, trimmed."""
    return F.coalesce(*[F.when(T.strip(c) != "", T.strip(c)) for c in columns if c is not None], F.lit(default))


def source_id(own: Column, older: Column | None = None) -> Column:
    return first_filled(own, older)


def language(own: Column, meta: Column | None = None) -> Column:
    """The language of the row's metadata, else its own."""
    return first_filled(meta, own)


def column(df: DataFrame, *names: str) -> Column:
    """The first of the columns that a table has and that isn't null; null if it has none."""
    found = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def identity_modality(declared: Column, flag: Column, messages: Column) -> Column:
    """As :func:`messages.modality`, with an older flag asked before the blocks."""
    said = F.lower(T.strip(declared))
    return (
        F.when(said.isin("image_text", "multimodal"), "image_text").when(said == "text", "text")
        .when(F.coalesce(flag, F.lit(False)), "image_text").when(M.has_image(messages), "image_text").otherwise("text")
    )


def chat(user: Column, assistant: Column) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("user", user), turn("assistant", assistant))


def identity_rows(df: DataFrame) -> DataFrame:
    """Conversation rows of the identity pack in the validator's form; a missing conversation is made of prompt and response."""
    own = F.col("messages") if "messages" in df.columns else F.lit(None).cast(f"array<{M.TURN}>")
    made = chat(F.coalesce(filled(column(df, "prompt", "user")), F.lit(NO_PROMPT)), F.coalesce(filled(column(df, "response", "output", "assistant")), F.lit(NO_RESPONSE)))
    flag = F.col("multimodal").cast("boolean") if "multimodal" in df.columns else F.lit(None).cast("boolean")
    return df.select(
        F.lit("1.0").alias("schema_version"), F.col("id").cast("string").alias("id"), F.coalesce(F.nullif(column(df, "source_id", "source"), F.lit("")), F.lit("identity_pack")).alias("source_id"),
        F.coalesce(F.nullif(column(df, "license"), F.lit("")), F.lit(LICENSE)).alias("license"), F.lit("off").alias("thinking"), F.lit(False).alias("enable_thinking"),
        identity_modality(column(df, "modality"), flag, F.coalesce(own, F.array().cast(f"array<{M.TURN}>"))).alias("modality"), F.coalesce(own, made).alias("messages"),
    )


def preference_rows(df: DataFrame, identity: bool = False) -> DataFrame:
    """Preference rows for reports, or with ``identity`` those of the identity pack in the validator's form.

    A blank prompt is made of the prompt messages: for reports of all plain contents, for the identity
    pack of the texts of all messages.
    """
    turns = F.col("prompt_messages") if "prompt_messages" in df.columns else F.lit(None).cast(f"array<{M.TURN}>")
    if identity:
        parts = F.transform(turns, lambda m: M.content_text(m["content"]))
    else:
        parts = F.transform(F.filter(turns, lambda m: m["content"].isNotNull() & ~M.is_blocks(m["content"])), lambda m: m["content"])
    prompt = F.coalesce(filled(F.col("prompt")), F.nullif(T.strip(F.array_join(parts, " ")), F.lit("")), F.lit(NO_PROMPT))
    text = lambda c, default: F.coalesce(filled(F.col(c)) if identity else F.col(c), F.lit(default))
    source = F.coalesce(F.nullif(column(df, "source_id", "source"), F.lit("")), F.lit("identity_pack_preferences")) if identity else source_id(column(df, "source_id"), column(df, "source"))
    rest = [F.coalesce(F.nullif(column(df, "license"), F.lit("")), F.lit(LICENSE)).alias("license")] if identity else []
    return df.select(F.col("id").cast("string").alias("id"), source.alias("source_id"), *rest, prompt.alias("prompt"), text("chosen", NO_CHOSEN if identity else "").alias("chosen"), text("rejected", NO_REJECTED if identity else "").alias("rejected"))


def storage_messages(messages: Column) -> Column:
    """Messages as block lists: plain text as it is, texts of lists collapsed, what is empty left out."""
    plain = lambda c: F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), *[F.lit(None).cast("string").alias(n) for n in M.IMAGE_FIELDS]))

    def block(b: Column) -> Column:
        return F.struct(b["type"].alias("type"), F.when(b["type"] == "text", T.squeeze(b["text"])).alias("text"), *[F.when(b["type"] == "image", F.nullif(T.strip(b[n]), F.lit(""))).alias(n) for n in M.IMAGE_FIELDS])

    def blocks(c: Column) -> Column:
        kept = F.filter(F.from_json(c, M.BLOCKS), lambda b: ((b["type"] == "text") & (F.coalesce(T.squeeze(b["text"]), F.lit("")) != "")) | (b["type"] == "image"))
        return F.transform(kept, block)

    turns = F.transform(
        F.filter(messages, lambda m: m["content"].isNotNull()),
        lambda m: F.struct(F.coalesce(F.nullif(m["role"], F.lit("")), F.lit("user")).alias("role"), F.when(M.is_blocks(m["content"]), blocks(m["content"])).otherwise(plain(m["content"])).alias("content")),
    )
    return F.filter(turns, lambda m: F.size(m["content"]) > 0)


def canonical_messages(messages: Column) -> Column:
    """Messages of the three roles, roles in small letters, texts collapsed; of block lists the texts and named images.
    A block list comes out as text and image parts, plain text as its text; a list without either is left out."""
    role = lambda m: F.lower(T.strip(F.coalesce(m["role"], F.lit(""))))

    def text(m: Column) -> Column:
        parts = F.filter(F.from_json(m["content"], M.BLOCKS), lambda b: ((b["type"] == "text") & b["text"].isNotNull()) | ((b["type"] == "image") & b["image"].isNotNull()))
        joined = F.transform(parts, lambda b: F.when(b["type"] == "text", F.concat(F.lit("text:"), T.squeeze(b["text"]))).otherwise(F.concat(F.lit("image:"), b["image"])))
        return F.when(M.is_blocks(m["content"]), F.when(F.size(joined) > 0, F.array_join(joined, "|"))).otherwise(T.squeeze(m["content"]))

    kept = F.filter(messages, lambda m: role(m).isin("system", "user", "assistant"))
    return F.filter(F.transform(kept, lambda m: F.struct(role(m).alias("role"), text(m).alias("content"))), lambda m: m["content"].isNotNull())


def user_prompts(messages: Column) -> Column:
    """The texts of the user, collapsed, joined by spaces."""
    return F.array_join(F.filter(F.transform(M.texts(messages, "user"), T.squeeze), lambda t: t != ""), " ")


def approximate_text(messages: Column) -> Column:
    """All texts, collapsed, and ``[image]`` for each image, in lines."""
    def parts(m: Column) -> Column:
        blocks = F.transform(F.from_json(m["content"], M.BLOCKS), lambda b: F.when(b["type"] == "text", T.squeeze(b["text"])).when(b["type"] == "image", F.lit("[image]")))
        return F.when(M.is_blocks(m["content"]), blocks).otherwise(F.array(T.squeeze(m["content"])))

    flat = F.flatten(F.transform(F.filter(messages, lambda m: m["content"].isNotNull()), parts))
    return F.array_join(F.filter(flat, lambda t: F.coalesce(t, F.lit("")) != ""), "\n")


def text_only(df: DataFrame, messages: str = "messages") -> DataFrame:
    """The rows for training on text: contents collapsed, modality text, and whether a row held images.
    A table with real images, not just placeholders, is an error when its rows are read."""
    held = M.has_image(F.col(messages))
    return df.withColumn("collapsed", held).withColumn(
        messages, F.when(concrete_image(F.col(messages)), F.raise_error(F.lit("a row holds a real image")).cast(df.schema[messages].dataType)).otherwise(M.collapse_to_text(F.col(messages)))
    ).withColumn("modality", F.lit("text"))


def image_kinds(messages: Column) -> Column:
    """How each image of the messages is referred to."""
    blocks = F.flatten(F.transform(F.filter(messages, lambda m: M.is_blocks(m["content"])), lambda m: F.from_json(m["content"], M.BLOCKS)))
    return F.transform(F.filter(blocks, lambda b: b["type"] == "image"), M.image_kind)


def concrete_image(messages: Column) -> Column:
    return F.coalesce(F.exists(image_kinds(messages), lambda k: k.isin("image_path", "image_path_like", "image_bytes_b64")), F.lit(False))


def surface(rows: DataFrame, messages: str = "messages") -> DataFrame:
    """One row: rows, rows with images, with placeholders, with real images, and what they can be trained on."""
    kinds = image_kinds(F.col(messages))
    has = lambda *names: F.coalesce(F.exists(kinds, lambda k: k.isin(*names)), F.lit(False))
    counts = rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.coalesce(F.size(kinds) > 0, F.lit(False))).alias("multimodal_rows"),
        F.count_if(has("placeholder_uri")).alias("placeholder_image_rows"), F.count_if(has("image_path", "image_path_like", "image_bytes_b64")).alias("concrete_image_rows"),
    )
    state = F.when(F.col("multimodal_rows") == 0, "text_only_native").when((F.col("concrete_image_rows") == 0) & (F.col("placeholder_image_rows") > 0), "text_only_placeholder_fallback")
    return counts.withColumn("training_surface", state.otherwise("unverified_concrete_multimodal"))


def asset_name(record_id: Column, reference: Column) -> Column:
    """The fixed name of the picture that stands for a placeholder."""
    return F.concat(F.substring(F.sha2(F.concat(record_id, F.lit("::"), reference), 256), 1, 20), F.lit(".png"))


def text_rows(df: DataFrame, payload: str, row_id: str, source: str, appended: tuple[str, ...] = ()) -> DataFrame:
    """id, source_id, chat: records of any known layout as conversations; null where none can be made.

    For the sources ``appended``, whose conversations end before the preferred answer, that answer is put at their end.
    """
    rows = upstream.rows(df, payload)
    chosen = upstream.preferred(F.col("record"))
    turn = F.struct(F.lit("assistant").alias("role"), chosen.alias("content"))
    open_end = F.col("conversation").isNotNull() & (F.element_at("conversation", -1)["role"] != "assistant") & F.col(source).isin(*appended) if appended else F.lit(False)
    made = F.when(open_end & chosen.isNotNull(), F.array_append("conversation", turn)).otherwise(F.col("conversation"))
    return rows.select(F.col(row_id).alias("id"), F.col(source).alias("source_id"), made.alias("chat"))


def image_rows(df: DataFrame, question: Column, answers: Column, image: Column, row_id: Column) -> DataFrame:
    """Question and answer pairs about a picture: the majority of the answers, the first seen of equally frequent ones.
    Rows without question, answer or picture are left out."""
    clean = F.filter(F.transform(answers, T.squeeze), lambda a: a != "")
    votes = F.transform(F.array_distinct(clean), lambda a: F.struct((-F.size(F.filter(clean, lambda x: x == a))).alias("k"), F.array_position(clean, a).alias("at"), a.alias("answer")))
    best = F.array_min(votes)["answer"]
    asked = T.squeeze(question)
    return df.where((asked != "") & best.isNotNull() & (T.strip(image) != "")).select(
        row_id.alias("id"), F.lit("image_text").alias("modality"), asked.alias("question"), best.alias("answer"), image.alias("image")
    )


def first_pair(pairs: Column) -> Column:
    """The first of question and answer pairs in which neither is blank, with its place from 0."""
    clean = F.transform(pairs, lambda p, i: F.struct(T.squeeze(p["question"]).alias("question"), T.squeeze(p["answer"]).alias("answer"), i.alias("at")))
    return F.try_element_at(F.filter(clean, lambda p: (p["question"] != "") & (p["answer"] != "")), F.lit(1))


def text_record(record_id: Column, source: Column, bucket: Column, user: Column, assistant: Column, language_: Column, image: Column | None = None, transformed: bool = False) -> Column:
    """A record of the older layout, with a picture beside the user's text if one is given."""
    said = T.squeeze(user)
    if image is not None:
        none = F.lit(None).cast("string")
        said = F.to_json(F.array(F.struct(F.lit("text").alias("type"), said.alias("text"), none.alias("image")), F.struct(F.lit("image").alias("type"), none.alias("text"), image.alias("image"))))
    meta = F.struct(language_.alias("language"), F.lit(True).alias("thinking_disabled"), F.lit(transformed).alias("transformed"))
    return F.struct(
        record_id.alias("id"), source.alias("source"), bucket.alias("bucket"), F.lit("text" if image is None else "multimodal").alias("modality"), chat(said, T.squeeze(assistant)).alias("messages"), meta.alias("meta")
    )
