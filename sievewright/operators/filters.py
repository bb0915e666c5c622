"""Ordered, countable reasons for keeping and dropping rows; reasons are columns, never exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.operators.order import numbered

# Keys that hold personal data, values of a switched-off flag, roles and modalities.
PERSONAL_KEYS = (
    "email", "phone", "ip", "ip_address", "user_id", "name", "first_name", "last_name", "gender", "age", "race", "ethnicity", "religion",
    "sexual_orientation", "demographics",
)
OFF_VALUES = ("off", "false", "0", "disabled", "no")
ROLES = ("system", "user", "assistant")
MODALITIES = ("text", "image_text")


def drop_personal_columns(df: DataFrame, keys: tuple[str, ...] = PERSONAL_KEYS) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in keys])


def drop_personal_keys(entries: Column, keys: tuple[str, ...] = PERSONAL_KEYS) -> Column:
    return F.map_filter(entries, lambda k, v: ~F.lower(k).isin(*keys))


def empty_user_prompt(messages: Column) -> Column:
    return F.coalesce(~F.exists(M.texts(messages, "user"), lambda t: T.strip(t) != ""), F.lit(True))


def flagged_toxic(*labels: Column, above: float = 0.7) -> Column:
    """Whether any label is true or above the bound; labels are numbers or booleans."""
    out = F.lit(False)
    for label in labels:
        out = out | F.coalesce(label.cast("double") > above, F.lit(False))
    return out


def thinking_off(flag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(flag)).isin(*OFF_VALUES), F.lit(True))


def template_off(enabled: Column) -> Column:
    return F.coalesce(~enabled, F.lit(True))


def row_texts(messages: Column) -> Column:
    return F.array_join(M.texts(messages), "\n")


def drop_reason(messages: Column, toxic: Column, thinking: Column, enabled: Column, drop_on_marker: bool = True) -> Column:
    """The first reason to drop a row, null to keep it."""
    marked = T.marker_total(row_texts(messages)) > 0
    reason = F.when(empty_user_prompt(messages), "empty_user_prompt").when(toxic, "toxic_flagged").when(~thinking_off(thinking) | ~template_off(enabled), "thinking_not_disabled")
    return reason.when(marked, "marker_detected") if drop_on_marker else reason


def compat_reason(id_: Column, messages: Column, modality: Column) -> Column:
    """The tolerant check: what is wrong first, or ok."""
    return (
        F.when(id_.isNull() | (F.trim(id_) == ""), "missing_id")
        .when(messages.isNull() | (F.size(messages) < 2), "invalid_messages")
        .when(~modality.isin(*MODALITIES), "invalid_modality")
        .when(F.exists(messages, lambda m: m["role"].isNull() | m["content"].isNull()), "invalid_message_block")
        .otherwise("ok")
    )


def read_messages(messages: Column) -> Column:
    """Role, content, block list (null for plain text) and text of each message, each parsed once."""
    def one(m: Column) -> Column:
        blocks = F.when(m["content"].startswith("[{"), F.from_json(m["content"], M.BLOCKS))
        return F.transform(
            F.array(F.struct(m["role"].alias("role"), m["content"].alias("content"), blocks.alias("blocks"))),
            lambda x: F.struct(
                x["role"].alias("role"), x["content"].alias("content"), x["blocks"].alias("blocks"),
                F.coalesce(F.array_join(F.filter(F.transform(F.filter(x["blocks"], lambda b: b["type"] == "text"), lambda b: b["text"]), lambda t: t.isNotNull()), " "), x["content"]).alias("text"),
            ),
        )[0]

    return F.transform(messages, one)


def first_of(codes: Column) -> Column:
    """The first code of an array that isn't null."""
    return F.try_element_at(F.filter(codes, lambda c: c.isNotNull()), F.lit(1))


def vision_reason(read: Column, require_user_image: bool = True) -> Column:
    """What is wrong first with messages that show pictures, null if nothing is: the user's contents are
    block lists, texts aren't blank, blocks are of two types, and each picture is named.  Whether a
    named file can be decoded is for whoever reads it."""
    def block(b: Column) -> Column:
        return (
            F.when(b["type"] == "text", F.when(F.coalesce(T.strip(b["text"]), F.lit("")) == "", "block_text"))
            .when(b["type"] == "image", F.when(M.image_kind(b) == "missing", "image_reference")).otherwise("block_type")
        )

    def message(m: Column) -> Column:
        plain = F.when(m["role"] == "user", "user_content").when(T.strip(m["content"]) == "", "content")
        return F.when(m["blocks"].isNull(), plain).when(F.size(m["blocks"]) == 0, "content").otherwise(first_of(F.transform(m["blocks"], block)))

    found = first_of(F.transform(read, message))
    seen = F.exists(read, lambda m: (m["role"] == "user") & F.coalesce(F.exists(m["blocks"], lambda b: b["type"] == "image"), F.lit(False)))
    return F.coalesce(found, F.when(~seen, F.lit("no_user_image"))) if require_user_image else found


def strict_reason(df: DataFrame, images: bool = True) -> Column:
    """The strict check of a canonical conversation row: its first error, or ok.  Without ``images`` pictures aren't looked at."""
    c = df.__getitem__
    blank = lambda x: x.isNull() | (T.strip(x) == "")
    modality = F.coalesce(F.trim(c("modality")), F.lit("text"))

    def message(m: Column) -> Column:
        wrong_role = m["role"].isNull() | ~m["role"].isin(*ROLES)
        return F.when(wrong_role, "role").when(m["content"].isNull(), "content").when(m["blocks"].isNull() & (T.marker_total(m["content"]) > 0), "marker")

    def reason(read: Column) -> Column:
        asked = F.exists(read, lambda m: (m["role"] == "user") & (T.strip(F.coalesce(m["text"], F.lit(""))) != ""))
        listed = F.exists(read, lambda m: m["blocks"].isNotNull() & (T.marker_total(m["text"]) > 0))
        found = first_of(F.transform(read, message))
        out = (
            F.when(found.isNotNull(), found).when(~asked, "user_prompt").when(listed, "marker").when(~thinking_off(c("thinking")), "thinking")
            .when(~template_off(c("chat_template_kwargs.enable_thinking")), "chat_template_kwargs").when(attestation_missing(c("source_id"), c("private_local_attestation")), "attestation")
        )
        if images:
            seen = vision_reason(read)
            out = out.when((modality == "image_text") & seen.isNotNull(), F.concat(F.lit("image:"), seen))
        return out.otherwise("ok")

    # The messages are parsed once, for all that is asked of them.
    checked = F.transform(F.array(read_messages(c("messages"))), reason)[0]
    return (
        F.when(c("schema_version").isNull() | (c("schema_version") != "1.0"), "schema_version").when(blank(c("id")), "id").when(blank(c("source_id")), "source_id").when(blank(c("license")), "license")
        .when(~modality.isin(*MODALITIES), "modality").when(c("messages").isNull() | (F.size(c("messages")) == 0), "messages").otherwise(checked)
    )


def identity_reason(df: DataFrame) -> Column:
    """The strict check that takes pictures for text: of rows with pictures only the texts are looked at."""
    return strict_reason(df, images=False)


def preference_reason(df: DataFrame) -> Column:
    """The strict check of a preference row: its first error, or ok."""
    c = df.__getitem__
    blank = lambda x: x.isNull() | (T.strip(x) == "")
    turns = c("prompt_messages")
    wrong = F.coalesce(F.exists(turns, lambda m: m["role"].isNull() | ~m["role"].isin(*ROLES)), F.lit(False))
    missing = F.coalesce(F.exists(turns, lambda m: m["content"].isNull()), F.lit(False))
    asked = F.array_join(F.filter(F.transform(M.texts(turns, "user"), T.strip), lambda t: t != ""), " ")
    prompt = F.when(~blank(c("prompt")), T.strip(c("prompt"))).otherwise(F.coalesce(asked, F.lit("")))
    attested = attestation_missing(c("source_id"), c("private_local_attestation")) if "private_local_attestation" in df.columns else F.upper(c("source_id")).startswith("PRIVATE_LOCAL")
    marks = F.lit(0)
    for text in (prompt, c("chosen"), c("rejected")):
        marks = marks + T.marker_total(text)
    return (
        F.when(blank(c("id")), "id").when(blank(c("source_id")), "source_id").when(blank(c("license")), "license")
        .when(blank(c("prompt")) & wrong, "role").when(blank(c("prompt")) & missing, "content").when(prompt == "", "prompt").when(blank(c("chosen")), "chosen").when(blank(c("rejected")), "rejected")
        .when(~thinking_off(c("thinking")), "thinking").when(~template_off(c("chat_template_kwargs.enable_thinking")), "chat_template_kwargs").when(attested, "attestation").when(marks > 0, "marker").otherwise("ok")
    )


def first_error(df: DataFrame, reason: str, order: list[str]) -> DataFrame:
    """One row: how many rows aren't ok, and the first of them by order, as rows[number]: reason; the number is from 0."""
    made = numbered(df.select(*order, reason), order, "__n")
    bad = F.col(reason) != "ok"
    first = F.min_by(F.concat(F.lit("rows["), (F.col("__n") - 1).cast("string"), F.lit("]: "), F.col(reason)), F.when(bad, F.col("__n")))
    return made.agg(F.count_if(bad).alias("n_invalid"), F.when(F.count_if(bad) > 0, first).alias("first_error"))


def enforce(df: DataFrame, reason: Column, *labels: str) -> DataFrame:
    """The rows, each of which must be ok: reading one that isn't raises an error with its reason and labels."""
    said = F.concat(reason, *[F.concat(F.lit(f" {c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in labels])
    return df.where(F.when(reason == "ok", F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))


def require_no_markers(df: DataFrame, text: Column) -> DataFrame:
    """The rows, none of which may hold a reasoning marker: the error names those found, in order."""
    names = T.marker_names(text)
    return df.where(F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("reasoning markers: "), F.array_join(names, ", "))).cast("boolean")))


def attestation_missing(source: Column, attestation: Column) -> Column:
    """Private local sources need a complete attestation with each row."""
    filled = lambda x: F.coalesce(F.trim(x) != "", F.lit(False))
    complete = (
        filled(attestation["provenance_attestation"]) & filled(attestation["license"]) & filled(attestation["pii_policy"])
        & attestation["redistribution_allowed"].isNotNull()
    )
    return F.upper(F.coalesce(source, F.lit(""))).startswith("PRIVATE_LOCAL") & ~F.coalesce(complete, F.lit(False))


def allowed_sources(allowlist: DataFrame, order: Column | None = None) -> DataFrame:
    """source_id, enabled: of a source listed twice the last by order holds, without one the last as the table is read."""
    placed = allowlist.select(F.trim("source_id").alias("source_id"), "enabled", (F.monotonically_increasing_id() if order is None else order).alias("__at"))
    return placed.groupBy("source_id").agg(F.max_by("enabled", "__at").alias("enabled"))


def admit(df: DataFrame, allowlist: DataFrame, source: str = "source_id") -> DataFrame:
    """Each row's admission: ok, not_listed or not_enabled.  The list is counted before it is broadcast."""
    from sievewright.session import BROADCAST_ROWS

    listed = allowed_sources(allowlist).select(F.col("source_id").alias("__listed"), "enabled")
    if listed.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    joined = df.join(listed, F.trim(F.col(source)) == F.col("__listed"), "left")
    return joined.withColumn(
        "admission", F.when(F.col("__listed").isNull(), "not_listed").when(F.col("enabled"), "ok").otherwise("not_enabled")
    ).drop("__listed", "enabled")
