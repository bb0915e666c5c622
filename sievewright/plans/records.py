"""Queries of normalisers, validators and reports of records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.operators import filters, mixing, normalize, reports
from sievewright.plans.queries import _ALL_TEXT, _CATEGORY, _COMPAT, _EMPTY_PROMPT, _LISTED, _OFF, _SFT_TOK, _SQUEEZE, INJECTED, _strict_sql, marks, sft, sft_tokens, tok, txt
from sievewright.plans.registry import query
from sievewright.session import scratch_path, table
from sievewright.sources import jsonl, sinks

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_BLANK = r"coalesce(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '') = ''"


def prefs(spark, folder):
    return table(spark, folder, "preference_rows")


_IMAGES = "len(list_filter(messages, lambda m: " + _LISTED + " AND len(list_filter(TRY_CAST(m.content AS JSON[]), lambda b: json_extract_string(b, '$.type') = 'image')) > 0)) > 0"
_MODALITY = (
    "CASE WHEN lower(trim(modality)) IN ('image_text', 'multimodal') THEN 'image_text' WHEN lower(trim(modality)) = 'text' THEN 'text' "
    f"WHEN coalesce(category LIKE '%multi%', false) THEN 'image_text' WHEN coalesce({_IMAGES}, false) THEN 'image_text' ELSE 'text' END"
)


@query(f"SELECT id, ingested_at, {_MODALITY} AS modality FROM (SELECT * REPLACE (CASE WHEN id LIKE '%3' THEN modality END AS modality) FROM sft_rows)")
def q74_identity_modality(spark, folder):
    """The declared modality is taken away from most rows, so that flag and blocks decide."""
    declared = F.when(F.col("id").endswith("3"), F.col("modality"))
    return sft(spark, folder).select("id", "ingested_at", normalize.identity_modality(declared, F.col("category").contains("multi"), F.col("messages")).alias("modality"))


_ALL_PARTS = "array_to_string(list_filter(list_transform(prompt_messages, lambda m: {0}), lambda t: t IS NOT NULL), ' ')"


@query(
    f"SELECT id, ingested_at, coalesce({_STRIP.format('nullif(source_id, chr(32))')}, 'unknown') AS source_id, CASE WHEN NOT {_BLANK.format('prompt')} THEN prompt ELSE coalesce(nullif({_STRIP.format(_ALL_PARTS.format('m.content'))}, ''), 'No prompt provided') END AS prompt, "
    "coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected FROM preference_rows WHERE source_id IS NOT NULL"
)
def q75_preference_report_rows(spark, folder):
    rows = prefs(spark, folder).where("source_id is not null")
    made = normalize.preference_rows(rows.withColumn("id", F.concat_ws("|", "id", F.col("ingested_at").cast("string"))))
    return made.select(F.split("id", "[|]")[0].alias("id"), F.split("id", "[|]")[1].cast("timestamp").alias("ingested_at"), "source_id", "prompt", "chosen", "rejected")


@query(
    f"SELECT id, ingested_at, coalesce(nullif(source_id, ''), 'identity_pack_preferences') AS source_id, coalesce(nullif(license, ''), 'operator_provided') AS license, "
    f"CASE WHEN NOT {_BLANK.format('prompt')} THEN prompt ELSE coalesce(nullif({_STRIP.format(_ALL_PARTS.format(txt('m.content')))}, ''), 'No prompt provided') END AS prompt, "
    f"CASE WHEN {_BLANK.format('chosen')} THEN 'No chosen response provided' ELSE chosen END AS chosen, CASE WHEN {_BLANK.format('rejected')} THEN 'No rejected response provided' ELSE rejected END AS rejected FROM preference_rows"
)
def q76_identity_preferences(spark, folder):
    rows = prefs(spark, folder).withColumn("id", F.concat_ws("|", "id", F.col("ingested_at").cast("string")))
    made = normalize.preference_rows(rows, identity=True)
    return made.select(F.split("id", "[|]")[0].alias("id"), F.split("id", "[|]")[1].cast("timestamp").alias("ingested_at"), "source_id", "license", "prompt", "chosen", "rejected")


@query(
    f"SELECT id, coalesce(nullif(source_id, ''), 'identity_pack') AS source_id, coalesce(nullif(license, ''), 'operator_provided') AS license, 'text' AS modality, "
    f"CASE WHEN {_BLANK.format('prompt')} THEN 'No prompt provided' ELSE prompt END || chr(10) || CASE WHEN {_BLANK.format('chosen')} THEN 'No response provided' ELSE chosen END AS chat FROM preference_rows"
)
def q77_identity_rows(spark, folder):
    """Pairs taken as older rows with a prompt and a response instead of messages."""
    made = normalize.identity_rows(prefs(spark, folder).select("id", "source_id", "license", "prompt", F.col("chosen").alias("response")))
    return made.select("id", "source_id", "license", "modality", F.array_join(F.transform("messages", lambda m: m["content"]), "\n").alias("chat"))


_USER_TURNS = r"list_filter(list_transform(list_filter(prompt_messages, lambda m: m.role = 'user'), lambda m: " + _STRIP.format("(" + txt("m.content") + ")") + "), lambda t: t <> '')"
_PREF_PROMPT = f"CASE WHEN NOT {_BLANK.format('prompt')} THEN {_STRIP.format('prompt')} ELSE coalesce(array_to_string({_USER_TURNS}, ' '), '') END"
_PREF_REASON = (
    f"CASE WHEN {_BLANK.format('id')} THEN 'id' WHEN {_BLANK.format('source_id')} THEN 'source_id' WHEN {_BLANK.format('license')} THEN 'license' "
    f"WHEN {_BLANK.format('prompt')} AND coalesce(len(list_filter(prompt_messages, lambda m: m.role IS NULL OR m.role NOT IN ('system', 'user', 'assistant'))), 0) > 0 THEN 'role' "
    f"WHEN {_BLANK.format('prompt')} AND coalesce(len(list_filter(prompt_messages, lambda m: m.content IS NULL)), 0) > 0 THEN 'content' WHEN ({_PREF_PROMPT}) = '' THEN 'prompt' "
    f"WHEN {_BLANK.format('chosen')} THEN 'chosen' WHEN {_BLANK.format('rejected')} THEN 'rejected' WHEN NOT ({_OFF}) THEN 'thinking' WHEN coalesce(chat_template_kwargs.enable_thinking, false) THEN 'chat_template_kwargs' "
    f"WHEN starts_with(upper(source_id), 'PRIVATE_LOCAL') THEN 'attestation' WHEN ({marks(_PREF_PROMPT)}) + ({marks('chosen')}) + ({marks('rejected')}) > 0 THEN 'marker' ELSE 'ok' END"
)


@query(f"SELECT id, ingested_at, {_PREF_REASON} AS reason FROM preference_rows")
def q78_strict_preferences(spark, folder):
    df = prefs(spark, folder)
    return df.select("id", "ingested_at", filters.preference_reason(df).alias("reason"))


@query(
    f"WITH r AS (SELECT id, ingested_at, {_strict_sql(True)} AS reason FROM sft_rows), n AS (SELECT *, row_number() OVER (ORDER BY id NULLS FIRST, ingested_at NULLS FIRST, reason) - 1 AS i FROM r) "
    "SELECT count(*) FILTER (reason <> 'ok') AS n_invalid, CASE WHEN count(*) FILTER (reason <> 'ok') > 0 THEN arg_min('rows[' || i || ']: ' || reason, i) FILTER (reason <> 'ok') END AS first_error FROM n"
)
def q79_dataset_error(spark, folder):
    df = sft(spark, folder)
    return filters.first_error(df.select("id", "ingested_at", filters.strict_reason(df).alias("reason"), filters.strict_reason(df).alias("again")), "reason", ["id", "ingested_at", "again"])


@query(f"SELECT id, ingested_at, {_strict_sql(False)} AS reason FROM sft_rows")
def q80_identity_validate(spark, folder):
    df = sft(spark, folder)
    return df.select("id", "ingested_at", filters.identity_reason(df).alias("reason"))


@query(
    "WITH l AS (SELECT doc_id, max(toxic) AS toxic FROM review_labels GROUP BY doc_id), r AS (SELECT d.doc_id, CASE WHEN "
    + r"coalesce(regexp_replace(text, '^\s+|\s+$', '', 'g'), '') = '' THEN 'empty_user_prompt' WHEN coalesce(toxic > 0.7, false) THEN 'toxic_flagged' "
    + f"WHEN ({marks('text')}) > 0 THEN 'marker_detected' END AS reason FROM documents d LEFT JOIN l USING (doc_id)) SELECT coalesce(reason, 'kept') AS reason, count(*) AS n_rows FROM r GROUP BY ALL"
)
def q81_labelled_drop_reasons(spark, folder):
    """The composite filter over documents with the labels of their reviews."""
    labels = table(spark, folder, "review_labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    turn = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    rows = table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id", "left")
    reason = filters.drop_reason(turn, filters.flagged_toxic(F.col("toxic")), F.lit("off"), F.lit(False))
    return reports.reasons(rows.select(reason.alias("reason")), "reason")


_SFT_MARKS = f"({marks('coalesce(' + _ALL_TEXT + ', chr(32))')})"
_CAT_TOKENS = ", ".join(f"coalesce(sum(t) FILTER (c = '{k}'), 0) AS c{i}" for i, k in enumerate(sorted(mixing.CATEGORY_TARGETS)))
_MOD_TOKENS = ", ".join(f"coalesce(sum(t) FILTER (m = '{k}'), 0) AS m{i}" for i, k in enumerate(sorted(mixing.MODALITY_TARGETS)))
_IDENTITY_IMAGES = 0.1
_REQUIRED = (mixing.MODALITY_TARGETS["image_text"] - 0.2 * _IDENTITY_IMAGES) / 0.8


def _within_sql(prefix: str, targets: dict[str, float]) -> str:
    return " AND ".join(f"abs(CAST({prefix}{i} AS DOUBLE) / greatest(sft_tokens_total, 1) - {targets[k]}::DOUBLE) <= 0.015::DOUBLE" for i, k in enumerate(sorted(targets)))


_FULL_REPORT = (
    f"WITH r AS (SELECT {_COMPAT} AS reason, {_CATEGORY} AS c, modality AS m, CAST({_SFT_TOK} AS BIGINT) AS t, CAST({_SFT_MARKS} AS BIGINT) AS k FROM sft_rows), ok AS (SELECT * FROM r WHERE reason = 'ok'), "
    f"a AS (SELECT count(*) AS sft_rows_total, count(*) FILTER (c = 'identity_behavior') AS identity_sft_rows, CAST(coalesce(sum(t), 0) AS BIGINT) AS sft_tokens_total, CAST(coalesce(sum(t) FILTER (c = 'identity_behavior'), 0) AS BIGINT) AS identity_sft_tokens, "
    f"coalesce(sum(t) FILTER (c <> 'identity_behavior' AND m = 'image_text'), 0) AS image_tokens, coalesce(sum(k), 0) AS sft_marks, {_CAT_TOKENS}, {_MOD_TOKENS} FROM ok), "
    f"b AS (SELECT count(*) AS preferences_rows_total, count(*) FILTER (trim(source_id) IN ('identity_pack', 'identity_pack_preferences')) AS identity_preference_rows, coalesce(sum(({marks("coalesce(prompt, '')")}) + ({marks("coalesce(chosen, '')")})), 0) AS pref_marks FROM preference_rows), "
    "i AS (SELECT count(*) FILTER (reason <> 'ok') AS invalid_sft_rows FROM r), o AS (SELECT * FROM a, b, i), "
    "f AS (SELECT sft_rows_total, identity_sft_rows, sft_tokens_total, identity_sft_tokens, preferences_rows_total, identity_preference_rows, invalid_sft_rows, sft_tokens_total - identity_sft_tokens AS open_sft_tokens, "
    "CAST(identity_sft_tokens AS DOUBLE) / greatest(sft_tokens_total, 1) AS identity_token_share, CAST(sft_marks + pref_marks AS BIGINT) AS cot_marker_count, "
    f"{_REQUIRED!r}::DOUBLE AS required_non_identity_multimodal_share, CAST(image_tokens AS DOUBLE) / greatest(sft_tokens_total - identity_sft_tokens, 1) AS non_identity_multimodal_share, "
    f"{_within_sql('c', mixing.CATEGORY_TARGETS)} AS token_category_targets_within_tolerance, {_within_sql('m', mixing.MODALITY_TARGETS)} AS token_modality_targets_within_tolerance FROM o), "
    "v AS (SELECT *, cot_marker_count = 0 AS cot_marker_count_zero, invalid_sft_rows = 0 AS no_invalid_rows, abs(identity_token_share - 0.2::DOUBLE) <= 1e-12 AS identity_token_share_exact, "
    "abs(non_identity_multimodal_share - required_non_identity_multimodal_share) <= 0.015::DOUBLE AS non_identity_multimodal_share_within_tolerance, preferences_rows_total > 0 AS preferences_nonempty FROM f) "
    "SELECT *, cot_marker_count_zero AND no_invalid_rows AND non_identity_multimodal_share_within_tolerance AND preferences_nonempty AND token_category_targets_within_tolerance AND token_modality_targets_within_tolerance AND identity_token_share_exact AS pass FROM v"
)


@query(_FULL_REPORT)
def q82_full_report(spark, folder):
    df = sft(spark, folder)
    rows = df.select(
        filters.compat_reason(F.col("id"), F.col("messages"), F.col("modality")).alias("reason"), M.category(F.lit(None).cast("string"), F.col("category")).alias("category"), "modality",
        sft_tokens().cast("long").alias("tokens"), T.marker_total(filters.row_texts(F.col("messages"))).cast("long").alias("markers"),
    )
    marked = (F.coalesce(T.marker_total(F.coalesce("prompt", F.lit(""))), F.lit(0)) + F.coalesce(T.marker_total(F.coalesce("chosen", F.lit(""))), F.lit(0))).cast("long")
    pairs = prefs(spark, folder).select(normalize.source_id(F.col("source_id")).alias("source_id"), marked.alias("markers"))
    return reports.full_report(rows, pairs, mixing.CATEGORY_TARGETS, mixing.MODALITY_TARGETS, mixing.TOKEN_TOLERANCE, 0.2, _IDENTITY_IMAGES)


_ID_TEXT = "array_to_string(list_filter(flatten(list_transform(messages, lambda m: list_transform(list_filter(m.content, lambda b: b.type = 'text'), lambda b: b.text))), lambda t: t IS NOT NULL), ' ')"
_ID_TOK = "coalesce(list_sum(list_transform(flatten(list_transform(messages, lambda m: list_transform(list_filter(m.content, lambda b: b.type = 'text'), lambda b: b.text))), lambda t: " + tok("t") + ")), 0)"
_ID_MOD = "CASE WHEN coalesce(multimodal, false) OR coalesce(len(list_filter(messages, lambda m: len(list_filter(m.content, lambda b: b.type = 'image')) > 0)) > 0, false) THEN 'image_text' ELSE 'text' END"


@query(
    f"WITH r AS (SELECT id, CASE WHEN coalesce(messages_flat.user, '') = '' THEN 'user_prompt' ELSE 'ok' END AS reason, {_ID_MOD} AS m, CAST({_ID_TOK} AS BIGINT) AS t, CAST({marks(_ID_TEXT)} AS BIGINT) AS k FROM identity_sft), "
    f"p AS (SELECT id, CASE WHEN {_BLANK.format('prompt')} THEN 'prompt' ELSE 'ok' END AS reason, CAST(({marks("coalesce(prompt, '')")}) + ({marks("coalesce(chosen, '')")}) + ({marks("coalesce(rejected, '')")}) AS BIGINT) AS k FROM preference_rows), "
    "a AS (SELECT count(*) AS sft_rows, CAST(coalesce(sum(t), 0) AS BIGINT) AS sft_tokens_total, CAST(coalesce(sum(t) FILTER (m = 'image_text'), 0) AS BIGINT) AS image_text_tokens, count(*) FILTER (m = 'image_text') AS image_text_rows, sum(k) AS ka FROM r), "
    "b AS (SELECT count(*) AS preference_rows, sum(k) AS kb FROM p), x AS (SELECT count(*) FILTER (reason <> 'ok') AS invalid_sft FROM (SELECT * FROM r ORDER BY id, reason LIMIT 2000)), y AS (SELECT count(*) FILTER (reason <> 'ok') AS invalid_preferences FROM (SELECT * FROM p ORDER BY id, reason LIMIT 2000)) "
    "SELECT sft_rows, preference_rows, sft_tokens_total, sft_tokens_total - image_text_tokens AS text_tokens, image_text_tokens, CAST(image_text_tokens AS DOUBLE) / greatest(sft_tokens_total, 1) AS image_text_share_tokens, sft_rows - image_text_rows AS text_rows, image_text_rows, "
    "CAST(image_text_rows AS DOUBLE) / greatest(sft_rows, 1) AS image_text_share, CAST(ka + kb AS BIGINT) AS cot_marker_count_detected, invalid_sft, invalid_preferences FROM a, b, x, y"
)
def q83_identity_report(spark, folder):
    rows = table(spark, folder, "identity_sft")
    texts = F.filter(F.flatten(F.transform("messages", lambda m: F.transform(F.filter(m["content"], lambda b: b["type"] == "text"), lambda b: b["text"]))), lambda t: t.isNotNull())
    tokens = F.coalesce(F.aggregate(F.transform(texts, T.token_estimate), F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    image = F.coalesce(F.col("multimodal"), F.lit(False)) | F.coalesce(F.exists("messages", lambda m: F.exists(m["content"], lambda b: b["type"] == "image")), F.lit(False))
    a = rows.select(
        "id", F.when(F.coalesce("messages_flat.user", F.lit("")) == "", "user_prompt").otherwise("ok").alias("reason"), F.when(image, "image_text").otherwise("text").alias("modality"), tokens.alias("tokens"),
        F.coalesce(T.marker_total(F.array_join(texts, " ")), F.lit(0)).cast("long").alias("markers"),
    ).withColumn("again", F.col("reason"))
    marked = None
    for c in ("prompt", "chosen", "rejected"):
        part = F.coalesce(T.marker_total(F.coalesce(c, F.lit(""))), F.lit(0))
        marked = part if marked is None else marked + part
    b = prefs(spark, folder).select("id", F.when(F.coalesce(T.strip(F.col("prompt")), F.lit("")) == "", "prompt").otherwise("ok").alias("reason"), marked.cast("long").alias("markers")).withColumn("again", F.col("reason"))
    return reports.identity_report(a, b, ["id", "again"])


_KINDS = "flatten(list_transform(list_filter(messages, lambda m: " + _LISTED + "), lambda m: list_transform(list_filter(TRY_CAST(m.content AS JSON[]), lambda b: json_extract_string(b, '$.type') = 'image'), lambda b: "
_KINDS += "CASE WHEN coalesce(trim(json_extract_string(b, '$.image_bytes_b64')), '') <> '' THEN 'image_bytes_b64' WHEN coalesce(trim(json_extract_string(b, '$.image_path')), '') <> '' THEN 'image_path' WHEN regexp_matches(lower(trim(coalesce(json_extract_string(b, '$.image'), ''))), '^(image|synthetic)://') THEN 'placeholder_uri' WHEN coalesce(trim(json_extract_string(b, '$.image')), '') <> '' THEN 'image_path_like' ELSE 'missing' END)))"


@query(
    f"WITH r AS (SELECT {_KINDS} AS k FROM sft_rows), c AS (SELECT count(*) AS row_count, count(*) FILTER (len(k) > 0) AS multimodal_rows, count(*) FILTER (list_contains(k, 'placeholder_uri')) AS placeholder_image_rows, "
    "count(*) FILTER (list_contains(k, 'image_path') OR list_contains(k, 'image_path_like') OR list_contains(k, 'image_bytes_b64')) AS concrete_image_rows FROM r) "
    "SELECT *, CASE WHEN multimodal_rows = 0 THEN 'text_only_native' WHEN concrete_image_rows = 0 AND placeholder_image_rows > 0 THEN 'text_only_placeholder_fallback' ELSE 'unverified_concrete_multimodal' END AS training_surface FROM c"
)
def q84_training_surface(spark, folder):
    return normalize.surface(sft(spark, folder))


#: References to files made placeholders, which text-only training allows.
_PLACED = "replace(m.content, '\"image_path\"', '\"image\"')"
_TEXT_ONLY = (
    "CASE WHEN m.content LIKE '[{%' AND json_valid(m.content) THEN coalesce(nullif(array_to_string(list_filter(list_transform(list_filter(TRY_CAST(m.content AS JSON[]), lambda b: json_extract_string(b, '$.type') = 'text'), "
    r"lambda b: regexp_replace(json_extract_string(b, '$.text'), '^\s+|\s+$', '', 'g')), lambda t: t <> ''), chr(10)), ''), '" + M.IMAGE_ONLY + r"') ELSE coalesce(regexp_replace(m.content, '^\s+|\s+$', '', 'g'), '') END"
)


@query(f"SELECT id, ingested_at, 'text' AS modality, coalesce({_IMAGES}, false) AS collapsed, array_to_string(list_transform(messages, lambda m: {_TEXT_ONLY}), chr(10)) AS chat FROM sft_rows")
def q85_text_only(spark, folder):
    rows = sft(spark, folder).select("id", "ingested_at", "modality", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.regexp_replace(F.regexp_replace(m["content"], '"image_path"', '"image"'), '("image": ?")(?!image://|synthetic://)', "$1synthetic://").alias("content"))).alias("messages"))
    made = normalize.text_only(rows)
    return made.select("id", "ingested_at", "modality", "collapsed", F.array_join(F.transform("messages", lambda m: m["content"]), "\n").alias("chat"))


_ROLE = r"lower(regexp_replace(coalesce(m.role, ''), '^\s+|\s+$', '', 'g'))"
_LEGACY = (
    f"CASE WHEN {_LISTED} THEN nullif(array_to_string(list_filter(list_transform(TRY_CAST(m.content AS JSON[]), lambda b: CASE WHEN json_extract_string(b, '$.type') = 'text' THEN 'text:' || "
    + _SQUEEZE.format("json_extract_string(b, '$.text')")
    + " WHEN json_extract_string(b, '$.type') = 'image' THEN 'image:' || json_extract_string(b, '$.image') END), lambda x: x IS NOT NULL), '|'), '') ELSE "
    + _SQUEEZE.format("m.content")
    + " END"
)


@query(f"SELECT id, ingested_at, array_to_string(list_filter(list_transform(list_filter(messages, lambda m: {_ROLE} IN ('system', 'user', 'assistant')), lambda m: {_ROLE} || '=' || {_LEGACY}), lambda x: x IS NOT NULL), chr(10)) AS chat FROM sft_rows")
def q86_canonical_messages(spark, folder):
    turns = normalize.canonical_messages(F.col("messages"))
    return sft(spark, folder).select("id", "ingested_at", F.array_join(F.transform(turns, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "\n").alias("chat"))


_STORED = (
    f"CASE WHEN {_LISTED} THEN list_filter(list_transform(TRY_CAST(m.content AS JSON[]), lambda b: CASE json_extract_string(b, '$.type') WHEN 'text' THEN nullif(" + _SQUEEZE.format("json_extract_string(b, '$.text')") + ", '') "
    "WHEN 'image' THEN 'image:' || coalesce(nullif(trim(json_extract_string(b, '$.image_path')), ''), '') END), lambda x: x IS NOT NULL) ELSE [m.content] END"
)


@query(f"SELECT id, ingested_at, array_to_string(list_transform(list_filter(list_transform(list_filter(messages, lambda m: m.content IS NOT NULL), lambda m: {{'r': coalesce(nullif(m.role, ''), 'user'), 'b': {_STORED}}}), lambda x: len(x.b) > 0), lambda x: x.r || '=' || array_to_string(x.b, '|')), chr(10)) AS chat FROM sft_rows")
def q87_storage_messages(spark, folder):
    turns = normalize.storage_messages(F.col("messages"))
    shown = lambda b: F.when(b["type"] == "image", F.concat(F.lit("image:"), F.coalesce(b["image_path"], F.lit("")))).otherwise(b["text"])
    return sft(spark, folder).select("id", "ingested_at", F.array_join(F.transform(turns, lambda m: F.concat(m["role"], F.lit("="), F.array_join(F.transform(m["content"], shown), "|"))), "\n").alias("chat"))


_PARTS = (
    f"CASE WHEN {_LISTED} THEN list_transform(TRY_CAST(m.content AS JSON[]), lambda b: CASE json_extract_string(b, '$.type') WHEN 'text' THEN " + _SQUEEZE.format("json_extract_string(b, '$.text')") + " WHEN 'image' THEN '[image]' END) ELSE [" + _SQUEEZE.format("m.content") + "] END"
)


@query(f"SELECT id, ingested_at, array_to_string(list_filter(flatten(list_transform(list_filter(messages, lambda m: m.content IS NOT NULL), lambda m: {_PARTS})), lambda t: coalesce(t, '') <> ''), chr(10)) AS text FROM sft_rows")
def q88_approximate_text(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", normalize.approximate_text(F.col("messages")).alias("text"))


@query(f"SELECT id, ingested_at, array_to_string(list_filter(list_transform(list_filter(prompt_messages, lambda m: m.role = 'user'), lambda m: {_SQUEEZE.format('(' + txt('m.content') + ')')}), lambda t: t <> ''), ' ') AS prompt FROM preference_rows")
def q89_user_prompts(spark, folder):
    return prefs(spark, folder).select("id", "ingested_at", normalize.user_prompts(F.col("prompt_messages")).alias("prompt"))


_RAW_TURNS = "list_filter(list_transform(CAST(json_extract(p, '$.messages') AS JSON[]), lambda m: {'r': CASE WHEN lower(trim(json_extract_string(m, '$.role'))) IN ('user', 'human') THEN 'user' WHEN lower(trim(json_extract_string(m, '$.role'))) IN ('assistant', 'gpt', 'model', 'bot') THEN 'assistant' ELSE '' END, 'c': " + _SQUEEZE.format("coalesce(json_extract_string(m, '$.content'), '')") + "}), lambda t: t.r <> '' AND t.c <> '')"


@query(
    f"WITH j AS (SELECT raw_id, received_at, source_id, CASE WHEN json_valid(payload) THEN payload END AS p FROM raw_records), t AS (SELECT raw_id, received_at, source_id, CASE WHEN json_extract(p, '$.messages') IS NOT NULL THEN {_RAW_TURNS} END AS m, "
    + _SQUEEZE.format("coalesce(json_extract_string(p, '$.prompt'), '')") + " AS q, " + _SQUEEZE.format("coalesce(json_extract_string(p, '$.chosen'), '')") + " AS a FROM j) "
    "SELECT raw_id AS id, source_id, CASE WHEN len(list_filter(m, lambda t: t.r = 'user')) > 0 AND len(list_filter(m, lambda t: t.r = 'assistant')) > 0 THEN array_to_string(list_transform(m, lambda t: t.r || ': ' || t.c), chr(10)) "
    "WHEN q <> '' AND a <> '' THEN 'user: ' || q || chr(10) || 'assistant: ' || a END AS chat FROM t"
)
def q90_text_rows(spark, folder):
    rows = normalize.text_rows(table(spark, folder, "raw_records"), "payload", "raw_id", "source_id")
    return rows.select("id", "source_id", F.when(F.col("chat").isNotNull(), F.array_join(F.transform("chat", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")).alias("chat"))


@query("SELECT DISTINCT id, p AS reference, substr(sha256(id || '::' || p), 1, 20) || '.png' AS asset FROM (SELECT id, b.image_path AS p FROM (SELECT id, unnest(m.content) AS b FROM (SELECT id, unnest(messages) AS m FROM identity_sft)) WHERE b.type = 'image') WHERE regexp_matches(p, '^(image|synthetic)://')")
def q91_placeholder_assets(spark, folder):
    blocks = table(spark, folder, "identity_sft").select("id", F.explode("messages").alias("m")).select("id", F.explode("m.content").alias("b")).where("b.type = 'image'")
    named = blocks.select("id", F.col("b.image_path").alias("reference")).where(F.col("reference").rlike("^(image|synthetic)://")).distinct()
    return named.select("id", "reference", normalize.asset_name(F.col("id"), F.col("reference")).alias("asset"))


def _removed_sql() -> str:
    text, counts = "t0", []
    layers = "SELECT doc_id, '" + INJECTED + "' || text AS t0 FROM documents"
    for i, p in enumerate([*(f"(?is){b}" for b in T.MARKER_BLOCKS), *(f"(?i){p.replace(chr(39), chr(39) * 2)}" for p in T.MARKERS.values())]):
        counts.append(f"n{i}")
        layers = f"SELECT *, len(regexp_extract_all(t{i}, '{p}')) AS n{i}, regexp_replace(t{i}, '{p}', ' ', 'g') AS t{i + 1} FROM ({layers})"
        text = f"t{i + 1}"
    return f"SELECT doc_id, CAST({' + '.join(counts)} AS BIGINT) AS removed, length(trim(regexp_replace({text}, '\\s+', ' ', 'g'))) AS n_left FROM ({layers}) WHERE t0 IS NOT NULL"


@query(_removed_sql())
def q92_scrub_count(spark, folder):
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", T.scrubbed(F.concat(F.lit(INJECTED), "text")).alias("x"))
    return rows.select("doc_id", F.col("x.removed").cast("long").alias("removed"), F.length("x.text").cast("long").alias("n_left"))


@query("SELECT n_nationkey, sha256('{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}') AS object_hash, sha256('{\"messages\": [{\"content\": \"' || n_name || '\", \"role\": \"user\"}], \"source\": \"nation\"}') AS record_hash FROM nation")
def q93_stable_hashes(spark, folder):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, names = pdf["n_nationkey"].tolist(), pdf["n_name"].tolist()
            yield pd.DataFrame({
                "n_nationkey": pdf["n_nationkey"], "object_hash": [sinks.object_hash({"name": n, "key": int(k)}) for k, n in zip(keys, names)],
                "record_hash": [sinks.record_hash("nation", [{"role": "user", "content": n}]) for n in names],
            })

    return table(spark, folder, "nation").select("n_nationkey", "n_name").mapInPandas(run, "n_nationkey int, object_hash string, record_hash string")


@query(f"SELECT target_share AS overall, 0.1::DOUBLE AS identity_share, target_share / 2 AS identity_part, (target_share - 0.1::DOUBLE * (target_share / 2)) / 0.9::DOUBLE AS derived, source_id FROM mixture_sources")
def q38_derived_share(spark, folder):
    """What the rest must hold for each source's share, if a tenth of all holds half of it."""
    rows = table(spark, folder, "mixture_sources").select("source_id", F.col("target_share").alias("overall"), F.lit(0.1).alias("identity_share"), (F.col("target_share") / 2).alias("identity_part"))
    return rows.withColumn("derived", mixing.derived_column(F.col("overall"), F.col("identity_share"), F.col("identity_part")))


@query("WITH e AS (SELECT user_id, event_type, event_id FROM events), g AS (SELECT user_id, list(event_type ORDER BY event_id) AS answers FROM e GROUP BY user_id), u AS (SELECT user_id, answers, unnest(list_distinct(answers)) AS a FROM g), v AS (SELECT user_id, a, len(list_filter(answers, lambda x: x = a)) AS k, list_position(answers, a) AS pos FROM u WHERE a IS NOT NULL AND trim(a) <> '') SELECT CAST(user_id AS VARCHAR) AS id, 'image_text' AS modality, 'What did user ' || user_id || ' do?' AS question, arg_min(a, -k * 1000000 + pos) AS answer, 'image://' || user_id AS image FROM v GROUP BY user_id")
def q94_image_rows(spark, folder):
    """Users as pictures, and what they did as answers of several people."""
    answers = table(spark, folder, "events").where("event_type is not null").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("answers"))
    user = F.col("user_id").cast("string")
    return normalize.image_rows(answers, F.concat(F.lit("What did user "), user, F.lit(" do?")), F.col("answers"), F.concat(F.lit("image://"), user), user)


@query(
    "SELECT count(*) FILTER (json_valid(p)) AS n_good, count(*) FILTER (NOT json_valid(p)) AS n_bad FROM (SELECT regexp_replace(payload, '\\s+', ' ', 'g') AS p FROM raw_records WHERE payload IS NOT NULL AND trim(regexp_replace(payload, '\\s+', ' ', 'g')) <> '')"
)
def q102_line_quality(spark, folder):
    """The payloads written as lines of text files and read again: well-formed and broken ones."""
    lines = table(spark, folder, "raw_records").select(F.regexp_replace("payload", r"\s+", " ").alias("value")).where("value is not null")
    path = scratch_path(spark, "payloads")
    lines.write.text(path)
    return jsonl.line_quality(spark, path).select("n_good", "n_bad")


@query(
    f"SELECT id, 'text' AS modality, {_SQUEEZE.format("coalesce(prompt, '')")} || chr(10) || {_SQUEEZE.format("coalesce(chosen, '')")} AS chat, coalesce(language, 'unknown') AS language, true AS thinking_disabled FROM preference_rows"
)
def q103_text_records(spark, folder):
    """Pairs as records of the older layout."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    made = prefs(spark, folder).select(normalize.text_record(F.col("id"), F.col("source_id"), F.lit("general_polished"), blank("prompt"), blank("chosen"), F.coalesce("language", F.lit("unknown"))).alias("r"))
    return made.select("r.id", "r.modality", F.array_join(F.transform("r.messages", lambda m: m["content"]), "\n").alias("chat"), "r.meta.language", "r.meta.thinking_disabled")
