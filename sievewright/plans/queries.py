"""The library's own operators as queries over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.functions import messages as M
from sievewright.functions import text as T
from sievewright.operators import dedupe, filters, mixing, normalize, reports
from sievewright.plans.registry import QUERIES, SQL, Query, query
from sievewright.session import scratch_path, table
from sievewright.sources import jsonl, upstream

# SQL of the building blocks; {0} is the argument.
_TXT = "CASE WHEN {0} LIKE '[{{%' AND json_valid({0}) THEN array_to_string(json_extract_string({0}, '$[*].text'), ' ') ELSE coalesce({0}, '') END"
_TOK = "coalesce(len(regexp_extract_all({0}, '" + T.TOKEN_PATTERN + "')), 0)"
_SQUEEZE = "trim(regexp_replace({0}, '" + T.SPACES.replace("{", "{{").replace("}", "}}") + "', ' ', 'g'))"
_DEDUPE = r"regexp_replace(regexp_replace(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g'), '[^a-zA-Z0-9\x{{0600}}-\x{{06ff}}\x{{0400}}-\x{{04ff}}\x{{4e00}}-\x{{9fff}} ]+', ' ', 'g')"
_LENGTH = r"(CASE WHEN {0} IS NULL THEN 0 ELSE greatest(CASE WHEN regexp_replace({0}, '^\s+|\s+$', '', 'g') = '' THEN 0 ELSE len(regexp_split_to_array(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '\s+')) END, len(regexp_extract_all({0}, '[\x{{4e00}}-\x{{9fff}}]'))) END)"


def txt(c: str) -> str:
    return _TXT.format(c)


def tok(c: str) -> str:
    return _TOK.replace("{0}", c)


def marks(c: str) -> str:
    return " + ".join(f"coalesce(len(regexp_extract_all({c}, '(?i){p.replace(chr(39), chr(39) * 2)}')), 0)" for p in T.MARKERS.values())


_ALL_TEXT = "array_to_string(list_transform(messages, lambda m: " + txt("m.content") + "), chr(10))"
_USERS = "list_transform(list_filter(messages, lambda m: m.role = 'user'), lambda m: " + txt("m.content") + ")"
_EMPTY_PROMPT = r"coalesce(len(list_filter(" + _USERS + r", lambda t: regexp_replace(t, '^\s+|\s+$', '', 'g') <> '')) = 0, true)"
_OFF = "coalesce(lower(trim(thinking)) IN ('off', 'false', '0', 'disabled', 'no'), true)"


def _sig(a: str, b: str) -> str:
    return "sha256(" + _DEDUPE.format(f"coalesce({a}, '')") + " || chr(10) || " + _DEDUPE.format(f"coalesce({b}, '')") + ")"


INJECTED = "<think>a plan</think> Scratchpad: "


def sft(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sft_rows")


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def sft_tokens() -> F.Column:
    return F.coalesce(F.aggregate(F.transform(M.texts(F.col("messages")), T.token_estimate), F.lit(0), lambda a, x: a + x), F.lit(0))


_SFT_TOK = "coalesce(list_sum(list_transform(messages, lambda m: " + tok("(" + txt("m.content") + ")") + ")), 0)"
_CATEGORY = (
    "coalesce(CASE trim(category) WHEN 'identity' THEN 'identity_behavior' WHEN 'general_polished' THEN 'polished_general_assistant' "
    "WHEN 'real_user' THEN 'real_user_conversations' WHEN 'multilingual' THEN 'multilingual' WHEN 'utility' THEN 'utility_tasks' ELSE nullif(trim(category), '') END, 'unknown')"
)


def normalized_sft(spark: SparkSession, folder: str) -> DataFrame:
    return sft(spark, folder).select(
        "*", M.category(F.lit(None).cast("string"), F.col("category")).alias("norm_category"), sft_tokens().cast("long").alias("n_tokens")
    )


@query("SELECT doc_id, CAST(" + tok("text") + " AS BIGINT) AS n_tokens FROM documents")
def q01_token_estimate(spark, folder):
    return docs(spark, folder).select("doc_id", T.token_estimate(F.col("text")).cast("long").alias("n_tokens"))


@query(f"SELECT id, ingested_at, CAST({_SFT_TOK} AS BIGINT) AS n_tokens FROM sft_rows")
def q02_row_tokens(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", sft_tokens().cast("long").alias("n_tokens"))


_COMPOSITION = f"""WITH r AS (SELECT {_CATEGORY} AS category, coalesce(modality, 'unknown') AS modality, CAST({_SFT_TOK} AS BIGINT) AS t FROM sft_rows),
g AS (SELECT 'category' AS dimension, category AS value, count(*) AS n_rows, CAST(sum(t) AS BIGINT) AS n_tokens FROM r GROUP BY category
UNION ALL SELECT 'modality', modality, count(*), CAST(sum(t) AS BIGINT) FROM r GROUP BY modality)
SELECT dimension, value, n_rows, n_tokens, CAST(n_rows AS DOUBLE) / sum(n_rows) OVER (PARTITION BY dimension) AS row_share,
CAST(n_tokens AS DOUBLE) / sum(n_tokens) OVER (PARTITION BY dimension) AS token_share FROM g"""


@query(_COMPOSITION)
def q03_composition(spark, folder):
    rows = normalized_sft(spark, folder).select(F.col("norm_category").alias("category"), F.coalesce("modality", F.lit("unknown")).alias("modality"), "n_tokens")
    return mixing.composition(rows, "n_tokens")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, coalesce({c}, 'unknown') AS value, count(*) AS n_rows FROM sft_rows GROUP BY ALL" for c in ("category", "modality", "language", "source_id", "license")
    )
)
def q05_histograms(spark, folder):
    return reports.histograms(sft(spark, folder), "category", "modality", "language", "source_id", "license")


@query(f"SELECT doc_id, CAST({marks('t')} AS BIGINT) AS n_markers FROM (SELECT doc_id, '{INJECTED}' || text AS t FROM documents)")
def q06_marker_count(spark, folder):
    return docs(spark, folder).select("doc_id", T.marker_total(F.concat(F.lit(INJECTED), "text")).cast("long").alias("n_markers"))


_SCRUB = "t"
for _b in T.MARKER_BLOCKS:
    _SCRUB = f"regexp_replace({_SCRUB}, '(?is){_b}', ' ', 'g')"
for _p in T.MARKERS.values():
    _SCRUB = f"regexp_replace({_SCRUB}, '(?i){_p.replace(chr(39), chr(39) * 2)}', ' ', 'g')"


@query(f"SELECT doc_id, trim(regexp_replace({_SCRUB}, '\\s+', ' ', 'g')) AS clean FROM (SELECT doc_id, '{INJECTED}' || text AS t FROM documents)")
def q07_marker_scrub(spark, folder):
    return docs(spark, folder).select("doc_id", T.scrub_markers(F.concat(F.lit(INJECTED), "text")).alias("clean"))


@query(
    "SELECT doc_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(t, '(?i){T.MARKERS[n].replace(chr(39), chr(39) * 2)}') THEN '{n}' END" for n in sorted(T.MARKERS))
    + f"], lambda x: x IS NOT NULL), ',') AS names FROM (SELECT doc_id, '{INJECTED}' || coalesce(text, '') AS t FROM documents)"
)
def q08_marker_names(spark, folder):
    return docs(spark, folder).select("doc_id", F.array_join(T.marker_names(F.concat(F.lit(INJECTED), F.coalesce("text", F.lit("")))), ",").alias("names"))


_REASON = (
    f"CASE WHEN {_EMPTY_PROMPT} THEN 'empty_user_prompt' WHEN NOT ({_OFF}) OR coalesce(chat_template_kwargs.enable_thinking, false) THEN 'thinking_not_disabled' "
    f"WHEN ({marks('coalesce(' + _ALL_TEXT + ', chr(32))')}) > 0 THEN 'marker_detected' END"
)


def _reason() -> F.Column:
    return filters.drop_reason(F.col("messages"), F.lit(False), F.col("thinking"), F.col("chat_template_kwargs.enable_thinking"))


@query(f"SELECT coalesce(reason, 'kept') AS reason, count(*) AS n_rows FROM (SELECT {_REASON} AS reason FROM sft_rows) GROUP BY ALL")
def q09_drop_reasons(spark, folder):
    return reports.reasons(sft(spark, folder).select(_reason().alias("reason")), "reason")


@query(f"SELECT id, ingested_at FROM sft_rows WHERE ({_REASON}) IS NULL")
def q10_filtered_rows(spark, folder):
    return sft(spark, folder).where(_reason().isNull()).select("id", "ingested_at")


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q11_personal_columns(spark, folder):
    return filters.drop_personal_columns(table(spark, folder, "customer").withColumnRenamed("c_name", "Name"))


@query(f"SELECT id, ingested_at, {_EMPTY_PROMPT} AS empty_prompt FROM sft_rows")
def q12_empty_user_prompt(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", filters.empty_user_prompt(F.col("messages")).alias("empty_prompt"))


_COMPAT = (
    "CASE WHEN id IS NULL OR trim(id) = '' THEN 'missing_id' WHEN messages IS NULL OR len(messages) < 2 THEN 'invalid_messages' "
    "WHEN modality NOT IN ('text', 'image_text') THEN 'invalid_modality' WHEN len(list_filter(messages, lambda m: m.role IS NULL OR m.content IS NULL)) > 0 THEN 'invalid_message_block' ELSE 'ok' END"
)


@query(f"SELECT {_COMPAT} AS reason, count(*) AS n_rows FROM sft_rows GROUP BY ALL")
def q13_compat_validate(spark, folder):
    return reports.reasons(sft(spark, folder).select(filters.compat_reason(F.col("id"), F.col("messages"), F.col("modality")).alias("reason")), "reason")


_ATTEST = (
    "starts_with(upper(coalesce(source_id, '')), 'PRIVATE_LOCAL') AND NOT coalesce(coalesce(trim(private_local_attestation.provenance_attestation) <> '', false) AND "
    "coalesce(trim(private_local_attestation.license) <> '', false) AND coalesce(trim(private_local_attestation.pii_policy) <> '', false) AND private_local_attestation.redistribution_allowed IS NOT NULL, false)"
)
_LISTED = "(m.content LIKE '[{%' AND json_valid(m.content))"
_MARKS_OF = "(" + marks("(" + txt("m.content") + ")") + ") > 0"
_FIRST = "list_filter({0}, lambda c: c IS NOT NULL)[1]"
_BLOCK = (
    r"CASE json_extract_string(b, '$.type') WHEN 'text' THEN CASE WHEN coalesce(regexp_replace(json_extract_string(b, '$.text'), '^\s+|\s+$', '', 'g'), '') = '' THEN 'block_text' END "
    "WHEN 'image' THEN CASE WHEN coalesce(trim(json_extract_string(b, '$.image_path')), '') = '' AND coalesce(trim(json_extract_string(b, '$.image')), '') = '' AND coalesce(trim(json_extract_string(b, '$.image_bytes_b64')), '') = '' THEN 'image_reference' END ELSE 'block_type' END"
)
_VISION = (
    "coalesce("
    + _FIRST.format(
        f"list_transform(messages, lambda m: CASE WHEN NOT {_LISTED} THEN CASE WHEN m.role = 'user' THEN 'user_content' WHEN "
        + r"regexp_replace(m.content, '^\s+|\s+$', '', 'g') = '' THEN 'content' END ELSE "
        + _FIRST.format(f"list_transform(TRY_CAST(m.content AS JSON[]), lambda b: {_BLOCK})")
        + " END)"
    )
    + f", CASE WHEN len(list_filter(messages, lambda m: m.role = 'user' AND {_LISTED} AND len(list_filter(TRY_CAST(m.content AS JSON[]), lambda b: json_extract_string(b, '$.type') = 'image')) > 0)) = 0 THEN 'no_user_image' END)"
)


def _strict_sql(images: bool) -> str:
    return (
        "CASE WHEN schema_version IS NULL OR schema_version <> '1.0' THEN 'schema_version' WHEN id IS NULL OR trim(id) = '' THEN 'id' "
        "WHEN source_id IS NULL OR trim(source_id) = '' THEN 'source_id' WHEN license IS NULL OR trim(license) = '' THEN 'license' "
        "WHEN coalesce(trim(modality), 'text') NOT IN ('text', 'image_text') THEN 'modality' WHEN messages IS NULL OR len(messages) = 0 THEN 'messages' ELSE coalesce("
        + _FIRST.format(
            "list_transform(messages, lambda m: CASE WHEN m.role IS NULL OR m.role NOT IN ('system', 'user', 'assistant') THEN 'role' WHEN m.content IS NULL THEN 'content' "
            f"WHEN NOT {_LISTED} AND {_MARKS_OF} THEN 'marker' END)"
        )
        + r", CASE WHEN len(list_filter(messages, lambda m: m.role = 'user' AND regexp_replace(" + txt("m.content") + r", '^\s+|\s+$', '', 'g') <> '')) = 0 THEN 'user_prompt' "
        + f"WHEN len(list_filter(messages, lambda m: {_LISTED} AND {_MARKS_OF})) > 0 THEN 'marker' WHEN NOT ({_OFF}) THEN 'thinking' WHEN coalesce(chat_template_kwargs.enable_thinking, false) THEN 'chat_template_kwargs' "
        + f"WHEN {_ATTEST} THEN 'attestation' "
        + (f"WHEN coalesce(trim(modality), 'text') = 'image_text' AND ({_VISION}) IS NOT NULL THEN 'image:' || ({_VISION}) " if images else "")
        + "ELSE 'ok' END) END"
    )


_STRICT = _strict_sql(True)


@query(f"SELECT id, ingested_at, {_STRICT} AS reason FROM sft_rows")
def q14_strict_validate(spark, folder):
    df = sft(spark, folder)
    return df.select("id", "ingested_at", filters.strict_reason(df).alias("reason"))


_ALLOWED = "(SELECT s, arg_max(enabled, n) AS enabled FROM (SELECT trim(source_id) AS s, enabled, row_number() OVER () AS n FROM allowlist_entries) GROUP BY s)"


@query(f"SELECT CASE WHEN l.s IS NULL THEN 'not_listed' WHEN l.enabled THEN 'ok' ELSE 'not_enabled' END AS admission, r.source_id, count(*) AS n_rows FROM sft_rows r LEFT JOIN {_ALLOWED} l ON trim(r.source_id) = l.s GROUP BY ALL")
def q15_source_admission(spark, folder):
    admitted = filters.admit(sft(spark, folder).select("source_id"), table(spark, folder, "allowlist_entries"))
    return admitted.groupBy("admission", "source_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"SELECT id, ingested_at, {_ATTEST} AS missing FROM sft_rows")
def q17_attestation(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", filters.attestation_missing(F.col("source_id"), F.col("private_local_attestation")).alias("missing"))


@query(f"SELECT {_CATEGORY} AS category, count(*) AS n_rows FROM sft_rows GROUP BY ALL")
def q18_category_alias(spark, folder):
    return sft(spark, folder).groupBy(M.category(F.lit(None).cast("string"), F.col("category")).alias("category")).agg(F.count(F.lit(1)).alias("n_rows"))


_TRIM = "nullif(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '')"


@query(f"SELECT coalesce({_TRIM.format('source')}, 'unknown') AS source, coalesce({_TRIM.format('lang')}, 'unknown') AS language, count(*) AS n_rows FROM documents GROUP BY ALL")
def q19_source_language(spark, folder):
    named = docs(spark, folder).select(normalize.source_id(F.col("source")).alias("source"), normalize.language(F.col("lang")).alias("language"))
    return named.groupBy("source", "language").agg(F.count(F.lit(1)).alias("n_rows"))


_SQ = _SQUEEZE.format("(" + txt("m.content") + ")")


@query(
    f"SELECT id, ingested_at, array_to_string(list_transform(list_filter(messages, lambda m: {_SQ} <> ''), lambda m: upper(coalesce(m.role, 'user')) || ': ' || {_SQ}), chr(10)) AS history FROM sft_rows"
)
def q20_render_history(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", M.render_history(F.col("messages")).alias("history"))


@query(f"SELECT id, ingested_at, array_to_string(list_filter(list_transform(list_filter(messages, lambda m: m.role = 'user'), lambda m: {_SQ}), lambda t: t <> ''), chr(10)) AS prompt FROM sft_rows")
def q21_user_text(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", M.user_text(F.col("messages")).alias("prompt"))


@query(f"SELECT id, ingested_at, list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: {txt('m.content')})[-1] AS answer FROM sft_rows")
def q22_last_assistant(spark, folder):
    return sft(spark, folder).select("id", "ingested_at", M.last_assistant(F.col("messages")).alias("answer"))


@query(
    "SELECT CASE WHEN NOT coalesce(json_valid(payload), false) THEN 'unparsable' WHEN json_extract(payload, '$.messages') IS NOT NULL THEN 'messages' ELSE 'pair' END AS kind, "
    "coalesce(CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.lang') END, 'none') AS lang, count(*) AS n_rows FROM raw_records GROUP BY ALL"
)
def q23_payload_kinds(spark, folder):
    rows = jsonl.parse_payloads(table(spark, folder, "raw_records"))
    kind = F.when(F.col("parsed").isNull(), "unparsable").when(F.col("parsed.messages").isNotNull(), "messages").otherwise("pair")
    return rows.groupBy(kind.alias("kind"), F.coalesce("parsed.lang", F.lit("none")).alias("lang")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "SELECT id, ingested_at, CASE WHEN chosen_score < rejected_score THEN rejected ELSE chosen END AS better, CASE WHEN chosen_score < rejected_score THEN chosen ELSE rejected END AS worse, "
    "abs(chosen_score - rejected_score) AS margin FROM preference_rows WHERE chosen_score <> rejected_score"
)
def q24_preference_pairs(spark, folder):
    swap = F.col("chosen_score") < F.col("rejected_score")
    return table(spark, folder, "preference_rows").where("chosen_score <> rejected_score").select(
        "id", "ingested_at", F.when(swap, F.col("rejected")).otherwise(F.col("chosen")).alias("better"),
        F.when(swap, F.col("chosen")).otherwise(F.col("rejected")).alias("worse"), F.abs(F.col("chosen_score") - F.col("rejected_score")).alias("margin"),
    )


@query(
    "SELECT CASE WHEN m IS NULL THEN 'no_scores' WHEN m <= 0 THEN 'no_margin' WHEN m < 0.8 THEN 'small_margin' ELSE 'ok' END AS reason, count(*) AS n_rows FROM (SELECT chosen_score - rejected_score AS m FROM preference_rows) GROUP BY ALL"
)
def q25_margin_reasons(spark, folder):
    m = F.col("chosen_score") - F.col("rejected_score")
    reason = F.when(m.isNull(), "no_scores").when(m <= 0, "no_margin").when(m < 0.8, "small_margin").otherwise("ok")
    return reports.reasons(table(spark, folder, "preference_rows").select(reason.alias("reason")), "reason")


@query(
    "WITH c AS (SELECT user_id, event_type, count(*) AS votes, min(event_id) AS first FROM events WHERE event_type IS NOT NULL GROUP BY ALL) "
    "SELECT user_id, event_type AS answer, votes FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, first) = 1"
)
def q26_majority_answer(spark, folder):
    return reports.majority(table(spark, folder, "events"), "user_id", "event_type", "event_id")


_SIG = _sig("messages_flat.user", "messages_flat.assistant")


def signed_identity(spark, folder):
    return table(spark, folder, "identity_sft").select("id", T.signature(F.col("messages_flat.user"), F.col("messages_flat.assistant")).alias("signature"))


@query(f"SELECT id, {_SIG} AS signature FROM identity_sft")
def q27_exact_signature(spark, folder):
    return signed_identity(spark, folder)


@query(f"SELECT min(id) AS id, signature, count(*) AS n_copies FROM (SELECT id, {_SIG} AS signature FROM identity_sft) GROUP BY signature")
def q28_exact_dedupe(spark, folder):
    return dedupe.copy_counts(signed_identity(spark, folder), "signature", "id")


@query(
    f"WITH s AS (SELECT doc_id, collected_at, sha256({_DEDUPE.format('text')}) AS signature FROM documents WHERE text IS NOT NULL), l AS (SELECT DISTINCT signature FROM s WHERE collected_at < TIMESTAMPTZ '2025-06-01 00:00:00+00') "
    "SELECT min(doc_id) AS doc_id, signature FROM s WHERE (collected_at >= TIMESTAMPTZ '2025-06-01 00:00:00+00' OR collected_at IS NULL) AND signature NOT IN (SELECT signature FROM l) GROUP BY signature"
)
def q29_ledger_dedupe(spark, folder):
    signed = docs(spark, folder).where("text is not null").select("doc_id", "collected_at", F.sha2(T.dedupe_form(F.col("text")), 256).alias("signature"))
    day = F.lit("2025-06-01 00:00:00+00:00").cast("timestamp")
    return dedupe.first_not_in_ledger(signed, F.col("collected_at") < day, "signature", "doc_id")


@query()
def q30_near_duplicates(spark, folder):
    rows = table(spark, folder, "identity_sft").select(
        "id", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("language", F.lit("")).alias("language"), "multimodal",
        T.dedupe_form(F.coalesce("messages_flat.user", F.lit(""))).alias("user"), T.dedupe_form(F.coalesce("messages_flat.assistant", F.lit(""))).alias("answer"),
    )
    return dedupe.near_duplicates(rows, ["category", "language", "multimodal"], "id", "user", "answer")


_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({0}), '\s+'), lambda w: w <> ''))"
_A, _B = _WORDS.format("chosen"), _WORDS.format("rejected")


@query(
    f"SELECT id, ingested_at, CASE WHEN len(list_distinct(list_concat({_A}, {_B}))) = 0 THEN 1.0::DOUBLE ELSE CAST(len(list_intersect({_A}, {_B})) AS DOUBLE) / len(list_distinct(list_concat({_A}, {_B}))) END AS overlap "
    "FROM preference_rows WHERE chosen IS NOT NULL AND rejected IS NOT NULL"
)
def q31_jaccard(spark, folder):
    return table(spark, folder, "preference_rows").where("chosen is not null and rejected is not null").select("id", "ingested_at", T.jaccard(F.col("chosen"), F.col("rejected")).alias("overlap"))


def _garbled_sql(c: str) -> str:
    return rf"(trim(regexp_replace({c}, '\s+', ' ', 'g')) = '' OR contains({c}, chr(65533)) OR CAST(len(regexp_extract_all({c}, '[\x00-\x08\x0e-\x1f]')) AS DOUBLE) / greatest(length({c}), 1) > 0.02::DOUBLE)"


_X, _Y = _WORDS.format("coalesce(chosen, '')"), _WORDS.format("coalesce(rejected, '')")


@query(
    f"WITH s AS (SELECT id, ingested_at, CASE WHEN len(list_distinct(list_concat({_X}, {_Y}))) = 0 THEN 1.0::DOUBLE ELSE CAST(len(list_intersect({_X}, {_Y})) AS DOUBLE) / len(list_distinct(list_concat({_X}, {_Y}))) END AS score, "
    f"{_garbled_sql("coalesce(chosen, '')")} AS reference_garbled, {_garbled_sql("coalesce(rejected, '')")} AS candidate_garbled FROM preference_rows), "
    "p AS (SELECT *, score >= 0.25::DOUBLE AND NOT candidate_garbled AS passes FROM s) SELECT *, bool_and(passes) OVER () AS ok FROM p"
)
def q32_template_parity(spark, folder):
    """The tables hold no outputs of two exports; chosen and rejected answers stand for the pairs."""
    return reports.parity(table(spark, folder, "preference_rows").select("id", "ingested_at", "chosen", "rejected"), "chosen", "rejected")


_SOURCES = "(SELECT trim(source) AS source, count(*) AS n_docs FROM documents WHERE trim(source) <> '' GROUP BY ALL)"


def source_counts(spark, folder):
    return docs(spark, folder).groupBy(F.trim("source").alias("source")).agg(F.count(F.lit(1)).alias("n_docs")).where("source <> ''")


@query(f"SELECT source, n_docs, CAST(n_docs AS DOUBLE) / sum(n_docs) OVER () AS share FROM {_SOURCES}")
def q33_normalize_weights(spark, folder):
    return mixing.normalized(source_counts(spark, folder), "n_docs")


@query(
    f"WITH e AS (SELECT source, round(CAST(n_docs AS DOUBLE) / sum(n_docs) OVER () * 1000, 9) AS exact FROM {_SOURCES}), f AS (SELECT source, exact, floor(exact) AS base FROM e), "
    "r AS (SELECT source, base, row_number() OVER (ORDER BY base - exact, source) AS r, 1000 - sum(base) OVER () AS missing FROM f) "
    "SELECT source, CAST(base + CASE WHEN r <= missing THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM r"
)
def q34_allocate(spark, folder):
    return mixing.allocate(source_counts(spark, folder), "source", "n_docs", 1000)


@query(
    "WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, n, row_number() OVER (ORDER BY doc_id) AS i FROM (SELECT doc_id, CAST(" + tok("text") + " AS BIGINT) AS n FROM documents) WHERE n > 0), "
    "f AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS doc_id, CAST(0 AS BIGINT) AS n, CAST(100000 AS BIGINT) AS room "
    "UNION ALL SELECT t.i, CASE WHEN t.n <= f.room THEN t.doc_id END, t.n, CASE WHEN t.n <= f.room THEN f.room - t.n ELSE f.room END FROM f JOIN t ON t.i = f.i + 1) "
    "SELECT doc_id, n AS n_tokens FROM f WHERE doc_id IS NOT NULL"
)
def q36_budget_fill(spark, folder):
    return mixing.budget_fill(docs(spark, folder).select("doc_id", T.token_estimate(F.col("text")).cast("long").alias("n_tokens")), "doc_id", "n_tokens", 100_000)


@query(
    f"WITH c AS ({_COMPOSITION}), w(target, wanted) AS (VALUES {', '.join(f'({k!r}, {v}::DOUBLE)' for k, v in sorted(mixing.CATEGORY_TARGETS.items()))}) "
    "SELECT target, wanted, coalesce(token_share, 0) AS actual, abs(coalesce(token_share, 0) - wanted) <= 0.015::DOUBLE AS within FROM w LEFT JOIN (SELECT * FROM c WHERE dimension = 'category') ON value = target"
)
def q37_target_drift(spark, folder):
    shares = q03_composition(spark, folder).where(F.col("dimension") == "category")
    return mixing.drift(shares, mixing.CATEGORY_TARGETS, "value", "token_share", mixing.TOKEN_TOLERANCE)


def _drift_sql(dimension: str, measure: str, targets: dict[str, float], tolerance: float) -> str:
    values = ", ".join(f"({k!r}, {v}::DOUBLE)" for k, v in sorted(targets.items()))
    return (
        f"SELECT '{dimension}' AS dimension, '{measure}' AS measure, target, wanted, coalesce({measure}, 0) AS actual, abs(coalesce({measure}, 0) - wanted) <= {tolerance}::DOUBLE AS within "
        f"FROM (VALUES {values}) w(target, wanted) LEFT JOIN (SELECT * FROM c WHERE dimension = '{dimension}') ON value = target"
    )


@query(
    f"WITH c AS ({_COMPOSITION}) "
    + " UNION ALL ".join(
        _drift_sql(d, m, targets, tolerance)
        for d, targets in (("category", mixing.CATEGORY_TARGETS), ("modality", mixing.MODALITY_TARGETS))
        for m, tolerance in (("row_share", mixing.ROW_TOLERANCE), ("token_share", mixing.TOKEN_TOLERANCE))
    )
)
def q37_all_drift(spark, folder):
    return mixing.all_drift(q03_composition(spark, folder))


def _manifest_sql(source: str, column: str) -> str:
    return (
        f"SELECT coalesce(CAST({column} AS VARCHAR), 'unknown') AS value, count(*) AS n_rows, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS percent FROM {source} GROUP BY 1"
    )


@query(_manifest_sql("documents", "category"))
def q39_category_manifest(spark, folder):
    return reports.manifest(docs(spark, folder), "category")


@query(_manifest_sql("identity_sft", "language"))
def q40_language_manifest(spark, folder):
    return reports.manifest(table(spark, folder, "identity_sft"), "language")


@query(_manifest_sql("identity_sft", "multimodal"))
def q41_multimodal_manifest(spark, folder):
    return reports.manifest(table(spark, folder, "identity_sft"), "multimodal")


@query(
    "WITH l AS (SELECT coalesce(lang, 'unknown') AS lang, CAST(" + _LENGTH.format("text") + " AS BIGINT) AS v FROM documents), s AS (SELECT lang, count(*) AS n, min(v) AS least, max(v) AS greatest, avg(CAST(v AS DOUBLE)) AS mean, list_sort(list(v)) AS a FROM l GROUP BY lang) "
    "SELECT lang, n, least, greatest, mean, " + ", ".join(f"a[1 + CAST(floor((n - 1) * {p}::DOUBLE) AS BIGINT)] AS p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9)) + " FROM s"
)
def q42_length_report(spark, folder):
    lengths = docs(spark, folder).select(F.coalesce("lang", F.lit("unknown")).alias("lang"), T.length_check(F.col("text")).cast("long").alias("v"))
    return reports.floor_percentiles(lengths, "lang", "v")


def _unit_sql(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE"


@query(f"SELECT doc_id, source, {_unit_sql("CAST(doc_id AS VARCHAR) || '/3407'")} AS u FROM documents ORDER BY u, doc_id LIMIT 500")
def q48_hash_sample(spark, folder):
    """A sample of 500 documents without replacement, the same every time."""
    u = T.hash_unit(F.col("doc_id").cast("string"), 3407)
    return docs(spark, folder).select("doc_id", "source", u.alias("u")).orderBy("u", "doc_id").limit(500)


@query("SELECT doc_id, CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 7 AS BIGINT) AS fragment FROM documents")
def q49_template_hash(spark, folder):
    return docs(spark, folder).select("doc_id", T.hash_index(F.col("doc_id").cast("string"), 7).alias("fragment"))


@query(
    "WITH n AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, coalesce(sum(CASE WHEN n_chars >= 400 THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ok FROM documents WHERE source IS NOT NULL) "
    "SELECT source, doc_id FROM n WHERE i <= 64 AND NOT (ok >= 8 AND i - 1 >= 12)"
)
def q50_scan_prefix(spark, folder):
    rows = docs(spark, folder).where("source is not null").select("source", "doc_id", "n_chars")
    return mixing.scan_prefix(rows, "source", "doc_id", F.coalesce(F.col("n_chars") >= 400, F.lit(False)), 64, 8, 12).select("source", "doc_id")


_IMG = "len(list_filter(messages, lambda m: CASE WHEN m.content LIKE '[{%' AND json_valid(m.content) THEN list_contains(json_extract_string(m.content, '$[*].type'), 'image') ELSE false END)) > 0"


@query(f"SELECT CASE WHEN coalesce({_IMG}, false) THEN 'image' ELSE 'text' END AS surface, coalesce(modality, 'unknown') AS modality, count(*) AS n_rows FROM sft_rows GROUP BY ALL")
def q51_training_surface(spark, folder):
    surface = F.when(M.has_image(F.col("messages")), "image").otherwise("text")
    return sft(spark, folder).groupBy(surface.alias("surface"), F.coalesce("modality", F.lit("unknown")).alias("modality")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "SELECT CASE WHEN coalesce(trim(p), '') <> '' THEN 'image_path' ELSE 'missing' END AS kind, count(*) AS n_blocks FROM "
    "(SELECT b.image_path AS p FROM (SELECT unnest(m.content) AS b FROM (SELECT unnest(messages) AS m FROM identity_sft)) WHERE b.type = 'image') GROUP BY ALL"
)
def q52_image_kind(spark, folder):
    blocks = table(spark, folder, "identity_sft").select(F.explode("messages").alias("m")).select(F.explode("m.content").alias("b")).where("b.type = 'image'")
    wide = blocks.select(F.struct(F.col("b.image_path").alias("image_path"), *[F.lit(None).cast("string").alias(n) for n in ("image", "path", "image_bytes_b64")]).alias("b"))
    return wide.groupBy(M.image_kind(F.col("b")).alias("kind")).agg(F.count(F.lit(1)).alias("n_blocks"))


_CHAT_TEXT = (
    "CASE WHEN m.content LIKE '[{%' AND json_valid(m.content) THEN coalesce(nullif(array_to_string(list_filter(list_transform(list_filter(TRY_CAST(m.content AS JSON[]), lambda b: json_extract_string(b, '$.type') = 'text'), "
    r"lambda b: regexp_replace(json_extract_string(b, '$.text'), '^\s+|\s+$', '', 'g')), lambda t: t <> ''), chr(10)), ''), '" + M.IMAGE_ONLY + r"') ELSE coalesce(regexp_replace(m.content, '^\s+|\s+$', '', 'g'), '') END"
)


@query(f"SELECT id, ingested_at, array_to_string(list_transform(messages, lambda m: coalesce(nullif(m.role, ''), 'user') || '=' || {_CHAT_TEXT}), chr(10)) AS chat FROM sft_rows")
def q53_text_collapse(spark, folder):
    flat = F.transform(M.collapse_to_text(F.col("messages")), lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return sft(spark, folder).select("id", "ingested_at", F.array_join(flat, "\n").alias("chat"))


@query(r"SELECT doc_id, text IS NULL OR trim(regexp_replace(text, '\s+', ' ', 'g')) = '' OR contains(text, chr(65533)) OR CAST(len(regexp_extract_all(text, '[\x00-\x08\x0e-\x1f]')) AS DOUBLE) / greatest(length(text), 1) > 0.02::DOUBLE AS garbled FROM documents")
def q54_garbled(spark, folder):
    return docs(spark, folder).select("doc_id", T.garbled(F.col("text")).alias("garbled"))


@query("SELECT source, coalesce(nullif(regexp_replace(regexp_replace(lower(source), '[^a-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'main') AS slug, count(*) AS n_rows FROM documents GROUP BY ALL")
def q55_slug(spark, folder):
    return docs(spark, folder).groupBy("source", T.slug(F.col("source")).alias("slug")).agg(F.count(F.lit(1)).alias("n_rows"))


_AUDIT = {"digits": "[0-9]{5}", "role_tag": "^(USER|ASSISTANT|Human|Q|A):", "heading": "^# ", "bullet": "^- "}


@query(
    " UNION ALL ".join(
        f"SELECT '{k}' AS pattern, count(*) AS n_lines, count(DISTINCT doc_id) AS n_documents FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '{p}')" for k, p in _AUDIT.items()
    )
)
def q56_pattern_audit(spark, folder):
    lines = docs(spark, folder).select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    hits = lines.select("doc_id", F.explode(F.array(*[F.when(F.col("line").rlike(p), F.lit(k)) for k, p in _AUDIT.items()])).alias("pattern")).where("pattern is not null")
    return hits.groupBy("pattern").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_documents"))


@query(
    "SELECT origin, source, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM (SELECT 0 AS origin, id, source FROM identity_sft UNION ALL SELECT 1, id, source_id FROM sft_rows UNION ALL SELECT 2, id, source_id FROM preference_rows) GROUP BY ALL"
)
def q57_union_merge(spark, folder):
    parts = [
        table(spark, folder, name).select(F.lit(i).alias("origin"), "id", F.col(source).alias("source"))
        for i, (name, source) in enumerate((("identity_sft", "source"), ("sft_rows", "source_id"), ("preference_rows", "source_id")))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("origin", "source").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"))


_PART = "CAST(CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 3 AS BIGINT)"


@query(
    f"SELECT id, signature FROM (SELECT id, {_PART} AS part, 'pref:' || {_sig('prompt', 'chosen')} AS signature FROM preference_rows) QUALIFY row_number() OVER (PARTITION BY signature ORDER BY part, id) = 1"
)
def q58_stream_ingest(spark, folder):
    """The preference table streamed in three batches, each with the rows of the one before again: the
    records that come out are the first of their signature, of all batches."""
    from sievewright.streaming.ingest import ingest

    rows = table(spark, folder, "preference_rows").select("id", "prompt", "chosen")
    part = T.hash_index(F.col("id"), 3)
    state = scratch_path(spark, "stream")
    for k in range(3):  # the files of a batch are older than those of the next
        rows.where((part == k) | (part == k - 1)).repartition(STREAM_FILES).write.mode("append").parquet(f"{state}/in")
    ingest(spark, f"{state}/in", rows.schema, f"{state}/out", f"{state}/state", "prompt", "chosen", "id", STREAM_FILES, kind="pref")
    return spark.read.parquet(f"{state}/out").select("id", "signature")


@query(
    f"WITH r AS (SELECT id, modality, {_STRICT} AS reason, CAST({_SFT_TOK} AS BIGINT) AS t, ({marks('coalesce(' + _ALL_TEXT + ', chr(32))')}) AS m FROM sft_rows) "
    "SELECT count(*) AS rows_total, count(*) FILTER (reason = 'ok') AS rows_valid, count(*) FILTER (reason <> 'ok') AS rows_invalid, CAST(coalesce(sum(t) FILTER (reason = 'ok'), 0) AS BIGINT) AS tokens_valid, "
    "count(*) FILTER (m > 0) AS rows_marked, count(*) FILTER (reason = 'ok' AND modality = 'image_text') AS rows_image_text, count(DISTINCT id) FILTER (reason = 'ok') AS ids FROM r"
)
def q59_validation_report(spark, folder):
    df = sft(spark, folder)
    checked = df.select("id", "modality", filters.strict_reason(df).alias("reason"), sft_tokens().cast("long").alias("t"), T.marker_total(filters.row_texts(F.col("messages"))).alias("m"))
    return reports.validation(checked, "reason", "t", "m")


@query(
    "SELECT run_id, counts.sft_tokens_total AS sft_tokens_total, generated_at FROM full_dataset_validation QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY generated_at DESC) = 1"
)
def q60_latest_reports(spark, folder):
    latest = Window.partitionBy("run_id").orderBy(F.col("generated_at").desc())
    return table(spark, folder, "full_dataset_validation").withColumn("__r", F.row_number().over(latest)).where("__r = 1").select("run_id", F.col("counts.sft_tokens_total").alias("sft_tokens_total"), "generated_at")


@query(
    "WITH m AS (SELECT modality, avg(target_share) AS share FROM mixture_sources GROUP BY modality), e AS (SELECT modality, round(share * 777, 9) AS x FROM m), "
    "r AS (SELECT modality, floor(x) AS base, row_number() OVER (ORDER BY x - floor(x) DESC, modality) - 1 AS r, 777 - sum(floor(x)) OVER () AS missing, count(*) OVER () AS n FROM e) "
    "SELECT modality, CAST(base + floor(missing / n) + CASE WHEN r < missing % n THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM r"
)
def q35_bucket_counts(spark, folder):
    shares = table(spark, folder, "mixture_sources").groupBy("modality").agg(F.avg("target_share").alias("share"))
    return mixing.bucket_counts(shares, "modality", "share", "modality", 777)


_TURNS = "list_filter(list_transform(CAST(json_extract(p, '$.messages') AS JSON[]), lambda m: {'r': CASE lower(trim(json_extract_string(m, '$.role'))) WHEN 'user' THEN 'user' WHEN 'human' THEN 'user' WHEN 'assistant' THEN 'assistant' WHEN 'gpt' THEN 'assistant' WHEN 'model' THEN 'assistant' WHEN 'bot' THEN 'assistant' ELSE '' END, 'c': " + _SQUEEZE.format("coalesce(json_extract_string(m, '$.content'), '')") + "}), lambda t: t.r <> '' AND t.c <> '')"


@query(
    f"WITH j AS (SELECT raw_id, received_at, CASE WHEN json_valid(payload) THEN payload END AS p FROM raw_records), t AS (SELECT raw_id, received_at, CASE WHEN json_extract(p, '$.messages') IS NOT NULL THEN {_TURNS} END AS m, "
    + _SQUEEZE.format("coalesce(json_extract_string(p, '$.prompt'), '')") + " AS q, " + _SQUEEZE.format("coalesce(json_extract_string(p, '$.chosen'), '')") + " AS a FROM j) "
    "SELECT raw_id, received_at, CASE WHEN len(list_filter(m, lambda t: t.r = 'user')) > 0 AND len(list_filter(m, lambda t: t.r = 'assistant')) > 0 THEN array_to_string(list_transform(m, lambda t: t.r || ': ' || t.c), chr(10)) "
    "WHEN q <> '' AND a <> '' THEN 'user: ' || q || chr(10) || 'assistant: ' || a END AS chat FROM t"
)
def q61_upstream_conversations(spark, folder):
    rows = upstream.rows(table(spark, folder, "raw_records"), "payload")
    chat = F.when(F.col("conversation").isNotNull(), F.array_join(F.transform("conversation", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n"))
    return rows.select("raw_id", "received_at", chat.alias("chat"))


@query(
    "WITH j AS (SELECT raw_id, received_at, CASE WHEN json_valid(payload) THEN payload END AS p FROM raw_records), t AS (SELECT raw_id, received_at, "
    + ", ".join(_SQUEEZE.format(f"coalesce(json_extract_string(p, '$.{c}'), '')") + f" AS {c}" for c in ("prompt", "chosen", "rejected"))
    + " FROM j) SELECT * FROM t WHERE prompt <> '' AND chosen <> '' AND rejected <> ''"
)
def q62_preference_triplets(spark, folder):
    rows = upstream.rows(table(spark, folder, "raw_records"), "payload").where("triplet is not null")
    return rows.select("raw_id", "received_at", "triplet.prompt", "triplet.chosen", "triplet.rejected")


@query(
    "SELECT source_id, CASE WHEN reason IS NULL THEN coalesce(subset, 'default') END AS subset, CASE WHEN reason IS NULL THEN coalesce(split, default_split, 'train') END AS split, CASE WHEN reason IS NULL THEN 'planned' ELSE 'skipped' END AS status, reason "
    "FROM (SELECT source_id, min(default_split) AS default_split FROM allowlist_entries GROUP BY source_id) LEFT JOIN (VALUES ('openquill/wildturns_3m', 'preference', 'validation')) o(source_id, subset, split) USING (source_id) "
    "LEFT JOIN (VALUES ('larkspan/refusal_gold', 'subset_not_listed')) s(source_id, reason) USING (source_id)"
)
def q64_stream_plan(spark, folder):
    listed = table(spark, folder, "allowlist_entries").groupBy("source_id").agg(F.min("default_split").alias("default_split"))
    return upstream.stream_plan(listed, {"openquill/wildturns_3m": ("preference", "validation")}, {"larkspan/refusal_gold": "subset_not_listed"})


_TENTH = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10"


@query(
    f"WITH e AS (SELECT *, CAST(time_bucket(INTERVAL 1 hour, ts) AS TIMESTAMPTZ) AS window_start, {_TENTH} AS tenth FROM events), m AS (SELECT max(ts) FILTER (tenth > 1) - INTERVAL 2 hour AS first, max(ts) - INTERVAL 2 hour AS last FROM e) "
    "SELECT window_start, event_type, count(*) AS n_events, round(sum(value), 4) AS total_value FROM e, m WHERE window_start + INTERVAL 1 hour <= last AND (tenth > 0 OR window_start + INTERVAL 1 hour > first) GROUP BY ALL"
)
def q65_windowed_counts(spark, folder):
    """Events streamed in three batches, the last of which is late: the windows that the watermark has closed,
    without the events that came after it had passed their window."""
    from sievewright.streaming.ingest import stream_windowed_counts

    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    tenth = T.hash_index(F.col("event_id").cast("string"), 10)
    state = scratch_path(spark, "events")
    for part in (tenth > 1, tenth == 1, tenth == 0):
        events.where(part).repartition(STREAM_FILES).write.mode("append").parquet(f"{state}/in")
    stream_windowed_counts(spark, f"{state}/in", events.schema, f"{state}/out", f"{state}/state", STREAM_FILES)
    return spark.read.parquet(f"{state}/out").withColumn("total_value", F.round("total_value", 4))


#: Files that a batch of the streamed queries consists of.
STREAM_FILES = 4


def queries() -> dict[str, Query]:
    from sievewright.plans import generation, records  # noqa: F401  (they register themselves)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
