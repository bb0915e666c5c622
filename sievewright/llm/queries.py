"""The pN_ queries: each problem's operator over the whole tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import abuse, answers, containers, format_copies, languages, mixing, personal, tokens, visual
from sievewright.session import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
#: Where the vocabulary files lie on every machine; another folder is named by the environment.
TOKENIZERS = os.environ.get("SIEVEWRIGHT_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = tokens.Tokenizer(TOKENIZERS)


def _document_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.record_tokens(table(spark, folder, "documents"), ["doc_id", "source"], "text", TOKENIZER)


def p1_record_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.corpus_tokens(table(spark, folder, "documents"), table(spark, folder, "sft_rows"), TOKENIZER)


def p1_totals(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.totals(p1_record_tokens(spark, folder))


def p1_against_reports(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.against_reports(p1_record_tokens(spark, folder), table(spark, folder, "full_dataset_validation"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return format_copies.copy_pairs(*(table(spark, folder, t) for t in ("sft_rows", "preference_rows", "raw_records")))


def p2_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return format_copies.collapse(*(table(spark, folder, t) for t in ("sft_rows", "preference_rows", "raw_records")))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal.findings(table(spark, folder, "sft_rows"))


def p3_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return personal.redacted(table(spark, folder, "sft_rows"))


def _languages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, languages.Crf]:
    docs, sft = table(spark, folder, "documents"), table(spark, folder, "sft_rows")
    return docs, sft, languages.fit(languages.sample(languages.document_source(docs), languages.conversation_source(sft)))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.wrong_labels(*_languages(spark, folder))


def p4_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.languages(*_languages(spark, folder))


def p4_segments(spark: SparkSession, folder: str) -> DataFrame:
    return languages.segments(*_languages(spark, folder))


def _defects(spark: SparkSession, folder: str) -> DataFrame:
    identity, preferences = table(spark, folder, "identity_sft"), table(spark, folder, "preference_rows")
    flat = (identity, "id", "language", F.concat_ws("\n\n", "messages_flat.user", "messages_flat.assistant"))
    pairs = (preferences, "id", "language", F.concat_ws("\n\n", "prompt", "chosen", "rejected"))
    return answers.defects(identity, preferences, languages.fit(languages.sample(flat, pairs)))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _defects(spark, folder).select("table_name", "id", "field", "defect")


def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    return _defects(spark, folder).groupBy("table_name", "field", "defect").agg(F.count(F.lit(1)).alias("n_answers"))


def _abuse(spark: SparkSession, folder: str) -> DataFrame:
    passed = abuse.read(table(spark, folder, "documents"), table(spark, folder, "sft_rows"))
    return abuse.record_scores(passed, abuse.fit(passed))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.flagged(_abuse(spark, folder))


def p6_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _abuse(spark, folder)


def p6_rates(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.rates(_abuse(spark, folder))


def p6_against_review(spark: SparkSession, folder: str) -> DataFrame:
    return abuse.against_review(_abuse(spark, folder), table(spark, folder, "review_labels"))


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return containers.pack(_document_sizes(spark, folder), table(spark, folder, "container_specs"))


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    return containers.fill(p7_containers(spark, folder), table(spark, folder, "container_specs"))


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_document_sizes(spark, folder), table(spark, folder, "mixture_sources"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(p8_mixture(spark, folder), table(spark, folder, "mixture_sources"))


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    """A mixture as large as the listed sources: those short of their share give what their repeats allow."""
    sizes, sources = materialize(_document_sizes(spark, folder), "sizes"), table(spark, folder, "mixture_sources")
    listed = sources.select(tokens.clean_label("source_id", "").alias("source")).where("source != ''").distinct()
    held = sizes.withColumn("source", tokens.clean_label("source", "")).join(F.broadcast(listed), "source")  # mixing.MAX_SOURCES rows at most
    return mixing.mix(sizes, sources, total_tokens=held.agg(F.sum("n_tokens")).first()[0] or 0)


def p8_filled(spark: SparkSession, folder: str) -> DataFrame:
    return _filled(spark, folder)


def p8_filled_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(_filled(spark, folder), table(spark, folder, "mixture_sources"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return visual.same_look(table(spark, folder, "documents"))


def p9_forms(spark: SparkSession, folder: str) -> DataFrame:
    return visual.canonical_documents(table(spark, folder, "documents")).select("doc_id", "form")


def queries() -> dict[str, Query]:
    found = {name: value for name, value in globals().items() if name.startswith("p") and name[1:2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: (int(x[0][1:].split("_")[0]), not x[0].endswith("_found"))))


def _canonical_sql(c: str) -> str:
    """Without white space, punctuation and letter case; the sharp s and the final sigma as case folding has them."""
    return rf"regexp_replace(nfc_normalize(replace(replace(lower({c}), 'ß', 'ss'), 'ς', 'σ')), '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')"


def _plain_sql(c: str) -> str:
    listed = f"TRY_CAST({c} AS JSON[])"
    texts = f"array_to_string(list_filter(list_transform(list_filter({listed}, lambda b: json_extract_string(b, '$.type') = 'text'), lambda b: json_extract_string(b, '$.text')), lambda t: t IS NOT NULL), ' ')"
    return f"CASE WHEN ltrim({c}) LIKE '[%' AND json_valid({c}) AND len(list_filter({listed}, lambda b: json_extract_string(b, '$.type') IS NOT NULL)) > 0 THEN {texts} ELSE coalesce({c}, '') END"


def _messages_sql(messages: str, role: str, content: str) -> str:
    text = _canonical_sql(f"({_plain_sql(content)})")
    some = f"len(list_filter({messages}, lambda m: {text} <> '')) > 0"
    return f"CASE WHEN {some} THEN 'm' || array_to_string(list_transform({messages}, lambda m: chr(30) || lower(trim(coalesce({role}, ''))) || chr(31) || {text}), '') END"


def _pair_sql(prompt: str, chosen: str) -> str:
    a, b = _canonical_sql(f"coalesce({prompt}, '')"), _canonical_sql(f"coalesce({chosen}, '')")
    return f"CASE WHEN {a} <> '' OR {b} <> '' THEN 'p' || chr(30) || {a} || chr(30) || {b} END"


_USERS = f"array_to_string(list_transform(list_filter(prompt_messages, lambda m: lower(trim(coalesce(m.role, ''))) = 'user'), lambda m: {_plain_sql('m.content')}), chr(10))"
_LISTED = "TRY_CAST(json_extract(p, '$.messages') AS JSON[])"
_RAW_KEY = (
    f"coalesce(CASE WHEN json_type(json_extract(p, '$.messages')) = 'ARRAY' THEN {_messages_sql(_LISTED, "json_extract_string(m, '$.role')", "json_extract_string(m, '$.content')")} END, "
    f"{_pair_sql("json_extract_string(p, '$.prompt')", "json_extract_string(p, '$.chosen')")})"
)
_KEYS = (
    f"keys AS MATERIALIZED (SELECT DISTINCT * FROM (SELECT 'sft_rows' AS table_name, id, {_messages_sql('messages', 'm.role', 'm.content')} AS key FROM sft_rows "
    f"UNION ALL SELECT 'preference_rows', id, {_pair_sql(f'coalesce(prompt, {_USERS})', 'chosen')} FROM preference_rows "
    f"UNION ALL SELECT 'raw_records', raw_id, {_RAW_KEY} FROM (SELECT raw_id, CASE WHEN json_valid(payload) AND ltrim(payload) LIKE '{{%' THEN payload END AS p FROM raw_records)) WHERE key IS NOT NULL AND id IS NOT NULL)"
)


def _forms_sql() -> str:
    """The forms that need no look at their neighbours: characters dropped or replaced one by one, then composed."""
    dropped = "".join(f"\\x{{{ord(c):x}}}" for c, out in visual.SINGLE.items() if not out and ord(c) < 0xE0000)
    text = f"regexp_replace(text, '[{dropped}]+', '', 'g')"
    for c, out in visual.SINGLE.items():
        if len(out) > 1 and 0xFB00 <= ord(c) <= 0xFB06:  # ligatures
            text = f"replace({text}, '{c}', '{out}')"
    single = {c: out for c, out in visual.SINGLE.items() if len(out) == 1 and c not in "'\r" and out != "'" and ord(c) < 0x10000}
    return f"nfc_normalize(translate(nfc_normalize({text}), '{''.join(single)}', '{''.join(single.values())}'))"


def oracle_sql() -> dict[str, str]:
    """SQL of what needs no model and no tokenizer."""
    return {
        "p2_found": f"WITH {_KEYS} SELECT DISTINCT a.table_name, a.id AS id_a, b.id AS id_b FROM keys a JOIN keys b ON a.table_name = b.table_name AND a.key = b.key AND a.id < b.id",
        "p2_collapsed": f"WITH {_KEYS} SELECT table_name, min(id) AS representative_id, count(*) AS n_copies FROM keys GROUP BY table_name, key",
        "p9_found": f"WITH f AS MATERIALIZED (SELECT doc_id, text, {_forms_sql()} AS form FROM documents WHERE trim(regexp_replace(text, '[\\s\\p{{Z}}\\p{{C}}]+', '', 'g')) <> '') "
        "SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text",
        "p9_forms": f"SELECT doc_id, {_forms_sql()} AS form FROM documents",
    }
