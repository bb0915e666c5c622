"""Queries of the generator's operators: seeds, rubric scores, worse variants and pairs, reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sievewright.functions import text as T
from sievewright.operators import generate, mixing, review, rubric
from sievewright.plans.queries import _DEDUPE, _LENGTH, _sig, _unit_sql
from sievewright.plans.registry import query
from sievewright.session import materialize, table

TERMS = ("veyra-2", "noctule")
RUBRIC = rubric.Rubric(TERMS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_sql(c: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(p)})" for p in phrases) + ")"


_SCRIPTS = {"ru": ("[\\x{0400}-\\x{04ff}]", "expected_cyrillic"), "ar": ("[\\x{0600}-\\x{06ff}]", "expected_arabic"), "zh": ("[\\x{4e00}-\\x{9fff}]", "expected_cjk")}
_NAMED = "coalesce({0} IN (" + ", ".join(map(quoted, rubric.NAMED_LANGUAGES)) + "), false)"


def off_script_sql(t: str, lang: str) -> str:
    return "CASE " + " ".join(f"WHEN {lang} = '{k}' AND NOT regexp_matches({t}, '{p}') THEN '{n}'" for k, (p, n) in _SCRIPTS.items()) + " END"


def components_sql(t: str, lang: str, category: str) -> dict[str, str]:
    low, words, d = f"lower({t})", f"greatest({_LENGTH.format(t)}, 1)", "::DOUBLE"
    neg = any_sql(low, rubric.NEGATIVE)
    cats = ", ".join(map(quoted, rubric.IDENTITY_CATEGORIES))
    return {
        "identity_fidelity": f"10{d}" + "".join(f" - CASE WHEN contains({low}, '{x}') THEN 0{d} ELSE 4{d} END" for x in TERMS) + f" - CASE WHEN {_NAMED.format(lang)} AND {any_sql(low, rubric.OTHER_NAMES)} THEN 3{d} ELSE 0{d} END",
        "tone": f"10{d} - CASE WHEN contains({t}, '!!') THEN 2.5{d} ELSE 0{d} END + CASE WHEN {any_sql(low, rubric.FRIENDLY)} THEN 0.5{d} ELSE 0{d} END - CASE WHEN length({t}) > 2200 THEN 4{d} ELSE 0{d} END",
        "brevity": f"CASE WHEN {words} > 220 THEN greatest(0{d}, 10 - ({words} - 220) / 60{d}) WHEN {words} < 11 THEN greatest(0{d}, 10 - (11 - {words}) * (10{d} / 11)) ELSE 10{d} END",
        "honesty": f"CASE WHEN {neg} THEN 5{d} ELSE 10{d} END",
        "capability_accuracy": f"CASE WHEN coalesce({category} IN ({cats}), false) THEN 9{d} ELSE 10{d} END + CASE WHEN contains({low}, 'cannot') AND contains(coalesce({category}, ''), 'multimodal') THEN 0.5{d} ELSE 0{d} END",
        "no_fake_tools": f"CASE WHEN {any_sql(low, rubric.TOOLS)} THEN 0{d} ELSE 10{d} END",
        "no_visible_cot": f"CASE WHEN {neg} THEN 0{d} ELSE 10{d} END",
        "multilingual_consistency": f"CASE WHEN ({off_script_sql(t, lang)}) IS NOT NULL THEN 6{d} ELSE 10{d} END",
    }


def score_sql(t: str, lang: str = "language", category: str = "category") -> str:
    d = "::DOUBLE"
    total = " + ".join(f"({part}) * {rubric.WEIGHTS[name]}{d}" for name, part in components_sql(t, lang, category).items())
    return f"round(greatest(0{d}, least(100{d}, ({total}) * 10{d})), 3)"


def issues_sql(t: str, lang: str) -> str:
    low, words = f"lower({t})", f"greatest({_LENGTH.format(t)}, 1)"
    single = [
        (f"NOT contains({low}, '{TERMS[0]}')", "missing_name"), (f"NOT contains({low}, '{TERMS[1]}')", "missing_maker"), (f"{_NAMED.format(lang)} AND {any_sql(low, rubric.OTHER_NAMES)}", "wrong_identity_marker"),
        (f"contains({t}, '!!')", "overly_expressive"), (f"length({t}) > 2200", "too_long"), (f"{words} > 220", "verbosity"), (f"{words} < 11", "too_short"), (any_sql(low, rubric.NEGATIVE), "possible_forbidden"),
    ]
    items = [f"CASE WHEN {c} THEN '{n}' END" for c, n in single]
    items += [f"CASE WHEN contains({low}, {quoted(p)}) THEN {quoted('tool_leak:' + p)} END" for p in rubric.TOOLS]
    items += [f"CASE WHEN contains({low}, {quoted(p)}) THEN {quoted('cot_leak:' + p)} END" for p in rubric.NEGATIVE]
    items.append(f"'lang:' || ({off_script_sql(t, lang)})")
    return "array_to_string(list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL), ',')"


#: Answers, the assistant's names set before every third so that all components come into play.
_THIRD = "CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 3 = 0"
_ANSWERS = (
    "(SELECT DISTINCT id, seed_id, language, CASE category WHEN 'direct_identity' THEN 'direct_identity_qa' WHEN 'multimodal_self' THEN 'multimodal_identity' ELSE category END AS category, "
    f"CASE WHEN {_THIRD} THEN 'Veyra-2 of Noctule: ' || messages_flat.assistant ELSE messages_flat.assistant END AS a FROM identity_sft WHERE messages_flat.assistant IS NOT NULL)"
)


def answers(spark, folder):
    rows = table(spark, folder, "identity_sft").where("messages_flat.assistant is not null")
    category = F.when(F.col("category") == "direct_identity", "direct_identity_qa").when(F.col("category") == "multimodal_self", "multimodal_identity").otherwise(F.col("category"))
    named = F.when(T.hash_index(F.col("id"), 3) == 0, F.concat(F.lit("Veyra-2 of Noctule: "), F.col("messages_flat.assistant"))).otherwise(F.col("messages_flat.assistant"))
    return rows.select("id", "seed_id", "language", category.alias("category"), named.alias("answer")).distinct()


def scored(spark, folder):
    return answers(spark, folder).withColumn("score", RUBRIC.total(F.col("answer"), F.col("language"), F.col("category")))


@query(f"SELECT id, {score_sql('a')} AS score FROM {_ANSWERS}")
def q43_rubric_score(spark, folder):
    return scored(spark, folder).select("id", "score")


@query("SELECT id, " + ", ".join(f"{sql} AS {name}" for name, sql in components_sql("a", "language", "category").items()) + f", {issues_sql('a', 'language')} AS issues FROM {_ANSWERS}")
def q43_rubric_components(spark, folder):
    rows = answers(spark, folder)
    parts = RUBRIC.components(F.col("answer"), F.col("language"), F.col("category"))
    return rows.select("id", *[c.alias(n) for n, c in parts.items()], F.array_join(RUBRIC.issues(F.col("answer"), F.col("language")), ",").alias("issues"))


@query(f"SELECT seed_id, score, id FROM (SELECT seed_id, id, {score_sql('a')} AS score FROM {_ANSWERS}) QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, id) = 1")
def q44_best_candidate(spark, folder):
    return rubric.best_of(scored(spark, folder).select("seed_id", "score", "id"), ["seed_id"], "score", "id")


_TAIL = "CASE language " + " ".join(f"WHEN '{k}' THEN {quoted(v.format(rubric.TAIL_PHRASE))}" for k, v in rubric.TAILS.items()) + f" ELSE {quoted(rubric.TAILS['en'].format(rubric.TAIL_PHRASE))} END"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def appended_sql(mode: str) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in rubric.FAILURES.items() if v is not None)
    return f"CASE {mode} WHEN 'too_long' THEN repeat(' ' || {_TAIL}, {rubric.TAIL_TIMES}) {cases} END"


_WORSE = f"(SELECT a.id, a.language, a.category, m.mode, a.a, {_STRIP.format('a.a || ' + appended_sql('m.mode'))} AS w FROM {_ANSWERS} a, (VALUES {', '.join(f'({quoted(k)})' for k in rubric.FAILURES)}) m(mode))"


def worsened(rows):
    """Each way to fail as a projection of its own, its sentence a constant."""
    parts = [rows.withColumn("mode", F.lit(m)).withColumn("w", rubric.worsen(F.col("answer"), F.col("language"), F.lit(m))) for m in rubric.FAILURES]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(f"SELECT id, mode, w AS worse FROM {_WORSE}")
def q45_failure_injection(spark, folder):
    return worsened(answers(spark, folder)).select("id", "mode", F.col("w").alias("worse"))


@query(
    f"SELECT mode, count(*) AS n_pairs, CAST(sum(CASE WHEN margin > 0 AND margin >= 0.8::DOUBLE THEN 1 ELSE 0 END) AS BIGINT) AS n_kept FROM (SELECT mode, {score_sql('a')} - {score_sql('w')} AS margin FROM {_WORSE}) GROUP BY mode"
)
def q46_margin_filter(spark, folder):
    rows = worsened(materialize(scored(spark, folder), "scored")).withColumn("margin", F.col("score") - RUBRIC.total(F.col("w"), F.col("language"), F.col("category")))
    return rows.groupBy("mode").agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if((F.col("margin") > 0) & (F.col("margin") >= rubric.MIN_MARGIN)).alias("n_kept"))


@query("SELECT 'x' AS part, a.m AS first, b.m AS second FROM (VALUES " + ", ".join(f"({i}, '{m}')" for i, m in enumerate(rubric.PREFERRED[: rubric.PAIRED])) + ") a(i, m), (VALUES " + ", ".join(f"({i}, '{m}')" for i, m in enumerate(rubric.PREFERRED[: rubric.PAIRED])) + ") b(i, m) WHERE a.i < b.i")
def q66_mode_pairs(spark, folder):
    return spark.createDataFrame([("x", a, b) for a, b in rubric.mode_pairs()], "part string, first string, second string")


_SINGLE = f"(SELECT s.id, s.language, s.category, s.a, m.i, m.mode AS modes, {_STRIP.format('s.a || ' + appended_sql('m.mode'))} AS w FROM {_ANSWERS} s, (VALUES {', '.join(f'({i}, {quoted(m)})' for i, m in enumerate(rubric.PREFERRED[: rubric.TRIED]))}) m(i, mode))"
_DOUBLE = (
    f"(SELECT s.id, s.language, s.category, s.a, m.i, m.x || ',' || m.y AS modes, {_STRIP.format('s.a || ' + appended_sql('m.x') + ' || ' + appended_sql('m.y'))} AS w FROM {_ANSWERS} s, "
    f"(VALUES {', '.join(f'({i}, {quoted(a)}, {quoted(b)})' for i, (a, b) in enumerate(rubric.mode_pairs()))}) m(i, x, y))"
)
_PAIRS = (
    f"one AS MATERIALIZED (SELECT id, i, modes, w, c, r FROM (SELECT *, {score_sql('a')} AS c, {score_sql('w')} AS r FROM {_SINGLE}) WHERE c > r AND c - r >= 0.8::DOUBLE), "
    f"two AS MATERIALIZED (SELECT id, i, modes, w, c, r FROM (SELECT *, {score_sql('a')} AS c, {score_sql('w')} AS r FROM {_DOUBLE} WHERE id NOT IN (SELECT id FROM one)) WHERE c > r AND c - r >= 0.8::DOUBLE), "
    "every AS (SELECT * FROM one UNION ALL SELECT * FROM two), n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS choice, count(*) OVER (PARTITION BY id) AS choices FROM every), "
    "p AS (SELECT id, modes, w, c, r FROM n WHERE choice = (CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 1073741824) % choices)"
)


def preference_pairs(spark, folder):
    once = answers(spark, folder).dropDuplicates(["id"])
    return rubric.least_used(rubric.rejected_candidates(once, RUBRIC), "id")


@query(f"WITH {_PAIRS} SELECT id, modes AS failure_modes, w AS rejected, c AS chosen_score, r AS rejected_score, round(c - r, 3) AS margin FROM p")
def q67_preference_generation(spark, folder):
    rows = preference_pairs(spark, folder)
    return rows.select("id", F.array_join("failure_modes", ",").alias("failure_modes"), "rejected", "chosen_score", "rejected_score", "margin")


@query(f"WITH {_PAIRS} SELECT mode, count(*) AS n_used FROM (SELECT unnest(string_split(modes, ',')) AS mode FROM p) GROUP BY mode")
def q68_mode_usage(spark, folder):
    return rubric.mode_usage(preference_pairs(spark, folder))


@query(
    " UNION ALL ".join(f"SELECT '{n}' AS component, coalesce(sum(rubric.components.{n}) FILTER (rubric.components.{n} >= 0), 0) AS total FROM identity_sft" for n in rubric.WEIGHTS)
)
def q69_component_totals(spark, folder):
    return rubric.component_totals(table(spark, folder, "identity_sft"), "rubric.components")


_CATEGORY_BOUNDS = []
_total = 0.0
for _name in sorted(mixing.CATEGORY_TARGETS)[:-1]:
    _total += mixing.CATEGORY_TARGETS[_name]
    _CATEGORY_BOUNDS.append((_total, _name))
_LANGS = ("en", "bg", "es", "fr", "de", "pt", "it", "ar", "ru", "zh")


def _pick_sql(seed: int) -> str:
    return _unit_sql(f"CAST(id AS VARCHAR) || '/{seed}'")


@query(
    f"SELECT id, CASE {' '.join(f'WHEN {_pick_sql(1)} < {b}::DOUBLE THEN {quoted(n)}' for b, n in _CATEGORY_BOUNDS)} ELSE {quoted(sorted(mixing.CATEGORY_TARGETS)[-1])} END AS category, "
    f"([{', '.join(map(quoted, _LANGS))}])[1 + CAST(floor({_pick_sql(2)} * 10) AS BIGINT)] AS language, {_pick_sql(3)} < 0.1::DOUBLE AS multimodal FROM range(2200) t(id)"
)
def q47_weighted_seeds(spark, folder):
    """2,200 seeds: a category by weight, a language and a coin, from the hash of their number."""
    key = F.col("id").cast("string")
    u, category = T.hash_unit(key, 1), F.lit(sorted(mixing.CATEGORY_TARGETS)[-1])
    for bound, name in reversed(_CATEGORY_BOUNDS):
        category = F.when(u < bound, F.lit(name)).otherwise(category)
    languages = F.array(*[F.lit(x) for x in _LANGS])
    return spark.range(2200).select("id", category.alias("category"), F.element_at(languages, (F.floor(T.hash_unit(key, 2) * 10) + 1).cast("int")).alias("language"), (T.hash_unit(key, 3) < 0.1).alias("multimodal"))


def _reviewed_sql() -> str:
    low = "lower(a)"
    forbidden = "CASE " + " ".join(f"WHEN contains({low}, {quoted(p)}) THEN {quoted('forbidden:' + p)}" for p in T.FORBIDDEN_PHRASES) + " END"
    user = "coalesce(messages_flat.user, '')"
    sig = "sha256(" + _DEDUPE.format(user) + " || chr(10) || " + _DEDUPE.format("a") + ")"
    named = f"CASE WHEN {_THIRD} THEN 'Veyra-2 of Noctule: ' || coalesce(messages_flat.assistant, '') ELSE coalesce(messages_flat.assistant, '') END"
    return (
        f"r AS (SELECT DISTINCT id, run_id, seed_id, messages_flat, len(messages) AS n, rubric.total + 4 - 8 * (CAST('0x' || substr(md5(id), 9, 8) AS BIGINT) % 2) AS total, {named} AS a FROM identity_sft), "
        f"s AS MATERIALIZED (SELECT id, run_id, seed_id, total, {sig} AS sig, CASE WHEN coalesce(id, '') = '' THEN 'invalid_id' WHEN run_id = 'run-08' THEN 'run_id_mismatch' WHEN coalesce(n, 0) < 2 THEN 'messages_invalid' "
        rf"WHEN regexp_replace(a, '^\s+|\s+$', '', 'g') = '' THEN 'assistant_text_empty' WHEN NOT (contains({low}, '{TERMS[0]}') AND contains({low}, '{TERMS[1]}')) THEN 'identity_drift' ELSE {forbidden} END AS base, coalesce(total < 84.0::DOUBLE, false) AS low FROM r), "
        "i AS (SELECT id, min(id) AS first_id FROM s WHERE base IS NULL AND NOT low GROUP BY id), g AS (SELECT sig, min(id) AS first FROM s WHERE base IS NULL AND NOT low GROUP BY sig), "
        "v AS (SELECT s.id, s.seed_id, CASE WHEN base IS NOT NULL THEN base WHEN g.first < s.id THEN 'exact_duplicate' WHEN low THEN 'low_score' END AS reason FROM s LEFT JOIN g USING (sig))"
    )


def reviewed(spark, folder):
    rows = table(spark, folder, "identity_sft")
    text = F.coalesce("messages_flat.assistant", F.lit(""))
    named = F.when(T.hash_index(F.col("id"), 3) == 0, F.concat(F.lit("Veyra-2 of Noctule: "), text)).otherwise(text)
    total = F.col("rubric.total") + 4 - 8 * T.hash_index(F.col("id"), 2, 9)
    once = rows.select("id", "run_id", "seed_id", F.col("messages_flat.user").alias("prompt"), named.alias("answer"), F.size("messages").alias("n_messages"), total.alias("total")).distinct()
    run = F.when(F.col("run_id") == "run-08", F.lit("another")).otherwise(F.col("run_id"))
    return once, review.review_answers(once.withColumn("place", F.col("id")), run, TERMS, "place").select("id", "reason")


@query(f"WITH {_reviewed_sql()} SELECT id, reason FROM v")
def q70_chunk_review(spark, folder):
    return reviewed(spark, folder)[1]


@query(
    f"WITH {_reviewed_sql()} SELECT count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_accepted, CAST(count(*) FILTER (reason IS NULL) AS DOUBLE) * 100 / 1000 AS attainment, "
    "CAST(count(*) FILTER (reason IN ('exact_duplicate', 'duplicate_id')) AS DOUBLE) / greatest(1, count(*)) AS duplicate_rate, CAST(count(*) FILTER (reason = 'low_score') AS DOUBLE) / greatest(1, count(*)) AS low_score_rate, count(DISTINCT seed_id) AS n_seeds FROM v"
)
def q71_review_report(spark, folder):
    once, found = reviewed(spark, folder)
    return review.review_report(found.join(once.select("id", "seed_id"), "id"), 1000)


_MODE = "list_filter([CASE WHEN id LIKE '%7' THEN NULL WHEN id LIKE '%3' THEN 'nonsense' ELSE 'fake_tool' END], lambda x: x IS NOT NULL)"


@query(
    f"WITH b AS (SELECT DISTINCT id, prompt, 'Veyra-2 by Noctule. ' || chosen AS chosen, rejected, chosen_score, rejected_score, margin, {_MODE} AS modes FROM preference_rows), "
    r"s AS MATERIALIZED (SELECT id, " + _sig("prompt", "chosen") + r" AS sig, CASE WHEN coalesce(id, '') = '' THEN 'invalid_id' WHEN coalesce(regexp_replace(chosen, '^\s+|\s+$', '', 'g'), '') = '' THEN 'chosen_top_level_empty' WHEN coalesce(regexp_replace(rejected, '^\s+|\s+$', '', 'g'), '') = '' THEN 'rejected_top_level_empty' "
    "WHEN NOT (contains(lower(chosen), 'veyra-2') AND contains(lower(chosen), 'noctule')) THEN 'identity_drift' ELSE coalesce(CASE " + " ".join(f"WHEN contains(lower(chosen), {quoted(p)}) THEN {quoted('forbidden:' + p)}" for p in T.FORBIDDEN_PHRASES) + " END, "
    "CASE WHEN chosen_score IS NULL OR rejected_score IS NULL OR margin IS NULL THEN 'score_invalid' WHEN chosen_score <= rejected_score THEN 'margin_invalid' WHEN margin < 0.8::DOUBLE THEN 'margin_too_low' "
    "WHEN len(modes) < 1 THEN 'failure_modes_missing' WHEN list_contains(modes, 'nonsense') THEN 'failure_mode_not_allowed:nonsense' END) END AS base FROM b), "
    "g AS (SELECT sig, min(id) AS first FROM s WHERE base IS NULL GROUP BY sig) SELECT id, CASE WHEN base IS NOT NULL THEN base WHEN g.first < id THEN 'exact_duplicate' END AS reason FROM s LEFT JOIN g USING (sig)"
)
def q72_preference_review(spark, folder):
    rows = table(spark, folder, "preference_rows")
    mode = F.when(F.col("id").endswith("7"), F.lit(None)).when(F.col("id").endswith("3"), "nonsense").otherwise("fake_tool")
    modes = F.filter(F.array(mode), lambda m: m.isNotNull())
    once = rows.select("id", "prompt", F.concat(F.lit("Veyra-2 by Noctule. "), "chosen").alias("chosen"), "rejected", "chosen_score", "rejected_score", "margin", modes.alias("failure_modes")).distinct()
    return review.review_preferences(once.withColumn("run_id", F.lit("r")).withColumn("place", F.col("id")), F.lit("r"), TERMS, "place").select("id", "reason")


@query("SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(*) FILTER (run_id IS DISTINCT FROM 'run-02') AS n_other_run, count(*) = 500 AND count(DISTINCT id) = 500 AND count(*) FILTER (run_id IS DISTINCT FROM 'run-02') = 0 AS valid FROM (SELECT DISTINCT id, run_id FROM identity_sft ORDER BY id, run_id LIMIT 500)")
def q73_shard_state(spark, folder):
    """Whether the first 500 records by id make a valid shard of one run."""
    return review.shard_state(table(spark, folder, "identity_sft").select("id", "run_id").distinct().withColumn("place", F.col("id")), "run-02", 500, "place")


_PACK = ("direct_identity", "indirect_identity", "tone_style", "adversarial_rename", "tool_honesty", "multilingual_consistency", "multimodal_self")
_RECORDS = "(SELECT id, min(category) AS category, min(language) AS language, bool_or(multimodal) AS multimodal FROM identity_sft GROUP BY id)"


@query(
    f"WITH r AS {_RECORDS}, f AS (SELECT c.place, min(id) AS id FROM r JOIN (VALUES {', '.join(f'({i}, {quoted(c)})' for i, c in enumerate(_PACK))}) c(place, category) USING (category) GROUP BY c.place), "
    "m AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM r WHERE language IN ('ar', 'ru', 'zh') AND multimodal) SELECT CAST(place AS BIGINT) AS place, id FROM f UNION ALL SELECT 7, id FROM m WHERE n <= 60 - (SELECT count(*) FROM f)"
)
def q63_stress_pack(spark, folder):
    """The first record of each category, then multimodal ones of three scripts, sixty in all."""
    rows = table(spark, folder, "identity_sft").groupBy("id").agg(F.min("category").alias("category"), F.min("language").alias("language"), F.bool_or("multimodal").alias("multimodal"))
    return generate.stress_pack(rows, list(_PACK), "id").select(F.col("place").cast("long").alias("place"), "id")


_FRAGMENTS = [
    ["I am Veyra-2", "This is Veyra-2", "Hello"], ["by Noctule,", "made by Noctule,", "of another company,"], ["and I cannot see your screen.", "and I will call a tool.", "and I answer in short words that anyone can check today."], ["Sorry!!", "Please ask on.", ""],
]


def _pick_of(values: list[str], key: str, shift: int) -> str:
    return f"([{', '.join(map(quoted, values))}])[1 + CAST('0x' || substr(md5({key}), {shift}, 8) AS BIGINT) % {len(values)}]"


_SEEDS = f"(SELECT 'seed-' || lpad(CAST(id + 1 AS VARCHAR), 5, '0') AS seed_id, id, ([{', '.join(map(quoted, _LANGS))}])[1 + CAST('0x' || substr(md5('language/' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10] AS language FROM range(2200) t(id))"
_SEED_KEY = "seed_id || '|' || CAST(v AS VARCHAR) || '|0'"


@query(
    f"WITH c AS (SELECT seed_id, v, 'Who are you, ' || language || '?' AS prompt, language, 'direct_identity_qa' AS category, {" || ' ' || ".join(_pick_of(f, _SEED_KEY, 1 + 8 * i) for i, f in enumerate(_FRAGMENTS))} AS answer FROM {_SEEDS}, range(3) w(v)), "
    f"s AS (SELECT *, {score_sql('answer')} AS score FROM c), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, v) = 1), "
    f"o AS (SELECT *, {_sig('prompt', 'answer')} AS sig FROM b WHERE score >= 84.0::DOUBLE), u AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY sig ORDER BY seed_id) = 1), "
    "n AS (SELECT *, row_number() OVER (ORDER BY seed_id) AS n FROM u) SELECT 'row-' || lpad(CAST(n AS VARCHAR), 7, '0') AS id, seed_id, prompt, answer, score FROM n WHERE n <= 200"
)
def q95_row_generation(spark, folder):
    """Of 2,200 seeds the best of three answers, if it scores enough, each pair once, at most 200."""
    seeds = generate.seed_table(spark, 2_200, mixing.CATEGORY_TARGETS, list(_LANGS), "multilingual")
    asked = seeds.select("seed_id", F.concat(F.lit("Who are you, "), "language", F.lit("?")).alias("prompt"), F.lit("direct_identity_qa").alias("category"), "language")
    return generate.generate(asked, _FRAGMENTS, RUBRIC, 200)


_ID_SIG = _sig("messages_flat.user", "messages_flat.assistant")


@query(
    f"WITH a AS (SELECT 0 AS part, id, {_ID_SIG} AS sig FROM identity_sft UNION ALL SELECT 1, id, {_sig('prompt', 'chosen')} FROM preference_rows UNION ALL SELECT 2, id || '-again', {_ID_SIG} FROM identity_sft) "
    "SELECT id, sig AS signature FROM a QUALIFY row_number() OVER (PARTITION BY sig ORDER BY part, id) = 1"
)
def q96_union_dedupe(spark, folder):
    """Three tables joined end to end, each pair of prompt and answer once, the first of them."""
    own = table(spark, folder, "identity_sft").select("id", T.signature(F.col("messages_flat.user"), F.col("messages_flat.assistant")).alias("signature"))
    other = table(spark, folder, "preference_rows").select("id", T.signature(F.col("prompt"), F.col("chosen")).alias("signature"))
    return generate.merge([own, other, own.withColumn("id", F.concat("id", F.lit("-again")))], "signature", "id")


@query(
    f"WITH s AS (SELECT id, run_id, 'sft:' || {_ID_SIG} AS sig FROM identity_sft), l AS (SELECT DISTINCT sig FROM s WHERE run_id IN ('run-01', 'run-02')), f AS (SELECT id, sig FROM s WHERE run_id NOT IN ('run-01', 'run-02') AND sig NOT IN (SELECT sig FROM l) QUALIFY row_number() OVER (PARTITION BY sig ORDER BY id) = 1) "
    "SELECT id, sig AS signature FROM f ORDER BY id LIMIT 250"
)
def q97_chunk_fill(spark, folder):
    """A chunk of 250 records that earlier runs didn't have; surplus rows stand in for duplicates."""
    rows = table(spark, folder, "identity_sft").select("id", "run_id", F.concat(F.lit("sft:"), T.signature(F.col("messages_flat.user"), F.col("messages_flat.assistant"))).alias("signature"))
    old = F.col("run_id").isin("run-01", "run-02")
    return generate.fill_chunk(rows.where(~old).select("id", "signature"), rows.where(old).select("signature"), "signature", "id", 250)


@query("SELECT seed_id, id, row_number() OVER (PARTITION BY seed_id ORDER BY id) - 1 AS cycle FROM (SELECT DISTINCT id, seed_id FROM identity_sft)")
def q98_cycle_index(spark, folder):
    return generate.cycles(table(spark, folder, "identity_sft").select("id", "seed_id").distinct(), "seed_id", "id").select("seed_id", "id", "cycle")


_AGAIN = f"SELECT id FROM (SELECT DISTINCT id FROM identity_sft) ORDER BY {_unit_sql("id || '/3407'")}, id LIMIT 25"


@query(_AGAIN)
def q99_spot_checks(spark, folder):
    return generate.spot_checks(table(spark, folder, "identity_sft").select("id").distinct(), "id")


_LEAKS = ("let me", "step by step", "<think>", "the library", "because")


@query(
    f"SELECT DISTINCT id, CASE {' '.join(f'WHEN contains(lower(a), {quoted(p)}) THEN {quoted(p)}' for p in T.FORBIDDEN_PHRASES)} END AS forbidden, {any_sql('lower(a)', _LEAKS)} AS leak, {any_sql('lower(a)', rubric.TOOLS)} AS tool_claim, "
    f"NOT (contains(lower(a), '{TERMS[0]}') AND contains(lower(a), '{TERMS[1]}')) AS lacks_identity FROM {_ANSWERS}"
)
def q100_marker_predicates(spark, folder):
    rows, a = answers(spark, folder), F.col("answer")
    return rows.select("id", review.forbidden_hit(a).alias("forbidden"), review.any_marker(a, _LEAKS).alias("leak"), review.any_marker(a, rubric.TOOLS).alias("tool_claim"), review.lacks_identity(a, TERMS).alias("lacks_identity")).distinct()


_TEMPLATES = {"multilingual": {"en": "Say hello. <IMAGE_CONTEXT>", "fr": "Dis bonjour.", "zh": "打个招呼。"}, "utility_tasks": {"de": "Sortiere die Liste."}, "identity_behavior": {"en": "Who are you?"}}
_USUAL = {c: by.get("en", next(iter(by.values()))) for c, by in _TEMPLATES.items()}


@query(
    f"WITH s AS (SELECT seed_id, id, language, CASE {' '.join(f'WHEN {_pick_sql(1)} < {b!r}::DOUBLE THEN {quoted(n)}' for b, n in _CATEGORY_BOUNDS)} ELSE {quoted(sorted(mixing.CATEGORY_TARGETS)[-1])} END AS category FROM {_SEEDS}) "
    f"SELECT seed_id, trim(replace(CASE category || '/' || language {' '.join(f'WHEN {quoted(c + chr(47) + k)} THEN {quoted(t)}' for c, by in _TEMPLATES.items() for k, t in by.items())} ELSE CASE category {' '.join(f'WHEN {quoted(c)} THEN {quoted(t)}' for c, t in _USUAL.items())} END END, "
    "'<IMAGE_CONTEXT>', CASE WHEN category = 'multilingual' AND " + _pick_sql(3) + " < 0.95::DOUBLE THEN '(picture)' ELSE '' END)) AS prompt FROM s"
)
def q101_prompt_templates(spark, folder):
    """The prompts of 2,200 seeds from templates in some languages, with the place of a picture filled."""
    seeds = generate.seed_table(spark, 2_200, mixing.CATEGORY_TARGETS, list(_LANGS), "multilingual")
    return seeds.select("seed_id", generate.prompt(_TEMPLATES, F.col("category"), F.col("language"), F.col("multimodal"), context="(picture)").alias("prompt"))
