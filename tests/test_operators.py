import random
from collections import deque
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sievewright.operators import dedupe, filters, mixing, order, reports, review, rubric

MESSAGES = "messages array<struct<role:string,content:string>>"


def test_drop_reasons(spark):
    rows = [
        ([("user", "  "), ("assistant", "x")], False, "off", None), ([("user", "q"), ("assistant", "x")], True, "off", False),
        ([("user", "q"), ("assistant", "<think>y")], False, None, False), ([("user", "q"), ("assistant", "x")], False, "ON", None),
        ([("user", "q"), ("assistant", "x")], False, "0", False), (None, False, "off", None),
    ]
    df = spark.createDataFrame(rows, MESSAGES + ", toxic boolean, thinking string, enabled boolean")
    reason = filters.drop_reason(F.col("messages"), F.col("toxic"), F.col("thinking"), F.col("enabled"))
    assert [r[0] for r in df.select(reason).collect()] == ["empty_user_prompt", "toxic_flagged", "marker_detected", "thinking_not_disabled", None, "empty_user_prompt"]


def test_toxic_label(spark):
    df = spark.createDataFrame([(0, None), (1, None), (None, 0.71), (None, 0.7), (None, None)], "a int, b double")
    assert [r[0] for r in df.select(filters.flagged_toxic(F.col("a"), F.col("b"))).collect()] == [False, True, True, False, False]


def test_admission(spark):
    allow = spark.createDataFrame([("s", True, "MIT", "a"), ("s", False, "MIT", "b"), ("t", True, None, None)], "source_id string, enabled boolean, license string, default_split string")
    rows = spark.createDataFrame([("s",), (" t ",), ("u",), (None,)], "source_id string")
    got = {r.source_id: r.admission for r in filters.admit(rows, allow).collect()}
    assert got == {"s": "not_enabled", " t ": "ok", "u": "not_listed", None: "not_listed"}


def test_personal_keys(spark):
    df = spark.createDataFrame([(1, "a@b", "x")], "id int, Email string, kept string")
    assert filters.drop_personal_columns(df).columns == ["id", "kept"]
    m = spark.createDataFrame([({"Phone": "1", "topic": "t"},)], "m map<string,string>")
    assert m.select(filters.drop_personal_keys(F.col("m"))).first()[0] == {"topic": "t"}


def test_weights_and_allocation(spark):
    w = spark.createDataFrame([("b", 3.0), ("a", 1.0)], "k string, w double")
    assert {r.k: r.share for r in mixing.normalized(w, "w").collect()} == {"a": 0.25, "b": 0.75}
    tie = spark.createDataFrame([("c", 1.0), ("b", 1.0), ("a", 1.0)], "k string, w double")
    assert {r.k: r.allocated for r in mixing.allocate(tie, "k", "w", 2).collect()} == {"a": 1, "b": 1, "c": 0}
    assert mixing.derived_share(0.12, 0.2, 0.095) == pytest.approx((0.12 - 0.2 * 0.095) / 0.8)
    with pytest.raises(ValueError):
        mixing.derived_share(0.0, 0.5, 0.5)


def test_composition_and_drift(spark):
    df = spark.createDataFrame([("general", "text", 2), ("identity", "image_text", 1)], "category string, modality string, t long")
    got = {(r.dimension, r.value): (r.row_share, r.token_share) for r in mixing.composition(df, "t").collect()}
    assert got["category", "general"] == (0.5, pytest.approx(2 / 3)) and got["modality", "image_text"] == (0.5, pytest.approx(1 / 3))
    shares = spark.createDataFrame([("a", 0.5)], "v string, s double")
    assert [r.within for r in mixing.drift(shares, {"a": 0.7}, "v", "s", 0.1).collect()] == [False]


def test_budget_fill_equals_the_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 5, 40, 300, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, t long")
    for budget, part_rows in ((0, 50), (7, 50), (500, 50), (500, 10**6), (4000, 23), (10**6, 50)):
        left, want = budget, []
        for i, t in rows:
            if t and t <= left:
                left -= t
                want.append(i)
        got, room = mixing.fill(df, "i", "t", budget, part_rows)
        assert sorted(r.i for r in got.collect()) == want and room == left
    with pytest.raises(ValueError, match="no exact fill"):
        mixing.select_open_rows(df, "i", "t", 10**7, 0.5)
    rows_, figures = mixing.select_open_rows(df, "i", "t", 1, 0.2, small_sample=True)
    assert rows_.count() == sum(bool(t) for _, t in rows) and not figures["identity_token_share_exact"] and figures["required_open_tokens_exact"] == 4
    taken, figures = mixing.select_open_rows(spark.createDataFrame([(0, 9), (1, 5), (2, 3)], "i long, t long"), "i", "t", 2, 0.2)
    assert sorted(r.i for r in taken.collect()) == [1, 2] and figures["full_tokens"] == 10 and figures["identity_token_share_exact"]


@pytest.mark.parametrize("part_rows", [7, 1000])
def test_numbers_and_running_sums(spark, part_rows):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot", "hot", None, "b"]), rng.randrange(9)) for i in rng.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "i int, g string, v int")
    want, sums = {}, {}
    for i, g, v in sorted(rows):
        want.setdefault(g, []).append(i)
        sums[i] = sums.get(("sum", g), 0) + v
        sums["sum", g] = sums[i]
    got = {r.i: r.n for r in order.numbered(df, ["i"], "n", ["g"], part_rows).collect()}
    assert got == {i: k for ids in want.values() for k, i in enumerate(ids, start=1)}
    assert {r.i: r.s for r in order.running(df, ["i"], F.col("v"), "s", ["g"], part_rows).collect()} == {i: sums[i] for i, _, _ in rows}
    named = order.with_row_ids(spark.createDataFrame([(1, None), (2, "x"), (3, "")], "i int, id string"), ["i"], "id", "row-%04d").orderBy("i").collect()
    assert [r.id for r in named] == ["row-0001", "x", "row-0003"]
    assert order.numbered(df.limit(0), ["i"], "n").count() == 0

def test_scan_prefix(spark):
    rows = [("s", i, i % 3 == 0) for i in range(60)]
    got = mixing.scan_prefix(spark.createDataFrame(rows, "s string, i int, ok boolean"), "s", "i", F.col("ok"), 40, 5, 10).collect()
    seen, ok = 0, 0
    for _, _, good in rows:
        if seen >= 40 or (ok >= 5 and seen >= 10):
            break
        seen, ok = seen + 1, ok + good
    assert len(got) == seen


def test_exact_and_ledger(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "k string, n int")
    assert sorted(map(tuple, dedupe.first_of_each(df, "k", "n").collect())) == [("a", 1), ("b", 3), ("c", 4)]
    ledger = spark.createDataFrame([("b",), ("b",)], "k string")
    assert sorted(r.k for r in dedupe.not_in_ledger(df, ledger, "k").collect()) == ["a", "a", "c"]


def test_near_duplicates_equal_the_loop(spark):
    rng = random.Random(2)
    base = ["the quick brown fox jumps over the lazy dog number %d of many", "a completely different sentence about %d small things"]
    rows = []
    for i in range(90):
        t = base[i % 2] % rng.choice([1, 1, 22, 333])
        rows.append((i, "x" if i % 5 else "y", t, t[::-1]))
    want, kept = {}, {}
    for i, block, p, a in rows:
        last = kept.setdefault(block, deque(maxlen=6))
        near = any(SequenceMatcher(None, p, q).ratio() >= 0.96 and SequenceMatcher(None, a, b).ratio() >= 0.96 for q, b in last)
        want[i] = not near
        if not near:
            last.append((p, a))
    df = spark.createDataFrame(rows, "i int, block string, p string, a string")
    got = {r.i: r.kept for r in dedupe.near_duplicates(df, ["block"], "i", "p", "a", window=6).collect()}
    assert got == want


def exact_fold(rows, window, ratio=0.96):
    want, kept = {}, {}
    for i, block, p, a in rows:
        last = kept.setdefault(block, deque(maxlen=window))
        want[i] = not any(SequenceMatcher(None, p, q).ratio() >= ratio and SequenceMatcher(None, a, b).ratio() >= ratio for q, b in last)
        if want[i]:
            last.append((p, a))
    return want


@pytest.mark.parametrize("slice_rows", [5, 16, 40])
def test_near_duplicates_do_not_depend_on_slices(spark, slice_rows):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(40)) for _ in range(30)]
    rows = [(i, "hot", texts[i], texts[i][::-1]) for i in range(10)]
    rows += [(i, "hot", texts[9], texts[9][::-1]) for i in range(10, 120)] + [(120, "hot", texts[4], texts[4][::-1])]
    for i in range(121, 400):
        t = texts[rng.randrange(9 + i % 20)]
        rows.append((i, rng.choice(["hot", "hot", None, "other"]), t, t[::-1]))
    df = spark.createDataFrame(rows, "i int, block string, p string, a string")
    got = dedupe.near_duplicates(df, ["block"], "i", "p", "a", window=8, slice_rows=slice_rows).collect()
    want = exact_fold(rows, 8)
    assert len(got) == len(rows) and {r.i: r.kept for r in got} == want and want[120] is False


@pytest.mark.parametrize("n", [4_999, 5_000, 5_001, 20_000])
def test_large_blocks_are_folded_as_small_ones(spark, n):
    """Blocks around and far above the size of a slice, with many repeats: the result is the loop's."""
    rng = random.Random(n)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(40)]
    rows = [(i, "hot", texts[rng.randrange(3 + i % 38)], "same answer") for i in range(n)]
    df = spark.createDataFrame(rows, "i int, block string, p string, a string")
    got = {r.i: r.kept for r in dedupe.near_duplicates(df, ["block"], "i", "p", "a", window=12).collect()}
    kept, want = deque(maxlen=12), {}
    for i, _, p, _ in rows:  # the texts are equal or far apart
        want[i] = p not in kept
        if want[i]:
            kept.append(p)
    assert got == want


def test_parity(spark):
    pairs = [(1, "a b c", "a b d"), (2, "a b c", "x"), (3, "a", "a\ufffd"), (4, None, ""), (5, "a", None)]
    rows = {r.i: r for r in reports.parity(spark.createDataFrame(pairs, "i int, a string, b string"), "a", "b").collect()}
    assert [rows[i].passes for i in range(1, 6)] == [True, False, False, False, False] and not rows[1].ok and rows[4].score == 1.0
    good = reports.parity(spark.createDataFrame(pairs[:1], "i int, a string, b string"), "a", "b").collect()
    assert good[0].ok and good[0].score == 0.5


def test_drift_by_rows_and_modality(spark):
    df = spark.createDataFrame([("multilingual", "text", 88), ("multilingual", "image_text", 12)], "category string, modality string, t long")
    got = {(r.dimension, r.measure, r.target): r.within for r in mixing.all_drift(mixing.composition(df, "t")).collect()}
    assert len(got) == 14 and got["modality", "token_share", "text"] and not got["modality", "row_share", "text"]


def test_floor_percentiles(spark):
    rng = random.Random(3)
    data = {g: sorted(rng.randrange(30) for _ in range(n)) for g, n in (("a", 1), ("b", 10), ("c", 101))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v long")
    for r in reports.floor_percentiles(df, "g", "v", (0.1, 0.5, 0.9)).collect():
        vs = data[r.g]
        assert [r.p10, r.p50, r.p90] == [vs[int((len(vs) - 1) * p)] for p in (0.1, 0.5, 0.9)] and r.mean == pytest.approx(sum(vs) / len(vs))


def test_majority_and_best(spark):
    df = spark.createDataFrame([("u", "x", 3), ("u", "y", 1), ("u", "y", 2), ("u", "x", 4), ("v", None, 5)], "u string, a string, o int")
    assert [(r.u, r.answer, r.votes) for r in reports.majority(df, "u", "a", "o").collect()] == [("u", "y", 2)]
    scored = spark.createDataFrame([("g", 1.0, 2), ("g", 3.0, 5), ("g", 3.0, 4)], "g string, s double, i int")
    assert [tuple(r) for r in rubric.best_of(scored, ["g"], "s", "i").collect()] == [("g", 3.0, 4)]


def test_rubric(spark):
    good = "I am veyra-2 by noctule and I can sort your notes, labels and lists with care today."
    df = spark.createDataFrame([(good, "en"), (good, "ru"), ("let me think", "en"), ("", None)], "t string, l string")
    terms = rubric.Rubric(("veyra-2", "noctule"))
    scores = [r[0] for r in df.select(terms.total(F.col("t"), F.col("l"))).collect()]
    assert scores[0] == 100.0 and scores[1] < 110 - 4 and scores[2] == 63.273 and 0 <= scores[3] < 90
    parts = df.select(*[c.alias(n) for n, c in terms.components(F.col("t"), F.col("l"), F.lit("multimodal_identity")).items()], terms.issues(F.col("t"), F.col("l")).alias("issues")).collect()
    assert parts[0].capability_accuracy == 9.0 and parts[0].issues == [] and parts[1].issues == ["lang:expected_cyrillic"]
    assert parts[2].issues == ["missing_name", "missing_maker", "too_short", "possible_forbidden", "cot_leak:let me think"] and parts[2].identity_fidelity == 2.0


def test_failures_and_pairs(spark):
    good = "I am veyra-2 by noctule and I can sort your notes, labels and lists with care today."
    df = spark.createDataFrame([(f"i{k}", good, "en", "tone") for k in range(40)] + [("bg", good, "bg", "tone")], "id string, answer string, language string, category string")
    terms = rubric.Rubric(("veyra-2", "noctule"))
    made = df.limit(1).select(*[rubric.worsen(F.col("answer"), F.col("language"), F.lit(m)).alias(m) for m in (*rubric.FAILURES, "none")]).first()
    assert made.fake_tool == good + " I can call internal tools to verify that right now." and made.none == good
    assert made.too_long.count("I am being extra verbose") == 30 and made.multilingual_inconsistent.endswith("\nCeci est mixed with the wrong language.")
    every = rubric.rejected_candidates(df, terms).collect()
    assert {tuple(r.failure_modes) for r in every if r.id == "i0"} <= {(m,) for m in rubric.PREFERRED[:6]} and all(r.margin >= 0.8 for r in every)
    pairs = rubric.least_used(rubric.rejected_candidates(df, terms), "id")
    assert sorted(r.id for r in pairs.collect()) == sorted({r.id for r in every})
    used = {r.mode: r.n_used for r in rubric.mode_usage(pairs).collect()}
    assert sum(used.values()) == 41 and len(used) > 1
    assert len(rubric.mode_pairs()) == 6 and rubric.mode_pairs()[0] == ("fake_tool", "fake_browsing")
    totals = {r.component: r.total for r in rubric.component_totals(spark.createDataFrame([((1.0, -2.0),), ((2.5, None),)], "c struct<a:double,b:double>"), "c").collect()}
    assert totals == {"a": 3.5, "b": 0.0}


def test_review(spark):
    text = "I am veyra-2 by noctule."
    rows = [
        ("a", "r", "q", text, 2, 90.0), ("a", "r", "q2", text, 2, 90.0), ("b", "r", "Q ", text, 2, 90.0), ("c", "x", "q3", text, 2, 90.0), ("d", "r", "q4", "no names", 2, 90.0),
        ("e", "r", "q5", text + " <think>", 2, 90.0), ("f", "r", "q6", text, 2, 10.0), ("g", "r", "q6", text, 2, None), ("h", "r", "q7", " ", 2, 90.0), ("i", "r", "q7", text, 1, 90.0), ("", "r", "q8", text, 2, 90.0),
    ]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "id string, run_id string, prompt string, answer string, n_messages int, total double, place int")
    got = {r.place: r.reason for r in review.review_answers(df, F.lit("r"), ("veyra-2", "noctule"), "place").collect()}
    assert [got[k] for k in range(11)] == [None, "duplicate_id", "exact_duplicate", "run_id_mismatch", "identity_drift", "forbidden:<think>", "low_score", None, "assistant_text_empty", "messages_invalid", "invalid_id"]
    pairs = [("a", text, "x", 9.0, 8.0, 1.0, ["fake_tool"]), ("b", text, "x", 8.0, 8.0, 0.0, ["fake_tool"]), ("c", text, "x", 9.0, 8.5, 0.5, ["fake_tool"]), ("d", text, "x", 9.0, 8.0, 1.0, []), ("e", text, "x", 9.0, 8.0, 1.0, ["zz", "fake_tool", "aa"]), ("f", text, " ", 9.0, 8.0, 1.0, ["fake_tool"]), ("g", text, "x", None, 8.0, 1.0, ["fake_tool"])]
    df = spark.createDataFrame([(*r, "r", f"q{k}", k) for k, r in enumerate(pairs)], "id string, chosen string, rejected string, chosen_score double, rejected_score double, margin double, failure_modes array<string>, run_id string, prompt string, place int")
    got = {r.id: r.reason for r in review.review_preferences(df, F.lit("r"), ("veyra-2", "noctule"), "place").collect()}
    assert got == {"a": None, "b": "margin_invalid", "c": "margin_too_low", "d": "failure_modes_missing", "e": "failure_mode_not_allowed:aa,zz", "f": "rejected_top_level_empty", "g": "score_invalid"}


def test_weights_and_targets():
    assert mixing.checked_weights({"b": 3, "a": 1}) == {"a": 0.25, "b": 0.75}
    for wrong in ({}, {"a": -1.0, "b": 2.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            mixing.checked_weights(wrong)
    mixing.assert_targets({"a": 0.65, "z": 1.0}, {"a": 0.7}, 0.1)
    with pytest.raises(ValueError, match="of a"):
        mixing.assert_targets({"a": 0.5}, {"a": 0.7}, 0.1)
