import base64
import os
import random

import numpy as np
import pytest

from sievewright.llm import containers, mixing, tokens
from sievewright.llm.queries import TOKENIZER, TOKENIZERS

pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")
TEXTS = [
    None, "", " ", "Hello, world! It's 12345 o'clock…", "naïve café  \n\n x", "混合文字 and 日本語", "\x1c\x1d sep", "<|endoftext|> is text",
    "word " * 3000, "مرحبا بالعالم ١٢٣", "a" * 2000, "tab\t\tand  spaces   ", "emoji 😀😀 👍🏽", "don't you've I'LL",
]


def reference(text):
    import tiktoken

    with open(TOKENIZER.path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("x", pat_str=tokens.BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return len(encoding.encode_ordinary(text or ""))


@pytest.mark.parametrize("limits", [{}, {"block_records": 2, "block_pieces": 3}, {"block_records": 1, "hot_blocks": 2}])
def test_record_tokens_are_exact(spark, limits):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, pieces int")
    got = {r.doc_id: r.n_tokens for r in tokens.record_tokens(df, ["doc_id", "block"], "text", TOKENIZER, **limits).collect()}
    known = [reference(t) for t in TEXTS] * 3
    assert got == dict(enumerate(known))
    assert tokens.record_tokens(df.limit(0), ["doc_id"], "text", TOKENIZER).count() == 0


def test_messages_and_json_tokenizer(spark):
    from tokenizers import Tokenizer as Json

    rows = [(1, [("user", "Hi There"), ("assistant", '[{"type": "text", "text": "ok then"}]'), ("x", None)]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    own = tokens.Tokenizer(TOKENIZERS, "byte_bpe_50k.json")
    got = {r.id: r.n_tokens for r in tokens.record_tokens(df, ["id"], "messages", own).collect()}
    encode = lambda t: len(Json.from_file(own.path).encode(t, add_special_tokens=False).ids)
    assert got == {1: encode("Hi There") + encode("ok then"), 2: 0, 3: 0}


def test_totals_add_up(spark):
    rows = [("documents", str(i), random.Random(i).choice("ab"), "en", None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "table_name string, record_id string, source string, language string, category string, n_tokens long")
    by = tokens.totals(df).collect()
    for grouping in {r.grouping for r in by}:
        assert sum(r.n_tokens for r in by if r.grouping == grouping) == sum(range(50))


def brute_first_fit(sizes, capacity, separator):
    free, bins = [], []
    for s in sizes:
        for b, room in enumerate(free):
            if room >= s + (separator if room < capacity else 0):
                free[b] -= s + (separator if room < capacity else 0)
                break
        else:
            b = len(free)
            free.append(capacity - s)
        bins.append(b)
    return bins


def test_first_fit_decreasing_equals_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        capacity, separator = rng.randrange(5, 60), rng.choice([0, 1, 2])
        sizes = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 60))), reverse=True)
        bins, places = containers.first_fit_decreasing(np.array(sizes), capacity, separator)
        assert bins.tolist() == brute_first_fit(sizes, capacity, separator)
        for b in set(bins.tolist()):
            inside = [s for s, x in zip(sizes, bins) if x == b]
            assert sum(inside) + separator * (len(inside) - 1) <= capacity and sorted(places[bins == b].tolist()) == list(range(len(inside)))


def test_packing(spark):
    rng = random.Random(6)
    sizes = [(i, rng.choice([0, None, rng.randrange(1, 90), 100, 257])) for i in range(300)]
    df = spark.createDataFrame([(i, n, 1) for i, n in sizes], "doc_id long, n_tokens long, capacity int")
    specs = spark.createDataFrame([("a", 100, 1), ("a", 100, 1), ("b", 64, None), ("none", 0, 1), (None, 5, 1)], "container_name string, capacity_tokens int, separator_tokens int")
    rows = containers.pack(df, specs, group_items=50).collect()
    for name, capacity, separator in (("a", 100, 1), ("b", 64, 0)):
        mine = [r for r in rows if r.container_name == name]
        inside = {}
        for r in mine:
            inside.setdefault((r.group_no, r.container_no), []).append(r.n_tokens)
        assert all(sum(x) + separator * (len(x) - 1) <= capacity for x in inside.values())
        by = {}
        for r in mine:
            by.setdefault(r.doc_id, []).append(r)
        assert {d: sum(r.n_tokens for r in x) for d, x in by.items()} == {i: n for i, n in sizes if n}
        assert all(len(x) == (1 if dict(sizes)[d] <= capacity else -(-dict(sizes)[d] // capacity)) for d, x in by.items())
    assert {r.container_name for r in rows} == {"a", "b"}
    assert containers.pack(df.limit(0), specs).count() == 0 and containers.pack(df, specs.limit(0)).count() == 0


def test_pfair_is_less_than_one_block_off():
    rng = random.Random(7)
    for _ in range(20):
        weights = mixing.whole_weights([rng.random() ** 2 + 1e-3 for _ in range(rng.randrange(1, 12))], 1000)
        slots = mixing.pfair_schedule(weights, 1000)
        assert sum(weights) == 1000 and len(slots) == 1000
        given = [0] * len(weights)
        for t, s in enumerate(slots, start=1):
            given[s] += 1
            assert all(abs(g - t * w / 1000) < 1 for g, w in zip(given, weights))
        assert given == weights


def test_quotas():
    assert mixing.quotas([100, 10], [0.5, 0.5], [1, 2], None) == [20.0, 20.0]
    assert mixing.quotas([100, 10], [0.5, 0.5], [1, 2], 60) == [40.0, 20.0]
    assert mixing.quotas([0, 10], [0.5, 0.5], [1, 1], None) == [0.0, 10.0] and mixing.quotas([], [], [], None) == []


@pytest.mark.parametrize("total", [None, 3000])
def test_mixture(spark, total):
    rng = random.Random(8)
    docs = [(i, rng.choice(["A", " a", "b", "B", "c", "other", None]), rng.randrange(0, 40)) for i in range(900)]
    docs += [(1000 + i, "small", 10) for i in range(5)]
    df = spark.createDataFrame([(i, s, n, 3) for i, s, n in docs], "doc_id long, source string, n_tokens long, slot int")
    sources = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, None), ("c", 0.1, 2), ("small", 0.1, 4), ("ghost", 0.0, 1), ("a", 0.5, 1)], "source_id string, target_share double, max_repeats int")
    rows = mixing.mix(df, sources, total, block_tokens=50, bucket_rows=40).collect()
    copies = {}
    for r in rows:
        copies.setdefault((r.source, r.doc_id), []).append(r.copy)
    limit = {"a": 1, "b": 1, "c": 2, "small": 4}
    assert all(len(x) == len(set(x)) <= limit[s] for (s, _), x in copies.items())
    tokens_of = {}
    for r in rows:
        tokens_of[r.source] = tokens_of.get(r.source, 0) + r.n_tokens
    if total is None:  # 50 tokens, four times, are a tenth: 2,000 in all
        assert tokens_of["small"] == 200
        for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
            assert abs(tokens_of[s] / sum(tokens_of.values()) - share) < 0.02
    report = {r.source: r for r in mixing.shares(mixing.mix(df, sources, total, 50, bucket_rows=40), sources).collect()}
    assert sum(r.actual_share for r in report.values()) == pytest.approx(1) and report["ghost"].n_records == 0
    assert mixing.mix(df.limit(0), sources).count() == 0 and mixing.mix(df, sources.limit(0)).count() == 0


def test_small_shares_keep_their_records(spark):
    assert mixing.whole_weights([1.0, 1e-6, 1e-6, 0.0], 10) == [8, 1, 1, 0] and mixing.whole_weights([1.0] * 10, 10) == [1] * 10
    assert mixing.period_for([0.5, 0.5]) == 10_000 and mixing.period_for([1.0, 2e-5]) == 50_000 and mixing.period_for([1.0, 1e-9]) == 50_000
    docs = [(i, "a", 1000, 1) for i in range(100)] + [(1000, "tiny", 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long, slot int")
    sources = spark.createDataFrame([("a", 0.99999, 1), ("tiny", 0.00001, 1)], "source_id string, target_share double, max_repeats int")
    rows = mixing.mix(df, sources).collect()
    assert [r.doc_id for r in rows if r.source == "tiny"] == [1000] and len(rows) == 100
    assert len({(r.slot, r.place) for r in rows}) == len(rows)


def test_the_smallest_sources_are_spread(spark):
    """A source of a millionth comes at its release times, not at the begin of each period."""
    docs = [(i, "a", 50_000, 1) for i in range(2_000)] + [(10_000 + i, "tiny", 1, 1) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long, slot int")
    sources = spark.createDataFrame([("a", 1 - 1e-6, 1), ("tiny", 1e-6, 1)], "source_id string, target_share double, max_repeats int")
    rows = mixing.mix(df, sources, block_tokens=1).collect()
    tiny = sorted(r.slot for r in rows if r.source == "tiny")
    assert len(tiny) >= 99 and all(abs(slot - k * 1_000_000) <= 1_000_000 for k, slot in enumerate(tiny)) and len({(r.slot, r.place) for r in rows}) == len(rows)


def test_registered_mixture_reports_uneven_shares(spark):
    """A mixture as large as its sources: repeats stay within their cap and shares are reported as they are."""
    from sievewright.llm import queries

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    rows = queries.p8_filled_shares(spark, folder).collect()
    assert sum(r.actual_share for r in rows) == pytest.approx(1)
    assert all(r.repeats <= (r.max_repeats or 1) for r in rows) and any(r.repeats > 1 for r in rows)
    assert any(abs(r.actual_share - r.target_share) > 0.001 for r in rows)
    balanced = queries.p8_shares(spark, folder).collect()
    assert sum(r.n_tokens for r in rows) > sum(r.n_tokens for r in balanced)


def test_message_lists_of_slices():
    import pyarrow as pa

    from sievewright.llm.records import message_lists

    rows = [[{"role": "user", "content": f"t{i}"}, {"role": None, "content": None}][: i % 3] if i % 4 else None for i in range(20)]
    column = pa.array(rows, pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())])))
    want = [[m["content"] or "" for m in r] if r else [] for r in rows]
    for start, length in ((0, 20), (3, 7), (19, 1), (20, 0), (5, 0)):
        assert message_lists(column.slice(start, length)) == want[start : start + length]
    assert message_lists(column.slice(6, 5), "role") == [[m["role"] or "" for m in r] if r else [] for r in rows][6:11]
