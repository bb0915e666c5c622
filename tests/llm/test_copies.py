import itertools
import json
import random

import pytest

from sievewright.llm import copies, format_copies, visual

MESSAGES = "array<struct<role:string,content:string>>"


def brute_pairs(keys):
    ids = sorted({i for i, _ in keys})
    of = {}
    for i, k in keys:
        if k is not None:
            of.setdefault(i, set()).add(k)
    return {(a, b) for a, b in itertools.combinations(ids, 2) if of.get(a, set()) & of.get(b, set())}


@pytest.mark.parametrize("limits", [{}, {"range_rows": 5}])
def test_classes_and_pairs_equal_brute_force(spark, limits):
    rng = random.Random(1)
    # One key holds a third of the rows; ids repeat; keys share hashes never, but texts are alike.
    keys = [(f"i{rng.randrange(90):03d}", rng.choice(["hot", "hot", "b", "c", None, f"k{n % 20}", f"u{n}"])) for n in range(150)]
    keys = list({i: (i, k) for i, k in keys}.values())
    df = spark.createDataFrame([("t", i, k, 1) for i, k in keys + keys[:20]], "g string, id string, key string, class_id int").drop("class_id")
    members = copies.classes(df, ["g"], "id", "key", **limits).distinct()
    got = {(r.id_a, r.id_b) for r in copies.pairs(members, ["g"], "id", block=4).collect()}
    assert got == brute_pairs(keys)
    for r in members.collect():
        assert r.class_id == min(i for i, k in keys if k == dict(keys)[r.id])
    rows = copies.pairs(members, ["g"], "id", block=4).collect()
    assert len(rows) == len(set(rows))  # each pair once
    assert set(copies.pairs(members, ["g"], "id", block=4, hot_rows=10).collect()) == set(rows)


def tables(spark, sft=(), pref=(), raw=()):
    return (
        spark.createDataFrame(list(sft), f"id string, messages {MESSAGES}, key string"),
        spark.createDataFrame(list(pref), f"id string, prompt string, prompt_messages {MESSAGES}, chosen string, __h long"),
        spark.createDataFrame(list(raw), "raw_id string, payload string, class_id string"),
    )


def test_formatting_is_ignored(spark):
    a = [("user", "Straße, HELLO  world!"), ("assistant", "Yes.")]
    b = [("User ", "strasse hello world"), ("assistant", json.dumps([{"type": "text", "text": "YES"}, {"type": "image", "image_path": "x"}]))]
    c = [("assistant", "strasse hello world"), ("user", "yes")]
    d = [("user", "strasse hello worlds"), ("assistant", "yes")]
    blank = [("user", "  "), ("assistant", None)]
    sft = [("1", a, "x"), ("2", b, "x"), ("3", c, "x"), ("4", d, "x"), ("2", b, "x"), ("5", blank, "x"), ("6", blank, "x"), ("7", None, "x"), (None, a, "x"), ("8", [("user", "...")], "x")]
    pref = [("p1", "A b", None, "C", 1), ("p2", None, [("user", "a B!"), ("assistant", "no")], "c.", 1), ("p3", "ab", None, None, 1), ("p4", "A  B", None, None, 1)]
    one = json.dumps({"messages": [{"role": "user", "content": "Hi"}], "lang": "en"}, indent=2)
    two = json.dumps({"lang": "de", "messages": [{"content": "hi!", "role": "user"}]})
    raw = [("r1", one, "x"), ("r2", two, "x"), ("r3", "{broken", "x"), ("r4", "{broken", "x"), ("r5", None, "x"), ("r6", "[]", "x"), ("r7", '{"messages": [null, 3], "prompt": 4}', "x")]
    got = {tuple(r) for r in format_copies.copy_pairs(*tables(spark, sft, pref, raw)).collect()}
    assert got == {("sft_rows", "1", "2"), ("preference_rows", "p1", "p2"), ("preference_rows", "p3", "p4"), ("raw_records", "r1", "r2")}
    counts = {(r.table_name, r.representative_id): r.n_copies for r in format_copies.collapse(*tables(spark, sft, pref, raw)).collect()}
    assert counts["sft_rows", "1"] == 2 and counts["sft_rows", "3"] == 1 and ("sft_rows", "5") not in counts


def test_empty_tables(spark):
    assert format_copies.copy_pairs(*tables(spark)).count() == 0 and format_copies.collapse(*tables(spark)).count() == 0


def test_canonical_forms():
    form = visual.canonical_form
    assert form("ｌｕｎｃｈ　ﬁle‑x") == "lunch file-x"
    assert form("е́") == form("é") == form("é") == "é"
    assert form("й") == form("й") == "й" and form("и") != form("й")
    assert form("a​́b­c﻿") == "ábc"
    assert form("Αlthοugh") == "Although" and form("⼈") == "人" and form("أ") == "أ"
    assert form("x²") == "x²" and form("①") == "①" and form("З") != form("3") and form("О") != form("0")
    assert not visual.conflicts(visual.TABLE)
    assert visual.conflicts({"a": "X", "A": "X"}) and visual.conflicts({"b": "c", "c": "d"})
    rng = random.Random(4)
    alphabet = "aäαаàάé́ ̈‍ﬁＡ人⼈\nй 9٣"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(9)))
        assert form(form(text)) == form(text), ascii(text)


def test_same_look(spark):
    texts = {1: "A note", 2: "А note", 3: "A note", 4: "A note", 5: "a note", 6: None, 7: "  ", 8: " ", 9: "x" * 50_000 + "о", 10: "x" * 50_000 + "o"}
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, digest int")
    want = {(a, b) for a, b in itertools.combinations((1, 2, 3, 4), 2) if texts[a] != texts[b]} | {(9, 10)}
    assert {tuple(r) for r in visual.same_look(docs).collect()} == want
    assert {r.doc_id: r.form for r in visual.canonical_documents(docs).collect()}[6] is None
    assert visual.same_look(docs.limit(0)).count() == 0


DIFFERENT = [  # what a reader tells apart
    ("\u0600\u0661", "\u0661"), ("\u0622\u06dd", "\u0622"), ("\u0645\u06cc\u200c\u062e\u0648\u0627\u0647\u0645", "\u0645\u06cc\u062e\u0648\u0627\u0647\u0645"), ("\u0647\u200d", "\u0647"),
    ("\U0001f468\u200d\U0001f469\u200d\U0001f467", "\U0001f468\U0001f469\U0001f467"), ("\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f", "\U0001f3f4"),
    ("\u0915\u094d\u200d\u0937", "\u0915\u094d\u0937"), ("\u2764\ufe0f", "\u2764"), ("\u0438\u0306", "\u0438"), ("\u0436", "ӝ"), ("\u0386", "\u00c1"), ("\ufdfa", "\u0635\u0644\u0649"), ("abc", "\u202eabc"),
    ("\u2075", "5"), ("a\u0301", "a\u0300"), ("\u0423", "\u04ae"), ("l", "I"),
]
SAME = [  # what looks the same
    ("a\u200cb", "ab"), ("\u0627\u200c\u0628", "\u0627\u0628"), ("\u0435\u0308", "\u00eb"), ("\u0451", "e\u0308"), ("\u03bf\u0301", "\u00f3"), ("a\u0301\u0323", "a\u0323\u0301"), ("\ufefb", "\u0644\u0627"), ("a\r\nb", "a\nb"),
    ("a\u2028b", "a\nb"), ("\u1112\u1161\u11ab", "\ud55c"), ("\uff76\uff9e", "\u30ac"), ("\ufb01\u0301", "f\u00ed"), ("a\ufe0f", "a"), ("\u2800", " "), ("\u0430\u0306", "\u0103"), ("\uff71\uff99", "\u30a2\u30eb"),
]


def test_what_a_reader_tells_apart_stays_apart_and_the_rest_meets():
    form = visual.canonical_form
    for a, b in DIFFERENT:
        assert form(a) != form(b), (ascii(a), ascii(b))
    for a, b in SAME:
        assert form(a) == form(b), (ascii(a), ascii(b), ascii(form(a)), ascii(form(b)))


def test_clusters_equal_canonical_composition_and_forms_stay():
    import unicodedata

    form, rng = visual.canonical_form, random.Random(2)
    marks = [chr(x) for x in (*range(0x300, 0x330), 0x61, 0x65, 0x1EA1, 0xE9, 0x1100, 0x1161, 0x11A8, 0x5D0, 0x5B4, 0x5BC, 0x622, 0x654)]
    more = [*marks, *map(chr, (0x200B, 0x200C, 0x200D, 0xFE0F, 0x1F468, 0x2764, 0x628, 0x627, 0x94D, 0x915, 0xE0067, 0x1F3F4, 13, 10, 0xAD, 0xFE8E, 0xFB1D, 0xFF76, 0xFF9E, 0xFFA1, 0xFFC2, 0x439, 0x435))]
    for _ in range(20_000):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(1, 6)))
        assert form(text) == unicodedata.normalize("NFC", text)
        text = "".join(rng.choice(more) for _ in range(rng.randrange(1, 7)))
        assert form(form(text)) == form(text), ascii(text)


def test_conflict_check_sees_what_a_reader_tells_apart():
    for table in ({"и": "n", "п": "n"}, {"é": "e"}, {"x": ""}, {"1": "l"}, {"\u06dd": "a"}, {"г": "r", "я": "r"}):
        assert visual.conflicts(table), table
