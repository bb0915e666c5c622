import json

import pytest
from pyspark.sql import functions as F

from sievewright.operators import filters, normalize, reports
from sievewright.sources import dispatch, jsonl, sinks

MESSAGE = "array<struct<role:string,content:string>>"
ROW = f"schema_version string, id string, source_id string, license string, modality string, thinking string, chat_template_kwargs struct<enable_thinking:boolean>, messages {MESSAGE}, private_local_attestation struct<provenance_attestation:string,license:string,redistribution_allowed:boolean,pii_policy:string>"
GOOD = dict(
    schema_version="1.0", id="a", source_id="PRIVATE_LOCAL_01", license="MIT", modality="text", thinking="off", chat_template_kwargs=(False,), messages=[("user", "Hello"), ("assistant", "Hi")],
    private_local_attestation=("mine", "MIT", False, "none"),
)
PICTURE = json.dumps([{"type": "image", "image": "image://x"}, {"type": "text", "text": "look"}])


def rows(spark, changes):
    return spark.createDataFrame([tuple((GOOD | c).values()) for c in changes], ROW)


def test_strict_rows(spark):
    changes = [
        ({}, "ok"), (dict(schema_version="2.0"), "schema_version"), (dict(id=" "), "id"), (dict(source_id=None), "source_id"), (dict(license=""), "license"), (dict(modality="audio"), "modality"), (dict(modality=None), "ok"),
        (dict(messages=[]), "messages"), (dict(messages=None), "messages"), (dict(messages=[("tool", "x")]), "role"), (dict(messages=[("user", None)]), "content"), (dict(messages=[("assistant", "x")]), "user_prompt"),
        (dict(messages=[("user", "q"), ("assistant", "<think>x")]), "marker"), (dict(messages=[("user", "q"), ("assistant", json.dumps([{"type": "text", "text": "scratchpad"}]))]), "marker"),
        (dict(thinking="on"), "thinking"), (dict(thinking=None), "ok"), (dict(chat_template_kwargs=(True,)), "chat_template_kwargs"), (dict(private_local_attestation=None), "attestation"), (dict(private_local_attestation=("mine", "MIT", None, "none")), "attestation"),
        (dict(source_id="public", private_local_attestation=None), "ok"), (dict(modality="image_text", messages=[("user", PICTURE), ("assistant", "ok")]), "ok"), (dict(modality="image_text"), "image:user_content"),
        (dict(modality="image_text", messages=[("user", json.dumps([{"type": "text", "text": "x"}]))]), "image:no_user_image"), (dict(modality="image_text", messages=[("user", json.dumps([{"type": "image"}, {"type": "text", "text": "x"}]))]), "image:image_reference"),
        (dict(modality="image_text", messages=[("user", json.dumps([{"type": "video", "text": "x"}, {"type": "text", "text": "x"}]))]), "image:block_type"),
    ]
    df = rows(spark, [c for c, _ in changes])
    assert [r[0] for r in df.select(filters.strict_reason(df)).collect()] == [w for _, w in changes]
    assert {r[0] for r in df.where("modality = 'image_text'").select(filters.identity_reason(df)).collect()} == {"ok"}
    marked = df.withColumn("i", F.monotonically_increasing_id()).withColumn("reason", filters.strict_reason(df))
    first = filters.first_error(marked, "reason", ["i"]).first()
    assert first.first_error == "rows[1]: schema_version" and first.n_invalid == sum(w != "ok" for _, w in changes)
    with pytest.raises(Exception, match=" id=a"):
        filters.enforce(df, filters.strict_reason(df), "id").collect()
    assert filters.enforce(df.limit(1), filters.strict_reason(df), "id").count() == 1
    with pytest.raises(Exception, match="think_open"):
        filters.require_no_markers(spark.createDataFrame([("<think>",)], "t string"), F.col("t")).collect()


def test_strict_preferences(spark):
    schema = f"id string, source_id string, license string, prompt string, prompt_messages {MESSAGE}, chosen string, rejected string, thinking string, chat_template_kwargs struct<enable_thinking:boolean>"
    base = ("p", "s", "MIT", None, [("user", "Hello there")], "a", "b", "off", None)
    changed = lambda **c: tuple((dict(zip(("id", "source_id", "license", "prompt", "prompt_messages", "chosen", "rejected", "thinking", "kw"), base)) | c).values())
    cases = [
        (changed(), "ok"), (changed(prompt_messages=None), "prompt"), (changed(prompt_messages=[("tool", "x")]), "role"), (changed(prompt_messages=[("user", None)]), "content"), (changed(prompt="x", prompt_messages=[("tool", "x")]), "ok"),
        (changed(chosen=" "), "chosen"), (changed(rejected=None), "rejected"), (changed(license=None), "license"), (changed(thinking="yes"), "thinking"), (changed(kw=(True,)), "chat_template_kwargs"), (changed(rejected="scratchpad: x"), "marker"),
        (changed(source_id="private_local_9"), "attestation"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], schema)
    assert [r[0] for r in df.select(filters.preference_reason(df)).collect()] == [w for _, w in cases]


def test_normalised_rows(spark):
    df = spark.createDataFrame([("a", None, "u", None, None, None), (None, " ", None, [("user", "x"), ("assistant", PICTURE), ("user", "y")], "c", "s")], f"id string, prompt string, response string, prompt_messages {MESSAGE}, chosen string, source string")
    made = normalize.identity_rows(df).collect()
    assert made[0].messages[0].content == normalize.NO_PROMPT and made[0].messages[1].content == "u" and made[0].source_id == "identity_pack" and made[1].source_id == "s" and made[1].license == "operator_provided"
    pref = df.withColumn("rejected", F.lit(None).cast("string"))
    report, strict = normalize.preference_rows(pref).collect(), normalize.preference_rows(pref, identity=True).collect()
    assert report[0].prompt == "No prompt provided" and report[1].prompt == "x y" and report[1].source_id == "s" and report[0].source_id == "unknown" and report[0].chosen == ""
    assert strict[1].prompt == "x look y" and strict[0].chosen == normalize.NO_CHOSEN and strict[1].rejected == normalize.NO_REJECTED and strict[0].source_id == "identity_pack_preferences"
    names = spark.createDataFrame([(None, " de "), ("fr", "x"), (" ", None)], "meta string, own string")
    assert [r[0] for r in names.select(normalize.language(F.col("own"), F.col("meta"))).collect()] == ["de", "fr", "unknown"]


def test_messages_of_all_kinds(spark):
    rows_ = [([("User ", "a  b"), ("tool", "x"), (None, PICTURE), ("assistant", json.dumps([{"type": "image", "image_path": "/p.png"}]))],), ([("user", "")],), (None,)]
    df = spark.createDataFrame(rows_, f"messages {MESSAGE}")
    m = F.col("messages")
    got = df.select(
        normalize.canonical_messages(m).alias("legacy"), normalize.storage_messages(m).alias("stored"), normalize.approximate_text(m).alias("about"), normalize.user_prompts(m).alias("prompts"), normalize.concrete_image(m).alias("real"),
        normalize.image_kinds(m).alias("kinds"),
    ).collect()
    assert [(x.role, x.content) for x in got[0].legacy] == [("user", "a b")] and got[0].about == "a b\nx\n[image]\nlook\n[image]" and got[0].real and got[0].kinds == ["placeholder_uri", "image_path"]
    assert [len(x.content) for x in got[0].stored] == [1, 1, 2, 1] and got[0].stored[2].role == "user" and got[0].stored[0].content[0].text == "a  b"
    assert got[2].legacy is None and not got[2].real and got[1].prompts == ""
    with pytest.raises(Exception, match="real image"):
        normalize.text_only(df.withColumn("modality", F.lit("x"))).collect()
    placed = spark.createDataFrame([([("user", PICTURE), (None, json.dumps([{"type": "image", "image": "image://y"}]))],)], f"messages {MESSAGE}")
    one = normalize.text_only(placed).first()
    assert one.collapsed and one.modality == "text" and [x.content for x in one.messages] == ["look", "Image reference omitted for text-only training."] and one.messages[1].role == "user"
    state = normalize.surface(placed.unionByName(df.where("size(messages) = 1"))).first()
    assert (state.row_count, state.multimodal_rows, state.placeholder_image_rows, state.concrete_image_rows, state.training_surface) == (2, 1, 1, 0, "text_only_placeholder_fallback")


def test_image_and_text_records(spark):
    df = spark.createDataFrame([("1", " What? ", ["b", "a", " a ", "b"], "p"), ("2", "", ["a"], "p"), ("3", "q", [], "p"), ("4", "q", ["x"], None)], "id string, q string, a array<string>, image string")
    got = normalize.image_rows(df, F.col("q"), F.col("a"), F.col("image"), F.col("id")).collect()
    assert [(r.id, r.question, r.answer) for r in got] == [("1", "What?", "b")]
    pairs = spark.createDataFrame([([(None, "x"), ("q", " "), (" q2 ", "a2"), ("q3", "a3")],), ([],)], "p array<struct<question:string,answer:string>>")
    first = [r[0] for r in pairs.select(normalize.first_pair(F.col("p"))).collect()]
    assert (first[0].question, first[0].answer, first[0].at) == ("q2", "a2", 2) and first[1] is None
    made = df.limit(1).select(normalize.text_record(F.col("id"), F.lit("s"), F.lit("b"), F.col("q"), F.lit("ok"), F.lit("en"), F.col("image")).alias("r")).first().r
    assert made.modality == "multimodal" and json.loads(made.messages[0].content)[1] == {"type": "image", "image": "p"} and made.meta.thinking_disabled


def test_text_rows_append_the_preferred_answer(spark):
    record = json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}, {"role": "user", "content": "q2"}], "response1": "x", "response2": "y", "overall_preference": 1})
    df = spark.createDataFrame([("1", "s", record), ("2", "t", record)], "id string, source string, payload string")
    got = {r.id: [m.content for m in r.chat] for r in normalize.text_rows(df, "payload", "id", "source", ("s",)).collect()}
    assert got == {"1": ["q", "a", "q2", "y"], "2": ["q", "a", "q2"]}


def test_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": "a"}\n\n[1]\n{"id": "b"}\n{broken\n{"id": "c"}\n', encoding="utf-8")
    name = f"file://{path}"
    assert jsonl.count_lines(spark, name) == 6 and [r.id for r in jsonl.read_limited(spark, name, 4).orderBy("id").collect()] == ["a", "b"]
    assert [r.id for r in jsonl.read_limited(spark, name, 2).collect()] == ["a"]
    with pytest.raises(Exception, match="invalid JSON at line 5"):
        jsonl.read_limited(spark, name).collect()
    quality = jsonl.line_quality(spark, name).first()
    assert (quality.n_good, quality.n_bad, quality.first_error) == (4, 1, "line:5")
    missing = jsonl.line_quality(spark, f"file://{tmp_path}/none.jsonl").first()
    assert (missing.n_good, missing.n_bad, missing.first_error) == (0, 1, "missing_file:none.jsonl")
    for n in ("sft_chunk_0001.jsonl", "sft_chunk_000a.jsonl"):
        (tmp_path / n).write_text('{"id": "x"}\n')
    assert [r.chunk for r in jsonl.read_chunks(spark, f"file://{tmp_path}", "sft_chunk_????.jsonl").collect()] == ["sft_chunk_0001.jsonl"]
    (tmp_path / "code").mkdir()
    (tmp_path / "code" / "a.py").write_text("old_name = 1\nx\nold_name\n")
    (tmp_path / "code" / "b.bin").write_text("old_name")
    hits = jsonl.scan_patterns(spark, f"file://{tmp_path}/code", {"old": "old_name", "other": "zzz"})
    assert sorted((r.pattern, r.line) for r in hits.collect()) == [("old", 1), ("old", 3)]
    counted = jsonl.pattern_hits(hits, ("old",)).first()
    assert (counted.n_lines, counted.n_files, counted.violation) == (2, 1, True)


def test_sources(spark, tmp_path):
    allowed = dispatch.allowlist([{"source_id": "a", "enabled": True}, {"source_id": "b", "enabled": False}, {"source_id": "b", "enabled": True}, {"source_id": "c"}, {"x": 1}])
    assert dispatch.assert_allowed("b", allowed)["enabled"] is True
    for name in ("c", "d"):
        with pytest.raises(dispatch.NotAllowed):
            dispatch.source_records(spark, {"source_id": name}, "local", allowed)
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "1"}\n{"id": "2"}\n')
    entry = {"source_id": "a", "local_path": f"file://{path}"}
    assert dispatch.source_records(spark, entry, "local", allowed, 1).count() == 1 and dispatch.load_source(spark, entry, "local", allowed).count() == 2
    with pytest.raises(ValueError):
        dispatch.source_records(spark, {"source_id": "a"}, "local", allowed)
    spark.range(5).write.parquet(f"file://{tmp_path}/hub/a/train")
    assert dispatch.source_records(spark, {"source_id": "a"}, "hub", allowed, 3, f"file://{tmp_path}/hub").count() == 3
    attested = {"private_local_x": {"enabled": True, "source_mode": "local", "private_local_attestation": {"provenance_attestation": "p", "license": "l", "pii_policy": "n", "redistribution_allowed": False}}}
    dispatch.assert_attested(attested)
    attested["private_local_x"]["source_mode"] = "hub"
    with pytest.raises(dispatch.NotAllowed):
        dispatch.assert_attested(attested)
    (tmp_path / "c.json").write_text('{"a": 1}')
    assert dispatch.load_config(str(tmp_path / "c.json")) == {"a": 1}
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError):
        dispatch.load_config(str(tmp_path / "l.json"))
    assert dispatch.first_existing(["x.json", "c.json"], folder=str(tmp_path))[0] == str(tmp_path / "c.json") and dispatch.first_existing(["x"], folder=str(tmp_path), required=False)[0] is None
    with pytest.raises(FileNotFoundError):
        dispatch.first_existing(["x"], folder=str(tmp_path))
    assert dispatch.distinct_requirements([" Torch>=2 ", "# note", "", "torch", "numpy[x]==1", "core~=3"], ("core",)) == ["Torch>=2", "numpy[x]==1"]


def test_more_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "é"), ("b", None)], "k string, v string")
    assert sinks.write_jsonl(df, f"file://{tmp_path}/rows") == 2
    for _ in range(2):  # written again, a chunk replaces itself
        assert sinks.commit_chunk(df, f"file://{tmp_path}/chunk") == 2
    assert spark.read.json(f"file://{tmp_path}/chunk").count() == 2 and not (tmp_path / "chunk.commit.tmp").exists()
    folder = tmp_path / "d"
    (folder / "sub").mkdir(parents=True)
    (folder / "b b.txt").write_bytes(b"x" * 3_000_000)
    (folder / "sub" / "a.txt").write_bytes(b"y")
    got = sinks.checksums(spark, f"file://{folder}").collect()
    assert [(r.path, r.sha256) for r in got] == [(p, sinks.file_sha256(str(folder / p))) for p in ("b b.txt", "sub/a.txt")]
    assert sinks.bundle([str(folder / "b b.txt"), str(folder / "sub"), str(folder / "none")], str(tmp_path / "z.zip")) == ["b b.txt"]
    for k in (1, 2):
        sinks.heartbeat(spark, f"file://{tmp_path}/beats", chunk=k)
    assert sorted(json.loads(r.value)["fields"]["chunk"] for r in spark.read.text(f"file://{tmp_path}/beats").collect()) == [1, 2]
    assert sinks.stable_json({"b": "é", "a": 1}) == '{"a":1,"b":"\\u00e9"}' and sinks.object_hash({"b": 1, "a": 2}) == sinks.object_hash({"a": 2, "b": 1})
    assert sinks.record_hash("s", [{"role": "user", "content": "é"}]) != sinks.record_hash("s", [{"role": "user", "content": "e"}])


def test_reports(spark):
    rows_ = spark.createDataFrame([("ok", "identity_behavior", "text", 20, 0), ("ok", "multilingual", "image_text", 16, 0), ("ok", "multilingual", "text", 64, 0), ("missing_id", "x", "text", 5, 3)], "reason string, category string, modality string, tokens long, markers long")
    prefs = spark.createDataFrame([("identity_pack", 0), ("s", 0)], "source_id string, markers long")
    args = ({"identity_behavior": 0.2, "multilingual": 0.8}, {"text": 0.84, "image_text": 0.16}, 0.015, 0.2, 0.0)
    bad = reports.full_report(rows_, prefs, *args).first()
    assert bad.identity_token_share_exact and bad.token_category_targets_within_tolerance and bad.non_identity_multimodal_share_within_tolerance and not bad.no_invalid_rows and not bad["pass"] and bad.identity_preference_rows == 1
    assert reports.full_report(rows_.where("reason = 'ok'"), prefs, *args).first()["pass"]
    few = rows_.where("reason = 'ok'").withColumn("tokens", F.when(F.col("category") == "identity_behavior", 200).otherwise(F.col("tokens")).cast("long"))
    assert not reports.full_report(few, prefs, *args).first()["pass"] and reports.full_report(few, prefs, *args, small_sample=True).first()["pass"]
    none = reports.full_report(rows_.limit(0), prefs.limit(0), *args).first()
    assert none.sft_rows_total == 0 and not none.preferences_nonempty
    manifest = reports.dataset_manifest(bad.asDict(), {"sft": "/x"}, {"sft": "00"}, "2025-01-01")
    text = reports.manifest_markdown(manifest)
    assert "- sft: `/x` (sha256 `00`)" in text and "- pass: `False`" in text and "- sft_rows_total: `3`" in text


def test_generation(spark):
    from sievewright.operators import generate, rubric

    rows = spark.createDataFrame([("a", "s", 1), ("b", "s", 2), ("c", "t", 3)], "id string, seed string, n int")
    assert {r.id: r.cycle for r in generate.cycles(rows, "seed", "n").collect()} == {"a": 0, "b": 1, "c": 0}
    assert [r.id for r in generate.truncate(rows, ["n"], 2).orderBy("n").collect()] == ["a", "b"]
    merged = generate.merge([rows.limit(0), rows.where("id = 'c'").withColumn("seed", F.lit("s")), rows], "seed", "n").collect()
    assert sorted((r.id, r.seed) for r in merged) == [("c", "s"), ("c", "t")]
    ledger = spark.createDataFrame([("t",)], "seed string")
    assert [r.id for r in generate.fill_chunk(rows, ledger, "seed", "n", 5).collect()] == ["a"]
    templates = {"x": {"en": "look <IMAGE_CONTEXT>", "de": "schau"}, "y": {"fr": "voir"}}
    asked = spark.createDataFrame([("x", "de", False), ("x", "ru", True), ("y", None, False), ("z", "en", False)], "c string, l string, i boolean")
    assert [r[0] for r in asked.select(generate.prompt(templates, F.col("c"), F.col("l"), F.col("i"), context="here")).collect()] == ["schau", "look here", "voir", None]
    sent = asked.select(generate.message_payload(F.col("c"), F.col("l"), F.col("i"), F.lit("image://1")).alias("m")).collect()
    assert [len(r.m[0].content) for r in sent] == [1, 2, 1, 1] and sent[1].m[0].content[0].image == "image://1"
    seeds = generate.seed_table(spark, 400, {"a": 3.0, "b": 1.0}, ["en", "de"], "b").collect()
    assert 60 < sum(s.category == "b" for s in seeds) < 140 and all(s.category == "b" for s in seeds if s.multimodal) and len({s.seed_id for s in seeds}) == 400
    small = spark.createDataFrame([(f"s{i}", "q", "tone", "en") for i in range(9)], "seed_id string, prompt string, category string, language string")
    made = generate.generate(small, [["x by y and a few words more so that it is long enough", "no"]], rubric.Rubric(("x", "y")), 5).collect()
    assert [r.id for r in made] == ["row-0000001"] and made[0].answer.startswith("x by y")
    pack = generate.stress_pack(spark.createDataFrame([("a", "k", "en", False), ("b", "k", "ar", True), ("c", "m", "ru", True)], "id string, category string, language string, multimodal boolean"), ["m", "k", "none"], "id", 4)
    assert sorted((r.place, r.id) for r in pack.collect()) == [(0, "c"), (1, "a"), (3, "b"), (3, "c")]
    assert generate.spot_checks(rows, "id", 2).count() == 2


def test_command_line(spark, tmp_path, capsys):
    from sievewright import cli

    sft, pref, out = tmp_path / "s.jsonl", tmp_path / "p.jsonl", tmp_path / "r.json"
    good = {"id": "1", "category": "identity_behavior", "messages": [{"role": "user", "content": [{"type": "text", "text": "who are you"}]}, {"role": "assistant", "content": "me"}]}
    sft.write_text(json.dumps(good) + "\n" + json.dumps({"id": "", "messages": []}) + "\n")
    pref.write_text(json.dumps({"id": "p", "prompt": "q", "chosen": "a", "rejected": "b"}) + "\n")
    base = ["--sft", f"file://{sft}", "--preferences", f"file://{pref}", "--output", str(out)]
    assert cli.main(["validate-dataset", *base], spark) == 0 and cli.main(["validate-dataset", *base, "--strict"], spark) == 2
    report = json.loads(out.read_text())
    assert report["sft_rows_total"] == 1 and report["invalid_sft_rows"] == 1 and report["preferences_rows_total"] == 1 and report["sft_tokens_total"] == 4
    assert cli.main(["validate-identity", *base, "--strict"], spark) == 2
    assert json.loads(out.read_text())["preference_rows"] == 1
    for name in ("m.md", "m.json"):
        assert cli.main(["render-manifest", "--report", str(out), "--file", f"sft={sft}", "--output", str(tmp_path / name)]) == 0
    assert "# Dataset manifest" in (tmp_path / "m.md").read_text() and len(json.loads((tmp_path / "m.json").read_text())["sha256"]["sft"]) == 64
    (tmp_path / "a.py").write_text("bad_call()\n")
    assert cli.main(["audit", "--folder", f"file://{tmp_path}", "--patterns", json.dumps({"bad": "bad_call"}), "--violations", "bad"], spark) == 2


def test_scratch_is_deleted(spark):
    from sievewright import session

    kept = session.materialize(spark.range(3), "x")
    assert kept.count() == 3 and session.clean(spark)
    with pytest.raises(Exception):
        spark.read.parquet(session.scratch_path(spark, "x").rsplit("/", 1)[0])
