import json
import os

import pytest

from sievewright.llm import abuse, answers, labelmodel, languages, personal

FOLDER = "/root/testdata/sf0.01"
MESSAGES = "array<struct<role:string,content:string>>"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


# --- problem 3 -----------------------------------------------------------------------------------

CASES = [
    ("You can write to me at nevio+bills@kanal7.invalid any time.", {"email": "nevio+bills@kanal7.invalid"}),
    ("Reply to rosnikov [at] mail [dot] lindgrove [dot] test please", {"email": "rosnikov [at] mail [dot] lindgrove [dot] test"}),
    ("Call me on +1 (555) 555-0103 after six.", {"phone": "+1 (555) 555-0103"}),
    ("Ruf mich nach sechs unter +49 (0)40 66969 073 an.", {"phone": "+49 (0)40 66969 073"}),
    ("رقمي هو +٠٠٠ ٥ ٥٥٥ ٩٩٠٣.", {"phone": "+٠٠٠ ٥ ٥٥٥ ٩٩٠٣"}),
    ("My passport number is XC0095408.", {"id_number": "XC0095408"}),
    ("Le fisc me connaît sous le 969942-1454.", {"id_number": "969942-1454"}),
    ("We moved to 11b Thistle Court, flat 4, Little Orrin 03635 last spring.", {"address": "11b Thistle Court, flat 4, Little Orrin 03635"}),
    ("Bitte liefern an Alte Färbergasse 188.", {"address": "Alte Färbergasse 188"}),
    ("J'habite 119 rue des Tilleuls Gris.", {"address": "119 rue des Tilleuls Gris"}),
    ("我住在云栖县青藤路126号。", {"address": "云栖县青藤路126号"}),
    ("My name is linnet harrowick and I am waiting for an answer.", {"name": "linnet harrowick"}),
    ("Me llamo Y. Vallecino y espero una respuesta.", {"name": "Y. Vallecino"}),
    ("表格由麦青禾签名。", {"name": "麦青禾"}),
    ("It works.\n— Mirabel Brackley-Noon", {"name": "Mirabel Brackley-Noon"}),
    ("Dunstave, Elsbeth · 12.99.581168", {"name": "Dunstave, Elsbeth", "id_number": "12.99.581168"}),
    ("Barnaby Fennimarsh (oskeller@kanal7.invalid)", {"name": "Barnaby Fennimarsh", "email": "oskeller@kanal7.invalid"}),
    ("See page 39, line 14, of manual 31191. Order number 42856 was split into 3 parcels.", {}),
    ("The firmware went from 4.27.0 to 5.0.27 in build 2031-61973.", {}),
    ("The meeting is from 10:58 to 12:30 in hall 58. Batch 80755 shows it.", {}),
    ("An @ alone, a [at] too, and > a quote — with a dash", {}),
    # Other wording than that of the tables.
    ("I talked to John Smith yesterday.", {"name": "John Smith"}),
    ("Contact Maria Lopez tomorrow", {"name": "Maria Lopez"}),
    ("Das hat Herr Müller gesagt.", {"name": "Müller"}),
    ("Hablé con Lucía Ferrer y con nadie más.", {"name": "Lucía Ferrer"}),
    ("Viele Grüße\nAnna Schmidt", {"name": "Anna Schmidt"}),
    ("Уважаемый Иван Петров, пишу вам.", {"name": "Иван Петров"}),
    ("Das Blatt hat gestern Uwe Kern bekommen.", {}),
    ("Das Blatt hat Uwe Kern unterschrieben.", {"name": "Uwe Kern"}),
    ("Pay into DE89 3704 0044 0532 0130 00 today.", {"id_number": "DE89 3704 0044 0532 0130 00"}),
    ("Pay into DE88 3704 0044 0532 0130 00 today.", {"id_number": "3704 0044 0532 0130 00"}),  # no account, still a long number
    ("It is 4111 1111 1111 1111, valid.", {"id_number": "4111 1111 1111 1111"}),
    ("Soy 12345678Z.", {"id_number": "12345678Z"}),
    ("Soy 12345678A.", {}),
    ("Il codice RSSMRA85T10A562S basta.", {"id_number": "RSSMRA85T10A562S"}),
    ("O CPF 529.982.247-25 vale.", {"id_number": "529.982.247-25"}),
    ("Phones 555-0103 / 555-0104 / 555-0105 / 555-0106", None),
    ("On 12/05/2024 10:30 it rained, on 2024-05-12 too.", {}),
    ("ISBN 978-3-16-148410-0 is out of print.", {}),
    ("The host 192.168.100.200 answers.", {}),
    ("It takes 1234567890 bytes.", {}),
    ("See https://user@host.example/12345678901 for it.", {}),
    ("Радослава Дъбравин, ж.к. Мъгливец 108", {"name": "Радослава Дъбравин", "address": "ж.к. Мъгливец 108"}),
    ("Die Frau geht. Dear Customer Support, contact us.", {}),
    ("See mailto:bob@x.example for it", {"email": "bob@x.example"}),
    ("", {}),
]


@pytest.mark.parametrize("text,wanted", CASES, ids=range(len(CASES)))
def test_personal_information(text, wanted):
    found = personal.find(text)
    if wanted is None:  # several of a kind
        assert [text[a:b] for a, b, _ in found] == ["555-0103", "555-0104", "555-0105", "555-0106"]
        return
    assert {kind: text[a:b] for a, b, kind in found} == wanted
    redacted = personal.redact(text, found)
    for kind, value in wanted.items():
        assert value not in redacted and personal.PLACEHOLDERS[kind] in redacted
    # The rest is unchanged: with the findings put back, the text is as it was.
    for a, b, kind in found:
        redacted = redacted.replace(personal.PLACEHOLDERS[kind], text[a:b], 1)
    assert redacted == text


@pytest.mark.parametrize("length", [79, 80, 81, 300, 20_000])
def test_an_address_is_replaced_whole(length):
    text = "Mail " + "a" * length + "@mail.example now"
    assert personal.redact(text, personal.find(text)) == "Mail [EMAIL] now"
    street = "word " * length + "I live at 12 Mill Lane " + "word " * length
    assert [street[a:b] for a, b, _ in personal.find(street)] == ["12 Mill Lane"]


def test_block_lists_keep_their_text():
    content = '[ {"type":"image","image_path":"x"},\n {"text" : "caf\\u00e9 \\ud83d\\ude00 a@b.example\\n\\"ok\\"" ,"type":"text"}]'
    want = content.replace("a@b.example", "[EMAIL]")
    assert personal.redact_message(content) == want and json.loads(want)[1]["text"].startswith("café 😀 [EMAIL]")


def test_personal_tables(spark):
    blocks = json.dumps([{"type": "image", "image_path": "x"}, {"type": "text", "text": "Mail a@b.example"}])
    rows = [("1", [("user", blocks), ("assistant", "no"), ("user", None)], 0), ("1", [("user", blocks), ("assistant", "no"), ("user", None)], 0), ("2", None, 0), (None, [("user", "a@b.example")], 0), ("3", [], 0), ("4", [("user", "plain " * 50_000 + "a@b.example")], 0)]
    df = spark.createDataFrame(rows, f"id string, messages {MESSAGES}, turn int")
    assert sorted(map(tuple, personal.findings(df).collect())) == [("1", 0, "email"), ("4", 0, "email")]
    got = {r.id: r.messages for r in personal.redacted(df).collect()}
    assert json.loads(got["1"][0].content)[1]["text"] == "Mail [EMAIL]" and got["1"][1].content == "no" and got["1"][2].content is None
    assert got["2"] is None and got["3"] == [] and personal.findings(df.limit(0)).count() == 0


# --- problem 4 -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def crf(spark):
    from sievewright.session import table

    docs, sft = table(spark, FOLDER, "documents"), table(spark, FOLDER, "sft_rows")
    return languages.fit(languages.sample(languages.document_source(docs), languages.conversation_source(sft), rows=40))


def test_label_codes(spark):
    names = ["EN", "en-GB", "fr_CA", "German", "deu", "zh-CN", "n/a", "", None, " und ", "nl", "Русский"]
    df = spark.createDataFrame([(n,) for n in names], "l string")
    assert [r[0] for r in df.select(languages.label_code("l")).collect()] == ["en", "en", "fr", "de", "de", "zh", None, None, None, None, "nl", "ru"]


@needs_data
def test_languages_on_held_out_rows(spark, crf):
    """Rows of the larger table that the sample can't hold, with the share of wrong labels known."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang in ('en','de','fr','es','pt','it','bg','ru','ar','zh') and length(text) > 60").orderBy("text").limit(1500).collect()
    result = languages.label_sentences(crf, [languages.tokens_of(r.text) for r in rows])
    right = sum(r.lang in {languages.LANGUAGES[x] for x in languages.held_languages(f)} for r, f in zip(rows, result))
    assert right / len(rows) > 0.93  # about one label in twenty is wrong


@needs_data
def test_mixed_and_wrong_labels(spark, crf):
    en, de = "The archive team compares the seed list behind the workshop.", "Das Archivteam vergleicht die Saatliste hinter der Werkstatt."
    texts = [
        (1, en, "en"), (2, en, "English"), (3, de, "en"), (4, en, None), (5, f"{en} {de}", "en"), (6, en + " (\"Saatliste\")", "en"), (7, None, "en"), (8, " ", None), (9, "12 34", ""),
        (10, en.replace("e", "е").replace("o", "о"), "en"), (11, f"USER: {de}\nASSISTANT: {de}", "de"),
    ]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, t, lang in texts], "doc_id long, text string, lang string, label string")
    sft = spark.createDataFrame([("a", [("user", en), ("assistant", de)], "en"), ("a", [("user", en), ("assistant", de)], "en"), ("b", None, None), ("c", [("user", en * 2000)], "de")], f"id string, messages {MESSAGES}, language string")
    got = sorted((r.table_name, r.record_id, r.language) for r in languages.wrong_labels(docs, sft, crf).collect())
    assert got == sorted([("documents", "3", "de"), ("documents", "4", "en"), ("documents", "5", "en"), ("documents", "5", "de"), ("sft_rows", "a", "en"), ("sft_rows", "a", "de"), ("sft_rows", "c", "en")])
    parts = [r for r in languages.segments(docs, sft, crf).collect() if r.record_id == "5"]
    assert [p.language for p in sorted(parts, key=lambda p: p.first_sentence)] == ["en", "de"] and all(0.9 < p.confidence <= 1 for p in parts)
    assert languages.wrong_labels(docs.limit(0), sft.limit(0), crf).count() == 0


@needs_data
def test_stretches_give_what_the_whole_record_gives(spark, crf):
    """Records below, at and far above a stretch: sentences and posteriors are those of one chain over all words."""
    import numpy as np

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) > 40").orderBy("doc_id").limit(150).collect()
    lists = [languages.tokens_of(r.text) for r in docs]
    mixed = [t for a, b in zip(lists[:60:2], lists[1:60:2]) for t in (*a, ".", *b, ".")]
    lists += [mixed * 6, ("archive team seed list " * 3000).split(), [w for t in lists[:40] for w in t if w != "."]]
    for size in (95, 96, 97, 10_000):
        lists.append([w for w in ("the archive team compares the seed list . " * 2000).split()][:size])
    assert max(map(len, lists)) > 10_000
    cut = languages.label_sentences(crf, lists)
    whole, languages.STRETCH = languages.STRETCH, 10**9
    try:
        one = languages.label_sentences(crf, lists)
    finally:
        languages.STRETCH = whole
    for a, b in zip(cut, one):
        assert (a is None) == (b is None)
        if a is not None:
            assert (a[0] == b[0]).all() and (a[2] == b[2]).all()
            assert np.abs(a[1] - b[1]).max() < 1e-4 and languages.held_languages(a).keys() == languages.held_languages(b).keys()


@needs_data
def test_of_two_deliveries_the_latest_counts(spark, crf):
    en, de = "The archive team compares the seed list behind the workshop.", "Das Archivteam vergleicht die Saatliste hinter der Werkstatt."
    rows = [("a", [("user", en)], "en", "2024-01-02"), ("a", [("user", de)], "en", "2024-01-01"), ("b", [("user", en)], "en", None), ("b", [("user", de)], "en", "2024-01-01")]
    sft = spark.createDataFrame(rows, f"id string, messages {MESSAGES}, language string, ingested_at string")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    got = {(r.record_id, r.language) for r in languages.languages(docs, sft, crf).collect()}
    assert got == {("a", "en"), ("b", "de")}
    assert {(r.record_id, r.language) for r in languages.wrong_labels(docs, sft, crf).collect()} == {("b", "de")}


# --- label model and problem 5 ---------------------------------------------------------------------


def test_label_model_recovers_voters():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.1
    counts = {}
    for y in truth:
        pattern = "".join("0" if rng.random() < 0.2 else ("+" if (rng.random() < right) == y else "-") for right in (0.95, 0.9, 0.85, 0.7))
        counts[pattern] = counts.get(pattern, 0) + 1
    model = labelmodel.fit(counts, 4)
    assert model.posterior("++++") > 0.95 and model.posterior("----") < 0.01 and model.posterior("++--") > model.posterior("--++")
    assert labelmodel.fit({}, 2).posterior("00") < 0.2


ANSWERS = {
    "empty": [None, "", "  ", "N/A", "null", "...", "​"],
    "truncated": ["The archive team compares the seed list behind the worksh", "The beekeeper labels the broken lamp and also", "We should look at it (", "It returns the ticket, "],
    "refusal": ["I'm sorry, but I can't help with the blue ledger.", "Als Assistent muss ich diese Anfrage ablehnen.", "На такой вопрос я отвечать не буду.", "我没有办法谈论这件事。"],
    "copied_question": ["Why is it important that the junior editor measures the second draft?", "Your question was: Why is it important that the junior editor measures the second draft?"],
    "wrong_language": ["Das Archivteam vergleicht die Saatliste hinter der Werkstatt.", "El barquero repara la lámpara rota detrás del taller."],
    "": ["The archive team compares the seed list behind the workshop.", "The wooden crate", "- The tide table\n- The blue ledger", "I can't see your screen, but the steps are the same everywhere. The beekeeper checks the seed list before lunch.", "The night reviewer returns the weekly summary before lunch"],
}


@needs_data
def test_planted_defects(spark, crf):
    prompt = "Why is it important that the junior editor measures the second draft?"
    planted = [(f"{d or 'ok'}{i}", d, a) for d, texts in ANSWERS.items() for i, a in enumerate(texts)]
    fillers = [(f"f{i}", "", f"The {who} {does} the {what} {where}. {where.capitalize()}, the {who} {does} the {what}.") for i, (who, does, what, where) in enumerate((w, d, t, p) for w in ("archive team", "beekeeper", "night reviewer") for d in ("compares", "checks", "returns") for t in ("seed list", "wooden crate", "tide table", "blue ledger", "weekly summary") for p in ("behind the workshop", "before lunch", "in the reading room"))]
    rows = [(i, (prompt, a), "x") for i, _, a in planted + fillers] + [("ok0", (prompt, ANSWERS[""][0]), "x"), (None, (prompt, ""), "x"), ("np", (None, ANSWERS[""][0]), "x")]
    identity = spark.createDataFrame(rows, "id string, messages_flat struct<user:string,assistant:string>, field string")
    translate = "Put this into German for me: The archive team compares the seed list."
    pref = spark.createDataFrame([("p1", translate, None, ANSWERS["wrong_language"][0], "")], f"id string, prompt string, prompt_messages {MESSAGES}, chosen string, rejected string")
    got = {}
    for r in answers.defects(identity, pref, crf).collect():
        got.setdefault(r.id, set()).add(r.defect)
    assert got.pop("p1") == {"empty"}
    for i, d, a in planted:
        found = got.pop(i, set())
        if d == "refusal":  # some of them in another language than the prompt
            found.discard("wrong_language")
        assert found == ({d} if d else set()), (i, a)
    assert not got
    assert answers.defects(identity.limit(0), pref.limit(0), crf).count() == 0


@needs_data
def test_one_record_makes_no_known_ending(spark, crf):
    twice, once = "The crew paints the purple gate. The wind moves the purple gate.", "The crew paints the silver door."
    rows = [("a", ("why?", twice)), ("a", ("why?", twice)), ("b", ("why?", once)), ("c", ("why?", once)), ("o1", ("why?", "He saw the purple gate")), ("o2", ("why?", "He saw the silver door"))]
    identity = spark.createDataFrame(rows, "id string, messages_flat struct<user:string,assistant:string>")
    pref = spark.createDataFrame([], f"id string, prompt string, prompt_messages {MESSAGES}, chosen string, rejected string")
    got = {r.id: r.truncated for r in answers.scored(identity, pref, crf).collect()}
    assert got["o1"].endswith("+") and got["o2"].endswith("-")


REFUSALS = [  # none of these stands in the tables or in the patterns
    "That isn't a topic I'm comfortable getting into.", "This goes against my guidelines, so I'll pass.", "I won't be able to help with that request, sorry.", "I'd rather not discuss this question.",
    "Das geht gegen meine Richtlinien, leider.", "Dazu möchte ich nicht Stellung nehmen, tut mir leid.", "C'est contraire à mes principes, désolé.", "Ce n'est pas un sujet dont je parle.", "Lo siento, va contra mis normas.",
    "Não é um tema sobre o qual eu fale, desculpa.", "Mi dispiace, va contro le mie regole.", "Съжалявам, това е против моите правила.", "Простите, это против моих принципов.", "عذرا، هذا ضد مبادئي.", "抱歉，这个问题我不方便谈。",
]


@needs_data
def test_cutoffs_are_validated(spark, crf):
    """Defects planted in complete answers of the tables: the cutoffs lie where F1 is best, or next to it."""
    import random

    rng = random.Random(9)
    identity = spark.read.parquet(f"{FOLDER}/identity_sft.parquet").select("id", "messages_flat", "language")
    rows = identity.where("messages_flat.user is not null and length(messages_flat.assistant) > 60 and rtrim(messages_flat.assistant) rlike '[.。؟!]$' and language in ('en','de','fr','es','ru','bg','it','pt')").dropDuplicates(["id"]).orderBy("id").limit(420).collect()
    planted, truth = [], {}
    for i, r in enumerate(rows):
        user, answer, kind = r.messages_flat.user, r.messages_flat.assistant, (*answers.DEFECTS, "ok", "ok")[i % 7]
        if kind == "empty":
            answer = rng.choice([None, "", "N/A", "...", " \n"])
        elif kind == "truncated":
            words = answer.split(" ")
            answer = " ".join(words[: rng.randrange(max(1, len(words) - 5), len(words))])
            answer = answer[: -rng.randrange(1, 4)] if rng.random() < 0.3 and len(words[-1]) > 4 else answer
            if answer.rstrip()[-1:] in ".!?":
                answer = answer.rstrip().rstrip(".!?") + " the"
        elif kind == "refusal":
            answer = REFUSALS[i % len(REFUSALS)]
        elif kind == "copied_question":
            answer = user
        elif kind == "wrong_language":
            answer = next(o.messages_flat.assistant for o in rows[(i + 50) % len(rows) :] + rows if o.language != r.language)
        truth[f"planted-{i}"] = kind
        planted.append((f"planted-{i}", (user, answer)))
    both = identity.select("id", "messages_flat").unionByName(spark.createDataFrame(planted, "id string, messages_flat struct<user:string,assistant:string>"))
    pref = spark.createDataFrame([], f"id string, prompt string, prompt_messages {MESSAGES}, chosen string, rejected string")
    scored = answers.scored(both, pref, crf)
    posterior = answers.models(scored)
    found = [r for r in scored.collect() if r.id in truth]
    scores = {d: [posterior[d][r[d]] for r in found] for d in answers.DEFECTS}
    real = {d: [truth[r.id] == d for r in found] for d in answers.DEFECTS}
    best = answers.best_cutoffs(scores, real)
    for d in answers.DEFECTS:
        # A refusal is in its own language, and a cut answer may be cut to a sentence: both may be of another kind too.
        hits = [s >= answers.CUTOFFS[d] for s in scores[d]]
        both_ = sum(h and t for h, t in zip(hits, real[d]))
        f1 = 2 * both_ / (sum(hits) + sum(real[d]))
        print(d, best[d], round(f1, 3), sum(hits), sum(real[d]), both_)
        assert f1 >= best[d][1] - 0.03, (d, best[d], f1)


# --- problem 6 -----------------------------------------------------------------------------------


def test_obfuscation_is_undone():
    for text in ("You M O R O N", "you m-o-r-o-n", "you m0r0n", "you mоrоn", "you moroooon", "you m*ron", "you m​oron"):
        assert " moron " in abuse.plain(text), text
    assert "人 渣" in abuse.plain("人-渣") and abuse.plain("人人人人渣").count("人") == 1


def test_votes():
    vote = lambda t: abuse.vote(abuse.plain(t))
    assert vote("The beekeeper checks the seed list") is None and vote("Look with the naked eye") is None and vote("All of them should wait") is None
    assert vote("Nobody wants you here, you moron")["abusive"] == "+--++-"
    assert vote("The house rules say that nobody may call a colleague an idiot")["abusive"] == "+----+"
    assert vote("All of them are vermin and should be thrown out of the country")["hateful"] == "+-+++--"
    assert vote("She moaned, naked")["sexual"] == "-++--"


def test_correlated_label_model():
    """Accuracies, the prior and the one dependence come out; a pair that repeats itself isn't counted twice."""
    import numpy as np

    rng = np.random.default_rng(3)
    n = 400_000
    y = rng.random(n) < 0.005
    first = np.where(y, rng.random(n) < 0.7, rng.random(n) < 0.002)
    echo = np.where(rng.random(n) < 0.9, first, rng.random(n) < 0.01)  # repeats the first voter, right or wrong
    second = np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.001)
    third = np.where(y, rng.random(n) < 0.5, rng.random(n) < 0.001)
    counts = {}
    for row in zip(first, echo, second, third):
        p = "".join("+" if x else "-" for x in row)
        counts[p] = counts.get(p, 0) + 1
    model = labelmodel.fit_correlated(counts, [labelmodel.TRUST] * 4, hold=0.02)
    assert model.prior == pytest.approx(0.005, rel=0.5) and (0, 1) in {e[:2] for e in model.edges}
    assert all(a < 0.05 for a, _ in model.rates) and [b for _, b in model.rates] == pytest.approx([0.7, 0.63, 0.6, 0.5], abs=0.16)
    assert model.posteriors["----"] < 0.01 and model.posteriors["+-++"] > 0.95
    alone = labelmodel.fit_correlated(counts, [labelmodel.TRUST] * 4, hold=0.02, dependence=2.0)
    assert not alone.edges and model.posteriors["++--"] < alone.posteriors["++--"] - 0.1
    assert labelmodel.fit_correlated({}, [0.8]).posteriors == {} and labelmodel.fit_correlated({"--": 5}, [0.8, 0.0]).posteriors["--"] < 0.5


#: None of these stands in the tables: attacks, and uses that are none, in ten languages.
HELD_OUT = {
    "abusive": [
        "Kill yourself, you disgusting pig.", "You are a worthless coward and nobody likes you.", "Du bist ein elender Versager, verpiss dich.", "Tu es un minable, casse-toi.", "Eres un inútil, piérdete ya.",
        "És um fracassado, ninguém gosta de ti.", "Sei un imbecille, levati di torno.", "Ти си един тъпак, разкарай се.", "Ты просто ничтожество, отвали от меня.", "أنت غبي وفاشل، اغرب عن وجهي.", "你这个废物，滚蛋吧。",
    ],
    "hateful": [
        "Those immigrants are a disease and we should get rid of every one of them.", "All foreigners are parasites and must be deported.", "Alle Ausländer sind Schmarotzer und gehören abgeschoben.", "Les immigrés sont tous des parasites, il faut les expulser.",
        "Todos los extranjeros son parásitos, hay que expulsarlos.", "Todos os imigrantes são parasitas e devem ser expulsos.", "Tutti gli stranieri sono parassiti, bisogna cacciarli: vanno cacciati.", "Всички имигранти са паразити и трябва да бъдат изгонени.",
        "Все мигранты паразиты, их надо гнать из страны.", "كل المهاجرين طفيليات ويجب طردهم.", "所有移民都是寄生虫，应该驱逐出境。",
    ],
    "sexual": [
        "He was horny and she sent him nude pictures.", "They had wild sex, naked on the floor.", "Sie war nackt und stöhnte beim Sex.", "Elle était nue et gémissait pendant qu'ils baisèrent.", "Estaba desnuda y gemía de placer.", "Ela estava nua e gemia de tesão.",
        "Lei era nuda e gemeva mentre scoparono.", "Тя беше гола и стенеше, докато се чукаха.", "Она была голая и стонала от секса.", "كانت عارية تتأوه وهما مارسا الجنس.", "她赤裸着呻吟，两人疯狂做爱。",
    ],
    "": [
        "Patients ask the doctor about cancer screening and sexual health.", "Kill the process and restart the terminal.", "The museum guide repairs the broken lamp.", "Im Bericht steht, dass niemand einen anderen Idiot nennen darf.", "Le règlement interdit de traiter quelqu'un d'idiot.",
        "Vermin control is a task of the city.", "On peut voir la planète à l'oeil nu.", "Правила запрещают называть людей идиотами.", "规定禁止称别人为白痴。", "Die Ärztin erklärt die Vorsorge gegen Brustkrebs.",
    ],
}


@pytest.fixture(scope="module")
def abuse_model(spark):
    from sievewright.session import table

    passed = abuse.read(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, FOLDER, "sft_rows"))
    return abuse.fit(passed)


@needs_data
def test_abuse_on_held_out_sentences(spark, abuse_model):
    """Whole sentences that aren't in the tables: most attacks of each kind are flagged, other uses are not."""
    hashes = abuse._Hashes()
    score = {k: abuse.scores(abuse_model, [abuse.stream(abuse.plain(t), hashes) for t in texts]) for k, texts in HELD_OUT.items()}
    for i, kind in enumerate(abuse.KINDS):
        found = (score[kind][:, i] >= abuse.CUTOFF).sum()
        print(kind, found, len(HELD_OUT[kind]), score[kind][:, i].round(2).tolist())
        assert found >= 0.6 * len(HELD_OUT[kind]), (kind, score[kind][:, i].round(2).tolist())
    print(score[""].round(2).tolist())
    assert (score[""] >= abuse.CUTOFF).any(axis=1).sum() <= 1, score[""].round(2).tolist()


@needs_data
def test_scores(spark, abuse_model):
    from sievewright.session import table

    docs, sft = table(spark, FOLDER, "documents"), table(spark, FOLDER, "sft_rows")
    texts = {
        1: "Nobody wants you here, you moron.", 2: "All Kellens are vermin and should be thrown out of the country.", 3: "She moaned while he kissed her naked breasts.",
        4: "The house rules say that nobody may call a colleague an idiot.", 5: "The leaflet explains breast cancer screening and sexual health in plain words.", 6: None, 7: " ",
        8: "The archive team compares the seed list. " * 3000 + "Nobody wants you here, you m0r0n.", 9: "Yes, with one remark.", 10: "the archive team compares the seed list " * 500 + "nobody wants you here you moron",
    }
    small = spark.createDataFrame([(i, t, None, 0.5) for i, t in texts.items()], "doc_id long, text string, source string, abusive double")
    scored = abuse.record_scores(abuse.read(small, sft.limit(0)), abuse_model)
    got = {(int(r.record_id), r.kind) for r in abuse.flagged(scored).collect()}
    assert got == {(1, "abusive"), (2, "hateful"), (3, "sexual"), (8, "abusive"), (10, "abusive")}
    assert scored.count() == len(texts) and {r.source for r in scored.collect()} == {"unknown"}
    rate = abuse.rates(scored).first()
    assert rate.n_records == 10 and rate.any_rate == pytest.approx(5 / 10)
    empty = abuse.read(docs.limit(0), sft.limit(0))
    nothing = abuse.fit(empty)
    assert abuse.flagged(abuse.record_scores(abuse.read(small, sft.limit(0)), nothing)).count() == 0 and abuse.record_scores(empty, abuse_model).count() == 0


def test_every_sentence_is_counted(spark):
    """Sentences without a cue count as numbers, none is left out."""
    texts = ["One plain line. Another plain line. You moron!", "Nothing here.", None, " ", "Third. Fourth. Fifth."]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    sft = spark.createDataFrame([("a", [("user", "Hello there."), ("assistant", "Go away and shut up, you idiot.")], "s")], f"id string, messages {MESSAGES}, source_id string")
    passed = abuse.read(docs, sft)
    assert passed.where("part in ('vote', 'count')").groupBy().sum("n").first()[0] == 9
    assert passed.where("part = 'vote'").count() == 2


LONG = "Der Bericht beschreibt die Lage im Hafen und nennt die Zahlen der Woche. " * 6


@pytest.mark.parametrize(
    "prompt, lang, wanted",
    [
        (LONG + "\n\nSummarise this in French", "fr", True), ("Context: " + LONG + "Answer in German.", "de", True), (LONG + "\nОтветь на русском языке", "ru", True),
        (LONG + "\n请用德语回答", "de", True), (LONG + "\nأجب بالفرنسية", "fr", True), (LONG + "\nPlease translate: Italian", "it", True), ("Translate this into English: " + LONG, "en", True),
        (LONG + "\nSummarise this in French", "es", False), (LONG + '\nWhat does "answer in French" mean?', "fr", False), (LONG + "\n> Answer in French.\nWhat is this?", "fr", False),
        (LONG + "\nThe annex was written in French.", "fr", False), (LONG + "\nHe lives in Germany.", "de", False),
    ],
)
def test_language_asked_for_anywhere(prompt, lang, wanted):
    row, _ = answers.votes(prompt, "Eine ganz andere Antwort mit genug Wörtern für jede Stimme.", ("xx", lang, True, True))
    assert row["wrong_language"].startswith("--" if wanted else "++")


# --- problem 9: clusters ------------------------------------------------------------------------


def test_jamo_and_half_width_kana_compose():
    import random
    import unicodedata

    from sievewright.llm.visual import CLUSTERS, canonical_form

    korean = "한국어 가각 텍스트"
    assert canonical_form(unicodedata.normalize("NFD", korean)) == korean and canonical_form("각") == "각" and canonical_form("ᄀ​ᅡ") == "가"
    assert canonical_form("ｶﾞﾊﾟｳﾞあﾞ") == canonical_form("ガパヴあ゙") == "ガパヴあ゙"
    assert all(canonical_form(c) == canonical_form(out) == out for c, out in CLUSTERS.items())
    rng = random.Random(1)
    pool = [chr(x) for x in (*range(0x1100, 0x1200), *range(0x3040, 0x3100), *range(0xFF61, 0xFFDD), *range(0x300, 0x330), *range(0xAC00, 0xAC40), 0x200B, 0x3099, 0x309A, 0x61, 0x430, 0x456, 0x3BF, 0xFB1D, 0x5B4)]
    for _ in range(20_000):
        form = canonical_form("".join(rng.choice(pool) for _ in range(rng.randrange(1, 6))))
        assert canonical_form(form) == form
