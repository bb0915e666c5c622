"""Problem 5: defective answers, with their kinds of defect.

Each defect has a few labelling functions that vote yes, no or abstain on an answer; a label model
(:mod:`sievewright.llm.labelmodel`) learns from the agreement of the votes over all answers how far
each is to be trusted, and every defect whose posterior exceeds its cutoff is reported.  An answer
may have several.  The cutoffs are validated: :func:`best_cutoffs` finds them on labelled answers, and
the tests hold :data:`CUTOFFS` against defects planted in answers that no cutoff was chosen on.

Whether an answer breaks off is decided with the corpus, by two voters besides those that look at the
answer itself: its last words are looked up among the last words of all finished sentences, and the
share in which its last word ends a sentence, of all the times it is used, is held against that of all
words.  One pass over the texts gives the votes, the endings and the counts of words; the lookups are
joins on the ending, in which each distinct ending takes part once.

Defined results: a null answer and one without letters or digits, or with a placeholder word only,
is empty and nothing else; without a prompt there is no copied question and no wrong language; an
answer in a language that the prompt asks for, anywhere outside of quoted payload, is right; rows
with a null id are left out; a repeated id is one record.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import labelmodel
from sievewright.llm.records import content_text, lookup
from sievewright.llm.languages import LANGUAGES, Crf, label_sentences, tokens_of, words_of
from sievewright.session import materialize

DEFECTS = ("empty", "truncated", "refusal", "copied_question", "wrong_language")
#: Posteriors above which a defect is reported; validated on answers with planted defects in the tests.
CUTOFFS = {"empty": 0.5, "truncated": 0.5, "refusal": 0.5, "copied_question": 0.5, "wrong_language": 0.5}
VOTERS = {"empty": 3, "truncated": 5, "refusal": 4, "copied_question": 3, "wrong_language": 3}
#: Votes on truncation that the corpus gives.
CORPUS_VOTES = 2
#: A word is used rarely, or as often as others, at the end of a sentence by these multiples of the
#: share of all words; below so many uses it tells nothing.
RARE_END, COMMON_END, LEAST_USES = 0.2, 0.8, 12

_PLACEHOLDER = frozenset("null none nil nan na n/a undefined empty blank todo tbd missing <empty> <null> <none> [empty] (empty) keine nessuno нет няма".split())
_STOP = ".!?。！？؟…"
_CLOSERS = "\"'”’»“„«()（）[]【】*_`~>#•- \t\r\n\xa0"

_REFUSE = re.compile(
    "|".join(
        (
            r"(?:can't|cannot|can not|unable to|not able to|won't|will not|not going to) (?:be able to )?(?:help|assist|answer|talk|discuss|speak|comment|provide|share|do that|comply)",
            r"must (?:decline|refuse)|have to (?:decline|refuse)|i (?:decline|refuse)\b|rather not (?:get into|talk|discuss|answer|say)|prefer not to",
            r"nicht (?:weiter)?helfen|keine (?:auskunft|antwort) geben|beantworte ich (?:\w+ )?nicht|nicht (?:beantworten|eingehen|darüber (?:sprechen|reden))|(?:anfrage|bitte|frage) (?:leider )?(?:ablehnen|zurückweisen)|nicht in der lage",
            r"ne (?:peux|puis) pas (?:vous |t'|te )?(?:aider|répondre|parler)|pas en mesure d|préfère ne pas|ne répondrai pas|(?:dois|suis obligée? de|suis contraint de) (?:refuser|décliner)",
            r"no puedo (?:ayudar|responder|hablar|contestar)|no estoy en condiciones|prefiero no |no voy a (?:contestar|responder|hablar)|(?:debo|tengo que) (?:rechazar|declinar)",
            r"não posso (?:ajudar|responder|falar)|não estou em condições|prefiro não |não vou responder|(?:tenho de|tenho que|devo) (?:recusar|declinar)",
            r"non posso (?:aiutar|risponder|parlar)|non sono in grado|preferisco non |non darò risposta|non risponderò|devo (?:rifiutare|declinare)",
            r"не мога да (?:ви |ти )?(?:помогна|отговоря|говоря)|не съм в състояние|предпочитам да не|няма да отговоря|(?:трябва да|принуден съм да) (?:откажа|отклоня)",
            r"не могу (?:вам |тебе )?(?:помочь|ответить|говорить)|не в состоянии|предпоч(?:ёл|ел|итаю|ла)(?: бы)? не|(?:отвечать|говорить) не (?:буду|стану)|не (?:буду|стану) (?:отвечать|говорить)|(?:вынужден|вынуждена|должен) (?:отклонить|отказать)",
            r"لا (?:أستطيع|يمكنني) (?:مساعدت|الإجابة|الحديث)|لست قادرا|أفضل (?:ألا|أن لا)|لن أجيب|(?:يجب|علي) أن أرفض|لا أستطيع أن أساعد",
            # Of the topic, the rules, or passing on it, in all ten.
            r"(?:isn't|is not|not) (?:a (?:topic|subject)|something) (?:that )?i|not comfortable|(?:against|outside) my (?:guidelines|rules|policy|policies|principles)|i'll (?:have to )?pass\b|no comment",
            r"gegen meine (?:richtlinien|regeln|grundsätze)|dazu (?:möchte|werde) ich nicht|kein thema für mich|nicht wohl dabei|möchte ich (?:lieber )?nicht (?:antworten|eingehen|sprechen)",
            r"contraire à mes (?:règles|principes)|pas un sujet (?:que|dont)|je passe mon tour|je m'abstiens|je ne souhaite pas (?:répondre|en parler|aborder)",
            r"contra (?:de )?mis (?:normas|principios|reglas)|no es un tema (?:que|del)|me abstengo|no me siento cómod",
            r"contra (?:as )?minhas (?:regras|normas)|contra os meus princípios|não é um tema|abstenho-me|não me sinto confort",
            r"contro le mie (?:regole|linee)|contro i miei principi|non è un argomento|mi astengo|non mi sento a mio agio",
            r"против моите (?:правила|принципи)|не е тема|въздържам се|против моих (?:правил|принципов)|не та тема|воздержусь|не хочу (?:это )?обсуждать",
            r"ضد (?:مبادئي|قواعدي)|ليس موضوعا|أمتنع عن|违反我的|不方便(?:谈|回答|讨论)|不便(?:谈|回答|讨论)|恕难",
            r"没有?办法(?:谈|回答|帮|讨论)|不太?想(?:讨论|谈)|不会回答|必须拒绝|(?:无法|不能|没法)(?:帮|为你|为您|回答|谈|讨论|协助|提供)|帮不(?:了|上)|恕不",
        )
    )
)
_FRAME = re.compile(
    r"sorry|afraid|apologi|as an? (?:ai|assistant)|tut mir leid|leider|bedaure|als (?:ki|assistent)|désolé|regrette|en tant qu|lo siento|lamento|como asistente|como assistente|"
    r"mi dispiace|spiacente|come assistente|съжалявам|като асистент|извин|сожале|прости|как помощник|عذرا|آسف|بصفتي|抱歉|对不起|作为(?:助手|ai)|"
    # It speaks of the question rather than answering it.
    r"\b(?:question|topic|request|frage|anfrage|thema|sujet|demande|pregunta|petición|pergunta|pedido|domanda|richiesta|tema|въпрос|вопрос|запрос)\b|سؤال|موضوع|问题|话题|请求|grundsätzlich"
)
_ASKS = {
    "en": "english englisch anglais inglés ingles inglês inglese английски английский الإنجليزية 英语 英文",
    "de": "german deutsch allemand alemán aleman alemão tedesco немски немецкий الألمانية 德语 德文",
    "fr": "french französisch français francés frances francês francese френски французский الفرنسية 法语 法文",
    "es": "spanish spanisch espagnol español espanol espanhol spagnolo испански испанский الإسبانية 西班牙语 西班牙文",
    "pt": "portuguese portugiesisch portugais portugués português portoghese португалски португальский البرتغالية 葡萄牙语 葡萄牙文",
    "it": "italian italienisch italien italiano italiana италиански итальянский الإيطالية 意大利语 意大利文",
    "bg": "bulgarian bulgarisch bulgare búlgaro bulgaro български болгарский البلغارية 保加利亚语",
    "ru": "russian russisch russe ruso russo руски русский الروسية 俄语 俄文",
    "ar": "arabic arabisch arabe árabe arabo арабски арабский العربية 阿拉伯语 阿拉伯文",
    "zh": "chinese chinesisch chinois chino chinês cinese китайски китайский الصينية 中文 汉语",
}
_ASK_WORDS = {w: lang for lang, words in _ASKS.items() for w in words.split()}
_LEADS = re.compile(r"^[^\n:：]{3,40}[:：]\s*")
_WORD = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+(?:['’][^\W_㐀-鿿]+)*")


def _form(name: str) -> str:
    """A language's name in a request, with its endings; never the name of a country."""
    if "\u0400" <= name[0] <= "\u04ff":
        return re.sub("(?:ий|и)$", "", name) + r"(?:ий|ом|ого|ому|и)"
    if "\u0600" <= name[0] <= "\u06ff" or "㐀" <= name[0] <= "鿿":
        return name
    return ("(?<!in )" if name == "italien" else "") + name + r"(?:e[nmrs]?|s)?(?!\w)"


#: Ways to ask for a language: a preposition, a verb or "language:" before its name, or a word after it.
_NAME = "(?P<name>" + "|".join(_form(w) for w in sorted(_ASK_WORDS, key=len, reverse=True)) + ")"
_REQUEST = re.compile(
    r"(?:(?<!\w)(?:(?:into|in|to|auf|ins|im|en|em|au|al|a|para|all'|nell'|на|по)(?:[ \-]+(?:(?:the|o|el|le|il|plain|simple|good|proper|clear|formal|fluent|brazilian|einfachem|gutem|korrektem|klarem|чистом|простом)[ \-]+){0,2})?"
    r"|(?:translat\w+|speak|use|using|write|answer|reply|respond|übersetz\w+|sprich|schreib\w*|parle[zr]?|habla\w*|fal[ae]\w*|parl[ai]\w*|язык[е]?|език|language|sprache|langue|idioma|língua|lingua|اللغة|استخدم)\s*[:=\-]?\s*"
    r"|(?:إلى|في|باللغة|إلى اللغة)\s+|ب)|(?:用|以|成|为|說|说|语言[:：]?)\s*)" + _NAME
    + "|" + r"(?<!\w)" + _NAME.replace("?P<name>", "?P<before>")
    + r",?\s*(?:please|translation|version|answer|reply|response|summary|only|bitte|s'il|svp|por favor|per favore|пожалуйста|моля|من فضلك|回答|回复|作答|翻译)"
)
#: A language's name at a word's begin, in scripts without spaces anywhere.
_NAMED = re.compile("|".join(w if "㐀" <= w[0] <= "鿿" else rf"(?<![^\W\d_]){w}" for w in sorted(_ASK_WORDS, key=len, reverse=True)))
#: What is said of a text and asks for nothing.
_STATED = re.compile(r"\b(?:was|is|were|are|been)\s+(?:\w+\s+)?(?:written|published|spoken|printed|held|sung|filmed|taught)\s+$")
#: Payload by its marks: fenced, between quotation marks, in quoted lines.
_QUOTED = re.compile(
    r"```.*?```|(?<!\w)\"(?=\S)[^\"]*(?<=\S)\"(?!\w)|“[^“”]*”|„[^„“”]*[“”]|«[^«»]*»|「[^「」]*」|『[^『』]*』|^[ \t]*>[^\n]*", re.S | re.M
)


def languages_named(asked: str) -> set[str]:
    """The languages that a plain prompt asks for, wherever it does, outside of quoted payload.

    In the head, the first sentence or what stands before a colon or line break, the bare name is enough.
    """
    text = _QUOTED.sub(" ", asked)
    head = re.split(r"[:：\n。！？!?]|\.(?=\s|$)", text.lstrip(), maxsplit=1)[0]
    out = {_ASK_WORDS[w] for w in _NAMED.findall(head)}
    for m in _REQUEST.finditer(text):
        if not _STATED.search(text[text.rfind("\n", 0, m.start()) + 1 : m.start()]):
            name = m["name"] or m["before"]
            out.add(next(lang for w, lang in _STEMS if name.startswith(w)))
    return out


#: Names as :func:`_form` cuts them, the longest first.
_STEMS = sorted(((re.sub("(?<=к)(?:ий|и)$", "", w), lang) for w, lang in _ASK_WORDS.items()), key=lambda x: -len(x[0]))


_INVISIBLE = re.compile("[\xad\u061c\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
#: Cheap cues, one of which every refusal pattern needs; found by one automaton in one pass.
_CUES = ahocorasick.Automaton()
for _cue in (
    "can't;cannot;can not;unable;not able;won't;will not;not going;decline;refuse;rather not;prefer not;nicht;keine a;ablehnen;zurückweisen;pas ;refuser;décliner;"
    "no puedo;no estoy;prefiero;no voy;rechazar;declinar;não ;recusar;non ;rifiutare;declinare;preferisco;не ;няма;откажа;отклон;отказать;لا ;لست;أفضل;لن ;أرفض;"
    "办法;想;会回答;拒绝;无法;不能;没法;帮不;恕不;n't ;is not;not a;not something;not comfortable;against my;outside my;pass;no comment;gegen meine;dazu ;kein thema;lieber nicht;"
    "contraire;je passe;m'abstiens;contra ;me abstengo;no es un;no me s;abstenho;contro ;mi astengo;против;въздърж;воздерж;ضد ;ليس;أمتنع;违反;方便;不便;恕难"
).split(";"):
    _CUES.add_word(_cue, 1)
_CUES.make_automaton()


def plain(text: str) -> str:
    """Composed, case folded, without invisible characters."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKC", text).casefold()
    if _INVISIBLE.search(text):
        text = "".join(c for c in text if unicodedata.category(c) != "Cf")
    return text.replace("’", "'")


_EDGES = "\"'’”“„«»‘()（）[]【】*_`~>#•-—–.,;:!?…،؛؟、，；：。！？"
_EDGE_SET = frozenset(_EDGES)
_STOPS = re.compile(r"[.!?؟…。！？]+")


def ending(part: str) -> str | None:
    """The last words of a sentence: two words, or three characters of a script without spaces."""
    tail = part.rstrip().rstrip(_EDGES)
    if tail and "㐀" <= tail[-1] <= "鿿":
        return tail[-3:]
    last = tail.rsplit(None, 2)[-2:]
    if len(last) == 2 and last[0][-1] not in _EDGE_SET and last[0][0] not in _EDGE_SET and last[1][0] not in _EDGE_SET:
        return f"{last[0]} {last[1]}"  # nothing to strip
    words: list[str] = []
    while tail and len(words) < 2:
        rest, _, last = tail.rpartition(" ")
        last = last.split()[-1] if last.split() else ""
        if word := last.strip(_EDGES):
            words.insert(0, word)
        tail = rest.rstrip()
    return " ".join(words) or None


def last_word(end: str) -> str:
    """The last word of an ending, in scripts without spaces the last character."""
    return end[-1] if "㐀" <= end[-1] <= "鿿" else end.rpartition(" ")[2]


_SENTENCE = re.compile(r"(?<=[.!?。！？؟:：])\s*|\n+")
_LISTED = re.compile(r"(?:^|\n)\s*[-*•\d]")


def endings(text: str) -> list[str]:
    """The endings of all finished sentences of a plain text."""
    return [e for e in map(ending, _STOPS.split(text)[:-1]) if e]


def _sign(yes: bool, no: bool = False) -> str:
    return "+" if yes else "-" if no else "0"


def asked_of(prompt: str | None) -> tuple[str, list[str], frozenset[str]]:
    """A prompt as the voters read it: plain, its words, and the set of them."""
    text = plain(prompt or "")
    words = _WORD.findall(text)
    return text, words, frozenset(words)


def votes(
    prompt: str | tuple[str, list[str], frozenset[str]], answer: str | None, held: tuple[str | None, str | None, bool, bool], read: tuple[str, list[str], frozenset[str]] | None = None
) -> tuple[dict[str, str], str | None]:
    """Vote patterns of each defect, without the corpus votes on truncation, and the ending to look up.

    ``held``: language of prompt and answer, and whether each is sure.  ``read``: the answer as :func:`asked_of` reads it.
    """
    text, content, _ = read or asked_of(answer)
    bare = text.strip()
    placeholder = bare in _PLACEHOLDER or bare.strip("<>[]().-_ ") in _PLACEHOLDER
    out = {"empty": _sign(answer is None or not bare, bool(bare)) if not content else _sign(False, not placeholder)}
    out["empty"] += _sign(not content, len(content) >= 3) + _sign(placeholder or not content, bool(content) and not placeholder)
    if not content or placeholder:
        for d in DEFECTS[1:]:
            out[d] = "-" * (VOTERS[d] - CORPUS_VOTES * (d == "truncated"))  # the corpus adds the last votes
        return out, None

    # Truncation: does the text stop, dangle, or end where sentences of the corpus end?
    tail = bare.rstrip(_CLOSERS)
    stopped = bool(tail) and (tail[-1] in _STOP or tail[-1] in ";；")
    closed = not stopped and bare[-1] in "\"”»)）]】'"
    fence = bare.endswith("```") and bare.count("```") % 2 == 0
    done = stopped or closed or fence
    dangling = not done and bare[-1] in ",:，、：-–—(（[«„“‘/&+"
    opened = not done and any(bare.count(a) > bare.count(b) for a, b in (("(", ")"), ("«", "»"), ("（", "）"), ("[", "]"), ("„", "“")))
    listed = len(content) <= 4 and bool(_LISTED.search(bare))
    lookup = None if done or dangling else ending(bare)
    out["truncated"] = _sign(dangling, done) + _sign(opened, False) + _sign(False, listed and not dangling)

    # Refusal: what it says, how it is framed, and whether an answer follows.
    sentences: list[str] = []
    says: list[bool] = []
    if next(_CUES.iter(bare), None) is not None:
        sentences = [s for s in _SENTENCE.split(bare) if _WORD.search(s)]
        says = [next(_CUES.iter(s), None) is not None and _REFUSE.search(s) is not None for s in sentences]
    if any(says):
        first = says.index(True) + 1
        after = sum(len(_WORD.findall(s)) for s, x in zip(sentences[first:], says[first:]) if not x)
        out["refusal"] = "+" + _sign(after < 4, after >= 8) + _sign(bool(_FRAME.search(bare))) + _sign(len(sentences) <= 3, len(sentences) > 5)
    else:
        out["refusal"] = "-" + _sign(False, len(content) >= 8) + "--"

    # Copied question: nothing but the prompt, perhaps behind a few words that announce it.
    asked, asked_words, asked_set = asked_of(prompt) if isinstance(prompt, str) else prompt
    mine = set(content)
    if not asked_words or len(mine & asked_set) < 0.6 * len(mine):
        out["copied_question"] = "---"
    else:
        bodies = [content, _WORD.findall(_LEADS.sub("", bare, count=1))]
        joined = "\x00".join(asked_words)
        whole = any(b and "\x00".join(b) in joined and len(b) >= 0.5 * len(asked_words) and len(b) >= 5 for b in bodies)
        grams = {tuple(content[i : i + 3]) for i in range(len(content) - 2)} or {tuple(content)}
        known = {tuple(asked_words[i : i + 3]) for i in range(len(asked_words) - 2)} or {tuple(asked_words)}
        share = len(grams & known) / len(grams)
        cover = len(grams & known) / len(known)
        fresh = len(grams - known)  # new content; a prompt given twice has next to none
        whole = whole or (share >= 0.95 and cover >= 0.5)
        out["copied_question"] = _sign(whole, not whole) + _sign(share >= 0.75 and cover >= 0.5, share < 0.6) + _sign(fresh <= 6 and cover >= 0.5, fresh > 8 or cover < 0.3)

    # Language: of prompt and answer, and whether the prompt asks for another.
    from_lang, to_lang, sure_prompt, sure_answer = held
    differ = bool(from_lang and to_lang and from_lang != to_lang)
    spoken = languages_named(asked) if differ else set()
    wanted = differ and to_lang in spoken
    out["wrong_language"] = _sign(differ and sure_answer and not wanted, not differ or wanted) + _sign(differ and sure_prompt and sure_answer and not wanted, not differ or wanted) + _sign(differ and sure_answer and not spoken, not differ or not sure_answer or wanted)
    return out, lookup


def answer_rows(identity: DataFrame, preferences: DataFrame) -> DataFrame:
    """table_name, id, prompt and the one or two answers (a, b) of every record of both tables."""
    users = F.array_join(
        F.transform(F.filter("prompt_messages", lambda m: F.lower(F.trim(m["role"])) == "user"), lambda m: content_text(m["content"])), "\n"
    )
    one = identity.select(
        F.lit("identity_sft").alias("table_name"), F.col("id").cast("string").alias("id"), F.col("messages_flat.user").alias("prompt"),
        F.col("messages_flat.assistant").alias("a"), F.lit(None).cast("string").alias("b"),
    )
    two = preferences.select(
        F.lit("preference_rows").alias("table_name"), F.col("id").cast("string").alias("id"), F.coalesce("prompt", users).alias("prompt"),
        F.col("chosen").alias("a"), F.col("rejected").alias("b"),
    )
    return one.unionByName(two).where(F.col("id").isNotNull())


#: The fields of a table's answers a and b.
FIELDS = {"identity_sft": ("assistant",), "preference_rows": ("chosen", "rejected")}


def _languages(found: list) -> list[tuple[str | None, bool]]:
    """The main language of each text, and whether it is sure; all texts at once."""
    held = [i for i, r in enumerate(found) if r is not None]
    out: list[tuple[str | None, bool]] = [(None, False)] * len(found)
    if not held:
        return out
    starts = np.concatenate(([0], np.cumsum([len(found[i][2]) for i in held])[:-1]))
    total = np.add.reduceat(np.concatenate([found[i][4] for i in held]), starts, axis=0)
    words = np.add.reduceat(np.concatenate([found[i][2] for i in held]), starts)
    best = total.argmax(axis=1)
    sure = (total.max(axis=1) >= 0.9 * total.sum(axis=1)) & (words >= 4)
    for i, x, y in zip(held, best.tolist(), sure.tolist()):
        out[i] = (LANGUAGES[x], y)
    return out


_PASS = ", ".join(f"{c} string" for c in ("part", "table_name", "id", "field", *DEFECTS, "ending", "first", "last")) + ", n_all long, n_final long"
_COLUMNS = [c.split()[0] for c in _PASS.split(", ")]
#: Distinct endings and words that a task gathers before it hands them on.
GATHERED = 300_000


def _read(parts: tuple[np.ndarray, ...]):
    """One pass over the texts.  Rows of three parts: ``vote``, each answer with its votes; ``ending``, each
    ending of a finished sentence with the first and last record that has it; ``word``, each word with
    how often it is used and how often it ends a sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(parts)
        crf = words.crf
        first: dict[str, str] = {}
        last: dict[str, str] = {}
        used: Counter = Counter()
        final: Counter = Counter()

        def rows(out: dict[str, list]) -> pa.RecordBatch:
            n = max(map(len, out.values()))
            return pa.record_batch([pa.array(out.get(c) or [None] * n, pa.int64() if c.startswith("n_") else pa.string()) for c in _COLUMNS], _COLUMNS)

        def gathered() -> Iterator[pa.RecordBatch]:
            if first:
                yield rows({"part": ["ending"] * len(first), "ending": list(first), "first": list(first.values()), "last": [last[e] for e in first]})
            if used:
                yield rows({"part": ["word"] * len(used), "ending": list(used), "n_all": list(used.values()), "n_final": [final[w] for w in used]})
            for x in (first, last, used, final):
                x.clear()

        def gather(record: str, text: str, all_words: list[str]) -> None:
            used.update(all_words)
            for e in endings(text):
                final[last_word(e)] += 1
                if e not in first:
                    first[e] = last[e] = record
                elif record < first[e]:
                    first[e] = record
                elif record > last[e]:
                    last[e] = record

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                tables, ids, prompts, a, b = (c.to_pylist() for c in batch.slice(at, 4096).columns)
                texts = [x for p, *xs in zip(prompts, a, b) for x in (p, *xs)]  # prompt, a, b of each record
                token_lists = [tokens_of(t) if t else [] for t in texts]
                spoken = _languages(label_sentences(crf, token_lists, words))
                out: dict[str, list] = {c: [] for c in ("table_name", "id", "field", *DEFECTS, "ending")}
                for i, table in enumerate(tables):
                    p, sure_p = spoken[3 * i]
                    asked = asked_of(prompts[i])
                    record = f"{table}\x00{ids[i]}"
                    gather(record, asked[0], asked[1])
                    for k, field in enumerate(FIELDS[table], start=1):
                        x, sure = spoken[3 * i + k]
                        read = asked_of(texts[3 * i + k])
                        gather(record, read[0], read[1])
                        row, lookup = votes(asked, texts[3 * i + k], (p, None if len(token_lists[3 * i + k]) < 3 else x, sure_p, sure), read)
                        row.update(table_name=table, id=ids[i], field=field, ending=lookup)
                        for column, values in out.items():
                            values.append(row[column])
                yield rows(out | {"part": ["vote"] * len(out["id"])})
                if len(first) + len(used) > GATHERED:
                    yield from gathered()
        yield from gathered()

    return run


def scored(identity: DataFrame, preferences: DataFrame, crf: Crf) -> DataFrame:
    """Each answer's vote patterns; the truncation pattern ends with the votes of the corpus."""
    passed = materialize(answer_rows(identity, preferences).mapInArrow(_read((crf.weights, crf.within, crf.across)), _PASS), "answers")
    voted = passed.where("part = 'vote'").select("table_name", "id", "field", *DEFECTS, "ending")
    # An ending is known once two records have it; a record counts once, however often it is delivered.
    known = passed.where("part = 'ending'").groupBy("ending").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last")
    words = passed.where("part = 'word'").groupBy(F.col("ending").alias("word")).agg(F.sum("n_all").alias("n_all"), F.sum("n_final").alias("n_final"))
    share = words.agg((F.sum("n_final") / F.sum("n_all")).alias("share"))  # one row
    asked = voted.where("ending is not null").select("ending").distinct()
    last = F.when(F.substring("ending", -1, 1).between("㐀", "鿿"), F.substring("ending", -1, 1)).otherwise(F.substring_index("ending", " ", -1))
    facts = lookup(asked.withColumn("word", last), words, "word").join(known.select("ending", F.lit(True).alias("known")), "ending", "left").crossJoin(F.broadcast(share))
    rate = F.col("n_final") / F.col("n_all") / F.col("share")
    facts = facts.select(
        "ending",
        F.concat(
            F.when((F.col("n_all") >= LEAST_USES) & (rate <= RARE_END), "+").when((F.col("n_all") >= LEAST_USES) & (rate >= COMMON_END), "-").otherwise("0"),
            F.when(F.col("known").isNull(), "+").otherwise("-"),
        ).alias("said"),
    )
    joined = lookup(voted, facts, "ending")
    return materialize(joined.withColumn("truncated", F.concat("truncated", F.coalesce("said", F.when(F.col("truncated").startswith("+"), "0" * CORPUS_VOTES).otherwise("-" * CORPUS_VOTES)))).drop("ending", "said"), "votes")


def models(rows: DataFrame) -> dict[str, dict[str, float]]:
    """The posterior of each vote pattern of each defect; at most 3 ** voters of them."""
    return {d: labelmodel.posteriors(rows, d, VOTERS[d]) for d in DEFECTS}


def best_cutoffs(posteriors: dict[str, list[float]], truth: dict[str, list[bool]]) -> dict[str, tuple[float, float]]:
    """Of each defect the cutoff with the best F1 on labelled answers, the middle of those as good, and that F1."""
    out = {}
    for d, scores in posteriors.items():
        graded = []
        for cut in sorted({0.05 * k for k in range(1, 20)}):
            hits = [s >= cut for s in scores]
            both = sum(h and t for h, t in zip(hits, truth[d]))
            graded.append((2 * both / max(1, sum(hits) + sum(truth[d])), cut))
        best = max(f for f, _ in graded)
        as_good = [c for f, c in graded if f >= best - 1e-9]
        out[d] = (round(as_good[len(as_good) // 2], 2), best)
    return out


def defects(identity: DataFrame, preferences: DataFrame, crf: Crf, cutoffs: dict[str, float] = CUTOFFS) -> DataFrame:
    """table_name, id, field, defect, posterior."""
    rows = scored(identity, preferences, crf)
    spark = rows.sparkSession
    out = None
    for d, model in models(rows).items():
        sure = [(p, float(x)) for p, x in model.items() if x >= cutoffs[d]]
        patterns = spark.createDataFrame(sure, f"{d} string, posterior double")  # at most 3 ** voters rows
        found = rows.join(F.broadcast(patterns), d).select("table_name", "id", "field", F.lit(d).alias("defect"), "posterior")
        out = found if out is None else out.unionByName(found)
    return out.dropDuplicates(["table_name", "id", "field", "defect"])
