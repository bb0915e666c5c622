"""Problem 4: the language of every record, and of every segment of a mixed one.

A linear-chain conditional random field labels the words.  Features of a word are its affixes,
its character n-grams and itself (the learned lexicon) besides a seed lexicon of function words;
transitions are learned apart for neighbours within a sentence and across a sentence break.
Forward-backward gives each word's posterior; a sentence has the language with the most posterior
mass, and runs of sentences of one language are the segments.

Words are taken from the canonical form of :mod:`sievewright.llm.visual`, so look-alike letters
don't count as another language, and a foreign term within a sentence is outvoted by it.

The model is fitted on the driver on a bounded sample: of each language the ``TRAIN_ROWS`` labelled
documents and as many conversations with the least hash, cleaned of sentences whose words speak
for another label.  Everything
else covers all rows and whole texts.

Defined results: null or blank texts, and texts without a word, have no language and don't come
out; a repeated id is one record; labels are compared by code, whatever their spelling.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.records import content_text, text_lists
from sievewright.llm.visual import canonical_form, word_ready

LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "bg", "ru", "ar", "zh")
TRAIN_ROWS = 80
TRAIN_CHARS = 4_000
FEATURES = 1 << 15
#: Words of a stretch of whole sentences that forward-backward runs over at first.  The messages of
#: longer records are then carried from stretch to stretch until they no longer change, so that the
#: posteriors are those of the whole record, whatever the length of a stretch.
STRETCH = 96
#: Change of a message, of all its mass, that counts as none.
SETTLED = 1e-6
#: Words of a training sequence; longer sentences are trained on in parts.
PART = 60
#: A sentence counts as held in a language from so many words and such a mean posterior.
SENTENCE_WORDS = 5
SENTENCE_CONFIDENCE = 0.9

#: Function words of each language: the seed of the lexicon features.
SEED = {
    "en": "the of and to in is that for it with as on are this not but was by which you from they have",
    "de": "der die das und ist nicht ein eine mit für auf dass wenn auch von zu dem den im wie wird sich",
    "fr": "le la les des est une et que qui dans pour pas sur avec au du ce il elle ne quand même",
    "es": "el los las una y que en es por con para no se su al lo como del cuando aunque si",
    "pt": "o os as um uma e que em é por com para não se ao do da dos quando na no você",
    "it": "il lo gli una e che di è per con non si al del della nel quando anche se ogni",
    "bg": "и на да се че за от с е не по като са или ще към това когато този всеки",
    "ru": "и в на не что с по как это для но он она когда если или уже его ещё каждый",
    "ar": "في من على أن إلى هذا التي عن مع لا كان كل ما هو هي قد ثم إذا لأن",
    "zh": "的 了 是 在 和 不 有 我 他 这 们 为 就 也 都 要 会 说 吗 因为",
}

#: Spellings of language labels besides the two-letter code.
SPELLINGS = {
    "en": "eng english anglais", "de": "deu ger german deutsch", "fr": "fra fre french français francais",
    "es": "spa spanish español espanol castellano", "pt": "por portuguese português portugues", "it": "ita italian italiano",
    "bg": "bul bulgarian български", "ru": "rus russian русский", "ar": "ara arabic العربية", "zh": "zho chi cmn chinese mandarin 中文",
}
MISSING = ("", "unknown", "und", "undetermined", "n/a", "na", "none", "null", "nan", "?", "-", "xx", "mul", "zxx", "mis", "other", "undefined", "unk")

_TOKEN = re.compile(
    r"[㐀-鿿]{1,2}|[^\W\d_㐀-鿿]+(?:['’][^\W\d_㐀-鿿]+)*|[。！？；]+|[.!?;؟]+(?!\w)|\n\s*(?=[\n\-*#>•])|\n(?=\w[\w\- ]{0,18}:)|\x00"
)
_NO_WORDS = re.compile(r"\S*(?:@|://|\[at\]|\(at\))\S*")
_BREAK = re.compile(r"[.!?;。！？；؟\n\x00]")


def label_code(name: str) -> Column:
    """A label's two-letter code; null if it is missing; other labels in lower case."""
    plain = F.lower(F.regexp_replace(F.col(name), r"[\s\p{Z}\p{C}]+", ""))
    code = F.regexp_extract(plain, r"^([^\-_]+)", 1)
    spelled = {w: c for c, words in SPELLINGS.items() for w in words.split()}
    pairs = [F.lit(x) for item in spelled.items() for x in item]
    known = F.create_map(*pairs)
    return F.when(plain.isNull() | plain.isin(*MISSING), F.lit(None)).otherwise(F.coalesce(known[code], known[plain], code))


def tokens_of(text: str) -> list[str]:
    """Words and sentence breaks of a text; the words' canonical form is taken word by word."""
    text = word_ready(text.lower())
    if "@" in text or "://" in text or "at]" in text or "at)" in text:
        text = _NO_WORDS.sub(" ", text)
    return _TOKEN.findall(text)


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (FEATURES - 1)


def word_features(word: str) -> list[int]:
    """Hashed features: the word in canonical form, its affixes and n-grams, and its script."""
    word = canonical_form(word) or word
    w = f"^{word}$"
    found = {"w" + word}
    found.update("p" + w[: n + 1] for n in (1, 2, 3, 4) if len(w) > n + 1)
    found.update("s" + w[-n - 1 :] for n in (1, 2, 3, 4) if len(w) > n + 1)
    found.update("g" + w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    point = ord(word[0])
    found.add("c" + ("l" if point < 0x250 else "c" if point < 0x530 else "a" if 0x600 <= point < 0x780 else "h" if 0x3400 <= point < 0xA000 else "o"))
    found.update("k" + lang for lang in LANGUAGES if word in _SEED_SETS[lang])
    return sorted({_hash(f) for f in found})


_SEED_SETS = {lang: frozenset(canonical_form(words).split()) for lang, words in SEED.items()}


@dataclass
class Crf:
    """Weights: of each feature and language, and of transitions within and across sentences."""

    weights: np.ndarray
    within: np.ndarray
    across: np.ndarray

    def emission(self, word: str) -> np.ndarray:
        return self.weights[word_features(word)].sum(axis=0)


def _posteriors(scores: np.ndarray, breaks: np.ndarray, lengths: np.ndarray, within: np.ndarray, across: np.ndarray, pairs: bool = False):
    """Forward-backward over padded sequences.

    ``scores``: sequence x word x language, exponentiated and scaled; ``breaks``: whether a
    sentence break comes before the word.  Returns posteriors, log-likelihood terms and, with
    ``pairs``, the expected transitions of both kinds.
    """
    b, t, k = scores.shape
    alpha = np.empty_like(scores)
    scale = np.empty((b, t), np.float32)
    live = np.arange(t)[None, :] < lengths[:, None]
    a = scores[:, 0] / k
    for i in range(t):
        if i:
            step = np.where(breaks[:, i, None], a @ across, a @ within)
            a = np.where(live[:, i, None], step * scores[:, i], a)
        s = a.sum(axis=1)
        scale[:, i] = s
        a = a / s[:, None]
        alpha[:, i] = a
    beta = np.ones((b, k), np.float32)
    post = np.empty_like(scores)
    expected = [np.zeros((k, k)), np.zeros((k, k))]
    for i in range(t - 1, -1, -1):
        p = alpha[:, i] * beta
        post[:, i] = p / p.sum(axis=1, keepdims=True)
        if i:
            g = scores[:, i] * beta
            if pairs:
                for kind, matrix in ((0, within), (1, across)):
                    rows = live[:, i] & (breaks[:, i] == bool(kind))
                    if rows.any():
                        x = alpha[rows, i - 1][:, :, None] * matrix[None] * g[rows][:, None, :]
                        expected[kind] += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = np.where(breaks[:, i, None], g @ across.T, g @ within.T)
            back = back / back.sum(axis=1, keepdims=True)
            beta = np.where(live[:, i, None], back, beta)
    return post, np.log(scale), expected


def fit(texts: list[tuple[str, str]], epochs: int = 8, seed: int = 7) -> Crf:
    """Train on the sentences of (text, language) pairs.

    Labels are wrong here and there and some texts are mixed, so a sentence is left out where the
    counts of its words over all the pairs speak for another language than its label.
    """
    sentences: list[tuple[list[str], int]] = []
    for lang, words in SEED.items():
        sentences += [(canonical_form(words).split(), LANGUAGES.index(lang))] * 2
    for text, lang in texts:
        current: list[str] = []
        for token in [*tokens_of(text), "."]:
            if _BREAK.match(token):
                sentences += [(current[i : i + PART], LANGUAGES.index(lang)) for i in range(0, len(current), PART)]
                current = []
            else:
                current.append(token)
    counts: dict[str, np.ndarray] = {}
    for words, y in sentences:
        for w in words:
            counts.setdefault(w, np.zeros(len(LANGUAGES)))[y] += 1
    total = sum(counts.values())
    logs = {w: np.log((c + 0.02) / (total + 1)) for w, c in counts.items()}
    clean = [(words, y) for words, y in sentences if int(np.argmax(sum(logs[w] for w in words))) == y]
    return _train(clean, epochs, np.random.default_rng(seed))


def _train(sentences: list[tuple[list[str], int]], epochs: int, rng: np.random.Generator, batch: int = 256) -> Crf:
    """Adam on the conditional log-likelihood of sequences of about four sentences.

    Neighbouring sentences keep their language three times out of four and come from anywhere
    else otherwise, so that the chain learns to stay within a sentence and to switch at breaks.
    """
    k = len(LANGUAGES)
    by_lang = [[i for i, (_, y) in enumerate(sentences) if y == lang] for lang in range(k)]
    vocabulary: dict[str, int] = {}
    coded = [(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words]), y) for words, y in sentences]
    rows = [word_features(w) for w in vocabulary]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate([np.array(r) for r in rows])
    weights = np.zeros((FEATURES, k), np.float32)
    within = np.eye(k, dtype=np.float32) * 3
    across = np.eye(k, dtype=np.float32)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, within, across)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(coded))
        for at in range(0, len(order), batch * 4):
            group = order[at : at + batch * 4]
            sequences = []
            for first in group[::4]:
                items = [first]
                while len(items) < 4:
                    lang = coded[items[-1]][1]
                    if rng.random() < 0.25 or not by_lang[lang]:
                        items.append(int(rng.integers(len(coded))))
                    else:
                        items.append(by_lang[lang][int(rng.integers(len(by_lang[lang])))])
                ids = np.concatenate([coded[i][0] for i in items])
                ys = np.concatenate([np.full(len(coded[i][0]), coded[i][1]) for i in items])
                br = np.concatenate([np.arange(len(coded[i][0])) == 0 for i in items])
                sequences.append((ids, ys, br))
            length = np.array([len(s[0]) for s in sequences])
            t = int(length.max())
            ids, ys = np.zeros((len(sequences), t), np.int64), np.zeros((len(sequences), t), np.int64)
            br = np.zeros((len(sequences), t), bool)
            for j, s in enumerate(sequences):
                ids[j, : length[j]], ys[j, : length[j]], br[j, : length[j]] = s
            live = np.arange(t)[None] < length[:, None]
            used = np.unique(ids[live])
            pick = np.isin(owner, used)
            emission = np.zeros((len(rows), k), np.float32)
            np.add.at(emission, owner[pick], weights[feature[pick]])
            e = emission[ids]
            scores = np.exp(e - e.max(axis=2, keepdims=True))
            post, _, expected = _posteriors(scores, br, length, np.exp(within), np.exp(across), pairs=True)
            delta = -post
            np.add.at(delta, (np.arange(len(ids))[:, None], np.arange(t)[None], ys), 1.0)
            delta[~live] = 0
            by_word = np.zeros((len(rows), k), np.float32)
            np.add.at(by_word, ids[live], delta[live])
            grad_w = np.zeros_like(weights)
            np.add.at(grad_w, feature[pick], by_word[owner[pick]])
            n = float(live.sum())
            grads = [grad_w / n - 1e-5 * weights]
            for kind, matrix in ((False, within), (True, across)):
                seen = np.zeros((k, k))
                inner = live[:, 1:] & (br[:, 1:] == kind)
                np.add.at(seen, (ys[:, :-1][inner], ys[:, 1:][inner]), 1.0)
                grads.append(((seen - expected[int(kind)]) / n - 1e-4 * matrix).astype(np.float32))
            step += 1
            for x, g, (m, v) in zip((weights, within, across), grads, state):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                x += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return Crf(weights.astype(np.float32), np.exp(within).astype(np.float32), np.exp(across).astype(np.float32))


class _Words(dict):
    """Row numbers of words in a growing table of emissions; bounded, as it starts again when full."""

    LIMIT = 100_000

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf, self.table = crf, np.zeros((1024, len(LANGUAGES)), np.float32)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if _BREAK.match(word):
            self[word] = -1
            return -1
        e = self.crf.emission(word)
        self.table[number] = np.exp(e - e.max())
        self[word] = number
        return number


_KEPT: dict[int, _Words] = {}


def words_of(parts: tuple[np.ndarray, ...]) -> _Words:
    """The table of a model's words in this process, kept from task to task."""
    key = zlib.crc32(parts[0].tobytes())
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = _Words(Crf(*parts))
    return _KEPT[key]


def _messages(scores: np.ndarray, breaks: np.ndarray, lengths: np.ndarray, within: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages over padded sequences, each of them adding up to one."""
    b, t, k = scores.shape
    alpha, beta = np.empty_like(scores), np.empty_like(scores)
    live = np.arange(t)[None, :] < lengths[:, None]
    a = scores[:, 0] / scores[:, 0].sum(axis=1, keepdims=True)
    alpha[:, 0] = a
    for i in range(1, t):
        step = np.where(breaks[:, i, None], a @ across, a @ within) * scores[:, i]
        a = np.where(live[:, i, None], step / step.sum(axis=1, keepdims=True), a)
        alpha[:, i] = a
    m = np.full((b, k), 1 / k, np.float32)
    beta[:, t - 1] = m
    for i in range(t - 1, 0, -1):
        g = scores[:, i] * m
        back = np.where(breaks[:, i, None], g @ across.T, g @ within.T)
        m = np.where(live[:, i, None], back / back.sum(axis=1, keepdims=True), m)
        beta[:, i - 1] = m
    return alpha, beta


def _settle(alpha: np.ndarray, beta: np.ndarray, table: np.ndarray, ids: np.ndarray, begin: np.ndarray, fresh: np.ndarray, first: np.ndarray, length: np.ndarray, crf: Crf) -> None:
    """Carry the messages over the edges of stretches.

    From each edge within a record a front runs on, rewriting messages from those of the neighbour,
    until what it writes is what stood there; the chain forgets within a few words.  Fronts that
    reach the next edge go on over it.
    """
    last = first + length - 1
    inner = ~fresh[first]  # stretches that continue a record
    at = first[inner]
    while len(at):
        step = np.where(begin[at, None], alpha[at - 1] @ crf.across, alpha[at - 1] @ crf.within) * table[ids[at]]
        step /= step.sum(axis=1, keepdims=True)
        moved = np.abs(step - alpha[at]).max(axis=1) > SETTLED
        alpha[at] = step
        at = at[moved] + 1
        at = at[at < len(ids)]
        at = at[~fresh[at]]
    ends = np.append(fresh[1:], True)  # the last word of a record
    at = last[~ends[last]]
    while len(at):
        g = table[ids[at + 1]] * beta[at + 1]
        step = np.where(begin[at + 1, None], g @ crf.across.T, g @ crf.within.T)
        step /= step.sum(axis=1, keepdims=True)
        moved = np.abs(step - beta[at]).max(axis=1) > SETTLED
        beta[at] = step
        at = at[moved] - 1
        at = at[at >= 0]
        at = at[~ends[at]]


def label_sentences(crf: Crf, token_lists: list[list[str]], words: _Words | None = None):
    """For each record, arrays of its sentences: language, mean posterior, words, place in the
    tokens and posterior mass; None for a record without words."""
    words = words if words is not None else _Words(crf)
    if len(words) > words.LIMIT:
        words.clear()
        words.table = np.zeros((1024, len(LANGUAGES)), np.float32)
    number = words.__getitem__
    lengths = np.fromiter(map(len, token_lists), np.int64, len(token_lists))
    flat = np.fromiter(map(number, chain.from_iterable(token_lists)), np.int32, int(lengths.sum()))
    owner = np.repeat(np.arange(len(token_lists)), lengths)
    word = flat >= 0
    ids, owner = flat[word], owner[word]
    results: list[tuple[np.ndarray, ...] | None] = [None] * len(token_lists)
    if not len(ids):
        return results
    place = np.flatnonzero(word) - np.concatenate(([0], np.cumsum(lengths)[:-1]))[owner]
    stop = np.cumsum(~word)[word]
    fresh = np.concatenate(([True], owner[1:] != owner[:-1]))  # the first word of a record
    begin = fresh.copy()
    begin[1:] |= stop[1:] != stop[:-1]  # the first word of a sentence
    starts = np.flatnonzero(begin)
    sizes = np.diff(np.concatenate((starts, [len(ids)])))
    # Stretches of whole sentences: a new one for each record and wherever the last one is full.
    cut, room = np.empty(len(starts), bool), 0
    for s, (size, new) in enumerate(zip(sizes.tolist(), fresh[starts].tolist())):
        cut[s] = new or size > room
        room = (STRETCH if cut[s] else room) - size
    first = starts[cut]
    length = np.diff(np.concatenate((first, [len(ids)])))
    alpha = np.empty((len(ids), len(LANGUAGES)), np.float32)
    beta = np.empty_like(alpha)
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        # Stretches of like length side by side, so that little is padding and memory is bounded.
        end = at + 1
        while end < len(order) and (end - at + 1) * length[order[end]] <= 200_000:
            end += 1
        group = order[at:end]
        at = end
        t = int(length[group].max())
        cells = first[group][:, None] + np.arange(t)[None]
        live = np.arange(t)[None] < length[group][:, None]
        cells = np.where(live, cells, first[group][:, None])
        breaks = begin[cells] & live
        breaks[:, 0] = False
        x, y = _messages(words.table[ids[cells]], breaks, length[group], crf.within, crf.across)
        alpha[cells[live]], beta[cells[live]] = x[live], y[live]
    _settle(alpha, beta, words.table, ids, begin, fresh, first, length, crf)
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    mass = np.add.reduceat(post, starts, axis=0)
    lang, sure = mass.argmax(axis=1), mass.max(axis=1) / sizes
    of = owner[starts]
    edges = np.concatenate((np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))), [len(of)]))
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
        results[of[i]] = (lang[i:j], sure[i:j], sizes[i:j], place[starts[i:j]], mass[i:j])
    return results


def held_languages(result: tuple[np.ndarray, ...]) -> dict[int, float]:
    """The languages of a record's whole sentences with their confidence; at least the best one."""
    lang, confidence, counts, _, mass = result
    sure = (counts >= SENTENCE_WORDS) & (confidence >= SENTENCE_CONFIDENCE)
    weight = np.bincount(lang, counts * sure, len(LANGUAGES))
    if weight.any():
        certain = np.bincount(lang, confidence * counts * sure, len(LANGUAGES))
        return {int(x): float(certain[x] / weight[x]) for x in np.flatnonzero(weight)}
    total = mass.sum(axis=0)
    return {int(total.argmax()): float(total.max() / total.sum())}


def sample(*sources: tuple[DataFrame, str, str, Column], rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[tuple[str, str]]:
    """Labelled texts of up to ``chars`` characters: at most ``rows`` of each language and source,
    those with the least hash.  A source: table, id column, label column, text."""
    from pyspark.sql import Window

    out = []
    for df, key, label, text in sources:
        coded = df.select(key, label_code(label).alias("l"), F.xxhash64(key).alias("h")).where(F.col("l").isin(*LANGUAGES))
        ids = (
            coded.dropDuplicates([key]).withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", key)))
            .where(F.col("r") <= rows * 2).select(key, "l")
        )  # at most 2 x rows x 10 ids
        picked = df.join(F.broadcast(ids), key).select(key, "l", text.alias("t")).where(F.length("t").between(20, chars))
        found: dict[str, dict] = {}
        for r in sorted(picked.collect(), key=lambda r: str(r[key])):
            found.setdefault(r["l"], {}).setdefault(r[key], r["t"])
        out += [(t, lang) for lang in sorted(found) for t in list(found[lang].values())[:rows]]
    return out


def document_source(docs: DataFrame) -> tuple[DataFrame, str, str, Column]:
    return docs, "doc_id", "lang", F.col("text")


def conversation_source(sft: DataFrame) -> tuple[DataFrame, str, str, Column]:
    return sft, "id", "language", F.array_join(F.transform("messages", lambda m: content_text(m["content"])), "\n\n")


#: What is found of a record: its languages, or its segments.
_LANGUAGE = "struct<language:string,confidence:double,n_sentences:int>"
_SEGMENT = "struct<first_sentence:int,language:string,confidence:double,n_sentences:int,n_words:int>"


def _label(crf_parts: tuple[np.ndarray, ...], segments: bool):
    names = ["first_sentence", "language", "confidence", "n_sentences", "n_words"] if segments else ["language", "confidence", "n_sentences"]
    types = {"first_sentence": pa.int32(), "language": pa.string(), "confidence": pa.float64(), "n_sentences": pa.int32(), "n_words": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(crf_parts)
        crf = words.crf
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                found = label_sentences(crf, [tokens_of("\n\n".join(t)) for t in text_lists(b, "__text")], words)
                out: dict[str, list] = {n: [] for n in names}
                kept, offsets = [], [0]
                for i, result in enumerate(found):
                    if result is None:
                        continue
                    if segments:
                        rows = _segments(result)
                    else:
                        rows = [(LANGUAGES[x], c, int((result[0] == x).sum())) for x, c in sorted(held_languages(result).items())]
                    for row in rows:
                        for column, value in zip(out.values(), row):
                            column.append(value)
                    kept.append(i)
                    offsets.append(offsets[-1] + len(rows))
                rows = pa.StructArray.from_arrays([pa.array(v, types[n]) for n, v in out.items()], names)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
                keys = b.select(["record_id", "label", "t", "h"]).take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([*keys.columns, lists], ["record_id", "label", "t", "h", "found"])

    return run


def _segments(result: tuple[np.ndarray, ...]) -> list[tuple]:
    """Runs of sentences of one language: first sentence, language, confidence, sentences, words."""
    lang, confidence, counts, _, _ = result
    edges = [0, *(np.flatnonzero(lang[1:] != lang[:-1]) + 1).tolist(), len(lang)]
    out = []
    for i, j in zip(edges, edges[1:]):
        n = int(counts[i:j].sum())
        out.append((i, LANGUAGES[lang[i]], float((confidence[i:j] * counts[i:j]).sum() / n), j - i, n))
    return out


def _both(docs: DataFrame, sft: DataFrame, crf: Crf, segments: bool) -> DataFrame:
    """table_name, record_id, label, found: one row for each id, its latest delivery (of equally late ones
    that with the greatest hash).  Texts aren't shuffled: a delivery is labelled where it lies."""
    parts = (crf.weights, crf.within, crf.across)
    late = lambda df, c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(-(2**62))) if c in df.columns else F.lit(0).cast("long")
    inputs = (
        ("documents", docs, F.col("doc_id").cast("string"), "lang", "text", late(docs, "collected_at")),
        ("sft_rows", sft, F.col("id").cast("string"), "language", "messages", late(sft, "ingested_at")),
    )
    found = None
    for name, df, key, label, text, t in inputs:
        rows = df.select(key.alias("record_id"), label_code(label).alias("label"), t.alias("t"), F.xxhash64(text).alias("h"), F.col(text).alias("__text")).where("record_id is not null")
        part = rows.mapInArrow(_label(parts, segments), f"record_id string, label string, t long, h long, found array<{_SEGMENT if segments else _LANGUAGE}>")
        part = part.withColumn("table_name", F.lit(name))
        found = part if found is None else found.unionByName(part)
    mark = F.struct("t", "h")
    return found.groupBy("table_name", "record_id").agg(F.max_by(F.struct("label", "found"), mark).alias("x")).select("table_name", "record_id", "x.label", "x.found")


def languages(docs: DataFrame, sft: DataFrame, crf: Crf) -> DataFrame:
    """table_name, record_id, language, confidence, n_sentences: a row for each language a record holds."""
    return _both(docs, sft, crf, False).select("table_name", "record_id", F.inline("found"))


def segments(docs: DataFrame, sft: DataFrame, crf: Crf) -> DataFrame:
    """The segments of every record: runs of sentences of one language, with confidence."""
    return _both(docs, sft, crf, True).select("table_name", "record_id", F.inline("found"))


def wrong_labels(docs: DataFrame, sft: DataFrame, crf: Crf) -> DataFrame:
    """table_name, record_id, language of the records whose label is missing, wrong or one of several."""
    held = F.transform("found", lambda x: x["language"])
    rows = _both(docs, sft, crf, False).select("table_name", "record_id", "label", held.alias("held"))
    return rows.where(F.col("label").isNull() | ~F.array_contains("held", F.col("label")) | (F.size("held") > 1)).select("table_name", "record_id", F.explode("held").alias("language"))
