"""Problem 9: text that looks the same but is made of different characters.

A finite-state transducer reads a text once, cluster by cluster, and writes each cluster's canonical
form.  A cluster is a base character with all that changes or follows it: combining marks, joiners,
variation selectors, tags, the jamo of a syllable, a line feed after a carriage return.  Its tables
are compiled at import from the character database and the look-alike list below:

* ``SINGLE`` has the form of a cluster of one character;
* ``CLUSTERS`` has whole clusters; the longest match wins, so that a cluster is looked up whole first;
* ``ARCS`` are the transitions for clusters that aren't listed, such as a base with many marks: a
  mark leads from one composed letter to the next, or is written out.

:func:`conflicts` holds every entry against what a reader tells apart and the module refuses to load
if it finds any: a form that changes again, a case pair, letters of one script, letters with other
accents, or characters of another sort that meet in one form, and anything visible that is dropped.

Canonical form: full-width forms, Latin ligatures, radicals and positional forms of letters become
the ordinary characters, special spaces and blank signs a space, line ends a line feed, hyphen
variants the hyphen-minus; base and accent are composed, marks stand in canonical order; letters of
Cyrillic, Greek and Armenian that look like a Latin letter become that letter, also with an accent.
Characters without a glyph go, but only where they change none: the joiners stay between letters
whose shapes they change, after a virama and within emoji, variation selectors after signs that
have variants, tags in flags.  Signs of the format category that do show, such as the Arabic end of
verse, stay.  Case, accents, digits and every other character stay too, so texts that look different
stay different.  In particular letters that only resemble each other (small Cyrillic ka and k, ze and
3, O and 0, l and I) stay apart.

Defined results: null stays null; a blank text becomes its blanks; a mark without a base stays.
The transformation is idempotent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.copies import classes, pairs
from sievewright.session import materialize

#: Look-alike letters: each pair has the same glyph in common fonts.
LOOK_ALIKES = {
    # Cyrillic small letters
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "ԝ": "w", "х": "x", "у": "y",
    # Cyrillic capitals
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "У": "Y",
    # Greek
    "ο": "o", "ν": "v", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Armenian and others
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "ɡ": "g", "ɑ": "a",
    # hyphens, apostrophes of the same glyph
    "‐": "-", "‑": "-", "ʼ": "’",
}

#: Blocks whose compatibility forms look like the ordinary characters.  Others, such as
#: superscripts and circled digits, do look different and stay.
_WIDTH_BLOCKS = ((0x2E80, 0x2FD5), (0xFB00, 0xFB06), (0xFB13, 0xFB17), (0xFB50, 0xFDFB), (0xFE70, 0xFEFC), (0xFF01, 0xFFEE))
#: The half-width voicing signs, letters by category, are marks of the kana before them.
_VOICING = {"ﾞ": "\u3099", "ﾟ": "\u309a"}
#: Format characters that show or change the order of what is shown: number signs, end of verse,
#: annotations, overrides of direction, notation and hieroglyph controls.
_SHOWN = ((0x600, 0x605), (0x6DD, 0x6DD), (0x70F, 0x70F), (0x890, 0x891), (0x8E2, 0x8E2), (0x202D, 0x202E), (0xFFF9, 0xFFFB), (0x110BD, 0x110BD), (0x110CD, 0x110CD), (0x13430, 0x1345F), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A))
#: Without a glyph though no format characters.
_BLANKS = {"\u2800": " ", "\u3164": " ", "\uffa0": " ", "\u1680": "\u1680"}
_ENDS = {"\u2028": "\n", "\u2029": "\n", "\x85": "\n", "\r": "\n"}
_ALSO_GONE = "\u034f\u115f\u1160\u17b4\u17b5"
_JOINERS = "\u200c\u200d"
_SELECTORS = tuple(map(chr, (*range(0x180B, 0x180E), 0x180F, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))))
_TAGS = tuple(map(chr, range(0xE0020, 0xE0080)))
#: Ideographs, syllables of Hangul and private use have nothing to map and are left out.
_POINTS = (*range(0x80, 0x3400), *range(0x4DC0, 0x4E00), *range(0xA000, 0xAC00), *range(0xD7A4, 0xD800), *range(0xF900, 0x20000), *range(0xE0000, 0xE0200))


def _ordinary(c: str) -> str:
    """The ordinary characters of a width, ligature or positional form; itself if it is none."""
    point = ord(c)
    parts = unicodedata.decomposition(c).split()
    if not parts or not any(a <= point <= b for a, b in _WIDTH_BLOCKS):
        return c
    letters = [chr(int(x, 16)) for x in parts if x[0] != "<"]
    # Ligatures of whole words don't look like their letters; of two letters they do.
    return "".join(letters) if point < 0xFB50 or point >= 0xFF00 or (len(letters) <= 2 and " " not in letters) else c


def _compose_look(text: str) -> str:
    """Decomposed, look-alikes replaced, composed again: by rule at compile time, never for texts."""
    parts = list(unicodedata.normalize("NFD", text))
    for i, c in enumerate(parts):
        # The tonos of a Greek capital stands before it, so that it resembles no Latin letter.
        accented = i + 1 < len(parts) and unicodedata.combining(parts[i + 1])
        if c in LOOK_ALIKES and not (accented and "\u0370" <= c <= "\u03ff" and c.isupper()):
            parts[i] = LOOK_ALIKES[c]
    return unicodedata.normalize("NFC", "".join(parts))


def _compile() -> dict[str, str]:
    """The form of each cluster of one character that isn't its own form."""
    table: dict[str, str] = {**_BLANKS, **_VOICING, **_ENDS}
    for point in _POINTS:
        c = chr(point)
        if c in table:
            continue
        kind = unicodedata.category(c)
        if (kind == "Cf" and not any(a <= point <= b for a, b in _SHOWN)) or c in _ALSO_GONE or c in _SELECTORS:
            table[c] = ""
        elif kind == "Zs":
            table[c] = " "
        elif kind[0] != "M" and not 0xAC00 <= point <= 0xD7A3:
            table[c] = _compose_look("".join(map(_ordinary, _ordinary(c))))
    return {c: out for c, out in table.items() if c != out}


SINGLE = _compile()
_MARKS = tuple(chr(p) for p in _POINTS if unicodedata.category(chr(p))[0] == "M" and chr(p) not in SINGLE) + tuple(_VOICING)
#: Canonical decompositions and the transitions that undo them: (letter so far, mark) -> letter.
_PARTS = {chr(p): unicodedata.normalize("NFD", chr(p)) for p in _POINTS if not 0xAC00 <= p <= 0xD7A3 and unicodedata.normalize("NFD", chr(p)) != chr(p)}
ARCS: dict[tuple[str, str], str] = {}
for _c in _PARTS:
    _two = [chr(int(x, 16)) for x in unicodedata.decomposition(_c).split()]
    if len(_two) == 2 and unicodedata.normalize("NFC", _c) == _c:
        ARCS[_two[0], _two[1]] = _c


def _giving(first: int, last: int) -> str:
    return "".join(map(chr, range(first, last + 1)))


#: Conjoining jamo: leading consonants, vowels, trailing consonants.
_LEADING, _VOWEL, _TRAILING = _giving(0x1100, 0x1112), _giving(0x1161, 0x1175), _giving(0x11A8, 0x11C2)
for _i, _l in enumerate(_LEADING):
    for _j, _v in enumerate(_VOWEL):
        ARCS[_l, _v] = _syllable = chr(0xAC00 + (_i * 21 + _j) * 28)
        for _k, _t in enumerate(_TRAILING, start=1):
            ARCS[_syllable, _t] = chr(ord(_syllable) + _k)

#: Letters of Arabic that join the next or the one before, from the forms they have.
_POSITIONS: dict[str, set[str]] = {"initial": set(), "final": set()}
for _p in (*range(0xFB50, 0xFE00), *range(0xFE70, 0xFEFD)):
    _d = unicodedata.decomposition(chr(_p)).split()
    if len(_d) == 2 and _d[0].strip("<>") in _POSITIONS:
        _POSITIONS[_d[0].strip("<>")].add(chr(int(_d[1], 16)))


def _joins(c: str, side: str) -> bool:
    """Whether a letter joins the next one (``initial``) or the one before (``final``)."""
    if c in _POSITIONS[side] or c == "\u0640":
        return True
    # Letters of other joining scripts, and those without listed forms, may join.
    return c not in _POSITIONS["final"] and unicodedata.category(c) == "Lo" and c != "\u0621" and (0x66E <= ord(c) <= 0x8C9 or 0x1820 <= ord(c) <= 0x18AA)


def _pictured(c: str) -> bool:
    return unicodedata.category(c) in ("So", "Sk") and (0x2190 <= ord(c) <= 0x3299 or ord(c) >= 0x1F000)


def _joiner_shows(joiner: str, base: str, marks: list[str], after: str) -> bool:
    if any(unicodedata.combining(m) == 9 for m in marks) or (after and unicodedata.combining(after) == 9):
        return True
    left, right = bool(base) and _joins(base, "initial"), bool(after) and _joins(after, "final")
    if joiner == "\u200c":
        return left and right
    return left != right or (bool(base) and bool(after) and _pictured(base) and _pictured(after))


def _selector_shows(selector: str, base: str, ext: str) -> bool:
    if selector in "\ufe0e\ufe0f":
        return _pictured(base) or "\u20e3" in ext or base in "©®™‼⁉ℹ"
    if "\u180b" <= selector <= "\u180f":
        return 0x1820 <= ord(base) <= 0x18AA
    return unicodedata.category(base)[0] == "S" or unicodedata.category(base) == "Lo"


def _automaton(base: str, marks: list[str]) -> str:
    """Base and marks by transitions: the longest composed letter that they lead to, then the rest."""
    letters = [p for c in (*base, *marks) for p in _PARTS.get(c, c)]
    out, at = [], 0
    while at < len(letters):
        state = "" if unicodedata.combining(letters[at]) else letters[at]
        at += bool(state)
        run = []
        while at < len(letters) and (unicodedata.combining(letters[at]) or (not run and (state, letters[at]) in ARCS)):
            if not unicodedata.combining(letters[at]):
                state = ARCS[state, letters[at]]
            else:
                run.append(letters[at])
            at += 1
        rest: list[str] = []
        for m in sorted(run, key=unicodedata.combining):
            free = not rest or unicodedata.combining(rest[-1]) < unicodedata.combining(m)
            if free and (state, m) in ARCS:
                state = ARCS[state, m]
            else:
                rest.append(m)
        out += [state, *rest]
    return "".join(out)


def _sequences() -> dict[str, str]:
    """Whole clusters: decomposed letters, half-width kana with a voicing sign, syllables, line ends."""
    out = {"\r\n": "\n"}
    for c, parts in _PARTS.items():
        if len(parts) > 1 and unicodedata.normalize("NFC", c) == c and unicodedata.combining(parts[1]):
            out[parts] = _automaton(SINGLE.get(parts[0], parts[0]), list(parts[1:]))
    for kana in map(chr, range(0xFF66, 0xFF9E)):
        for sign, mark in _VOICING.items():
            if (SINGLE[kana], mark) in ARCS:
                out[kana + sign] = ARCS[SINGLE[kana], mark]
    for first in _LEADING:
        for vowel in _VOWEL:
            out[first + vowel] = pair = ARCS[first, vowel]
            for last in _TRAILING:
                out[first + vowel + last] = out[pair + last] = ARCS[pair, last]
    return out


CLUSTERS = _sequences()
TABLE = SINGLE | CLUSTERS


def _script(c: str) -> str:
    return unicodedata.name(c, " ").split()[0]


def _sort(c: str) -> str:
    """What sort of sign a reader sees."""
    kind = unicodedata.category(c)
    return "blank" if kind[0] == "Z" or c in "\n\r\x85" or c in _BLANKS else "letter" if kind[0] == "L" or unicodedata.name(c, "").startswith(("KANGXI", "CJK RADICAL")) else kind[0]


def conflicts(table: dict[str, str]) -> list[str]:
    """Why a table can't be used: forms that change again, or signs told apart that meet in one form."""
    wrong = []
    met: dict[tuple[str, str], str] = {}
    for c, out in table.items():
        again = "".join(table.get(x, x) for x in out)
        if again != out:
            wrong.append(f"{c!r} -> {out!r} isn't fixed")
        if len(c) == 1:
            other = c.swapcase()
            if other != c and len(other) == 1 and table.get(other, other) == out and out.strip():
                wrong.append(f"{c!r} and {other!r} both give {out!r}")
        first = "".join(map(_ordinary, _ordinary(c))) if len(c) == 1 else c
        if not out:
            if unicodedata.category(c[0]) != "Cf" and c not in _ALSO_GONE and c not in _SELECTORS:
                wrong.append(f"{c!r} is dropped")
            continue
        if _sort(first[0]) != _sort(out[0]) and c not in LOOK_ALIKES:
            wrong.append(f"{c!r} and {out!r} are of different sorts")
        bare, shown = unicodedata.normalize("NFD", first), unicodedata.normalize("NFD", out)
        accents = lambda s: [x for x in s if unicodedata.combining(x)]
        if len(c) == 1 and c not in _VOICING and accents(bare) != accents(shown):
            wrong.append(f"{c!r} and {out!r} differ in accents")
        if len(c) == 1 and bare == c and unicodedata.category(c)[0] == "L":
            # Of one script, two letters never share a form.
            if met.setdefault((_script(c), out), c) != c:
                wrong.append(f"{c!r} and {met[_script(c), out]!r} both give {out!r}")
    return wrong


if _wrong := conflicts(TABLE):
    raise ValueError(f"conflicting canonical forms: {_wrong[:5]}")


def _class(chars) -> str:
    """Characters as ranges of a character class."""
    points = sorted(map(ord, chars))
    ranges, start = [], points[0]
    for a, b in zip(points, points[1:] + [0]):
        if b != a + 1:
            ranges.append(f"\\U{start:08x}-\\U{a:08x}")
            start = b
    return "".join(ranges)


#: Characters that are dropped wherever they stand, also between a base and its marks.
_GONE = frozenset(c for c, out in SINGLE.items() if not out and c not in _JOINERS and c not in _SELECTORS and c not in _TAGS)
_BINDING = frozenset((*_MARKS, *_JOINERS, *_SELECTORS, *_TAGS))
#: A cluster of more than one character, the longest that there is at its place.
_CLUSTER = re.compile(
    "(?:(?:[{l}][{n}]*[{v}]|[가-힣])[{n}]*[{t}]|[{l}][{n}]*[{v}])[{b}{g}]*|\r\n|(?s:.)[{g}]*[{b}][{b}{g}]*".format(
        l=_LEADING, v=_VOWEL, t=_TRAILING, g=_class(_GONE), b=_class(_BINDING), n=_class(_GONE | _BINDING - frozenset(_MARKS))
    )
)
#: What a text must hold to have such a cluster.
_MANY = frozenset((*_BINDING, "\r", *_VOWEL, *_TRAILING))
_MAP = str.maketrans(SINGLE)


@lru_cache(maxsize=65_536)
def _cluster(cluster: str, after: str) -> str:
    """The form of a cluster; ``after`` is the character that follows it, which joiners look at."""
    kept = "".join(c for c in cluster if c not in _GONE)
    whole = CLUSTERS.get(kept)
    if whole is not None:
        return whole
    base = SINGLE.get(kept[:1], kept[:1])
    if kept[:1] in _BINDING:
        base, kept = "", "\0" + kept
    ext = kept[1:]
    marks, shown = [], []
    joiner = ""
    for c in ext:
        if c in _JOINERS:
            if not joiner and _joiner_shows(c, base[-1:], marks, SINGLE.get(after, after)[:1]):
                joiner = c
        elif c in _TAGS:
            if base == "\U0001f3f4":
                shown.append(c)
        elif c in _SELECTORS:
            if base and not shown and _selector_shows(c, base[-1], ext):
                shown.append(c)
        else:
            marks.append(SINGLE.get(c, c))
    if base:
        head = _automaton(base, marks)
        return (head[:1] + shown[0] + head[1:] if shown and shown[0] in _SELECTORS else head + "".join(shown)) + joiner
    return _automaton("", marks) + joiner


def canonical_form(text: str) -> str:
    """The one consistent form of a text, written in one pass over its clusters."""
    if text.isascii() and "\r" not in text:
        return text
    if _MANY.isdisjoint(text):
        return text.translate(_MAP)
    out, at = [], 0
    for m in _CLUSTER.finditer(text):
        a, b = m.span()
        out.append(text[at:a].translate(_MAP))
        out.append(_cluster(m.group(), text[b : b + 1]))
        at = b
    out.append(text[at:].translate(_MAP))
    return "".join(out)


#: Characters that may stand inside a word without being word characters: dropped ones and marks.
#: Of the basic plane only, for which the engine has a table.
_INNER = re.compile("[" + _class(c for c in (*_GONE, *_BINDING, *_VOWEL, *_TRAILING) if ord(c) < 0x10000) + "]")


def word_ready(text: str) -> str:
    """The text with canonical clusters where a word could be broken by its characters.

    What is left to do can be done word by word, with :func:`canonical_form` of each distinct word.
    """
    if text.isascii() or not _INNER.search(text):
        return text
    return canonical_form(text)


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.schema.get_field_index("text")).to_pylist()
        forms = pa.array([None if t is None else canonical_form(t) for t in texts], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), forms], ["doc_id", "text", "form"])


def canonical_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, form: every document's text and its consistent form."""
    return docs.select("doc_id", "text").mapInArrow(_forms, "doc_id bigint, text string, form string")


def membership(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id, class_id, digest: documents of equal form share a class; digest tells raw texts apart."""
    forms = canonical_documents(docs).where(F.trim(F.regexp_replace("text", r"[\s\p{Z}\p{C}]+", "")) != "")
    forms = forms.select("doc_id", "form", F.sha2("text", 256).alias("digest"))
    labelled = classes(forms, [], "doc_id", "form", carry=["digest"], **limits).select("doc_id", "class_id", "digest").distinct()
    return materialize(labelled, "looks")  # both sides of the pairs read it


def same_look(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id_a, doc_id_b: documents that look the same and differ in their characters."""
    return pairs(membership(docs, **limits), [], "doc_id", differ="digest").select(
        F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b")
    )
