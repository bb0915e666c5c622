"""Text functions as Spark columns; all run in the JVM and none calls Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern of the estimate, equal in Python, Java and RE2.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}]"

#: White space of any kind, the same in Java and RE2.
SPACES = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"

# Reasoning markers in the order in which they are scrubbed.
MARKERS = {
    "think_open": r"<\s*think\s*>",
    "think_close": r"<\s*/\s*think\s*>",
    "analysis_open": r"<\s*analysis\s*>",
    "analysis_close": r"<\s*/\s*analysis\s*>",
    "chain_of_thought": r"chain[- ]of[- ]thought\s*:?\s*",
    "lets_think": r"let['’]?s think step by step",
    "reasoning_trace": r"reasoning(?:\s+trace|_content)?\s*:?\s*",
    "scratchpad": r"scratchpad\s*:?\s*",
}
#: Whole blocks that go with their content.
MARKER_BLOCKS = (r"<\s*think\s*>.*?<\s*/\s*think\s*>", r"<\s*analysis\s*>.*?<\s*/\s*analysis\s*>")

# Phrases of the quality rules.
FORBIDDEN_PHRASES = (
    "internal thoughts", "i think step by step", "<think>", "let me check the web", "i have live access", "as your browser",
    "i can see your camera feed",
)


def token_estimate(text: Column) -> Column:
    """Words and single signs of a text; 0 for null and blank."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_PATTERN)), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """White space of any kind collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def marker_counts(text: Column) -> dict[str, Column]:
    return {name: F.regexp_count(text, F.lit("(?i)" + pattern)) for name, pattern in MARKERS.items()}


def marker_total(text: Column) -> Column:
    """Matches of all markers, each pattern counted on its own; 0 for null.

    The text is bound once, so that an expression isn't evaluated for each pattern, and the
    patterns are counted only where any of them is found.
    """
    anything = "(?i)" + "|".join(MARKERS.values())

    def total(t: Column) -> Column:
        out = F.lit(0)
        for count in marker_counts(t).values():
            out = out + count
        return F.when(t.rlike(anything), out).otherwise(F.lit(0))

    return F.element_at(F.transform(F.array(text), total), 1)


def marker_names(text: Column) -> Column:
    """The markers a text holds, in order of their names."""
    hits = [F.when(text.rlike("(?i)" + MARKERS[name]), F.lit(name)) for name in sorted(MARKERS)]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def scrub_markers(text: Column) -> Column:
    """Without reasoning blocks and markers."""
    for block in MARKER_BLOCKS:
        text = F.regexp_replace(text, "(?is)" + block, " ")
    for pattern in MARKERS.values():
        text = F.regexp_replace(text, "(?i)" + pattern, " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def scrubbed(text: Column) -> Column:
    """The text without reasoning blocks and markers, and how many of them went: text, removed."""
    removed = F.lit(0)
    current = text
    for pattern in [*(f"(?is){b}" for b in MARKER_BLOCKS), *(f"(?i){p}" for p in MARKERS.values())]:
        removed = removed + F.regexp_count(current, F.lit(pattern))
        current = F.regexp_replace(current, pattern, " ")
    return F.struct(F.trim(F.regexp_replace(current, r"\s+", " ")).alias("text"), removed.alias("removed"))


def dedupe_form(text: Column) -> Column:
    """The form in which exact duplicates are compared."""
    lowered = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.regexp_replace(F.regexp_replace(lowered, r"\s+", " "), r"[^a-zA-Z0-9؀-ۿЀ-ӿ一-鿿 ]+", " ")


def signature(prompt: Column, answer: Column) -> Column:
    """Hash of a pair of texts in their dedupe form."""
    return F.sha2(F.concat(dedupe_form(F.coalesce(prompt, F.lit(""))), F.lit("\n"), dedupe_form(F.coalesce(answer, F.lit("")))), 256)


def length_check(text: Column) -> Column:
    """The greater of the number of words and of Han characters; 0 for blank."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    words = F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"\s+")))
    return F.coalesce(F.greatest(words, F.regexp_count(bare, F.lit("[一-鿿]"))), F.lit(0))


def slug(text: Column, default: str = "main", keep_case: bool = False) -> Column:
    allowed = "[^A-Za-z0-9._-]+" if keep_case else "[^a-z0-9._-]+"
    cut = F.regexp_replace(F.regexp_replace(text if keep_case else F.lower(text), allowed, "-"), "^-+|-+$", "")
    return F.when(cut.isNull() | (cut == ""), F.lit(default)).otherwise(cut)


def word_set(text: Column) -> Column:
    """Distinct words in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of the word sets: 1 if both are empty, 0 if one is."""
    x, y = word_set(a), word_set(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def garbled(text: Column) -> Column:
    """Blank, with a replacement character, or with more than 2 % control characters."""
    control = F.regexp_count(text, F.lit(r"[\x00-\x08\x0e-\x1f]")) / F.greatest(F.length(text), F.lit(1))
    return text.isNull() | (F.trim(F.regexp_replace(text, r"\s+", " ")) == "") | F.contains(text, F.lit("�")) | (control > 0.02)


def script_score(text: Column, language: Column) -> Column:
    """10, or 6 where a language with a script of its own shows none of it."""
    own = {"ru": "[Ѐ-ӿ]", "ar": "[؀-ۿ]", "zh": "[一-鿿]"}
    score = F.lit(10.0)
    for lang, pattern in own.items():
        score = F.when((language == lang) & ~text.rlike(pattern), F.lit(6.0)).otherwise(score)
    return score


def hash_index(key: Column, size: int, shift: int = 1) -> Column:
    """A fixed pseudo-random index below ``size``: the first 8 hex digits of the MD5, modulo."""
    return F.conv(F.substring(F.md5(key), shift, 8), 16, 10).cast("bigint") % size


def hash_unit(key: Column | str, seed: int = 0) -> Column:
    """A fixed pseudo-random number in [0, 1) from a value's text and a seed."""
    column = F.col(key) if isinstance(key, str) else key
    return hash_index(F.concat(column.cast("string"), F.lit(f"/{seed}")), 1 << 32) / float(1 << 32)
