"""Cleaning, folding, stop words and sentences as Spark columns.

Patterns carry the flags that make Java regexes follow Unicode rules: ``U`` for classes and word
boundaries, ``iu`` for case-insensitive accented text.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusmill.constants import DROPPED_SECTIONS, SEE_ALSO, STOP_WORD_LISTS
from corpusmill.functions.common import by_key, in_slices, let

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_TAG = r"""</?[A-Za-z](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|</?[A-Za-z][^>]*>|<[!?][^>]*>"""
_SUP = r"(?is)<sup\b[^>]*>.*?</sup\s*>"
_PIPED_LINK = r"\[\[([^|\]]+)\|([^\]]+)\]\]"
_PLAIN_LINK = r"\[\[([^|\]]+)\]\]"
_CITATION = r"(?U)\[\d+\]"
# White space as Unicode text counts it.
_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = f"[ {_SPACE}]+"
_UNEVEN_SPACES = f"[{_SPACE}][ {_SPACE}]*| [ {_SPACE}]+"


@F.arrow_udf(StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return in_slices(lambda part: [None if t is None else html.unescape(t) for t in part], pa.string(), texts)


def _normal(text: str) -> str:
    text = html.unescape(text)
    if "[[" in text:
        text = re.sub(_PLAIN_LINK, r"\1", re.sub(_PIPED_LINK, r"\2", text))
    return unicodedata.normalize("NFKC", text)


@F.arrow_udf(StringType())
def _unescape_link_nfkc(texts: pa.Array) -> pa.Array:
    return in_slices(lambda part: [None if t is None else _normal(t) for t in part], pa.string(), texts)


# The optimizer copies a deterministic column into filters on it, which would run the whole chain twice.
_unescape = _unescape.asNondeterministic()
_unescape_link_nfkc = _unescape_link_nfkc.asNondeterministic()


def replace_where(text: Column, needle: str, *patterns: tuple[str, str]) -> Column:
    """Regex replacements, skipped for texts without ``needle``: a byte search is much cheaper than a regex pass."""

    def apply(t: Column) -> Column:
        out = t
        for pattern, replacement in patterns:
            out = F.regexp_replace(out, pattern, replacement)
        return F.when(F.contains(t, F.lit(needle)), out).otherwise(t)

    return let(text, apply)


def collapse_spaces(text: Column) -> Column:
    # Single plain spaces, by far the most frequent, are not touched.
    return F.trim(F.regexp_replace(text, _UNEVEN_SPACES, " "))


def strip_markup(text: Column) -> Column:
    """Drop comments, script/style bodies and tags; character references stay as they are."""
    return replace_where(text, "<", (_HIDDEN, ""), (_TAG, ""))


def unescape(text: Column) -> Column:
    """Decode character references. SQL has no function for it, so texts pass through one Arrow batch."""
    return _unescape(text)


def clean_text(text: Column) -> Column:
    """Plain text of a page: no superscripts, tags, link syntax or ``[n]`` marks, NFKC, single spaces.

    Each step uses its input once, so nested calls do not multiply.
    """
    bare = replace_where(text, "<", (_SUP, ""), (_HIDDEN, ""), (_TAG, ""))
    return collapse_spaces(replace_where(_unescape_link_nfkc(bare), "[", (_CITATION, "")))


def clean_wiki_text(text: Column) -> Column:
    """Resolve links, drop ``{{…}}`` templates (not nested) and tags, single spaces."""
    text = replace_where(text, "[[", (r"\[\[([^|\]]*\|)?([^\]]+)\]\]", "$2"))
    text = replace_where(text, "{{", (r"(?s)\{\{.*?\}\}", ""))
    return collapse_spaces(unescape(strip_markup(text)))


def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    """Accent folds by rule: the first character of the canonical decomposition, where that is ASCII."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            source.append(chr(code))
            target.append(base)
    # Letters and marks without a decomposition.
    single = {
        "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ı": "i",
        "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "•": "*", " ": " ", "¡": "!", "¿": "?", "×": "x",
    }
    several = [
        ("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("þ", "th"), ("Þ", "Th"),
        ("—", "--"), ("…", "..."), ("«", "<<"), ("»", ">>"), ("°", "deg"), ("€", "EUR"),
    ]
    return "".join([*source, *single]), "".join([*target, *single.values()]), several


_FOLD_FROM, _FOLD_TO, _FOLD_MANY = _fold_tables()
_FOLD_MANY_PATTERN = "[" + "".join(a for a, _ in _FOLD_MANY) + "]"


def fold_accents(text: Column) -> Column:
    """Latin text to ASCII; other scripts stay as they are."""

    def several(t: Column) -> Column:
        out = t
        for a, b in _FOLD_MANY:
            out = F.replace(out, F.lit(a), F.lit(b))
        return F.when(t.rlike(_FOLD_MANY_PATTERN), out).otherwise(t)

    def fold(t: Column) -> Column:
        ascii_only = F.octet_length(t) == F.length(t)
        return F.when(ascii_only, t).otherwise(let(F.translate(t, _FOLD_FROM, _FOLD_TO), several))

    return let(text, fold)


def fold_text(text: str) -> str:
    """The same fold for literals on the driver."""
    for a, b in _FOLD_MANY:
        text = text.replace(a, b)
    return text.translate(str.maketrans(_FOLD_FROM, _FOLD_TO))


def default_stop_words(spark: SparkSession) -> dict[str, list[str]]:
    """Spark ML's stop word lists by language code."""
    from pyspark.ml.feature import StopWordsRemover

    return {lang: list(StopWordsRemover.loadDefaultStopWords(name)) for lang, name in STOP_WORD_LISTS.items()}


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACES), lambda w: w != "")


def is_stop_word(word: Column, lang: Column, stop_words: dict[str, Iterable[str]]) -> Column:
    cases = {code: word.isin(list(entries)) for code, entries in stop_words.items()}
    return by_key(lang, cases, F.lit(False))


def remove_stop_words(text: Column, lang: Column, stop_words: dict[str, Iterable[str]]) -> Column:
    kept = F.filter(words(text), lambda w: ~is_stop_word(F.lower(w), lang, stop_words))
    return F.array_join(kept, " ")


def split_sentences(text: Column) -> Column:
    """Non-empty trimmed parts between runs of ``.``, ``!`` and ``?``."""
    parts = F.transform(F.split(text, r"[.!?]+"), lambda s: F.regexp_replace(s, f"^{_SPACES}|{_SPACES}$", ""))
    return F.filter(parts, lambda s: s != "")


def _cut_sections(text: Column) -> Column:
    """Cut from each dropped heading to the end, heading by heading.

    One pass over all headings gives the same text unless two headings share a ``==`` mark.
    """
    names = "|".join(DROPPED_SECTIONS)
    in_turn = text
    for name in DROPPED_SECTIONS:
        in_turn = F.regexp_replace(in_turn, rf"(?iuUs)==\s*{name}\s*==.*", "")
    return (
        F.when(~F.contains(text, F.lit("==")), text)
        .when(text.rlike(rf"(?iuU)==\s*({names})\s*==\s*({names})\s*=="), in_turn)
        .otherwise(F.regexp_replace(text, rf"(?iuUs)==\s*({names})\s*==.*", ""))
    )


def advanced_clean_text(
    text: Column,
    lang: Column,
    stop_words: dict[str, Iterable[str]] | None = None,
    split: bool = False,
) -> Column:
    """Record text: wiki cleaning, accent fold for en/de, no citations, "see also" tail, tables or link sections.

    With ``stop_words`` (language code to list) those words are dropped as well. ``split`` gives the list of sentences.
    """
    text = clean_wiki_text(text)
    text = let(text, lambda t: F.when(lang.isin("en", "de"), fold_accents(t)).otherwise(t))
    text = replace_where(text, "[", (_CITATION, ""))
    text = F.regexp_replace(text, r"(?iuU)\b(" + "|".join(SEE_ALSO) + r")\b.*", "")
    text = replace_where(text, "{|", (r"(?s)\{\|.*?\|\}", ""))
    text = let(text, _cut_sections)
    if stop_words is not None:
        text = remove_stop_words(text, lang, stop_words)
    return split_sentences(text) if split else F.trim(text)
