"""Questions, answers and their pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import (
    DEFINITION_QUESTION,
    ENTITY_QUESTION,
    ENTITY_QUESTION_TYPES,
    KEYWORD_QUESTIONS,
    QUESTION_PHRASES,
)
from corpusmill.functions.common import by_key


def translate_question(question: Column, lang: Column) -> Column:
    """Replace the known phrases one after the other; other languages keep the text."""
    cases = {}
    for code, phrases in QUESTION_PHRASES.items():
        out = question
        for source, target in phrases:
            out = F.replace(out, F.lit(source), F.lit(target))
        cases[code] = out
    return by_key(lang, cases, question)


def _fill(template: str, **values: Column) -> Column:
    """Concatenate a ``{name}`` template."""
    parts, rest = [], template
    while "{" in rest:
        head, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        parts += [F.lit(head), values[name]]
    return F.concat(*parts, F.lit(rest))


def _question(spec: tuple[str, str, str], lang: Column, **values: Column) -> Column:
    kind, difficulty, template = spec
    return F.struct(
        translate_question(_fill(template, **values), lang).alias("text"),
        F.lit(kind).alias("type"),
        F.lit(difficulty).alias("difficulty"),
    )


def _first(items: Column, bound: int | None) -> Column:
    return items if bound is None else F.slice(items, 1, bound)


def generate_questions(
    title: Column, lang: Column, keywords: Column, entities: Column | None = None,
    max_keywords: int | None = None, max_entities: int | None = None,
) -> Column:
    """One definition question, three per keyword, one per suitable entity; bounds take the first keywords and entities only."""
    parts = [
        F.array(_question(DEFINITION_QUESTION, lang, title=title)),
        F.flatten(
            F.transform(
                _first(keywords, max_keywords),
                lambda k: F.array(*[_question(spec, lang, keyword=k, title=title) for spec in KEYWORD_QUESTIONS]),
            )
        ),
    ]
    if entities is not None:
        suitable = F.filter(
            _first(entities, max_entities), lambda e: e["type"].isin(ENTITY_QUESTION_TYPES)
        )
        parts.append(F.transform(suitable, lambda e: _question(ENTITY_QUESTION, lang, entity=e["text"], title=title)))
    return F.concat(*parts)


def _answer(text: Column, kind: str, length: str) -> Column:
    return F.struct(text.alias("text"), F.lit(kind).alias("type"), F.lit(length).alias("length"))


def generate_answers(
    content: Column, summary: Column, max_length: int | None = None, max_paragraphs: int | None = None
) -> Column:
    """Summary, full text, then the non-blank lines; bounds take the first characters and lines only."""
    lines = F.filter(F.split(content, "\n"), lambda p: F.regexp_replace(p, r"(?U)\s+", "") != "")
    return F.concat(
        F.array(
            _answer(summary, "summary", "short"),
            _answer(content if max_length is None else F.substring(content, 1, max_length), "detailed", "long"),
        ),
        F.transform(_first(lines, max_paragraphs), lambda p: _answer(p, "paragraph", "medium")),
    )


def zip_shorter(left: Column, right: Column, left_name: str, right_name: str) -> Column:
    """Positional pairs up to the length of the shorter list."""
    left, right = F.coalesce(left, F.slice(left, 1, 0)), F.coalesce(right, F.slice(right, 1, 0))
    size = F.greatest(F.least(F.size(left), F.size(right)), F.lit(0))
    return F.transform(
        F.arrays_zip(F.slice(left, 1, size).alias("l"), F.slice(right, 1, size).alias("r")),
        lambda p: F.struct(p["l"].alias(left_name), p["r"].alias(right_name)),
    )
