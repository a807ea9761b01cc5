"""Cleaning and repair of passage and answer text as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from qaspark.functions.bind import let

# --- fixed values: what the cleaning rules look for -----------------------------------------
BLOCK_TAGS = ["title", "table", "td", "li", "ol"]
UI_WORDS = ["[원본 편집]", "[편집]", "\\'", "펼치기", "버튼 클릭"]
TRAILING_SECTIONS = [
    "같이 보기",
    "참고 자료",
    "외부 링크",
    "원본 주소",
    "각주",
    "참고 문헌",
    "함께 보기",
    "관련 서적",
    "관련 항목",
]
ENTITIES = ["&nbsp;", "&lt;", "&gt;", "&quot;"]
BLANKS = "\\t\\r\\n\\u00a0\\u200b"
# --------------------------------------------------------------------------------------------


# fixed values: the characters that count as blank at the ends of a text
_UNICODE_BLANK = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"


def _strip_markup(text: Column, ui_words: Sequence[str], entities: Sequence[str]) -> Column:
    for tag in BLOCK_TAGS:
        text = F.regexp_replace(text, f"(?is)<{tag}.*?>.*?</{tag}>", "")
    text = F.regexp_replace(text, "(?is)<.+?>", "")
    text = F.regexp_replace(text, "\\[[0-9]+\\]", " ")
    for word in ui_words:
        text = F.replace(text, F.lit(word), F.lit(""))
    for heading in TRAILING_SECTIONS:
        text = F.substring_index(text, heading, 1)
    return F.regexp_replace(text, f"(?:{'|'.join(entities)}|[ {BLANKS}])+", " ")


def cut_to_last_stop(text: Column, legacy: bool = False) -> Column:
    """Keep up to and including the last full stop; text without one stays as it is.

    ``legacy`` empties a text that already ends with its full stop.
    """

    def cut(body: Column) -> Column:
        tail = F.length(F.substring_index(body, ".", -1))
        kept = F.left(body, F.length(body) - tail)
        if legacy:
            kept = F.when(tail == 0, F.lit("")).otherwise(kept)
        return F.when(F.instr(body, ".") == 0, body).otherwise(kept)

    return let(text, cut)


def drop_byline(text: Column) -> Column:
    """Drop the sentence that holds the last ``@``, and everything after it."""

    def before_mark(body: Column) -> Column:
        return F.left(body, F.length(body) - F.length(F.substring_index(body, "@", -1)) - 1)

    def whole_sentences(before: Column) -> Column:
        last = F.length(F.substring_index(before, ".", -1))
        return F.when(F.instr(before, ".") == 0, F.lit(".")).otherwise(
            F.left(before, F.length(before) - last)
        )

    return let(
        text,
        lambda body: F.when(F.instr(body, "@") == 0, body).otherwise(
            let(before_mark(body), whole_sentences)
        ),
    )


def clean_answer(text: Column) -> Column:
    """Strip markup, marks, interface words and trailing sections; collapse blanks."""
    return _strip_markup(text, UI_WORDS, ENTITIES)


def clean_context(text: Column, variant: str = "wiki", legacy: bool = False) -> Column:
    """``clean_answer`` plus the cut at the last full stop, trimmed.

    Variants: ``wiki``; ``byline`` also drops mail by-lines; ``plain`` knows fewer marks.
    """
    if variant == "plain":
        body = _strip_markup(text, UI_WORDS[1:], ENTITIES[:1])
    elif variant in ("wiki", "byline"):
        body = clean_answer(text)
    else:
        raise ValueError(f"unknown cleaning variant: {variant}")
    if variant == "byline":
        body = drop_byline(body)
    return strip(cut_to_last_stop(body, legacy))


def strip(text: Column, side: str = "both") -> Column:
    """Remove all Unicode blanks at the ends, not only spaces."""
    bare = F.regexp_replace(text, f"^{_UNICODE_BLANK}+", "")
    return bare if side == "left" else F.regexp_replace(bare, f"{_UNICODE_BLANK}+$", "")


def rebased_start(context: Column, start: Column) -> Column:
    """Answer offset in the cleaned context: length of the cleaned text that stood before it."""
    return F.length(strip(clean_answer(F.substring(context, F.lit(1), start)), "left"))


def balance_brackets(text: Column) -> Column:
    """Add the one missing round or angle bracket; the first kind that is unbalanced wins."""

    def has(mark: str) -> Column:
        return F.contains(text, F.lit(mark))

    return (
        F.when(has("(") & ~has(")"), F.concat(text, F.lit(")")))
        .when(has(")") & ~has("("), F.concat(F.lit("("), text))
        .when(has("<") & ~has(">"), F.concat(text, F.lit(">")))
        .when(has(">") & ~has("<"), F.concat(F.lit("<"), text))
        .otherwise(text)
    )


def strip_particle(text: Column, particles: Sequence[str], charset: bool = False) -> Column:
    """Remove the longest particle the text ends with.

    ``charset`` removes every trailing character that occurs in that particle instead.
    """
    result = None
    for particle in sorted(particles, key=lambda p: (-len(p), p)):
        ends = F.endswith(text, F.lit(particle)) & (F.length(text) > len(particle))
        if charset:
            short = F.regexp_replace(text, "[" + "".join(map(_escaped, particle)) + "]+$", "")
        else:
            short = F.left(text, F.length(text) - len(particle))
        result = F.when(ends, short) if result is None else result.when(ends, short)
    return text if result is None else result.otherwise(text)


def _escaped(char: str) -> str:
    return "\\" + char if char in "\\]^-[&" else char


def title_tag(title: Column, text: Column) -> Column:
    return F.concat(F.lit("@"), title, F.lit(":"), text)


def parse_doc_id(identifier: Column) -> Column:
    """Number in ``name_12-3`` style ids, with the dash dropped: 123."""
    return F.replace(F.split_part(identifier, F.lit("_"), F.lit(2)), F.lit("-"), F.lit("")).cast("long")
