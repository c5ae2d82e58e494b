"""Parsers of printed positions, numbers and levels as column expressions. A text that does not match gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUM = r"([0-9]+(?:\.[0-9]+)?)"


def group(text: Column, pattern: str, k: int = 1) -> Column:
    """A group of the first match; null where the pattern is not found or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def number(text: Column) -> Column:
    return text.try_cast("double")


def km_to_m(text: Column) -> Column:
    """'1240+535.8' at the start of a text to 1240535.8."""
    km, m = group(text, r"^\s*([0-9]+)\+[0-9]"), group(text, r"^\s*[0-9]+\+" + _NUM)
    return number(km) * 1000 + number(m)


def free_position(text: Column) -> Column:
    """dddd+ddd, else CH ddddddd, else a bare number of 7 digits, else km dddd."""
    a = number(group(text, r"([0-9]{1,4})\+[0-9]{1,3}")) * 1000 + number(group(text, r"[0-9]{1,4}\+([0-9]{1,3}(?:\.[0-9]+)?)"))
    b = number(group(text, r"(?i)\bCH\.?\s*([0-9]{5,8}(?:\.[0-9]+)?)"))
    c = number(group(text, r"(?<![0-9])([0-9]{7}(?:\.[0-9]+)?)(?![0-9])"))
    return F.coalesce(a, b, c, number(group(text, r"(?i)\bkm\s*([0-9]{1,4})(?![0-9])")) * 1000)


def m_to_km(pos: Column) -> Column:
    """1240535.82 to '1240+535.820'."""
    mm = F.round(pos * 1000).cast("long")
    km = F.floor(mm / 1_000_000)
    return F.format_string("%d+%07.3f", km, (mm - km * 1_000_000) / 1000)


def plain(x: Column) -> Column:
    """Three decimals without trailing zeros."""
    return F.regexp_replace(F.format_string("%.3f", x), r"\.?0+$", "")


def one_in(label: Column) -> Column:
    """N of '1 in N'."""
    return number(group(label, r"(?i)1\s*in\s*" + _NUM))


def gradient_words(label: Column) -> Column:
    """'R 1 in 150' to '1 in 150 rising'; above 1 in 100000 it is level."""
    n = one_in(label)
    way = F.when(label.rlike(r"(?i)^\s*(R|rise|\+)"), "rising").otherwise("falling")
    return F.when(label.rlike(r"(?i)level") | (n > 1e5), "level").when(n.isNotNull(), F.concat(F.lit("1 in "), plain(n), F.lit(" "), way))


def dms(text: Column) -> Column:
    """Degrees, minutes and seconds to degrees; missing parts are 0."""
    parts = F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0))
    part = lambda k: F.coalesce(number(F.get(parts, F.lit(k))), F.lit(0.0))
    return F.when(F.size(parts) > 0, part(0) + part(1) / 60 + part(2) / 3600)


def highest_level(text: Column, name: str) -> Column:
    """The largest number printed behind ``name``."""
    found = F.regexp_extract_all(text, F.lit(rf"(?i){name}\D{{0,6}}([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return F.array_max(F.transform(found, number))


def configuration(text: Column) -> Column:
    """'1 X 3.5 X 2' to (cells, span, height)."""
    parts = F.transform(F.split(F.upper(text), r"\s*X\s*"), lambda x: number(F.trim(x)))
    return F.when(text.rlike(r"(?i)^\s*[0-9.]+\s*x\s*[0-9.]+"), F.struct(F.get(parts, F.lit(0)).alias("cells"), F.get(parts, F.lit(1)).alias("span"), F.get(parts, F.lit(2)).alias("height")))


def key(text: Column) -> Column:
    """Upper case without anything but letters and digits."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def revision_order(rev: Column) -> Column:
    """10 of 'R10'; -1 without a number."""
    return F.coalesce(group(rev, r"^R([0-9]+)").try_cast("int"), F.lit(-1))


def first_kind(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The kind of the first pattern that is found, in order."""
    out = F.lit(default)
    for kind, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), kind).otherwise(out)
    return out


# Character references that texts hold.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def strip_tags(html: Column) -> Column:
    """Without scripts, styles and tags, character references decoded, white space as one space."""
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(?:script|style)\s*>", " "), "<[^>]+>", " ")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def json_block(text: Column) -> Column:
    """What a ```json fence holds, else the widest [..] or {..}."""
    return F.coalesce(group(text, r"(?s)```json\s*(.*?)```"), group(text, r"(?s)(\[.*\]|\{.*\})"))


def split_think(text: Column) -> tuple[Column, Column]:
    """(thinking, answer) of a reply; marker tokens <|..|> go."""
    text = F.regexp_replace(text, r"<\|[^|<>]*\|>", "")
    bare = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    return bare(group(text, r"(?s)<think>(.*?)</think>")), bare(F.regexp_replace(text, r"(?s)^.*</think>", ""))


def colour(value: Column) -> Column:
    """An integer colour as (r, g, b)."""
    return F.array(F.shiftright(value, 16).bitwiseAND(255), F.shiftright(value, 8).bitwiseAND(255), value.bitwiseAND(255))
