"""Values, tokens and tool calls in free text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.parse import json_block, number, plain
from plumbline.functions.udfs import KEEP

POSITION = r"[0-9]+\+[0-9]+(?:\.[0-9]+)?"
GROUPED = r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?"


def numbers(text: Column) -> Column:
    """Distinct numbers of a text: positions in metres, then the others in order, without the commas of thousands."""
    at = F.transform(F.regexp_extract_all(text, F.lit(POSITION), F.lit(0)), lambda x: number(F.split_part(x, F.lit("+"), F.lit(1))) * 1000 + number(F.split_part(x, F.lit("+"), F.lit(2))))
    rest = F.regexp_extract_all(F.regexp_replace(text, POSITION, " "), F.lit(GROUPED), F.lit(0))
    return F.array_union(at, F.transform(rest, lambda x: number(F.replace(x, F.lit(","), F.lit("")))))


def shorthand(text: Column) -> Column:
    """Letters with points between them, two to five, as one word: h.f.l. is hfl."""
    for n in (5, 4, 3, 2):
        letters = r"\.".join(["([a-z])"] * n)
        text = F.regexp_replace(text, rf"\b{letters}\b\.?", "".join(f"${k}" for k in range(1, n + 1)))
    return text


def tokens(text: Column, stop: list[str]) -> Column:
    """Distinct tokens in order: words, words joined by a stroke, and numbers, lower-cased, shorthand as words, without ``stop``."""
    found = F.regexp_extract_all(shorthand(F.lower(text)), F.lit("[a-z]+(?:/[a-z]+)*|[0-9]+(?:[.][0-9]+)?"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: ~w.isin(*stop)))


def json_of(text: Column) -> Column:
    """The JSON that a reply holds, in a fence or between its outermost brackets; null where it is not valid."""
    held = json_block(text)
    # as the one value of an array: what follows a value is an error then
    whole = F.try_parse_json(F.concat(F.lit("["), held, F.lit("]")))
    return F.when(whole.isNotNull() & F.try_variant_get(whole, "$[1]", "variant").isNull(), held)


def normal(value: Column) -> Column:
    """A number to three decimals without trailing zeros; else the text, lower-cased, white space as one space."""
    text = F.trim(F.regexp_replace(F.lower(value), r"\s+", " "))
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), plain(number(text))).otherwise(text)


def value_recall(prediction: Column, reference: Column) -> Column:
    """Share of the distinct values of ``reference`` (an array) that the text ``prediction`` has; null if there are none.

    Values are compared as ``normal`` has them; a number must be one of the text's, other values may be anywhere in it."""
    wanted = F.array_distinct(F.filter(F.transform(reference, normal), lambda v: v.isNotNull() & (v != "")))
    text = F.coalesce(normal(F.concat(prediction, F.lit(" "))), F.lit(""))
    have = F.transform(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0)), normal)
    hit = lambda v: F.array_contains(have, v) | (~v.rlike(r"^[0-9.]+$") & F.contains(text, v))
    return F.size(F.filter(wanted, hit)) / F.nullif(F.size(wanted), F.lit(0))


CALL = r"(?s)<call name=\"(\w+)\">(.*?)</call>"
ARGUMENT = r"(?s)<arg name=\"(\w+)\">(.*?)</arg>"


def tool_calls(text: Column, kinds: dict[str, str]) -> Column:
    """Calls of a reply in order: name, and arguments as a map of JSON values typed by ``kinds`` ("tool.argument" -> number,
    boolean, else text). A value that is not of its kind stays a text; of arguments with one name the first counts."""
    quoted = lambda raw: F.concat(F.lit('"'), F.replace(F.replace(raw, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    listed = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])

    def typed(tool: Column, key: Column, raw: Column) -> Column:
        kind = F.try_element_at(listed, F.concat(tool, F.lit("."), key))
        bare = F.lower(F.trim(raw))
        return F.when((kind == "number") & F.trim(raw).rlike(r"^-?[0-9]+(\.[0-9]+)?$"), F.trim(raw)).when((kind == "boolean") & bare.isin("true", "false"), bare).otherwise(quoted(raw))

    def call(tool: Column, body: Column) -> Column:
        keys, raws = (F.regexp_extract_all(body, F.lit(ARGUMENT), F.lit(k)) for k in (1, 2))
        pairs = F.zip_with(keys, raws, lambda k, v: F.struct(k.alias("key"), typed(tool, k, v).alias("value")))
        first = F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1)
        return F.struct(tool.alias("name"), F.map_from_entries(first).alias("arguments"))

    names, bodies = (F.regexp_extract_all(text, F.lit(CALL), F.lit(k)) for k in (1, 2))
    return F.zip_with(names, bodies, call)


def protected(text: Column) -> Column:
    """The text with a numbered placeholder for each number, position and quote, and the array of those."""
    kept, free = F.regexp_extract_all(text, F.lit(KEEP), F.lit(0)), F.split(text, KEEP, -1)
    masked = F.array_join(F.transform(free, lambda x, i: F.concat(x, F.when(i < F.size(kept), F.concat(F.lit("⟦"), i.cast("string"), F.lit("⟧"))).otherwise(F.lit("")))), "")
    return F.struct(masked.alias("text"), kept.alias("kept"))


def all_words(text: Column, asked: Column) -> Column:
    """Whether the text has every word that is asked for, as a word and whatever its case; true where none is."""
    have = F.split(F.lower(text), "[^a-z0-9]+")
    wanted = F.filter(F.split(F.lower(asked), "[^a-z0-9]+"), lambda w: w != "")
    return F.forall(wanted, lambda w: F.array_contains(have, w))
