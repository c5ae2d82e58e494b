"""Pandas UDFs for what built-in functions cannot express: folds, parsers with callbacks, dynamic programs."""

from __future__ import annotations

import difflib
import hashlib
import json
import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\s*(?:([0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?)|(\S))")
#: How strongly signs between numbers bind; a sign before a number binds most.
_BINDS = {"+": 1, "-": 1, "*": 2, "×": 2, "/": 2, "÷": 2}
_SIGN = 3


def evaluate(text: str | None) -> tuple[float | None, str | None]:
    """(value to 3 decimals, error) of an arithmetic expression: numbers, + - * /, signs and brackets only.

    Numbers wait on one stack, operators on another; an operator is carried out once one that binds no more strongly follows."""
    numbers: list[float] = []
    waiting: list[tuple[str, int]] = []

    def carry_out(least: int) -> None:
        while waiting and waiting[-1][1] >= least:
            sign, binds = waiting.pop()
            x = numbers.pop()
            if binds == _SIGN:
                numbers.append(-x if sign == "-" else x)
            else:
                first = numbers.pop()
                numbers.append(first + x if sign == "+" else first - x if sign == "-" else first * x if sign in "*×" else first / x)

    if text is None or not text.strip() or len(text) > 200:
        return None, "no expression"
    wanted = True
    try:
        for number, mark in _TOKEN.findall(text.rstrip()):
            if wanted and number:
                numbers.append(float(number))
                wanted = False
            elif wanted and mark == "(":
                waiting.append(("(", 0))
            elif wanted and mark and mark in "+-":
                waiting.append((mark, _SIGN))
            elif not wanted and mark in _BINDS:
                carry_out(_BINDS[mark])
                waiting.append((mark, _BINDS[mark]))
                wanted = True
            elif not wanted and mark == ")":
                carry_out(1)
                if not waiting:
                    return None, "a bracket is not open"
                waiting.pop()
            else:
                return None, f"{number or mark} is not expected"
        if wanted:
            return None, "a number is missing"
        carry_out(1)
        if waiting:
            return None, "a bracket is not closed"
        if not math.isfinite(numbers[0]):
            return None, "too large"
        return round(numbers[0], 3), None
    except ZeroDivisionError:
        return None, "division by zero"


@F.pandas_udf(T.StructType([T.StructField("value", T.DoubleType()), T.StructField("error", T.StringType())]))
def calc(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([evaluate(t) for t in text], columns=["value", "error"])


def flatten(value, path: str = "", key: str | None = None) -> dict[str, str]:
    """Path -> scalar of a nested value; nulls are left out. Items of a list go by their number, or, where all are objects that
    have ``key``, each with another value, by that."""
    if isinstance(value, dict):
        return {k: v for name, x in value.items() for k, v in flatten(x, f"{path}.{name}" if path else str(name), key).items()}
    if isinstance(value, list):
        names = [x.get(key) if isinstance(x, dict) else None for x in value]
        if key is None or None in names or len(set(map(str, names))) < len(names):
            names = range(len(value))
        return {k: v for i, x in zip(names, value, strict=True) for k, v in flatten(x, f"{path}[{i}]", key).items()}
    return {} if value is None else {path: str(value)}


def _flattened(text: pd.Series, key: str | None) -> pd.Series:
    def one(t: str | None) -> dict[str, str] | None:
        try:
            return flatten(json.loads(t), key=key) if t else None
        except ValueError:
            return None

    return text.map(one)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def flatten_json(text: pd.Series) -> pd.Series:
    return _flattened(text, None)


def flatten_json_by(key: str):
    """As ``flatten_json``, with the items of lists by their ``key``."""

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def run(text: pd.Series) -> pd.Series:
        return _flattened(text, key)

    return run


def segment(text: str, words: frozenset[str], longest: int = 20) -> list[str]:
    """The fewest dictionary words that make up ``text``; the text itself if none do."""
    best: list[tuple[int, int] | None] = [(0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            if best[start] is not None and text[start:end] in words and (best[end] is None or best[start][0] + 1 < best[end][0]):
                best[end] = (best[start][0] + 1, start)
    if best[len(text)] is None:
        return [text]
    out, at = [], len(text)
    while at:
        out.append(text[best[at][1] : at])
        at = best[at][1]
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def segment_udf(text: pd.Series, words: pd.Series) -> pd.Series:
    """``segment`` with the words that each text may be made up of."""
    return pd.Series([None if t is None else segment(t, frozenset(() if w is None else w)) for t, w in zip(text, words, strict=True)])


def successive(text: str) -> list[int] | None:
    """'1011' to [10, 11]: the digits as consecutive numbers, or null."""
    for width in range(1, len(text) // 2 + 1):
        n, out = int(text[:width]), text[:width]
        found = [n]
        while len(out) < len(text):
            n += 1
            out += str(n)
            found.append(n)
        if out == text:
            return found
    return None


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def split_successive(text: pd.Series) -> pd.Series:
    return text.map(lambda t: successive(t) if t and t.isdigit() else None)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two labels; null if one is."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


#: Numbers, positions and quotes, which no rewording may touch.
KEEP = r"[0-9]+\+[0-9]+(?:\.[0-9]+)?|-?[0-9]+(?:\.[0-9]+)?|\"[^\"]*\""


def protect(text: str) -> tuple[str, list[str]]:
    """The text with a numbered placeholder for each kept piece, and those pieces: cut at them, every second piece is one."""
    pieces = re.split(f"({KEEP})", text)
    return "".join(p if at % 2 == 0 else f"⟦{at // 2}⟧" for at, p in enumerate(pieces)), pieces[1::2]


def restore(text: str, kept: list[str]) -> str | None:
    """The text with its placeholders filled; null if one was lost or doubled."""
    pieces = re.split(r"⟦([0-9]+)⟧", text)
    held = pieces[1::2]
    if sorted(held) != sorted(map(str, range(len(kept)))):
        return None
    return pieces[0] + "".join(kept[int(number)] + free for number, free in zip(held, pieces[2::2], strict=True))


# Plain rewordings of question words.
REWORD = {"what is": ["tell me", "give"], "how many": ["what number of"], "show": ["list", "display"], "find": ["look up", "search for"], "which": ["what"], "height": ["level"], "distance": ["length"]}


def reword(text: str, seed: str, chance: float = 0.55) -> str | None:
    """A seeded rewording that leaves protected spans as they are."""
    rng = random.Random(hashlib.md5(seed.encode()).hexdigest())
    body, kept = protect(text)
    for phrase, others in REWORD.items():
        if rng.random() < chance:
            body = re.sub(rf"(?i)\b{phrase}\b", lambda m, o=others: rng.choice(o), body, count=1)
    if rng.random() < 0.12:
        body = body.lower()
    if rng.random() < 0.1:
        body = body.rstrip("?. ")
    return restore(body, kept)


@F.pandas_udf(T.StringType())
def reword_udf(text: pd.Series, seed: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else reword(t, str(s)) for t, s in zip(text, seed, strict=True)])


def match_boxes(refs: list[list[float]], preds: list[list[float]], least: float = 0.5) -> tuple[int, int, int]:
    """(tp, fp, fn) of greedy one-to-one matching in the order of the references."""

    def overlap(a: list[float], b: list[float]) -> float:
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w <= 0 or h <= 0:
            return 0.0
        return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)

    free, tp = list(range(len(preds))), 0
    for r in refs:
        best = max(free, key=lambda i: overlap(r, preds[i]), default=None)
        if best is not None and overlap(r, preds[best]) >= least:
            free.remove(best)
            tp += 1
    return tp, len(preds) - tp, len(refs) - tp


def answer_mask(ids: list[int], start: list[int], end: int) -> list[int]:
    """1 for ids from behind each start sequence to the end id inclusive; to the end of the row if there is none.

    The places of starts and ends are found in arrays; a start inside what is marked already does not count."""
    x, n = np.asarray(ids, np.int64), len(start)
    out = np.zeros(len(x), np.int64)
    if len(x) < n or not n:
        return out.tolist()
    begins = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(x, n) == np.asarray(start)).all(1))
    ends = np.flatnonzero(x == end)
    upto = 0
    for at in begins.tolist():
        if at >= upto:
            k = np.searchsorted(ends, at + n)
            upto = int(ends[k]) + 1 if k < len(ends) else len(x)
            out[at + n : upto] = 1
    return out.tolist()


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def answer_mask_udf(ids: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([answer_mask(list(a), list(s), int(e)) for a, s, e in zip(ids, start, end, strict=True)])
