"""Text out of what recognition engines return: nested answers, classic lists, line objects, page trees."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType

from vellumine.functions.text import Text, _c, strip

#: Keys whose values are texts; they are read first, in this order. Fixed values.
TEXT_KEYS = ("text", "texts", "rec_texts", "rec_text", "label")


def harvest(answer: Any) -> list[str]:
    """All strings in a nested answer, stripped, blank ones left out.

    Of an object the values of TEXT_KEYS come first, then all its values in their order, so
    those come twice. Works with a stack, so depth has no limit.

    >>> harvest({"b": ["x", " "], "text": "t"})
    ['t', 'x', 't']
    """
    out, todo = [], [answer]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out += [x.strip()] if x.strip() else []
        elif isinstance(x, dict):
            todo += reversed([x[k] for k in TEXT_KEYS if k in x] + list(x.values()))
        elif isinstance(x, list):
            todo += reversed(x)
    return out


@F.pandas_udf(ArrayType(StringType()))
def harvested(answer: pd.Series) -> pd.Series:
    """harvest of a JSON text; null for null and for text that is no JSON."""

    def read(x: str | None) -> list[str] | None:
        try:
            return None if x is None else harvest(json.loads(x))
        except (ValueError, RecursionError):
            return None

    return answer.map(read)


def _filled(texts: Column) -> Column:
    return F.filter(F.transform(texts, strip), lambda t: t.isNotNull() & (t != ""))


def _string(v: Column, path: str) -> Column:
    """A member that is a string, else null."""
    member = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(member, "$", "string"))


def classic_text(answer: Text, detected: bool = True) -> Column:
    """Lines of a classic answer, a JSON list of [box, [text, score]], or without detection of [text, score].

    A list around the only list of lines is taken off. What isn't shaped so is left out; an
    answer that is no list gives an empty text, null stays null.
    """
    v = F.try_parse_json(_c(answer))
    items = F.try_variant_get(v, "$", "array<variant>")
    only = (F.size(items) == 1) & F.schema_of_variant(F.get(items, F.lit(0))).startswith("ARRAY")
    inner = F.when(only, F.try_variant_get(v, "$[0]", "array<variant>")).otherwise(items)
    boxed = lambda x: _string(x, "$[1][0]")
    one = boxed if detected else lambda x: F.coalesce(F.when(F.size(F.try_variant_get(x, "$", "array<variant>")) == 2, _string(x, "$[0]")), boxed(x))
    return F.when(_c(answer).isNotNull(), F.coalesce(F.array_join(_filled(F.transform(inner, one)), "\n"), F.lit("")))


def line_texts(answer: Text) -> Column:
    """Texts of the lines of {"text_lines": [{"text": ...}]}, stripped, blank ones left out; empty for anything else."""
    lines = F.try_variant_get(F.try_parse_json(_c(answer)), "$.text_lines", "array<variant>")
    return F.coalesce(_filled(F.transform(lines, lambda x: _string(x, "$.text"))), F.array().cast("array<string>"))


def page_text(blocks: Text) -> Column:
    """Text of a page tree, an array of blocks of lines of words: a line a line, a blank one between blocks."""
    line = lambda words: strip(F.array_join(F.transform(words, lambda w: strip(F.coalesce(w, F.lit("")))), " "))
    block = lambda lines: F.array_join(F.filter(F.transform(lines, line), lambda t: t != ""), "\n")
    return F.array_join(F.filter(F.transform(_c(blocks), block), lambda t: t != ""), "\n\n")
