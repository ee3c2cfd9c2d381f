"""Positions: lines, columns and character offsets, as column expressions over a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | int | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def line_to_char_offset(text: Column, line: Column | int) -> Column:
    """Offset of the start of a line counted from 1; 0 before the first, the text's length after the last."""
    line, lines = _column(line), F.split(text, "\n", -1)
    before = F.aggregate(F.slice(lines, F.lit(1), F.greatest(line - 1, F.lit(0))), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return F.when(line < 1, 0).when(line > F.size(lines), F.length(text)).otherwise(before)


def line_range(text: Column, line: Column | int, content: Column | str = "") -> Column:
    """``start, end`` of a line; with ``content`` the end follows from its length instead."""
    line, lines, content = _column(line), F.split(text, "\n", -1), _column(content)
    start = line_to_char_offset(text, line)
    inside = F.try_element_at(lines, F.greatest(line, F.lit(1)).cast("int"))
    end = F.when(F.length(content) > 0, start + F.length(content)).when(line < 1, start + F.length(F.try_element_at(lines, F.size(lines))))
    end = end.when(line <= F.size(lines), start + F.length(inside)).otherwise(F.length(text))
    return F.struct(start.alias("start"), end.alias("end"))


def line_segment_range(text: Column, line: Column | int, first: Column | int, last: Column | int) -> Column:
    """``start, end`` of the columns ``first`` to ``last`` (exclusive) of a line."""
    base = line_to_char_offset(text, line)
    return F.struct((base + _column(first)).alias("start"), (base + _column(last)).alias("end"))


def line_col_to_char_offset(text: Column, line: Column | int, col: Column | int) -> Column:
    return line_to_char_offset(text, line) + _column(col)


def char_offset_to_line(text: Column, offset: Column | int) -> Column:
    """The line, counted from 0, that an offset lies in."""
    before = F.substring(text, F.lit(1), F.greatest(_column(offset), F.lit(0)))
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit("")))


def char_length(start: Column, end: Column) -> Column:
    return end - start


def token_range(span: Column) -> Column:
    """An inclusive span as its two ends; a span that is not set is an error."""
    unset = F.raise_error(F.lit("the component has no token span"))
    return F.when(span.isNotNull(), span).otherwise(unset.cast("struct<start:int,end:int>"))


def token_count(span: Column) -> Column:
    """Tokens of an inclusive span; 0 without one."""
    return F.coalesce(span["end"] - span["start"] + 1, F.lit(0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vector columns; 0 if one is zero, null or of another length."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when((F.size(a) == F.size(b)) & (norm > 0), dot(a, b) / norm), F.lit(0.0))


def numeric_id(value: Column) -> Column:
    """The number of ids like ``T5``, ``token_5`` or ``5``; null for others."""
    return F.regexp_extract(value, r"^(?:T|token_)?(\d+)$", 1).try_cast("int")
