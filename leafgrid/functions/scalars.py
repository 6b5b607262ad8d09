"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that recognition confuses, each with the right one.
CONFUSED = "营管掌常富量京答王青夏草"
RIGHT = "宫宫宫宫宫宫宫宫日七八半"
# The characters allowed in a row of each kind.
YEAR = "一二三四五六七八九十百千年"
WEEKDAY = "一二三四五六七月日金木水火土大小"
ASTRO = "一二三四五六七八九十初宫度分秒半壹"
CJK = "[\\x{4e00}-\\x{9fff}\\x{3400}-\\x{4dbf}]"


def correct_characters(text: Column) -> Column:
    return F.translate(text, CONFUSED, RIGHT)


def only(text: Column, allowed: str) -> Column:
    """``text`` without the characters that are not in ``allowed``."""
    return F.regexp_replace(text, f"[^{allowed}]", "")


def charset_of_row(row: Column) -> Column:
    """The allowed characters of a table row: years, weekdays, then positions."""
    return F.when(row == 0, F.lit(YEAR)).when(row == 1, F.lit(WEEKDAY)).otherwise(F.lit(ASTRO))


def last_number(stem: Column) -> Column:
    """The last run of digits as an integer; null without one."""
    return F.try_element_at(F.regexp_extract_all(stem, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1)).cast("int")


def clean_stem(name: Column) -> Column:
    """A file name without folder and extension."""
    return F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"\.[^.]*$", "")


def round_half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def floor_div(a: Column, b: Column) -> Column:
    return F.floor(a / b)


def angle_from_vertical(dx: Column, dy: Column) -> Column:
    """Degrees, 0 for a vertical segment and 90 for a horizontal one."""
    return F.abs(F.degrees(F.atan2(F.abs(dx), F.abs(dy))))


def segment_kind(angle: Column, tolerance: float = 10.0) -> Column:
    return F.when(angle <= tolerance, "vertical").when(angle >= 90 - tolerance, "horizontal").otherwise("other")


def expand_ranges(text: Column) -> Column:
    """``'1,3-5'`` as an array of integers."""
    part = F.split(F.regexp_replace(text, r"\s", ""), ",")
    ends = lambda p: F.split(p, "-")
    first = lambda p: F.get(ends(p), F.lit(0)).cast("int")
    last = lambda p: F.coalesce(F.get(ends(p), F.lit(1)).cast("int"), first(p))
    return F.flatten(F.transform(part, lambda p: F.sequence(first(p), last(p))))


def cell_label(index: Column, sub: Column) -> Column:
    """``i``, or ``i.sub`` in a double row, counted from 1."""
    return F.concat_ws(".", (index + 1).cast("string"), sub.cast("string"))


def in_numbers(number: Column, text: Column) -> Column:
    """Whether a number is one of ``'all'``, ``'3-6'`` or ``'1,4'``."""
    return F.when(F.lower(F.trim(text)) == "all", F.lit(True)).otherwise(F.array_contains(expand_ranges(F.when(F.lower(F.trim(text)) != "all", text)), number))
