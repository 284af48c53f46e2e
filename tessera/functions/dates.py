"""Dates in the forms that the comment sources use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("dd/MM/yyyy HH:mm", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def parse(c: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """The timestamp by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def day(c: Column) -> Column:
    """``yyyy-MM-dd``; where no format fits the first ten characters, and 'inconnu' where there are none."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.when(text == "", "inconnu").otherwise(F.coalesce(F.date_format(parse(text), "yyyy-MM-dd"), F.substring(text, 1, 10)))


def first_of_list(c: Column) -> Column:
    """The timestamp of the first element of a comma-separated list, null if it has none of the two list formats."""
    return parse(F.trim(F.split(c, ",")[0]), FORMATS[:2])


def week_key(ts: Column) -> Column:
    """Year and week as strftime's ``%Y-%W``: weeks begin on Monday, days before the first one are week 0."""
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7)
    return F.format_string("%04d-%02d", F.year(ts), week)
