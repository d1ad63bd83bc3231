"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings that mean true; any other text is false.
TRUE_WORDS = ["1", "true", "True"]
# Letters spelled out in a mail domain.
DOMAIN_SPELLING = [("ä", "ae"), ("ö", "oe"), ("ü", "ue"), (" ", "")]


def as_flag(text: Column) -> Column:
    return F.when(text.isNotNull(), text.isin(TRUE_WORDS))


def mail_domain(city: Column) -> Column:
    for letter, spelled in DOMAIN_SPELLING:
        city = F.replace(city, F.lit(letter), F.lit(spelled))
    return F.lower(city)


def mail_address(first_name: Column, surname: Column, city: Column) -> Column:
    return F.concat(first_name, F.lit("."), surname, F.lit("@"), mail_domain(city), F.lit(".de"))


def is_heading(text: Column) -> Column:
    """A line such as ``NEW PROJECTS:``. NULL is not a heading."""
    return F.coalesce(text.endswith(":"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def occurrences(text: Column, char: str) -> Column:
    """How often one character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def same_id(left: Column, right: Column) -> Column:
    """Equality of two UUID texts, whatever their case."""
    return F.lower(left) == F.lower(right)


def file_stem(file_name: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(file_name, r"(?<=.)[.][^.]*$", "")


def clamp(value: Column, low, high) -> Column:
    """``value`` forced into low..high; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))
