"""Attributes of one-line XML rows, ``<row A="1" B="2" />``.

Where the target names the attributes, ``from_xml`` reads them. Where they are not known beforehand
no schema-bound reader fits: names and values are cut out by pattern and the references in the
values (``&amp;``, ``&#10;``) are resolved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = r"[\p{L}_:][\p{L}\p{N}_:.\-]*"
VALUE = r"""(?:"[^"<]*"|'[^'<]*')"""
ATTRIBUTE = rf"({NAME})\s*=\s*({VALUE})"
ROW_LINE = rf"(?s)^\s*<row(?:\s+{NAME}\s*=\s*{VALUE})*+\s*(?:/>|>\s*</row\s*>)\s*$"

# The references every XML document may use; & comes last so that it is not undone twice.
NAMED_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]


def is_row(line: Column) -> Column:
    """A line that starts with a ``row`` element; ``<rows>`` is another element."""
    return line.rlike(r"^\s*<row(?:[ \t/>]|$)")


def attribute_names(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(ATTRIBUTE), F.lit(1))


def attributes(line: Column, fold: bool = False) -> Column:
    """Map of attribute name to resolved value; a malformed row line is an error.

    For names that are not known beforehand. ``fold`` gives lower-case names.
    """
    # As in any XML attribute, a raw tab or line break counts as a blank
    flat = F.translate(line, "\t\n\r", "   ")
    quoted = F.regexp_extract_all(flat, F.lit(ATTRIBUTE), F.lit(2))
    bare = F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    names = attribute_names(flat)
    if fold:
        names = F.transform(names, F.lower)
    message = F.concat(F.lit("malformed row: "), line)
    return F.when(
        line.rlike(ROW_LINE), F.map_from_arrays(names, F.transform(bare, resolved))
    ).otherwise(F.raise_error(message).cast("map<string,string>"))


def known_attributes(line: Column, names: Sequence[str]) -> Column:
    """The named attributes as a struct of texts; names match in any case, NULL where absent.

    The matching follows ``spark.sql.caseSensitive``, which must be off (see ``folds_names``).
    """
    schema = T.StructType([T.StructField(f"_{name}", T.StringType()) for name in names])
    return F.from_xml(line, schema, {"mode": "FAILFAST", "attributePrefix": "_"})


def folds_names(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive").lower() != "true"


def resolved(value: Column) -> Column:
    """Attribute text with its references replaced. Text without ``&`` takes the short way."""
    named = F.when(value.contains("&#"), _numbered(value)).otherwise(value)
    for reference, char in NAMED_REFERENCES:
        named = F.replace(named, F.lit(reference), F.lit(char))
    return F.when(value.contains("&"), named).otherwise(value)


def _numbered(value: Column) -> Column:
    # "a&#10;b&#x26;c" splits at "&#" into "a", "10;b", "x26;c"
    pieces = F.split(value, "&#")
    rest = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda piece: F.concat(
            _char(F.substring_index(piece, ";", 1)),
            F.substring(piece, F.instr(piece, ";") + 1, F.length(piece)),
        ),
    )
    return F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))


def _char(code: Column) -> Column:
    hexed = F.when(
        code.startswith("x"), F.substring(code, F.lit(2), F.length(code))
    ).otherwise(F.hex(code.try_cast("bigint")))
    char = F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")
    # A numbered ampersand must not start a named reference in the next step
    return F.when(char == "&", F.lit("&amp;")).otherwise(char)


def escaped(value: Column) -> Column:
    """Text made safe for a double-quoted attribute."""
    for reference, char in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                            ("&#9;", "\t"), ("&#10;", "\n"), ("&#13;", "\r")]:
        value = F.replace(value, F.lit(char), F.lit(reference))
    return value


def row_line(**columns: Column) -> Column:
    """Columns as one ``<row …/>`` line; a NULL column leaves its attribute out."""
    parts = [
        F.when(c.isNotNull(), F.concat(F.lit(f'{name}="'), escaped(c.cast("string")), F.lit('"')))
        for name, c in columns.items()
    ]
    return F.concat(F.lit("  <row "), F.concat_ws(" ", *parts), F.lit(" />"))
