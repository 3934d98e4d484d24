"""Text expressions: record fields, quoted lines, words and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday names for day numbers 1 to 7.
WEEKDAYS = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]

# Fixed value: the characters that separate words.
WORD_GAP = "[ \\t\\n\\r\\f]+"

# Fixed value: filler for missing places of a ten-wide list.
NO_ENTRY = "None"


def tab_fields(line: Column) -> Column:
    """All fields of a tab-separated line."""
    return F.split(line, "\t")


def tab_field(line: Column, index: int) -> Column:
    """Field `index` of a tab-separated line, null where the line is too short."""
    return F.get(tab_fields(line), F.lit(index))


def words(text: Column) -> Column:
    """Words of a text; a leading or trailing gap leaves an empty one to drop."""
    return F.split(text, WORD_GAP)


def weekday_name(number: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return F.get(names, number.try_cast("int") - 1)


def quoted_line(*columns: Column) -> Column:
    """Every field in double quotes, joined by commas; a null shows as `None`."""
    fields = [
        F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit(NO_ENTRY)), F.lit('"'))
        for c in columns
    ]
    return F.concat_ws(",", *fields)


def without_single_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit(""))


def pair_text(name: Column, value: Column) -> Column:
    """`(name, value)` as one text cell, single quotes removed."""
    return without_single_quotes(
        F.concat(F.lit("("), name, F.lit(", "), value.cast("string"), F.lit(")"))
    )


def bag_text(items: Column) -> Column:
    """An array of names as one text cell: `{(AA),(DL)}`."""
    inner = F.array_join(F.transform(items, lambda x: F.concat(F.lit("("), x, F.lit(")"))), ",")
    return F.concat(F.lit("{"), inner, F.lit("}"))
