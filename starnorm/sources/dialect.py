"""How text is laid out in CSV, for the writer and the readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quotes are doubled inside text. No field equals the null mark, so an empty field is
# null and two quotes are an empty text.
NULL_MARK = "\ue000"
DIALECT = {"header": True, "escape": '"', "nullValue": NULL_MARK, "emptyValue": ""}

# How line breaks inside text are written: as they are, inside quotes, which makes a
# file one task's work to read; or escaped, so that every line is a record and a file
# is read by as many tasks as it has splits.
LINE_BREAKS = ("quoted", "escaped")

# What an escaped character is written as, the escape character first.
ESCAPES = {"\\": "\\s", "\n": "\\n", "\r": "\\r", NULL_MARK: "\\e"}


def escaped(text: Column) -> Column:
    """Text without line breaks and null marks."""
    for character, written in ESCAPES.items():
        text = F.replace(text, F.lit(character), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given.

    Every escape character begins a pair, so the pairs are replaced one kind after the
    other, those that bring an escape character back last.
    """
    for character, written in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(written), F.lit(character))
    return text
