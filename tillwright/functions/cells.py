"""Cell-level text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_string(c: Column) -> Column:
    """Collapse runs of white space, trim, and turn empty text into NULL."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def blank(c: Column) -> Column:
    """True for NULL, white space only, and the text ``nan``."""
    s = strip(c)
    return c.isNull() | (s == "") | (F.lower(s) == "nan")
