"""Cleaning of names and of published number cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(c: Column, *, trim_again: bool = False, join_letters: bool = False) -> Column:
    """Trim blanks, then turn every run of white space into one blank.

    ``trim`` removes blanks only, so a leading tab ends up as one leading blank;
    ``trim_again`` removes that as well.  ``join_letters`` closes up letter-spaced
    names such as ``A b c d``.
    """
    cleaned = F.regexp_replace(F.trim(c), r"\s+", " ")
    if join_letters:
        spaced = r"^\s*\p{L}( \p{L})+\s*$"
        cleaned = F.when(cleaned.rlike(spaced), F.regexp_replace(cleaned, " ", "")).otherwise(cleaned)
    return F.trim(cleaned) if trim_again else cleaned


def parse_count(c: Column) -> Column:
    """Published count cell to long: blank-separated thousands, ``-`` or empty is null."""
    return F.regexp_replace(c, r"\s+", "").try_cast("long")


def snake_name(label: str) -> str:
    """A display label as a column name: ``New Cases (Late)`` gives ``new_cases_late``."""
    return re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")
