"""Shared Column expressions on texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def n_words(text: Column) -> Column:
    """Number of words: runs of anything but space and the controls 9 to 13."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")
