"""Labels and formatting."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.vocabulary import DISPLAY_NAMES


def all_label(tag: Column) -> Column:
    """``man_made`` to ``All Man_made``."""
    return F.concat(F.lit("All "), F.upper(F.substring(tag, 1, 1)), F.lower(F.substr(tag, F.lit(2))))


def display_name(tag: Column) -> Column:
    """The fixed name of a tag, or its words with capitals."""
    names = F.create_map(*(F.lit(x) for x in chain(*DISPLAY_NAMES.items())))
    return F.coalesce(names[tag], F.initcap(F.replace(tag, F.lit("_"), F.lit(" "))))


def duration(seconds: Column) -> Column:
    """``12.0s``, ``2.5m`` or ``1.2h``."""
    return (
        F.when(seconds < 60, F.format_string("%.1fs", seconds))
        .when(seconds < 3600, F.format_string("%.1fm", seconds / 60))
        .otherwise(F.format_string("%.1fh", seconds / 3600))
    )


def thousands(value: Column, decimals: int = 0) -> Column:
    """``1,234.50``: groups of three digits and a fixed number of decimals."""
    return F.format_number(value, decimals)


def stamp(moment: Column) -> Column:
    """``2024-05-01 13:00:00``, in the session's time zone."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def none_to_null(text: Column) -> Column:
    return F.nullif(text.cast("string"), F.lit("None"))
