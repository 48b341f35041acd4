"""Tag filters and classification over wide, map, dotted and hstore tag layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def require(df: DataFrame, *names: str) -> None:
    """Raises ``ValueError`` for a mandatory column that is missing, before anything runs."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def hstore(text: Column, key: str) -> Column:
    """Value of ``key`` in ``"key"=>"value",...``; null where it is absent."""
    return F.nullif(F.regexp_extract(text, f'"{key}"=>"([^"]+)"', 1), F.lit(""))


def resolve(df: DataFrame, key: str) -> Column:
    """The value of a tag wherever the table keeps it: a column of its own, ``tag.``/``tags.``/``@`` columns, a map
    column ``tags``, or hstore text ``other_tags``; a null column if nowhere."""
    found = [F.col(f"`{n}`") for n in (key, f"tag.{key}", f"tags.{key}", f"@{key}") if n in df.columns]
    if "tags" in df.columns and isinstance(df.schema["tags"].dataType, MapType):
        found.append(F.col("tags")[key])
    if "other_tags" in df.columns:
        found.append(hstore(F.col("other_tags"), key))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def matches(df: DataFrame, vocabulary: Mapping[str, Sequence[str]]) -> Column:
    """Whether any key of ``vocabulary`` has one of its values; keys without a column count as absent."""
    tests = [resolve(df, k).isin(*v) for k, v in vocabulary.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def classify(df: DataFrame, vocabulary: Mapping[str, Sequence[str]], kind: str, value: str) -> DataFrame:
    """Adds ``kind`` (the first key in order whose value is in its vocabulary) and ``value``, and drops what none has."""
    tagged = df.withColumns({f"_t_{k}": resolve(df, k) for k in vocabulary})
    tests = [(k, F.col(f"_t_{k}").isin(*v)) for k, v in vocabulary.items()]
    name = reduce(lambda c, t: c.when(t[1], F.lit(t[0])), tests[1:], F.when(tests[0][1], F.lit(tests[0][0])))
    own = reduce(lambda c, t: c.when(t[1], F.col(f"_t_{t[0]}")), tests[1:], F.when(tests[0][1], F.col(f"_t_{tests[0][0]}")))
    out = tagged.withColumns({kind: name, value: own}).where(F.col(kind).isNotNull())
    return out.drop(*(f"_t_{k}" for k in vocabulary))


def tag_columns(df: DataFrame) -> list[str]:
    """Columns that look like tags: names that begin with ``tag`` or hold a colon."""
    return [c for c in df.columns if c.startswith("tag") or ":" in c]


def existing(df: DataFrame, *names: str) -> list[str]:
    """Of ``names`` those the table has, in the given order."""
    return [n for n in names if n in df.columns]
