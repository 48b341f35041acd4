"""Bounded samples of labelled rows, for models that are fitted on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % by


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, fold: Column, id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """``id, text, label`` of at most ``per_class`` labelled rows of each class, those with the least id hashes among
    rows whose ``fold`` holds. Rows without a label, and all but one of a repeated id, are left out."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & fold).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("label"))
    chosen = [marked.where(F.col("label") == k).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * per_class ids
    picked = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "_id")
    return picked.toPandas().drop_duplicates("_id").sort_values("_id").reset_index(drop=True)
