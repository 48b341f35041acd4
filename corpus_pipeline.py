"""The training-corpus pipeline: quality rules, near-duplicates, decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``docs``, whatever extra ones there are and whatever these are called.
Nulls in any column, empty and very long texts and repeated rows are handled as each stage says; an empty table goes
through every stage as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decontamination, minhash, packing, pii, quality_rules
from freshet.llm.storage import discard, save


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep. Null, empty and very short texts (under ten words) go; a repeated row is
    judged like the first."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id, null ids last. Rows are linked by a key of
    their own, so ids may repeat or be null: different texts stay, copies go. Rows without words are copies only if
    both their id and their text are the same."""
    key = f"_row_{uuid.uuid4().hex}"
    keyed = save(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = minhash.near_duplicates(keyed, id_col=key).select(key, "n_shingles", "component_id")
    rows = keyed.select(key, F.col("doc_id").alias("id"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha")).join(found, key)
    blank = F.col("n_shingles") == 0
    group = [F.when(~blank, F.col("component_id")).alias("a"), F.when(blank, F.col("id")).alias("b"), F.when(blank, F.col("text_sha")).alias("c"), blank.alias("d")]
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col(key).alias("row")))
    kept = rows.groupBy(*group).agg(first.alias("first")).select(F.col("first.row").alias(key))
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage. Null and empty texts hold none and stay; without items all stay."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the names of its kinds, ``n_chars`` being their new length. Null texts stay
    null, and every row stays."""
    return pii.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text is its end id alone; rows with a null id and repeated rows are
    packed as they come."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: Tokens and similarity groups are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, save(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
