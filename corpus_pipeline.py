"""The training-data pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``. Every
stage works on all that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkiln import session
from feedkiln.llm import byte_bpe, decontaminate, line_dedup, simhash_bk, toxicity_gbt
from feedkiln.llm.common import prepare, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees score below 0.5."""
    prepare(spark)
    model = toxicity_gbt.fit(docs, read(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity_gbt.remove_toxic(docs, model, threshold=0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document that loses all its
    lines goes with them. ``n_chars`` follows the text."""
    prepare(spark)
    count = "_lines_removed"
    while count in docs.columns:
        count += "_"
    clean = line_dedup.dedup_lines(docs, min_lines=2, min_chars=100, removed=count)
    cut = F.col(count) > 0
    return (clean.filter(~cut | F.col("text").rlike(r"[^\x09-\x0D\x20]"))
            .withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
            .select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each SimHash group."""
    prepare(spark)
    return simhash_bk.keep_first(docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word passage of the benchmark."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"), window=10)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    prepare(spark)
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", tokenise),
]

#: A learned model, 64-bit fingerprints and a merge loop are beyond SQL; the
#: tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read again, so a lost executor repeats one stage at most."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = session.scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
