"""A corpus pipeline of five stages, each over all that the stage before kept.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``. ``run``
writes each stage's rows to the shared scratch folder and reads them back for the next.

Defined results: a null text is the empty text to every stage and stays null until masking finds
something in it, which it never does; rows that repeat are judged alike; an empty table passes through
as one; columns beside those of ``documents`` are carried along by the filtering stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, pieces, pii, quality, simhash
from quern.llm.common import read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours' votes give a score of 0.7 or more."""
    labels = read_table(spark, sf_dir, "labels")
    scored, name = quality.with_quality(docs, quality.fit(docs, labels))
    return scored.where(F.col(name)["score"] >= quality.KEEP).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id; of rows alike in id and fingerprint, one."""
    printed, name = simhash.with_fingerprint(docs, keep=["doc_id"])
    prints = stored(printed.select("doc_id", F.col(name)["fp"].alias("fp")), "prints")
    kept = simhash.survivors(simhash.near_components(prints))
    rows, name = simhash.with_fingerprint(docs)
    rows = rows.withColumn(name, F.col(name)["fp"])
    stays = rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows[name] == kept["fp"]), "left_semi")
    return stays.dropDuplicates(["doc_id", name]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    found, name = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated(F.col(name))).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; spans of personal data read as their kind, and ``n_chars`` follows the text."""
    masked, name = pii.with_masked(docs, pii.fit(docs))
    text = F.when(F.col("text").isNotNull(), F.col(name)["text"])
    return masked.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    vocabulary = pieces.PieceVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rows, name = pieces.with_digests(docs, vocabulary, keep=["doc_id"])
    return rows.select("doc_id", f"{name}.*")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("contamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", encode),
]

#: Hashing, votes of neighbours and merges have no SQL form; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
