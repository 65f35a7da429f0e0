"""Corpus pipeline over ``documents``: language ID, line dedup, near-duplicate
removal, decontamination, byte-level BPE.

Each stage works on all rows its predecessor kept, is written as parquet into
the shared folder and reread as the next one's input.  All stages but the last
return the columns of their input.  Rows of null text are empty texts; extra
columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast.llm import bpe, common, decontaminate, langid, line_dedup, near_duplicates
from unitcast.llm.queries import DOCUMENT_EVIDENCE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the evidence supports; others go."""
    common.ship(spark)
    return langid.accepted(docs, **DOCUMENT_EVIDENCE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; ``text`` and ``n_chars`` become those of the kept
    text.  A document that loses all its lines is kept as empty text."""
    common.ship(spark)
    out = line_dedup.dedup_lines(docs)
    kept = F.col("_kept.kept")
    values = {"text": kept, "n_chars": F.length(kept).cast("long")}
    return out.select(*[values.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of smallest id."""
    common.ship(spark)
    return near_duplicates.one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ``benchmark`` item."""
    leaks = decontaminate.find_leaks(docs, common.table(spark, sf_dir, "benchmark"))
    return decontaminate.without_leaks(docs, leaks)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text (little-endian unsigned 32-bit), their number, and the
    digest of the text decoded from them; columns so named are replaced."""
    common.ship(spark)
    made = ("ids", "n_tokens", "decoded", "decoded_sha256")
    rest = [c for c in docs.columns if c != "text" and c not in made]
    coded = bpe.round_trip(docs.select(*rest, "text"))
    return coded.select(*rest, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                  F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("byte_level_bpe", encode_texts),
]

#: The language model, MinHash candidates and BPE merges have no SQL form;
#: tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else common.stored(out, f"stage-{name}")
    return docs
