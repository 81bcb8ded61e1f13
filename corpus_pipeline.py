"""The corpus pipeline: documents through the text operators, each stage written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, near, packing, quality
from millrace.llm.common import remainder, table
from millrace.llm.queries import TOKENIZER
from millrace.sources.scratch import drop_tables, write_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more. It is fitted to labelled documents outside the held-out quarter.

    Null and empty texts are scored like any other; equal texts share their fate, however long; an empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, remainder(labels["doc_id"], 4) != 2)
    return quality.keep_good(docs, model)


def without_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites repeat (their first occurrence stays); text and n_chars are the new text's.

    A document that loses all its lines goes: each of them stands in an earlier document.
    """
    found = lines.remove_spread_lines(docs).where("n_removed = 0 OR n_left > 0")
    new = {
        "text": F.col("kept_text"),
        "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType),
    }
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar documents (five-word shingles, a similarity of 0.8 or more)."""
    return near.keep_first(docs, shingle=5, percent=80)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none and stay, repeated rows alike."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of the documents (ids, little-endian 32-bit numbers) in sequences of 1,024: one row per piece.

    A null or empty text is one piece, the end id; repeated rows are packed each; a very long text is many pieces.
    """
    return packing.pack(packing.token_pieces(docs, TOKENIZER, numbered=True))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_spread_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", clean_of_benchmark),
    ("best-fit packing", packed),
]

#: The classifier and the packing have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; what each one keeps is written to the shared folder, read again, and deleted once the next one's is there."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, _ = write_table(docs)
            drop_tables(before)
    return docs
