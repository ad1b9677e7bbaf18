"""From raw documents to packed token sequences: toxic documents, repeated lines, near-duplicates and passages go first.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import jaccard, lines, packing, repeats, toxicity
from emberlog.llm.common import read, stage
from emberlog.llm.queries import tokenizer_path
from emberlog.session import utc

#: The stages learn from labels and hash words, which SQL here can't restate; they are tested against brute force.
ORACLE_SQL = None


def _with_text(rows: DataFrame, docs: DataFrame, text: Column, changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row``, with a new text and its length where it changed."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.3).filter("predicted = 0").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines one stays in the corpus; documents keep their other lines."""
    done = lines.without_similar_lines(docs, min_words=5, least=0.8, short_copies=True)
    return _with_text(done, docs, F.col("text"), F.col("n_removed") > 0)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return jaccard.one_of_each(docs, width=5, threshold=0.8)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 35-word window that also occurs elsewhere go."""
    done = repeats.without_repeats(docs, window=35)
    return _with_text(done, docs, F.col("kept"), F.col("n_removed") > 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("passages", drop_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(utc(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
