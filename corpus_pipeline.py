"""The corpus pipeline: documents through five of the training-data operators, each stage a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.bpe import digests, public_file
from tramline.llm.common import Scratch, table
from tramline.llm.mixture import mixed_texts
from tramline.llm.similar import keep_one_similar
from tramline.llm.substrings import dedup_texts
from tramline.llm.toxicity import without_toxic

#: In the mixture, no source is used more than this much more often than another.
REPEAT_MOST = 1.25
#: Words of a passage that goes wherever it recurs.
PASSAGE = 45


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null text is judged as empty text; null ids have no label."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more) stays.

    Texts without words (null, empty, blank) are one group. Null ids come last, so one stays only in a group without others.
    """
    return keep_one_similar(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE words that recur go from the texts, wherever they are; n_chars follows. No row goes; null text stays null."""
    out = dedup_texts(docs, PASSAGE, words=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once at least; those of small sources more often, within REPEAT_MOST. A null source is a source; empty texts are used once."""
    return mixed_texts(docs, repeat_most=REPEAT_MOST)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their number, and digests of the ids and of what they decode to. Null text has no ids."""
    return digests(docs, public_file(), ids=True)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mixing", mixing), ("bpe", bpe)]

#: No SQL can express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
