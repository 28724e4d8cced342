"""From raw documents to packed sequences: five stages, each of them one corpus operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import importance, packing, repetition, shingles, suffix
from millrace.llm.common import discard, written
from millrace.llm.queries import table, tokenizer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps.

    Null and empty texts weigh 0 and take part in the draw; rows without an id stay; repeated rows stay or go together, and of
    other ties the smaller id stays; very long texts are weighed whole; an empty table stays empty; columns of any name stay.
    """
    return importance.accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules.

    Null and empty texts have no word and go; ids play no part, so rows without one are judged like others; repeated rows fare
    alike; a share at its limit passes; very long texts are measured whole; an empty table stays empty; columns of any name stay.
    """
    return docs.where(repetition.passes("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles have a Jaccard similarity of at least 0.8.

    Tries of SimHash fingerprints and, beyond their radius, MinHash buckets find the candidates; stars are contracted; shingles decide.
    Texts without a word are one component; rows without an id stay; repeated rows of a kept id stay together; a pair at exactly
    0.8 is linked; very long texts are compared whole; an empty table stays empty; columns of any name stay.
    """
    return shingles.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes or more that an earlier one has; n_chars follows.

    Null texts become empty; rows without an id stay whole; rows of one id don't cut each other; characters that a cut splits go
    whole; very long texts are read whole; an empty table stays empty; other columns stay as they are, whatever their names.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = suffix.cut_spans(docs, keep_text=True, carry=others)
    named = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")} | {c: F.col(f"carry{i}") for i, c in enumerate(others)}
    if "n_chars" in others:
        named["n_chars"] = F.length("kept_text").cast(dict(docs.dtypes)["n_chars"])
    return cut.select(*(named[c].alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids.

    Null and empty texts are their end id; rows without an id and repeated rows are packed like others; very long texts are cut
    over several sequences; ties are ``packing.pack``'s; an empty table gives no piece; other columns are not read.
    """
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-dedup", near_duplicates),
    ("suffix-array dedup", substring_dedup),
    ("packing", packing_stage),
]

#: Hashes of word shingles, resampling and suffix arrays have no SQL form; tests hold both dedup stages against brute force, the others by their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written and read again; a stage's table goes as soon as the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            discard(spark, before)
        before = path
    return docs
