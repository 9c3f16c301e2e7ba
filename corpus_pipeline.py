"""Corpus pipeline: five stages from raw documents to token ids.

Each stage reads what the one before has written - so a stage may delete the
scratch tables of the stages before it - and its decisions take effect: quality rules drop rejected documents, the n-gram Jaccard join leaves
one document of each group, substring dedup cuts repeated sentences, benchmark
decontamination drops documents that hold benchmark passages, and BPE encodes
what is left. All stages but the last return the columns of documents.

Nulls and repeated rows are treated as each operator's docstring says; extra
columns of documents pass through the first four stages. Where a text changes,
``n_chars`` follows it if the table has that column.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import bpe, decontaminate, jaccard_join, quality, substring_dedup
from txrisk.llm.common import beside, discard, held, quoted, release, stored

#: No SQL: stages 2, 3 and 5 hash, train or encode; tests hold the rows against brute force.
ORACLE_SQL = None


#: Scratch tables behind the result of the stage called last, until the next is called.
_behind: list[str] = []


def _stage(function):
    """A stage: its predecessor's result has been written, so the tables behind that go first."""
    @functools.wraps(function)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _behind)
        before = set(held())
        out = function(spark, docs, sf_dir)
        _behind[:] = [x for x in held() if x not in before]
        return out
    return call


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct beside the columns that operators read, so that no name can clash."""
    given = {c.lower(): c for c in docs.columns}
    read = [(quoted(given[c]) if c in given else F.lit(None).cast("string")).alias(c)
            for c in ("doc_id", "text", "lang")]
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("document"), *read)


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*beside("document", docs.columns, []))


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return _back(quality.judged(_rows(docs), keep=["document"]).where("kept"), docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group."""
    return _back(jaccard_join.join_classes(_rows(docs), keep=["document"]).where("is_first"), docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without sentences of repeated passages."""
    found = substring_dedup.dedup(_rows(docs), keep=["document"])
    out = []
    for c in docs.columns:
        old = F.col("document").getField(c)
        if c.lower() == "text":
            out.append(F.when(old.isNotNull(), F.col("clean")).alias(c))
        elif c.lower() == "n_chars":
            out.append(F.when(F.col("n_removed") > 0, F.length("clean")).otherwise(old)
                       .cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(old.alias(c))
    return found.select(*out)


@_stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _back(decontaminate.leaks(_rows(docs), bench, keep=["document"]).where("n_hit = 0"), docs)


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of ids and decoded text of each document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_and_decode(_rows(docs), path, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.digests(encoded, "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        given, docs = docs, stored(stage(spark, docs, sf_dir), "stage")
        if k:
            discard(given)
    release(spark, _behind)
    return docs
