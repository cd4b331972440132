"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

* ``quality_rules``: documents that the base rule or the learned decision list
  rejects go;
* ``near_duplicates``: one document of each class of similar texts stays, that
  of the least doc_id;
* ``decontamination``: documents that hold a benchmark window go;
* ``pii``: spans of personal data become their kind in brackets, ``n_chars`` follows;
* ``byte_bpe``: texts become token ids, of which counts and digests are returned.

Nulls, empty and very long texts and repeated rows have the results that the
operators define; rows equal in doc_id and text are one document from the second
stage on. An empty table passes through; other columns keep their names and
values, also where they are named like a result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from brindle.llm import byte_bpe, decontamination, jaccard_join, pii, quality_rules
from brindle.llm.common import dropped, staged, table


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` on ``docs`` whose other columns have names of their own meanwhile, so none can clash with its results."""
    names = docs.columns
    needed = {names.index(n) for n in ("doc_id", "text")}
    inner = [n if i in needed else f"_column{i}" for i, n in enumerate(names)]
    return stage(docs.toDF(*inner)).select(*inner).toDF(*names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return _apart(docs, lambda d: quality_rules.judge(d, labels).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, jaccard_join.one_of_each)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda d: decontamination.clean(d, benchmark))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns

    def mask(d: DataFrame) -> DataFrame:
        masked = pii.find(d).withColumn("text", pii.redacted())
        if "n_chars" not in names:
            return masked
        chars = d.columns[names.index("n_chars")]
        return masked.withColumn(chars, F.length(F.coalesce("text", F.lit(""))).cast(d.schema[chars].dataType))

    return _apart(docs, mask)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("byte_bpe", tokenize),
]

#: Learned rules, MinHash classes and token ids are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
            if k:
                dropped(before)
    return docs
