"""The corpus pipeline: `documents` to token ids.

Quality rules, exact de-duplication, near de-duplication, mixing of sources, encoding. Every stage takes all that the
one before kept, as a written table; all but the last return the columns of the input, whatever those are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import session
from tidemark.llm import bpe, common, exact_dedup, mixing, ngram_join, quality_rules

USED = ("doc_id", "text", "lang", "source")


_LEFT: list[str] = []


def _tidy(spark: SparkSession, docs: DataFrame) -> None:
    """Remove what earlier stages had staged: their results are written by now, unless `docs` still reads from it."""
    names = [p.rsplit("/", 1)[-1] for p in _LEFT]
    if names and not any(n in f for f in docs.inputFiles() for n in names):
        common.remove(spark, *_LEFT)
        _LEFT.clear()


def _filtered(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on `docs`, with columns it does not use under names that clash with nothing, and the same columns after."""
    spark = common.tune(docs.sparkSession)
    _tidy(spark, docs)
    inner = {c: c if c in USED else f"_column_{k}" for k, c in enumerate(docs.columns)}
    before = set(common.staged_paths(spark))
    out = work(docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in docs.columns]))
    _LEFT.extend(p for p in common.staged_paths(spark) if p not in before)
    return out.select(*[F.col(inner[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility rules reject go."""
    return _filtered(docs, lambda d: quality_rules.quality_rules(d).where("kept"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest doc_id."""
    return _filtered(docs, exact_dedup.keep_first)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 or more of their shingles of five words stays, that of the smallest doc_id."""
    return _filtered(docs, lambda d: ngram_join.keep_one(d, n=5, percent=80))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in global random order."""
    return _filtered(docs, mixing.mix_sources)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in place of its text."""
    _tidy(common.tune(spark), docs)
    return bpe.encode_texts(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies), ("mixing", mix), ("bpe_encoding", encode)]
ORACLE_SQL = None  # no SQL for fertility; tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet below the shared folder and read by the next."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = session.scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
