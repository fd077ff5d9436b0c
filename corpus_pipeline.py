"""Corpus preparation: toxicity, near-duplicates, benchmark leaks, source mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all
but the last return the columns of ``docs``, whatever these are named.  ``run`` chains them over
``documents``; each stage's rows are written once before the next one reads them.

Null texts are empty: never toxic, no near-duplicate of anything, no leak; size 0 in the mixture.
Null and repeated ids are ordinary rows.  Rows equal in all columns count as one near-duplicate
group.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from polyseg.llm.common import kept, packed, small_batches, table, unpacked
from polyseg.llm.decontamination import without_contamination
from polyseg.llm.minhash import without_near_duplicates
from polyseg.llm.mixing import expand_copies, mix_sources
from polyseg.llm.sharding import interleave_shards
from polyseg.llm.toxicity import fit_toxicity, severity_column, toxic_labels

#: Near-duplicates on five-word shingles: no contract says otherwise for the pipeline.
SIMILAR_PERCENT = 80
OWN = ("doc_id", "text", "source")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of a toxic grade stays under the fitted cut; all without any toxic label."""
    small_batches(spark)
    model = fit_toxicity(docs.select("doc_id", "text"), toxic_labels(spark, sf_dir))
    return docs.where(~severity_column(spark, model)(F.col("text"))["toxic"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, of smallest id; null and repeated ids lose only copies."""
    return without_near_duplicates(docs, SIMILAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contamination(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    mixed = mix_sources(packed(docs, *OWN))
    return unpacked(expand_copies(mixed, [*OWN, "__rest"]), docs.columns, OWN)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mixture."""
    return interleave_shards(docs.select(*OWN)).select("doc_id", "source", "size", "text_crc32", "law", "shard", "slot")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_leaks), ("mixing", mix), ("sharding", shard)]

#: The fitted model and the signatures have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
