"""Proportional stratified interleaving: deal rows into shards that all match the source mixture.

Rows of each source are shuffled by a seeded hash and ranked; a row's key is its fractional
rank ``(2k - 1) / 2n`` within its source.  Sorted by that key, every stretch of the table holds
every source in proportion, so cutting it into equal row counts gives shards that match the
mixture (the ``rows`` law: shard sizes differ by one row at most).

Both ranks are distributed prefix sums: rows fall into order-preserving hash buckets (or key
ranges), bucket counts are summed in a small table, and ``row_number`` runs inside a bucket
only.  A source with a third of all rows is therefore split over many tasks.

Defined cases: null text has no bytes (size 16, checksum of the empty string); null sources
form a stratum of their own; null ids and repeated rows are ordinary rows (rows equal in id
and text are interchangeable); an empty table gives no rows; other columns are kept,
whatever their names; those named like a returned column give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import hash_bits, hash_bucket, packed, table, unpacked

N_SHARDS = 40


def interleave_shards(df: DataFrame, n_shards: int = N_SHARDS, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard to every row."""
    rows = df.count()
    bits = hash_bits(rows)
    ranges = 1 << bits
    text = F.coalesce(F.col(text_col), F.lit(""))
    own, columns = (id_col, text_col, source_col), df.columns
    base = packed(df, *own).withColumns(
        {
            "size": (F.octet_length(text) + 16).cast("long"),
            "text_crc32": F.crc32(text.cast("binary")),
            "__src": F.col(source_col),
            "__h": F.xxhash64(F.lit(seed), F.col(id_col), text),
        }
    )
    base = base.withColumn("__b", hash_bucket(F.col("__h"), bits))

    counts = base.groupBy("__src", "__b").agg(F.count("*").alias("__c"))
    by_source = W.partitionBy("__src")
    before = counts.select(
        F.col("__src").alias("__s1"),
        F.col("__b").alias("__b1"),
        F.coalesce(F.sum("__c").over(by_source.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.sum("__c").over(by_source).alias("__n"),
    )
    inside = W.partitionBy("__src", "__b").orderBy("__h", id_col, "text_crc32")
    ranked = (
        base.withColumn("__i", F.row_number().over(inside))
        .join(before, F.col("__src").eqNullSafe(F.col("__s1")) & (F.col("__b") == F.col("__b1")))
        .withColumn("__f", (2 * (F.col("__off") + F.col("__i")) - 1) / (2 * F.col("__n")))
        .withColumn("__r", F.floor(F.col("__f") * ranges).cast("int"))
    )
    totals = ranked.groupBy("__r").agg(F.count("*").alias("__c"))
    starts = totals.select(F.col("__r").alias("__r1"), F.coalesce(F.sum("__c").over(W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    place = W.partitionBy("__r").orderBy("__f", F.col("__src").asc_nulls_last(), "__h", id_col, "text_crc32")
    placed = (
        ranked.withColumn("__p", F.row_number().over(place))
        .join(starts, F.col("__r") == F.col("__r1"))
        .withColumn("__p", (F.col("__p") + F.col("__start") - 1).cast("long"))
        .withColumn("law", F.lit("rows"))
        .withColumn("shard", F.expr(f"int((__p * {n_shards}L) div {max(rows, 1)}L)"))
        # first position of a shard: the ceiling of shard * rows / shards
        .withColumn("slot", F.col("__p") - F.expr(f"(shard * {max(rows, 1)}L + {n_shards - 1}L) div {n_shards}L"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
    )
    return unpacked(placed, columns, own, ("size", "text_crc32", "law", "shard", "slot", "grown_shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return interleave_shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source")
