"""Shared helpers of the training-data operators: checkpoints, Arrow batches, sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..durable import ensure_checkpoints, kept, small_batches

__all__ = ["ensure_checkpoints", "kept", "small_batches"]

#: Words are runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over the whole table (one aggregate row comes back)."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def hash_bits(rows: int, per_bucket: int = 50_000) -> int:
    """Bits of a 64-bit hash that split ``rows`` into buckets of about ``per_bucket``."""
    return max(1, (max(rows, 1) // per_bucket).bit_length())


def hash_bucket(h, bits: int):
    """Order-preserving bucket of a signed 64-bit hash."""
    return F.shiftright(h, 64 - bits)


def packed(df: DataFrame, *own: str) -> DataFrame:
    """df with all columns but ``own`` in one struct ``__rest``: whatever their names, none can clash with an operator's."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in own]
    return df.select(*own, (F.struct(*rest) if rest else F.lit(None).cast("struct<none:int>")).alias("__rest"))


def unpacked(df: DataFrame, columns: list[str], own: tuple[str, ...], new: tuple[str, ...] = ()) -> DataFrame:
    """The columns as they were, in their order; those of ``new`` names give way to the operator's."""
    keep = [F.col(c) if c in own else F.col("__rest").getField(c).alias(c) for c in columns if c not in new]
    return df.select(*keep, *new)
