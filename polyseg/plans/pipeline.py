"""The whole flow over a source tree: scan, extract, move, translate, splice, switch, check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..durable import kept
from ..functions.text import has_script
from ..operators import checks, extract, memory, rewrite
from ..sources import readers


def documents(tree: DataFrame, rewritten: DataFrame, moves: DataFrame) -> DataFrame:
    """tree(file, text) with the rewritten files in place, then moved, then with switchers."""
    new = tree.join(rewritten.select("file", F.col("content").cast("string").alias("spliced")), "file", "left")
    placed = rewrite.apply_moves(new.select("file", F.coalesce("spliced", "text").alias("text")), moves)
    switched = rewrite.switchers(placed).withColumnRenamed("text", "switched")
    return placed.join(switched, "file", "left").select("file", F.coalesce("switched", "text").alias("text"))


def verify(spark: SparkSession, root: str) -> DataFrame:
    """Findings of the tree as it stands."""
    tree = readers.scan_files(spark, root).select("file", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    return checks.gate(tree, readers.scan_markdown(spark, root), tree.select("file"))


def run(spark: SparkSession, root: str, known: DataFrame, engines: list, dry_run: bool = False) -> dict[str, DataFrame]:
    """Every step as a DataFrame over an immutable snapshot of the tree; nothing is written there.

    Spans, the memory and the resulting files are computed once, whichever results are used: every
    engine sees a segment once.  A dry run plans the moves and translates nothing.
    """
    tree = readers.scan_files(spark, root).select("file", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    moves = kept(rewrite.plan_moves(tree.select("file", has_script(F.col("text")).alias("has_script"))))
    if dry_run:
        return {"moves": moves}
    files = readers.scan_translatable(spark, root)
    spans = kept(extract.extract(files))
    occurrences = extract.occurrences(spans)
    segments = memory.distinct_segments(spans)
    updated = kept(memory.upsert(known, memory.chain(memory.pending(segments, known), engines).withColumn("seq", F.lit(0))))
    rewritten = kept(rewrite.splice(files, occurrences, updated).where("n > 0"))
    final = kept(documents(tree, rewritten, moves))
    markdown = final.where(F.col("file").endswith(".md"))
    before = tree.join(final.withColumnRenamed("text", "after"), "file").select("file", F.col("text").alias("before"), "after")
    findings = checks.gate(final, markdown, final.select("file"), before)
    return {"occurrences": occurrences, "segments": segments, "memory": updated, "moves": moves, "rewritten": rewritten.select("file", F.col("content").cast("string").alias("text"), "n"), "files": final, "findings": findings}
