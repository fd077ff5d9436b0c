"""Inputs and outputs: source trees, occurrence and memory files, dictionary, glossary, findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import has_script, norm
from ..operators.classify import is_translatable, language

OCCURRENCES = "file string, start int, end int, h string, kind string"
MEMORY = "h string, src string, en string, engine string"
FINDINGS = "check string, file string, detail string, n bigint"


def _tree(spark: SparkSession, root: str, glob: str | None, wanted) -> DataFrame:
    """(file, content): files whose path below root is ``wanted``; paths are judged while listing, so no other file is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file = F.regexp_replace(path, rf"^.*?\Q{root.rstrip('/')}\E/", "")
    files = reader.load(root)
    return (files if wanted is None else files.where(wanted(file))).select(file.alias("file"), "content")


def scan_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """files(file, content): every file below root, path relative to it."""
    return _tree(spark, root, glob, None)


def scan_translatable(spark: SparkSession, root: str) -> DataFrame:
    """files(file, content, text, lang): translatable paths with valid UTF-8 that hold the script."""
    files = _tree(spark, root, None, is_translatable)
    files = files.withColumn("text", F.try_validate_utf8(F.col("content").cast("string"))).where(F.col("text").isNotNull())
    return files.where(has_script(F.col("text"))).withColumn("lang", language(F.col("file")))


def _visible(file: Column) -> Column:
    return ~F.arrays_overlap(F.split(file, "/"), F.array(F.lit(".git"), F.lit("node_modules")))


def scan_markdown(spark: SparkSession, root: str) -> DataFrame:
    """(file, text) of every markdown file outside version control and installed packages."""
    return _tree(spark, root, "*.md", _visible).select("file", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, at): lines with a key that orders them by file, then by place in it, however a file is split."""
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return spark.read.text(path).select("value", at.alias("at"))


def readme_folders(files: DataFrame) -> DataFrame:
    folder = F.regexp_replace(F.col("file"), "[^/]*$", "")
    return files.where(_visible(F.col("file")) & F.col("file").rlike(r"(^|/)README[^/]*\.md$")).select(folder.alias("folder")).distinct()


def read_occurrences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OCCURRENCES).json(path).withColumn("kind", F.coalesce("kind", F.lit("comment")))


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """The last record of a key wins; order is file position."""
    lines = _lines(spark, path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", MEMORY).alias("r"), "at").select("r.*", "at")
    return rows.groupBy("h").agg(F.max_by(F.struct("src", "en", "engine"), "at").alias("r")).select("h", "r.*")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return parse_dictionary(_lines(spark, path))


def parse_dictionary(lines: DataFrame) -> DataFrame:
    """lines(value, at) -> (src_norm, en): comments and lines without a tab skipped, last duplicate wins."""
    part = F.split("value", "\t", 2)
    good = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#") & F.col("value").contains("\t"))
    rows = good.select(norm(part[0]).alias("src_norm"), F.trim(part[1]).alias("en"), "at")
    return rows.groupBy("src_norm").agg(F.max_by("en", "at").alias("en"))


def read_glossary(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A short list of terms, for the driver."""
    rows = spark.read.text(path).select(F.trim("value").alias("t")).where((F.col("t") != "") & ~F.col("t").startswith("#")).distinct().collect()
    return tuple(sorted(r["t"] for r in rows))


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FINDINGS).json(path)


def write_records(df: DataFrame, path: str) -> None:
    """Occurrences, findings and rewritten files: JSON lines, non-ASCII kept."""
    df.write.mode("overwrite").json(path)


def write_memory(memory: DataFrame, path: str) -> None:
    """Range-partitioned and sorted by key: part files in order are the sorted file."""
    memory.select("h", "src", "en", "engine").repartitionByRange("h").sortWithinPartitions("h").write.mode("overwrite").json(path)
