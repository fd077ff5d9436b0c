"""Mixing sources to target weights by entropy balancing.

The dual of "least relative entropy subject to one token constraint per source" is convex and
separable: document d of source s gets the rate ``min(3, exp(lambda_s * size_d / scale))`` and
``lambda_s`` solves ``sum(rate * size) = target_s``.  Documents are first reduced to cells
(source, size, count), so an iteration touches cells, not documents; Newton steps (bisected
when they leave the bracket) run as one aggregate per iteration, checkpointed to cut lineage.

Rates become copies in two native steps.  Per source, cells in order of falling size take
``floor`` differences of the cumulative rate (so rounding errors alternate and cancel), then a
greedy fold over one cell per power of two of size (a short array) moves the words still owed.
A cell's copies are dealt to its documents by seeded hash rank; cells with more than
``SPLIT`` documents are ranked in hash buckets with prefix offsets, never in one task.

Sources are ordered by code point, null last, and weigh 1, 2, 3, repeating; targets share all
words by weight, stop at three times the source's own words, and the excess is reshared (water
filling in closed form: the level is the largest of the levels after each number of capped
sources).  The sources table has a row per source, and only it is ordered as a whole.

Defined cases: null text has size 0; documents of size 0 are taken 0 or 1 times with no effect
on words (they get rate 1 where their source has a positive target, else 0); null ids and
repeated rows are ordinary rows; an empty table gives no rows; a source without words has
target 0.  Extra columns are kept, whatever their names; those named like a returned column give
way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import WORD_RE, ensure_checkpoints, hash_bits, hash_bucket, packed, table, unpacked

MAX_COPIES = 3
SPLIT = 50_000
TOLERANCE = 1e-7
MAX_STEPS = 60


def source_targets(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """sizes(src, source_size) -> also weight and target, by closed-form water filling."""
    everything = W.partitionBy(F.lit(0))
    t = sizes.withColumn("weight", (F.row_number().over(everything.orderBy(F.col("src").asc_nulls_last())) - 1) % cycle + 1)
    t = t.withColumn("cap", F.col("source_size") * MAX_COPIES)
    tight = everything.orderBy(F.col("cap") / F.col("weight"), F.col("src").asc_nulls_last())
    t = t.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "capped": F.coalesce(F.sum("cap").over(tight.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weights": F.sum("weight").over(tight.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    t = t.withColumn("level", F.max((F.col("total") - F.col("capped")) / F.col("weights")).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return t.select("src", "source_size", "weight", target.alias("target"))


def solve_dual(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """lambda per source (src, source_size, target, lam, scale); null lam: all rates are at their bound."""
    x = F.col("size") / F.col("scale")
    shape = cells.where("size > 0").groupBy("src").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"), F.min("size").alias("least"))
    shape = shape.withColumnRenamed("src", "__src")
    # the bracket's other end: the smallest document alone would bring the rate past its goal
    goal = F.when(F.col("target") >= F.col("source_size"), F.log(F.lit(float(MAX_COPIES)))).otherwise(F.log(F.col("target") / F.col("source_size")))
    edge = goal * F.col("scale") / F.col("least")
    free = (F.col("target") > 0) & (F.col("target") < MAX_COPIES * F.col("source_size"))
    state = (
        targets.join(shape, F.col("src").eqNullSafe(F.col("__src")), "left")
        .drop("__src")
        .withColumns({"lam": F.when(free, F.lit(0.0)), "lo": F.when(free, F.least(edge, F.lit(0.0))), "hi": F.when(free, F.greatest(edge, F.lit(0.0)))})
        .drop("least")
        .checkpoint()
    )
    columns = state.columns
    for _ in range(MAX_STEPS):
        c = cells.where("size > 0").select(F.col("src").alias("__src"), "size", "n")
        rate = F.exp(F.col("lam") * x)
        words = F.col("n") * F.col("size")
        sums = (
            c.join(state, F.col("src").eqNullSafe(F.col("__src")))
            .where("lam is not null")
            .groupBy(F.col("__src"))
            .agg(F.sum(words * F.least(rate, F.lit(float(MAX_COPIES)))).alias("g"), F.sum(F.when(rate < MAX_COPIES, words * x * rate).otherwise(0.0)).alias("dg"))
        )
        off = F.col("g") - F.col("target")
        step = state.join(sums, F.col("src").eqNullSafe(F.col("__src")), "left").withColumns(
            {"err": F.coalesce(F.abs(off) / F.col("target"), F.lit(0.0)), "lo": F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))}
        )
        newton = F.col("lam") - off / F.nullif(F.col("dg"), F.lit(0.0))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        move = F.when(F.col("err") <= TOLERANCE, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        step = step.withColumn("lam", F.when(F.col("lam").isNotNull(), move)).select(*columns, "err").checkpoint()
        state = step.select(*columns)
        if (step.agg(F.max("err")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state


def cell_copies(cells: DataFrame, state: DataFrame) -> DataFrame:
    """Whole copies per cell: cells plus source_size, target and copies (for the cell together)."""
    s = state.withColumnRenamed("src", "__src")
    full = F.when(F.col("target") > 0, F.lit(float(MAX_COPIES))).otherwise(F.lit(0.0))
    rate = F.when(F.col("size") == 0, F.when(F.col("target") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).when(F.col("lam").isNull(), full)
    rate = rate.otherwise(F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("lam") * F.col("size") / F.col("scale"))))
    c = cells.join(s, F.col("src").eqNullSafe(F.col("__src"))).withColumn("rate", rate)
    falling = W.partitionBy("src").orderBy(F.col("size").desc())
    c = c.withColumn("upto", F.floor(F.sum(F.col("n") * F.col("rate")).over(falling) + 0.5 + 1e-9))
    c = c.withColumn("copies", F.least(F.greatest(F.col("upto") - F.lag("upto", 1, 0).over(falling), F.lit(0)), MAX_COPIES * F.col("n")))
    c = c.withColumn("class", F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))))
    c = c.select("src", "size", "n", "source_size", "target", "copies", "class")
    owed = c.groupBy(F.col("src").alias("__s")).agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("owed"))
    pick = c.where("size > 0").groupBy("src", "class").agg(F.max_by(F.struct("size", "n", "copies"), F.struct("n", "size")).alias("p"))
    ladder = pick.groupBy("src").agg(F.reverse(F.array_sort(F.collect_list("p"))).alias("ladder"))
    fold = """aggregate(ladder, struct(round(owed) AS left, array() :: array<struct<size:bigint,add:bigint>> AS adds), (a, p) -> struct(
        a.left - q(a.left, p) * p.size AS left, concat(a.adds, array(struct(p.size AS size, q(a.left, p) AS add))) AS adds))"""
    q = f"(CASE WHEN a.left >= 0 THEN least(bigint(floor(a.left / p.size)), {MAX_COPIES} * p.n - p.copies) ELSE -least(bigint(floor(-a.left / p.size)), p.copies) END)"
    fold = fold.replace("q(a.left, p)", q).replace("array() :: array<struct<size:bigint,add:bigint>>", "cast(array() AS array<struct<size:bigint,add:bigint>>)")
    adds = (
        ladder.join(owed, F.col("src").eqNullSafe(F.col("__s")))
        .select("src", F.explode(F.expr(fold)["adds"]).alias("a"))
        .select(F.col("src").alias("__s"), F.col("a.size").alias("__z"), F.col("a.add").alias("add"))
    )
    out = c.join(adds, F.col("src").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")), "left")
    return out.select("src", "size", "n", "source_size", "target", (F.col("copies") + F.coalesce("add", F.lit(0))).cast("long").alias("copies"))


def mix_sources(df: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Add size, source_size, target, copies and taken to every row of ``df``."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    own, columns = (id_col, text_col, source_col), df.columns
    df = packed(df, *own)
    count = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)), F.lit(0)).cast("long")
    sized = df.withColumns({"size": count, "__src": F.col(source_col)})
    cells = sized.groupBy(F.col("__src").alias("src"), "size").agg(F.count("*").alias("n")).checkpoint()
    targets = source_targets(cells.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    plan = cell_copies(cells, solve_dual(cells, targets)).checkpoint()
    rows = cells.agg(F.sum("n")).first()[0] or 0
    bits = hash_bits(rows, SPLIT)

    cell = plan.select(F.col("src").alias("__s"), F.col("size").alias("__z"), F.col("n").alias("__n"), "source_size", "target", F.col("copies").alias("__k"))
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = (
        sized.withColumn("__h", F.xxhash64(F.lit(seed), F.col(id_col), text_key))
        .join(cell, F.col("__src").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")))
        .withColumn("__b", F.when(F.col("__n") > SPLIT, hash_bucket(F.col("__h"), bits)).otherwise(F.lit(0).cast("long")))
    )
    rank = F.row_number().over(W.partitionBy("__src", "size", "__b").orderBy("__h", id_col))
    ranked = keyed.withColumn("__i", rank.cast("long"))
    if plan.where(F.col("n") > SPLIT).limit(1).count():
        big = keyed.where(F.col("__n") > SPLIT).groupBy("__src", "size", "__b").agg(F.count("*").alias("__c"))
        before = F.sum("__c").over(W.partitionBy("__src", "size").orderBy("__b").rowsBetween(W.unboundedPreceding, -1))
        offsets = big.select(F.col("__src").alias("__s2"), F.col("size").alias("__z2"), F.col("__b").alias("__b2"), F.coalesce(before, F.lit(0)).alias("__off"))
        same = F.col("__src").eqNullSafe(F.col("__s2")) & (F.col("size") == F.col("__z2")) & (F.col("__b") == F.col("__b2")) & (F.col("__n") > SPLIT)
        ranked = ranked.join(offsets, same, "left").withColumn("__i", F.col("__i") + F.coalesce("__off", F.lit(0))).drop("__s2", "__z2", "__b2", "__off")
    copies = F.expr("__k div __n + if(__i <= __k % __n, 1, 0)").cast("int")
    return unpacked(ranked.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")), columns, own, ("size", "source_size", "target", "copies", "taken"))


def expand_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each row as often as it has copies (at most three)."""
    return mixed.where("copies > 0").withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
