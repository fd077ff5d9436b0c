"""Near-duplicate groups by SuperMinHash, banding, full verification and union-find.

Signatures.  Every shingle draws, step by step, one entry of a random permutation of the slots
(Fisher-Yates) and the value ``step + uniform``; a slot keeps its minimum.  The draws of one
element are thus correlated permutation ranks, which gives less variance than independent
hashes, and a row stops as soon as every slot holds a value below the next step.  Here the step
is the top byte of a 64-bit value, so a slot's minimum is one integer minimum, and steps run in
numpy over all rows of a batch that have not stopped.

Linking.  Rows are first reduced to classes with the same word sequence (a third of all rows
may be one text).  Classes meet in 24 bands of 4 slots: a pair with similarity 0.85 misses all
bands with probability under 3e-8 (at 0.80, the pipeline's threshold: 3e-6).  Within a bucket no list of pairs is made: a hub (the member
whose buckets are largest, usually the text the others were copied from) is compared with the
rest, verified links are joined, and only buckets that still hold several components go on;
after ``STAR_ROUNDS`` such rounds the remaining members of different components are compared
exhaustively and exactly, block against block of what their buckets connect (pairs that meet in
a band), and only a forest of the links found leaves a task.  Every link that
counts is confirmed on the full shingle sets: ``100 * |A & B| >= percent * |A | B|``.
Components come from randomised contraction of the graph of verified links (checkpointed each
round) until ``TAIL`` links are left, which one task joins by union-find.

Sets hold 64-bit shingle hashes; two different shingles of a pair of documents collide with
probability below 1e-9 even at 100,000 words each.

Defined cases: null or blank text has an empty set and is linked with nothing; fewer than five
words are one shingle; vertices are the classes (63 bits of their hash), so rows with a null id
and rows that share an id but not a text are linked by their own texts; a component's id is the
smallest id in it, null if it has none; an empty table gives no rows; extra columns are ignored here.
"""

from __future__ import annotations

import contextlib
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import ensure_checkpoints, small_batches, table
from .textbatch import U, distinct, mix64, pieces, shingles, word_hashes, words

SLOTS, ROWS_PER_BAND = 96, 4
BANDS = SLOTS // ROWS_PER_BAND
WORDS, PERCENT = 5, 85
STAR_ROUNDS = 2
BLOCK = 1024
ROUND_ROWS = 1_000_000  # links a task of a component round takes (16 bytes each)
TAIL = 16_384  # links that one task finishes


def superminhash(g: np.ndarray, off: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """Signatures (rows, m) of rows of distinct 64-bit hashes; rows without hashes are all ones."""
    n_rows = len(off) - 1
    sig = np.full((n_rows, m), np.iinfo(np.uint64).max, U)
    flat = sig.reshape(-1)
    live_rows = np.flatnonzero(np.diff(off) > 0)
    row = np.repeat(np.arange(n_rows), np.diff(off))
    x, r = g, row
    perm = None
    with np.errstate(over="ignore"):
        for j in range(m):
            if not len(x):
                break
            d = mix64(x + U(2 * j + 1) * U(0x9E3779B97F4A7C15))
            k = j + ((d >> U(32)) * U(m - j) >> U(32)).astype(np.int64)
            value = (U(j) << U(56)) | (mix64(d + U(0x632BE59BD9B4E019)) >> U(8))
            if j == 0:
                slot = k
            else:
                lines = np.arange(len(x))
                slot = perm[lines, k].astype(np.int64)
                perm[lines, k] = perm[lines, j]
            np.minimum.at(flat, r * m + slot, value)
            done = (sig[live_rows].max(axis=1) >> U(56)) <= U(j)
            live = np.zeros(n_rows, bool)
            live_rows = live_rows[~done]
            live[live_rows] = True
            keep = live[r]
            if j == 0:  # most rows have stopped: only now is a permutation per element kept
                x, r, k = x[keep], r[keep], k[keep]
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
                perm[np.arange(len(x)), k] = 0
            elif not keep.all():
                x, r, perm = x[keep], r[keep], perm[keep]
    return sig


def word_sequences(column: pa.Array, piece: int = 1_000_000):
    """(first row, word hashes, row offsets, 16-byte class keys) of pieces of a text column."""
    for first, n, data, off in pieces(column, piece):
        s, e, wo = words(data, off)
        h = word_hashes(data, s, e)
        raw, at = h.tobytes(), (8 * wo).tolist()
        keys = [hashlib.blake2b(raw[at[i] : at[i + 1]], digest_size=16).digest() if at[i + 1] > at[i] else None for i in range(n)]
        yield first, h, wo, keys


def shingle_sets(column: pa.Array, k: int = WORDS, piece: int = 1_000_000):
    """(first row, sorted distinct hashes, row offsets, 16-byte class keys) of pieces of a text column."""
    for first, h, wo, keys in word_sequences(column, piece):
        g, r = shingles(h, wo, k)
        yield first, *distinct(g, r, len(keys)), keys


def _vertices(keys: list) -> pa.Array:
    return pa.array([None if k is None else int.from_bytes(k[:8], "little") >> 1 for k in keys], pa.int64())


def _class_rows(*carried: str):
    """Carried columns and the class of each row."""

    def run(batches):
        for b in batches:
            for first, _, _, keys in word_sequences(b.column("text")):
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(first, len(keys)) for c in carried), _vertices(keys)], [*carried, "v"])

    return run


def _sized_rows(batches):
    """The size of the set and the class of each row."""
    for b in batches:
        for first, _, so, keys in shingle_sets(b.column("text")):
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, len(keys)), pa.array(np.diff(so), pa.int64()), _vertices(keys)], ["doc_id", "n_shingles", "v"])


def _band_rows(batches):
    for b in batches:
        for first, g, so, keys in shingle_sets(b.column("text")):
            sig = superminhash(g, so)
            at = np.flatnonzero(np.diff(so) > 0)
            ids = b.column("doc_id").slice(first, len(keys)).take(pa.array(at))
            with np.errstate(over="ignore"):
                bands = sig[at].reshape(-1, BANDS, ROWS_PER_BAND)
                key = np.zeros((len(at), BANDS), U)
                for i in range(ROWS_PER_BAND):
                    key = mix64(key * U(0x100000001B3) + bands[:, :, i])
                key = mix64(key + np.arange(BANDS, dtype=U) * U(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(so)[at], pa.int64()), pa.array(list(key.view(np.int64)), pa.list_(pa.int64()))],
                ["doc_id", "n", "bands"],
            )


def _set_rows(batches):
    for b in batches:
        for first, g, so, keys in shingle_sets(b.column("text")):
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, len(keys)), pa.array([g[so[i] : so[i + 1]].tobytes() for i in range(len(keys))], pa.binary())], ["doc_id", "shingles"])


def _verify(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                p, q = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            at = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("ca").filter(at), b.column("cb").filter(at)], ["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components ca, cb of the pairs (a, b, ca, cb) whose full sets are similar enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("ca", "cb", "x", "y").mapInArrow(_verify(percent), "a long, b long")


def components(edges: DataFrame, tail: int = TAIL) -> DataFrame:
    """(v, c): the smallest vertex reachable, for every vertex of an edge (a, b), by randomised contraction.

    In every round each vertex moves to the one of least hash among itself and its neighbours (another hash each
    round), and the links are carried over to where their ends went; links inside one vertex vanish.  A round leaves
    at most three quarters of the vertices in expectation, a star is one vertex after one or two rounds, and so all
    rounds together handle a small multiple of the links instead of links times rounds.  The last ``tail`` links, a
    constant number, are finished by union-find in one task.
    """
    spark = edges.sparkSession
    # checkpoints carry the constraints of the plans they cut, which multiply from round to round in the driver
    with settings(spark, {"spark.sql.constraintPropagation.enabled": "false"}):
        links = _undirected(edges, "a", "b").checkpoint()
        # tasks by the number of links; replanning only where a hub's links may need splitting, as it fills the driver
        tasks = -(-links.count() // ROUND_ROWS)
        own = {"spark.sql.adaptive.enabled": str(tasks > 1).lower(), "spark.sql.shuffle.partitions": str(max(spark.sparkContext.defaultParallelism, tasks))}
        with settings(spark, own):
            return _contracted(links, tail)


@contextlib.contextmanager
def settings(spark: SparkSession, own: dict[str, str]):
    before = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _undirected(links: DataFrame, x: str, y: str) -> DataFrame:
    return links.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()


def _smallest(batches):
    """(v, r): the smallest vertex reachable over the links of one task."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(root, pa.int64()), pa.array([find(x) for x in root], pa.int64())], ["v", "r"])


def _contracted(links: DataFrame, tail: int) -> DataFrame:
    moves = []
    while links.count() > tail:
        rank = lambda v, turn=len(moves): F.xxhash64(F.lit(turn), v)
        ends = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(links.select(F.col("b").alias("v"), F.col("a").alias("u")))
        near = ends.withColumn("h", rank("u")).groupBy("v").agg(F.min_by("u", "h").alias("u"), F.min("h").alias("h"))
        move = near.select("v", F.when(rank("v") < F.col("h"), F.col("v")).otherwise(F.col("u")).alias("r")).checkpoint()
        moves.append(move)
        links = links.join(move.select(F.col("v").alias("a"), F.col("r").alias("x")), "a").join(move.select(F.col("v").alias("b"), F.col("r").alias("y")), "b")
        links = _undirected(links, "x", "y").checkpoint()
    moves.append(links.coalesce(1).mapInArrow(_smallest, "v long, r long"))
    whole = moves.pop()
    while moves:  # from the last, smallest round back to the first
        whole = moves.pop().join(whole.select(F.col("v").alias("r"), F.col("r").alias("to")), "r", "left").select("v", F.coalesce("to", "r").alias("r"))
    whole = whole.checkpoint()
    return whole.join(whole.groupBy("r").agg(F.min("v").alias("c")), "r").select("v", "c").checkpoint()


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (v, c) after links between components: only the components' own graph is searched."""
    new = components(links)
    if labels is None:
        return new
    moved = labels.join(new.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left").select("v", F.coalesce("to", "c").alias("c"))
    return moved.union(new.join(labels.select("v"), "v", "left_anti")).checkpoint()


def _block_edges(percent: int):
    """Links between components of members of two blocks of a candidate group: exact, and only a forest of them."""

    def run(key, left, right):
        import pandas as pd

        a, b = [], []
        if len(left) and len(right):
            local = [np.frombuffer(x, U) for x in (*left["shingles"], *right["shingles"])]
            _, flat = np.unique(np.concatenate(local), return_inverse=True)
            start = np.concatenate([[0], np.cumsum([len(x) for x in local])])
            cut = start[len(left)]
            other, edge = flat[cut:], start[len(left) : -1] - cut
            held = np.zeros(int(flat.max()) + 1, bool)
            bands = np.stack(right["bands"].to_numpy())
            label, size = right["c"].to_numpy(), right["n"].to_numpy()
            root = {c: c for c in {*left["c"], *label}}

            def find(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            for i, (n, c, own) in enumerate(zip(left["n"], left["c"], left["bands"], strict=True)):
                near = (label != c) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n))
                near[near] = (bands[near] == np.asarray(own)).any(axis=1)
                if not near.any():
                    continue
                held[flat[start[i] : start[i + 1]]] = True
                both = np.add.reduceat(held[other].astype(np.int64), edge)
                held[flat[start[i] : start[i + 1]]] = False
                for j in np.flatnonzero(near & (100 * both >= percent * (size + n - both))):
                    x, y = find(c), find(label[j])
                    if x != y:
                        root[x] = y
                        a.append(c)
                        b.append(label[j])
        return pd.DataFrame({"a": a, "b": b}).astype("int64")

    return run


def near_components(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(v, c) for the rows of classes(doc_id, text), distinct word sequences, that have a link."""
    low, most = F.least("n", "hub_n"), F.greatest("n", "hub_n")
    banded = classes.mapInArrow(_band_rows, "doc_id long, n long, bands array<long>")
    member = banded.select("doc_id", "n", F.posexplode("bands").alias("band", "key"))
    big = member.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    member = member.join(big, ["band", "key"]).checkpoint()
    popular = member.groupBy("doc_id").agg(F.sum("size").alias("pop"))
    member = member.join(popular, "doc_id").select("band", "key", "doc_id", "n", "pop").checkpoint()
    near_ids = member.select("doc_id").distinct()
    sets = classes.join(near_ids, "doc_id", "left_semi").mapInArrow(_set_rows, "doc_id long, shingles binary").checkpoint()

    labels = None
    rest = member.withColumn("c", F.col("doc_id"))
    for step in range(STAR_ROUNDS):
        hub = rest.groupBy("band", "key").agg(F.max_by(F.struct("doc_id", "n", "c"), F.struct("pop", -F.col("doc_id"))).alias("h"))
        hub = hub.select("band", "key", F.col("h.doc_id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.c").alias("hub_c"))
        met = rest.join(hub, ["band", "key"])
        pairs = met.where((F.col("c") != F.col("hub_c")) & (100 * low >= percent * most))
        one, two = F.struct("doc_id", "c"), F.struct(F.col("hub").alias("doc_id"), F.col("hub_c").alias("c"))
        pairs = pairs.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
        pairs = pairs.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"), F.col("a.c").alias("ca"), F.col("b.c").alias("cb")).distinct()
        labels = merged(labels, verified(pairs, sets, percent).distinct().checkpoint())
        # what is left of a bucket: its members without this hub, where they are of several components
        rest = met.where("doc_id != hub").select("band", "key", "doc_id", "n", "pop").join(labels, F.col("doc_id") == F.col("v"), "left")
        rest = rest.withColumn("c", F.coalesce("c", "doc_id")).drop("v")
        mixed = rest.groupBy("band", "key").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 < c2").select("band", "key")
        rest = rest.join(mixed, ["band", "key"], "left_semi").checkpoint()
        if not rest.limit(1).count():
            return labels
    # the exact way for the rest: members that buckets connect, block against block
    first = rest.groupBy("band", "key").agg(F.min("doc_id").alias("a"))
    group = components(rest.join(first, ["band", "key"]).select("a", F.col("doc_id").alias("b")).distinct())
    few = rest.select("doc_id", "n", "c").distinct().join(group.select(F.col("v").alias("doc_id"), F.col("c").alias("g")), "doc_id")
    size = few.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    bands = classes.join(few.select("doc_id"), "doc_id", "left_semi").mapInArrow(_band_rows, banded.schema).select("doc_id", "bands")
    rows = few.join(size, "g").join(bands, "doc_id").join(sets, "doc_id")
    rows = rows.withColumn("i", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    left = rows.withColumn("j", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)))
    right = rows.withColumn("j", F.col("i")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j"))))
    keys = ["g", "i", "j"]
    columns = [*keys, "doc_id", "n", "c", "bands", "shingles"]
    left, right = (x.select(*(F.col(c).alias(c) for c in columns)).groupBy(*keys) for x in (left, right))
    found = left.cogroup(right).applyInPandas(_block_edges(percent), "a long, b long").checkpoint()
    return merged(labels, found)


def class_components(docs: DataFrame, percent: int) -> DataFrame:
    """(v, c) for the classes of docs(text) that have a link."""
    texts = docs.select("text").mapInArrow(_class_rows("text"), "text string, v long").where("v is not null")
    return near_components(texts.groupBy(F.col("v").alias("doc_id")).agg(F.min("text").alias("text")), percent)


def near_duplicates(df: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``df``."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    small_batches(spark)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = docs.mapInArrow(_sized_rows, "doc_id long, n_shingles long, v long").checkpoint()
    first = keyed.where("v is not null").groupBy("v").agg(F.min("doc_id").alias("rep"))
    label = first.join(class_components(docs, percent), "v", "left").withColumn("c", F.coalesce("c", "v"))
    smallest = label.groupBy("c").agg(F.min("rep").alias("component_id"))
    out = keyed.join(label.join(smallest, "c").select("v", "component_id"), "v", "left")
    out = out.withColumn("component_id", F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(df: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` per component, of smallest id (null last); rows without words are all kept."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    small_batches(spark)
    blank = F.coalesce(F.col(text_col), F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z")
    worded, row = df.where(~blank), [F.xxhash64(F.lit(k), *(F.col(f"`{c}`") for c in df.columns)) for k in (1, 2)]
    docs = worded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row[0].alias("row"), row[1].alias("row2"))
    keyed = docs.mapInArrow(_class_rows("doc_id", "row", "row2"), "doc_id long, row long, row2 long, v long").checkpoint()
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "row2")).alias("best")
    label = keyed.groupBy("v").agg(best).join(class_components(docs, percent), "v", "left")
    best = label.groupBy(F.coalesce("c", "v").alias("c")).agg(F.min("best").alias("best")).select(F.col("best.row").alias("r1"), F.col("best.row2").alias("r2"))
    # rows equal in all columns are one: the columns in a struct, so that none can clash with the keys
    rows = worded.select(row[0].alias("r1"), row[1].alias("r2"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("whole"))
    return rows.join(best.distinct(), ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).select("whole.*").unionByName(df.where(blank))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
