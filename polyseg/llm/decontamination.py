"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

The index holds an inverted list per term of the items: item numbers in order with their impacts,
the list's largest impact, and the largest one in each block of ``BLOCK`` items.  Block-max WAND
runs per passage: cursors of the passage's terms are kept in order of their items; the pivot is
the first item at which the summed list maxima reach the smallest threshold; if the block maxima
around it can't reach the block's smallest threshold, the cursors skip to the block's end, else
they move up to the pivot and the item is scored in full.  A batch's passages first meet one
bound by matrix operations: the sums of their block maxima, which most passages fail.

An item is retrieved where its BM25 score reaches ``SHARE`` of the score it gives its own text,
and there is no cut-off by rank: all above the threshold go on.  A retrieved passage counts only
if it holds at least ``OVERLAP`` of the five-word shingles of the item's question and as much of
its answer (the last sentence, or the second half of a single sentence).  Passages are windows of
twice the longest item's words, half overlapping, so any copy of an item lies wholly in one of
them; items are split by length into indexes of at most ``INDEX_ITEMS``, which bounds windows.

Document frequencies and the mean length are counted over all items, so a term weighs the same
in every index.  Indexes are broadcast in parts of about ``PART_BYTES`` of text, whose number
follows the benchmark's size: a benchmark beyond one part is searched part by part, and the rows
are written in between.  Documents are never shuffled.

Defined cases: null or empty texts and items have no words and match nothing; items without an id
take no part; an item of fewer than five words is one shingle of its own length; repeated items
are reported each under its own id; repeated documents are ordinary rows; an empty benchmark
flags nothing; a column named ``leaks`` gives way to the result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import kept, small_batches, table
from .textbatch import U, pieces, shingles, word_hashes, words

BLOCK = 4
INDEX_ITEMS = 256
PART_BYTES = 16_000_000
K1, B = 1.2, 0.75
SHARE, OVERLAP, SHINGLE = 0.5, 0.8, 5
PIECE = 500_000
HITS = "array<struct<item_id:long,score:double,question:double,answer:double>>"
SLACK = 1e-3  # impacts are single floats


def _hashes(text: str) -> tuple[np.ndarray, int]:
    """Word hashes, and the number of words before the answer."""
    data = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = words(data, np.array([0, len(data)]))
    h = word_hashes(data, s, e)
    cuts = [m.end() for m in re.finditer(r"[.?!]+[\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])", text)]
    before = int((s < len(text[: cuts[-1]].encode())).sum()) if cuts else len(h) // 2
    return h, before


class Collection:
    """Statistics of all items: their number, mean length and document frequencies (for the terms asked for)."""

    def __init__(self, n: int, mean: float, terms: np.ndarray, df: np.ndarray):
        order = np.argsort(terms)
        self.n, self.mean, self.terms, self.df = n, mean, terms[order], df[order]

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[np.searchsorted(self.terms, terms)]
        return np.log1p((self.n - df + 0.5) / (df + 0.5))


class ItemIndex:
    """Inverted lists of up to INDEX_ITEMS items of similar length: (id, hashes, words before the answer)."""

    def __init__(self, items: list, of: Collection):
        self.ids = np.array([i for i, _, _ in items], np.int64)
        self.longest = max(len(h) for _, h, _ in items)
        flat = np.concatenate([h for _, h, _ in items])
        self.terms, term = np.unique(flat, return_inverse=True)
        n, lengths = len(items), np.array([len(h) for _, h, _ in items])
        posting, tf = np.unique(term * n + np.repeat(np.arange(n), lengths), return_counts=True)
        term, item = posting // n, posting % n
        norm = K1 * (1 - B + B * lengths / of.mean)
        impact = (of.idf(self.terms)[term] * tf * (K1 + 1) / (tf + norm[item])).astype(np.float32)
        self.threshold = SHARE * np.bincount(item, impact, n)  # every term of the item once
        self.lowest = float(self.threshold.min()) - SLACK
        edge = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.lists = [(item[a:b].tolist(), impact[a:b].tolist()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        self.most = np.maximum.reduceat(impact, edge[:-1]).tolist()
        starts = np.arange(0, n, BLOCK)
        self.block_max = np.zeros((len(self.terms), len(starts)), np.float32)
        np.maximum.at(self.block_max, (term, item // BLOCK), impact)
        self.peaks, self.end = self.block_max.tolist(), n
        self.block_least = np.minimum.reduceat(self.threshold, starts) - SLACK
        self.hit = np.zeros(1 << 16, bool)
        self.hit[(self.terms >> U(48)).astype(np.int64)] = True
        self.parts = []
        for _, h, before in items:
            k = min(SHINGLE, len(h))
            g, _ = shingles(h, np.array([0, len(h)]), k)
            last = np.arange(len(g)) + k - 1
            self.parts.append((k, np.unique(g[last < before]), np.unique(g[last >= before])))

    def retrieve(self, terms: list[int], blocks: list[int]) -> Iterator[tuple[int, float]]:
        """Block-max WAND: (item, score) of all items of the blocks that the distinct terms bring to their threshold."""
        cursors, goal = [[0, t, 0] for t in terms], blocks[0] * BLOCK
        moved = cursors
        while True:
            for c in moved:
                items = self.lists[c[1]][0]
                c[2] = at = bisect_left(items, goal, c[2])
                c[0] = items[at] if at < len(items) else self.end
            cursors.sort()
            while cursors and cursors[-1][0] == self.end:
                cursors.pop()
            reach, end = 0.0, 0
            for _, t, _ in cursors:
                reach += self.most[t]
                end += 1
                if reach >= self.lowest:
                    break
            if reach < self.lowest:
                return
            pivot = cursors[end - 1][0]
            while end < len(cursors) and cursors[end][0] == pivot:
                end += 1
            moved, block = cursors[:end], pivot // BLOCK
            if block not in blocks:
                later = [x for x in blocks if x > block]
                if not later:
                    return
                goal = later[0] * BLOCK
            elif sum([self.peaks[c[1]][block] for c in moved]) < self.block_least[block]:
                goal = (block + 1) * BLOCK
                if end < len(cursors):
                    goal = min(goal, cursors[end][0])
            elif cursors[0][0] < pivot:
                goal = pivot
            else:
                score = sum([self.lists[t][1][at] for _, t, at in moved])
                if score >= self.threshold[pivot] - SLACK:
                    yield pivot, score
                goal = pivot + 1

    def search(self, h: np.ndarray, wo: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(row, item id, score, question overlap, answer overlap) for passages of all rows."""
        step, n_terms = self.longest, len(self.terms)
        at = np.flatnonzero(self.hit[(h >> U(48)).astype(np.int64)])
        pos = np.minimum(np.searchsorted(self.terms, h[at]), n_terms - 1)
        true = self.terms[pos] == h[at]
        at, pos = at[true], pos[true]
        if not len(at):
            return []
        # chunks of ``step`` words of a row; a passage is a chunk and the next one of its row
        chunks = -(-np.diff(wo) // step)
        first = np.concatenate([[0], np.cumsum(chunks)])
        row = np.searchsorted(wo, at, "right") - 1
        chunk = first[row] + (at - wo[row]) // step
        pair = np.unique(chunk * n_terms + pos)
        chunk, pos = pair // n_terms, pair % n_terms
        edge = np.flatnonzero(np.diff(chunk, prepend=-1))
        bound = np.zeros((first[-1] + 1, self.block_max.shape[1]), np.float32)
        bound[chunk[edge]] = np.add.reduceat(self.block_max[pos], edge, axis=0)
        inner = np.ones(first[-1], bool)
        inner[first[1:][chunks > 0] - 1] = False  # the last chunk of a row has no next one
        bound[:-1][inner] += bound[1:][inner]
        found = {}
        able = bound[:-1] >= self.block_least[None]
        for c in np.flatnonzero(able.any(axis=1)):
            lo, hi = np.searchsorted(chunk, [c, c + 1 + inner[c]])
            r = int(np.searchsorted(first, c, "right") - 1)
            w0 = wo[r] + (c - first[r]) * step
            text = h[w0 : min(w0 + 2 * step, wo[r + 1])]
            for i, score in self.retrieve(np.unique(pos[lo:hi]).tolist(), np.flatnonzero(able[c]).tolist()):
                k, q, a = self.parts[i]
                if len(text) < k:
                    continue
                g, _ = shingles(text, np.array([0, len(text)]), k)
                asked, told = (float(np.isin(x, g).mean()) if len(x) else 1.0 for x in (q, a))
                if asked >= OVERLAP and told >= OVERLAP:
                    new = (r, int(self.ids[i]), float(score), asked, told)
                    found[r, i] = max(found.get((r, i), new), new)
        return list(found.values())


def _item_rows(batches):
    for b in batches:
        rows = [(i, p, *_hashes(t)) for i, p, t in zip(*(b.column(c).to_pylist() for c in ("item_id", "part", "text")), strict=True)]
        rows = [x for x in rows if len(x[2])]
        if rows:
            ids, part, h, before = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(part, pa.int32()), pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64())), pa.array(before, pa.int32())], ["item_id", "part", "h", "before"])


def index_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[ItemIndex]]:
    """Indexes of benchmark(item_id, text), one part of bounded size after another."""
    good = benchmark.where("item_id is not null and text is not null")
    size = good.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int")
    items = kept(good.select("item_id", part.alias("part"), "text").mapInArrow(_item_rows, "item_id long, part int, h array<long>, before int"))
    n, mean = items.agg(F.count("*"), F.avg(F.size("h"))).first()
    if not n:
        return
    term = items.select("part", F.explode(F.array_distinct("h")).alias("term"))
    df = kept(term.groupBy("term").agg(F.count("*").alias("df")))
    for p in range(parts):
        rows = items.where(F.col("part") == p).orderBy(F.size("h"), "item_id", "h").collect()
        of = df.join(term.where(F.col("part") == p), "term", "left_semi").collect()  # of this part's words
        if not rows:
            continue
        stats = Collection(n, mean, np.array([r["term"] for r in of], np.int64).view(U), np.array([r["df"] for r in of], float))
        found = [(r["item_id"], np.array(r["h"], np.int64).view(U), r["before"]) for r in rows]
        yield [ItemIndex(found[i : i + INDEX_ITEMS], stats) for i in range(0, len(found), INDEX_ITEMS)]


def contamination_column(spark: SparkSession, indexes: list[ItemIndex]):
    """A column function: text -> array of (item_id, score, question, answer)."""
    shared = spark.sparkContext.broadcast(indexes)

    def search(text: pa.Array) -> pa.Array:
        out = [[] for _ in range(len(text))]
        for first, n, data, off in pieces(text, PIECE):
            s, e, wo = words(data, off)
            h = word_hashes(data, s, e)
            for index in shared.value:
                for r, item, score, q, a in index.search(h, wo):
                    out[first + r].append({"item_id": item, "score": score, "question": q, "answer": a})
        return pa.array(out, pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])))

    return F.arrow_udf(search, HITS)


def _searched(docs: DataFrame, benchmark: DataFrame, step, part_bytes: int) -> DataFrame:
    """docs after step(docs, column function) for every part; rows are written between parts."""
    small_batches(docs.sparkSession)
    done = False
    for indexes in index_parts(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), part_bytes):
        docs = step(kept(docs) if done else docs, contamination_column(docs.sparkSession, indexes))
        done = True
    return docs


def with_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Add ``leaks``: the benchmark items that each row holds."""
    docs = docs.withColumn("leaks", F.array().cast(HITS))
    return _searched(docs, benchmark, lambda rows, hits: rows.withColumn("leaks", F.concat("leaks", hits(F.col(text_col)))), part_bytes)


def without_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows that hold no benchmark item, with their own columns."""
    return _searched(docs, benchmark, lambda rows, hits: rows.where(F.size(hits(F.col(text_col))) == 0), part_bytes)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode("leaks").alias("k")).select("doc_id", "k.*")
