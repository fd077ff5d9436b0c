"""Repeated 100-byte strings, by a sparse suffix array sorted deep-shallow.

Suffixes are sampled by content: in every 100-byte string the 40-byte gram of smallest hash is
an anchor, so equal strings hold the same anchor at the same place, and only suffixes at anchors
(about one byte in thirty) are bucketed and sorted.

1. Each task finds its anchors and a digest of their context (60 bytes before, 100 after: all
   100-byte strings that hold the anchor gram).  Equal contexts within the task are resolved at
   once (all but the earliest are repeats), so a passage in a third of all documents sends one
   row per task, not one per document.
2. Anchors meet by gram hash.  Equal contexts are resolved again; grams with one context end
   here, the others send one representative per distinct context.
3. Representatives fetch their context bytes and are suffix-sorted by bucket: three-way multikey
   quicksort (a pivot per group, on 8-byte words) to a shallow depth, then blind tries (bytes are
   looked at only at branching depths, one verification per insertion) order the remaining
   groups with long common prefixes.  The same is done with the reversed bytes before the anchor.
   From both sorted orders and their LCPs, two strings at the same offset are equal exactly if
   they share a node at the right depth on either side; all but the earliest are repeats.
4. Repeated ranges are merged per document and removed.

Documents are ordered by id, then checksum of the text; rows equal in id and text are one
document (each gets the same result, and neither repeats the other).

Equal contexts are told by a keyed 128-bit BLAKE2b digest of their bytes, which stands for the
comparison: all copies of a text can't be sent to one place to be read side by side.

Defined cases: null and empty texts have no bytes (digest of the empty string); texts under 100
bytes lose nothing; null ids come before all others; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ensure_checkpoints, partitions, small_batches, table, total_bytes
from .textbatch import BASE, U, _powers, mix64, pieces

LENGTH, GRAM = 100, 40
SPAN = LENGTH - GRAM + 1  # grams of a string
BEFORE = LENGTH - GRAM
SHALLOW = 56  # bytes that multikey quicksort compares before the tries take over
TASK_BYTES = 16_000_000

with np.errstate(over="ignore"):
    _VALUE = mix64((np.arange(256).astype(U) + U(77)) * U(BASE))
HELD = 1_000_000  # anchors a task holds before it sends them on
ANCHOR = np.dtype([("h", "<u8"), ("ctx", "<u8"), ("ctx2", "<u8"), ("doc", "<i8"), ("rk", "<u4"), ("pos", "<u4"), ("left", "u1"), ("right", "u1")])
RANGE = np.dtype([("doc", "<i8"), ("rk", "<u4"), ("start", "<u4"), ("end", "<u4")])


def _pack(rows: np.ndarray) -> bytes:
    """Column by column, which compresses better in a shuffle."""
    return b"".join(np.ascontiguousarray(rows[f]).tobytes() for f in rows.dtype.names)


def _unpack(blobs, dtype: np.dtype) -> np.ndarray:
    parts = []
    for blob in blobs:
        n, at = len(blob) // dtype.itemsize, 0
        rows = np.empty(n, dtype)
        for f in dtype.names:
            kind = dtype.fields[f][0]
            rows[f] = np.frombuffer(blob, kind, n, at)
            at += n * kind.itemsize
        parts.append(rows)
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _slide(x: np.ndarray, width: int, least) -> np.ndarray:
    """least(x[i : i + width]) for each i, by doubling."""
    done = 1
    while 2 * done <= width:
        x = least(x[: len(x) - done], x[done:])
        done *= 2
    return least(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def find_anchors(data: np.ndarray, off: np.ndarray):
    """(position, bytes before, bytes after, gram hash, context digests) of every anchor of the rows of ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.astype(U), np.zeros((0, 2), U)
    with np.errstate(over="ignore"):
        up, down = _powers(n + 1)
        c = np.zeros(n + 1, U)
        np.cumsum(_VALUE[data] * up[:n], dtype=U, out=c[1:])
        h = mix64((c[GRAM:] - c[:-GRAM]) * down[: n - GRAM + 1])
        h |= U(1)  # 0 marks windows that cross a row's end
        m = _slide(h, SPAN, np.minimum)
        bad = np.zeros(n - LENGTH + 2, np.int32)
        inner = off[1:-1]
        np.add.at(bad, np.clip(inner - LENGTH + 1, 0, len(bad) - 1), 1)
        np.add.at(bad, np.clip(inner, 0, len(bad) - 1), -1)
        m[np.cumsum(bad)[: len(m)] > 0] = 0
        padded = np.zeros(len(m) + 2 * (SPAN - 1), U)
        padded[SPAN - 1 : SPAN - 1 + len(m)] = m
        pos = np.flatnonzero(_slide(padded, SPAN, np.maximum) == h)
        row = np.searchsorted(off, pos, "right") - 1
        left, right = np.minimum(pos - off[row], BEFORE), np.minimum(off[row + 1] - pos, LENGTH)
    raw, digest = data.tobytes(), hashlib.blake2b
    ctx = b"".join(digest(raw[a:b], digest_size=16, salt=x.to_bytes(2, "little")).digest() for a, b, x in zip((pos - left).tolist(), (pos + right).tolist(), (left * 128 + right).tolist(), strict=True))
    return pos, left, right, h[pos], np.frombuffer(ctx, U).reshape(-1, 2)


def merge_ranges(r: np.ndarray) -> np.ndarray:
    """Overlapping and touching ranges of a document joined."""
    if not len(r):
        return r
    r = r[np.lexsort((r["start"], r["rk"], r["doc"]))]
    new = np.ones(len(r), bool)
    new[1:] = (r["doc"][1:] != r["doc"][:-1]) | (r["rk"][1:] != r["rk"][:-1])
    group = np.cumsum(new)
    # running maximum of the ends within each document
    reach = np.maximum.accumulate(r["end"].astype(np.int64) + (group << 33))
    new[1:] |= r["start"][1:] > (reach[:-1] & ((1 << 33) - 1))
    first = np.flatnonzero(new)
    out = r[first].copy()
    out["end"] = np.maximum.reduceat(r["end"], first)
    return out


def _ranges(doc, rk, start, end) -> np.ndarray:
    out = np.empty(len(doc), RANGE)
    out["doc"], out["rk"], out["start"], out["end"] = doc, rk, start, end
    return out


def resolve_contexts(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(earliest anchor of each gram and context, ranges of all others)."""
    if not len(a):
        return a, np.zeros(0, RANGE)
    a = a[np.lexsort((a["pos"], a["rk"], a["doc"], a["ctx2"], a["ctx"], a["h"]))]
    same = np.zeros(len(a), bool)
    same[1:] = (a["h"][1:] == a["h"][:-1]) & (a["ctx"][1:] == a["ctx"][:-1]) & (a["ctx2"][1:] == a["ctx2"][:-1])
    again = same.copy()
    # a row equal in id and text stands for the same document: its anchors are the same place
    again[1:] &= (a["doc"][1:] != a["doc"][:-1]) | (a["rk"][1:] != a["rk"][:-1]) | (a["pos"][1:] != a["pos"][:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))
    at_first = (a["doc"] == a["doc"][first]) & (a["rk"] == a["rk"][first]) & (a["pos"] == a["pos"][first])
    r = a[again & ~at_first]
    start = r["pos"] - r["left"]
    return a[~same], _ranges(r["doc"], r["rk"], start, r["pos"] + r["right"])


NULL_ID = np.iinfo(np.int64).min


def _doc_ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def _blobs(kept: list, ranges: list, buckets: int):
    """Distinct contexts by bucket, and the ranges of the others, as one batch."""
    a, more = resolve_contexts(np.concatenate(kept))
    r = merge_ranges(np.concatenate([*ranges, more]))
    bucket = (a["h"] % U(buckets)).astype(np.int64)
    order = np.lexsort((a["pos"], a["rk"], a["doc"], bucket))
    a, bucket = a[order], bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    blobs = [_pack(x) for x in np.split(a, cut[1:])] if len(a) else []
    keys = bucket[cut].tolist()
    if len(r):
        blobs.append(_pack(r))
        keys.append(int(r["doc"][0]) % buckets)
    kinds = [0] * (len(keys) - bool(len(r))) + [1] * bool(len(r))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "kind", "blob"])


def _anchor_blobs(buckets: int):
    def run(batches):
        kept, ranges, held = [], [], 0
        for b in batches:
            docs, rks = _doc_ids(b.column("doc_id")), b.column("rk").to_numpy(zero_copy_only=False)
            for first, n, data, off in pieces(b.column("text"), 1_500_000):
                pos, left, right, h, ctx = find_anchors(data, off)
                row = np.searchsorted(off, pos, "right") - 1
                a = np.empty(len(pos), ANCHOR)
                a["h"], a["ctx"], a["ctx2"], a["doc"], a["rk"], a["pos"], a["left"], a["right"] = h, ctx[:, 0], ctx[:, 1], docs[first + row], rks[first + row], pos - off[row], left, right
                one, more = resolve_contexts(a)
                kept.append(one)
                ranges.append(merge_ranges(more))
                held += len(one)
            if held > HELD:
                yield _blobs(kept, ranges, buckets)
                kept, ranges, held = [], [], 0
        if kept:
            yield _blobs(kept, ranges, buckets)

    return run


def _meet(batches):
    """All of a task's anchors: ranges of repeated contexts, and representatives of grams with several."""
    anchors, ranges = [], []
    for b in batches:
        kind = b.column("kind").to_numpy()
        blobs = b.column("blob").to_pylist()
        anchors += [x for x, k in zip(blobs, kind, strict=True) if k == 0]
        ranges += [x for x, k in zip(blobs, kind, strict=True) if k == 1]
    a = _unpack(anchors, ANCHOR)
    del anchors
    a = a[np.argsort(a["h"], kind="stable")]
    same = np.zeros(len(a) + 1, bool)
    same[1:-1] = a["h"][1:] == a["h"][:-1]
    a, more = resolve_contexts(a[same[:-1] | same[1:]])
    same = np.zeros(len(a) + 1, bool)
    same[1:-1] = a["h"][1:] == a["h"][:-1]
    a = a[same[:-1] | same[1:]]
    r = merge_ranges(np.concatenate([_unpack(ranges, RANGE), more]))
    zero = np.zeros(len(r), np.int64)
    columns = [("kind", zero + 1, np.zeros(len(a), np.int64)), ("h", zero, a["h"].view(np.int64))]
    columns += [("doc", r["doc"], a["doc"]), ("rk", r["rk"], a["rk"]), ("x", r["start"], a["pos"]), ("y", r["end"], a["left"]), ("z", zero, a["right"])]
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p.astype(np.int64), q.astype(np.int64)])) for _, p, q in columns], [c for c, _, _ in columns])


def _contexts(batches):
    """Context bytes of the representatives in each document."""
    for b in batches:
        out = []
        for doc, rk, text, reps in zip(b.column("doc").to_pylist(), b.column("rk").to_pylist(), b.column("text"), b.column("reps").to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes()
            out += [(r["h"], doc, rk, r["x"], r["y"], raw[r["x"] - r["y"] : r["x"] + r["z"]]) for r in reps]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.binary())], ["h", "doc", "rk", "pos", "before", "context"])


class BlindTrie:
    """Orders strings that share a long prefix; inner nodes hold only a depth and branching bytes."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def _byte(self, i: int, d: int) -> int:
        s = self.strings[i]
        return s[d] if d < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        node = self.root  # a leaf is a list of equal strings, an inner node (depth, {byte: node})
        while isinstance(node, tuple):
            node = node[1].get(self._byte(i, node[0])) or next(iter(node[1].values()))
        a, b = self.strings[i], self.strings[node[0]]
        most = min(len(a), len(b))
        d = min(self.depth, most)
        while d < most and a[d : d + 8] == b[d : d + 8]:
            d += 8
        d = min(d, most)
        while d < most and a[d] == b[d]:
            d += 1
        if d == len(a) == len(b):
            node.append(i)
            return
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < d:
            above, node = node, node[1][self._byte(i, node[0])]
        if isinstance(node, tuple) and node[0] == d:
            node[1][self._byte(i, d)] = [i]
            return
        old = node[0] if not isinstance(node, tuple) else self._leaf(node)
        new = (d, {self._byte(old, d): node, self._byte(i, d): [i]})
        if above is None:
            self.root = new
        else:
            above[1][self._byte(i, above[0])] = new

    @staticmethod
    def _leaf(node):
        while isinstance(node, tuple):
            node = next(iter(node[1].values()))
        return node[0]

    def ordered(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def _multikey(word: np.ndarray, size: np.ndarray, order: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) after three-way multikey quicksort of every group to ``depth`` words.

    All groups that aren't done take a step at once: around its pivot (the middle of three members' words) a group
    falls into what is smaller, equal and larger; the equal part goes on at the next word, the others at this one.
    """
    at = np.zeros(int(group[-1]) + 1 if len(group) else 0, np.int64)  # the word each group is at
    while True:
        count = np.bincount(group, minlength=len(at))
        places = np.flatnonzero(((count > 1) & (at < depth))[group])
        if not len(places):
            return order, group
        own = group[places]
        edge = np.flatnonzero(np.diff(own, prepend=-1))
        end = np.append(edge[1:], len(own))
        member = order[places]
        w = at[own]
        value, used = word[member, w], np.minimum(size[member], 8 * w + 8)
        # the middle of the first, middle and last member by (word, bytes used)
        trio = np.stack([edge, (edge + end) // 2, end - 1], axis=1)
        rank = np.lexsort((used[trio], value[trio]), axis=1)[:, 1]
        pivot = np.repeat(trio[np.arange(len(trio)), rank], end - edge)
        side = np.where(value == value[pivot], np.sign(used - used[pivot]) + 1, np.where(value < value[pivot], 0, 2))
        by = np.argsort(own * 3 + side, kind="stable")
        order[places] = member[by]
        key = np.zeros(len(order), bool)
        key[1:] = group[1:] != group[:-1]
        part = (own * 3 + side)[by]
        key[places[1:]] |= (part[1:] != part[:-1]) & (places[1:] == places[:-1] + 1)
        # words of the new groups, read off their first members
        step = at[group]
        step[places] += side[by] == 1
        group = np.cumsum(key)
        at = step[np.flatnonzero(np.diff(group, prepend=-1))]


def deep_shallow(strings: list[bytes], bucket: np.ndarray, width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp with the one before) of strings sorted by (bucket, bytes); lcp is -1 where a bucket begins."""
    n, wide = len(strings), -(-width // 8) * 8
    size = np.fromiter(map(len, strings), np.int64, n)
    flat = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8).reshape(n, wide)
    depth = min(shallow, wide) // 8
    order = np.argsort(bucket, kind="stable")
    group = np.cumsum(np.diff(bucket[order], prepend=bucket[order[:1]]) != 0) if n else np.zeros(0, np.int64)
    order, group = _multikey(flat.view(">u8").astype(U), size, order, group, depth)
    edge = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(edge, np.append(edge[1:], n), strict=True):
        if b - a > 1:  # they share what quicksort has seen
            trie = BlindTrie(strings, 8 * depth)
            for i in order[a:b].tolist():
                trie.insert(i)
            order[a:b] = trie.ordered()
    lcp = np.full(n, -1, np.int64)
    for a in range(1, n, 65_536):
        x, y = order[a : a + 65_536], order[a - 1 : min(a + 65_535, n - 1)]
        differ = flat[x] != flat[y]
        most = np.minimum(size[x], size[y])
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
        lcp[a : a + len(x)] = np.where(bucket[x] == bucket[y], np.minimum(first, most), -1)
    return order, lcp


def repeated_ranges(h: np.ndarray, doc, rk, pos, before, contexts: list[bytes]) -> np.ndarray:
    """Ranges of the strings of distinct contexts that also start earlier, in another context of the same gram."""
    rank = np.lexsort((pos, rk, doc))
    h, doc, rk, pos, before = h[rank], doc[rank], rk[rank], pos[rank], before[rank]
    contexts = [contexts[i] for i in rank]
    after = np.fromiter(map(len, contexts), np.int64, len(contexts)) - before
    n = len(h)
    ro, rl = deep_shallow([c[b:] for c, b in zip(contexts, before, strict=True)], h, LENGTH)
    lo, ll = deep_shallow([c[:b][::-1] for c, b in zip(contexts, before, strict=True)], h, BEFORE)
    hit = np.zeros((n, BEFORE + 1), bool)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(BEFORE + 1):
        right[ro], left[lo] = np.cumsum(rl < LENGTH - o), np.cumsum(ll < o)
        at = np.flatnonzero((before >= o) & (after >= LENGTH - o))
        _, first = np.unique(right[at] * (n + 1) + left[at], return_index=True)
        again = np.ones(len(at), bool)
        again[first] = False
        hit[at[again], o] = True
    flat = np.zeros((n, BEFORE + 3), np.int8)
    flat[:, 1:-1] = hit
    edge = np.diff(flat, axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    return merge_ranges(_ranges(doc[row], rk[row], pos[row] - (high - 1), pos[row] - low + LENGTH))


def _sort_suffixes(batches):
    columns = [[], [], [], [], []]
    contexts: list[bytes] = []
    for b in batches:
        for c, name in zip(columns, ("h", "doc", "rk", "pos", "before"), strict=True):
            c.append(b.column(name).to_numpy())
        contexts += b.column("context").to_pylist()
    if contexts:
        h, doc, rk, pos, before = (np.concatenate(c) for c in columns)
        order = np.lexsort((pos, rk, doc, h))  # rows equal in id and text bring the same place again
        new = np.ones(len(h), bool)
        for c in (h, doc, rk, pos):
            new[1:] &= c[order][1:] == c[order][:-1]
        at = order[~new | (np.arange(len(h)) == 0)]
        r = repeated_ranges(h[at], doc[at], rk[at], pos[at], before[at], [contexts[i] for i in at])
        yield pa.RecordBatch.from_arrays([pa.array(r[c].astype(np.int64)) for c in ("doc", "rk", "start", "end")], ["doc", "rk", "x", "y"])


def _remove(batches):
    for b in batches:
        out = []
        for text, ranges in zip(b.column("text"), b.column("ranges"), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            spans: list[list[int]] = []
            for s, e in sorted((r["x"], r["y"]) for r in ranges.as_py() or ()):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(e, spans[-1][1])
                else:
                    spans.append([s, e])
            at, kept = 0, hashlib.sha256()
            for s, e in spans:
                kept.update(raw[at:s])
                at = e
            kept.update(raw[at:])
            out.append((len(raw), sum(e - s for s, e in spans), len(spans), kept.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
        if out:
            cols = list(zip(*out, strict=True))
            spans = pa.array(cols[4], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3]), spans], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (the spans) for every row."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.crc32(text.cast("binary")).alias("rk"))
    tasks = max(partitions(spark), total_bytes(docs, "text") // TASK_BYTES)
    blobs = docs.mapInArrow(_anchor_blobs(tasks), "bucket long, kind int, blob binary").repartition(tasks, "bucket")
    met = blobs.mapInArrow(_meet, "kind long, h long, doc long, rk long, x long, y long, z long").checkpoint()

    # the same three columns on either side of both joins, so that the texts are shuffled once
    keyed = docs.select(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("doc"), "rk", "text")
    reps = met.where("kind = 0").groupBy("doc", "rk").agg(F.collect_list(F.struct("h", "x", "y", "z")).alias("reps"))
    contexts = keyed.join(reps, ["doc", "rk"]).select("doc", "rk", "text", "reps").mapInArrow(_contexts, "h long, doc long, rk long, pos long, before long, context binary")
    sorted_ = contexts.repartition(tasks, "h").mapInArrow(_sort_suffixes, "doc long, rk long, x long, y long")

    ranges = met.where("kind = 1").select("doc", "rk", "x", "y").union(sorted_).groupBy("doc", "rk").agg(F.collect_list(F.struct("x", "y")).alias("ranges"))
    found = keyed.join(ranges, ["doc", "rk"], "left").select(F.nullif("doc", F.lit(int(NULL_ID))).alias("doc_id"), "text", "ranges")
    return found.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")
