"""Spans of a script with UTF-8 byte offsets: by line, in markdown prose, in code by small lexers."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..durable import small_batches
from ..functions.classes import CHINESE, SPACES, ScriptClass

# What markdown prose isn't, for extraction and (without targets and addresses) for checks.
MARKDOWN_CHECK = (r"\A---\n(?s:.*?)\n---\n", r"(?s:```.*?```)", r"(?s:~~~.*?~~~)", r"`[^`\n]+`", r"<[^>\n]+>")
MARKDOWN_EXTRACT = (*MARKDOWN_CHECK, r"(?<=\])\([^)\n]*\)", r"https?://\S+")
# Lexical classes of the languages with lexers.
_LINE, _BLOCK = ("comment", r"//[^\n]*"), ("comment", r"/\*(?s:.*?)\*/")
_DOUBLE, _SINGLE = ("string", r'"(?:[^"\\\n]|\\.)*"'), ("string", r"'(?:[^'\\\n]|\\.)*'")
LEXERS = {
    "go": (_LINE, _BLOCK, _DOUBLE, ("raw_string", r"`[^`]*`"), ("", r"'(?:[^'\\\n]|\\.)+'")),
    "proto": (_LINE, _BLOCK, _DOUBLE, _SINGLE),
    "typescript": (_LINE, _BLOCK, _DOUBLE, _SINGLE, ("string", r"`(?:[^`\\]|\\(?s:.))*`")),
    "tsx": (_LINE, _BLOCK, _DOUBLE, _SINGLE, ("string", r"`(?:[^`\\]|\\(?s:.))*`")),
    "dart": (_LINE, _BLOCK, ("", r'"(?:[^"\\\n]|\\.)*"'), ("", r"'(?:[^'\\\n]|\\.)*'")),
}


_CORE, _EDGE, _INNER, _SPACE = 1, 2, 4, 8
_SPACE_RUN = re.compile(r"\s+")
#: Bytes of text whose spans are held at once.
CHUNK = 1 << 20


@lru_cache
def _classes(script: ScriptClass, spaces: str) -> np.ndarray:
    """The classes of every code point, as bits."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(0x200000, np.uint8)  # what four bytes can spell
    for bit, chars in ((_CORE, script.core), (_EDGE, script.core + script.extra), (_INNER, script.core + script.extra + spaces + script.joiners), (_SPACE, r"\s")):
        for m in re.finditer(f"[{_escaped(chars)}]+", every):
            out[m.start() : m.end()] |= bit
    return out


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character begins, and its code point; 0 for broken bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    points = lead.astype(np.int32)
    high = np.flatnonzero(lead >= 0x80)
    size, first = np.diff(at, append=len(data))[high], lead[high]
    points[high] = 0
    for n, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        some = (size == n) & (first >= low) & (first < low + mask + 1)
        own = high[some]
        got = points[own] + (first[some] & mask)
        for k in range(1, n):
            got = got << 6 | (data[at[own] + k] & 0x3F)
        points[own] = got
    return at, points


class Spans:
    """The spans of some texts: numbers of the text, start, end (bytes in the text), kind, and of the distinct source; sources and their hashes."""

    def __init__(self, texts: list[bytes], script: ScriptClass, free: Callable[[bytes], list[tuple[int, int, str]]] | None = None):
        """free: gives the ranges (characters, kind) of a text that spans are looked for in; without it lines are."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        first = np.cumsum([0, *map(len, texts)])
        at, points = _code_points(data)
        kinds = _classes(script, SPACES if free is None else " " if free is markdown_ranges else r"\s")[points]
        doc = np.searchsorted(at, first)  # each text's first character, and the end
        cut = (kinds & _INNER) == 0
        if free is None:
            cut |= points == 10
            names = ["string", "comment"]
        else:
            ranges = [(doc[i] + s, doc[i] + e, kind) for i, t in enumerate(texts) for s, e, kind in free(t) if s < e]
            names = sorted({kind for _, _, kind in ranges})
            place = np.zeros(len(points) + 1, np.int32)
            begin, stop = (np.array([x[k] for x in ranges], np.int64) for k in (0, 1))
            np.add.at(place, begin, 1)
            np.add.at(place, stop, -1)
            cut |= np.cumsum(place[:-1]) == 0
            cut[begin] = True  # two ranges may touch
        cut[doc[:-1][doc[:-1] < len(cut)]] = True
        part = np.cumsum(cut, dtype=np.int32)  # a run's edges have the same number, as a cut may only stand at its first one
        edges = np.flatnonzero((kinds & _EDGE) != 0) if free is None else np.flatnonzero(((kinds & _EDGE) != 0) & (np.cumsum(place[:-1]) > 0))
        new = np.diff(part[edges], prepend=-1) != 0
        heads = np.flatnonzero(new)
        if len(heads):
            held = np.logical_or.reduceat((kinds[edges] & _CORE) != 0, heads)
            a, b = edges[heads][held], edges[np.append(heads[1:], len(edges)) - 1][held] + 1
        else:
            a = b = heads
        loose = np.flatnonzero((kinds[a] & _SPACE) | (kinds[b - 1] & _SPACE))
        for i in loose:
            inside = np.flatnonzero((kinds[a[i] : b[i]] & _SPACE) == 0)
            a[i], b[i] = a[i] + inside[0], a[i] + inside[-1] + 1
        ends = np.append(at, len(data))
        s, e = ends[a], ends[b]
        self.text = np.searchsorted(first, s, "right") - 1
        if free is None:
            lines = np.union1d(first[:-1], np.flatnonzero(data == 10) + 1)
            pair = np.zeros(len(data) + 1, bool)
            pair[: len(data) - 1] = (data[1:] == data[:-1]) & ((data[1:] == ord("/")) | (data[1:] == ord("-")))
            pair[first[first > 0] - 1] = False  # of two texts
            marked = np.zeros(len(lines) + 1, bool)
            marked[np.searchsorted(lines, np.flatnonzero(pair[: len(data)] | (data == ord("#"))), "right")] = True
            kind = marked[np.searchsorted(lines, s, "right")].astype(np.int32)
        else:
            order = np.array([names.index(x[2]) for x in ranges], np.int32)
            kind = order[np.searchsorted(begin, a, "right") - 1] if len(order) else np.zeros(0, np.int32)
        self.kind, self.names = kind, names
        self.start, self.end = (s - first[self.text]).astype(np.int32), (e - first[self.text]).astype(np.int32)
        size = e - s
        to = np.cumsum(np.append(0, size))
        where = np.repeat(s - to[:-1], size) + np.arange(to[-1])
        src = pa.StringArray.from_buffers(len(s), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data[where])).dictionary_encode()
        self.which, self.sources = src.indices.to_numpy(), src.dictionary
        self.hashes = [segment_hash(x) for x in self.sources.to_pylist()]

    def of_texts(self, n: int) -> np.ndarray:
        """Where the spans of each text begin, and the end."""
        return np.searchsorted(self.text, np.arange(n + 1))


def segment_hash(src: str) -> str:
    """seg_hash() of one segment."""
    return hashlib.sha1(_SPACE_RUN.sub(" ", unicodedata.normalize("NFC", src)).strip(" ").encode()).hexdigest()


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut into parts of about CHUNK bytes of text, and their texts."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        size = np.cumsum(np.append(0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)))
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(size, size[at] + CHUNK, "right")) - 1)
            yield batch.slice(at, end - at), [x.as_py() or b"" for x in texts.slice(at, end - at)]
            at = end


def _type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _rows(script: ScriptClass, free: Callable | None, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            x = Spans(texts, script, free)
            which = pa.array(x.which)
            columns = [part.column(0).take(pa.array(x.text)), pa.array(x.start), pa.array(x.end), x.sources.take(which), pa.array(x.hashes, pa.string()).take(which), pa.array(x.names, pa.string()).take(pa.array(x.kind))]
            yield pa.RecordBatch.from_arrays(columns, [key, "start", "end", "src", "h", "kind"])

    return run


def _extracted(files: DataFrame, script: ScriptClass, key: str, free: Callable | None = None) -> DataFrame:
    small_batches(files.sparkSession)
    return files.where(F.col("text").isNotNull()).select(key, "text").mapInArrow(_rows(script, free, key), f"`{key}` {_type(files, key)}, start int, end int, src string, h string, kind string")


def extract_lines(files: DataFrame, script: ScriptClass = CHINESE, key: str = "file") -> DataFrame:
    """files(key, text) -> (key, start, end, src, h, kind): runs within lines, found over the bytes of many texts at once."""
    return _extracted(files, script, key)


def firsts(files: DataFrame, script: ScriptClass = CHINESE, key: str = "file") -> DataFrame:
    """The rows of extract_lines() that may be the first of their hash: of some texts at a time the first of each source by key and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            x = Spans(texts, script)
            place = np.argsort(pc.array_sort_indices(part.column(0), null_placement="at_start").to_numpy())
            order = np.lexsort((x.start, place[x.text]))
            which, at = np.unique(x.which[order], return_index=True)
            at, which = order[at], pa.array(which)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(x.text[at])), pa.array(x.start[at]), x.sources.take(which), pa.array(x.hashes, pa.string()).take(which), pa.array(x.names).take(pa.array(x.kind[at]))], [key, "start", "src", "h", "kind"])

    small_batches(files.sparkSession)
    return files.where(F.col("text").isNotNull()).select(key, "text").mapInArrow(run, f"`{key}` {_type(files, key)}, start int, src string, h string, kind string")


def hashes(files: DataFrame, script: ScriptClass = CHINESE, key: str = "file") -> DataFrame:
    """(key, h): the distinct hashes of each text's spans within lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            x = Spans(texts, script)
            names, same = np.unique(np.array(x.hashes, dtype="U40"), return_inverse=True)
            pairs = np.unique(x.text.astype(np.int64) * (len(names) + 1) + same[x.which])
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(pairs // (len(names) + 1))), pa.array(names.tolist(), pa.string()).take(pa.array(pairs % (len(names) + 1)))], [key, "h"])

    small_batches(files.sparkSession)
    return files.where(F.col("text").isNotNull()).select(key, "text").mapInArrow(run, f"`{key}` {_type(files, key)}, h string")


def _runs(text: str, ranges, pattern: re.Pattern, core: re.Pattern):
    at = size = 0  # characters before the last run found, and their bytes
    for a, b, kind in ranges:
        for m in pattern.finditer(text, a, b):
            body = m.group().strip()
            if core.search(body):
                s = m.start() + m.group().index(body[0])
                at, size = s, size + len(text[at:s].encode())
                yield {"start": size, "end": size + len(body.encode()), "src": body, "kind": kind}


def _escaped(pattern: str) -> str:
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern)


def _python(script: ScriptClass, spaces: str) -> tuple[re.Pattern, re.Pattern]:
    return re.compile(_escaped(script.run(spaces))), re.compile(_escaped(script.has()))


def masked_ranges(text: str, patterns) -> list[tuple[int, int]]:
    """Union of what the patterns match, each on the original text."""
    out: list[list[int]] = []
    for s, e in sorted(m.span() for p in patterns for m in re.finditer(p, text)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def markdown_ranges(text: bytes) -> list[tuple[int, int, str]]:
    """Prose, in characters."""
    text = text.decode()
    at, free = 0, []
    for s, e in [*masked_ranges(text, MARKDOWN_EXTRACT), (len(text), len(text))]:
        free.append((at, s, "md_prose"))
        at = e
    return free


def markdown_spans(text: str, script: ScriptClass = CHINESE) -> list[dict]:
    run, core = _python(script, " ")
    return list(_runs(text, markdown_ranges(text.encode()), run, core))


def code_ranges(lang: str) -> Callable[[bytes], list[tuple[int, int, str]]]:
    """A function that gives a text's comments and strings, in characters; text between them is code and has none."""
    kinds = LEXERS[lang]
    token = re.compile("|".join(f"({p})" for _, p in kinds))

    def ranges(text: bytes) -> list[tuple[int, int, str]]:
        found = ((m.start(), m.end(), kinds[m.lastindex - 1][0]) for m in token.finditer(text.decode()))
        return [x for x in found if x[2]]

    return ranges


def code_spans(text: str, lang: str, script: ScriptClass = CHINESE) -> list[dict]:
    """Runs inside comments and strings."""
    run, core = _python(script, r"\s")
    return list(_runs(text, code_ranges(lang)(text.encode()), run, core))


def extract(files: DataFrame, script: ScriptClass = CHINESE, key: str = "file") -> DataFrame:
    """files(key, text, lang): markdown and the languages with lexers by structure, all others by line; in one pass."""
    small_batches(files.sparkSession)
    ways = {"markdown": markdown_ranges} | {x: code_ranges(x) for x in LEXERS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                same = pc.equal(batch.column("lang"), lang) if lang is not None else pc.is_null(batch.column("lang"))
                yield from _rows(script, ways.get(lang), key)([batch.filter(same)])

    schema = f"`{key}` {_type(files, key)}, start int, end int, src string, h string, kind string"
    return files.where(F.col("text").isNotNull()).select(key, "text", F.when(F.col("lang").isin(*ways), F.col("lang")).alias("lang")).mapInArrow(run, schema)


def occurrences(spans: DataFrame, key: str = "file") -> DataFrame:
    """Markdown spans are stored as comments."""
    kind = F.when(F.col("kind") == "md_prose", "comment").otherwise(F.col("kind"))
    return spans.select(key, "start", "end", "h", kind.alias("kind"))
