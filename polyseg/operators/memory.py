"""Segments, translation memory and the chain of engines."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..durable import kept
from ..functions.text import norm, protect_all


def distinct_segments(spans: DataFrame, key: str = "file") -> DataFrame:
    """One row per hash: the first by file and offset."""
    first = F.min_by(F.struct("src", "kind"), F.struct(key, "start"))
    return spans.groupBy("h").agg(first.alias("s")).select("h", "s.src", "s.kind")


def pending(segments: DataFrame, memory: DataFrame) -> DataFrame:
    return segments.join(memory.select("h"), "h", "left_anti")


def missing(hashes: DataFrame, memory: DataFrame, order: str = "at") -> DataFrame:
    """Distinct hashes not in the memory, in input order."""
    return hashes.groupBy("h").agg(F.min(order).alias(order)).join(memory.select("h"), "h", "left_anti").orderBy(order).select("h")


def upsert(memory: DataFrame, new: DataFrame) -> DataFrame:
    """New records replace old ones of the same key; of several new ones the last wins (column ``seq``)."""
    latest = new.groupBy("h").agg(F.max_by(F.struct("src", "en", "engine"), "seq").alias("r")).select("h", "r.*")
    return memory.select("h", "src", "en", "engine").join(latest.select("h"), "h", "left_anti").unionByName(latest)


def remembered(memory: DataFrame, hashes: list[str] | None = None) -> DataFrame:
    """Point lookups: the records of some hashes (all without a list); count() gives their number."""
    return memory if hashes is None else memory.where(F.col("h").isin(*hashes))


class Engine(Protocol):
    """A batch translator: one output per input, empty where it has none."""

    name: str

    def translate(self, texts: list[str]) -> list[str]: ...


class RequestEngine:
    """A translator behind requests: code tokens are protected, failures retried, and few tasks call it at once.

    ``send`` takes and returns a list of texts; ``usage`` may tell (used, allowed) characters.
    """

    def __init__(self, name: str, send: Callable[[list[str]], list[str]], glossary: tuple[str, ...] = (), batch: int = 50, attempts: int = 4, tasks: int = 4, pause: float = 1.0, usage: Callable[[], tuple[int, int]] | None = None):
        self.name, self.send, self.glossary, self.batch, self.attempts, self.tasks, self.pause, self.usage = name, send, glossary, batch, attempts, tasks, pause, usage

    def _answer(self, texts: list[str]) -> list[str]:
        failures = []
        while len(failures) < self.attempts:
            if failures:
                time.sleep(self.pause * 2 ** (len(failures) - 1))
            try:
                return self.send(texts)
            except Exception as e:  # noqa: BLE001 - any failure of a request is tried again
                failures.append(e)
        raise RuntimeError(f"engine {self.name} gave up after {self.attempts} attempts: {failures[-1]}")

    def translate(self, texts: list[str]) -> list[str]:
        requests = (protect_all(texts[at : at + self.batch], self.glossary) for at in range(0, len(texts), self.batch))
        return [re.sub("</?x>", "", t) for request in requests for t in self._answer(request)]


class LocalEngine:
    """A model on the executors that translates one text at a time; ``load`` makes it once a process."""

    def __init__(self, name: str, load: Callable[[], Callable[[str], str]]):
        self.name, self.load = name, load

    def translate(self, texts: list[str]) -> list[str]:
        one = self.__dict__.get("_one") or self.__dict__.setdefault("_one", self.load())
        return [one(t) for t in texts]

    def __getstate__(self) -> dict:
        return {"name": self.name, "load": self.load}


class DictionaryEngine:
    """A join with the dictionary, normalized on both sides."""

    name = "dictionary"

    def __init__(self, dictionary: DataFrame):
        self.dictionary = dictionary

    def resolve(self, segments: DataFrame) -> DataFrame:
        keyed = segments.withColumn("src_norm", norm(F.col("src")))
        return keyed.join(self.dictionary, "src_norm", "left").select("h", "src", F.coalesce("en", F.lit("")).alias("en"))


def resolve_batches(segments: DataFrame, engine: Engine, batch: int = 50) -> DataFrame:
    """An engine over chunks of ``batch`` texts; a wrong number of results is an error that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.slice(at, batch)
                texts = part.column("src").to_pylist()
                out = engine.translate(texts)
                if len(out) != len(texts):
                    raise ValueError(f"engine {engine.name} returned {len(out)} results for {len(texts)} texts")
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("src"), pa.array(out, pa.string())], ["h", "src", "en"])

    rows = segments.select("h", "src")
    rows = rows.repartition(engine.tasks) if getattr(engine, "tasks", None) else rows
    return rows.mapInArrow(run, "h string, src string, en string")


def chain(segments: DataFrame, engines: list) -> DataFrame:
    """(h, src, en, engine): each engine sees only what those before it left; blank results don't count.

    An engine's results are written once before anything reads them, so that no segment is sent twice,
    whatever uses the outcome, and the memory and the files agree even where an engine varies.
    """
    done, left = None, segments.select("h", "src")
    for engine in engines:
        got = engine.resolve(left) if hasattr(engine, "resolve") else resolve_batches(left, engine)
        got = kept(got.where(F.trim("en") != "").withColumn("engine", F.lit(engine.name)))
        done = got if done is None else done.unionByName(got)
        left = left.join(got.select("h"), "h", "left_anti")
    return segments.select("h", "src", F.lit("").alias("en"), F.lit("").alias("engine")).limit(0) if done is None else done


def get_engine(name: str, dictionary: DataFrame | None = None, plugins: dict | None = None):
    """Engines by name; online and offline ones are plug-ins that bring their own translator."""
    if name == "dictionary" and dictionary is not None:
        return DictionaryEngine(dictionary)
    if plugins and name in plugins:
        return plugins[name]
    raise ValueError(f"unknown engine {name!r}")
