"""Spans, splices, pages and headings over large texts: the same results as slower ways, in bounded memory and time."""

import random
import re
import time
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from polyseg.functions import text as T
from polyseg.functions.classes import CHINESE
from polyseg.operators import checks, extract, memory, rewrite
from polyseg.plans import queries

ODD = ["用", "户", " ", "a", "\n", "é", "。", "--", "-", "/", "//", "#", "　", "、", "(", '"', "'", "`", "```", "~~~", "<", ">", "\U0001f600", " ", "\xa0", "\r", "\x1c", "](", "[", ")", "http://x ", "/*", "*/", "\\"]
RUN = re.compile("[一-鿿　-〿＀-￯](?:[一-鿿　-〿＀-￯\\s,.:;()'\"-]*[一-鿿　-〿＀-￯])?")


def by_line(text):
    at = 0
    for line in text.split("\n"):
        for m in RUN.finditer(line):
            if re.search("[一-鿿]", m.group()):
                start = at + len(line[: m.end() - len(m.group().lstrip())].encode())
                yield start, start + len(m.group().strip().encode()), m.group().strip(), "comment" if re.search("//|#|--", line) else "string"
        at += len(line.encode()) + 1


def test_spans_of_many_texts():
    rng = random.Random(1)
    listed = lambda spans: [(s["start"], s["end"], s["src"], s["kind"]) for s in spans]
    ways = [(None, by_line), (extract.markdown_ranges, lambda t: listed(extract.markdown_spans(t)))] + [(extract.code_ranges(x), lambda t, x=x: listed(extract.code_spans(t, x))) for x in extract.LEXERS]
    for _ in range(60):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.choice([0, 1, 2, 5, 40, 200]))) for _ in range(rng.randint(1, 9))]
        for free, want in ways:
            x = extract.Spans([t.encode() for t in texts], CHINESE, free)
            got = [(int(i), int(s), int(e), x.sources[int(w)].as_py(), x.names[k]) for i, s, e, w, k in zip(x.text, x.start, x.end, x.which, x.kind, strict=True)]
            assert got == [(i, *r) for i, t in enumerate(texts) for r in want(t)]
    extract.Spans([b"\xe4\xb8", b"\xe4\xb8\x80\xff", b"\x80\x80"], CHINESE)  # broken bytes


def test_spans_come_in_bounded_batches():
    """A batch of 20 MB never becomes one of as many spans."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(["用a" * 50_000] * 100)], ["file", "text"])
    sizes = [len(b) for b in extract._rows(CHINESE, extract.markdown_ranges, "file")([batch])]
    assert sum(sizes) == 5_000_000 and max(sizes) <= 6 * 50_000


def test_first_of_each_hash_and_hashes(spark):
    files = spark.createDataFrame([(k, f"用{'户' * (k % 3)} a　用\n名{k % 5}用　用") for k in range(40, 0, -1)], "file int, text string")
    spans = extract.extract_lines(files)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(memory.distinct_segments(extract.firsts(files))) == rows(memory.distinct_segments(spans))
    assert rows(extract.hashes(files)) == rows(spans.select("file", "h").distinct())


def test_splice_of_a_long_text(spark):
    """30,000 edits in one text: a fold that copies its result at every edit takes minutes."""
    raw = "// 用a。户b\n" * 15_000
    files = spark.createDataFrame([("a.go", raw.encode())], "file string, content binary")
    spans = extract.extract_lines(files.select("file", F.col("content").cast("string").alias("text")))
    known = memory.distinct_segments(spans).select("h", F.lit("Xy").alias("en"))
    began = time.time()
    one = rewrite.splice(files, extract.occurrences(spans), known).first()
    two = rewrite.splice_lines(files, known).first()
    plain = rewrite.splice_plain(files.select("file", F.col("content").cast("string").alias("text")), known).first()
    assert time.time() - began < 60 and one == two and one.n == plain.n == 30_000
    assert bytes(one.content).decode() == plain.text == "// XyaXyb\n" * 15_000


def test_padding_in_python(spark):
    """Every value between every pair of neighbours, against the column's rules."""
    values, sides = ["Xy", "x", "", "ab", "URL\n"], ["", "URL", "URL\n", "。", "，x", "a", "JSONURL\r\n", "（"]
    rows = [(v, b, a) for v in values for b in sides for a in sides]
    got = spark.createDataFrame(rows, "v string, b string, a string").select("v", "b", "a", T.pad_boundary(F.col("v"), F.col("b"), F.col("a")).alias("p")).collect()
    assert [rewrite._pad(r.v, r.b.encode(), r.a.encode()) for r in got] == [r.p for r in got]


def test_headings_in_the_row(spark):
    """Slugs of plain and odd heading lines, without a shuffle of lines."""
    rng = random.Random(2)
    parts = ["#", "##", " ", "  ", "a", "Bc", "-", "_", "!", "\t", "é", "用", "```", "~~~", "\n", "\r\n", " ", "\x0b", "#######"]
    texts = ["".join(rng.choice(parts) for _ in range(60)) for _ in range(300)] + ["## a b ##  \n### -C! d-\n####### no\n#no\n   # yes #\n    # no"]
    files = spark.createDataFrame(list(enumerate(texts)), "file int, text string")
    found = checks.headings(files)
    assert not re.search("Window|Exchange", found._jdf.queryExecution().executedPlan().toString())
    rows = found.withColumn("want", T.heading_slug(F.col("line"))).collect()
    atx, want = re.compile(r"[ \t]{0,3}#{1,6}[ \t]"), []
    for i, t in enumerate(texts):
        fenced = False
        for pos, line in enumerate(t.splitlines()):
            if re.match(r"\s*(```|~~~)", line):
                fenced = not fenced
            elif not fenced and atx.match(line):
                want.append((i, pos, line))
    assert sorted((r.file, r.pos, r.line) for r in rows) == want and [r.slug for r in rows] == [r.want for r in rows]
    assert [r.slug for r in rows if r.file == 300] == ["a-b", "c-d", "yes"]


def test_pages(spark):
    """Pages made over bytes are those made by columns."""
    text = "Ab, é cd-\n  #x y_z!\n\nlast 用 e"
    want = ["## Ab  cd-", "[a](#ab--cd) [b](#x-yz) [c](../docs/1.md#x) [d](https://e.org)   x yz", "```\n## \n[e](gone.md)\n```", "## last  e"]
    assert queries._page_text(text.encode(), False).decode() == "\n".join(want)
    assert queries._page_text(text.encode(), True).decode().split("\n")[-1] == "## lest  o"


def test_composition_sends_only_what_it_may_change(spark):
    """Python gets no text that composition leaves as it is, and the pattern of those is right for every character."""
    texts = ["plain", "", None, "用户，名", "é", "Ω", "ẋ̣", "〪〭", " ", "가", "é用"]
    frame = spark.createDataFrame([(t,) for t in texts], "c string")
    assert [r[0] for r in frame.select(T.nfc(F.col("c"))).collect()] == [t and unicodedata.normalize("NFC", t) for t in texts]
    assert "CASE WHEN" in frame.select(T.nfc(F.col("c")))._jdf.queryExecution().optimizedPlan().toString()
    kept = re.compile(T.NOT_COMPOSED.replace("[^", "[").replace(r"\x{0}", r"\x00").replace(r"\x{2ff}", "˿").replace(r"\x{", "\\u").replace("}", ""))
    parts = [unicodedata.decomposition(chr(c)).split() for c in range(0x110000)]
    joined = {int(p[1], 16) for p in parts if len(p) == 2 and p[0][0] != "<"} | {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    assert not [c for c in range(0x110000) if kept.match(chr(c)) and (unicodedata.combining(chr(c)) or c in joined or unicodedata.normalize("NFC", chr(c)) != chr(c))]
