"""Behaviour of the span engine on small inputs, and every SQL query against DuckDB."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from polyseg import cli
from polyseg.functions import text as T
from polyseg.operators import checks, classify, extract, memory, rewrite
from polyseg.plans import pipeline, queries
from polyseg.sources import readers
from polyseg.streaming import incremental

SF = "/root/testdata/sf0.001"


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "c string").select(column(F.col("c"))).collect()]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    rows = queries.QUERIES[name](spark, SF).toPandas()
    if name not in queries.ORACLE_SQL:
        assert len(rows)
        return
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    other = db.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(rows.columns)
    assert columns == sorted(other.columns)
    clean = lambda df: sorted(tuple("" if str(x) in ("nan", "None", "<NA>") else str(x).removesuffix(".0") for x in r) for r in df[columns].itertuples(index=False))
    assert clean(rows) == clean(other)


def test_paths(spark):
    yes = ["a/b.go", "ent/schema/x.go", "README.md", "x.less"]
    no = ["a/i18n/b.ts", "x.pb.go", "ent/x.go", "a.txt", "README.zh-CN.md", "a/[locale]/b.ts", "wire_gen/wire_gen.go", "x.arb", "gen/a.go"]
    assert values(spark, classify.is_translatable, yes + no) == [True] * len(yes) + [False] * len(no)


def test_normal_form_and_hash(spark):
    a, b, c = values(spark, T.seg_hash, ["用户　 名", " 用户 名 ", "e\u0301"])
    assert a == b == hashlib.sha1("用户 名".encode()).hexdigest() and c == values(spark, T.seg_hash, ["\u00e9"])[0]


def test_quoting_and_spacing(spark):
    assert values(spark, T.fix_spacing, ["URLParser of", "an XML tree", "HTTPSPort"]) == ["URL Parser of", "an XML tree", "HTTPS Port"]
    assert values(spark, lambda c: T.escape_literal(c, F.lit("q.sql")), ["don't \\ \"x\""]) == ["don''t \\ \"x\""]
    assert values(spark, lambda c: T.escape_literal(c, F.lit("q.ts")), ["say \"x\" \\"]) == ['say \\"x\\" \\\\']
    assert values(spark, T.heading_slug, ["#### Left & Right (both)", "# 数据 Flow 图", "## under_score-dash?"]) == ["left--right-both", "数据-flow-图", "under_score-dash"]
    assert values(spark, T.blank_literals, ["f(\"a\\\"b\") /* c */ + 'd' // e", "g(`h`) # i"]) == ["f(\"\") /**/ + '' //", "g(``) #"]


def test_protect(spark):
    got = values(spark, T.protector(("Kafka", "Kafka Streams")), ["调用 loadPage(n) 经 Kafka Streams 见 https://x.y/zW", "nothing here", "`a.b` a.bc.de %5d ${k.v} SOME_KEY", None])
    assert got == ["调用 <x>loadPage</x>(n) 经 <x>Kafka Streams</x> 见 <x>https://x.y/zW</x>", "nothing here", "<x>`a.b`</x> <x>a.bc.de</x> <x>%5d</x> $<x>{k.v}</x> <x>SOME_KEY</x>", None]


def test_lines_and_prefix_sums(spark):
    cases = ["", "a", "a\n", "a\n\nb\r\nc\u2028d\n"]
    assert values(spark, T.lines, cases) == [c.splitlines() for c in cases]
    rows = spark.sql("select sequence(1, 1000) a union all select array() a union all select array(7) a").select(T.prefix_sums(F.col("a"))).collect()
    assert sorted(len(r[0]) for r in rows) == [0, 1, 1000] and max(rows, key=lambda r: len(r[0]))[0] == [sum(range(1, i)) for i in range(1, 1001)]


SWITCHED = [
    ("# Tool\n\nold words\n", "# Tool\n\n[English](./README.md) · [简体中文](./README.zh-CN.md)\n\nold words\n"),
    ("# Tool\n\n<div class='c'>\n[EN](README_en.md) · [中](README_zh.md)\n</div>\n\nend", "# Tool\n\n[English](./README.md) · [简体中文](./README.zh-CN.md)\n\nend\n"),
    ("<div>\nlogo\n[EN](README_en.md) | **中文**\n</div>\n# Tool\n", "<div>\nlogo\n</div>\n# Tool\n\n[English](./README.md) · [简体中文](./README.zh-CN.md)\n"),
    ("<p>\nREADME_en.md README_ja.md\nREADME_fr.md README_zh.md\n</p>\ntext\n", "\n[English](./README.md) · [简体中文](./README.zh-CN.md)\ntext\n"),
    ("", "\n[English](./README.md) · [简体中文](./README.zh-CN.md)\n"),
]


def test_switchers(spark):
    rows = [(f"d{i}/README.md", t) for i, (t, _) in enumerate(SWITCHED)] + [(f"d{i}/README.zh-CN.md", "x") for i in range(len(SWITCHED))] + [("alone/README.md", "# Alone\n")]
    once = rewrite.switchers(spark.createDataFrame(rows, "file string, text string"))
    got = {r.file: r.text for r in once.collect()}
    assert [got[f"d{i}/README.md"] for i in range(len(SWITCHED))] == [t for _, t in SWITCHED] and "alone/README.md" not in got
    assert {r.file: r.text for r in rewrite.switchers(once).collect()} == got
    lines = ["Read [this](README.md) first | then the rest of it", "[A](README_en.md) | [B](CHANGES.md)", "[A](README_en.md) · **B**", "README.md or README_ja.md"]
    assert values(spark, T.is_stale_switcher, lines) == [False, False, True, True]


@pytest.mark.parametrize("lang,text", [("go", "// 用户 name\nx := \"创建\" + 名\n"), ("proto", "/* 用户 */ rpc 名 = 1; // 创建"), ("typescript", "const 名 = `创建 ${x}` // 用户")])
def test_code_spans(lang, text):
    spans = extract.code_spans(text, lang)
    assert {s["src"] for s in spans} == {"用户", "创建"}
    assert all(text.encode()[s["start"] : s["end"]].decode() == s["src"] for s in spans)


def test_markdown_spans():
    text = "---\ntitle: 用户\n---\n# 创建\n`名` [用](户.md)\n```\n名\n```\n"
    assert [s["src"] for s in extract.markdown_spans(text)] == ["创建", "用"]


def test_line_spans_of_long_and_odd_texts(spark):
    rng = random.Random(4)
    texts = ["", "用", "\n\n　用 户　,x // 名\n", "".join(rng.choice(["用", "户", " ", "a", "\n", "é", "。", "--"]) for _ in range(20_000))]
    got = extract.extract_lines(spark.createDataFrame(list(enumerate(texts)), "file int, text string")).collect()
    run = re.compile("[一-鿿　-〿＀-￯](?:[一-鿿　-〿＀-￯\\s,.:;()'\"-]*[一-鿿　-〿＀-￯])?")
    want = set()
    for i, t in enumerate(texts):
        at = 0
        for line in t.split("\n"):
            for m in run.finditer(line):
                body = m.group().strip()
                if re.search("[一-鿿]", body):
                    start = at + len(line[: m.start() + len(m.group()) - len(m.group().lstrip())].encode())
                    want.add((i, start, start + len(body.encode()), body, "comment" if re.search("//|#|--", line) else "string"))
            at += len(line.encode()) + 1
    assert {(r.file, r.start, r.end, r.src, r.kind) for r in got} == want and len(got) == len(want)


def fake(engine, log, answer):
    """An engine that notes every text it is sent, in a file, as tasks run in other processes."""

    class Fake:
        name = engine

        def translate(self, texts):
            with open(log, "a", encoding="utf-8") as f:
                f.writelines(f"{engine} {t}\n" for t in texts)
            return [answer(t) for t in texts]

    return Fake()


def test_chain_and_arity(spark, tmp_path):
    segments = spark.createDataFrame([("1", "用"), ("2", "户"), ("3", "名")], "h string, src string")
    words = spark.createDataFrame([("用", "use")], "src_norm string, en string")

    class Short:
        name = "short"

        def translate(self, texts):
            return texts[1:]

    log = str(tmp_path / "log")
    done = memory.chain(segments, [memory.DictionaryEngine(words), fake("a", log, lambda t: "" if t == "名" else "A" + t), fake("b", log, lambda t: "B" + t)])
    assert {(r["h"], r["en"], r["engine"]) for r in done.collect()} == {("1", "use", "dictionary"), ("2", "A户", "a"), ("3", "B名", "b")}
    assert done.count() == 3 and sorted(open(log, encoding="utf-8").read().split("\n")) == ["", "a 名", "a 户", "b 名"]
    assert memory.chain(segments, []).count() == 0
    with pytest.raises(Exception, match="short returned 2 results for 3"):
        memory.resolve_batches(segments.coalesce(1), Short()).collect()
    with pytest.raises(ValueError):
        memory.get_engine("none")


def test_request_engine():
    sent, fail = [], [1, 1, 1]

    def send(texts):
        if fail and fail.pop():
            raise OSError("busy")
        sent.append(texts)
        return ["%" + t for t in texts]

    engine = memory.RequestEngine("remote", send, ("Kafka",), batch=2, pause=0)
    assert engine.translate(["a Kafka b", "runJob() c", "d"]) == ["%a Kafka b", "%runJob() c", "%d"]
    assert sent == [["a <x>Kafka</x> b", "<x>runJob</x>() c"], ["d"]]
    fail[:] = [1] * 4
    with pytest.raises(RuntimeError, match="remote gave up after 4 attempts: busy"):
        engine.translate(["e"])
    assert memory.LocalEngine("own", lambda: str.upper).translate(["f"]) == ["F"]


def test_missing_and_upsert(spark):
    known = spark.createDataFrame([("b", "s", "old", "e")], readers.MEMORY)
    asked = spark.createDataFrame([("c", 0), ("b", 1), ("a", 2), ("c", 3)], "h string, at int")
    assert [r.h for r in memory.missing(asked, known).collect()] == ["c", "a"]
    new = spark.createDataFrame([("b", "s", "one", "e", 1), ("b", "s", "two", "e", 2), ("d", "s", "x", "e", 0)], readers.MEMORY + ", seq int")
    assert {(r.h, r.en) for r in memory.upsert(known, new).collect()} == {("b", "two"), ("d", "x")}
    assert memory.remembered(known).count() == 1 and memory.remembered(known, ["z"]).count() == 0


def edited(spark, file, raw, edits):
    """edits: (part of raw, kind, value, hash or None for its own)."""
    raw = raw.encode()
    at = [(raw.index(x.encode()), x, kind, value, h) for x, kind, value, h in edits]
    key = lambda x: hashlib.sha1(x.encode()).hexdigest()
    spans = spark.createDataFrame([(file, a, a + len(x.encode()), h or key(x), kind) for a, x, kind, _, h in at], "file string, start int, end int, h string, kind string")
    known = spark.createDataFrame([(h or key(x), "", value, "e") for _, x, _, value, h in at], readers.MEMORY)
    row = rewrite.splice(spark.createDataFrame([(file, raw)], "file string, content binary"), spans, known).first()
    return bytes(row.content).decode(), row.n


def test_splice_rules(spark):
    assert edited(spark, "q.sql", "v = '名' -- 读URL写", [("名", "string", "that's", None), ("读", "comment", "read", None), ("写", "comment", "Write", None)]) == ("v = 'that''s' -- read URL Write", 3)
    assert edited(spark, "q.go", "a「名」。用，b", [("名", "comment", "JSONName", None), ("用", "comment", "use", None)]) == ("a「JSON Name」。 use ，b", 2)
    assert edited(spark, "q.go", "s := `名` + \"用\"", [("名", "raw_string", "a`b", None), ("用", "string", "say \"x\"", None)]) == ("s := `名` + \"say \\\"x\\\"\"", 1)
    assert edited(spark, "q.go", "// 名", [("名", "comment", "x", "0" * 40)]) == ("// 名", 0)
    assert edited(spark, "q.md", "## 数据\n[a](#数据) [b](other.md#数据) [c](#none)\n", [("数据", "comment", "Data", None)]) == ("## Data\n[a](#data) [b](other.md#data) [c](#none)\n", 1)


def test_anchor_repair(spark):
    texts = {"a.md": ("# 一\n```\n# 二\n```\n## 三\n", "# One\n```\n# Two\n```\n## Three\n[x](#一) [y](#二) [z](p.md#三)\n"), "b.md": ("# 一\n", "# One\n# More\n[x](#一)\n")}
    frame = lambda k: spark.createDataFrame([(f, t[k]) for f, t in texts.items()], "file string, text string")
    got = {r.file: r.text for r in rewrite.repair_anchors(frame(0), frame(1)).collect()}
    assert got == {"a.md": "# One\n```\n# Two\n```\n## Three\n[x](#one) [y](#二) [z](p.md#three)\n", "b.md": texts["b.md"][1]}


def test_drift(spark):
    go = "func Save(k string) {\n\tmail := `头\nto: all\nend` + Tail(k)\n}\n"
    rows = [
        ("a.go", 'msg := "名"\nlimit := 1\n', 'msg := "name"\nceiling := 1\n'), ("b.go", "// 名\n", "// name := 1\n"), ("c.py", "a = 1", "b = 1"),
        ("d.go", go, go.replace("头", "Head: x").replace("to: all", "to: none").replace("Tail(k)", "Rest(k)")), ("e.proto", "/* 一\n二: */\n", "/* one\ntwo: */\n"),
    ]
    got = checks.drift(spark.createDataFrame(rows, "file string, before string, after string")).collect()
    assert sorted((r["file"], r["detail"], r["n"]) for r in got) == [("a.go", "ceiling := 1", 2), ("d.go", "end` + Rest(k)", 4)]


def test_moves(spark):
    rows = [("README.md", True), ("README_en.md", False), ("docs/a.md", True), ("docs/CHANGELOG.md", True), ("x/README.md", True), ("x/README.zh-CN.md", True)]
    moves = rewrite.plan_moves(spark.createDataFrame(rows, "file string, has_script boolean"))
    assert {(r["src"], r["dst"]) for r in moves.collect()} == {("README.md", "README.zh-CN.md"), ("README_en.md", "README.md"), ("docs/a.md", "docs/zh-CN/a.md")}
    files = spark.createDataFrame([("README.md", "zh"), ("README_en.md", "en"), ("docs/a.md", "[l](b.md) [m](https://u) [n](#o)")], "file string, text string")
    assert {r.file: r.text for r in rewrite.apply_moves(files, moves).collect()} == {"README.zh-CN.md": "zh", "README.md": "en", "docs/a.md": "[l](b.md) [m](https://u) [n](#o)", "docs/zh-CN/a.md": "[l](../b.md) [m](https://u) [n](#o)"}


def tree(folder):
    (folder / "docs").mkdir(parents=True)
    (folder / "node_modules").mkdir()
    (folder / "main.go").write_text("// 用户\nfunc main() {} // 名\n", encoding="utf-8")
    (folder / "README.md").write_text("# 创建\n[x](gone.md) [y](#创建)\n", encoding="utf-8")
    (folder / "docs" / "b c+d.md").write_text("用户", encoding="utf-8")
    (folder / "node_modules" / "z.md").write_text("用户", encoding="utf-8")


def test_tree_end_to_end(spark, tmp_path):
    """Every engine sees each segment once, whatever is read of the results."""
    root = tmp_path / "a.b (c)"
    tree(root)
    log = str(tmp_path / "log")
    words = spark.createDataFrame([("用户", "User"), ("创建", "Create")], "src_norm string, en string")
    out = pipeline.run(spark, str(root), spark.createDataFrame([], readers.MEMORY), [memory.DictionaryEngine(words), fake("a", log, lambda t: ""), fake("b", log, lambda t: "Name")])
    files = {r["file"]: r["text"] for r in out["files"].collect()}
    assert files["main.go"] == "// User\nfunc main() {} // Name\n" and "README.zh-CN.md" in files and "docs/zh-CN/b c+d.md" in files
    assert "[y](#create)" in files["README.md"] and files["node_modules/z.md"] == "用户"
    assert {r["check"] for r in out["findings"].collect()} >= {"broken_link"}
    assert {r.file: r.n for r in out["rewritten"].collect()} == {"main.go": 2, "README.md": 1, "docs/b c+d.md": 1} and out["memory"].count() == 3
    assert sorted(open(log, encoding="utf-8").read().split("\n")) == ["", "a 名", "b 名"]
    assert set(pipeline.run(spark, str(root), out["memory"], [], dry_run=True)) == {"moves"}
    assert pipeline.run(spark, str(root), out["memory"], [])["rewritten"].count() == 3


def test_cli(spark, tmp_path, monkeypatch):
    tree(tmp_path / "in" / "one")
    monkeypatch.setattr(cli.SparkSession.Builder, "getOrCreate", lambda self: spark)
    (tmp_path / "words.tsv").write_text("# note\n用户\tfirst\n用户\tUser\nbroken\n创建\tCreate\n", encoding="utf-8")
    call = lambda step, *more: cli.main([step, str(tmp_path / "in"), "--repo", "one", "--out", str(tmp_path / "out"), "--dictionary", str(tmp_path / "words.tsv"), *more])
    assert call("docs", "--dry-run") == 0 and not (tmp_path / "out").exists()
    assert call("run") == 1 and call("verify", "--skip-build") == 1
    saved = readers.read_memory(spark, str(tmp_path / "out" / "memory"))
    assert {(r.src, r.en) for r in saved.collect()} == {("用户", "User"), ("创建", "Create")}
    assert call("translate", "--memory", str(tmp_path / "out" / "memory")) == 0
    assert readers.read_occurrences(spark, str(tmp_path / "out" / "occurrences")).count() == 4
    assert call("verify", "--baseline", str(tmp_path / "out" / "findings")) in (0, 1)
    with pytest.raises(ValueError):
        cli.main(["docs", str(tmp_path), "--repo", "..", "--out", "x"])


def test_readers(spark, tmp_path):
    (tmp_path / "g.txt").write_text("# note\nKafka\n\nAvro\n", encoding="utf-8")
    assert readers.read_glossary(spark, str(tmp_path / "g.txt")) == ("Avro", "Kafka")
    for i in range(3):
        (tmp_path / f"m{i}.jsonl").write_text(f'{{"h": "k", "src": "s", "en": "v{i}", "engine": "e"}}\n\n', encoding="utf-8")
    assert [r.en for r in readers.read_memory(spark, str(tmp_path / "m*.jsonl")).collect()] == ["v2"]
    tree(tmp_path / "t")
    assert {r.file for r in readers.scan_markdown(spark, str(tmp_path / "t")).collect()} == {"README.md", "docs/b c+d.md"}
    assert {(r.file, r.lang) for r in readers.scan_translatable(spark, str(tmp_path / "t")).collect()} == {("README.md", "markdown"), ("main.go", "go"), ("docs/b c+d.md", "markdown")}
    files = readers.scan_files(spark, str(tmp_path / "t"))
    assert [r.folder for r in readers.readme_folders(files).collect()] == [""]


def test_stream(spark, tmp_path):
    """A segment is looked up once over all batches; a repeated batch replaces its own rows."""
    source, words = str(tmp_path / "in"), spark.createDataFrame([("用户", "User"), ("名", "Name")], "src_norm string, en string")
    put = lambda *rows: spark.createDataFrame(rows, "file string, text string, lang string").write.mode("append").parquet(source)
    for n, rows in enumerate(([("a", "用户", "yaml")], [("b", "用户", "yaml"), ("c", "名", "yaml")])):
        put(*rows)
        stream = spark.readStream.schema("file string, text string, lang string").parquet(source)
        incremental.follow(stream, str(tmp_path / "memory"), [memory.DictionaryEngine(words)], str(tmp_path / "state")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "memory"))
        assert {(r.src, r.en) for r in got.collect()} == {("用户", "User"), ("名", "Name")[: 2 * n]} - {()} and got.count() == n + 1


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_top_findings_of_all_sources(spark, tmp_path):
    """Documents without a source or of any name are ranked too, as in the SQL."""
    rows = [(1, "aeiou", "en", "src0"), (2, "aeiou aeiou", "de", None), (3, "aeiou aeiou aeiou", "es", "hot")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.check, r.file, r["rank"]) for r in queries.top_findings(spark, str(tmp_path)).collect()}
    assert {x for x in got if x[0] == "residual"} == {("residual", "3", 1), ("residual", "2", 2), ("residual", "1", 3)}
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == {(c, f, r) for c, f, _, _, r in db.sql(queries.ORACLE_SQL["top_findings"]).fetchall()}
