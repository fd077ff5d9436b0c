"""The ten operators on small inputs: brute force, planted cases, nulls, empty tables, repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyseg.llm import decontamination, html_text, lm_scoring, minhash, mixing, pii, registry, sharding, suffix_dedup, topk, toxicity

DOCS = "doc_id long, text string, source string, __h string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls everywhere, empty and long texts, ties and repeated rows, and a clashing extra column."""
    rows = [(1, "a b c d e f g", "s", None), (1, "a b c d e f g", "s", None), (2, None, None, "x"), (None, "w x y z q r", "t", None), (3, "", "t", None), (4, "lang " * 30000, "s", None), (5, "A B c d e f g", None, "y"), (6, "one", "t", None)]
    return spark.createDataFrame(rows, DOCS)


def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_mixing(spark, odd):
    folder = "/root/testdata/sf0.01"  # 50 documents a source: with ten, no choice of whole copies comes within 2 %
    got = mixing.op1_mixing(spark, folder).toPandas()
    per = got.groupby("source").agg(t=("target", "max"), k=("taken", "sum"), s=("size", "sum"), n=("source_size", "max"))
    assert (per.s == per.n).all() and abs(per.t.sum() - per.s.sum()) < 1e-3
    assert (abs(per.k - per.t) <= np.maximum(10, 0.02 * per.t)).all() and (got.taken <= 3 * got["size"]).all()
    again = mixing.op1_mixing(spark, folder).toPandas()
    assert sorted(map(tuple, got[["doc_id", "taken"]].to_numpy())) == sorted(map(tuple, again[["doc_id", "taken"]].to_numpy()))
    assert mixing.mix_sources(odd).count() == 8 and mixing.mix_sources(nothing(spark)).count() == 0


def test_sharding(spark, odd):
    got = sharding.op6_sharding(spark, SF).toPandas()
    n = got.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert n["count"].max() - n["count"].min() <= 1 and (n["max"] + 1 == n["count"]).all() and (n["nunique"] == n["count"]).all()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 16 for r in got.itertuples())
    # the order is that of fractional ranks within sources
    assert sharding.interleave_shards(odd).count() == 8 and sharding.interleave_shards(nothing(spark)).count() == 0


def brute_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        flag = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                flag[p : p + 100] = True
            seen.add(b[p : p + 100])
        kept = bytes(c for c, f in zip(b, flag) if not f)
        out[i] = (len(b), int(flag.sum()), int((np.diff(flag.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, odd):
    rng = random.Random(5)
    pool = ["a", "b", "foo bar ", "é", "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna "]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 50)))) for i in range(80)] + [(900, "a" * 2000), (901, None), (902, "")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(odd).count() == 8 and suffix_dedup.remove_repeats(nothing(spark)).count() == 0
    twice = spark.createDataFrame([(7, "xyz " * 10 + "".join(map(str, range(60))))] * 2, "doc_id long, text string")
    assert {r.n_removed for r in suffix_dedup.remove_repeats(twice).collect()} == {0}


def test_deep_shallow():
    rng = random.Random(3)
    s = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 20))) * rng.randint(1, 5) for _ in range(800)]
    bucket = np.array([rng.randint(0, 5) for _ in s])
    for shallow in (0, 8, 56):
        order, _ = suffix_dedup.deep_shallow(s, bucket, 100, shallow)
        assert [(bucket[i], s[i]) for i in order] == sorted(zip(bucket, s))


def test_pii(spark, odd):
    text = "mail a.b@x-y.co.uk or +1 (605) 555-9305, 10.0.0.255 not 300.1.1.1; card 4111 1111 1111 1111 é"
    assert [(k, text[s:e]) for k, s, e in pii.base_spans(text)] == [("email", "a.b@x-y.co.uk"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (605) 555-9305")]
    rows = pii.find_personal_data(odd.unionByName(spark.createDataFrame([(9, text, None, None)], DOCS))).collect()
    assert len(rows) == 9 and [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows if r.doc_id == 9] == [(1, 1, 1, 1)]
    assert {r.base_sha256 for r in rows if r.doc_id == 2} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find_personal_data(nothing(spark)).count() == 0


def test_pii_model_held_out():
    x, y = pii.training_rows(["the", "and", "of", "words"])
    model = pii.BiLstmCrf().fit(x, y)
    a, b = pii.training_rows(["the", "and", "of", "words"], 200, seed=77)
    found = model.viterbi(a.T).T
    assert (found == b).mean() > 0.97 and (found == b)[b > 0].mean() > 0.9


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 8) / 256]) for i in range(400)] + [(1000, None), (1050, [float("nan")] * 8), (1100, [None] * 8)]
    v = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = collections.defaultdict(list)
    for r in topk.top_k(v, v.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    m = np.array([np.floor(np.array(x, np.float32).astype(float) * 256) for _, x in rows[:400]]).astype(int)
    for q in range(0, 400, 50):
        s = m @ m[q]
        assert got[q] == [(i, s[i]) for i in sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:5]]
    assert len(got) == 8


def test_toxicity(spark, odd):
    got = toxicity.op5_toxicity(spark, "/root/testdata/sf0.01").join(toxicity.toxic_labels(spark, "/root/testdata/sf0.01"), "doc_id").toPandas()
    assert (got.toxic == (got.grade > 0)).mean() > 0.97
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert {r.tox.severity for r in toxicity.with_severity(odd, none).collect()} == {0.0}


def test_decontamination(spark, odd):
    item = "which tall bird eats small fish near the cold river at dawn. the grey heron does so every single day"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "before " * 90 + item + " after" * 70), (2, item[: len(item) // 2] + " nothing else"), (3, None), (4, "the bird " * 50)], "doc_id long, text string")
    got = decontamination.with_contamination(docs, bench)
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in got.collect()} == {1: [1], 2: [], 3: [], 4: []}
    assert decontamination.with_contamination(odd, bench.where("item_id = 9")).where(F.size("leaks") > 0).count() == 0
    rows = decontamination.op7_decontamination(spark, SF).collect()
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    brute = {(r.doc_id, i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, t in items.items() if t in " ".join(words(r.text))}
    assert brute <= {(r.doc_id, r.item_id) for r in rows}


def test_html(spark):
    page = "<html><head><title>T</title></head><body><nav>menu</nav><div class='cookie-notice'>ok?</div><article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four&nbsp;five<script>x('</p>')</script><div class=\"ad\">buy</div></article><section class='comments'><article>hi</article></section><footer>f</footer>"
    rows = [(1, "http://h/a", page), (2, None, None), (3, "http://h/b", "plain <b>te</b>xt"), (1, "http://h/a", page)]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(1, "A & B one two three four five"), (1, "A & B one two three four five"), (2, ""), (3, "plain text")]


def test_lm(spark, odd):
    rows = [(i, t) for i, t in enumerate(["the cat sat", "the dog sat on the cat", "", None, "unseen words here now", "the the the"] * 6)]
    got = lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count, held = collections.Counter(), {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            count.update([*(t or "").split(), "\0"])
    z = sum(count.values()) + 0.5 * (len(count) + 1)
    for r in got:
        w = [*(rows[r.doc_id][1] or "").split(), "\0"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(count[x] > 0 for x in w), sum(count.values()))
        assert abs(r.base_score - sum(np.log10((count[x] + 0.5) / z) for x in w)) < 1e-9 and r.score < 0
    assert lm_scoring.score_documents(odd).count() == 8 and lm_scoring.score_documents(nothing(spark)).count() == 0


def test_attention_windows_score_each_id_once():
    ro = np.cumsum([0, 1, 5, 32, 33, 200])
    start, end, skip = lm_scoring.cut_windows(ro)
    hits = np.zeros(ro[-1], int)
    for s, e, k in zip(start, end, skip):
        hits[s + k : min(s + lm_scoring.WINDOW, e)] += 1
    assert (hits == 1).all()


def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_minhash(spark, odd):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 99)}" for _ in range(150)]
    rows = [(i, " ".join(w if rng.random() > 0.012 else f"x{rng.randint(0, 999)}" for w in base)) for i in range(90)] + [(200, None), (201, ""), (202, "a b"), (203, "A B"), (204, "a c")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(odd).count() == 8 and minhash.near_duplicates(nothing(spark)).count() == 0


@pytest.mark.parametrize("tail", [0, 16, minhash.TAIL])
def test_components(spark, tail):
    """A path, a star, a self link, repeated links and small groups, in many rounds and by the tail alone."""
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(600, 700)] + [(-4, 500), (900, 900)] + [(rng.randrange(1000, 1090), rng.randrange(1000, 1090)) for _ in range(50)] * 2
    group = {v: {v} for link in links if link[0] != link[1] for v in link}
    for a, b in links:
        if a != b and group[a] is not group[b]:
            group[a] |= group[b]
            for v in group[b]:
                group[v] = group[a]
    got = minhash.components(spark.createDataFrame(links, "a long, b long"), tail).collect()
    assert len(got) == len(group) and all(r.c == min(group[r.v]) for r in got)
    assert minhash.components(spark.createDataFrame([], "a long, b long"), tail).count() == 0


def test_superminhash_estimates():
    rng = np.random.default_rng(4)
    a = rng.integers(1, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], rng.integers(1, 2**63, 100, dtype=np.uint64)])
    sig = minhash.superminhash(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 400, 800]), 256)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.1


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
    assert len(registry.QUERIES) == 10


@pytest.mark.parametrize("group", [lm_scoring.FIT_BYTES, 300_000])
def test_lm_learns_from_long_texts(spark, monkeypatch, group):
    """Training texts of 45,000 bytes alone teach what follows what, in one group and in averaged rounds of groups."""
    monkeypatch.setattr(lm_scoring, "FIT_BYTES", group)
    rows = [(i, "red blue " * 5000) for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([*rows, (held, "red blue " * 50)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    assert len(got) == len(rows) + 1 and got[held].score > 0.3 * got[held].base_score


def test_html_template_decides(spark):
    """Fixed text of a host goes inside articles too, but not the text of copies; a small article doesn't hide the slots around it."""
    def page(i, same="own"):
        return f"<html><body><nav>m{i}</nav><div class='top'>Our Site</div><div class='x'><p>long story {i} of many words here</p></div><article><p>{same} note {i}</p><div class='zz'>Get our app</div></article></body></html>"

    def long(i):
        return f"<html><body><p>Site {i}</p><article><h1>Title {i}</h1><p>story {i} goes on and on</p><p class='zz'>Get our app</p></article></body></html>"

    rows = [(i, "http://a/x", page(i)) for i in range(5)] + [(10 + i, "http://b/x", long(i)) for i in range(5)] + [(20 + i, "http://c/x", long(9)) for i in range(5)]
    got = {r.page_id: r.text for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: f"long story {i} of many words here own note {i}" for i in range(5)} | {10 + i: f"Title {i} story {i} goes on and on" for i in range(5)}
    assert got == want | {20 + i: "Title 9 story 9 goes on and on Get our app" for i in range(5)}


def test_near_dedup_stage_of_null_and_repeated_ids(spark):
    """Different texts stay, whatever their ids; of copies one row stays, and rows without words stay."""
    import corpus_pipeline

    rng = random.Random(8)
    text = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(60)) for _ in range(12)]
    near = text[0] + " end"
    rows = [*((None, t, "s") for t in text[:6]), (7, text[6], "s"), (7, text[7], "s"), (3, near, "s"), (9, text[8], "s"), (9, text[8], "s"), (7, near.upper(), "t"), (None, None, "s"), (None, "", "s"), (11, " \n", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    want = [*rows[1:10], *rows[12:]]
    assert sorted(map(str, got)) == sorted(map(str, want))
    out = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 80).collect()}
    assert {(None, 3, False), (None, None, True), (7, 3, False), (3, 3, True), (7, 7, True)} <= out


def test_blocks_verify_pairs_of_one_band():
    import pandas as pd

    own = np.arange(1, 20, dtype=np.uint64)
    block = lambda c, first: pd.DataFrame({"n": [19], "c": [c], "bands": [np.array([first, *range(c * 100, c * 100 + minhash.BANDS - 1)])], "shingles": [own.tobytes()]})
    edges = minhash._block_edges(85)
    assert len(edges(None, block(1, 7), block(2, 7))) == 1 and len(edges(None, block(1, 7), block(2, 8))) == 0
