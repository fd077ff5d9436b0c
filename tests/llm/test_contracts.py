"""The operators against plain versions of what they compute, and the cases that their docstrings state."""

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyseg.llm import decontamination, html_text, lm_scoring, minhash, mixing, pii, sharding, topk, toxicity
from test_llm import SF, brute_components

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lower_words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def test_mixing_against_bisection(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 60))), rng.choice(["a", "b", "c", None])) for i in range(400)] + [(1000 + i, "x", "d") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs).toPandas()
    own = collections.Counter()
    for _, t, s in rows:
        own[s] += len(t.split())
    names = ["a", "b", "c", "d", None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(own.values())
    while True:  # water filling, source by source
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * own[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * own[s]
            left -= target[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    for s in names:
        mine = got[got.source.isna()] if s is None else got[got.source == s]
        assert np.allclose(mine.target, target[s]) and (mine.source_size == own[s]).all()
        size = mine["size"].to_numpy(float)
        low, high = -50.0, 50.0
        for _ in range(200):  # the dual of one source by bisection
            mid = (low + high) / 2
            if (size * np.minimum(3, np.exp(np.minimum(50, mid * size / size.mean())))).sum() < target[s]:
                low = mid
            else:
                high = mid
        rate = np.minimum(3, np.exp(np.minimum(50, low * size / size.mean())))
        per = mine.assign(rate=rate).groupby("size").agg(n=("copies", "size"), copies=("copies", "sum"), rate=("rate", "first"))
        off = (per.copies - per.n * per.rate).abs()
        assert off.sum() <= len(per) + 8 and abs(mine.taken.sum() - target[s]) <= max(1, 0.002 * target[s])  # rounded by turns, then a few moved
        assert mine.copies.between(0, 3).all() and (mine.copies - mine.rate if "rate" in mine else mine.copies * 0).abs().max() < 3


CLASH = "doc_id long, text string, source string, __h string, copies string, size string, __rest string, shard string, leaks string, v string"


def clashing(spark):
    return spark.createDataFrame([(i, None if i % 4 == 0 else f"w{i} b c", f"s{i % 2}", *["mine"] * 7) for i in range(12)] + [(None, "", None, *["mine"] * 7)] * 2, CLASH)


def test_columns_of_any_name_stay(spark):
    docs = clashing(spark)
    mixed = mixing.mix_sources(docs)
    assert {(r["__h"], r["__rest"], r.shard, r.v) for r in mixed.collect()} == {("mine",) * 4} and dict(mixed.dtypes)["copies"] == "int"
    dealt = sharding.interleave_shards(docs)
    assert {(r["__h"], r.copies, r["__rest"]) for r in dealt.collect()} == {("mine",) * 3} and dealt.count() == 14


def test_sharding_is_by_fractional_rank(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.interleave_shards(docs).select("source", "shard", "slot").toPandas().sort_values(["shard", "slot"])
    rank = got.groupby("source").cumcount() + 1
    key = (2 * rank - 1) / (2 * got.groupby("source").slot.transform("size"))
    assert (np.diff(key.to_numpy()) >= -1e-12).all()
    share = got.groupby("source").size() / 40
    table = got.groupby(["shard", "source"]).size().unstack(fill_value=0)
    assert (table.sub(share, axis=1).abs() <= 1.5).all().all()


def plain_personal(text):
    """The base patterns as stated."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        double = [sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))]
        if 13 <= len(d) <= 19 and sum(double) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]


def test_personal_data_against_plain_patterns():
    rng = random.Random(12)
    alphabet = ["1", "2", "55", "0", ".", ".", "-", " ", "+", "@", "a", "b.c", "x@y.z", "(", ")", "é", "10.0.0.1", "4111111111111111", "+1 605 555 9305", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30)))
        assert pii.base_spans(text) == plain_personal(text), text
    began = time.time()
    pii.base_spans("1." * 300_000 + "a@" * 100_000 + "+1 " * 100_000 + "1 " * 200_000)
    assert time.time() - began < 20


def test_toxicity_on_rows_that_were_not_fitted(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), toxicity.toxic_labels(spark, folder)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit_toxicity(docs, labels.where(half))
    rows = docs.join(labels.where(~half).groupBy("doc_id").agg(F.max("grade").alias("grade")), "doc_id").toPandas()
    import pyarrow as pa

    toxic = model.above(model.scores(pa.array(rows.text)))[:, 0] > model.cut
    assert toxic[rows.grade > 0].mean() > 0.8 and toxic[rows.grade == 0].mean() < 0.03
    repeated = labels.where(half).unionByName(labels.where(half).withColumn("grade", F.lit(0))).unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, grade int"))
    assert np.allclose(np.sort(toxicity.fit_toxicity(docs, repeated).weights), np.sort(model.weights))
    assert toxicity.with_severity(docs.limit(0), labels.limit(0)).count() == 0


def brute_leaks(docs, items):
    """(doc_id, item_id) by BM25 of every window and item."""
    bags = {i: lower_words(t) for i, t in items if lower_words(t)}
    n, mean, df = len(bags), sum(map(len, bags.values())) / len(bags), collections.Counter(w for b in bags.values() for w in set(b))
    idf = {w: math.log1p((n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    impact = {i: {w: idf[w] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(b) / mean)) for w, c in collections.Counter(b).items()} for i, b in bags.items()}
    step, out = max(map(len, bags.values())), set()
    raw = dict(items)
    for d, t in docs:
        w = lower_words(t)
        for at in range(0, len(w), step):
            window = w[at : at + 2 * step]
            have = set(window)
            for i, b in bags.items():
                if sum(x for k, x in impact[i].items() if k in have) < 0.5 * sum(impact[i].values()):
                    continue
                k = min(5, len(b))
                cuts = [m.end() for m in re.finditer(r"[.?!]+[\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])", raw[i])]
                before = len(WORD.findall(raw[i][: cuts[-1]])) if cuts else len(b) // 2
                grams = {tuple(window[j : j + k]) for j in range(len(window) - k + 1)}
                parts = {tuple(b[j : j + k]) for j in range(len(b) - k + 1) if j + k - 1 < before}, {tuple(b[j : j + k]) for j in range(len(b) - k + 1) if j + k - 1 >= before}
                if len(window) >= k and all(len(p & grams) >= 0.8 * len(p) for p in parts):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("part_bytes", [decontamination.PART_BYTES, 1000])
def test_decontamination_against_all_windows(spark, part_bytes):
    rng = random.Random(1)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [(901, "a b"), (902, "a b"), (903, None)]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for k in range(40):  # items with words dropped and put in, between words of other texts
        text = lower_words(rng.choice(items[:-3])[1])
        text = [w if rng.random() > 0.03 * (k % 4) else "zz" for w in text]
        docs.append((5000 + k, " ".join(lower_words(docs[k][1])[: 10 * k] + text + lower_words(docs[k + 1][1])[:30])))
    docs += [(6000, "x a B c"), (6001, ""), (6002, None)]
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = decontamination.with_contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), part_bytes=part_bytes)
    rows = {(r.doc_id, x.item_id): x.score for r in got.collect() for x in r.leaks}
    if part_bytes > 1000:  # one index: the windows are those of the longest item
        assert set(rows) == brute_leaks(docs, items) and {(6000, 901), (6000, 902)} <= set(rows)
    whole = decontamination.with_contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    exact = {(d, i) for d, t in docs for i, x in items if x and f" {' '.join(lower_words(x))} " in f" {' '.join(lower_words(t))} "}
    assert exact <= set(rows) and exact <= {(r.doc_id, x.item_id) for r in whole.collect() for x in r.leaks}
    kept = decontamination.without_contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), part_bytes=part_bytes)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in rows}


def test_wand_retrieves_what_full_scoring_does():
    rng = np.random.default_rng(3)
    vocabulary = rng.integers(1, 2**63, 300, dtype=np.uint64)
    items = [(i, rng.choice(vocabulary, rng.integers(5, 40)), 3) for i in range(100)]
    terms, df = np.unique(np.concatenate([np.unique(h) for _, h, _ in items]), return_counts=True)
    index = decontamination.ItemIndex(sorted(items, key=lambda x: len(x[1])), decontamination.Collection(100, 20.0, terms, df.astype(float)))
    blocks = list(range(-(-100 // decontamination.BLOCK)))
    for _ in range(300):
        query = np.unique(rng.integers(0, len(index.terms), rng.integers(1, 120)))
        score = np.zeros(100)
        for t in query:
            score[index.lists[t][0]] += index.lists[t][1]
        want = set(np.flatnonzero(score >= index.threshold - decontamination.SLACK).tolist())
        assert {i for i, _ in index.retrieve(query.tolist(), blocks)} == want


def naive_top(rows, k):
    good = [(i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(int)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return {q: sorted(((-int(v @ w), i) for i, w in good if i != q))[:k] for q, v in good if q % 50 == 0}


def test_top_k_of_repeated_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 3)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4) / 256]) for i in range(300)] + [(7, [0.0] * 4), (7, [0.0] * 4), (100, [1 / 256] * 4)]
    v = topk.quantized(spark.createDataFrame([*rows, (400, None), (None, [1.0] * 4), (450, [float("inf")] * 4)], "vec_id long, embedding array<float>"))
    unique = {q: rows[q][1] for q in range(0, 300, 50) if q != 100}
    got = collections.defaultdict(list)
    for r in topk.top_k(v, v.where("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
    for q in unique:
        mine = np.array(unique[q]) * 256
        assert got[q] == sorted((-int(mine @ (np.array(w) * 256)), i) for i, w in rows if i != q)[:5]
    assert len(got) == 6 and topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_top_k_prunes_clusters():
    rng = np.random.default_rng(0)
    center = rng.standard_normal((100, 64))
    x = center[rng.integers(0, 100, 20_000)] + 0.15 * rng.standard_normal((20_000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    ids = np.arange(len(x))
    search = topk.Search(ids[::50], x[::50], np.full(len(ids[::50]), -np.inf), 5)
    for a in range(0, len(x), 8_000):
        search.add(ids[a : a + 8_000], x[a : a + 8_000])
    scores = x @ x[::50].T
    scores[ids[::50], np.arange(len(ids[::50]))] = -(10**9)
    assert (np.sort(search.best[2].reshape(-1, 5), axis=1) == np.sort(scores, axis=0)[-5:].T).all()
    assert search.scored < 0.2 * search.met


def test_template_classes_against_exact_vectors(spark):
    """Tokens of equal occurrence vectors, found by comparing the vectors themselves."""
    rng = random.Random(2)
    pages = []
    for i in range(12):
        side = "<div class='s'><p>About us</p></div>" if i % 3 else ""
        body = "".join(f"<p>own {i} {j} {rng.random()}</p>" for j in range(rng.randint(1, 3)))
        pages.append((i, "http://h/x", f"<html><body><div class='top'>Logo<p>Tag line</p></div>{side}<div class='body'>{body}</div><p>End</p></body></html>"))
    frame = spark.createDataFrame(pages, "page_id long, host string, html string").select(F.xxhash64("host").alias("host"), "html")
    got = set(html_text.templates(frame).first().template)
    vectors = collections.defaultdict(lambda: [0] * 12)
    for i, _, html in pages:
        for key, (n, _) in html_text.template_tokens(html).items():
            vectors[key][i] = n
    classes = collections.defaultdict(list)
    for key, v in vectors.items():
        if sum(map(bool, v)) >= 6:
            classes[tuple(v)].append(key)
    tokens = [key for c in classes.values() if len(c) >= 2 for key in c]
    assert got == set(html_text.nested([t for t, _ in tokens], [p for _, p in tokens])) and len(got) > 8
    assert html_text.nested([5, 6, 7, 8], [0, 5, 9, 7]) == [5, 6]
    out = {r.page_id: r.text for r in html_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("old"))).collect()}
    assert all(t.startswith(f"own {i} 0") and "Logo" not in t and "End" not in t for i, t in out.items())


def test_html_of_salted_templates_and_empty_tables(spark, monkeypatch):
    page = lambda i: f"<body><p>Site</p><article><p>story {i}</p><p>Get the app</p></article><p>Foot</p></body>"
    rows = [(i, "http://h/x", page(i), "mine") for i in range(6)] + [(9, None, None, "mine")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, row string")
    plain = sorted(html_text.extract_main_text(pages).collect())
    monkeypatch.setattr(html_text, "BROADCAST", -1)
    salted = sorted(html_text.extract_main_text(pages).collect())
    assert plain == salted and [r.text for r in plain] == [*(f"story {i}" for i in range(6)), ""] and {r.row for r in plain} == {"mine"}
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<a " * 300_000, "<div>" * 200_000 + "x", "<!" * 400_000, "<a '" * 200_001 + ">x", "<p>x</div>" * 80_000, "<b>" * 200_000 + "</i>" * 10_000])
def test_html_reads_odd_pages_in_linear_time(page):
    began = time.time()
    html_text.main_text(page, {1})
    html_text.template_tokens(page)
    assert time.time() - began < 15


def test_html_keeps_articles_in_marked_layouts():
    for page in ("<div class='layout has-sidebar'><article><p>Body text</p></article></div>", "<section id='share-prices'><article><p>Body text</p></article></section>"):
        assert html_text.main_text(page, frozenset()) == "Body text"


def test_scoring_is_the_trained_function():
    rng = np.random.default_rng(8)
    model = lm_scoring.AttentionModel(rng.integers(0, 50, lm_scoring.N_IDS).astype(float), np.arange(lm_scoring.N_IDS) % 2 == 0)
    for scale in (1, 40):  # the second makes scores and logits too large for exp
        for k in ("qkv", "out", "top"):
            model.p[k] = model.p[k] * np.float32(scale)
        ids, ro = rng.integers(0, 500, 180).astype(np.int32), np.array([0, 1, 40, 180])
        got = model.score(ids, ro)
        start, end, skip = lm_scoring.cut_windows(ro)
        before = np.concatenate([[lm_scoring.END], ids[:-1]])
        before[ro[:-1]] = lm_scoring.END
        for s, e, k in zip(start, end, skip):
            x = np.full(lm_scoring.WINDOW, lm_scoring.END)
            n = min(lm_scoring.WINDOW, e - s)
            x[:n] = before[s : s + n]
            h = model._forward(x[None])[0].astype(float)
            log = lambda v: v - v.max() - np.log(np.exp(v - v.max()).sum())
            for j in range(k, n):
                y = ids[s + j]
                g, i = divmod(model.cls[y], lm_scoring.GROUP)
                own = slice(g * lm_scoring.GROUP, (g + 1) * lm_scoring.GROUP)
                want = log(h[j] @ model.p["top"] + model.p["edge"])[g] + log(h[j] @ model.p["out"][:, own] + model.p["bias"][own])[i] + model.log_in[y]
                assert abs(got[s + j] - want) < 2e-3 * max(1, abs(got[s + j]))


def test_words_encoded_together_are_as_alone():
    rng = random.Random(3)
    letters = ["a", "B", "é", "1", "'", "s", "\xa0", "\u3000", "\u2003", "\x85", "\x1c", "用", "-", "\u200b", "_", "re"]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))).encode() for _ in range(4000)]
    encode = lm_scoring.tokenizer(lm_scoring.VOCABULARY).encode_ordinary
    for some in (words, [*words[:50], b"\xff\xfe", b"x" * 3000], [b"A"], []):
        data, n = np.frombuffer(b" ".join(some) + b" ", np.uint8), np.array([len(w) for w in some], np.int64)
        end = np.cumsum(n + 1) - 1
        ids, size = lm_scoring.encode_words(lm_scoring.VOCABULARY, data, end - n, end)
        want = [encode(" " + re.sub(rb"[A-Z]", lambda m: m.group().lower(), w).decode("utf-8", "replace")) for w in some]
        assert size.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_output_gradient_against_differences():
    rng = np.random.default_rng(9)
    model = lm_scoring.AttentionModel(rng.integers(0, 50, lm_scoring.N_IDS).astype(float), np.arange(lm_scoring.N_IDS) % 2 == 0)
    h, cls, weight = rng.standard_normal((40, lm_scoring.WIDTH)), rng.integers(0, len(model.p["bias"]), 40), rng.random(40).astype(np.float32)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    dh, g = model._output_gradient(h, cls, weight)
    loss = lambda: -(weight * model.log_classes(h, cls)).sum()
    for array, grad in ((h, dh), *((model.p[k], g[k]) for k in ("top", "edge", "out", "bias"))):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(12)]:
            array[at] += 1e-2
            more = loss()
            array[at] -= 2e-2
            less = loss()
            array[at] += 1e-2
            assert abs((more - less) / 2e-2 - grad[at]) < 2e-3


def test_word_probabilities_sum_to_one():
    spelled = np.log(np.array([0.1, 0.2, 0.3, 0.4]))  # of all words there are
    count = np.array([5, 1, 3, 0])
    assert abs((10 ** lm_scoring.word_logs(spelled, count, 9, 3)).sum() - 1) < 1e-9
    assert np.allclose(lm_scoring.word_logs(spelled, count * 0, 0, 0), spelled / np.log(10))


def test_near_duplicates_of_planted_pairs(spark):
    """Pairs just above and below the thresholds, by their exact similarity."""
    rng = random.Random(9)
    rows = []
    for k in range(150):
        w = [f"q{rng.randrange(10**6)}" for _ in range(120)]
        v = list(w)
        for _ in range(rng.randint(0, 6)):
            v[rng.randrange(120)] = "zz"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    for percent in (85, 80):
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()}
        assert got == {i: c for i, (_, c) in brute_components(rows, percent).items()}


def test_near_duplicates_without_a_hub(spark, monkeypatch):
    """A ring of texts, each like its neighbours only, leaves members that blocks must compare."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(10)
    w = [f"r{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(60):
        w[(k * 3) % 200 : (k * 3) % 200 + 1] = [f"n{k}"]
        rows.append((k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 93).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 93).items()}


def test_pipeline_of_all_stages(spark, tmp_path):
    """Every stage on nulls, shared ids, copies, leaks and clashing columns, and run() as their chain."""
    import corpus_pipeline

    rng = random.Random(11)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    real = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    fresh = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    odd = [(None, fresh[0], None), (None, fresh[1], None), (None, fresh[2], "s"), (4, fresh[3], "s"), (4, fresh[4], "s"), (90_001, fresh[5], "s"), (90_002, fresh[5], "t"), (90_003, None, "t"), (None, "", None), (90_004, "so " + items[0] + " so", "t")]
    kind = "doc_id long, text string, source string, copies string, leaks string, tox string, __rest string, v string, size string"
    docs = spark.createDataFrame([(*r, *["mine"] * 6) for r in real + odd], kind)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        if name != "sharding":
            assert out.columns == docs.columns and all(tuple(r)[3:] == ("mine",) * 6 for r in rows)
            after[name] = collections.Counter((r.doc_id, r.text, r.source) for r in rows)
            docs = spark.createDataFrame(rows, kind)
        else:
            dealt = rows
    before = collections.Counter(real + odd)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = before - after["toxicity"]
    found = {d for d, _, _ in gone}  # some of them without a label
    assert sum(toxic.get(d) == 1 for d in found) >= 0.8 * sum(toxic.values()) and sum(toxic.get(d) == 0 for d in found) <= 1 and not set(odd[:6]) & set(gone)
    texts = list(after["toxicity"].elements())
    group = brute_components([(i, t) for i, (_, t, _) in enumerate(texts)], 80)
    best = {}
    for i, r in enumerate(texts):
        if lower_words(r[1]):
            key = (r[0] is None, r[0] or 0)
            best[group[i][1]] = min(best.get(group[i][1], key), key)
    kept = after["near_dedup"]
    assert sum(n for r, n in kept.items() if lower_words(r[1])) == len(best) and set(odd[:5]) <= set(kept) and (90_002, fresh[5], "t") not in kept
    assert sum(n for r, n in kept.items() if not lower_words(r[1])) == sum(not lower_words(r[1]) for r in texts)
    left = after["decontamination"]
    assert not any(f" {' '.join(lower_words(x))} " in f" {' '.join(lower_words(t))} " for x in items for _, t, _ in left) and set(odd[:5]) <= set(left)
    mixed = after["mixing"]
    assert set(mixed) <= set(left) and all(n <= 3 * left[r] for r, n in mixed.items())
    assert len(dealt) == sum(mixed.values()) and collections.Counter((r.doc_id, r.source, r.text_crc32) for r in dealt) == collections.Counter({k: n for k, n in _crc(mixed).items()})
    per = collections.Counter(r.shard for r in dealt)
    assert max(per.values()) - min(per[i] for i in range(40)) <= 1
    again = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, dealt))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def _crc(rows):
    out = collections.Counter()
    for (i, t, s), n in rows.items():
        out[i, s, zlib.crc32((t or "").encode())] += n
    return out
