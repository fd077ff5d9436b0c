"""Personal data: fixed patterns first, then spans that a character BiLSTM-CRF adds.

The base finds emails, IP addresses, card and phone numbers over whole texts (linear scans, so
very long texts are safe).  The model is a character-level bidirectional LSTM whose emissions go
through a linear-chain CRF over O and B-/I- tags of the four kinds; it is trained in numpy on
labelled spans (generated texts: words of a bounded sample of documents with personal data in
the base's and in looser formats, and number-like decoys as negatives).

Every kind holds a digit or an ``@``, so windows are laid around such characters only, which
loses nothing: ``WINDOW`` characters, half overlapping, over the whole stretch around each
cluster.  All windows of a batch are decoded by Viterbi together and reconciled per text: each
character takes the tag of most weighted votes (a window's weight falls towards its edges).
Base spans always stay; a model span is added if it is made of whole tokens, holds what its kind
can't do without (a card number its check digit), and overlaps no base span and no added span before it.

Counts and ``base_sha256`` describe the base; ``spans`` holds all.

Defined cases: null and empty texts have no spans (the digest of the empty string); null ids
and repeated rows are ordinary rows; without any text to sample, fixed words fill the training
texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import small_batches, table

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_BYTES = 200, 20_000
WINDOW, CONTEXT, MIN_CHARS = 64, 24, 7
HIDDEN, EMBED = 16, 10
TAGS = 1 + 2 * len(KINDS)

_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_TRIGGER = re.compile(r"[0-9@]")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the fixed patterns, by kind as listed, then start."""
    out = [("email", *x) for x in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def encode(text: str) -> np.ndarray:
    """Character classes: 0 pads, ASCII by code, 96 other letters, 97 the rest."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(codes < 32, 1, np.where(codes < 127, codes - 31, np.where(codes < 0x2000, 96, 97)))


CLASSES = 98


def _sig(x):
    return 1 / (1 + np.exp(-x))


def _lse(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class BiLstmCrf:
    """Character BiLSTM with CRF transitions; arrays are (time, batch, features)."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": init(CLASSES, EMBED) * 3, "out": init(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": init(EMBED, 4 * HIDDEN), f"u{d}": init(HIDDEN, 4 * HIDDEN), f"c{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)}

    def _lstm(self, x, d, keep):
        p, (t, n, _) = self.p, x.shape
        steps = range(t) if d == "f" else range(t - 1, -1, -1)
        xw = x @ p["w" + d] + p["c" + d]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, tape = np.zeros((t, n, HIDDEN), np.float32), {}
        for i in steps:
            z = xw[i] + h @ p["u" + d]
            s = _sig(z[:, : 3 * HIDDEN])
            a, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + a * g
            tc = np.tanh(new)
            if keep:
                tape[i] = (h, c, a, f, o, g, tc)
            h, c = o * tc, new
            out[i] = h
        return out, tape

    def emissions(self, ids, keep=False):
        x = self.p["emb"][ids]
        (hf, tf), (hb, tb) = self._lstm(x, "f", keep), self._lstm(x, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        return h @ self.p["out"] + self.p["bias"], (x, h, tf, tb)

    def viterbi(self, ids) -> np.ndarray:
        e, _ = self.emissions(ids)
        t, n, _ = e.shape
        back, score = np.zeros((t, n, TAGS), np.int8), e[0]
        for i in range(1, t):
            s = score[:, :, None] + self.p["trans"][None]
            back[i] = s.argmax(axis=1)
            score = s.max(axis=1) + e[i]
        tags = np.zeros((t, n), np.int8)
        tags[-1] = score.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            tags[i - 1] = back[i, np.arange(n), tags[i]]
        return tags

    def gradient(self, ids, tags):
        """Mean negative log likelihood and its gradient."""
        p, (t, n) = self.p, ids.shape
        e, (x, h, tf, tb) = self.emissions(ids, keep=True)
        tr = p["trans"]
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[0] = e[0]
        for i in range(1, t):
            fwd[i] = _lse(fwd[i - 1][:, :, None] + tr[None], 1) + e[i]
        for i in range(t - 2, -1, -1):
            bwd[i] = _lse(tr[None] + (e[i + 1] + bwd[i + 1])[:, None, :], 2)
        z = _lse(fwd[-1], 1)
        de = np.exp(fwd + bwd - z[None, :, None])
        pair = np.exp(fwd[:-1, :, :, None] + tr[None, None] + (e[1:] + bwd[1:])[:, :, None, :] - z[None, :, None, None])
        dtr = pair.sum(axis=(0, 1))
        np.subtract.at(dtr, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        steps, lanes = np.meshgrid(np.arange(t), np.arange(n), indexing="ij")
        gold = e[steps, lanes, tags].sum() + tr[tags[:-1], tags[1:]].sum()
        de[steps, lanes, tags] -= 1
        de /= n
        g = {"trans": dtr / n, "out": np.einsum("tnh,tnk->hk", h, de), "bias": de.sum(axis=(0, 1))}
        dh = de @ p["out"].T
        dx = np.zeros_like(x)
        for d, tape, part in (("f", tf, dh[:, :, :HIDDEN]), ("b", tb, dh[:, :, HIDDEN:])):
            dw, du, dc0 = np.zeros_like(p["w" + d]), np.zeros_like(p["u" + d]), np.zeros_like(p["c" + d])
            nh, nc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for i in range(t - 1, -1, -1) if d == "f" else range(t):
                h0, c0, a, f, o, gg, tc = tape[i]
                gh = part[i] + nh
                gc = nc + gh * o * (1 - tc * tc)
                dz = np.concatenate([gc * gg * a * (1 - a), gc * c0 * f * (1 - f), gh * tc * o * (1 - o), gc * a * (1 - gg * gg)], axis=1)
                dw += x[i].T @ dz
                du += h0.T @ dz
                dc0 += dz.sum(axis=0)
                dx[i] += dz @ p["w" + d].T
                nh, nc = dz @ p["u" + d].T, gc * f
            g |= {"w" + d: dw, "u" + d: du, "c" + d: dc0}
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], ids.ravel(), dx.reshape(-1, EMBED))
        return float((z.sum() - gold) / n), g

    def fit(self, windows: np.ndarray, tags: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 4) -> BiLstmCrf:
        """windows and tags: (rows, WINDOW)."""
        rng, t = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
                _, g = self.gradient(windows[at].T, tags[at].T)
                t += 1
                for k in self.p:
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.98 * v[k] + 0.02 * g[k] ** 2
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.98**t)) + 1e-6)).astype(np.float32)
        return self


def _check_digit(body: str) -> str:
    return next(body + c for c in "0123456789" if _luhn(body + c))


def training_rows(words: list[str], rows: int = 2_400, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Windows with labelled spans: (classes, tags), each (rows, WINDOW)."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda: "".join(c for c in pick(words).lower() if c.isascii() and c.isalnum()) or "abc"
    x, y = np.zeros((rows, WINDOW), np.int64), np.zeros((rows, WINDOW), np.int64)
    for r in range(rows):
        kind = int(rng.integers(0, 8))
        if kind == 0:
            pii = name() + pick(["", ".", "_", "-"]) + pick([name(), digits(2)]) + "@" + name() + pick(["", digits(1)]) + "." + pick(["com", "org", "net", "example.com", "co.uk", "de"])
        elif kind == 1:
            pii = ".".join(str(rng.integers(0, 256)) for _ in range(4))
        elif kind == 2:
            full = _check_digit(pick(["4", "5", "37", "6011"]) + digits(int(rng.integers(10, 14))))
            pii = full if rng.random() < 0.5 else pick([" ", "-"]).join(full[i : i + 4] for i in range(0, len(full), 4))
        elif kind == 3:
            a, b, c = digits(3), digits(3), digits(4)
            pii = pick([f"+1 ({a}) {b}-{c}", f"+{pick(['44', '49', '34', '33'])} {digits(3)} {digits(6)}", f"({a}) {b}-{c}", f"+{digits(11)}"])
        else:  # decoys
            pii = pick([digits(int(rng.integers(1, 9))), f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(2)}:{digits(2)}", f"${digits(3)}.{digits(2)}", f"{digits(3)},{digits(3)}", "%0x" % int(rng.integers(2**40, 2**62)), "@" + name(), name() + digits(3), digits(22), "300." + digits(3) + ".777.1", "v" + digits(1) + "." + digits(1), f"{digits(2)}%", "".join(pick(list("0123456789abcdef")) for _ in range(int(rng.integers(16, 41))))])
        left, right = [pick(words) for _ in range(12)], [pick(words) for _ in range(12)]
        head, tail = " ".join(left) + pick([" ", " ", ": ", " ("]), pick([" ", " ", ". ", ", "]) + " ".join(right)
        text = head + pii + tail
        start = max(0, len(head) - int(rng.integers(0, WINDOW - 8)))
        codes = encode(text[start : start + WINDOW])
        x[r, : len(codes)] = codes
        if kind < 4:
            a, b = len(head) - start, min(len(head) - start + len(pii), WINDOW)
            y[r, a:b] = 2 + 2 * kind
            y[r, a] = 1 + 2 * kind
    return x, y


def windows_of(text: str) -> list[tuple[int, int]]:
    """Half-overlapping windows over the stretches around digits and @."""
    stretches: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.start() + CONTEXT)
        if stretches and a <= stretches[-1][1]:
            stretches[-1][1] = b
        else:
            stretches.append([a, b])
    out = []
    for a, b in stretches:
        starts = range(a, max(a + 1, b - WINDOW // 2), WINDOW // 2)
        out += [(s, min(s + WINDOW, len(text))) for s in starts]
    return out


def model_spans(model: BiLstmCrf, texts: list[str], batch: int = 512) -> list[list[tuple[str, int, int]]]:
    """Spans by the model alone, reconciled over each text's windows."""
    where = [(i, a, b) for i, t in enumerate(texts) for a, b in windows_of(t)]
    votes: list[dict[int, np.ndarray]] = [{} for _ in texts]
    for k in range(0, len(where), batch):
        part = where[k : k + batch]
        ids = np.zeros((WINDOW, len(part)), np.int64)
        for j, (i, a, b) in enumerate(part):
            ids[: b - a, j] = encode(texts[i][a:b])
        tags = model.viterbi(ids)
        for j, (i, a, b) in enumerate(part):
            for o in np.flatnonzero(tags[: b - a, j] >= 0):
                v = votes[i].setdefault(a + int(o), np.zeros(TAGS))
                v[tags[o, j]] += min(o + 1, WINDOW - o)
    out = []
    for vote in votes:
        spans: list[list] = []
        for at in sorted(vote):
            tag = int(vote[at].argmax())
            if tag == 0:
                continue
            kind = KINDS[(tag - 1) // 2]
            if tag % 2 == 0 and spans and spans[-1][2] == at and spans[-1][0] == kind:
                spans[-1][2] = at + 1
            else:
                spans.append([kind, at, at + 1])
        out.append([tuple(s) for s in spans])
    return out


def _plausible(kind: str, t: str, s: int, e: int) -> bool:
    """Whole tokens only, with what the kind can't do without."""
    figures = [c for c in t[s:e] if c in "0123456789"]
    digits = len(figures)
    if e - s < MIN_CHARS or t[s - 1 : s].isalnum() or t[e : e + 1].isalnum() or t[s].isspace() or t[e - 1].isspace():
        return False
    return {"email": "@" in t[s:e], "ip": digits >= 4, "card": 13 <= digits <= 19 and _luhn(figures), "phone": 9 <= digits <= 15}[kind]


def find_spans(model: BiLstmCrf, texts: list[str]) -> list[tuple[list, list]]:
    """(base, added) spans of each text."""
    base = [base_spans(t) if _TRIGGER.search(t) else [] for t in texts]
    out = []
    for t, b, m in zip(texts, base, model_spans(model, texts), strict=True):
        taken, added = sorted((s, e) for _, s, e in b), []
        for kind, s, e in m:
            if _plausible(kind, t, s, e) and not any(s < y and x < e for x, y in taken):
                added.append((kind, s, e))
                taken.append((s, e))
        out.append((b, added))
    return out


def _join(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


NOTHING = hashlib.sha256(b"").hexdigest()


def _rows(model):
    def run(batches):
        for b in batches:
            ids, text = b.column("doc_id"), b.column("text")
            some = pc.fill_null(pc.match_substring_regex(text, "[0-9@]"), False)
            out = [(0, 0, 0, 0, NOTHING, "")] * len(text)
            at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
            texts = text.take(pa.array(at)).to_pylist()
            for i, (base, added) in zip(at, find_spans(model.value, texts), strict=True):
                count = [sum(k == x for x, _, _ in base) for k in KINDS]
                out[i] = (*count, hashlib.sha256(_join(base).encode()).hexdigest(), _join(base + added))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])], ["doc_id", *("n_" + k for k in KINDS), "base_sha256", "spans"])

    return run


def train_model(docs: DataFrame, sample: int = SAMPLE_DOCS) -> BiLstmCrf:
    """The model, from generated spans among words of at most ``sample`` documents of up to SAMPLE_BYTES bytes."""
    keyed = docs.where(F.octet_length("text") < SAMPLE_BYTES).select(F.xxhash64("doc_id", "text").alias("k"), "text")
    keys = [r["k"] for r in keyed.select("k").orderBy("k").limit(sample).collect()]  # keys first: no task sends its texts
    few = keyed.where(F.col("k").isin(keys)).groupBy("k").agg(F.min("text").alias("text")).select("text").collect() if keys else []
    words = sorted({w for (t,) in few for w in t.split() if w and len(w) < 30 and not _TRIGGER.search(w)})
    return BiLstmCrf().fit(*training_rows(words or ["and", "the", "of", "to"]))


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts per kind, base_sha256 and spans for every row."""
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = spark.sparkContext.broadcast(train_model(docs))  # a few thousand weights
    return docs.mapInArrow(_rows(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
