"""Language-model scores of whole texts.

Base: add-half unigram log probabilities of lower-cased words and one end per document, from the
counts of all training documents.  Documents are grouped into blocks by hash; a block sends its
distinct words with their training counts to word buckets as packed arrays, buckets add them up
and answer each block with totals in the order asked.  No vocabulary is ever in one place, and a
frequent word is one entry per block.

Model: one causal self-attention layer with a feed-forward layer, in numpy, on the ids of a
public subword vocabulary (each distinct word of a block is tokenized once).  It predicts the
next id's class in two steps, ``P(group | context) * P(class | group, context)``, so that a place
costs some tens of outputs; ``P(id) = P(class | context) * P(id | class)``, where classes hold frequent ids
alone and the others by kind and frequency, and ``P(id | class)`` comes from the ids' counts in
all training documents.  A word's probability
is half that of its ids and half that of a discounted count, ``max(c - 0.75, 0) / N``, with the
mass that the discount frees given to the ids' probability again (all of it sums to one over all
words).  A text's probability is the mean of what its words so give and what its ids alone give.  Texts are covered by windows of ``WINDOW`` inputs every ``STRIDE``; a
window scores only what the one before it didn't, so each id is scored once with at least
``WINDOW - STRIDE`` ids of context, in masked batches.  The weights learn from every training
document, whatever its length: documents are dealt by hash into rounds (``ROUNDS``) of groups of
about ``FIT_BYTES``; a group fits a copy of the weights that the round before left, and the moves
of a round's groups are averaged row by row (an embedding by how often each group used it), first
inside tasks, then by ranges of rows.  Only averages of the model's size come to the driver.

Defined cases: null and empty texts consist of their end; a null id counts as the empty text in
the training rule; rows sharing an id are scored alike but counted each; without any training
document, counts are zero and the model keeps its starting weights; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import copy
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ensure_checkpoints, partitions, small_batches, table, total_bytes
from .textbatch import U, pieces, word_hashes, words

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END, N_IDS = 50_256, 50_257
WINDOW, STRIDE = 32, 24
WIDTH, INNER = 16, 32
SINGLES, BINS = 992, 32
GROUP = BINS  # classes of a group: frequent ids by rank, then the bins of ids that begin a word, then the others
ROUNDS = ((1 / 16, 0.015), (1 / 4, 0.01), (1.0, 0.007))  # up to which share of the documents, and the rate
FIT_BYTES = 4_000_000
FEW_WINDOWS = 20_000  # groups below go over their windows twice
BLOCK_BYTES = 8_000_000
MERGERS = 8
RANGES = 64
DISCOUNT, TRUST = 0.75, 0.5  # taken off a word's count; the share of the counts in a word's probability
LN10 = float(np.log(10))


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray:
    out = np.zeros(N_IDS, np.int64)
    for b, i in tokenizer(path)._mergeable_ranks.items():
        out[i] = len(b)
    return out


def encode_words(path: str, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of them per word) of each word at s..e, lowered and after a space, as if encoded alone.

    Words are encoded in one string and parted where the ids' bytes end; the vocabulary's pattern never
    matches over the space before a word, unless wide white space stands there: such words go one by one.
    """
    n = e - s + 1
    end = np.cumsum(n)
    if not len(n):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    text = _LOWER[data[np.repeat(s - 1 - end + n, n) + np.arange(end[-1])]]  # the byte before a word gives way to a space
    text[end - n] = 32
    a, b = text[:-1], text[1:]
    wide = np.flatnonzero((a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) | (a == 0xE2) & (b >> 1 == 0x40) | (a == 0xE3) & (b == 0x80))
    alone = np.zeros(len(n), bool)
    alone[np.searchsorted(end, wide, "right")] = True
    together = text[~np.repeat(alone, n)].tobytes()
    size = np.zeros(len(n), np.int64)
    ids, encoding = np.zeros(0, np.int32), tokenizer(path)
    try:
        ids = encoding.encode_to_numpy(together.decode()).astype(np.int32)
        until, ends = np.cumsum(n[~alone]), np.cumsum(_token_bytes(path)[ids])
        at = np.searchsorted(ends, until)
        whole = len(ends) == 0 or at[-1] < len(ends) and bool((ends[at] == until).all())
    except UnicodeDecodeError:
        whole = False
    if not whole:
        alone[:], ids = True, np.zeros(0, np.int32)
    elif len(ids):
        size[~alone] = np.diff(at, prepend=-1)
    if alone.any():
        raw, one = text.tobytes(), np.flatnonzero(alone)
        own = [encoding.encode_ordinary(raw[end[i] - n[i] : end[i]].decode("utf-8", "replace")) for i in one]
        size[one] = [len(x) for x in own]
        out, here = np.empty(size.sum(), np.int32), np.repeat(alone, size)
        out[here], out[~here] = np.fromiter(chain.from_iterable(own), np.int32), ids
        ids = out
    return ids, size


class Lexicon:
    """Subword ids of distinct words in packed arrays, kept between blocks up to a bound."""

    def __init__(self, path: str, most: int = 500_000):
        self.path, self.most = path, most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.row = np.zeros(0, U), np.zeros(0, np.int64)
        self.flat, self.off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != hashes)

    def lookup(self, hashes: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words held, first place, number) of the distinct words, sorted by hash, whose bytes stand at s..e."""
        new = self._missing(hashes)
        if len(new) and len(self.keys) > self.most:
            self._clear()
            new = np.arange(len(hashes))
        if len(new):
            ids, size = encode_words(self.path, data, s[new], e[new])
            self.flat = np.concatenate([self.flat, ids])
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(size)])
            at = np.searchsorted(self.keys, hashes[new])  # both are sorted
            self.keys, self.row = np.insert(self.keys, at, hashes[new]), np.insert(self.row, at, len(self.row) + np.arange(len(new)))
        row = self.row[np.searchsorted(self.keys, hashes)]
        return self.flat, self.off[row], self.off[row + 1] - self.off[row]


@lru_cache(maxsize=2)
def lexicon(path: str) -> Lexicon:
    """One lexicon a process: words come back in block after block."""
    return Lexicon(path)


def group_words(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct hashes, a place of each, index of each word's hash among them)."""
    order = np.argsort(h)
    ordered = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


def subwords(lexicon: Lexicon, data, s, e, wo, grouped):
    """(ids with an end per row, row offsets into them, ids of each word)."""
    unique, first, inverse = grouped
    flat, place, size = lexicon.lookup(unique, data, s[first], e[first])
    n = size[inverse]
    total = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(place[inverse] - total[:-1], n) + np.arange(total[-1])
    ro = total[wo] + np.arange(len(wo))
    ids = np.full(ro[-1], END, np.int32)
    keep = np.ones(ro[-1], bool)
    keep[ro[1:] - 1] = False
    ids[keep] = flat[at]
    return ids, ro, n


def assign_classes(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each id, natural log of P(id | class)). starts: whether an id begins a word."""
    order = np.lexsort((np.arange(N_IDS), -counts))
    cls = np.zeros(N_IDS, np.int64)
    cls[order[:SINGLES]] = np.arange(SINGLES)
    rest = order[SINGLES:]
    for part, of in enumerate((rest[starts[rest]], rest[~starts[rest]])):
        mass = np.cumsum(counts[of] + 0.5)
        cls[of] = SINGLES + part * BINS + np.minimum((mass / mass[-1] * BINS).astype(np.int64), BINS - 1) if len(of) else 0
    weight = counts + 0.5
    return cls, np.log(weight / np.bincount(cls, weight, SINGLES + 2 * BINS)[cls])


def cut_windows(ro: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the first input, rows' ends, first scored place) of all windows of rows."""
    n = np.diff(ro)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // stride))
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return ro[row] + k * stride, ro[row + 1], np.where(k > 0, WINDOW - stride, 0)


def _shifted(x: np.ndarray) -> np.ndarray:
    """Rows of logits, less their largest in place where exp may need it (a constant a row changes no softmax)."""
    if x.size and not -60 < x.min() <= x.max() < 60:
        x -= x.max(axis=1, keepdims=True)
    return x


class AttentionModel:
    """One causal self-attention block that predicts the class of the next id."""

    def __init__(self, counts: np.ndarray, starts: np.ndarray, seed: int = 2):
        self.cls, self.log_in = assign_classes(counts, starts)
        self.log_in = self.log_in.astype(np.float32)
        c, rng = SINGLES + 2 * BINS, np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        share = np.bincount(self.cls, counts + 0.5, c)
        self.p = {
            "emb": (rng.standard_normal((N_IDS, WIDTH)) * 0.1).astype(np.float32), "cls": (rng.standard_normal((c, WIDTH)) * 0.5).astype(np.float32), "pos": (rng.standard_normal((WINDOW, WIDTH)) * 0.1).astype(np.float32),
            "qkv": init(WIDTH, 3 * WIDTH), "wo": init(WIDTH, WIDTH), "w1": init(WIDTH, INNER), "b1": np.zeros(INNER, np.float32), "w2": init(INNER, WIDTH), "out": init(WIDTH, c) * np.float32(0.1), "bias": np.log(share / share.sum()).astype(np.float32),
            "top": init(WIDTH, c // GROUP) * np.float32(0.1), "edge": np.log(share.reshape(-1, GROUP).sum(axis=1) / share.sum()).astype(np.float32),
        }
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    def _forward(self, x: np.ndarray):
        p = self.p
        a = p["emb"].take(x, axis=0)
        a += p["cls"].take(self.cls.take(x), axis=0)
        a += p["pos"]
        b, t, d = a.shape
        qkv = (a.reshape(-1, d) @ p["qkv"]).reshape(b, t, 3 * d)
        q, k, v = qkv[:, :, :d], qkv[:, :, d : 2 * d], qkv[:, :, 2 * d :]
        s = np.matmul(q, k.transpose(0, 2, 1))
        s *= np.float32(1 / np.sqrt(d))
        if s.max(initial=0) > 60:  # else exp needs no shift
            s += self.mask
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s *= self.seen
        s *= 1 / (s.reshape(-1, t) @ np.ones(t, np.float32)).reshape(b, t, 1)
        m = np.matmul(s, v)
        y = a + (m.reshape(-1, d) @ p["wo"]).reshape(b, t, d)
        z = np.maximum(y.reshape(-1, d) @ p["w1"] + p["b1"], 0)
        h = y.reshape(-1, d) + z @ p["w2"]
        return h, (a, q, k, v, s, m, y, z)

    def _states(self, x: np.ndarray, low: int, wanted: np.ndarray) -> np.ndarray:
        """As _forward for the wanted ones of the places from low on, with fewer passes over memory: scores are shifted only where exp needs it."""
        p, scale = self.p, np.float32(1 / np.sqrt(WIDTH))
        a = self.inputs.take(x, axis=0)
        a += p["pos"]
        b, t, d = a.shape
        own = a[:, low:].reshape(-1, d)
        a = a.reshape(-1, d)
        q = (own @ (p["qkv"][:, :d] * scale)).reshape(b, t - low, d)
        k, v = (a @ p["qkv"][:, d : 2 * d]).reshape(b, t, d), np.ones((b, t, d + 1), np.float32)
        v[:, :, :d] = (a @ p["qkv"][:, 2 * d :]).reshape(b, t, d)
        s = np.matmul(q, np.ascontiguousarray(k.transpose(0, 2, 1)))
        if s.max(initial=0) > 60:
            s[:, self.seen[low:] == 0] = -np.inf
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s *= self.seen[low:]
        m = np.matmul(s, v).reshape(-1, d + 1).take(wanted, axis=0)
        a = own.take(wanted, axis=0)
        a += (m[:, :d] / m[:, d:]) @ p["wo"]
        z = a @ p["w1"]
        z += p["b1"]
        np.maximum(z, 0, out=z)
        a += z @ p["w2"]
        return a

    def _parts(self, cls: np.ndarray):
        """(group, order by group, the columns and ordered places of every group there is)."""
        group = cls // GROUP
        order = np.argsort(group.astype(np.uint8), kind="stable")
        edge = np.searchsorted(group[order], np.arange(len(self.p["edge"]) + 1)).tolist()
        return group, order, [(slice(g * GROUP, (g + 1) * GROUP), slice(edge[g], edge[g + 1])) for g in range(len(edge) - 1) if edge[g + 1] > edge[g]]

    def log_classes(self, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log P(class) of each state's class."""
        group, order, parts = self._parts(cls)
        ones, each = np.ones(GROUP, np.float32), np.arange(len(h))
        top = _shifted(h @ self.p["top"] + self.p["edge"])
        out = top[each, group]
        out -= np.log(np.exp(top, out=top) @ np.ones(top.shape[1], np.float32))
        own, right, within = h.take(order, axis=0), cls[order] % GROUP, np.empty((len(h), GROUP), np.float32)
        for at, rows in parts:
            np.matmul(own[rows], self.p["out"][:, at], out=within[rows])
            within[rows] += self.p["bias"][at]
        own = _shifted(within)[each, right]
        own -= np.log(np.exp(within, out=within) @ ones)
        out[order] += own
        return out

    def _output_gradient(self, h: np.ndarray, cls: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, dict]:
        """Gradients of the weighted sum of -log P(class) by the states and the output weights."""

        def residual(x: np.ndarray, right: np.ndarray, w: np.ndarray) -> np.ndarray:
            np.exp(_shifted(x), out=x)
            x *= (w / (x @ np.ones(x.shape[1], np.float32)))[:, None]
            x[np.arange(len(x)), right] -= w
            return x

        p, (group, order, parts) = self.p, self._parts(cls)
        e = residual(h @ p["top"] + p["edge"], group, weight)
        ones = np.ones(len(h), np.float32)
        g = {"top": h.T @ e, "edge": ones @ e, "out": np.zeros_like(p["out"]), "bias": np.zeros_like(p["bias"])}
        dh = e @ p["top"].T
        own, back, e = h.take(order, axis=0), np.empty_like(h), np.empty((len(h), GROUP), np.float32)
        for at, rows in parts:
            np.matmul(own[rows], p["out"][:, at], out=e[rows])
            e[rows] += p["bias"][at]
        e = residual(e, cls[order] % GROUP, weight[order])
        for at, rows in parts:
            g["out"][:, at], g["bias"][at] = own[rows].T @ e[rows], ones[rows] @ e[rows]
            np.matmul(e[rows], p["out"][:, at].T, out=back[rows])
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        dh += back.take(place, axis=0)
        return dh, g

    def fit(self, ids: np.ndarray, ro: np.ndarray, batch: int = 192, rate: float = 0.015, seed: int = 6) -> AttentionModel:
        """Fit on windows side by side, which hold each id once."""
        start, end, _ = cut_windows(ro, WINDOW)
        before = np.concatenate([[END], ids[:-1]]).astype(np.int32)
        before[ro[:-1]] = END
        epochs = 2 if len(start) < FEW_WINDOWS else 1
        p, rng, t = self.p, np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in p.items()}
        v2 = {k: np.zeros_like(v) for k, v in p.items()}
        steps = max(1, epochs * (-(-len(start) // batch)))
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(start)), max(1, len(start) // batch)):
                at = start[at, None] + np.arange(WINDOW), end[at, None]
                good, at = at[0] < at[1], np.minimum(at[0], len(ids) - 1)
                x, y = before[at], ids[at]
                h, (a, q, k, v, s, mm, yy, z) = self._forward(x)
                b, tt, d = a.shape
                dh, g = self._output_gradient(h, self.cls[y.ravel()], (good.ravel() / np.float32(good.sum())).astype(np.float32))
                dz = (dh @ p["w2"].T) * (z > 0)
                g |= {"w2": z.T @ dh, "w1": yy.reshape(-1, d).T @ dz, "b1": np.ones(len(dz), np.float32) @ dz}
                dy = dh + dz @ p["w1"].T
                g["wo"] = mm.reshape(-1, d).T @ dy
                dm = (dy @ p["wo"].T).reshape(b, tt, d)
                ds = np.matmul(dm, v.transpose(0, 2, 1))
                ds -= np.einsum("btd,btd->bt", dm, mm)[:, :, None]  # the sum of ds * s: mm is s times v
                ds *= s
                ds *= np.float32(1 / np.sqrt(d))
                dqkv = np.concatenate([np.matmul(ds, k), np.matmul(ds.transpose(0, 2, 1), q), np.matmul(s.transpose(0, 2, 1), dm)], axis=2).reshape(-1, 3 * d)
                g["qkv"] = a.reshape(-1, d).T @ dqkv
                da = dy + dqkv @ p["qkv"].T
                g["pos"] = da.reshape(b, tt, d).sum(axis=0)
                flat = x.ravel()
                order = np.argsort(flat.astype(np.uint16), kind="stable")  # N_IDS < 2**16: a radix sort
                used, first = np.unique(flat[order], return_index=True)
                de = np.add.reduceat(da.reshape(-1, d).take(order, axis=0), first)
                g["cls"] = np.zeros_like(p["cls"])
                np.add.at(g["cls"], self.cls[used], de)
                t += 1
                lr = rate * min(1.0, 2 * (1 - t / (steps + 1)))
                for name, w in p.items():
                    if name == "emb":
                        m[name][used] = 0.9 * m[name][used] + 0.1 * de
                        v2[name][used] = 0.99 * v2[name][used] + 0.01 * de**2
                        w[used] -= lr * m[name][used] / (np.sqrt(v2[name][used]) + 1e-6)
                        continue
                    m[name] = 0.9 * m[name] + 0.1 * g[name]
                    v2[name] = 0.99 * v2[name] + 0.01 * g[name] ** 2
                    w -= (lr * (m[name] / (1 - 0.9**t)) / (np.sqrt(v2[name] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
        return self

    def score(self, ids: np.ndarray, ro: np.ndarray, batch: int = 256) -> np.ndarray:
        """Natural log probability of each id after those before it in its row."""
        start, end, skip = cut_windows(ro)
        out = np.zeros(len(ids))
        self.inputs = self.p["emb"] + self.p["cls"][self.cls]
        before = np.concatenate([[END], ids[:-1]]).astype(np.int32)
        before[ro[:-1]] = END
        places = np.arange(WINDOW)
        for low in np.unique(skip):  # a row's first window scores all its places, others those from low on
            here = np.flatnonzero(skip == low)
            for k in range(0, len(here), batch):
                at, stop = start[here[k : k + batch], None] + places, end[here[k : k + batch], None]
                wanted = np.flatnonzero(at[:, low:] < stop)
                np.minimum(at, len(ids) - 1, out=at)
                x, at = before[at], at[:, low:].ravel()[wanted]
                y = ids[at]
                out[at] = self.log_classes(self._states(x, low, wanted), self.cls[y]) + self.log_in[y]
        return out

    def rows(self) -> np.ndarray:
        """All weights as rows of WIDTH: the embeddings, then the others (padded)."""
        rest = np.concatenate([v.ravel() for k, v in self.p.items() if k != "emb"])
        return np.concatenate([self.p["emb"], np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)])

    def moved(self, by: np.ndarray) -> AttentionModel:
        """A copy with all weights moved by rows."""
        out, at = copy.copy(self), 0
        out.p = {"emb": (self.p["emb"] + by[:N_IDS]).astype(np.float32)}
        rest = by[N_IDS:].ravel()
        for k, v in self.p.items():
            if k != "emb":
                out.p[k] = (v + rest[at : at + v.size].reshape(v.shape)).astype(np.float32)
                at += v.size
        return out


MODEL_ROWS = len(AttentionModel(np.ones(N_IDS), np.arange(N_IDS) % 2 == 0).rows())
RANGE = -(-MODEL_ROWS // RANGES)
#: A row's move: its number, how much it counts, and the sum of moves times that.
MOVE = np.dtype([("row", "<i4"), ("weight", "<f8"), ("by", "<f4", WIDTH)])


def _add_moves(batches):
    """Sums of all moves of a task by row, as one blob per range of rows."""
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for part, blob in zip(b.column("part").to_pylist(), b.column("moves").to_pylist(), strict=True):
            m = np.frombuffer(blob, MOVE)
            if part not in parts:
                parts[part] = np.zeros(RANGE), np.zeros((RANGE, WIDTH))
            parts[part][0][m["row"] - part * RANGE] += m["weight"]
            parts[part][1][m["row"] - part * RANGE] += m["by"]
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([_blob(part, *sums) for part, sums in parts.items()], pa.binary())], ["part", "moves"])


def _blob(part: int, weight: np.ndarray, by: np.ndarray) -> bytes:
    at = np.flatnonzero(weight)
    out = np.empty(len(at), MOVE)
    out["row"], out["weight"], out["by"] = at + part * RANGE, weight[at], by[at]
    return out.tobytes()


def _learn(model, rate: float, path: str):
    """A group's moves of the broadcast model's weights, by ranges of rows."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        text = group.sort_by([("order", "ascending"), ("text", "ascending")]).column("text")
        sample = [subwords(lexicon(path), d, s, e, wo, grouped) for _, _, d, s, e, wo, grouped in _block_words(text)]
        ids = np.concatenate([x for x, _, _ in sample])
        ro = np.cumsum([0, *np.concatenate([np.diff(o) for _, o, _ in sample])])
        old = model.value
        rows = old.rows()
        new = old.moved(np.zeros_like(rows)).fit(ids, ro, rate=rate)
        weight = np.full(len(rows), float(len(ids)))
        weight[:N_IDS] = np.bincount(ids, minlength=N_IDS)  # each row's END stands before its first id
        by = (new.rows() - rows) * weight[:, None]
        parts = range(RANGES)
        return pa.table({"part": pa.array(parts, pa.int64()), "moves": pa.array([_blob(i, weight[i * RANGE : (i + 1) * RANGE], by[i * RANGE : (i + 1) * RANGE]) for i in parts], pa.binary())})

    return run


def learn(model: AttentionModel, docs: DataFrame, size: int, path: str) -> AttentionModel:
    """The model fitted on all of docs(doc_id, text), about ``size`` bytes."""
    rounds = ROUNDS if size > FIT_BYTES else ((1.0, ROUNDS[0][1]),)
    docs = docs.select("text", F.xxhash64(F.lit(1), "doc_id", "text").alias("order"))
    place, low = F.pmod("order", F.lit(1 << 20)), 0
    for share, rate in rounds:
        high = int(share * (1 << 20))
        groups = max(1, -(-size * (high - low) // (FIT_BYTES << 20)))
        shared = docs.sparkSession.sparkContext.broadcast(model)
        here = docs.where((place >= low) & (place < high)).withColumn("group", F.pmod(F.xxhash64(F.lit(2), "order"), F.lit(groups)))
        moves = here.groupBy("group").applyInArrow(_learn(shared, rate, path), "part long, moves binary").mapInArrow(_add_moves, "part long, moves binary")
        by, weight = np.zeros((MODEL_ROWS, WIDTH)), np.ones(MODEL_ROWS)
        for r in moves.repartition(MERGERS, "part").mapInArrow(_add_moves, "part long, moves binary").collect():  # the model's size
            m = np.frombuffer(r["moves"], MOVE)
            by[m["row"]], weight[m["row"]] = m["by"], m["weight"]
        model = model.moved(by / weight[:, None])
        shared.unpersist()
        low = high
    return model


def _block_words(text: pa.Array):
    for first, n, data, off in pieces(text, 1_500_000):
        s, e, wo = words(data, off)
        yield first, n, data, s, e, wo, group_words(word_hashes(data, s, e))


def _distinct(text) -> tuple[np.ndarray, list]:
    parts = list(_block_words(text))
    return np.unique(np.concatenate([p[-1][0] for p in parts])) if parts else np.zeros(0, U), parts


def _bucket_cuts(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct hashes by bucket, and bucket offsets."""
    bucket = ((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64)  # keeps the sorted order
    return bucket, np.searchsorted(bucket, np.arange(buckets + 1))


def _ask(buckets: int, path: str):
    """A block's distinct words with training counts, by bucket; its training subword counts."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        hashes, parts = _distinct(group.column("text"))
        held = group.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        count = np.zeros(len(hashes), np.int64)
        ids = np.zeros(N_IDS, np.int64)
        for first, n, data, s, e, wo, grouped in parts:
            unique, place, inverse = grouped
            used = ~held[first : first + n]
            c = np.bincount(inverse[np.repeat(used, np.diff(wo))], minlength=len(unique))
            count[np.searchsorted(hashes, unique)] += c
            flat, start, size = lexicon(path).lookup(unique, data, s[place], e[place])
            at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            ids += np.bincount(flat[at], np.repeat(c, size), N_IDS).astype(np.int64)
            ids[END] += used.sum()
        _, cut = _bucket_cuts(hashes, buckets)
        some = [i for i in range(buckets) if cut[i + 1] > cut[i]]
        blobs = [hashes[cut[i] : cut[i + 1]].tobytes() + count[cut[i] : cut[i + 1]].astype("<u4").tobytes() for i in some]
        at = np.flatnonzero(ids)
        blobs.append(at.astype("<i4").tobytes() + ids[at].astype("<i8").tobytes())
        return pa.table({"bucket": pa.array([*some, -1], pa.int64()), "block": pa.array([key[0].as_py()] * len(blobs), pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def _answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Totals of a bucket's words, to each block in the order asked; and how many are known, and their sum."""
    blobs = [np.frombuffer(b, np.uint8) for b in group.column("blob").to_pylist()]
    hashes = [b[: len(b) // 12 * 8].view(U) for b in blobs]
    counts = [b[len(b) // 12 * 8 :].view("<u4") for b in blobs]
    unique, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts).astype(np.float64), len(unique))
    cut = np.cumsum([len(h) for h in hashes])[:-1]
    answers = [total[i].astype("<f8").tobytes() for i in np.split(inverse, cut)]
    bucket = key[0].as_py()
    known = np.array([(total > 0).sum(), total.sum()], "<f8").tobytes()
    return pa.table({"block": pa.array([*group.column("block").to_pylist(), -1], pa.int64()), "bucket": pa.array([bucket] * (len(blobs) + 1), pa.int64()), "totals": pa.array([*answers, known], pa.binary())})


def _add_ids(batches):
    """Counts per subword of all rows of a task, as one row."""
    total, some = np.zeros(N_IDS, np.int64), False
    for b in batches:
        for blob in b.column("blob").to_pylist():
            cut = len(blob) // 12 * 4
            total[np.frombuffer(blob[:cut], "<i4")] += np.frombuffer(blob[cut:], "<i8")
            some = True
    if some:
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([at.astype("<i4").tobytes() + total[at].astype("<i8").tobytes()], pa.binary())], ["blob"])


def word_logs(spelled: np.ndarray, count, total: int, distinct: int) -> np.ndarray:
    """log10 of a word's probability from its ids' natural log probability and its count in training."""
    log = spelled / LN10
    if not total:
        return log
    own = (1 - TRUST) + TRUST * DISCOUNT * distinct / total  # what the ids' probability counts
    counted = np.maximum(np.asarray(count, float) - DISCOUNT, 0) * TRUST / total
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(counted), spelled + np.log(own)) / LN10


def score_documents(df: DataFrame, path: str = VOCABULARY, folds: int = 5, held_fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), (fold == held_fold).alias("held_out"))
    size = total_bytes(docs, "text")
    blocks = int(max(partitions(spark), size // BLOCK_BYTES))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = docs.groupBy("block").applyInArrow(_ask(blocks, path), "bucket long, block long, blob binary").checkpoint()
    answered = asked.where("bucket >= 0").groupBy("bucket").applyInArrow(_answer, "block long, bucket long, totals binary").checkpoint()

    ends = docs.where(~F.col("held_out")).count()
    known = answered.where("block = -1").select("totals").collect()  # two numbers a bucket
    sums = np.sum([np.frombuffer(r["totals"], "<f8") for r in known], axis=0) if known else np.zeros(2)
    n_total, n_words = int(sums[1]) + ends, int(sums[0]) + (ends > 0)
    # counts per subword are added up inside tasks, then in MERGERS tasks; each sends one row of the vocabulary's size
    merged = asked.where("bucket = -1").select("blob").mapInArrow(_add_ids, "blob binary").repartition(MERGERS).mapInArrow(_add_ids, "blob binary")
    counts = np.zeros(N_IDS)
    for r in merged.collect():
        cut = len(r["blob"]) // 12 * 4
        counts[np.frombuffer(r["blob"][:cut], "<i4")] += np.frombuffer(r["blob"][cut:], "<i8")
    starts = np.zeros(N_IDS, bool)
    for b, i in tokenizer(path)._mergeable_ranks.items():
        starts[i] = b[:1] == b" "

    model = learn(AttentionModel(counts, starts), docs.where(~F.col("held_out")), size, path)
    shared = spark.sparkContext.broadcast(model)  # of the vocabulary's size

    z = np.log10(n_total + 0.5 * (n_words + 1))

    def score(key, left, right):
        hashes, parts = _distinct(left.column("text"))
        got = dict(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist(), strict=True))
        c = np.concatenate([np.frombuffer(got[i], "<f8") for i in sorted(got)]) if got else np.zeros(0)
        logs = np.log10(c + 0.5) - z
        size, known, base, lm = (np.zeros(len(left), k) for k in (np.int64, np.int64, float, float))
        for first, rows, data, s, e, wo, grouped in parts:
            unique, _, inverse = grouped
            at, row = np.searchsorted(hashes, unique)[inverse], np.repeat(np.arange(rows), np.diff(wo))
            here = slice(first, first + rows)
            size[here] = np.diff(wo) + 1
            known[here] = np.bincount(row, c[at] > 0, rows).astype(np.int64) + (ends > 0)
            base[here] = np.bincount(row, logs[at], rows) + np.log10(ends + 0.5) - z
            ids, ro, n = subwords(lexicon(path), data, s, e, wo, grouped)
            logs_ids = shared.value.score(ids, ro)
            # the last id of a row is its end; a word's ids follow each other
            words_ids = np.delete(logs_ids, ro[1:] - 1)
            spelled = np.add.reduceat(words_ids, np.cumsum(n) - n) if len(n) else np.zeros(0)
            counted = np.bincount(row, word_logs(spelled, c[at], n_total, n_words), rows) + word_logs(logs_ids[ro[1:] - 1], float(ends), n_total, n_words)
            # the text by the model alone or with counts, either as likely beforehand
            lm[here] = np.logaddexp(counted * LN10, np.add.reduceat(logs_ids, ro[:-1])) / LN10 - np.log10(2)
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), "n_tokens": size, "n_known": known, "train_tokens": np.full(len(left), n_total), "base_score": base, "score": lm})

    left = docs.groupBy("block")
    right = answered.where("block >= 0").groupBy("block")
    return left.cogroup(right).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
