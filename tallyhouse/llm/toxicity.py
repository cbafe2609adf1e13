"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the sum of its own embedding (words frequent in the training sample) and the mean embedding of its
character pieces (trigrams, the first four and the last four characters), so spellings never seen as words still carry
their characters. Longer runs of word characters (scripts without blanks, words joined by underscores) are read whole, in
overlapping parts of 40 characters that are words of their own. Two gated recurrent units read a window of words in both directions, attention pools their states, and
a logistic output scores the window. Every document is covered by overlapping windows; its score is that of its worst
window. The model is fitted by gradient descent on document labels: each document's highest-scoring window carries the
document's label.

Training reads a bounded sample of labelled rows (``toxic_rows`` and ``clean_rows`` documents not longer than
``train_chars``, the lowest by a hash of the id); its parameters have a fixed size and are broadcast. Scoring reads whole texts.

Defined results: null and empty texts (no words) get the score of a window without words; repeated rows get equal
scores; an empty table gives no rows; without any labelled rows of both classes the model scores every text 0; columns
of other names pass through, columns named as the added ones are replaced; a null id is scored like any other.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import ChainMap, Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import giving_back, kept

_WORD = re.compile(r"\w+")
WINDOW, STRIDE = 32, 24
LONGEST = 40
_SPREAD = np.arange(WINDOW)


def words(text: str | None) -> list[str]:
    """Runs of word characters; a run of more than ``LONGEST`` enters as overlapping parts that end with the run."""
    found = _WORD.findall(text.lower()) if text else []
    if not found or len(max(found, key=len)) <= LONGEST:
        return found
    return [w[a:a + LONGEST] for w in found
            for a in ([0] if len(w) <= LONGEST else [*range(0, len(w) - LONGEST, LONGEST // 2), len(w) - LONGEST])]


def pieces(word: str) -> list[str]:
    """Character trigrams of the marked word, its first and its last four characters."""
    marked = f"<{word}>"
    return [marked[i:i + 3] for i in range(len(marked) - 2)] + ["^" + word[:4], word[-4:] + "$"]


def starts(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[int]:
    """First words of the windows over ``n`` words; the last one ends with the text."""
    if n <= window:
        return [0]
    return [*range(0, n - window, stride), n - window]


@dataclass
class Model:
    word_ids: dict[str, int]
    piece_ids: dict[str, int]
    p: dict[str, np.ndarray]
    shift: float = 0.0
    tag: str = field(default_factory=lambda: uuid.uuid4().hex)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(a: np.ndarray, U: np.ndarray, c: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, B, k) of a gated recurrent unit over gate inputs ``a`` (T, B, 3k); ``keep`` gets what backward needs."""
    k = U.shape[0]
    h = np.zeros((a.shape[1], k), a.dtype)
    out = np.empty((*a.shape[:2], k), a.dtype)
    for t in range(len(a)):
        hu = h @ U
        s = _sigmoid(a[t, :, :2 * k] + hu[:, :2 * k])
        m = hu[:, 2 * k:] + c
        n = np.tanh(a[t, :, 2 * k:] + s[:, k:] * m)
        if keep is not None:
            keep.append((h, s, m, n))
        h = n + s[:, :k] * (h - n)
        out[t] = h
    return out


def _gru_back(dout: np.ndarray, U: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = U.shape[0]
    da, dU, dc = np.empty((*dout.shape[:2], 3 * k), dout.dtype), np.zeros_like(U), np.zeros(k, U.dtype)
    dh = np.zeros(dout.shape[1:], dout.dtype)
    for t in range(len(dout) - 1, -1, -1):
        h, s, m, n = kept[t]
        z, r = s[:, :k], s[:, k:]
        dh = dh + dout[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz, dr = dh * (h - n) * z * (1 - z), dn * m * r * (1 - r)
        dhu = np.concatenate([dz, dr, dn * r], 1)
        da[t] = np.concatenate([dz, dr, dn], 1)
        dU += h.T @ dhu
        dc += (dn * r).sum(0)
        dh = dh * z + dhu @ U.T
    return da, dU, dc


def _pool(H: np.ndarray, mask: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attention over the words of each window: logits, weights, pooled states. Windows without words pool to zero."""
    e = np.where(mask, H @ p["v"], -np.inf)
    top = e.max(0)
    w = np.exp(e - np.where(np.isfinite(top), top, 0))
    w /= np.maximum(w.sum(0), 1e-30)
    pooled = (w[:, :, None] * H).sum(0)
    return pooled @ p["w"] + p["b"][0], w, pooled


def window_logits(gates: np.ndarray, mask: np.ndarray, p: dict) -> np.ndarray:
    """Logits of windows from both directions' gate inputs (T, B, 6k)."""
    k3 = gates.shape[2] // 2
    H = np.concatenate([_gru(gates[:, :, :k3], p["U0"], p["c0"]),
                        _gru(gates[::-1, :, k3:], p["U1"], p["c1"])[::-1]], 2)
    return _pool(H, mask, p)[0]


def _gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, p: dict) -> tuple[dict, np.ndarray, float]:
    """Gradients of the logistic loss of windows with word vectors ``x`` (T, B, e)."""
    kept0, kept1 = [], []
    H = np.concatenate([_gru(x @ p["W0"] + p["a0"], p["U0"], p["c0"], kept0),
                        _gru((x @ p["W1"] + p["a1"])[::-1], p["U1"], p["c1"], kept1)[::-1]], 2)
    logit, w, pooled = _pool(H, mask, p)
    q = _sigmoid(logit)
    d = (q - y) / len(y)
    dpool = d[:, None] * p["w"]
    dw = (H * dpool).sum(2)
    de = w * (dw - (w * dw).sum(0))
    dH = w[:, :, None] * dpool + de[:, :, None] * p["v"]
    k = p["U0"].shape[0]
    da0, dU0, dc0 = _gru_back(dH[:, :, :k], p["U0"], kept0)
    da1, dU1, dc1 = _gru_back(dH[::-1, :, k:], p["U1"], kept1)
    da1 = da1[::-1]
    flat = lambda m: m.reshape(-1, m.shape[2])
    g = {"w": pooled.T @ d, "b": np.array([d.sum()]), "v": (de[:, :, None] * H).sum((0, 1)), "U0": dU0, "c0": dc0,
         "U1": dU1, "c1": dc1, "W0": flat(x).T @ flat(da0), "a0": flat(da0).sum(0), "W1": flat(x).T @ flat(da1),
         "a1": flat(da1).sum(0)}
    loss = -np.mean(np.log(np.where(y > 0, q, 1 - q) + 1e-9))
    return g, da0 @ p["W0"].T + da1 @ p["W1"].T, float(loss)


def train(texts: list[str], labels: list[int], width: int = 16, state: int = 8, epochs: int = 5, steps: int = 300, batch: int = 128,
          rate: float = 0.02, drop: float = 0.15, noise: float = 0.02, most_words: int = 8000, most_pieces: int = 8000, seed: int = 5) -> Model:
    """Fit the network on labelled texts, for ``epochs`` passes but at least ``steps`` gradient steps."""
    rng = np.random.default_rng(seed)
    # Texts become word numbers at once; windows are views of them.
    number: dict[str, int] = {}
    ids, held = [], Counter()
    for text in texts:
        d = np.array([number.setdefault(w, len(number)) for w in words(text)], np.int32)
        held.update(np.unique(d).tolist())
        ids.append(d)
    vocab = list(number)
    seen = {w: held[i] for i, w in enumerate(vocab)}
    del held
    word_ids = {w: i for i, (w, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most_words]) if n > 2}
    chars = Counter(c for w in vocab for c in pieces(w))
    piece_ids = {c: i for i, (c, n) in enumerate(sorted(chars.items(), key=lambda x: (-x[1], x[0]))[:most_pieces]) if n > 2}
    f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"Ew": noise * f(len(word_ids) + 1, width) * np.sqrt(len(word_ids) + 1), "Ec": noise * f(len(piece_ids) + 1, width)
         * np.sqrt(len(piece_ids) + 1), "W0": f(width, 3 * state), "W1": f(width, 3 * state), "U0": f(state, 3 * state),
         "U1": f(state, 3 * state), "v": f(2 * state), "w": f(2 * state), "b": np.zeros(1, np.float32)}
    p |= {n: np.zeros(s, np.float32) for n, s in (("a0", 3 * state), ("a1", 3 * state), ("c0", state), ("c1", state))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    model = Model(word_ids, piece_ids, p)
    of_word = np.array([word_ids.get(w, len(word_ids)) for w in vocab] + [len(word_ids)], np.int32)
    flat, sizes = array("i"), array("i")
    for w in vocab:
        found = [piece_ids[c] for c in pieces(w) if c in piece_ids]
        flat.extend(found)
        sizes.append(len(found))
    flat, sizes = np.array(flat, np.int32), np.array([*sizes, 0], np.int32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    share = (1 / np.maximum(sizes, 1)).astype(np.float32)
    none = len(vocab)
    p["Ew"][len(word_ids)] = 0
    padded = [np.r_[d, np.full(max(WINDOW - len(d), 0), none, np.int32)] for d in ids]
    begin = np.r_[0, np.cumsum([len(d) for d in padded])]
    opens = [np.array(starts(len(d)), np.int64) + at for d, at in zip(ids, begin, strict=False)]
    first, opens, ids = np.r_[0, np.cumsum([len(o) for o in opens])], np.concatenate(opens), np.concatenate(padded)
    del padded, number, seen

    def window(at: np.ndarray) -> np.ndarray:
        return ids[opens[at][:, None] + _SPREAD].T

    y = np.array(labels, np.float32)
    grads2 = {k: np.zeros_like(v) for k, v in p.items()}
    picked = len(y) + int((y == 0).sum())
    for _ in range(max(epochs, -(-steps * min(batch, picked) // picked))):
        table = _gate_table(p, of_word, flat, owner, share)
        logit = np.concatenate([window_logits(table[w], w != none, p) for a in range(0, len(opens), 4096)
                                if (w := window(np.arange(a, min(a + 4096, len(opens))))) is not None])
        del table
        # A toxic text trains its worst window; a clean one its worst and a random one.
        worst = np.array([a + int(np.argmax(logit[a:b])) for a, b in zip(first, first[1:], strict=False)])
        other = first[:-1] + (rng.random(len(y)) * np.diff(first)).astype(int)
        pick = np.concatenate([worst, other[y == 0]])
        target = np.concatenate([y, np.zeros(int((y == 0).sum()), np.float32)])
        order = rng.permutation(len(pick))
        for a in range(0, len(order), batch):
            at = order[a:a + batch]
            w = window(pick[at])
            w = np.where(rng.random(w.shape) < drop, none, w)  # words left out at random: no single one may decide
            used, back = np.unique(w, return_inverse=True)
            x, parts = _vectors(p, used, of_word, flat, owner, share)
            g, dx, _ = _gradients(x[back.reshape(w.shape)], w != none, target[at], p)
            dv = np.zeros_like(x)
            np.add.at(dv, back.reshape(-1), dx.reshape(-1, dx.shape[2]))
            g["Ew"], g["Ec"] = np.zeros_like(p["Ew"]), np.zeros_like(p["Ec"])
            np.add.at(g["Ew"], of_word[used], dv)
            np.add.at(g["Ec"], flat[parts[0]], dv[parts[1]] * share[used[parts[1]]][:, None])
            g["Ew"][len(word_ids)] = 0
            for k in p:
                grads2[k] += g[k] ** 2
                p[k] -= (rate * (3 if k[0] == "E" else 1) * g[k] / (np.sqrt(grads2[k]) + 1e-6)).astype(np.float32)
    return model


def _vectors(p, used, of_word, flat, owner, share):
    """Word vectors of ``used`` words, and which (piece place, row) pairs made them."""
    lo, hi = np.searchsorted(owner, used), np.searchsorted(owner, used, "right")
    sizes = hi - lo
    row = np.repeat(np.arange(len(used)), sizes)
    place = np.repeat(lo - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    x = np.zeros((len(used), p["Ec"].shape[1]), np.float32)
    np.add.at(x, row, p["Ec"][flat[place]])
    return x * share[used][:, None] + p["Ew"][of_word[used]], (place, row)


def _gate_table(p, of_word, flat, owner, share, block: int = 20_000):
    """Gate inputs of all words, a block at a time: the vectors of a block's pieces are many times larger than they are."""
    return np.concatenate([_gates(_vectors(p, np.arange(a, min(a + block, len(of_word))), of_word, flat, owner, share)[0], p)
                           for a in range(0, len(of_word), block)])


def _gates(x, p):
    return np.concatenate([x @ p["W0"] + p["a0"], x @ p["W1"] + p["a1"]], 1)


class Scorer:
    """Score texts; keeps the gate inputs of up to ``memory`` words it has met."""

    def __init__(self, model: Model, memory: int = 150_000):
        self.p, self.word_ids, self.piece_ids, self.shift = model.p, model.word_ids, model.piece_ids, model.shift
        self.memory, self.width = memory, model.p["W0"].shape[0]
        self.ids: dict[str, int] = {}
        self.gates = _gates(np.zeros((1, self.width), np.float32), self.p)  # row 0: no word
        self.used = 1

    def _inputs(self, new: list[str]) -> np.ndarray:
        get = self.piece_ids.get
        found = [[j for c in pieces(w) if (j := get(c)) is not None] for w in new]
        sizes = np.array([len(f) for f in found])
        x = np.zeros((len(new), self.width), np.float32)
        flat = np.array([j for f in found for j in f], np.int64)
        some = sizes > 0
        if len(flat):
            sums = np.add.reduceat(self.p["Ec"][flat], (np.cumsum(sizes) - sizes)[some])
            x[some] = sums / sizes[some][:, None]
        known = [(i, k) for i, w in enumerate(new) if (k := self.word_ids.get(w)) is not None]
        if known:
            x[[i for i, _ in known]] += self.p["Ew"][[k for _, k in known]]
        return _gates(x, self.p)

    def _place(self, docs: list[list[str]]) -> dict[str, int]:
        """Rows of the words; words beyond the memory get rows for this call only."""
        missing = set().union(*docs).difference(self.ids)
        if not missing:
            return self.ids
        new = sorted(missing)
        need = self.used + len(new)
        if need > len(self.gates):
            room = np.zeros((max(need, min(2 * len(self.gates), self.memory)) - self.used, self.gates.shape[1]), np.float32)
            self.gates = np.concatenate([self.gates[:self.used], room])
        self.gates[self.used:need] = self._inputs(new)
        rows = zip(new, range(self.used, need), strict=True)
        if need > self.memory:
            return ChainMap(self.ids, dict(rows))
        self.ids.update(rows)
        self.used = need
        return self.ids

    def scores(self, texts: list[str | None], group: int = 1024) -> np.ndarray:
        """The score of each text's worst window."""
        docs = [words(t) for t in texts]
        get, rows, of = self._place(docs).__getitem__, [], []
        for i, d in enumerate(docs):
            ids = np.fromiter(map(get, d), np.int32, len(d))
            at = np.array(starts(len(d)))
            if len(d) < WINDOW:
                ids = np.concatenate([ids, np.zeros(WINDOW - len(d), np.int32)])
            rows.append(ids[at[:, None] + _SPREAD])
            of.append(np.full(len(at), i))
        rows, of = np.concatenate(rows), np.concatenate(of)
        logit = np.concatenate([window_logits(self.gates[rows[a:a + group].T], rows[a:a + group].T > 0, self.p)
                                for a in range(0, len(rows), group)])
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, of, logit)
        return _sigmoid(top + self.shift)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        folds: int = 5, toxic_rows: int = 1200, clean_rows: int = 2400, train_chars: int = 20_000, **options) -> Model | None:
    """Train on rows whose ``crc32(key as text) mod folds`` is not 0; at most ``toxic_rows`` and ``clean_rows`` of them.

    A fifth of the sample is left out of the training and sets the cut-off: the logits are shifted so that 0.5 is the
    best threshold there.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()
                         & (F.crc32(F.col(key).cast("string")) % folds != 0)).select(key, F.col(label).alias("_y")).distinct()
    # Choose by id first: only the chosen rows are joined with their texts.
    order = F.xxhash64(F.col(key), F.lit("sample"))
    short = docs.where(F.length(text) <= train_chars).select(key, F.length(text).alias("_n"))
    some = [marks.where(F.col("_y") == y).join(short, key).select(key, "_y", order.alias("_o")).orderBy("_o", key)
            .limit(n) for y, n in ((0, clean_rows), (1, toxic_rows))]
    chosen = some[0].unionByName(some[1])
    rows = docs.select(key, F.col(text).alias("_t")).join(F.broadcast(chosen), key).orderBy("_o").collect()
    y = [r["_y"] for r in rows]
    if len(set(y)) < 2:
        return None
    cut = max(1, len(rows) // 5)
    held, fitted = rows[:cut], rows[cut:]
    model = train([r["_t"] for r in fitted], [r["_y"] for r in fitted], **options)
    score = Scorer(model).scores([r["_t"] for r in held])
    logit = np.log(np.clip(score, 1e-7, 1 - 1e-7) / (1 - np.clip(score, 1e-7, 1 - 1e-7)))
    model.shift = -_threshold(logit, np.array([r["_y"] for r in held]))
    return model


def _threshold(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of its gap."""
    order = np.argsort(logit)
    x, t = logit[order], y[order]
    errors = np.r_[0, np.cumsum(t)] + np.r_[np.cumsum((1 - t)[::-1])[::-1], 0]
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    low, high = x[i - 1] if i else x[0] - 1, x[i] if i < len(x) else x[-1] + 1
    return float((low + high) / 2)


def worker_scorer(model: Model) -> Scorer:
    """One scorer a worker process and model; it outlives a task."""
    return kept(_tag(model), lambda: Scorer(model))


def _tag(model: Model) -> str:
    return f"toxicity {model.tag}"


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (1 from 0.5 on)."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("score", T.DoubleType())])
    where = names.index(text)

    def run(batches):
        scorer = worker_scorer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                got = scorer.scores(part.column(where).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())], names=schema.names)

    scored = docs.select(names).mapInArrow(giving_back(run, (_tag(model),)), schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
