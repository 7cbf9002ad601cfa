"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE_WORDS`` words; every word of the text is in one).
Each passage is encoded into counts and ratios, a small network embeds it, gated attention
(softmax of w . (tanh(V h) * sigmoid(U h))) weighs the passages, and the weighted sum is scored.
Only document labels are used: which passages matter is learned.

The model is fitted on the driver from a bounded sample: at most ``max_docs`` labelled documents (those
of the smallest hashed ids), with all of their passages. Scoring
reads every passage of every document where it lies, without a shuffle.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSAGE_WORDS = 100
MAX_DOCS = 4000
THRESHOLD = 0.3
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"

# Character classes; a passage's encoding starts with the share of each.
_CLASSES = ("space", "newline", "lower", "upper", "other letter", "digit", "stop", "comma", "bang", "dash", "quote",
            "bracket", "bar", "symbol", "other")
_N = len(_CLASSES)
N_FEATURES = _N + 11


def _class_of(c: str) -> int:
    if c == "\n":
        return 1
    if c.isspace():
        return 0
    if c.isalpha():
        return 2 if c.islower() else 3 if c.isupper() else 4
    if c.isdigit():
        return 5
    for k, chars in enumerate((".", ",;:", "!?", "-_", "'\"", "()[]{}<>", "|/\\", "#$%&*@+=~^"), 6):
        if c in chars:
            return k
    return _N - 1


_TABLE = np.array([_class_of(chr(i)) for i in range(0x3000)], np.int64)


def encode(text: str | None, passage_words: int = PASSAGE_WORDS) -> np.ndarray:
    """One row of features per passage of the whole text; a text without words is one row of zeros."""
    words = (text or "").split()
    if not words:
        return np.zeros((1, N_FEATURES), np.float32)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _TABLE[np.minimum(code, len(_TABLE) - 1)]
    for c in np.unique(code[code >= len(_TABLE)]).tolist():
        kind[code == c] = _class_of(chr(c))
    gap = kind < 2
    starts = np.flatnonzero(~gap & np.append(True, gap[:-1]))
    low = np.arange(0, len(words), passage_words)
    n = len(low)
    bounds = np.append(starts[low], len(code))
    bounds[0] = 0
    size = np.diff(bounds)
    share = np.bincount(np.repeat(np.arange(n) * _N, size) + kind, minlength=n * _N).reshape(n, _N) / size[:, None]
    length = np.fromiter(map(len, words), np.float64, len(words))
    # The first of a word's characters, its last, and where a letter's case turns tell prose from junk.
    first, last = kind[starts], kind[starts + length.astype(np.int64) - 1]
    count = np.diff(np.append(low, len(words)))
    mean = lambda x: np.add.reduceat(x.astype(np.float64), low) / count
    mean_length = mean(length)
    distinct, again, pairs = np.empty(n), np.empty(n), np.empty(n)
    for i in range(n):
        part = words[low[i]:low[i] + passage_words]
        distinct[i] = len(set(part)) / len(part)
        again[i] = sum(map(operator.eq, part, part[1:])) / len(part)
        pairs[i] = len(set(zip(part, part[1:]))) / max(1, len(part) - 1)
    return np.column_stack([
        share, mean_length, np.sqrt(np.maximum(0, mean(length ** 2) - mean_length ** 2)), mean(length <= 3),
        mean(first == 3), mean(last == 6), mean(last == 8), mean((last >= 12) & (last <= 13)), distinct, again, pairs,
        np.log1p(count),
    ]).astype(np.float32)


@dataclass
class AttentionModel:
    """Weights of the network; ``prior`` alone where the labels have fewer than two classes."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, passages: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Scores of bags; ``bags`` holds each bag's first row."""
        if self.weights is None:
            return np.full(len(bags), self.prior)
        x = np.clip((passages - self.mean) / self.scale, -8, 8)
        return _forward(self.weights, x, bags)["score"]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w, x, bags):
    size = np.diff(np.append(bags, len(x)))
    h = np.maximum(0, x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, bags), size))
    a = e / np.repeat(np.add.reduceat(e, bags), size)
    z = np.add.reduceat(h * a[:, None], bags)
    return {"size": size, "h": h, "t": t, "g": g, "a": a, "z": z, "score": _sigmoid(z @ w["c"] + w["d"][0])}


def _gradients(w, x, bags, y, decay):
    f = _forward(w, x, bags)
    up = ((f["score"] - y) / len(y)).astype(x.dtype)
    dz = np.repeat(up[:, None] * w["c"], f["size"], axis=0)
    da = (dz * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, bags), f["size"]))
    dt, dg = np.outer(de, w["w"]) * f["g"] * (1 - f["t"] ** 2), np.outer(de, w["w"]) * f["t"] * f["g"] * (1 - f["g"])
    dh = (dz * f["a"][:, None] + dt @ w["V"].T + dg @ w["U"].T) * (f["h"] > 0)
    out = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
           "c": f["z"].T @ up, "d": np.array([up.sum()])}
    return {k: v + decay * w[k] for k, v in out.items()}


def fit_attention(bags: list[np.ndarray], y: np.ndarray, hidden: int = 24, gate: int = 12, steps: int = 200,
                  rate: float = 0.02, decay: float = 1e-4) -> AttentionModel:
    """Fit on bags of encoded passages with 0/1 labels (full-batch Adam, fixed seed)."""
    y = np.asarray(y, np.float64)
    if not len(y) or y.min() == y.max():
        return AttentionModel(float(y.mean()) if len(y) else 0.5)
    x = np.concatenate(bags).astype(np.float64)
    first = np.cumsum([0, *map(len, bags[:-1])])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = np.clip((x - mean) / scale, -8, 8).astype(np.float32)
    rng = np.random.default_rng(0)
    shape = {"W": (x.shape[1], hidden), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,)}
    w = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in shape.items()} | {"b": np.zeros(hidden), "d": np.zeros(1)}
    w = {k: p.astype(np.float32) for k, p in w.items()}
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        for k, g in _gradients(w, x, first, y, decay).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return AttentionModel(float(y.mean()), mean, scale, {k: p.astype(np.float64) for k, p in w.items()})


def _encoded_batches(batches):
    for batch in batches:
        out = [encode(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())], ["doc_id", "label", "x"]
        )


def fit_quality(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> AttentionModel:
    """Fit on documents with a ``quality`` label that are not held out.

    Rows without id or label are passed over; a doc_id with several labels counts with its smallest.
    Without labels, or with labels of one class, the model is that class's share.
    """
    known = labels.where("doc_id is not null and quality is not null").where(f"not ({HELD_OUT})")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    # At most max_docs rows of two numbers, so broadcasting them is bounded.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = found.mapInArrow(_encoded_batches, "doc_id long, label int, x binary").collect()
    rows = sorted({(r.doc_id, r.label, bytes(r.x)) for r in rows})  # repeated rows count once
    bags = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for _, _, x in rows]
    return fit_attention(bags, np.array([label for _, label, _ in rows]))


def _score_batches(model: AttentionModel, name: str):
    def run(batches):
        for batch in batches:
            scores, bags, first, n = [], [], [], 0

            def flush():
                if bags:
                    scores.append(model.score(np.concatenate(bags), np.array(first)))

            for text in batch.column("text").to_pylist():
                x = encode(text)
                bags.append(x)
                first.append(n)
                n += len(x)
                if n > 20_000:
                    flush()
                    bags, first, n = [], [], 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], [*batch.schema.names, name]
            )

    return run


def score_quality(docs: DataFrame, model: AttentionModel, column: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` in 0..1 (higher: label 1 likelier); a column of that name is replaced.

    The score depends on the text alone. Null and empty texts are scored as one empty passage. Rows,
    repeated ones too, stay as they are; an empty table gives an empty result.
    """
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(_score_batches(model, column), schema)
