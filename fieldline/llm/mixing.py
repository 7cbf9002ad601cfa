"""Soft-membership mixing of a corpus to target domain weights.

A classifier fitted on a labelled table gives each document posteriors p(domain | text). Rates r >= 0
per document are fitted by projected-gradient least squares so that the expected token totals
E_k = sum r t p_k (t: the document's tokens) match the targets T_k:

    minimise  sum_k (E_k(r) - T_k)^2 / E_k(1)   over  0 <= r <= max_rate

from r = 1, with the documents weighted by their tokens. A step moves a rate by
-eta sum_k p_k (E_k - T_k) / E_k(1), so documents of equal posteriors always share a rate: posteriors are
rounded to a grid and the fit runs over the grid's occupied cells, which Spark aggregates from all
documents and sums anew in each step. The driver holds only the K residuals of each step.

The classifier is a softmax regression on words and word starts of five and seven letters. It is fitted on the
driver from a bounded sample, ``max_docs`` labelled documents (smallest hashed ids), over the
``max_features`` features that tell its domains apart best. Counts, posteriors and totals cover all
documents and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint, row_id

MAX_DOCS = 4000
MAX_FEATURES = 512
STEMS = (5, 7)
GRID = 64
MAX_STEPS = 80
TOLERANCE = 1e-4


def features(text: str | None) -> set[str]:
    """Distinct lower-case words, and starts of longer words (marked, so that they differ from words)."""
    words = set((text or "").lower().split())
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS))


@dataclass
class DomainModel:
    domains: list[str]
    vocabulary: dict[str, int]
    weights: np.ndarray  # (features, domains)
    bias: np.ndarray

    def posteriors(self, text: str | None) -> np.ndarray:
        at = [self.vocabulary[f] for f in features(text) & self.vocabulary.keys()]
        z = self.bias + self.weights[sorted(at)].sum(axis=0)
        e = np.exp(z - z.max())
        return e / e.sum()


def fit_softmax(rows: list[list[int]], y: np.ndarray, names: list[str], vocabulary: dict[str, int], steps: int = 200,
                rate: float = 0.1, decay: float = 1e-3) -> DomainModel:
    """Softmax regression on presence features (full-batch Adam from zero); ``rows``: each text's features by number."""
    k = max(1, len(names))
    size = np.bincount(y, minlength=k) + 1.0
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, own in enumerate(rows):
        x[i, own] = 1
    best = vocabulary
    w, b = np.zeros((len(best), k), np.float32), np.log(size / size.sum())
    one = np.eye(k, dtype=np.float32)[y]
    w = np.vstack([w, b.astype(np.float32)])  # the bias is the weight of a feature that every text has
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    held = np.append(np.ones(len(best)), 0)[:, None]  # only the bias is free of decay
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if len(names) > 1 else 1):
        z = x @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ ((z / z.sum(axis=1, keepdims=True) - one) / len(y)) + decay * held * w / len(y) ** 0.5
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-6)
    w, b = w[:-1], w[-1].astype(np.float64)
    return DomainModel(names, vocabulary, w.astype(np.float64), b)


def fit_domains(docs: DataFrame, labelled: DataFrame, max_docs: int = MAX_DOCS, max_features: int = MAX_FEATURES) -> DomainModel:
    """Fit on ``docs`` (doc_id, text) and a labelled table (doc_id, domain).

    Rows without id or domain are passed over; of several domains of an id the first by name counts.
    Features are counted and chosen in Spark; the driver gets the numbers of each sampled text's chosen
    features.
    """
    known = labelled.where("doc_id is not null and domain is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Only ids found in docs may fill the sample; it has at most max_docs rows of (id, name).
    present = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    sample = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    found = checkpoint(texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id", "text"]))
    sizes = {r.domain: r["count"] for r in found.groupBy("domain").count().collect()}
    names, total = sorted(sizes), sum(sizes.values())
    if not names:
        return DomainModel([], {}, np.zeros((0, 1)), np.zeros(1))
    # A feature's worth: by how many texts its count in some domain differs from an even spread.
    counts = found.mapInArrow(_feature_rows, "domain string, feature string").groupBy("feature").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(names)])
    uneven = [F.abs(F.col(f"n{i}") - F.col("n") * F.lit(sizes[d] / total)) for i, d in enumerate(names)]
    worth = (F.greatest(*uneven) if len(uneven) > 1 else uneven[0]) / F.sqrt("n")
    best = counts.where("n > 2").orderBy(worth.desc(), "feature").limit(max_features).select("feature").collect()
    vocabulary = {r.feature: i for i, r in enumerate(best)}
    rows = found.mapInArrow(_sample_rows(vocabulary), "doc_id long, domain string, own array<int>").collect()
    rows = sorted((r.doc_id, r.domain, tuple(r.own)) for r in rows)
    return fit_softmax([list(own) for _, _, own in rows], np.array([names.index(d) for _, d, _ in rows]), names, vocabulary)


def _feature_rows(batches):
    for batch in batches:
        for domain, text in zip(batch.column("domain").to_pylist(), batch.column("text").to_pylist()):
            own = list(features(text))
            yield pa.RecordBatch.from_arrays([pa.array([domain] * len(own), pa.string()), pa.array(own, pa.string())], ["domain", "feature"])


def _sample_rows(vocabulary: dict[str, int]):
    def run(batches):
        for batch in batches:
            own = [sorted(vocabulary[f] for f in features(t) & vocabulary.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("domain"), pa.array(own, pa.list_(pa.int32()))], ["doc_id", "domain", "own"])

    return run


def _posterior_batches(model: DomainModel, grid: int):
    def run(batches):
        for batch in batches:
            tokens, cells = [], []
            for text in batch.column("text").to_pylist():
                tokens.append(len((text or "").split()))
                p = model.posteriors(text)
                low = np.floor(p * grid).astype(int)
                low[np.argsort(low - p * grid, kind="stable")[: grid - low.sum()]] += 1  # largest remainders
                cells.append(low.tolist())
            keep = [i for i, n in enumerate(batch.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(tokens, pa.int64()), pa.array(cells, pa.list_(pa.int32()))],
                [batch.schema.names[i] for i in keep] + ["n_tokens", "cell"],
            )

    return run


def posteriors(docs: DataFrame, model: DomainModel, grid: int = GRID) -> DataFrame:
    """row_id, doc_id, n_tokens (words) and ``cell``: the posteriors in model order, in 1/grid."""
    base = docs.select(row_id("doc_id", "text").alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_posterior_batches(model, grid), "row_id long, doc_id long, n_tokens long, cell array<int>")


def _rates(p: np.ndarray, steps: np.ndarray, max_rate: float) -> np.ndarray:
    """Rates after the given gradient steps, from 1, each projected to 0..max_rate."""
    r = np.ones(len(p))
    for step in steps:
        r = np.clip(r - p @ step, 0, max_rate)
    return r


def _rate_batches(steps: np.ndarray, max_rate: float, grid: int, sums: bool):
    def run(batches):
        for batch in batches:
            p = np.array(batch.column("cell").to_pylist(), float).reshape(batch.num_rows, -1) / grid
            r = _rates(p, steps, max_rate) if batch.num_rows else np.ones(0)
            if sums:
                e = ((r * np.array(batch.column("tokens").to_pylist(), float))[:, None] * p).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(e)), pa.int32()), pa.array(e)], ["k", "e"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(r)], ["cell", "rate"])

    return run


def fit_rates(members: DataFrame, targets: list[float] | None, n_domains: int, weights: list[float] | None = None,
              anchor: int = 0, max_rate: float = float("inf"), grid: int = GRID) -> DataFrame:
    """Rates per posterior cell (cell, rate), given ``members`` (n_tokens, cell).

    Targets are token totals, or follow from ``weights``: the anchor domain's expected tokens are its
    target and the others' targets stand to it as their weights.
    """
    # There are at most comb(grid + K - 1, K - 1) cells, so few partitions are enough for every step.
    parts = min(200, -(-comb(grid + n_domains - 1, n_domains - 1) // 50_000))
    cells = checkpoint(members.groupBy("cell").agg(F.sum("n_tokens").alias("tokens")).coalesce(parts))

    def expected(steps: list[np.ndarray]) -> np.ndarray:
        e = np.zeros(n_domains)
        for r in cells.mapInArrow(_rate_batches(np.array(steps), max_rate, grid, True), "k int, e double").collect():
            e[r.k] += r.e  # one sum per batch of cells and domain
        return e

    now = expected([])
    scale = np.maximum(now, 1e-9 * max(1.0, now.sum()))
    if targets is None:
        w = np.array(weights, float)
        targets = w / w[anchor] * now[anchor]
    targets = np.asarray(targets, float)
    steps: list[np.ndarray] = []
    if now.sum() > 0:
        pairs = [F.sum(F.col("tokens") * F.col("cell")[i] * F.col("cell")[j] / grid ** 2).alias(f"g{i}_{j}")
                 for i in range(n_domains) for j in range(n_domains)]
        gram = np.array(list(cells.agg(*pairs).first()), float).reshape(n_domains, n_domains)
        eta = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max()
        for _ in range(MAX_STEPS):
            if np.abs(now - targets).max() <= TOLERANCE * now.sum():
                break
            steps.append(eta * (now - targets) / scale)
            before, now = now, expected(steps)
            if np.abs(now - before).max() <= 0.01 * TOLERANCE * max(1.0, now.sum()):
                break
    return cells.mapInArrow(_rate_batches(np.array(steps), max_rate, grid, False), "cell array<int>, rate double")


def uniform(key: Column, seed: int = 17) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") / float(1 << 53)


def document_rates(docs: DataFrame, model: DomainModel, weights: dict[str, float], anchor: str,
                   max_rate: float = float("inf")) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): row_id, doc_id, n_tokens, posteriors, rate and ``copies``.

    ``copies`` is the rate rounded up or down by a draw from the row's id, so its expectation is the
    rate. Null and empty texts have no tokens and the rate of their posteriors. Rows that repeat an id
    get the same draw. A domain the model does not know has no documents; with no labels at all, or an
    empty table, every rate is 1.
    """
    members = posteriors(docs, model) if model.domains else posteriors(docs, DomainModel([""], {}, np.zeros((0, 1)), np.zeros(1)))
    members = checkpoint(members)
    names = model.domains or [""]
    if anchor in names:
        rates = fit_rates(members, None, len(names), [weights.get(n, 0.0) for n in names], names.index(anchor), max_rate)
    else:
        rates = members.select("cell").distinct().withColumn("rate", F.lit(1.0))
    u = uniform(F.col("row_id"))
    return members.join(rates, "cell").select(
        "row_id", "doc_id", "n_tokens", F.transform("cell", lambda c: c / F.lit(float(GRID))).alias("posteriors"), "rate",
        F.floor(F.col("rate") + u).cast("int").alias("copies"),
    )


def mix(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with each row as often as ``rates`` (row_id, copies) says; columns stay as they are."""
    copies = rates.where("copies > 0").groupBy(F.col("row_id").alias("__row")).agg(F.min("copies").alias("__copies"))
    keyed = docs.withColumn("__row", row_id("doc_id", "text")).join(copies, "__row")
    again = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return keyed.withColumn("__n", again).drop("__row", "__copies", "__n")


def toxicity_domains(labels: DataFrame) -> DataFrame:
    """The labelled table of the toxic label: doc_id, domain ("toxic" or "clean")."""
    return labels.where("toxic is not null").select("doc_id", F.when(F.col("toxic") > 0, "toxic").otherwise("clean").alias("domain"))


#: Production targets: two tokens in a hundred may be of toxic text.
TARGET_WEIGHTS = {"clean": 0.98, "toxic": 0.02}
