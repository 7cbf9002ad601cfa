import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from fieldline.llm import mixing as M
from fieldline.llm.common import read_table

SF = "/root/testdata/sf0.1"


def brute_rates(p, t, targets, scale, max_rate, steps=20_000):
    """Projected gradient on all documents in one process, to convergence."""
    r = np.ones(len(p))
    gram = (p * t[:, None]).T @ p / np.sqrt(np.outer(scale, scale))
    eta = 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(steps):
        e = (r * t) @ p
        r = np.clip(r - eta * p @ ((e - targets) / scale), 0, max_rate)
    return r


def corpus(n=300):
    rng = random.Random(1)
    marks = {"a": ["apple", "amber"], "b": ["bronze", "beech"], "c": ["copper", "cedar"]}
    rows, domain = [], {}
    for i in range(n):
        d = rng.choice("aaabbc")
        words = [rng.choice(["the", "of", "and", "in"]) for _ in range(rng.randint(1, 60))] + [rng.choice(marks[d])]
        if rng.random() < 0.2:
            words.append(rng.choice(marks[rng.choice("abc")]))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        domain[i] = d
    return rows, domain


def test_rates_match_brute_force_and_targets(spark):
    rows, domain = corpus()
    df = spark.createDataFrame([Row(cell="clash", doc_id=d, text=t, rate=1, copies="x") for d, t in rows])
    labelled = spark.createDataFrame([(d, x) for d, x in domain.items() if d % 2], "doc_id long, domain string")
    model = M.fit_domains(df, labelled)
    assert model.domains == ["a", "b", "c"]
    guess = {d: model.domains[int(model.posteriors(t).argmax())] for d, t in rows}
    assert np.mean([guess[d] == domain[d] for d in domain if d % 2 == 0]) > 0.85
    for weights, cap in (({"a": 1, "b": 1, "c": 1}, np.inf), ({"a": 8, "b": 1, "c": 1}, np.inf), ({"a": 8, "b": 1, "c": 0}, 1.0)):
        out = M.document_rates(df, model, weights, "a", cap).collect()
        assert len(out) == len(rows)
        p = np.array([r.posteriors for r in out])
        t, r = np.array([x.n_tokens for x in out], float), np.array([x.rate for x in out])
        now = t @ p
        target = np.array([weights[k] for k in "abc"]) / weights["a"] * now[0]
        want = brute_rates(p, t, target, now, cap)
        e, best = (r * t) @ p, (want * t) @ p
        loss = lambda x: ((x - target) ** 2 / now).sum()
        assert loss(e) <= loss(best) + 1e-3 * now.sum()
        if cap == np.inf:
            assert np.allclose(e, target, rtol=0.01, atol=1e-3 * now.sum())
        assert (r >= 0).all() and (r <= cap).all()
        copies = np.array([x.copies for x in out])
        assert (copies >= np.floor(r)).all() and (copies <= np.floor(r) + 1).all()
        assert abs((copies * t).sum() - (r * t).sum()) < 0.1 * (r * t).sum()


def test_toxic_documents_are_found_and_thinned(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    train = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    model = M.fit_domains(docs, M.toxicity_domains(train))
    rates = {r.doc_id: r for r in M.document_rates(docs, model, M.TARGET_WEIGHTS, "clean", 1.0).collect()}
    assert len(rates) == docs.count()
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 2]
    k = model.domains.index("toxic")
    right = [(rates[r.doc_id].posteriors[k] > 0.5) == (r.toxic == 1) for r in held]
    assert np.mean(right) > 0.95
    clean = [rates[r.doc_id].rate for r in held if not r.toxic]
    assert np.mean(clean) > 0.98
    kept = M.mix(docs, M.document_rates(docs, model, M.TARGET_WEIGHTS, "clean", 1.0))
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.copies for r in rates.values())


def test_nulls_repeats_empty_tables_and_no_labels(spark):
    df = spark.createDataFrame([(1, "a b c", 9), (1, "a b c", 9), (None, "x y", 8), (None, None, 7), (2, "", 6)],
                               "doc_id long, text string, n_tokens int")
    none = spark.createDataFrame([], "doc_id long, domain string")
    model = M.fit_domains(df, none)
    rates = M.document_rates(df, model, {"clean": 1.0}, "clean")
    assert [r.rate for r in rates.collect()] == [1.0] * 5
    assert M.mix(df, rates).count() == 5
    empty = df.limit(0)
    labelled = spark.createDataFrame([(1, "clean"), (2, "toxic"), (None, "clean"), (2, None)], "doc_id long, domain string")
    assert M.document_rates(empty, M.fit_domains(df, labelled), M.TARGET_WEIGHTS, "clean").count() == 0
    assert M.document_rates(df, M.fit_domains(df, labelled), M.TARGET_WEIGHTS, "clean").count() == 5
    assert M.mix(empty, rates).count() == 0


def test_uniform_is_even(spark):
    rows = spark.range(20_000).select(M.uniform(M.F.col("id")).alias("u")).agg({"u": "avg"}).first()
    assert rows[0] == pytest.approx(0.5, abs=0.02)
