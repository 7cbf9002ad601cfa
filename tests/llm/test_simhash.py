import random

import numpy as np
import xxhash
from pyspark.sql import Row

from fieldline.llm import simhash as S


def slow_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, radius=3):
    """doc_id -> (fingerprint, component) by comparing all pairs."""
    fp = [slow_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                comp[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), d), d)
    return sorted((d, f"{fp[i]:016x}", best[root(i)]) for i, (d, _) in enumerate(rows))


def texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "Straße", "x y"]
    out = ["", None, " \t\n", "One", "one two", "A b C", "a B c"]
    for _ in range(25):
        words = [rng.choice(vocab) for _ in range(rng.randint(3, 200))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 5)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "CHANGED"
            out.append(rng.choice([" ", "\n", "  "]).join(copy))
    return out


def test_fingerprint_equals_definition():
    for t in texts():
        assert S.fingerprint(t) == slow_fingerprint(t)
    long = " ".join(f"t{i % 977}" for i in range(70_000))
    assert S.fingerprint(long) == slow_fingerprint(long)


def test_bit_sliced_distances_equal_brute_force():
    rng = np.random.default_rng(1)
    for n, radius in ((1, 3), (70, 3), (200, 0), (200, 5), (130, 8)):
        fp = rng.integers(0, 2**63, n, dtype=np.uint64)
        for i in range(0, n, 2):
            fp[i] = fp[0] ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 9))))
        got = set()
        for q, w, mask in S.near_cells(fp, S.bit_planes(fp), radius):
            for a, b, m in zip(q, w, mask):
                got |= {(int(a), int(b) * 64 + j) for j in range(64) if int(m) >> j & 1 and b * 64 + j < n}
        want = {(i, j) for i in range(n) for j in range(n) if int(fp[i] ^ fp[j]).bit_count() <= radius}
        assert got == want


def test_buckets_lose_no_pair():
    rng = random.Random(2)
    for n in (10, 10**5, 10**8, 10**12):
        tables = S.bucket_tables(n, 3)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                b ^= 1 << bit
            key = lambda x, t: [x >> s & (1 << w) - 1 for s, w in t]
            assert any(key(a, t) == key(b, t) for t in tables)


def test_components_match_brute_force(spark, monkeypatch):
    rows = list(enumerate(texts()))
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([Row(doc_id=d, text=t, fp=1, row_id="clash", kept=None or 0) for d, t in rows])
    got = sorted(tuple(r) for r in S.simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect())
    assert got == brute(rows)
    monkeypatch.setattr(S, "BUCKET_CAP", 4)  # hot buckets go through chunk cells
    monkeypatch.setattr(S, "BUCKET_AIM", 8)
    got = sorted(tuple(r) for r in S.simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect())
    assert got == brute(rows)


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string, extra int"
    df = spark.createDataFrame([(None, "p q r s t", 1), (None, "p q r s t", 2), (7, "k l m n", 3), (7, "k l m n", 3),
                                (None, None, 4), (3, "", 5)], schema)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in S.simhash_dedup(df).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(7, 7, True)] * 2 + [(None, 3, False), (3, 3, True)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in S.keep_one(df).collect()), key=str)
    assert kept == sorted([(None, "p q r s t"), (7, "k l m n"), (3, "")], key=str)
    assert S.keep_one(df).columns == df.columns
    none = spark.createDataFrame([], schema)
    assert S.simhash_dedup(none).count() == 0 and S.keep_one(none).count() == 0


def test_rows_of_one_id_in_different_groups_all_stay(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"{x}{rng.randrange(500)}" for _ in range(80)) for x in "abc")
    rows = [(7, a), (7, b), (7, b.upper()), (7, c), (2, c), (8, a), (9, b), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.text) for r in S.keep_one(df).collect()), key=str)
    assert len(got) == 4 and (7, a) in got and (2, c) in got
    assert sum(d == 7 and t.lower() == b for d, t in got if t) == 1
    assert sum(d == 9 and not t for d, t in got) == 1
