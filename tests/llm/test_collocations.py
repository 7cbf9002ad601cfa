import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from fieldline.llm import collocations as C
from fieldline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute_counts(rows, longest=3):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return counts, totals


def brute(rows, least=10, top=2000, longest=3, percent=50):
    counts, totals = brute_counts(rows, longest)
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    shadow = defaultdict(int)
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                shadow[lang, w[i:i + k]] = max(shadow[lang, w[i:i + k]], a)
    out = defaultdict(list)
    for (lang, w), a in found.items():
        cuts = []
        for k in range(1, len(w)):
            l, r = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        if shadow[lang, w] == 0 or 100 * shadow[lang, w] < percent * a:
            out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
            for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]


def odd_rows(seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "é", "漢字", "🙂", "a" * 40, "\x00", " ", "x-y", "|", "of", "of"]
    seps = [" ", " ", " ", " ", "  ", "\t", "\n", ". ", ",", "\r\n", " ; ", "\x0b", "\x0c", "!?", ""]
    rows = [(None, "null lang here " * 12), ("en", None), ("en", ""), ("en", " \t\n.,"), (None, None), ("und", "null lang. here"),
            ("fr", "a b " * 400), ("de", "ab c " * 9), ("de", "ab c"), ("es", "seul"), ("en", "new york city " * 15), ("xx", "q" * 5000 + " r ")] * 2
    for _ in range(120):
        n = rng.randint(0, 60)
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(rng.choice(words) + rng.choice(seps) for _ in range(n))))
    return rows + rows[:40]


def frame(spark, rows):
    schema = "doc_id long, lang string, text string, rank string, n string, phrase int, a int"
    return spark.createDataFrame([Row(doc_id=i, lang=g, text=t, rank="x", n="y", phrase=1, a=2) for i, (g, t) in enumerate(rows)], schema)


def test_words_equal_regular_expressions():
    rng = random.Random(7)
    for _ in range(300):
        texts = ["".join(rng.choice("aB .\t\n漢,é") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4))]
        words = C.Words([t.encode() for t in texts])
        flat = [[w for w in re.findall(r"[^\x20\x09]+", p)] for t in texts for p in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(LOWER))]
        want = [(w, i < len(p) - 1) for p in flat for i, w in enumerate(p)]
        places = np.arange(len(want))
        assert [p.decode() for p in words.phrases(places, 1)] == [w for w, _ in want]
        assert [words.distinct[i].as_py().decode() for i in words.ids.tolist()] == [w for w, _ in want]
        assert words.joined.tolist() == [j for _, j in want]


def test_trie_counts_its_phrases_only():
    rng = random.Random(9)
    for size, letters in ((1, "a"), (300, "abc\x01\x02é"), (4000, "".join(map(chr, range(97, 600)))), (20_000, "abcdefgh")):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(max(2, size // 20))]
        make = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(2, 3)))
        phrases = sorted({make().encode() for _ in range(size)})
        trie = C.Trie.unpacked(C.Trie.build(phrases).packed())
        texts = [rng.choice([" ", ". "]).join(rng.choice(words) for _ in range(500)), " ".join(p.decode() for p in phrases[:200]), ""]
        want, _ = brute_counts([("x", t) for t in texts])
        counts = np.zeros(len(phrases), np.int64)
        trie.count(C.Words([t.encode() for t in texts]), counts)
        assert counts.tolist() == [want["x", tuple(p.decode().split(" "))] for p in phrases]
        trie.count(C.Words([]), counts)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many slices, shards and rounds, and a bitmap full of collisions
        for name, value in (("SLICE_BYTES", 2000), ("SHARD_BYTES", 200), ("ROUND_BYTES", 4000), ("BITMAP_BITS", 32768), ("BLOCK", 16)):
            monkeypatch.setattr(C, name, value)
    rows = odd_rows()
    docs = frame(spark, rows).repartition(3)
    for params, args in (({}, {}), ({"min_count": 4, "top": 5, "max_words": 4, "contained_percent": 80}, {"least": 4, "top": 5, "longest": 4, "percent": 80})):
        got = [tuple(r) for r in C.collocations(docs, **params).collect()]
        assert sorted(got) == sorted(brute(rows, **args))
        assert len(got) > 10


def test_phrases_with_equal_hashes_are_all_found(spark, monkeypatch):
    seen = []
    lost = C._lost
    monkeypatch.setattr(C, "_lost", lambda *a: seen.append(lost(*a)) or seen[-1])
    for name in ("BITMAP_BITS", "HASH_BITS"):
        monkeypatch.setattr(C, name, {"BITMAP_BITS": 32768, "HASH_BITS": 15}[name])
    rng = random.Random(8)  # several phrases a hash
    rows = odd_rows(4) + [("en", " ".join(f"w{rng.randrange(300)}" for _ in range(60)) * 2) for _ in range(400)]
    docs = frame(spark, rows).repartition(4)
    got = [tuple(r) for r in C.collocations(docs).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert any(not gap.isEmpty() for gap in seen)


def test_scores_are_exact_beyond_64_bits(spark):
    pairs = [(3_037_000_500, 3_037_000_501, 9_000_000_011), (10**13 - 1, 10**13, 10**13 + 7), (999_983, 1_000_003, 999_983)]
    df = spark.createDataFrame(pairs, "a long, l long, r long").selectExpr(
        "(cast(1000000 as decimal(8,0)) * (cast(a as decimal(14,0)) * cast(a as decimal(14,0)))) div (cast(l as decimal(14,0)) * cast(r as decimal(14,0))) s")
    assert [r.s for r in df.collect()] == [1_000_000 * a * a // (l * r) for a, l, r in pairs]


def test_empty_and_small_tables(spark):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for rows in ([], [(None, None)], [("en", "one two")]):
        out = C.collocations(frame(spark, rows) if rows else spark.createDataFrame([], "lang string, text string"))
        assert out.columns == columns and out.count() == 0
    out = C.collocations(frame(spark, [("en", "one two")] * 10))
    assert [tuple(r) for r in out.collect()] == [("en", 1, "one two", 10, 10, 10, 20, 1_000_000)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query_equals_loops_and_sql(spark):
    rows = duckdb.sql(f"SELECT lang, text FROM '{SF}/documents.parquet'").fetchall()
    want = sorted(brute(rows))
    assert sorted(tuple(r) for r in QUERIES["op13_phrase_collocations"](spark, SF).collect()) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    assert sorted(con.sql(ORACLES["op13_phrase_collocations"]).fetchall()) == want
