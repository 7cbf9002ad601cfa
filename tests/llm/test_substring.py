import random

import numpy as np
from pyspark.sql import Row

from fieldline.llm import substring as S


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_gear_hash_equals_recurrence():
    data = np.frombuffer(bytes(random.Random(1).randrange(256) for _ in range(300)), np.uint8)
    h, want = 0, []
    for b in data:
        h = (2 * h + int(S._GEAR[b])) & 0xFFFF
        want.append(h)
    assert S.gear_hash(data).tolist() == want


def test_cuts_cover_text_and_resist_insertions():
    rng = random.Random(2)
    for text in (words(rng, 3000), "漢字" * 5000, "a" * 20_000, "x", "ß " * 40):
        data = text.encode()
        cuts = S.cut_points(data)
        assert cuts == sorted(set(cuts)) and cuts[-1] == len(data)
        sizes = np.diff([0, *cuts])
        assert sizes.max() <= S.MAX_BYTES
        for i, j in zip([0, *cuts], cuts):
            data[i:j].decode()  # never inside a character
    a = words(rng, 3000).encode()
    b = a[:5000] + b"inserted words here " + a[5000:]
    ca, cb = ({d[i:j] for i, j in zip([0, *c], c)} for d, c in ((a, S.cut_points(a)), (b, S.cut_points(b))))
    assert len(ca - cb) <= 4
    assert S.cut_points(b"") == []


def brute(rows):
    """Texts after deleting, for each document in id order, the chunk runs seen before (one process, no Spark)."""
    owner = {}
    for d, t in sorted(rows):
        data = (t or "").encode()
        if data:
            for x in S.digests(data, S.cut_points(data)):
                owner.setdefault(x, d)
    out = {}
    for d, t in rows:
        data = (t or "").encode()
        spans = S.repeated_spans(data, {x for x in S.digests(data, S.cut_points(data)) if owner[x] < d}) if data else []
        for i, j in reversed(spans):
            data = data[:i] + data[j:]
        out[d] = data.decode() if t is not None else None
    return out


def test_planted_passages_go_and_clean_text_stays(spark):
    rng = random.Random(3)
    passages = [words(rng, n) for n in (52, 60, 90, 400)]
    rows = []
    for i in range(60):
        t = words(rng, rng.randint(20, 300))
        if i % 2:
            t = t + " " + passages[i // 2 % 4] + "\n" + words(rng, rng.randint(0, 200))
        rows.append((i, t))
    rows += [(60, rows[0][1]), (61, None), (62, ""), (63, "short text")]
    rng.shuffle(rows)
    df = spark.createDataFrame([Row(doc_id=d, text=t, row_id="clash", digest=1, removed_spans=2) for d, t in rows])
    out = S.substring_dedup(df)
    assert out.columns == ["doc_id", "text", "row_id", "digest", "removed_spans"]
    got = {r.doc_id: r for r in out.collect()}
    assert {d: r.text for d, r in got.items()} == brute(rows)
    by = dict(rows)
    for d, r in got.items():
        text = by[d] or ""
        for s in reversed(r.removed_spans):
            text = text[: s.start] + text[s.start + s.length:]
        assert text == (r.text or "")
        if d < 60 and d % 2 == 0:
            assert r.text == by[d]
    for p in passages:
        holders = sum(p in (r.text or "") for r in got.values())
        assert holders == 1
        tokens = p.split()
        left = 0
        for r in got.values():
            t = r.text or ""
            if p not in t:
                left = max(left, sum(" ".join(tokens[i:i + 5]) in t for i in range(len(tokens) - 4)))
        assert left <= 30
    assert got[60].text == ""


def test_nulls_repeats_and_empty_table(spark):
    rng = random.Random(4)
    a, b = words(rng, 100), words(rng, 80)
    schema = "text string, doc_id long"
    df = spark.createDataFrame([(a, 5), (a, 5), (a, None), (b, None), (b, None), (None, None), ("", 1)], schema)
    got = sorted(((r.doc_id, r.text) for r in S.substring_dedup(df).collect()), key=str)
    assert got == sorted([(5, a), (5, a), (None, ""), (None, b), (None, b), (None, None), (1, "")], key=str)
    assert S.substring_dedup(spark.createDataFrame([], schema)).count() == 0


def test_repeats_inside_one_text(spark):
    rng = random.Random(5)
    p, q = words(rng, 80), words(rng, 40)
    df = spark.createDataFrame([(1, p + " " + q + " " + p)], "doc_id long, text string")
    r = S.substring_dedup(df).first()
    assert r.text.startswith(p + " " + q) and len(r.text) < len(p + q) + 150


def test_every_passage_of_fifty_words_goes():
    rng = random.Random(6)
    vocab = [words(rng, 1) for _ in range(400)] + list("abcdefgh")
    for n in (50, 51, 55, 60, 80):
        for _ in range(400):
            p = " ".join(rng.choice(vocab) for _ in range(n))
            a, b = (f"{words(rng, rng.randint(5, 40))} {p} {words(rng, rng.randint(5, 40))}".encode() for _ in range(2))
            spans = S.repeated_spans(b, set(S.digests(a, S.cut_points(a))))
            assert len(spans) == 1
            low, high = spans[0]
            assert b[low:high].decode().strip() in p


def test_unspaced_text_and_short_whole_texts(spark):
    rng = random.Random(7)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))
    p, run, doc = han(2000), "".join(rng.choice("acgt") for _ in range(3000)), han(400)
    rows = [(1, han(300) + p + han(300)), (2, han(200) + p + han(100)), (3, words(rng, 30) + " " + run), (4, words(rng, 40) + " " + run),
            (5, doc), (6, doc), (7, "all of it"), (8, "all of it"), (9, "all of it and more"), (10, han(500))]
    got = {r.doc_id: r.text for r in S.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    by = dict(rows)
    assert all(got[d] == by[d] for d in (1, 3, 5, 7, 9, 10))
    assert got[6] == got[8] == ""
    assert len(got[2]) < 300 + 150 and got[2].startswith(by[2][:200]) and got[2].endswith(by[2][-100:])
    assert len(got[4]) < len(by[4]) - 3000 + 200
    assert got == brute(rows)


def test_unspaced_passages_are_found():
    rng = random.Random(8)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))
    for _ in range(200):
        p = han(300)
        a, b = ((han(100) + p + han(100)).encode() for _ in range(2))
        assert S.repeated_spans(b, set(S.digests(a, S.cut_points(a))))
