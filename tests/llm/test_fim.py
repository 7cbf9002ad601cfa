import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from fieldline.llm import common, fim
from fieldline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, n string, form string, output int"


def plain_form(doc_id, text, seed=7, rate=100, spm=50):
    """The transformation by plain slicing of a list of lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_marks_equal_byte_loops():
    rng = np.random.default_rng(3)
    for size in (0, 1, 7, 8, 9, 63, 500):
        data = rng.choice(np.array([0x0A, 0x0B, 0x8A, 0x09, 0x41, 0xC3, 0xBF, 0x00, 0xFF], np.uint8), size)
        words = fim.words_of(data)
        for marks, hit in ((fim.mark_equal(words, 0x0A), data == 0x0A),
                           (fim.mark_continuation(words), (data & 0xC0) == 0x80)):
            assert (marks.view(np.uint8)[:size] == np.where(hit, 0x80, 0)).all()
            m = fim.Marks(marks)
            at = np.arange(size + 1)
            assert (m.rank(at) == np.concatenate([[0], np.cumsum(hit)])).all()
            where = np.flatnonzero(hit)
            assert (m.select(np.arange(1, len(where) + 1)) == where).all()


def odd_texts():
    rng = random.Random(5)
    texts = [None, "", "\n", "a", "a\n", "\n\n\n", "é\nß\n🙂\n漢", "has <P> inside\nb", "<S", "<\n<P\n>", "x<M>\n",
             "a<\nP>\nb<S\n>", "tab\tand\r\nreturn\r\n", "  \x0b\x0c\n\x85", "\n" * 3000, "no end " * 30_000]
    alphabet = ["\n", "\n", "a", "é", "漢字", "🙂", "<", "P", ">", " line of text ", "\x00", "\r"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    return texts


def test_equals_plain_slicing(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    rows = [(i * 37 - 200, t) for i, t in enumerate(odd_texts())] + [(None, "null id\nb\nc\n"), (9, "twice\nx"), (9, "twice\nx")]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, n="x", form="psm", output=1) for i, t in rows], SCHEMA).repartition(3)
    for params in ({}, {"seed": 3, "rate": 60, "spm_rate": 20}):
        got = fim.fim_transform(docs, **params).withColumn("back", fim.fim_restore(F.col("output"), F.col("form"))).collect()
        key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
        want = [(i, *plain_form(i, t, params.get("seed", 7), params.get("rate", 100), params.get("spm_rate", 50)), t or "")
                for i, t in rows]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
        assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    out = fim.fim_transform(empty)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and out.count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_query_equals_slicing_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in docs:
        n, form, p, m, out = plain_form(i, t)
        want.append((i, n, form, p, m, digest(out), digest(t or "")))
    got = [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, sf).collect()]
    assert sorted(got) == sorted(want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(ORACLES["op12_fill_in_middle"]).fetchall()) == sorted(want)
