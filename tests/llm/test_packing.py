import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from fieldline.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


ODD = ["", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\n b\n", "x\t y", "it's we'll 'S", "a  b  c", "a 　b",
       "a\x1c b", "\x1c a", "a\u0085 b", "<|endoftext|>", "x <|endoftext|> y", "漢字 かな  🙂🙂 é", "12 345  6", "a​ b", "᠎ b"]


def test_ids_equal_those_of_tokenizers(plain):
    rng = random.Random(1)
    alphabet = [" ", " ", "  ", "\n", "\t", "a", "the", "Is", "'s", "é", "ß", "9", "!", "\u00a0", "\u2003", "\x1d", "漢", "_", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice((rng.randrange(0x20, 0x3000), rng.randrange(0x1F000, 0x1FB00)))) for _ in range(80)) for _ in range(300)]
    texts += ["ab" * 3000, "a b " * 3000, "\n" * 5000]
    fast = P.ByteBpe(PATH)
    assert fast.fast is not None
    for t in texts:
        assert np.frombuffer(fast(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    other = P.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert np.frombuffer(other("Some Words here"), "<u4").tolist() == word.encode("Some Words here", add_special_tokens=False).ids


def test_cut_pieces():
    ids = np.arange(2500, dtype="<u4").tobytes()
    assert [p[:2] for p in P.cut_pieces(ids)] == [(0, 452), (452, 1024), (1476, 1024)]
    assert P.cut_pieces(ids[:4096]) == [(0, 1024, zlib.crc32(ids[:4096]))]
    assert [p[:2] for p in P.cut_pieces(ids[:8192])] == [(0, 1024), (1024, 1024)]
    assert [p[:2] for p in P.cut_pieces(ids[:4100])] == [(0, 1), (1, 1024)]


def least_bins(sizes, capacity):
    """Smallest number of bins by exhaustive search."""
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[i]}:
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, rest + [r - sizes[i]])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_bound_never_exceeds_the_optimum_and_packing_is_valid():
    rng = random.Random(2)
    for _ in range(150):
        cap = rng.choice([10, 16, 21])
        sizes = np.array([rng.randint(1, cap) for _ in range(rng.randint(1, 9))])
        bins, offset, used = P.best_fit_decreasing(sizes, cap)
        opt = least_bins(sizes.tolist(), cap)
        assert P.bin_lower_bound(sizes, cap) <= opt <= used
        for b in range(used):
            spans = sorted((o, o + s) for o, s, x in zip(offset, sizes, bins) if x == b)
            assert spans[0][0] == 0 and spans[-1][1] <= cap
            assert all(i[1] == j[0] for i, j in zip(spans, spans[1:]))
    assert P.bin_lower_bound(np.array([6, 6, 6]), 10) == 3
    assert P.bin_lower_bound(np.array([], int), 10) == 0


def check_packed(rows, docs, plain, capacity=1024):
    want = defaultdict(list)
    for d, t in docs:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        at = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for i, (a, b) in enumerate(zip(at, at[1:])):
            want[d].append((i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for spans in seqs.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    sizes = np.array([r.length for r in rows])
    return len(seqs), P.bin_lower_bound(sizes, capacity)


def test_documents_are_packed_whole(spark, plain):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "of", "Über", "x1"]) for _ in range(int(rng.expovariate(1 / 400))))) for i in range(400)]
    docs += [(500, None), (501, ""), (None, "p q"), (None, "p q"), (7, "again 7"), (502, "long " * 5000)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, uid="clash", part=1, length=2) for d, t in docs])
    n, bound = check_packed(P.pack_documents(df, PATH).collect(), docs, plain)
    assert n <= bound + 1
    # many small partitions: the exchange closes the gaps that each leaves
    n, bound = check_packed(P.pack_documents(df, PATH, part_rows=40).collect(), docs, plain)
    assert n <= bound + 4


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
