"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are stored as bit planes (plane p holds bit p of 64 fingerprints per machine word).
One pass over the planes updates the Hamming distances of a query to 64 fingerprints at a time with
carry-save counters; a word whose 64 distances all exceed the radius is abandoned.

The pairs to compare come from the pigeonhole principle: with the 64 bits cut into ``m`` blocks, two
fingerprints within ``radius`` < m bits agree on at least ``m - radius`` blocks, so each choice of
that many blocks keys one table of buckets and no pair is lost. Equal fingerprints are one row
before any comparison; a bucket of more than ``BUCKET_CAP`` rows is dealt out as cells of chunk
pairs. A cell returns a spanning forest of its links, never the pairs themselves.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.llm.common import SURROGATE, checkpoint, connected_components, row_id

BITS = 64
BUCKET_CAP = 8192
#: Buckets are keyed so finely that they hold about this many rows, as far as the key bits reach.
BUCKET_AIM = 512
TILE_WORDS = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a whole text: majority of the bits of its shingles' XXH64 (seed 42)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, end = (end - size)[: len(words) - k + 1].tolist(), end[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[i:j], 42) for i, j in zip(start, end)], "<u8")
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def _fingerprint_batches(shingle: int, carried: list[str]):
    def run(batches):
        for batch in batches:
            seen: dict[str | None, int] = {}
            out = []
            for text in batch.column("text").to_pylist():
                if text not in seen:
                    seen[text] = fingerprint(text, shingle)
                out.append(seen[text])
            fp = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(fp)], [*carried, "fp"]
            )

    return run


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, words) planes: bit j of word w in plane p is bit p of fingerprint 64 w + j."""
    lanes = -(-len(fp) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[: len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


class _Counter:
    """Bit-sliced counters: the distances of many pairs, one bit plane per binary digit."""

    def __init__(self, shape, radius: int):
        self.radius = radius
        self.digits = [np.zeros(shape, np.uint64) for _ in range(max(1, radius.bit_length()))]
        self.over = np.zeros(shape, np.uint64)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        low = self.digits[0]
        half = x ^ y
        carry = (x & y) | (low & half)
        self.digits[0] = low ^ half
        for i in range(1, len(self.digits)):
            digit = self.digits[i]
            self.digits[i], carry = digit ^ carry, digit & carry
        self.over |= carry

    def beyond(self) -> np.ndarray:
        """Mask of the pairs whose distance so far exceeds the radius."""
        above, equal = self.over.copy(), ~self.over
        for i in reversed(range(len(self.digits))):
            if self.radius >> i & 1:
                equal = equal & self.digits[i]
            else:
                above |= equal & self.digits[i]
                equal = equal & ~self.digits[i]
        return above

    def keep(self, cells) -> None:
        self.digits = [d[cells] for d in self.digits]
        self.over = self.over[cells]


def near_cells(queries: np.ndarray, planes: np.ndarray, radius: int):
    """Yield (query numbers, word numbers, masks): set bits are fingerprints within the radius."""
    words = planes.shape[1]
    lean = np.bitwise_count(planes).sum(axis=1, dtype=np.int64) * 2 - words * 64
    order = np.argsort(np.abs(lean), kind="stable")  # the planes that tell most apart come first
    step = max(1, TILE_WORDS // words)
    for low in range(0, len(queries), step):
        part = queries[low:low + step]
        masks = np.where((part[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1), ALL, np.uint64(0))
        count = _Counter((len(part), words), radius)
        q = w = None
        for n in range(0, BITS, 2):
            i, j = order[n], order[n + 1]
            if q is None:
                count.add(planes[i][None, :] ^ masks[i][:, None], planes[j][None, :] ^ masks[j][:, None])
            else:
                count.add(planes[i][w] ^ masks[i][q], planes[j][w] ^ masks[j][q])
            if n % 8 == 6 or n == BITS - 2:
                live = count.beyond() != ALL
                if q is None:
                    if live.mean() < 0.5 or n == BITS - 2:
                        q, w = np.nonzero(live)
                        count.keep((q, w))
                elif live.mean() < 0.7 or n == BITS - 2:
                    q, w = q[live], w[live]
                    count.keep(live)
                if q is not None and not len(q):
                    break
        if len(q):
            yield q + low, w, ~count.beyond()


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = up


def join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the sets of all pairs (a, b) in place; every root is its set's smallest number."""
    while len(a):
        a, b = _roots(parent, a), _roots(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Spanning forest (child, root) of the links among ``left``, or between left and right."""
    fp = left if right is None else np.concatenate([left, right])
    shift = 0 if right is None else len(left)
    lanes = left if right is None else right
    parent = np.arange(len(fp))
    for q, w, mask in near_cells(left, bit_planes(lanes), radius):
        for low in range(0, len(q), 1 << 15):
            part = slice(low, low + (1 << 15))
            bits = np.unpackbits(mask[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cell, lane = np.nonzero(bits)
            a, b = q[part][cell], w[part][cell] * 64 + lane
            real = b < len(lanes) if right is not None else (b < len(lanes)) & (b > a)
            join_sets(parent, a[real], b[real] + shift)
    child = np.arange(len(fp))
    root = _roots(parent, child)
    linked = root != child
    return np.stack([fp[linked].view(np.int64), fp[root[linked]].view(np.int64)], axis=1)


def _cell_links(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        low, high = pdf["i"].iloc[0], pdf["j"].iloc[0]
        if low == high:
            links = spanning_links(fp, None, radius)
        else:
            mine = (pdf["chunk"] == low).to_numpy()
            links = spanning_links(fp[mine], fp[~mine], radius)
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def bucket_tables(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """Per table the bit ranges (shift, width) that key its buckets; the same pairs meet for any ``n``.

    More blocks give longer keys and more tables; the smallest number of blocks whose keys are long
    enough for buckets of about BUCKET_AIM rows is taken.
    """
    want = max(1, n // BUCKET_AIM).bit_length() - 1
    for blocks in range(radius + 1, min(radius + 4, BITS) + 1):
        cuts = [BITS * i // blocks for i in range(blocks + 1)]
        chosen = blocks - radius
        if want <= chosen * (BITS // blocks) or blocks == min(radius + 4, BITS):
            break
    tables = []
    for choice in combinations(range(blocks), chosen):
        left, ranges = want, []
        for c in choice:
            width = min(left, cuts[c + 1] - cuts[c])
            if width:
                ranges.append((cuts[c], width))
                left -= width
        tables.append(ranges)
    assert len(tables) == comb(blocks, chosen)
    return [[]] if not want else tables


def _bucket_key(ranges: list[tuple[int, int]]) -> Column:
    key = F.lit(0).cast("long")
    for shift, width in ranges:
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        key = F.shiftleft(key, width).bitwiseOR(part)
    return key


def fingerprint_links(reps: DataFrame, radius: int, n: int) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column ``fp``."""
    tables = bucket_tables(n, radius)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), _bucket_key(r).alias("key")) for t, r in enumerate(tables)])
    rows = reps.select("fp", F.inline(keys))
    sizes = rows.groupBy("t", "key").agg(F.ceil(F.count("*") / F.lit(float(BUCKET_CAP))).cast("int").alias("s"),
                                         F.count("*").alias("n")).where("n > 1").drop("n")
    dealt = rows.join(sizes, ["t", "key"]).withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    cells = dealt.select("fp", "t", "key", "chunk", F.least("chunk", "other").alias("i"),
                         F.greatest("chunk", "other").alias("j"))
    return cells.groupBy("t", "key", "i", "j").applyInPandas(_cell_links(radius), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, radius: int, more: list[Column] = []) -> DataFrame:
    """doc_id, row_id, the columns ``more``, fp, set (the component's label) and best (its smallest row_id), a row a document."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id("doc_id", "text").alias("row_id"), *more,
                       F.col("text").cast("string").alias("text"))
    kinds = base.drop("text").dtypes
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds) + ", fp long"
    fps = checkpoint(base.mapInArrow(_fingerprint_batches(shingle, [name for name, _ in kinds]), schema))
    reps = checkpoint(fps.groupBy("fp").agg(F.min("row_id").alias("rep")))
    links = fingerprint_links(reps.select("fp"), radius, reps.count())
    sets = connected_components(links)
    named = reps.join(sets.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "set", F.coalesce("component", "fp")
    )
    # Few fingerprints are linked at all: only these need their component's smallest id looked up.
    linked = named.where("component is not null")
    best = linked.groupBy("set").agg(F.min("rep").alias("best"))
    class_of = linked.join(best, "set").select("fp", "set", "best").unionByName(
        named.where("component is null").select("fp", "set", F.col("rep").alias("best"))
    )
    return fps.join(class_of, "fp")


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """Near-duplicate groups of ``docs`` (doc_id, text; further columns are ignored).

    Returns one row per input row: doc_id, row_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id linked directly or through others, itself included) and ``kept`` (this row's id is
    the smallest). Words are runs without ASCII white space, A-Z in lower case. A null or wordless
    text has fingerprint zero and links like any other. A null doc_id gets a surrogate ``row_id``
    larger than any id; its component_id is null only if no member of the component has an id. Rows
    that repeat a doc_id stay rows of their own. An empty table gives an empty result.
    """
    return _grouped(docs, shingle, radius).select(
        "doc_id", "row_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("best") < SURROGATE, F.col("best")).alias("component_id"),
        (F.col("row_id") == F.col("best")).alias("kept"),
    )


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id.

    If rows of a group repeat that id, the one with the smallest text hash stays (of equal texts, any one).
    Rows that repeat an id in different groups all stay.
    """
    text = F.xxhash64(F.col("text").cast("string"))
    kept = _grouped(docs, shingle, radius, [text.alias("hash")]).where("row_id = best").groupBy("set").agg(
        F.min("row_id").alias("__row"), F.min("hash").alias("__hash"))
    # Rows of one id and text have one fingerprint, so they are in one group.
    out = docs.withColumn("__row", row_id("doc_id", "text")).withColumn("__hash", text)
    out = out.join(kept.select("__row", "__hash"), ["__row", "__hash"], "left_semi")
    return out.dropDuplicates(["__row", "__hash"]).drop("__row", "__hash")
