"""Substring dedup by content-defined chunking with a gear rolling hash.

A text's UTF-8 bytes may be cut after white space (inside a run without white space that is
``LONG_WORD`` bytes long, after characters where a gear hash has two bits clear). Of these places those
are cut whose gear hash is the least of some ``WINDOW`` places in a row (winnowing), so cuts move with
the content, an insertion changes only the chunks beside it, and cuts are at most ``WINDOW`` places
apart. The hash that is compared depends on the last 8 bytes only: all cuts of a repeated passage are
the same in both texts, but for ``WINDOW`` - 1 places and 8 bytes at either end.

A digest covers ``SPAN`` chunks in a row: digests repeat only where a passage does, not where a few
common words do. A repeated passage of 50 words has 26 or more between its first and its last sure cut,
in five chunks or more; so it is always found.

Of each repeated digest the occurrence in the smallest id stays (within a text, the first). A run of
repeated chunks is deleted if it holds at least ``min_words`` words, or ``WORD_CHARS`` code points for
each of them (scripts without white space). A digest of its own kind covers the text as a whole: a text
that is repeated as a whole is deleted whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldline.llm.common import row_id

WINDOW = 6
SPAN = 3
MAX_BYTES = 4096
LONG_WORD = 64
MIN_WORDS = 25
#: A run without enough words is long enough with so many code points for each word asked for (150 for 25).
WORD_CHARS = 6
_GEAR = np.array([xxhash.xxh64_intdigest(bytes([i]), 7) & 0xFFFF for i in range(256)], np.uint16)
#: The order in which the hash's low bytes are preferred as cuts.
_ORDER = np.random.default_rng(7).permutation(256)
_SPACE = np.isin(np.arange(256), np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))


def gear_hash(data: np.ndarray) -> np.ndarray:
    """16-bit gear hash after each byte, h[i] = 2 h[i-1] + gear[data[i]], by doubling the window."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        if len(h) > width:
            h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of a text's bytes (the last is len(data)); none for empty bytes."""
    n = len(data)
    if not n:
        return []
    b = np.frombuffer(data, np.uint8)
    h = gear_hash(b)
    space = _SPACE[b]
    place = space & ~np.append(space[1:], False)  # the last of several
    at = np.arange(n)
    last = np.maximum.accumulate(np.where(space, at, -1))
    # In a long run without white space a character's last byte may be a cut, if two bits are clear.
    long_run = at - last >= LONG_WORD
    if long_run.any():
        ends = np.append(b[1:] & 0xC0 != 0x80, True)
        place |= long_run & ends & (h & np.uint16(0x00C0) == 0)
    places = np.flatnonzero(place)
    if len(places) > WINDOW:
        order = _ORDER[h[places] & 0xFF]
        window = np.lib.stride_tricks.sliding_window_view(order[::-1], WINDOW)[::-1]
        # The last of equal ones: the view runs backwards, and argmin takes the first.
        places = np.unique(places[np.arange(len(window)) + WINDOW - 1 - window.argmin(axis=1)])
    cuts, low = [], 0
    for c in (places + 1).tolist():
        if c - low > MAX_BYTES:
            _forced(data, low, c, cuts)
        cuts.append(c)
        low = c
    if n - low > MAX_BYTES:
        _forced(data, low, n, cuts)
    if not cuts or cuts[-1] < n:
        cuts.append(n)
    return cuts


def _forced(data: bytes, low: int, high: int, cuts: list[int]) -> None:
    """Cuts at most MAX_BYTES apart between low and high, at characters' starts."""
    while high - low > MAX_BYTES:
        low += MAX_BYTES
        while data[low] & 0xC0 == 0x80:
            low -= 1
        cuts.append(low)


def digests(data: bytes, cuts: list[int]) -> list[int]:
    """Per run of SPAN chunks, its digest (fewer chunks: of them all); last, that of the text as a whole."""
    hashed = xxhash.xxh64_intdigest
    starts = [0, *cuts[:-1]]
    own = [hashed(data[i:j]) for i, j in zip(starts, cuts[SPAN - 1:])] if len(cuts) > SPAN else [hashed(data)]
    return [*own, hashed(data, 1)]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _digest_rows(batches):
    for batch in batches:
        ids, out = [], []
        for rid, text in zip(batch.column("row_id").to_pylist(), batch.column("text").to_pylist()):
            data = (text or "").encode("utf-8", "surrogatepass")
            if data:
                own = set(digests(data, cut_points(data)))
                ids.append(np.full(len(own), rid, np.int64))
                out.append(_signed(list(own)))
            if sum(map(len, out)) > 200_000:
                yield _digest_batch(ids, out)
                ids, out = [], []
        if out:
            yield _digest_batch(ids, out)


def _digest_batch(ids, out):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(ids))], ["digest", "row_id"])


def repeated_spans(data: bytes, repeated: set[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Byte spans to delete: runs of chunks whose digest is in ``repeated`` or came before in the text."""
    cuts = cut_points(data)
    flags = [False] * len(cuts)
    seen: set[int] = set()
    *own, whole = digests(data, cuts)
    if whole in repeated:
        return [(0, len(data))]
    for i, d in enumerate(own):
        if d in repeated or d in seen:
            flags[i:i + SPAN] = [True] * len(flags[i:i + SPAN])
        seen.add(d)
    spans, low = [], None
    starts = [0, *cuts[:-1]]
    for i, flag in enumerate([*flags, False]):
        if flag and low is None:
            low = starts[i]
        elif not flag and low is not None:
            high = cuts[i - 1]
            part = data[low:high]
            if len(part.split()) >= min_words or len(part.decode("utf-8", "surrogatepass")) >= WORD_CHARS * min_words:
                spans.append((low, high))
            low = None
    return spans


def _remove(min_words: int):
    def run(batches):
        for batch in batches:
            texts, removed = [], []
            for text, own in zip(batch.column("__text").to_pylist(), batch.column("__repeated").to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = repeated_spans(data, {d & 0xFFFFFFFFFFFFFFFF for d in own or ()}, min_words) if data else []
                if not spans:
                    texts.append(text)
                    removed.append([])
                    continue
                kept, chars, at, low = [], [], 0, 0
                for i, j in spans:
                    before = data[low:i].decode("utf-8", "surrogatepass")
                    gone = data[i:j].decode("utf-8", "surrogatepass")
                    kept.append(before)
                    chars.append({"start": at + len(before), "length": len(gone)})
                    at += len(before) + len(gone)
                    low = j
                kept.append(data[low:].decode("utf-8", "surrogatepass"))
                texts.append("".join(kept))
                removed.append(chars)
            keep = [i for i, name in enumerate(batch.schema.names) if name not in ("__text", "__repeated")]
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(texts, pa.string()), pa.array(removed, spans_type)],
                [batch.schema.names[i] for i in keep] + ["__text", "__removed"],
            )

    return run


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages deleted from ``text``, and a column ``removed_spans``.

    Every row stays, with all its columns; ``removed_spans`` lists (start, length) of the deleted
    passages in code points of the old text (a column of that name in ``docs`` is replaced). A text
    that is repeated as a whole becomes empty; null and empty texts stay as they are. Rows that
    repeat a doc_id count as one document: they keep what they share. A null doc_id sorts after all
    ids, by content. An empty table gives an empty result.
    """
    base = docs.select(row_id("doc_id", "text").alias("row_id"), F.col("text").cast("string").alias("text"))
    rows = base.mapInArrow(_digest_rows, "digest long, row_id long")
    first = rows.groupBy("digest").agg(F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    first = first.where("low < high").select("digest", "low")
    # Hot digests: the aggregation combines before its shuffle, and the join's large side can be split.
    repeated = rows.join(first, "digest").where("row_id > low").groupBy("row_id").agg(
        F.collect_list("digest").alias("__repeated")
    )
    keyed = docs.drop("removed_spans").withColumn("__row", row_id("doc_id", "text")).withColumnRenamed("text", "__text")
    joined = keyed.join(repeated.withColumnRenamed("row_id", "__row"), "__row", "left").drop("__row")
    others = [f for f in joined.schema.fields if f.name not in ("__text", "__repeated")]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType([*others, T.StructField("__text", T.StringType()), T.StructField("__removed", T.ArrayType(span))])
    out = joined.mapInArrow(_remove(min_words), schema)
    return out.select(*[F.col("__text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns
                        if c != "removed_spans"], F.col("__removed").alias("removed_spans"))
