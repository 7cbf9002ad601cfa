"""Best-fit packing of tokenised documents with certified bin counts.

Documents are tokenised where they lie; only (id, piece, start, length, checksum) rows are shuffled.
Each partition packs its pieces by best-fit decreasing and computes a lower bound on its number of
sequences from dual feasible functions. The deal goes round by size, so every partition gets the same mix of sizes.
A partition that meets its bound is certified and final, but for its emptiest sequence, which only
the rounding up of its bound allows; the others ("gaps") keep their full sequences, exchange the pieces of all sequences with room left
under a new deal, over partitions twice as large, and pack again, until all are certified, a round
saves nothing or MAX_ROUNDS (which bounds a partition at PART_ROWS * 2 ** (MAX_ROUNDS - 1) pieces).
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint

CAPACITY = 1024
END_ID = 2
#: Pieces per packing task, about.
PART_ROWS = 32_768
MAX_ROUNDS = 5


#: The fixed split pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of so many characters without a space go to the slower encoder, whose time does not grow with their square.
LONG_RUN = 2000


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Token ids of whole texts under a ``tokenizers`` file, as bytes of little-endian 32-bit ids.

    In a byte-level BPE file without normaliser whose ids rise in the order of its merges, an id is
    a merge rank, and the file's own vocabulary can be given to a rank-based encoder that is about
    five times as fast and yields the same ids. Any other file, and texts with very long runs
    without a space, are encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self._ranked(spec)
        self.long_run = re.compile(r"[^ ]{%d}" % LONG_RUN)

    @staticmethod
    def _ranked(spec: dict):
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model.get("merges") or []]
        made = [vocab.get("".join(m), -1) for m in merges]
        symbols = byte_symbols()
        usual = (
            model["type"] == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
            and split.get("use_regex", True) and not spec.get("normalizer") and made == sorted(set(made)) and made
            and min(made) > max(vocab[c] for c in symbols if c in vocab) and all(c in vocab for c in symbols)
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "dropout"))
        )
        if not usual:
            return None
        import tiktoken

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        if self.fast is None or self.long_run.search(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def cut_pieces(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of a document's pieces; only a document beyond the capacity is cut."""
    n = len(ids) // 4
    first = n if n <= capacity else n % capacity or capacity
    ends = range(first, n + 1, capacity)
    out, low = [], 0
    for high in ends:
        out.append((low, high - low, zlib.crc32(ids[4 * low:4 * high])))
        low = high
    return out


_TOKENIZERS: dict[str, ByteBpe] = {}  # one per worker process, reused by later tasks


def _piece_batches(path: str, capacity: int):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = ByteBpe(path)
        tokenizer = _TOKENIZERS[path]
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for k, text in enumerate(batch.column("text").to_pylist()):
                pieces = cut_pieces(tokenizer(text or "") + end, capacity)
                rows.extend((k, i, *p) for i, p in enumerate(pieces))
            at, piece, start, length, crc = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(
        _piece_batches(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def bin_lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of bins any packing needs, by two families of dual feasible functions.

    For each threshold t: sizes above capacity - t need a bin of their own (rounded up to a whole
    bin), sizes below t are rounded down to nothing, and what the rest occupies beyond the room beside
    the sizes over half a bin needs further bins. Threshold 0 is the bound by total length.
    """
    if not len(sizes):
        return 0
    n = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    count = np.concatenate([[0], np.cumsum(n)])  # count[x]: sizes < x
    total = np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    t = np.arange(capacity // 2 + 1)
    half = capacity // 2
    alone = count[-1] - count[capacity - t + 1]
    large = count[capacity - t + 1] - count[half + 1]
    room = large * capacity - (total[capacity - t + 1] - total[half + 1])
    small = total[half + 1] - total[t]
    bound = alone + large + np.maximum(0, -(-(small - room) // capacity))
    return int(max(bound.max(), -(-total[-1] // capacity)))


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin number, offset in the bin) of each size and the number of bins."""
    order = np.argsort(-sizes, kind="stable")
    bins, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, used = 0, 0  # bit r: some bin has room r
    for k, size in zip(order.tolist(), sizes[order].tolist()):
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b = capacity, used
            used += 1
        bins[k], offset[k] = b, capacity - room
        room -= size
        if room:
            stacks[room].append(b)
            open_rooms |= 1 << room
    return bins, offset, used


PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, sequence_id long, offset long, done boolean"


def _pack_part(turn: int, capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid", ignore_index=True)
        sizes = pdf["length"].to_numpy(np.int64)
        bins, offset, used = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, weights=sizes, minlength=used).astype(np.int64)
        certified = (used == bin_lower_bound(sizes, capacity)) & (bins != fill.argmin())
        pdf["sequence_id"] = (turn << 58) + (int(pdf["part"].iloc[0]) << 26) + bins
        pdf["offset"] = offset
        pdf["done"] = certified | (fill[bins] == capacity)
        return pdf[[c.split()[0] for c in PACKED.split(", ")]]

    return run


def _numbered(pieces: DataFrame) -> DataFrame:
    """Number the rows (partition, place by length in it); stored, so that a retry deals the same way."""
    order = pieces.sortWithinPartitions("length", "doc_id", "piece")
    return checkpoint(order.withColumn("uid", F.monotonically_increasing_id()))


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, piece, start, length, ids_crc32)."""
    todo = _numbered(pieces)
    n, final, before, last = todo.count(), [], None, None
    for turn in range(MAX_ROUNDS):
        parts = max(1, -(-n // (part_rows << turn)))
        source, place = F.shiftright("uid", 33), F.col("uid").bitwiseAND(F.lit((1 << 33) - 1))
        dealt = todo.withColumn("part", F.pmod(F.xxhash64(source, F.lit(turn)) + place, F.lit(parts)))
        packed = checkpoint(dealt.groupBy("part").applyInPandas(_pack_part(turn, capacity), PACKED))
        used = packed.where("offset = 0").count()
        if before is not None and used >= before:
            break  # nothing saved: the last round's sequences stand
        if last is not None:
            final[-1] = last.where("done")
        final.append(packed)
        left = packed.where("not done").agg(F.count("*"), F.count(F.when(F.col("offset") == 0, 1))).first()
        last, (n, before) = packed, left
        if not n or parts == 1:
            break
        todo = _numbered(packed.where("not done").drop("sequence_id", "offset", "done", "uid"))
    out = final[0]
    for more in final[1:]:
        out = out.unionByName(more)
    return out.drop("uid", "done")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Pack all ``docs`` (doc_id, text; further columns are ignored) into sequences of ``capacity`` tokens.

    A document is its token ids and the id 2; a null or empty text is that id alone. Only a document
    beyond the capacity is cut, its first piece the shorter. Rows that repeat a doc_id (or have none)
    are packed each on its own. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset;
    an empty table gives an empty result.
    """
    return pack(token_pieces(docs, tokenizer, capacity), capacity, part_rows)
