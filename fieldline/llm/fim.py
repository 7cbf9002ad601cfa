"""Fill-in-middle transformation with word-parallel (SWAR) line selection.

A text is cut into units, its lines (each with its line feed; the last may lack one). Two cut points
are drawn per document from a hash of its id, and the three parts are put in an order that lets a
model read prefix and suffix before it writes the middle.

Method. The texts of a slice of rows are one buffer of UTF-8 bytes, viewed as 64-bit words. Bytes
that end a unit are marked by arithmetic on whole words (byte equality without carries between
lanes), ``bitwise_count`` counts the marks of every word, and a unit's end is found by searching the
cumulative counts for its word and then resolving the select inside the word: a multiplication gives
the running count of each byte lane, a subtraction compares all lanes with the wanted rank at once.
Code points are counted the same way, by marking the bytes that continue one. No text is decoded
and no line is materialised; time and memory are linear in the bytes of a slice, which holds
32 MB or one longer text.

Cases. A null text is empty. An empty text, or one that holds a sentinel, stays plain (its counts of
code points are null). A null id draws its cuts from the empty decimal. Equal rows give equal rows;
an empty table gives an empty one; the input's other columns are not read, so their names can't
clash. Texts are expected to be valid UTF-8, as Spark's strings are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Of a hundred documents, how many are transformed, and how many of those put the suffix first.
RATE, SPM_RATE = 100, 50

LANES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
ONE, SEVEN, EIGHT = np.uint64(1), np.uint64(7), np.uint64(8)


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, zero-padded, with a spare word at the end."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def mark_equal(words: np.ndarray, byte: int) -> np.ndarray:
    """0x80 in each byte lane that equals ``byte``; lanes don't carry into each other."""
    x = words ^ (LANES * np.uint64(byte))
    return ~(((x & LOW) + LOW) | x | LOW)


def mark_continuation(words: np.ndarray) -> np.ndarray:
    """0x80 in each byte lane of the form 10xxxxxx, which starts no code point."""
    return words & ~(words << ONE) & HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before each position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = self.marks[word] & ((ONE << (byte * EIGHT)) - ONE)
        return self.before[word] + np.bitwise_count(inside)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth marks, counted from 1."""
        word = np.searchsorted(self.before, nth, "left") - 1
        left = (nth - self.before[word]).astype(np.uint64)
        running = (self.marks[word] >> SEVEN) * LANES
        reached = ((running | HIGH) - left * LANES) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def draws(doc_id, seed: int) -> list[int]:
    """The four numbers that decide a document: 8-digit groups of the hash of seed and id."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    return np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], ">u4").tolist()


def _transform(ids: list, texts: pa.Array, seed: int, rate: int, spm_rate: int):
    """Columns (n, form, prefix_chars, middle_chars, output) of one slice of rows."""
    rows = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset: texts.offset + rows + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]: offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    start, end = bounds[:-1], bounds[1:]
    words = words_of(data)
    ends = Marks(mark_equal(words, 0x0A))
    inner = Marks(mark_continuation(words))
    first = ends.rank(start)
    closed = ends.rank(end) - first
    filled = end > start
    open_end = filled.copy()
    open_end[filled] = data[end[filled] - 1] != 0x0A
    n = closed + open_end

    h = np.array([draws(i, seed) for i in ids], np.int64).reshape(rows, 4)
    cut_a, cut_b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    plain = ~filled | (h[:, 2] % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    spm = h[:, 3] % 100 < spm_rate

    def unit_end(k: np.ndarray) -> np.ndarray:
        at = np.where(k == 0, start, end)
        marked = (k > 0) & (k <= closed)
        at[marked] = ends.select((first + k)[marked]) + 1
        return at

    p, m = unit_end(np.minimum(cut_a, cut_b)), unit_end(np.maximum(cut_a, cut_b))
    before = [inner.rank(x) for x in (start, p, m)]
    prefix_chars = (p - start) - (before[1] - before[0])
    middle_chars = (m - p) - (before[2] - before[1])

    raw = memoryview(data)
    output = []
    for s, i, j, e, is_plain, is_spm in zip(*(x.tolist() for x in (start, p, m, end, plain, spm))):
        if is_plain:
            output.append(bytes(raw[s:e]))
        elif is_spm:
            output.append(b"".join((b"<S>", raw[j:e], b"<P>", raw[s:i], b"<M>", raw[i:j])))
        else:
            output.append(b"".join((b"<P>", raw[s:i], b"<S>", raw[j:e], b"<M>", raw[i:j])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return [
        pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
        pa.array(prefix_chars, pa.int64(), mask=plain), pa.array(middle_chars, pa.int64(), mask=plain),
        pa.array(output, pa.binary()).cast(pa.string()),
    ]


def fim_transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                  rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per document: its id, n units, form, prefix_chars, middle_chars and the output text."""
    schema = docs.select(F.col(id_col).alias("id")).schema
    out_names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    most = common.SLICE_BYTES

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            for low, rows in common.row_slices(texts, most):
                ids = batch.column("id").slice(low, rows)
                columns = _transform(ids.to_pylist(), texts.slice(low, rows), seed, rate, spm_rate)
                yield pa.RecordBatch.from_arrays([ids, *columns], out_names)

    id_type = schema["id"].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col)


def fim_restore(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from.

    A transformed text holds each sentinel once, so cutting there gives the parts back exactly.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


#: DuckDB: lines by regular expression, cuts by the hex digits of the hash.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u
  FROM documents
), c AS (
  SELECT *, len(u) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= {RATE} THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, text, n, form,
         array_to_string(u[1:least(a, b)], '') AS prefix,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
                        ELSE '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
