"""Secret scan: pattern matches, and credential values that would be hard to guess.

Base spans are regular-expression matches (``assign``: a credential name with a value of eight or
more characters; ``access``: access-key ids; ``hex``: long lower-case hexadecimal runs).

Method. Values in a credential context (after a credential name and a separator, quoted or not, and
the password part of a URL) are scored by password guess-cost dynamic programming: the cheapest
segmentation into

* words of a ranked dictionary (log2 of the rank, plus bits for capitals and look-alike characters),
* dates (days of a month, months and years in usual orders, with or without separators),
* repeats (a unit of up to MAX_PERIOD characters that recurs at least once),
* keyboard walks (neighbouring keys, bits for the first key, each turn and each shift), and
* brute-force spans (characters times log2 of the alphabet of the classes that occur),

each span costing SEGMENT_BITS more. A value whose cheapest segmentation needs ``min_bits`` or more
is a span of kind ``guess``; names, samples and easily guessed values stay below. The method only adds
spans. The dynamic program is linear in the value's length (brute force, walks and repeats are
running states, words and dates have bounded length), so values are scored whole.

The dictionary is the ranked word list given as a parameter, by default the whole words of a public
subword vocabulary, whose ids rise as frequency falls; it is cut at MAX_WORDS entries, which bounds
what is broadcast.

Cases. A null or empty text has no spans. Spans of equal kind don't overlap; ties in the start are
ordered as the kinds are listed. A context whose value is itself a credential name ("password:
token: x") passes the word on as the next context, and references to variables or templates are no
values. Rows are independent: repeats give repeated rows, an empty table gives an empty one, other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache
from math import comb, inf, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldline.llm import common

KINDS = ("assign", "access", "hex", "guess")
#: About 10**9 guesses.
MIN_BITS = 30.0
MAX_WORDS = 1 << 16
MAX_WORD_LENGTH = 24
MAX_PERIOD = 16
MAX_DATE_LENGTH = 10
SEGMENT_BITS = 1.0
REPEAT_BITS = 3.0
TURN_BITS = log2(6)
SHIFT_BITS = 1.0
#: Years up to this one count as likely in a date.
REFERENCE_YEAR, YEAR_SPACE = 2025, 100

# The patterns of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16

NAME = (r"(?:password|passwd|passphrase|passcode|secret|token|credentials?|api[_ -]?key|access[_ -]?key|"
        r"private[_ -]?key|(?<![A-Za-z])(?:pass|pwd|pin|auth|login))")
CONTEXT = re.compile(NAME + r"""["']?\x20*(?::|=>|=|\x20is\x20)\x20*""", re.A | re.I)
NAME_ALONE = re.compile(NAME, re.A | re.I)
VALUE = re.compile(r""""([^"\n]+)"|'([^'\n]+)'|["']?([^\s"',;]+)""")
USERINFO = re.compile(r"://[^\s:/@]+:([^\s/@]+)@")
REFERENCE = re.compile(r"\$\{?[A-Za-z_][\w.]*\}?|\$\(.*\)|<[^<>]*>|\{\{.*\}\}|\{\w*\}|%\w+%|\[[A-Za-z_ ]*\]")
TRAILING = ".,:!?)]}>|"
#: A text without any of these (lower-cased) holds no base span but hex, and no credential context.
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "pin", "auth", "login", "://")

# Passwords and samples that are guessed first.
COMMON = ("password", "123456", "12345678", "qwerty", "admin", "letmein", "welcome", "monkey", "dragon", "master", "login",
          "abc123", "iloveyou", "trustno1", "sunshine", "princess", "football", "baseball", "shadow", "superman", "passw0rd",
          "changeme", "secret", "default", "guest", "root", "test", "example", "sample", "dummy", "none", "null", "true",
          "false", "your", "token", "apikey", "here", "placeholder", "redacted")
LOOK_ALIKE = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t"})
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# The rows of a keyboard, unshifted and shifted; each row stands half a key to the right of the one above.
KEY_ROWS = (("`1234567890-=", "~!@#$%^&*()_+"), (" qwertyuiop[]\\", " QWERTYUIOP{}|"),
            (" asdfghjkl;'", ' ASDFGHJKL:"'), (" zxcvbnm,./", " ZXCVBNM<>?"))
KEYS = {ch: (r, c, shift) for r, pair in enumerate(KEY_ROWS) for shift, row in enumerate(pair) for c, ch in enumerate(row) if ch != " "}
#: Steps to the six neighbours of a key in that slanted grid.
STEPS = {(0, 1), (0, -1), (1, 0), (-1, 0), (1, -1), (-1, 1)}
FIRST_KEY_BITS = log2(47)

CLASS_SIZES = (10, 26, 26, 33, 100)


def char_class(ch: str) -> int:
    """0 digit, 1 lower case, 2 upper case, 3 other ASCII, 4 beyond ASCII."""
    if "0" <= ch <= "9":
        return 0
    if "a" <= ch <= "z":
        return 1
    if "A" <= ch <= "Z":
        return 2
    return 3 if ch < "\x80" else 4


def vocabulary_words(path: str) -> list[str]:
    """Whole words of a ``tokenizers`` vocabulary file in the order of their ids, common passwords first."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = dict.fromkeys(COMMON)
    for token in sorted((t for t in vocab if t.startswith("\u0120") or t.endswith("</w>")), key=vocab.get):
        word = token.removeprefix("\u0120").removesuffix("</w>").translate(ASCII_LOWER)
        if 3 <= len(word) <= MAX_WORD_LENGTH and word.isascii() and word.isalpha():
            words.setdefault(word)
    return list(words)[:MAX_WORDS]


class GuessCost:
    """Bits of the cheapest segmentation of a value."""

    def __init__(self, words: Sequence[str]):
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.longest = min(MAX_WORD_LENGTH, max(map(len, self.rank), default=0))
        self.bits = lru_cache(maxsize=1 << 14)(self._bits)

    def word_bits(self, span: str) -> float:
        low = span.translate(ASCII_LOWER)
        plain = low.translate(LOOK_ALIKE)
        best = inf
        if low in self.rank:
            best = log2(self.rank[low])
        if plain != low and plain in self.rank:
            best = min(best, log2(self.rank[plain]) + sum(a != b for a, b in zip(low, plain)))
        if best == inf or span == low:
            return best
        upper = sum("A" <= c <= "Z" for c in span)
        lower = sum("a" <= c <= "z" for c in span)
        if lower == 0 or (upper == 1 and "A" <= span[0] <= "Z"):
            return best + 1
        return best + log2(sum(comb(upper + lower, k) for k in range(1, min(upper, lower) + 1)))

    @staticmethod
    def brute_bits(span: str) -> float:
        return len(span) * log2(sum(CLASS_SIZES[c] for c in set(map(char_class, span))))

    @staticmethod
    def walk_bits(span: str) -> float:
        if len(span) < 3 or any(c not in KEYS for c in span):
            return inf
        bits, last = FIRST_KEY_BITS + SHIFT_BITS * KEYS[span[0]][2], None
        for a, b in zip(span, span[1:]):
            step, shift = key_step(a, b)
            if step is None:
                return inf
            bits += (TURN_BITS if step != last else 0.0) + shift
            last = step
        return bits

    def unit_bits(self, unit: str) -> float:
        """Cost of a repeated unit as one span."""
        return min(self.word_bits(unit), date_bits(unit), self.walk_bits(unit), self.brute_bits(unit))

    def _bits(self, s: str) -> float:
        low = s.translate(ASCII_LOWER)
        plain = low.translate(LOOK_ALIKE)
        classes = [char_class(c) for c in s]
        present = sorted(set(classes))
        masks = [{c for k, c in enumerate(present) if m >> k & 1} for m in range(1, 1 << len(present))]
        cost = [log2(sum(CLASS_SIZES[c] for c in m)) for m in masks]
        brute = [inf] * len(masks)
        periods = range(1, min(MAX_PERIOD, len(s) // 2) + 1)
        same = [0] * (MAX_PERIOD + 1)
        repeat = [inf] * (MAX_PERIOD + 1)
        pair = walk = inf
        last = None
        best = [0.0]
        for i, ch in enumerate(s):
            new = best[i] + SEGMENT_BITS
            found = inf
            for m, mask in enumerate(masks):
                brute[m] = min(brute[m], new) + cost[m] if classes[i] in mask else inf
                found = min(found, brute[m])
            step, shift = key_step(s[i - 1], ch) if i else (None, 0.0)
            if step is None:
                pair = walk = inf
            else:
                walk = min(pair, walk) + (TURN_BITS if step != last else 0.0) + shift
                pair = best[i - 1] + SEGMENT_BITS + FIRST_KEY_BITS + SHIFT_BITS * KEYS[s[i - 1]][2] + TURN_BITS + shift
                found = min(found, walk)
            last = step
            for p in periods:
                if i < p or s[i - p] != ch:
                    same[p], repeat[p] = 0, inf
                    continue
                same[p] += 1
                if same[p] >= p:
                    start = i + 1 - 2 * p
                    repeat[p] = min(repeat[p], best[start] + SEGMENT_BITS + self.unit_bits(s[start:start + p]) + REPEAT_BITS)
                    found = min(found, repeat[p])
            for length in range(3, min(self.longest, i + 1) + 1):
                start = i + 1 - length
                if low[start:i + 1] in self.rank or plain[start:i + 1] in self.rank:
                    found = min(found, best[start] + SEGMENT_BITS + self.word_bits(s[start:i + 1]))
            if classes[i] == 0:
                for length in range(4, min(MAX_DATE_LENGTH, i + 1) + 1):
                    start = i + 1 - length
                    if classes[start] == 0:
                        found = min(found, best[start] + SEGMENT_BITS + date_bits(s[start:i + 1]))
            best.append(found)
        return best[-1]


def key_step(a: str, b: str):
    """(step, shift bits) from key to neighbouring key; the step is None if they are no neighbours."""
    if a not in KEYS or b not in KEYS:
        return None, 0.0
    (r0, c0, s0), (r1, c1, s1) = KEYS[a], KEYS[b]
    step = (r1 - r0, c1 - c0)
    return (step, SHIFT_BITS * (s0 != s1)) if step in STEPS else (None, 0.0)


DATE = re.compile(r"(\d{1,4})([-/._ ])(\d{1,2})\2(\d{1,4})", re.A)


def _date_fields(span: str):
    """Ways to read a span as (year text, month or day, day or month, has separators)."""
    m = DATE.fullmatch(span)
    if m:
        a, _, b, c = m.groups()
        return [(y, p, q, True) for y, p, q in ((a, b, c), (c, a, b)) if len(y) in (2, 4) and len(p) <= 2 and len(q) <= 2]
    if len(span) in (6, 8) and span.isascii() and span.isdigit():
        y = len(span) - 4
        return [(span[:y], span[y:y + 2], span[y + 2:], False), (span[4:], span[:2], span[2:4], False)]
    return []


@lru_cache(maxsize=1 << 14)
def date_bits(span: str) -> float:
    """Bits of a year (1900 to 2099) or of a day of one; infinite if the span is no date."""
    if len(span) == 4 and span.isascii() and span.isdigit():
        return log2(max(YEAR_SPACE, abs(int(span) - REFERENCE_YEAR))) if "1900" <= span <= "2099" else inf
    best = inf
    for year, p, q, separated in _date_fields(span):
        y, p, q = int(year), int(p), int(q)
        if len(year) == 2:
            y += 2000 if y <= REFERENCE_YEAR - 2000 else 1900
        if 1900 <= y <= 2099 and 1 <= min(p, q) <= 12 and 1 <= max(p, q) <= 31:
            best = min(best, log2(366 * max(YEAR_SPACE, abs(y - REFERENCE_YEAR))) + 2.0 * separated)
    return best


def credential_values(text: str):
    """(start, end) of the values that stand in a credential context, left to right."""
    at = 0
    while (context := CONTEXT.search(text, at)) is not None:
        at = context.end()
        value = VALUE.match(text, at)
        if value is None:
            continue
        start, end = value.span(value.lastindex)
        reference = REFERENCE.fullmatch(text, start, end)
        if value.lastindex == 3:
            end -= len(value[3]) - len(value[3].rstrip(TRAILING))
        if end <= start or NAME_ALONE.fullmatch(text, start, end):
            continue
        at = value.end()
        if not reference and not REFERENCE.fullmatch(text, start, end):
            yield start, end
    for m in USERINFO.finditer(text):
        if not REFERENCE.fullmatch(m[1]):
            yield m.span(1)


def scan_text(text: str | None, cost: GuessCost, min_bits: float = MIN_BITS) -> list[tuple[str, int, int, float | None]]:
    """All spans (kind, start, end, bits) of a whole text, by start, then kind as listed."""
    if not text:
        return []
    spans = [("hex", *m.span(), None) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [("access", *m.span(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    low = text.lower()
    if any(hint in low for hint in HINTS):
        spans += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
        for start, end in dict.fromkeys(credential_values(text)):
            bits = cost.bits(text[start:end])
            if bits >= min_bits:
                spans.append(("guess", start, end, bits))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, words: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
                 min_bits: float = MIN_BITS) -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end, bits).

    Offsets count code points, ends are exclusive; bits are null but for kind ``guess``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(words[:MAX_WORDS]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))
    names = ("kind", "start", "end", "bits")
    most = common.SLICE_BYTES

    def run(batches):
        cost = GuessCost(shared.value)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            for low, n in common.row_slices(texts, most):
                found = [[dict(zip(names, s)) for s in scan_text(t.as_py(), cost, min_bits)] for t in texts.slice(low, n)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, n), pa.array(found, span_type)], ["id", "spans"])

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, "
                               "spans array<struct<kind:string,start:long,end:long,bits:double>>")
    return out.withColumnRenamed("id", id_col)


def spans_text(spans, kinds: Sequence[str] = KINDS):
    """The spans of the given kinds as text: kind:start:end, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
