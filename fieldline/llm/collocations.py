"""Phrase collocations per language, counted with double-array tries.

Method, level-wise as in Apriori (a phrase can only be frequent if its sub-phrases are):

1. ``words``: counts of all words per language (one aggregation).
2. For k = 1, 2, ...: a pass over the texts looks at neighbouring phrases of k words that both are
   possibly frequent (their hash is set in a bitmap of BITMAP_BITS bits) and adds up the hashes of
   the phrases of k + 1 words that they make. Hashes that reach the threshold form the next bitmap,
   and a second pass writes down their phrases, each from a text that the first pass has named for it.
   Collisions of bits only add candidates. Where phrases collide in their hash, the named text may lack
   one: then the counts of step 4 fall short of the hash's, and its phrases are sought in all texts.
3. The candidates are split into shards by language and first word, and each shard becomes a double-array
   trie over UTF-8 bytes (built in a task). The tries are broadcast in rounds of at most
   ROUND_BYTES of phrases, whatever the number of candidates.
4. In each round numpy starts one state at every word of a slice of text and advances all of them
   byte by byte, level by level; states without a transition drop out, states that accept at a
   word's end are added up with ``bincount``. A task hands on its count vectors in compressed blocks,
   and those of all text shards are summed block by block.
5. Scores, containment and ranks are joins and windows over the counted phrases.

What reaches the driver: bitmaps (fixed size), the tries of one round, and one row per trie. Scores
are exact integers (decimals of up to 38 digits; counts below 10**14).

Cases. A null text is empty, a null language is ``und``. Phrases never cross a piece's end. Repeated
rows count as often as they occur. Texts of any length are read whole; a task holds one slice of text
(SLICE_BYTES or one longer text). An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: A phrase is dropped for a longer one that has this share (in a hundred) of its count.
CONTAINED_PERCENT = 50
SCALE = 1_000_000
#: Parts that a language is ranked in first.
SALTS = 8
SLICE_BYTES = 2 << 20
#: Entries (words, hashes) that a task holds before it merges them.
HELD = 1 << 18
#: Hashes of candidates that are broadcast at a time.
OWNED = 1 << 21
HASH_BITS = 56
#: Counts that travel together.
BLOCK = 1 << 16
BITMAP_BITS = 1 << 26
#: Bytes of phrases in a trie, and in the tries that are broadcast at a time.
SHARD_BYTES, ROUND_BYTES = 8 << 20, 36 << 20

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SPACE, PIECE = 32, 10
NORMAL = bytes(
    PIECE if b in PIECE_ENDS else SPACE if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


class Words:
    """The words of a slice of texts of one language.

    ``text`` holds them in order, each followed by a space or, at the end of a piece, by a line feed;
    ``start`` and ``end`` are their places, ``ids`` number the distinct words in ``distinct``, ``tags``
    hold a checksum of the text that each word stands in.
    """

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b""]).translate(NORMAL), np.uint8)
        gap = (raw == SPACE) | (raw == PIECE)
        after_gap = np.concatenate([[True], gap[:-1]])
        first, last = np.flatnonzero(~gap & after_gap), np.flatnonzero(gap & ~after_gap)
        breaks = np.cumsum(raw == PIECE, dtype=np.int32)
        closes = np.ones(len(first), bool)
        closes[:-1] = breaks[first[1:]] > breaks[last[:-1] - 1]
        size = last - first
        self.text = raw[~gap | ~after_gap].copy()
        begins = np.cumsum([len(t) + 1 for t in texts])
        self.tags = np.array([zlib.crc32(t) for t in texts], np.uint32)[np.searchsorted(begins, first, "right")] if len(first) else np.zeros(0, np.uint32)
        self.end = (np.cumsum(size + 1) - 1).astype(np.int32)
        self.start = self.end - size.astype(np.int32)
        self.text[self.end] = np.where(closes, PIECE, SPACE)
        self.joined = ~closes  # the next word belongs to the same piece
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        letters = np.ascontiguousarray(raw[~gap])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def phrases(self, at: np.ndarray, k: int) -> list[bytes]:
        """The phrases of k words that begin at the given words."""
        raw = memoryview(self.text)
        return [bytes(raw[i:j]) for i, j in zip(self.start[at].tolist(), self.end[at + k - 1].tolist())]

    def distinct_at(self, at: np.ndarray, k: int) -> np.ndarray:
        """One place for each distinct phrase of k words among those that begin at the given words."""
        code, many = np.zeros(len(at), np.int64), len(self.distinct)
        for j in range(k):
            _, one, code = np.unique(code * many + self.ids[at + j], return_index=True, return_inverse=True)
        return at[one] if len(at) else at


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def phrase_hashes(h: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the phrases of 1 to ``longest`` words that begin at each word, given the words' hashes."""
    out = [h]
    for k in range(1, longest):
        out.append(_mix(out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:]) if len(out[-1]) else h[:0])
    return out


class HashCounts:
    """Adds up hashes over many slices, in memory that does not grow; keeps a tag of one occurrence of each."""

    def __init__(self, bits: int):
        self.bits, self.hashes, self.tags, self.held = bits, [], [], 0

    def add(self, h: np.ndarray, tags: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.hashes.append(h)
        self.tags.append(tags)
        self.held += len(h)
        if self.held >= 2 * HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            key = _cut(np.concatenate(self.hashes), self.bits)
            order = np.argsort(key)
            key = key[order]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n, tag = np.diff(np.append(at, len(key))), np.concatenate(self.tags)[order[at]].view(np.int32)
            key = key[at]
            yield _table({"h": pa.array(key.view(np.int64), pa.int64()), "n": pa.array(n, pa.int64()), "tag": pa.array(tag, pa.int32())})
        self.__init__(self.bits)


def _cut(h: np.ndarray, bits: int) -> np.ndarray:
    return h & np.uint64((1 << bits) - 1)


def _is_set(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _slices(batches, most: int) -> Iterator[tuple[str, Words]]:
    """Slices of the texts of one language, within a batch."""
    for batch in batches:
        held, size = defaultdict(list), defaultdict(int)
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            lang, body = lang.as_py(), text.as_buffer()
            if body is None or not body.size:
                continue
            held[lang].append(body)
            size[lang] += body.size
            if size[lang] >= most:
                yield lang, Words(held.pop(lang))
                size[lang] = 0
                pa.default_memory_pool().release_unused()
        for lang, texts in held.items():
            yield lang, Words(texts)
        pa.default_memory_pool().release_unused()


def _table(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def word_counts(texts: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, n) of the words that occur often enough; the row without a word counts all words."""
    most = SLICE_BYTES

    def run(batches):
        held, size = [], 0
        for lang, words in _slices(batches, most):
            n = np.bincount(words.ids, minlength=len(words.distinct))
            if not len(n):
                continue
            word = pa.concat_arrays([words.distinct.cast(pa.large_string()).cast(pa.string()), pa.nulls(1, pa.string())])
            held.append(_table({"lang": pa.array([lang] * len(word), pa.string()), "word": word, "n": pa.array(np.append(n, n.sum()), pa.int64())}))
            size += len(word)
            if size >= HELD:
                held = [merged(held)]
                if len(held[0]) * 2 > HELD:  # mostly different words: nothing more to merge
                    yield held.pop()
                size = sum(map(len, held))
        if held:
            yield merged(held)

    def merged(parts):
        both = pa.Table.from_batches(parts).group_by(["lang", "word"]).aggregate([("n", "sum")]).combine_chunks()
        return _table({"lang": both["lang"].combine_chunks(), "word": both["word"].combine_chunks(), "n": both["n_sum"].combine_chunks()})

    counted = texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return checkpoint(counted.where(F.col("word").isNull() | (F.col("n") >= min_count)))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in column h; at most BITMAP_BITS / 8 bytes reach the driver."""
    bit = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    parts = hashes.groupBy(F.shiftright(bit, 15).alias("part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros((max(1, BITMAP_BITS >> 15), 4096), np.uint8)
    for part, bits in parts:
        out[part] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def word_bits(frequent: DataFrame) -> np.ndarray:
    """The bitmap of the frequent words of all languages."""

    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            h = np.array([word_hashes(lang, [w.encode()])[0] for lang, w in pairs], np.uint64)
            yield _table({"h": pa.array(h.view(np.int64), pa.int64())})

    return bitmap(frequent.select("lang", "word").mapInArrow(run, "h long"))


def _hits(words: Words, keys: np.ndarray, k: int, bitmap_k: np.ndarray) -> np.ndarray:
    """Which words begin a phrase of k words of one piece whose hash is set."""
    hit = _is_set(bitmap_k, keys)
    for j in range(k - 1):
        hit &= words.joined[j:j + len(hit)]
    return hit


def screen(texts: DataFrame, k: int, bits: np.ndarray, min_count: int) -> DataFrame:
    """Hashes h of the phrases of k + 1 words that reach ``min_count``, where both their phrases of k words are set.

    ``tag`` is the checksum of a text that holds one of the phrases.
    """
    shared, most, width = texts.sparkSession.sparkContext.broadcast(bits), SLICE_BYTES, HASH_BITS

    def run(batches):
        held = HashCounts(width)
        for lang, words in _slices(batches, most):
            keys = phrase_hashes(word_hashes(lang, words.distinct.to_pylist())[words.ids], k + 1)
            hit = _hits(words, keys[k - 1], k, shared.value)
            if len(hit) > 1:
                both = hit[:-1] & hit[1:] & words.joined[k - 1:k + len(hit) - 2]
                yield from held.add(keys[k][both], words.tags[:len(both)][both])
        yield from held.flush()

    rows = texts.mapInArrow(run, "h long, n long, tag int").groupBy("h").agg(F.sum("n").alias("n"), F.max("tag").alias("tag"))
    found = checkpoint(rows.where(F.col("n") >= min_count))
    texts.sparkSession._jvm.System.gc()  # the shuffle files of a finished step go when their plan is collected
    return found


def candidate_phrases(texts: DataFrame, k: int, found: DataFrame, anywhere: bool = False) -> DataFrame:
    """The distinct (lang, phrase) of k words behind the hashes that ``screen`` found.

    A phrase is written down by the texts with its hash's tag alone, not by every task that holds it, or
    ``anywhere``. The hashes are broadcast in parts of about OWNED.
    """
    spark, most, width = texts.sparkSession, SLICE_BYTES, HASH_BITS
    parts, out = max(1, -(-found.count() // OWNED)), None
    for part in range(parts):
        owned = found.where(F.pmod("h", F.lit(parts)) == part).orderBy("h").toArrow()
        shared = spark.sparkContext.broadcast((owned["h"].to_numpy().astype(np.uint64), owned["tag"].to_numpy().view(np.uint32)))

        def run(batches, shared=shared):
            hashes, tags = shared.value
            low = np.uint64((1 << 24) - 1)
            maybe = np.zeros(1 << 24, bool)  # tells most words apart from the hashes without a search
            maybe[hashes & low] = True
            for lang, words in _slices(batches, most):
                key = _cut(phrase_hashes(word_hashes(lang, words.distinct.to_pylist())[words.ids], k)[k - 1], width)
                if not len(key) or not len(hashes):
                    continue
                hit = maybe[key & low]
                for j in range(k - 1):
                    hit &= words.joined[j:j + len(hit)]
                place = np.flatnonzero(hit)
                at = np.minimum(np.searchsorted(hashes, key[place]), len(hashes) - 1)
                place = place[(hashes[at] == key[place]) & (anywhere | (tags[at] == words.tags[place]))]
                new = words.phrases(words.distinct_at(place, k), k)
                yield _table({"lang": pa.array([lang] * len(new), pa.string()), "phrase": pa.array(new, pa.binary()).cast(pa.string())})

        rows = checkpoint(texts.mapInArrow(run, "lang string, phrase string").distinct())
        out = rows if out is None else out.unionByName(rows)
    return out


class Trie:
    """Double array over bytes: state s has child t = base[s] + byte iff check[t] == s; 0 is the root.

    Built level by level for all nodes of a depth at once. Nodes with many children get a block of
    their own, those with a few try random places of a sparse region until no two collide, and nodes
    with one child, the bulk, fill free slots in order.
    """

    CROWDED = 32

    def __init__(self, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.base, self.check, self.accept = base, check, accept

    @classmethod
    def build(cls, phrases: list[bytes]) -> Trie:
        """``phrases`` are distinct, not empty and in ascending order; the accepting state of the nth holds n."""
        trie = cls(np.zeros(512, np.int32), np.full(512, -1, np.int32), np.full(512, -1, np.int32))
        trie.check[0] = -2  # the root is nobody's child
        trie.free_from = 256
        data = np.frombuffer(b"".join(phrases), np.uint8)
        size = np.array([len(p) for p in phrases], np.int64)
        begin = np.cumsum(size) - size
        state, live, depth = np.zeros(len(phrases), np.int64), np.arange(len(phrases)), 0
        rng = np.random.default_rng(len(phrases))
        while len(live):
            parent, byte = state[live], data[begin[live] + depth].astype(np.int64)
            new = np.ones(len(live), bool)
            new[1:] = (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])
            slots = trie._place(parent[new], byte[new], rng)
            state[live] = slots[np.cumsum(new) - 1]
            depth += 1
            ended = size[live] == depth
            trie.accept[state[live[ended]]] = live[ended]
            live = live[~ended]
        slots = max(512, int(np.flatnonzero(trie.check >= 0).max(initial=0)) + 1)
        room = slots + 512 - len(trie.check)  # base + 255 stays inside
        if room > 0:
            trie._grow(room)
        return cls(trie.base[:slots + 512], trie.check[:slots + 512], trie.accept[:slots + 512])

    def packed(self) -> bytes:
        """The arrays for sending: accepting states as a list, all compressed."""
        ends = np.flatnonzero(self.accept >= 0).astype(np.int32)
        arrays = np.concatenate([[len(self.base), len(ends)], self.base, self.check, ends, self.accept[ends]]).astype(np.int32)
        return zlib.compress(arrays.tobytes(), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Trie:
        arrays = np.frombuffer(zlib.decompress(data), np.int32)
        slots, n = int(arrays[0]), int(arrays[1])
        base, check, ends, phrases = np.split(arrays[2:], np.cumsum([slots, slots, n]))
        accept = np.full(slots, -1, np.int32)
        accept[ends] = phrases
        return cls(base, check, accept)

    def _grow(self, by: int) -> int:
        """Append slots; returns where they begin."""
        begin = len(self.check)
        self.base = np.concatenate([self.base, np.zeros(by, np.int32)])
        self.check = np.concatenate([self.check, np.full(by, -1, np.int32)])
        self.accept = np.concatenate([self.accept, np.full(by, -1, np.int32)])
        return begin

    def _place(self, parent: np.ndarray, byte: np.ndarray, rng) -> np.ndarray:
        """Slots for the children (parent, byte), given in the order of their parents."""
        head = np.ones(len(parent), bool)
        head[1:] = parent[1:] != parent[:-1]
        group = np.cumsum(head) - 1
        owner, count = parent[head], np.bincount(group)
        base = np.zeros(len(owner), np.int64)

        crowded = np.flatnonzero(count > self.CROWDED)
        if len(crowded):
            base[crowded] = self._grow(256 * len(crowded)) + 256 * np.arange(len(crowded))
            self._claim(owner, base, group, byte, np.isin(group, crowded))
        few = (count > 1) & (count <= self.CROWDED)
        if few.any():
            room = 8 * int(count[few].sum()) + 512
            low = self._grow(room)
            for least, most in ((9, self.CROWDED), (4, 8), (2, 3)):
                todo = np.flatnonzero((count >= least) & (count <= most))
                while len(todo):
                    base[todo] = rng.integers(low, low + room - 256, len(todo))
                    rows = np.flatnonzero(np.isin(group, todo))
                    slot = base[group[rows]] + byte[rows]
                    lone = np.zeros(len(rows), bool)
                    lone[np.unique(slot, return_index=True)[1]] = True
                    clash = np.zeros(len(owner), bool)
                    clash[group[rows[~lone | (self.check[slot] != -1)]]] = True
                    self._claim(owner, base, group, byte, np.isin(group, todo[~clash[todo]]))
                    todo = todo[clash[todo]]
        single = np.flatnonzero(count == 1)
        if len(single):
            free = self.free_from + np.flatnonzero(self.check[self.free_from:] == -1)
            if len(free) < len(single):
                low = self._grow(max(len(single) - len(free), len(self.check) // 4))
                free = np.concatenate([free, np.arange(low, len(self.check))])
            free = free[: len(single)]
            self.free_from = int(free[-1]) + 1
            rows = np.flatnonzero(count[group] == 1)
            base[single] = free - byte[rows]
            self._claim(owner, base, group, byte, count[group] == 1)
        return base[group] + byte

    def _claim(self, owner, base, group, byte, rows) -> None:
        self.base[owner[group[rows]]] = base[group[rows]]
        self.check[base[group[rows]] + byte[rows]] = owner[group[rows]]

    def _advance(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children reached by the bytes, and which of them exist."""
        child = self.base.take(state) + byte
        return child, self.check.take(child) == state

    def _after_first_words(self, words: Words) -> np.ndarray:
        """The state after each distinct word and a space; -1 where no phrase goes on."""
        one = np.empty(len(words.distinct), np.int64)
        one[words.ids[::-1]] = np.arange(len(words.ids))[::-1]
        at, end = words.start[one], words.end[one]
        out, live, state = np.full(len(one), -1, np.int32), np.arange(len(one)), np.zeros(len(one), np.int32)
        while len(live):
            byte = np.where(at[live] == end[live], np.uint8(SPACE), words.text[at[live]])
            child, goes = self._advance(state[live], byte)
            over = at[live] == end[live]
            out[live[goes & over]] = child[goes & over]
            state[live] = child
            at[live] += 1
            live = live[goes & ~over]
        return out

    def count(self, words: Words, counts: np.ndarray) -> None:
        """Add to ``counts`` how often each phrase (of two words or more) begins at one of the words and ends at a word's end.

        All places advance together, a byte at a time; the first word is walked once per distinct word.
        """
        if not len(words.ids):
            return
        state = self._after_first_words(words)[words.ids]
        begins = words.joined & (state >= 0)
        state, at, text = state[begins], words.end[begins] + 1, words.text
        while len(at):
            child, goes = self._advance(state, text[at])
            state, at = child[goes], at[goes] + 1
            phrase = self.accept[state]
            done = (phrase >= 0) & ((text[at] == SPACE) | (text[at] == PIECE))
            if done.any():
                counts += np.bincount(phrase[done], minlength=len(counts))


def build_tries(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (lang, phrase) -> numbered phrases (lang, shard, id, phrase) and tries (lang, shard, n, n_bytes, trie)."""
    sized = candidates.withColumn("first", F.substring_index("phrase", " ", 1)).withColumn("size", F.octet_length("phrase"))
    firsts = sized.groupBy("lang", "first").agg(F.sum("size").alias("bytes"))
    langs = firsts.groupBy("lang").agg(F.ceil(F.sum("bytes") / F.lit(SHARD_BYTES)).cast("int").alias("shards"))
    # All phrases of a first word are in one shard, but for words with more phrases than a shard holds.
    spread = F.ceil(F.col("bytes") / F.lit(SHARD_BYTES)).cast("int")
    place = F.pmod(F.xxhash64("first") + F.pmod(F.xxhash64("phrase"), spread), F.col("shards"))
    dealt = sized.join(firsts, ["lang", "first"]).join(langs, "lang").select("lang", place.cast("int").alias("shard"), "phrase")
    order = Window.partitionBy("lang", "shard").orderBy("phrase")
    numbered = checkpoint(dealt.withColumn("id", (F.row_number().over(order) - 1).cast("int")))

    def make(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        phrases = [p.encode() for p in part["phrase"]]
        trie = Trie.build(phrases)
        return pd.DataFrame({"lang": [part["lang"].iloc[0]], "shard": [part["shard"].iloc[0]], "n": [len(phrases)],
                             "n_bytes": [sum(map(len, phrases))], "trie": [trie.packed()]})

    tries = numbered.groupBy("lang", "shard").applyInPandas(
        make, "lang string, shard int, n int, n_bytes long, trie binary")
    return numbered, checkpoint(tries)


def _rounds(sizes: list) -> list[list]:
    """Tries in groups of at most ROUND_BYTES of phrases (one larger trie alone)."""
    out, total = [[]], 0
    for row in sizes:
        if out[-1] and total + row.n_bytes > ROUND_BYTES:
            out.append([])
            total = 0
        out[-1].append(row)
        total += row.n_bytes
    return [r for r in out if r]


def _sum_blocks(batches):
    """Sum the count vectors of equal (lang, shard, block), which come one after the other; one vector is held."""
    def rows(key, total):
        ids = np.flatnonzero(total)
        return _table({"lang": pa.array([key[0]] * len(ids), pa.string()), "shard": pa.array(np.full(len(ids), key[1], np.int32)),
                       "id": pa.array((ids + key[2]).astype(np.int32)), "n": pa.array(total[ids], pa.int64())})

    key = total = None
    for batch in batches:
        for *at, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "block", "counts"))):
            counts = np.frombuffer(zlib.decompress(data), np.int64)
            if at == key:
                total = total + counts
                continue
            if key is not None:
                yield rows(key, total)
            key, total = at, counts
    if key is not None:
        yield rows(key, total)


def count_phrases(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lang, phrase, n): contiguous occurrences of every candidate within pieces."""
    spark, most = texts.sparkSession, SLICE_BYTES
    numbered, tries = build_tries(candidates)
    counted = spark.createDataFrame([], "lang string, shard int, id int, n long")
    for group in _rounds(tries.select("lang", "shard", "n_bytes").orderBy("lang", "shard").collect()):
        wanted = spark.createDataFrame([(r.lang, r.shard) for r in group], "lang string, shard int")
        rows = tries.join(F.broadcast(wanted), ["lang", "shard"]).select("lang", "shard", "n", "trie").toArrow()
        shared = spark.sparkContext.broadcast(list(zip(*(c.to_pylist() for c in rows.columns))))
        del rows

        def run(batches, shared=shared):
            by_lang = defaultdict(list)
            for lang, shard, n, trie in shared.value:
                by_lang[lang].append((shard, Trie.unpacked(trie), np.zeros(n, np.int64)))
            for lang, words in _slices(batches, most):
                for _, trie, counts in by_lang.get(lang, ()):
                    trie.count(words, counts)
            for lang, found in by_lang.items():
                for shard, _, counts in found:
                    for low in range(0, len(counts), BLOCK):
                        block = counts[low:low + BLOCK]
                        if block.any():
                            yield _table({"lang": pa.array([lang]), "shard": pa.array([shard], pa.int32()), "block": pa.array([low], pa.int32()),
                                          "counts": pa.array([zlib.compress(block.tobytes(), 1)], pa.binary())})

        blocks = texts.mapInArrow(run, "lang string, shard int, block int, counts binary")
        blocks = blocks.repartition("lang", "shard", "block").sortWithinPartitions("lang", "shard", "block")
        counted = counted.unionByName(checkpoint(blocks.mapInArrow(_sum_blocks, counted.schema)))
        shared.unpersist()
    return checkpoint(counted.join(numbered, ["lang", "shard", "id"]).select("lang", "phrase", "n"))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _lost(counted: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Hashes of ``found`` that occur more often than the counted phrases behind them.

    Two phrases may share a hash while the text that was named for it holds only one. A frequent phrase's
    parts are all frequent, so every occurrence of it is in n; a phrase that was lost leaves a gap.
    """
    width = HASH_BITS

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")))
            h = [phrase_hashes(word_hashes(lang, p.encode().split(b" ")), k)[k - 1][:1] for lang, p in rows]
            h = _cut(np.concatenate(h), width) if h else np.zeros(0, np.uint64)
            yield _table({"h": pa.array(h.view(np.int64), pa.int64()), "seen": batch.column("n")})

    own = counted.where(F.size(F.split("phrase", " ")) == k).select("lang", "phrase", "n").mapInArrow(run, "h long, seen long")
    seen = own.groupBy("h").agg(F.sum("seen").alias("seen"))
    return checkpoint(found.join(seen, "h", "left").where(F.col("n") > F.coalesce("seen", F.lit(0))).select(*found.columns))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts (lang, phrase, k, n) of all phrases of up to ``max_words`` words that occur ``min_count`` times, and (lang, n) of all words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = word_counts(texts, min_count)
    frequent = words.where("word IS NOT NULL")
    bits, screened = word_bits(frequent), {}
    for k in range(2, max_words + 1):
        screened[k] = screen(texts, k - 1, bits, min_count)
        bits = bitmap(screened[k])
    counts = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "n")
    if screened:
        listed = _union(candidate_phrases(texts, k, found) for k, found in screened.items())
        longer = count_phrases(texts, listed)
        gaps = {k: _lost(longer, found, k) for k, found in screened.items()}
        gaps = {k: lost for k, lost in gaps.items() if not lost.isEmpty()}
        if gaps:
            more = _union(candidate_phrases(texts, k, lost, anywhere=True) for k, lost in gaps.items())
            longer = longer.unionByName(count_phrases(texts, more.join(listed, ["lang", "phrase"], "left_anti")))
        longer = longer.where(F.col("n") >= min_count)
        counts = counts.unionByName(longer.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("k"), "n"))
    return checkpoint(counts), words.where("word IS NULL").select("lang", "n")


def _part(words: Column, first: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 contained_percent: int = CONTAINED_PERCENT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = phrase_counts(docs, min_count, max_words, text_col, lang_col)
    candidates = counts.where("k > 1").withColumn("w", F.split("phrase", " "))

    cut = F.col("cut")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.col("w"), F.lit(1), cut).alias("left"),
                       _part(F.col("w"), cut + 1, F.col("k") - cut).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(14,0)")
    scaled = F.lit(SCALE).cast("decimal(8,0)") * (wide("a") * wide("a"))
    score = F.call_function("div", scaled, wide("l") * wide("r"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r", "a")).alias("b"))

    inner = candidates.where("k > 2").select(
        "lang", F.col("n").alias("outer_n"),
        F.explode(F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))"))
        .alias("phrase")).groupBy("lang", "phrase").agg(F.max("outer_n").alias("outer_n"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("outer_n").isNull() | (F.col("outer_n") * 100 < F.col("b.a") * contained_percent))

    # Two levels, so that a language with most of the phrases is ranked in parts: at most SALTS * top rows meet in one task.
    best_first = [F.col("b.score").desc(), F.col("b.a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*best_first)
    parts = kept.select("lang", "phrase", "b", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    parts = parts.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= top)
    order = Window.partitionBy("lang").orderBy(*best_first)
    ranked = parts.select("lang", "phrase", "b", F.row_number().over(order).cast("long").alias("rank")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "b.a", "b.l", "b.r", "n", "b.score")


#: DuckDB: every phrase of every piece is written out and counted.
ORACLE_SQL = f"""
WITH pieces AS MATERIALIZED (
  SELECT row_number() OVER () AS id, * FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
    FROM documents)
), places AS (
  SELECT id, lang, unnest(w) AS w1, unnest(range(len(w))) AS i
  FROM (SELECT id, lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces)
), triples AS MATERIALIZED (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM places WINDOW p AS (PARTITION BY id ORDER BY i)
), totals AS (
  SELECT lang, CAST(count(*) AS BIGINT) AS n FROM triples GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, w1, NULL AS w2, NULL AS w3, CAST(count(*) AS BIGINT) AS f
  FROM triples GROUP BY lang, w1 HAVING count(*) >= {MIN_COUNT}
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, w1, w2, NULL, CAST(count(*) AS BIGINT)
  FROM triples WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= {MIN_COUNT}
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, CAST(count(*) AS BIGINT)
  FROM triples WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= {MIN_COUNT}
), cuts AS (
  SELECT lang, phrase, f AS a, 1 AS cut, w1 AS lhs, w2 AS rhs FROM f WHERE k = 2
  UNION ALL SELECT lang, phrase, f, 1, w1, w2 || ' ' || w3 FROM f WHERE k = 3
  UNION ALL SELECT lang, phrase, f, 2, w1 || ' ' || w2, w3 FROM f WHERE k = 3
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r,
         CAST(({SCALE}::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lhs JOIN f r ON r.lang = c.lang AND r.phrase = c.rhs
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f WHERE k = 3
    UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f WHERE k = 3) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE o.f IS NULL OR 100 * o.f < {CONTAINED_PERCENT} * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= {TOP}
"""
