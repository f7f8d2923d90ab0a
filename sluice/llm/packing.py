"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents longer than a sequence are cut into full pieces and a rest. Only the *lengths* of pieces decide a packing,
and there are no more of them than tokens in a sequence. So the bins are planned on the histogram of lengths, as
patterns (so many pieces of each length) with a number of copies: work and memory on the driver are bounded by the
sequence length, not by the corpus. Pieces then find their place by their rank among the pieces of equal length.

A pattern is filled greedily with the longest pieces that fit. Where a gap stays, its smallest piece gives way to two
unpacked pieces that fill the widened gap more tightly (best two fit).
"""

from __future__ import annotations

import os
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, written

#: Words whose ids a Python worker remembers; beyond this it starts anew. Words encoded at once: their encodings take far more room than ids.
CACHE_WORDS, WORDS_AT_ONCE = 400_000, 4096
#: Texts encoded at once, in bytes.
PIECE_BYTES = 1 << 21
#: This kind of tokenizer always cuts between a Latin letter and one of these, so a blank may be put there: words then recur
#: more often. (Not before an apostrophe, which may begin a contraction.)
_AFTER_LETTER = np.isin(np.arange(256), np.frombuffer(b'.,;:!?%&*$#|)]}"', dtype=np.uint8))
_LETTER = np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of small letters that have no other form: such a word is never cut before its pairs of letters are merged.
_UNCUT = "^[a-z\u00e0-\u00f6\u00f8-\u00ff]+$"
#: Words written into one text to be encoded together.
WORDS_A_TEXT = 256
#: Texts with this may hold a special token, which neither lower-casing nor blanks may touch.
_SPECIAL = "<|"
#: Parts in which pieces of equal length are counted and ranked.
RANK_BLOCKS = 64


class Encoder:
    """Ids of whole texts. White space never is part of a token of this kind of tokenizer, so a text's ids are those of its
    words, and a word met before is not encoded again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and each thread would keep memory of its own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the tokens that end a word, for tokenizers that mark them
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        if suffix:
            self.ending[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.starts, self.lengths = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def _store(self, words: list[str], ids: np.ndarray, lengths: np.ndarray):
        n, total = len(self.known), len(ids)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(words) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        self.pool[self.used:self.used + total] = ids
        self.starts[n:n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n:n + len(words)] = lengths
        self.known.update(zip(words, range(n, n + len(words))))
        self.used += total

    def _learn(self, words: list[str]):
        uncut = pc.match_substring_regex(pa.array(words, pa.large_string()), _UNCUT).to_numpy(zero_copy_only=False)
        together = [w for w, x in zip(words, uncut) if x]
        apart = [w for w, x in zip(words, uncut) if not x]
        found = self._together(together) if self.ending.any() else None
        if found is None:
            together, apart, found = [], words, self._apart([])
        self._store(together + apart, *(np.concatenate(x) for x in zip(found, self._apart(apart))))

    def _codes(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of words, each encoded by itself."""
        ids = [e.ids for i in range(0, len(words), WORDS_AT_ONCE)
               for e in self.tokenizer.encode_batch_fast(words[i:i + WORDS_AT_ONCE], add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for uncut words, many written into one text and told apart by the tokens that end a word; None if they cannot be."""
        parts = [np.zeros(0, dtype=np.uint32)]
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i:i + WORDS_AT_ONCE]
            texts = [" ".join(some[j:j + WORDS_A_TEXT]) for j in range(0, len(some), WORDS_A_TEXT)]
            parts += [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(parts)
        ends = np.flatnonzero(self.ending[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) and (not len(ends) or ends[-1] == len(ids)) else None

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are ``ids[bounds[i]:bounds[i + 1]]``."""
        texts = texts.cast(pa.large_string()).fill_null("")
        plain = _spaced(texts)
        special = pc.match_substring(texts, _SPECIAL).to_pylist()
        if any(special):
            plain = pa.array([t if x else p for x, t, p in zip(special, texts.to_pylist(), plain.to_pylist())], pa.large_string())
        lists = pc.ascii_split_whitespace(plain)
        flat = lists.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        code = self._codes(distinct)
        new = np.flatnonzero(code < 0)
        if len(self.known) + len(new) > CACHE_WORDS and self.known:
            self.forget()
            code = self._codes(distinct)
            new = np.flatnonzero(code < 0)
        if len(new):
            words = [distinct[i] for i in new]
            self._learn(words)
            code[new] = self._codes(words)
        code = code[flat.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, dtype=np.int64)
        lengths = self.lengths[code]
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(self.starts[code] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return ids, np.concatenate([[0], ends])[words]


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts (large strings without nulls) with A-Z lower-cased and a blank between a letter and a mark that follows it."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return texts
    data = _LOWER[np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]]
    at = np.flatnonzero(_AFTER_LETTER[data[1:]] & _LETTER[data[:-1]]) + 1
    offsets = offsets - offsets[0]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets + np.searchsorted(at, offsets, side="left")),
                                            pa.py_buffer(np.insert(data, at, 32)))


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _rows_by_bytes(texts: pa.Array):
    """Row ranges of about ``PIECE_BYTES`` each; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PIECE_BYTES, side="right"))
        j = min(len(texts), max(i + 1, j))
        yield i, j
        i = j


def pieces_of(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, size: int, end_id: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every row; ids end with ``end_id``."""

    def run(batch):
        for a, b in _rows_by_bytes(batch.column(1)):
            ids, bounds = _encoder(tokenizer_path).encode(batch.column(1).slice(a, b - a))
            rows, piece, start, length, crc = [], [], [], [], []
            for i in range(b - a):
                own = np.append(ids[bounds[i]:bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                for p, s in enumerate(range(0, len(own), size)):
                    part = own[s:s + size]
                    rows.append(a + i), piece.append(p), start.append(s), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])
        pa.default_memory_pool().release_unused()

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")), run,
                  "id long, piece int, start long, length long, ids_crc32 long")


class _Lengths:
    """Counts of unpacked pieces by length, with the longest length still there at or below a bound."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.copy()
        self.size = len(counts) - 1
        self._index()

    def _index(self):
        at = np.where(self.counts > 0, np.arange(self.size + 1), 0)
        self.below = np.maximum.accumulate(at)

    def take(self, pattern: dict[int, int], copies: int):
        gone = False
        for length, m in pattern.items():
            self.counts[length] -= m * copies
            gone |= self.counts[length] == 0
        if gone:
            self._index()

    def longest(self, bound: int, used: dict[int, int]) -> int:
        """Longest length of at most ``bound`` with a piece that ``used`` leaves; 0 if there is none."""
        x = int(self.below[bound])
        while x and self.counts[x] <= used.get(x, 0):
            x = int(self.below[x - 1])
        return x

    def best_two(self, bound: int, more_than: int, used: dict[int, int]) -> tuple[int, int] | None:
        """Two pieces that together are longer than ``more_than`` and as long as fits into ``bound``."""
        left = self.counts[:bound + 1].copy()
        for length, m in used.items():
            if length <= bound:
                left[length] -= m
        a = np.flatnonzero(left > 0)
        a = a[a > 0]
        if not len(a):
            return None
        at = np.where(left > 0, np.arange(bound + 1), 0)
        at[0] = 0
        below = np.maximum.accumulate(at)
        b = below[bound - a]
        same = (b == a) & (left[a] < 2)
        b[same] = below[a[same] - 1]
        total = np.where(b > 0, a + b, 0)
        i = int(np.argmax(total))
        return (int(a[i]), int(b[i])) if total[i] > more_than else None


def plan(counts: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: pieces}, copies) that use up ``counts[length]`` pieces of every length."""
    left = _Lengths(counts)
    out = []
    while (seed := int(left.below[size])) > 0:
        used: dict[int, int] = {}
        gap = size
        while (x := left.longest(gap, used)) > 0:
            m = 1 if not used else max(1, min(gap // x, int(left.counts[x]) - used.get(x, 0)))
            used[x] = used.get(x, 0) + m
            gap -= m * x
        if gap and len(used) + max(used.values()) > 2:
            smallest = min(used)
            used[smallest] -= 1
            two = left.best_two(gap + smallest, smallest, used)
            if two is None:
                used[smallest] += 1
            else:
                for x in two:
                    used[x] = used.get(x, 0) + 1
            used = {x: m for x, m in used.items() if m}
        copies = min(int(left.counts[x]) // m for x, m in used.items())
        left.take(used, copies)
        out.append((used, copies))
        assert seed in used or seed
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 4096,
         end_id: int = 1) -> DataFrame:
    """Place all pieces of ``docs``: (id_col, piece, start, length, ids_crc32, sequence_id, offset).

    A document's ids are its text's, then ``end_id``; a null or empty text is ``end_id`` alone. Only documents of more than
    ``size`` ids are cut. Sequences are gapless from offset 0. Ties among pieces of equal length are broken by id, piece and
    checksum, and repeated rows get a place each. Further columns are ignored; an empty table gives an empty result.
    """
    found = written(pieces_of(docs, id_col, text_col, tokenizer_path, size, end_id)
                    .withColumn("block", F.pmod(F.xxhash64("id", "piece"), F.lit(RANK_BLOCKS)).cast("int")), "pieces")
    spark = found.sparkSession
    # at most size * RANK_BLOCKS rows, whatever the corpus
    tallies = found.groupBy("length", "block").agg(F.count("*").alias("c")).collect()
    table = np.zeros((size + 1, RANK_BLOCKS), dtype=np.int64)
    for r in tallies:
        table[r["length"], r["block"]] = r["c"]
    before = np.cumsum(table, axis=1) - table
    patterns = plan(table.sum(axis=1), size)

    # per length: which ranks go to which pattern. At most about size * log(size) rows, whatever the corpus
    slots: dict[int, list] = {}
    sequences, taken = 0, np.zeros(size + 1, dtype=np.int64)
    for used, copies in patterns:
        offset = 0
        for length, m in sorted(used.items(), reverse=True):
            slots.setdefault(length, []).append((int(taken[length]), m, sequences, offset))
            taken[length] += m * copies
            offset += m * length
        sequences += copies
    arrays = {x: np.array(v, dtype=np.int64) for x, v in slots.items()}
    shared = spark.sparkContext.broadcast((before, arrays))

    from pyspark.sql import Window

    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "block").orderBy("id", "piece", "ids_crc32")) - 1)

    def place(batch):
        before, arrays = shared.value
        length = batch.column(3).to_numpy()
        rank = batch.column(6).to_numpy() + before[length, batch.column(5).to_numpy()]
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            own = arrays[int(x)]
            i = np.searchsorted(own[:, 0], rank[at], side="right") - 1
            within = rank[at] - own[i, 0]
            sequence[at] = own[i, 2] + within // own[i, 1]
            offset[at] = own[i, 3] + within % own[i, 1] * x
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                                         [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return mapped(ranked.select("id", "piece", "start", "length", "ids_crc32", "block", F.col("rank").cast("long")), place,
                  f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
