"""Phrases whose words attract each other, counted inside the distinct chunks of a prefix-free parsing.

A text is a sequence of words with a border wherever a piece ends, and ends in ``max_words - 1`` borders. A chunk ends where the hash of a
window of ``max_words - 1`` tokens is a multiple of ``EVERY``, and the next one begins with that window: chunks overlap by it, equal
passages have equal chunks, and every phrase lies within the chunk that its first word belongs to, the overlap belonging to
the later chunk. So phrases are counted once per distinct chunk, with the chunk's frequency as weight.

Words are counted by their text and get codes that no two of them share, so phrases are counted exactly by the codes of their words, in one pass for each
length, and only the frequent ones get their texts back, by joins with the words. A phrase can only be frequent if all its words and both its
parts without the last and without the first word are; those parts are looked up in a bitmap, which lets through a superset.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import in_bitmap, key_bitmap, mapped, written

#: One in so many windows ends a chunk; a chunk without any ends after ``LONGEST`` tokens.
EVERY, LONGEST = 64, 4096
#: Partial counts that a task holds before it hands them on.
HELD_KEYS, HELD_TEXTS = 4_000_000, 1_000_000
#: Up to so many frequent words, codes are places in the list of their keys (64 MiB at most); beyond, a word's code is its key, which takes more room.
LISTED_WORDS = 1 << 23
#: Bits of a word's hash that make its key. Words that share one get other keys.
KEY_BITS = 64
#: Parts into which the phrases of a language are dealt for the first ranking.
RANK_PARTS = 64

#: Bytes that end a piece, and bytes of words: neither those nor blanks.
_BORDER = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8))
_WORD = ~_BORDER
_WORD[[0x20, 0x09]] = False
#: In a chunk, tokens are joined by a space, but by a tab before the overlap, and a border is a line break.
_SPACE, _TAB, _LINE = 0x20, 0x09, 0x0A
_FOLD_LOW, _FOLD_STEP = (1 << 31) - 1, 0x9E3779B1  # products stay below 2^63
_LINE_HASH, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_IN_CHUNK = ~np.isin(np.arange(256), [_SPACE, _TAB, _LINE])


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these lengths, one after the other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _chunks(words: W.Words, overlap: int) -> tuple[np.ndarray, pa.Array]:
    """(text, chunk) of every chunk of the texts."""
    full = np.flatnonzero(words.counts)
    if not len(full):
        return full, pa.array([], pa.large_string())
    n = len(words.starts)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    first = words.bounds[full]
    seen = np.concatenate([[0], np.cumsum(_BORDER[words.buf])])
    lead = np.zeros(n, dtype=np.int64)
    lead[1:] = seen[words.starts[1:]] > seen[words.ends[:-1]]
    lead[first] = 0
    # tokens: each word after its border, if it has one, and the borders at the end of every text
    nth = np.cumsum(words.counts > 0)[text] - 1
    at = np.arange(n) + np.cumsum(lead) + nth * overlap
    total = int(at[-1]) + 1 + overlap
    hashes = np.full(total, _LINE_HASH)
    hashes[at] = words.hashes
    starts, lengths = np.full(total, len(words.buf), dtype=np.int64), np.ones(total, dtype=np.int64)
    starts[at], lengths[at] = words.starts, words.ends - words.starts
    places = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int(places[-1] + lengths[-1] + 1), _SPACE, dtype=np.uint8)
    joined[_ragged(places, lengths)] = np.append(words.buf, np.uint8(_LINE))[_ragged(starts, lengths)]

    begin = at[first]
    end = np.append(begin[1:], total)
    window = np.zeros(total - overlap + 1, dtype=np.uint64)
    for j in range(overlap):
        window = (window + hashes[j:j + len(window)]) * _STEP
    cut = np.zeros(total, dtype=bool)
    cut[:len(window)] = W.mix(window) % np.uint64(EVERY) == 0
    for j in range(overlap):
        cut[end - 1 - j] = False
    cut[begin] = True
    cuts = np.flatnonzero(cut)
    own = np.searchsorted(begin, cuts, side="right") - 1
    last = np.append(cuts[1:], total)  # the end of what a chunk owns
    last = np.where(np.append(own[1:] != own[:-1], True), end[own] - overlap, last)
    parts = -(-(last - cuts) // LONGEST)
    if (parts > 1).any():
        step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        own, cuts, last = (np.repeat(x, parts) for x in (own, cuts, last))
        cuts = cuts + step * LONGEST
        last = np.minimum(cuts + LONGEST, last)
    stop = last + overlap - 1
    sizes = places[stop] + lengths[stop] - places[cuts]
    data = joined[_ragged(places[cuts], sizes)]
    data[np.cumsum(sizes) - sizes + places[last] - 1 - places[cuts]] = _TAB
    return full[own], _strings(data, sizes)


def parse(docs: DataFrame, lang_col: str, text_col: str, max_words: int) -> DataFrame:
    """(lang, chunk, c): the distinct chunks of all texts, and how often each occurs."""

    def run(batch):
        for a, _, words in W.pieces(batch.column(1), _WORD):
            text, chunk = _chunks(words, max_words - 1)
            if len(text):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + text)), chunk.cast(pa.string())], ["lang", "chunk"])

    found = mapped(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("l"), F.col(text_col).cast("string").alias("t")),
                   run, "lang string, chunk string")
    return found.groupBy("lang", "chunk").agg(F.count("*").alias("c"))


class _Chunks:
    """The words of some chunks, and which phrases they begin."""

    def __init__(self, words: W.Words, langs: pa.Array, counts: np.ndarray):
        self.words = words
        self.text = np.repeat(np.arange(len(words.counts)), words.counts)
        self.lines = np.cumsum(words.raw == _LINE)[words.starts]
        self.owned = np.cumsum(words.raw == _TAB)[words.starts] == self.text  # each chunk has one tab, before its overlap
        self.counts = counts[self.text]
        langs = langs.dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)[self.text]
        self.lang_keys = np.array([_text_key(x) for x in self.langs.to_pylist()], dtype=np.uint64)

    def whole(self, k: int) -> np.ndarray:
        """Words from which ``k`` words follow each other without a border."""
        out = np.zeros(len(self.text), dtype=bool)
        if len(out) >= k:
            a, b = slice(0, len(out) - k + 1), slice(k - 1, len(out))
            out[a] = (self.text[a] == self.text[b]) & (self.lines[a] == self.lines[b])
        return out

    def keys(self, bits: int, clashes: list[np.ndarray]) -> np.ndarray:
        """Hash of language and word for every word, and for those in the first list of ``clashes`` another one, and so on."""
        out = W.mix(self.words.shingles(1) ^ self.lang_keys[self.lang]) >> np.uint64(64 - bits)
        for salt, shared in enumerate(clashes):
            at = np.flatnonzero(np.isin(out, shared))
            for i, word in zip(at, self.texts(at).to_pylist()):
                out[i] = _text_key(f"{salt} {word} {self.langs[self.lang[i]].as_py()}")
        return out

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words ``at``."""
        lengths = self.words.ends[at] - self.words.starts[at]
        return _strings(self.words.raw[_ragged(self.words.starts[at], lengths)], lengths).cast(pa.string())


def _text_key(text: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little"))


def _each(batches):
    """The chunks of a task, some at a time."""
    for batch in batches:
        counts = batch.column(2).to_numpy()
        for a, b, words in W.pieces(batch.column(1), _IN_CHUNK):
            if len(words.starts):
                yield _Chunks(words, batch.column(0).slice(a, b - a), counts[a:b])


def _summed(tables: list[pa.Table], by: list[str]) -> pa.Table:
    return pa.concat_tables(tables).group_by(by).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def _in_order(table: pa.Table):
    """Batches sorted by text, as neighbours that begin alike take less room in a shuffle."""
    return table.sort_by([("lang", "ascending"), ("phrase", "ascending")]).combine_chunks().to_batches(max_chunksize=100_000)


def _texts_tallied(tables, by: list[str]):
    """Partial sums of ``n``, held up to a number of rows."""
    held, rows = [], 0
    for t in tables:
        held.append(t)
        rows += t.num_rows
        if rows > HELD_TEXTS:
            held = [_summed(held, by)]
            rows = held[0].num_rows
            if rows > HELD_TEXTS // 2:
                yield from _in_order(held[0])
                held, rows = [], 0
    if held:
        yield from _in_order(_summed(held, by))


def _keys_tallied(tallies, names: list[str]):
    """The same for arrays, of which the last are counts and the others together a key."""

    def summed():
        *keys, counts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        keys, counts = [x[order] for x in keys], counts[order]
        first = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in keys], axis=0)))
        return [*(x[first] for x in keys), np.add.reduceat(counts, first)]

    def rows(columns):
        for i in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in columns], names)

    held, n = [], 0
    for columns in tallies:
        if not len(columns[0]):
            continue
        held.append(columns)
        n += len(columns[0])
        if n > HELD_KEYS:
            held = [summed()]
            n = len(held[0][0])
            if n > HELD_KEYS // 2:
                yield from rows(held[0])
                held, n = [], 0
    if held:
        yield from rows(summed())


def word_counts(chunks: DataFrame, bits: int = 64, clashes: list[np.ndarray] = ()) -> DataFrame:
    """(lang, phrase, key, n) of every word of every language."""

    def one(c: _Chunks) -> pa.Table:
        at = np.flatnonzero(c.owned)
        return pa.table({"lang": c.langs.take(pa.array(c.lang[at])), "phrase": c.texts(at), "key": c.keys(bits, clashes)[at].view(np.int64), "n": c.counts[at]})

    def run(batches):
        yield from _texts_tallied((one(c) for c in _each(batches)), ["lang", "phrase", "key"])

    return (chunks.select("lang", "chunk", "c").mapInArrow(run, "lang string, phrase string, key long, n long")
            .groupBy("lang", "phrase", "key").agg(F.sum("n").alias("n")))


def keyed_words(chunks: DataFrame, bits: int) -> tuple[DataFrame, list[np.ndarray]]:
    """``word_counts`` with a key of its own for every word, and the keys that words would share without another hash."""
    clashes: list[np.ndarray] = []
    while True:
        words = written(word_counts(chunks, bits, clashes), "words", compression="zstd")
        shared = words.groupBy("key").count().filter("count > 1").select("key").toArrow()
        if not shared.num_rows:
            return words, clashes
        clashes = [*clashes, shared["key"].to_numpy().view(np.uint64)]


class _Codes:
    """Codes of the frequent words, and how those of a phrase are packed into columns of 64 bits."""

    def __init__(self, bits: int, clashes: list[np.ndarray], listed: np.ndarray | None, bitmap: np.ndarray | None):
        self.bits, self.clashes, self.listed, self.bitmap = bits, clashes, listed, bitmap
        self.width = 64 if listed is None else max(1, len(listed).bit_length())
        self.in_one = max(1, 63 // self.width)

    def of_keys(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, may it be frequent) of words with these keys."""
        if self.listed is None:
            return keys.view(np.int64), in_bitmap(self.bitmap, keys)
        if not len(self.listed):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.listed, keys), len(self.listed) - 1)
        return at, self.listed[at] == keys

    def names(self, k: int) -> list[str]:
        return [f"key{i}" for i in range(-(-k // self.in_one))]

    def packed(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(codes), self.in_one):
            out.append(codes[i])
            for x in codes[i + 1:i + self.in_one]:
                out[-1] = (out[-1] << self.width) | x
        return out

    def unpacked(self, k: int) -> list[Column]:
        """The codes of ``k`` words from the columns that ``names`` tells."""
        if self.in_one == 1:
            return [F.col(x) for x in self.names(k)]
        return [F.shiftright(F.col(f"key{i // self.in_one}"), self.width * (min(k - i // self.in_one * self.in_one, self.in_one) - 1 - i % self.in_one))
                .bitwiseAND(F.lit((1 << self.width) - 1)) for i in range(k)]


def _coded(words: DataFrame, codes: _Codes) -> DataFrame:
    """(lang, phrase, code) of frequent words."""
    shared = words.sparkSession.sparkContext.broadcast(codes)

    def run(batch):
        code, _ = shared.value.of_keys(batch.column(2).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code)], ["lang", "phrase", "code"])

    return mapped(words.select("lang", "phrase", "key"), run, "lang string, phrase string, code long")


def _folded(codes, low, step):
    """One number from several codes, of numpy arrays or columns alike: phrases that share it only pass the same bitmap."""
    out = codes[0]
    for x in codes[1:]:
        out = low(out) * step + low(x)
    return out


def phrase_counts(chunks: DataFrame, k: int, codes: _Codes, parts: np.ndarray | None) -> DataFrame:
    """(codes of the words, n) of the phrases of ``k`` words that have frequent words, and parts of ``k - 1`` words in the bitmap ``parts``."""
    shared, names = chunks.sparkSession.sparkContext.broadcast((codes, parts)), codes.names(k)

    def one(c: _Chunks):
        codes, parts = shared.value
        code, frequent = codes.of_keys(c.keys(codes.bits, codes.clashes))
        mask = c.whole(k) & c.owned
        at = np.flatnonzero(mask)
        for j in range(k):
            at = at[frequent[at + j]]
        if parts is not None:
            for j in range(2):
                part = _folded([code[at + j + i] for i in range(k - 1)], lambda x: x & _FOLD_LOW, _FOLD_STEP)
                at = at[in_bitmap(parts, part.view(np.uint64))]
        return [*codes.packed([code[at + j] for j in range(k)]), c.counts[at]]

    def run(batches):
        yield from _keys_tallied((one(c) for c in _each(batches)), [*names, "n"])

    counted = chunks.select("lang", "chunk", "c").mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n"))
    return counted.select(*[x.alias(f"code{i}") for i, x in enumerate(codes.unpacked(k))], "n")


def with_texts(phrases: DataFrame, k: int, words: DataFrame) -> DataFrame:
    """(lang, phrase, n, words) of phrases of ``k`` words, given (lang, phrase, code) of the words."""
    for i in range(k):
        phrases = phrases.join(words.select(F.col("code").alias(f"code{i}"), F.col("phrase").alias(f"word{i}"), *(["lang"] if i == 0 else [])), f"code{i}")
    return phrases.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(k)]).alias("phrase"), "n", F.lit(k).alias("words"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, least: int = 10, share: int = 50,
                 top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``max_words`` words by score.

    Texts are lower-cased (A-Z) and cut at ``. , ; : ! ?`` and line breaks into pieces, and these at blanks into words; a null text has none, and a null
    language is ``und``. ``a`` counts all occurrences of the phrase within pieces, ``n`` all words of the language. Of the cuts of a phrase
    into a first part (``l`` occurrences) and a rest (``r``), the one of the lowest floor(1000000 a a / (l r)) counts, of equals the
    first; the arithmetic is exact up to 10^15 words. Phrases of fewer than ``least`` occurrences are no candidates; a candidate
    within a longer one that has ``share`` percent of its occurrences or more is dropped. Ties of scores go by ``a``, then by the phrase's bytes.
    Texts of any length are read whole; repeated rows count repeatedly; further columns are ignored; an empty table gives an empty result.
    """
    if max_words < 2 or least < 1:
        raise ValueError("phrases have two words or more, and candidates one occurrence or more")
    chunks = written(parse(docs, lang_col, text_col, max_words), "chunks", compression="zstd")
    words, clashes = keyed_words(chunks, KEY_BITS)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    total, n_frequent = words.agg(F.sum("n"), F.count_if(F.col("n") >= least)).first()
    # bitmaps of at most 64 MiB, sized by the largest number of phrases that can be frequent
    bits = 1 << min(29, max(20, (4 * (total or 0) // least).bit_length()))
    frequent = words.filter(F.col("n") >= least)
    listed = np.sort(frequent.select("key").toArrow()["key"].to_numpy().view(np.uint64)) if n_frequent <= LISTED_WORDS else None
    codes = _Codes(KEY_BITS, clashes, listed, key_bitmap(frequent, "key", bits) if listed is None else None)
    coded = written(_coded(frequent, codes), "codes", compression="zstd")
    found, parts = [], None
    for k in range(2, max_words + 1):
        phrases = written(phrase_counts(chunks, k, codes, parts).filter(F.col("n") >= least), f"phrases{k}", compression="zstd")
        found.append(with_texts(phrases, k, coded))
        if k < max_words:
            parts = key_bitmap(phrases, _folded([F.col(f"code{i}") for i in range(k)], lambda x: x.bitwiseAND(F.lit(_FOLD_LOW)), F.lit(_FOLD_STEP)), bits)
    found = written(reduce(DataFrame.union, found), "phrases")

    counts = words.filter(F.col("n") >= least).select("lang", "phrase", "n").union(found.select("lang", "phrase", "n"))
    part_of, k = F.split("phrase", " "), F.col("k")
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    score = F.expr("cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * cast(1000000 as decimal(7, 0))"
                   " div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))")
    scored = (
        found.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
        .withColumn("left", F.array_join(F.slice(part_of, F.lit(1), k), " ")).join(left, ["lang", "left"])
        .withColumn("right", F.array_join(F.slice(part_of, k + 1, F.size(part_of)), " ")).join(right, ["lang", "right"])
        .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
    )

    longer = found.filter("words > 2").select("lang", "words", "n", part_of.alias("w"))
    inner = longer.select("lang", "n", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), q -> transform(sequence(1, words - q + 1), i -> array_join(slice(w, i, q), ' '))))")).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = scored.join(covered, ["lang", "phrase"], "left").filter(F.expr(f"longer is null or 100 * longer < {int(share)} * a"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    near = flat.withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("nth") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
