"""Spelling variants: words one edit apart, by an index of variable-length grams.

Every position of a word starts one gram. It begins with ``SHORT`` characters and grows while it is frequent, up to ``LONG`` characters (words
are padded at their end). Whether it grows depends on its own characters alone, so an edit changes only the grams that
span it. The largest number of grams that one edit of a word can span is the word's bound: two words one edit apart share
all other grams, so with all grams in one fixed order, rare ones first, the first ``bound + 1`` of both words have one in common
that the edit spares. That gram lies on one side of the edit, and on its other side the words are equal: the lists of the index are kept
by a gram together with all that comes before it, or with all that comes after it. Lists are merged by a join that
verifies each pair on the spot.

The dictionary of frequent grams has a fixed largest size, whatever the vocabulary.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, mapped, written

#: Lengths of grams, and how many grams of one length the dictionary may hold.
SHORT, LONG, DICTIONARY = 2, 5, 50_000
#: Pads a word's end.
PAD = "￿"


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6) -> DataFrame:
    """(id, run): every maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``min_length`` code points in whole texts, with A-Z
    lower-cased. Null texts have none."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    found = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    # lower() changes no other letter of a run without capitals beyond ASCII, and is the faster of the two
    lowered = F.when(F.col("run").rlike("[À-Þ]"), ascii_lower(F.col("run"))).otherwise(F.lower("run"))
    return found.select("id", lowered.alias("run"))


def with_slips(runs: DataFrame, one_in: int = 199) -> Column:
    """The run, or where ``one_in`` divides h = crc32 of ``<id>:<run>``, the run without its code point h % length (from 0). A null id counts as empty."""
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    slip = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return F.when(h % one_in == 0, slip).otherwise(F.col("run"))


def counted(words: DataFrame, least: int = 5, min_length: int = 6) -> DataFrame:
    """(word, n): distinct words of at least ``min_length`` code points that occur ``least`` times or more."""
    return (words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least))


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Counts of the frequent grams of ``SHORT`` to ``LONG`` characters. A gram is frequent if it starts at more than one in ``DICTIONARY`` of all
    positions, so there are fewer than ``DICTIONARY`` of each length, and that many at most reach the driver."""
    positions = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    padded = words.select(F.concat("word", F.lit(PAD * (LONG - 1))).alias("w"), F.char_length("word").alias("n"))
    out: dict[str, int] = {}
    for q in range(SHORT, LONG + 1):
        grams = padded.select(F.explode(F.expr(f"transform(sequence(1, n), p -> substring(w, p, {q}))")).alias("gram"))
        frequent = grams.groupBy("gram").agg(F.count("*").alias("c")).filter(F.col("c") > max(1, positions // DICTIONARY))
        out.update((r["gram"], r["c"]) for r in frequent.collect())
    return out


def gram_lengths(word: str, frequent: dict[str, int]) -> list[int]:
    """Length of the gram from each position on."""
    padded = word + PAD * (LONG - 1)
    out = []
    for p in range(len(word)):
        q = SHORT
        while q < LONG and padded[p:p + q] in frequent:
            q += 1
        out.append(q)
    return out


def affected(lengths: list[int]) -> int:
    """The largest number of grams that one edit can span. An insertion spans no more than a change beside it."""
    change = np.zeros(len(lengths) + max(lengths, default=0) + 1, dtype=np.int64)
    for p, q in enumerate(lengths):
        change[p] += 1
        change[p + q] -= 1
    return int(np.cumsum(change)[:len(lengths)].max(initial=0))


def index_keys(word: str, frequent: dict[str, int]) -> set[str]:
    """The lists that ``word`` is in: for each of its first grams, ``<`` and the word up to its end, and ``>`` and the word from it on.
    One edit may span all grams of a word of ``LONG`` characters or fewer, so that is also listed by ``*`` and what is left without one character."""
    lengths = gram_lengths(word, frequent)
    padded = word + PAD * (LONG - 1)
    order = sorted(range(len(word)), key=lambda p: (frequent.get(padded[p:p + lengths[p]], 0), padded[p:p + lengths[p]], p))
    out = set()
    for p in order[:affected(lengths) + 1]:
        out.add(">" + word[p:])
        if p + lengths[p] <= len(word):
            out.add("<" + word[:p + lengths[p]])
    if len(word) <= LONG:
        out.add("*" + word)
        out.update("*" + word[:i] + word[i + 1:] for i in range(len(word)))
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: all pairs of words of ``words`` (word, n; distinct) that differ by one inserted, deleted or replaced code point."""
    frequent = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))

    def run(batch):
        keys, rows = [], []
        for i, word in enumerate(batch.column(0).to_pylist()):
            own = index_keys(word, frequent.value)
            keys.extend(own)
            rows.extend([i] * len(own))
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column(0).take(at), batch.column(1).take(at)], ["key", "word", "n"])

    index = mapped(words.select("word", F.col("n").cast("long")), run, "key string, word string, n long")
    a = index.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = index.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = F.expr("levenshtein(a, b, 1) = 1")
    return a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & near).select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n; each word once, as ``counted`` gives them).

    ``n_near`` counts the words one edit away; ``form`` is the most frequent of them (of equals the first in code-point order) if it has
    ``ratio`` times the word's count, else null; ``root`` is where following forms from the word ends, the word itself without a form.
    Words of any length, the empty one too, find all their neighbours. Null words are left out; an empty table gives an
    empty result; further columns are ignored.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words: ratio is 2 or more")
    words = written(words.select("word", F.col("n").cast("long").alias("n")).filter("word is not null"), "words")
    pairs = written(near_pairs(words), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    # the smallest of (-count, word) is the most frequent, then first in code-point order
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("c"), "near")).alias("best"))
    fits = -F.col("best.c") >= F.lit(ratio) * F.col("n")
    found = written(
        words.join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.c")).alias("form_n")), "forms")

    # counts grow by ``ratio`` with every form, which bounds a chain; pointers double, so its logarithm bounds the rounds
    least, most = found.agg(F.min("n"), F.max("n")).first()
    steps = 1 + int(math.log(max(1, most / max(1, least)), ratio)) if most else 0
    root = found.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps))) if steps else 0):
        after = root.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        root = written(root.join(after, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return (found.join(root, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
