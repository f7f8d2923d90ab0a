"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``window`` words (a shorter item is one window), and a window into its shingles. Full
containment of a window needs every one of its shingles, so the rarest one, by counts over all documents, is a
sufficient prefix. Documents give the positions of prefix shingles only (found through a bitmap of fixed size, then joined exactly
on the shingle). Length and position bounds drop windows that would not fit into the text there, and what is left is verified
word by word.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import apart, in_bitmap, key_bitmap, mapped, written

#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 3


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, n, text, shingles): every window of every item; shingle i is at word i."""

    def run(batch):
        rows = []
        for a, _, words in W.pieces(batch.column(1), W.LETTERS):
            for i, n in enumerate(words.counts):
                first = words.bounds[i]
                size = min(int(n), window)
                k = min(size, SHINGLE)
                hashes = words.shingles(k).view(np.int64) if size else []
                for s in range(first, first + n - size + 1) if size else ():
                    rows.append((batch.column(0)[a + i].as_py(), size, words.text(s, s + size), hashes[s:s + size - k + 1].tolist()))
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
                                          pa.array(cols[3], pa.list_(pa.int64()))], ["item", "n", "text", "shingles"])

    return mapped(items.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")), run,
                  "item string, n int, text string, shingles array<long>")


def _shingles(words: W.Words, k: int):
    """(text, word, hash) of the whole ``k``-word shingles."""
    hashes = words.shingles(k)
    doc = np.searchsorted(words.bounds, np.arange(len(hashes)), side="right") - 1
    at = np.arange(len(hashes)) - words.bounds[doc]
    keep = at + k <= words.counts[doc]
    return doc[keep], at[keep], hashes[keep]


def shingle_counts(docs: DataFrame, text_col: str, widths: list[int], bitmap: np.ndarray) -> DataFrame:
    """(key, c): how often shingles marked in ``bitmap`` occur in all texts."""
    marked = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch):
        for _, _, words in W.pieces(batch.column(0), W.LETTERS):
            for k in widths:
                _, _, hashes = _shingles(words, k)
                key, c = np.unique(hashes[in_bitmap(marked.value, hashes)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c.astype(np.int64))], ["key", "c"])

    return mapped(docs.select(F.col(text_col).cast("string").alias("t")), run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def candidates(docs: DataFrame, id_col: str, text_col: str, widths: list[int], bitmap: np.ndarray, window: int) -> DataFrame:
    """Per row (id, k, n_words, found): where prefix shingles are, with the words around each."""
    marked = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch):
        for a, b, words in W.pieces(batch.column(2), W.LETTERS):
            parts = []
            for k in widths:
                doc, at, hashes = _shingles(words, k)
                keep = in_bitmap(marked.value, hashes)
                parts.append(pd.DataFrame({"doc": doc[keep], "at": at[keep], "key": hashes[keep].view(np.int64)}))
            found = pd.concat(parts).sort_values(["doc", "at"], kind="stable")
            first = words.bounds[:-1][found["doc"]] if len(found) else np.zeros(0, dtype=np.int64)
            low = np.maximum(found["at"].to_numpy() - window + 1, 0)
            high = np.minimum(found["at"].to_numpy() + window, words.counts[found["doc"]] if len(found) else 0)
            around = [words.text(f + x, f + y) for f, x, y in zip(first, low, high)]
            ends = np.searchsorted(found["doc"].to_numpy(), np.arange(b - a + 1)).astype(np.int32)
            entry = pa.StructArray.from_arrays([pa.array(found["key"].to_numpy(), pa.int64()), pa.array(found["at"].to_numpy(), pa.int64()),
                                                pa.array(low, pa.int64()), pa.array(around, pa.string())], ["key", "at", "low", "around"])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words.counts, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends), entry)], ["id", "k", "n_words", "found"])

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k"),
                              F.col(text_col).cast("string").alias("t")), run,
                  "id long, k long, n_words long, found array<struct<key:long,at:long,low:long,around:string>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10) -> DataFrame:
    """(id, k, n_words, n_hit, items) for every row of ``docs``; ``k`` is the hash of its text.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items`` (sorted strings) are the items with such a
    window. Null or wordless texts have no words; null or wordless items have no windows, a null item id is left out
    of ``items`` though its windows hit. Repeated rows give equal rows; further columns are ignored; empty tables give no
    hits.
    """
    windows = written(item_windows(items, item_col, item_text_col, window), "windows")
    widths = sorted(r[0] for r in windows.select(F.least("n", F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    texts = windows.select("text", "n", "shingles").dropDuplicates(["text"])
    single = texts.select("text", "n", F.posexplode("shingles").alias("at", "key"))
    counts = shingle_counts(docs, text_col, widths, key_bitmap(single.select("key").distinct(), "key"))
    ranked = single.join(counts, "key", "left").groupBy("text", "n").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "key", "at")).alias("p"))
    prefixes = written(ranked.filter("p.c > 0").select("text", "n", F.col("p.key").alias("key"), F.col("p.at").alias("into")), "prefixes")

    base = written(candidates(docs, id_col, text_col, widths, key_bitmap(prefixes.select("key").distinct(), "key"), window), "candidates")
    found = base.select("id", "k", "n_words", F.explode("found").alias("f")).select("id", "k", "n_words", "f.*")
    start = F.col("at") - F.col("into")
    near = found.join(prefixes, "key").filter((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    hits = near.filter(F.array_join(F.slice(F.split("around", " "), (start - F.col("low") + 1).cast("int"), F.col("n")), " ") == F.col("text"))
    hits = written(hits.select("id", "k", start.alias("start"), (start + F.col("n")).alias("end"), "text").distinct(), "hits")

    spans = hits.groupBy("id", "k", "start").agg(F.max("end").alias("end"))
    before = F.max("end").over(Window.partitionBy("id", "k").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    words_hit = spans.withColumn("before", F.coalesce(before, F.lit(0))).groupBy("id", "k").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("n_hit"))
    named = hits.select("id", "k", "text").distinct().join(windows.select("text", "item").distinct(), "text")
    named = named.groupBy("id", "k").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_doc = words_hit.join(named, words_hit["id"].eqNullSafe(named["id"]) & (words_hit["k"] == named["k"])).select(
        words_hit["id"].alias("_id"), words_hit["k"].alias("_k"), "n_hit", "items")
    out = base.join(per_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    return out.select("id", "k", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without any hit, with their columns, whatever the names of further ones."""
    return apart(docs, [id_col, text_col], lambda d: _without_hits(d, items, id_col, text_col, **kw))


def _without_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, **kw) -> DataFrame:
    bad = contamination(docs, items, id_col, text_col, **kw).filter("n_hit > 0").select(F.col("id").alias("_id"), F.col("k").alias("_k")).distinct()
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (key == F.col("_k")), "left_anti")
