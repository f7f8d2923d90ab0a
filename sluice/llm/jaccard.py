"""Near-duplicate documents by n-gram Jaccard similarity: grouped prefix join.

Shingles are ordered by a rarity class counted over all documents, then by hash. Two sets that are similar enough
share a shingle among the first ``n - ceil(t n) + 1`` of each (the prefix). Documents of equal sets become one
class, classes of equal prefix and size one group; groups that share a prefix shingle are filtered by size and
position, expanded to their classes, and verified by the exact size of the intersection.

Before sets are moved, a pair is checked by signatures: the parities of the shingles that fall on each of ``SIGNATURE``
bits. Two sets differ in at least as many shingles as their signatures in bits, so the check drops no link.

Short lists of groups that share a shingle give all their pairs. Of a long list not all pairs are formed: each
round compares it with a few of its members (its pivots) only, and joins what is found to be linked; members
that are in one component already need no comparison. After a few rounds the pairs that are left, between
different components, are formed exactly. No link between different components is lost, and none is capped.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import BITMAP_BITS, in_bitmap, key_bitmap, mapped, written
from .components import components

#: Counters of the rarity sketch. Its size is fixed; on more data it only orders shingles less finely.
SKETCH = 1 << 22
_CHUNK = 1 << 14
#: Task sketches that one merge adds up.
_FAN = 256
#: Lists of more members are compared with pivots first; of shorter ones all pairs are formed at once.
LONG_LIST = 32
#: Rounds that compare each list with so many pivots before the pairs left are formed.
PIVOT_ROUNDS, PIVOTS = 2, 8
#: Lists that a member remembers, the first of its lists, to give a pair only in the first of them that both are in.
HEADS = 16
#: Bits of a set's signature, kept as 64-bit integers.
SIGNATURE = 512


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _set_hash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash for each set."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(W.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    return W.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """For each set, the parity of the number of its shingles on each bit."""
    n = len(bounds) - 1
    bit = np.repeat(np.arange(n) * SIGNATURE, np.diff(bounds)) + (hashes >> np.uint64(30) & np.uint64(SIGNATURE - 1)).astype(np.int64)
    odd = (np.bincount(bit, minlength=n * SIGNATURE) & 1).astype(np.uint8)
    ends = np.arange(n + 1, dtype=np.int32) * (SIGNATURE // 64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.packbits(odd).view(np.int64)))


def profile(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row (id, n, h): size and hash of its shingle set; and per task its shingle counts, in chunks. Chunks are compressed, as
    a task of few rows leaves most counters at zero."""

    def run(batches):
        counts, waiting, seen = np.zeros(SKETCH, dtype=np.uint32), [], 0

        def add():
            nonlocal waiting
            at, c = np.unique(np.concatenate(waiting), return_counts=True)
            counts[at] += c.astype(np.uint32)
            waiting = []

        task = np.random.SeedSequence().entropy & 0x7FFFFFFFFFFFFFFF
        for batch in batches:
            for a, b, words in W.pieces(batch.column(1), W.NOT_SPACE):
                hashes, bounds = W.shingle_sets(words, k)
                waiting.append((hashes & np.uint64(SKETCH - 1)).astype(np.uint32))
                seen += len(hashes)
                if sum(map(len, waiting)) > 1 << 19:
                    add()
                n = b - a
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, n), pa.array(np.diff(bounds)), pa.array(_signed(_set_hash(hashes, bounds))),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    ["id", "n", "h", "task", "chunk", "counts"])
        if seen:
            if waiting:
                add()
            for c in range(SKETCH // _CHUNK):
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                    pa.array([task], pa.int64()), pa.array([c], pa.int32()),
                    pa.array([zlib.compress(counts[c * _CHUNK:(c + 1) * _CHUNK].tobytes(), 1)], pa.binary())],
                    ["id", "n", "h", "task", "chunk", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, "id long, n long, h long, task long, chunk int, counts binary")


def _total(counts) -> np.ndarray:
    total = np.zeros(_CHUNK, dtype=np.uint64)
    for c in counts:
        total += np.frombuffer(zlib.decompress(c.as_py()), dtype=np.uint32)
    return np.minimum(total, 0xFFFFFFFF).astype(np.uint32)


def _added(key, table):
    """One chunk of the counts of some tasks."""
    counts = zlib.compress(_total(table["counts"]).tobytes(), 1)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([counts], pa.binary())})


def _classes(key, table):
    """The classes of one chunk, from the counts of the last tasks."""
    classes = np.rint(2 * np.log2(_total(table["counts"]) + 1.0)).astype(np.uint8)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int64()),
                     "counts": pa.array([classes.tobytes()], pa.binary())})


def rarity_classes(chunks: DataFrame) -> np.ndarray:
    """Class of every counter: about twice the binary logarithm of its count. ``SKETCH`` bytes on the driver. The last merge gives
    the classes, so that no task runs a second pass of Python behind a merge."""
    parts = chunks.select("chunk", "counts", "task")
    tasks = parts.select("task").distinct().count()
    while True:
        tasks = max(1, -(-tasks // _FAN))
        parts = parts.withColumn("task", F.pmod(F.xxhash64("task"), F.lit(tasks))).groupBy("chunk", "task").applyInArrow(
            _added if tasks > 1 else _classes, "chunk int, task long, counts binary")
        if tasks == 1:
            break
        parts = written(parts, "sketch")
    out = np.zeros(SKETCH, dtype=np.uint8)
    for r in parts.select("chunk", "counts").collect():
        out[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(bytes(r["counts"]), dtype=np.uint8)
    return out


def bitmap_bits(keys: int) -> int:
    """Bits of a bitmap of at most so many keys: 16 to 32 for each, up to ``BITMAP_BITS``."""
    return min(BITMAP_BITS, 1 << max(18, (16 * keys).bit_length()))


def _ordered(hashes, bounds, classes):
    """Shingles of every set by rarity class, then hash; with the set and the position of each."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, classes[(hashes & np.uint64(SKETCH - 1)).astype(np.int64)], doc))
    return hashes[order], doc, np.arange(len(doc)) - bounds[doc]


def _prefixes(words, k, classes, percent):
    hashes, bounds = W.shingle_sets(words, k)
    n = np.diff(bounds)
    length = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
    ordered, doc, position = _ordered(hashes, bounds, classes)
    keep = position < length[doc]
    starts = np.cumsum(length) - length
    return _set_hash(hashes, bounds), n, ordered[keep], doc[keep], position[keep], np.append(starts, length.sum()), (hashes, bounds)


def prefix_tokens(docs, id_col, text_col, k, classes, percent) -> DataFrame:
    """Every prefix shingle of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batch):
        for _, _, words in W.pieces(batch.column(1), W.NOT_SPACE):
            tokens = _prefixes(words, k, shared.value, percent)[2]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens))], ["token"])

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run, "token long")


def shared_prefixes(docs, id_col, text_col, k, classes, percent, bitmap) -> DataFrame:
    """Rows that have prefix shingles marked in ``bitmap``: (h, n, g, s, tokens, positions); g is the group, s the signature."""
    sc = docs.sparkSession.sparkContext
    shared, marked = sc.broadcast(classes), sc.broadcast(bitmap)

    def run(batch):
        for a, b, words in W.pieces(batch.column(1), W.NOT_SPACE):
            h, n, tokens, doc, position, bounds, sets = _prefixes(words, k, shared.value, percent)
            group = _set_hash(tokens, bounds) + W.mix(n.astype(np.uint64))
            keep = in_bitmap(marked.value, tokens)
            ends = np.searchsorted(doc[keep], np.arange(b - a + 1)).astype(np.int32)
            out = pa.RecordBatch.from_arrays([
                pa.array(_signed(h)), pa.array(n), pa.array(_signed(group)), _signatures(*sets),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(tokens[keep]))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(position[keep])),
            ], ["h", "n", "g", "s", "tokens", "positions"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run,
                  "h long, n long, g long, s array<long>, tokens array<long>, positions array<long>")


def class_sets(docs, id_col, text_col, k, bitmap, ids) -> DataFrame:
    """(h, shingles) of rows whose class is marked in ``bitmap`` and whose id in ``ids`` (or null); a class may come more than once."""
    sc = docs.sparkSession.sparkContext
    marked, chosen = sc.broadcast(bitmap), sc.broadcast(ids)

    def run(batch):
        own = batch.column(0)
        take = in_bitmap(chosen.value, own.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) | own.is_null().to_numpy(zero_copy_only=False)
        for a, b, words in W.pieces(batch.column(1).filter(pa.array(take)), W.NOT_SPACE):
            hashes, bounds = W.shingle_sets(words, k)
            h = _set_hash(hashes, bounds)
            first = np.zeros(len(h), dtype=bool)
            first[np.unique(h, return_index=True)[1]] = True
            keep = first & in_bitmap(marked.value, h) & (np.diff(bounds) > 0)
            if keep.any():
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(_signed(hashes)))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), lists], ["h", "shingles"]).filter(pa.array(keep))

    return mapped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run, "h long, shingles array<long>")


def _overlap_bound(percent: int, x: str, y: str):
    """100 * |x & y| >= percent * |x | y|, as a bound on the intersection."""
    return F.ceil(F.lit(percent) * (F.col(x) + F.col(y)) / F.lit(100 + percent))


def _alike(percent: int):
    """Signature filter on a pair; a group of several classes has no signature and passes."""
    apart = sum((F.bit_count(F.col("x_s")[i].bitwiseXOR(F.col("y_s")[i])) for i in range(SIGNATURE // 64)), F.lit(0))
    return F.coalesce(apart <= F.col("x_n") + F.col("y_n") - 2 * _overlap_bound(percent, "x_n", "y_n"), F.lit(True))


def _reach(percent: int):
    """Size and position filters on a pair of list members (columns with the prefixes x_ and y_)."""
    small, large = F.least("x_n", "y_n"), F.greatest("x_n", "y_n")
    most = F.least("x_p", "y_p") + F.least(F.col("x_n") - F.col("x_p"), F.col("y_n") - F.col("y_p"))
    return (100 * small >= percent * large) & (most >= _overlap_bound(percent, "x_n", "y_n"))


def _fits(percent: int):
    """Size, position and signature filters."""
    return _reach(percent) & _alike(percent)


def _member(side: str, *cols: str):
    return [F.col(c).alias(f"{side}_{c}") for c in cols]


def _pairs_with_pivot(lists: DataFrame, turn: int, percent: int):
    """Pairs of each list's pivots with the members of other components; and the lists without their pivots."""
    member = F.struct("g", "n", "p", "s", "label")
    pivots = lists.groupBy("list").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.array(*[F.min(F.struct(F.xxhash64("g", F.lit(turn * PIVOTS + i)).alias("r"), member.alias("v")))["v"] for i in range(PIVOTS)]).alias("v"))
    pivots = pivots.filter("lo <> hi").select("list", F.explode(F.array_distinct("v")).alias("v"))
    pairs = lists.join(pivots, "list").filter("g <> v.g and label <> v.label").select(
        *_member("x", "g", "n", "p", "s"), *[F.col(f"v.{c}").alias(f"y_{c}") for c in ("g", "n", "p", "s")])
    rest = lists.join(pivots.select("list").distinct(), "list").join(pivots.select("list", F.col("v.g").alias("g")), ["list", "g"], "left_anti")
    return pairs.filter(_fits(percent)).select("x_g", "y_g"), rest.select("list", "g", "n", "p", "s", "label")


def _pairs_of_short(lists: DataFrame, percent: int):
    """All pairs inside lists of at most ``LONG_LIST`` members that pass the size and position filters; ``shared`` is
    the number of these lists that both are in."""
    all_of = lists.groupBy("list").agg(F.collect_list(F.struct("g", "n", "p")).alias("all"))
    one = all_of.select(F.explode("all").alias("x"), "all")
    both = one.select("x", F.explode("all").alias("y")).filter("x.g < y.g")
    both = both.select(*[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in "gnp"])
    return both.groupBy("x_g", "y_g").agg(F.first("x_n").alias("x_n"), F.first("y_n").alias("y_n"), F.count("*").alias("shared"),
                                          F.max(_reach(percent)).alias("fits")).filter("fits")


def _enough_shared(pairs: DataFrame, long_of: DataFrame, percent: int):
    """Pairs whose prefixes can share enough. Of two prefixes, take the one that ends first in the order of shingles: what
    both sets share is in both prefixes or in the rest of that set, so prefixes share at least the wanted
    intersection less the longer rest. ``long_of`` (g, m) is the number of long lists of a group, which may all be shared."""
    x, y = (long_of.select(F.col("g").alias(f"{side}_g"), F.col("m").alias(f"{side}_m")) for side in "xy")
    pairs = pairs.join(x, "x_g", "left").join(y, "y_g", "left").na.fill(0, ["x_m", "y_m"])
    rest = F.greatest(*[F.ceil(F.col(n) * percent / 100) - 1 for n in ("x_n", "y_n")])
    return pairs.filter(F.col("shared") + F.least("x_m", "y_m") >= _overlap_bound(percent, "x_n", "y_n") - rest)


def _pairs_left(lists: DataFrame, percent: int):
    """All pairs of different components inside each list that pass the filters. Joined by list and a size band,
    as sizes that differ more cannot be similar. A band is a little wider than needed, against rounding. A pair
    that also meets in an earlier list is left to that one; what a filter drops there cannot be similar."""
    heads = lists.groupBy("g").agg(F.slice(F.sort_array(F.collect_list("list")), 1, HEADS).alias("heads"))
    lists = lists.join(heads, "g")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(1.0001 * np.log(100.01 / percent)))).cast("long")
    x = lists.select("list", *_member("x", "g", "n", "p", "s", "label", "heads"), F.explode(F.array(band, band + 1)).alias("band"))
    y = lists.select("list", *_member("y", "g", "n", "p", "s", "label", "heads"), band.alias("band"))
    same = x.join(y, ["list", "band"]).filter("x_label <> y_label and x_g <> y_g")
    first = F.array_min(F.array_intersect("x_heads", "y_heads"))
    return same.filter(_fits(percent)).filter(first.isNull() | (first >= F.col("list"))).select("x_g", "y_g")


def _marked(sets: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Sets of classes marked in ``bitmap``."""
    marked = sets.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch):
        keep = in_bitmap(marked.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        if keep.any():
            yield batch.filter(pa.array(keep))

    return mapped(sets, run, "h long, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, bits: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets are similar enough. Only sets of members of a pair are moved."""
    pairs = written(pairs, "pairs")
    needed = _marked(sets, key_bitmap(pairs.select(F.explode(F.array("a", "b")).alias("h")), "h", bits))
    a, b = needed.toDF("a", "sa"), needed.toDF("b", "sb")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"),
                                                  F.size("sa").alias("na"), F.size("sb").alias("nb"))
    return written(both.filter(F.col("i") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b").distinct(), "verified")


def _expanded(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of each pair of groups that pass the signature filter."""
    groups = pairs.select(F.least("x_g", "y_g").alias("x"), F.greatest("x_g", "y_g").alias("y")).distinct()
    both = (groups.join(members.select(F.col("g").alias("x"), *_member("x", "h", "n", "s")), "x")
            .join(members.select(F.col("g").alias("y"), *_member("y", "h", "n", "s")), "y"))
    return both.filter(_alike(percent)).select(F.col("x_h").alias("a"), F.col("y_h").alias("b"))


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    """Each pair once, the smaller class first."""
    return pairs.toDF("a", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85,
                    long_list: int = LONG_LIST) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of ``docs``.

    The set of a row is its distinct ``k``-word shingles (words of non-white-space, A-Z lower-cased); a text of fewer
    words is one shingle; a text without words, or null, is an empty set that is linked with nothing. Rows link
    when the Jaccard similarity is at least ``percent`` / 100, exactly. ``component_id`` is the smallest id
    that links reach. Rows of equal text (ties, repeated rows) link; a null id never is a component's id unless all its
    ids are null. Further columns are ignored; an empty table gives an empty result. Sets are told apart by a 64-bit hash.
    """
    base = written(profile(docs, id_col, text_col, k), "profile")
    rows = base.filter("chunk is null").select("id", "n", "h")
    classes = rarity_classes(base.filter("chunk is not null"))

    # prefix shingles that occur twice or more (by 40 of their bits; a clash only lets more through)
    often = (prefix_tokens(docs, id_col, text_col, k, classes, percent)
             .groupBy(F.col("token").bitwiseAND(F.lit((1 << 40) - 1)).alias("token")).agg(F.count("*").alias("c")).filter("c > 1"))
    size = rows.agg(F.count("*").alias("rows"), F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).alias("tokens")).first()
    bits = bitmap_bits(size["rows"])
    bitmap = key_bitmap(often, "token", bitmap_bits(int(size["tokens"] or 0) // 2))
    found = shared_prefixes(docs, id_col, text_col, k, classes, percent, bitmap)
    found = written(found.groupBy("h").agg(F.first(F.struct("n", "g", "s", "tokens", "positions")).alias("v")).select("h", "v.*"), "prefixes")

    members = found.select("g", "h", "n", "s")
    groups = found.groupBy("g").agg(F.min(F.struct("n", "tokens", "positions")).alias("v"), F.count("*").alias("c")).select("g", "v.*", "c")
    posts = groups.select("g", "n", F.explode(F.arrays_zip("tokens", "positions")).alias("e")).select(
        F.col("e.tokens").alias("list"), "g", "n", F.col("e.positions").alias("p"))
    many = posts.groupBy("list").agg(F.count("*").alias("c")).filter("c > 1")
    posts = written(posts.join(many, "list"), "posts")
    crowded = groups.select("g", "c").filter("c > 1")
    inner = written(found.select("g", "h", "n").join(crowded, "g").select(
        F.col("g").alias("list"), F.col("h").alias("g"), "n", F.lit(0).cast("long").alias("p"), "c"), "inner")

    # lists of few members: all their pairs; a pair is of classes from here on
    long_of = posts.filter(F.col("c") > long_list).groupBy("g").agg(F.count("*").alias("m"))
    short = _enough_shared(_pairs_of_short(posts.filter(F.col("c") <= long_list), percent), long_of, percent)
    short = _expanded(short, members, percent).union(
        _pairs_of_short(inner.filter(F.col("c") <= long_list), percent).select("x_g", "y_g"))
    short = written(_ordered_pairs(short), "pairs")
    lists, within = posts.filter(F.col("c") > long_list).drop("c"), inner.filter(F.col("c") > long_list).drop("c")
    own = written(members.join(lists.select("g").distinct(), "g", "left_semi"), "own")  # the classes of groups in long lists
    wanted = short.select(F.explode(F.array("a", "b")).alias("h")).union(within.select("g")).union(own.select("h")).distinct()
    wanted = written(rows.join(wanted, "h").groupBy("h").agg(F.min("id").alias("id")), "wanted")
    sets = written(class_sets(docs, id_col, text_col, k, key_bitmap(wanted, "h", bits), key_bitmap(wanted, "id", bits)), "sets")
    if sets.count() > 1.2 * wanted.count():  # bitmaps that are full let copies through
        sets = written(sets.dropDuplicates(["h"]), "sets")

    # members of long lists carry their signatures; a group of several classes has none
    alone = own.groupBy("g").agg(F.count("*").alias("c"), F.first("s").alias("s"))
    lists = written(lists.join(alone.select("g", F.when(F.col("c") == 1, F.col("s")).alias("s")), "g"), "lists")
    within = written(within.join(members.select(F.col("h").alias("g"), "s"), "g"), "inner")
    labels = written(components(_verified(short, sets, percent, bits)), "labels")
    for turn in range(PIVOT_ROUNDS + 1):
        some, some_inner = bool(lists.take(1)), bool(within.take(1))
        if not some and not some_inner:
            break
        pairs = []
        if some:
            marked = lists.join(written(_labels_of_groups(own, labels), "marks"), "g")
            if turn == PIVOT_ROUNDS:
                of_lists = _pairs_left(marked, percent)
            else:
                of_lists, lists = _pairs_with_pivot(marked, turn, percent)
            pairs.append(_expanded(of_lists, own, percent))
        if some_inner:
            inside = _labelled(within, labels)
            if turn == PIVOT_ROUNDS:
                inner_pairs = _pairs_left(inside, percent)
            else:
                inner_pairs, within = _pairs_with_pivot(inside, turn, percent)
            pairs.append(inner_pairs)
        new = _verified(_ordered_pairs(reduce(DataFrame.union, pairs)), sets, percent, bits)
        if new.take(1):  # a label stands for all links found before
            labels = written(components(new.union(labels.select("node", "label"))), "labels")
        if turn == PIVOT_ROUNDS:
            break
        if some:
            lists = written(lists.drop("label"), "lists")
        if some_inner:
            within = written(within.drop("label"), "inner")

    classes_of = rows.filter("n > 0").groupBy("h").agg(F.min("id").alias("least"))
    linked = classes_of.join(labels.withColumnRenamed("node", "h"), "h")
    smallest = linked.groupBy("label").agg(F.min("least").alias("component"))
    linked = linked.join(smallest, "label").select("h", "component")
    classes_of = classes_of.join(linked, "h", "left").select("h", F.coalesce("component", "least").alias("least"))
    out = rows.filter("n > 0").join(classes_of, "h", "left").select("id", "n", "least").union(
        rows.filter("n = 0").select("id", "n", "id"))
    return out.toDF(id_col, "n_shingles", "component_id")


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """List members with the component of each; ``g`` is a class."""
    return lists.join(labels.withColumnRenamed("node", "g"), "g", "left").withColumn("label", F.coalesce("label", "g"))


def _labels_of_groups(own: DataFrame, labels: DataFrame) -> DataFrame:
    """(g, label) of the groups that the classes ``own`` are in. Groups have equal labels only where all their classes are in one
    component; a group of several components has a label of its own, so it is compared with every other."""
    of = own.select("g", "h").join(labels.withColumnRenamed("node", "h"), "h", "left").withColumn("label", F.coalesce("label", "h"))
    return of.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).select(
        "g", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.xxhash64("g", F.lit("mixed"))).alias("label"))
