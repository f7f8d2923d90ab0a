"""Removal of repeated runs of lines, over all documents.

Every line is an id (a hash); a document is a sequence of ids. A suffix is a position in such a sequence. Names of
equal runs of 1, 2, 4, ... lines are built by prefix doubling: the name of a run of twice the length is made of the names of its
halves, and two overlapping names stand for a run of any length. Suffixes that share a run form an interval of the suffix
array (their longest common prefix is at least the run), found by grouping on that name; the order among intervals is
not needed, so names are hashes and no round needs a shuffle. An interval of two or more suffixes is a repeated
run. Runs are taken at the smallest depth that holds ``min_words`` words, from the left and from the right: each line of a longer
repeated run lies in such a run at its start or its end, so maximal runs are their unions. All but the
first occurrence are deleted. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, written

_BLANK = " \t\n\x0b\f\r"
#: A line break whose next line has a word. Blank lines thus stay with the line before them.
_BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def _units(text: Column) -> Column:
    """Lines with a word, each with the blank lines that follow it."""
    return F.split(text, _BREAK)


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, j, h, w): line ``j`` of a document, its id and its words. A document is (id, hash of the text)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    units = docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("k"), F.posexplode(_units(t)).alias("j", "u"))
    line = F.btrim("u", F.lit(_BLANK))
    return units.select("id", "k", "j", line.alias("line")).filter("line <> ''").select(
        "id", "k", "j", F.xxhash64("line").alias("h"), F.size(F.split("line", r"[\x20\x09-\x0D]+")).cast("long").alias("w"))


def _runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Runs of repeated lines at the depth of ``min_words``: (id, k, start, n, words, a, b); a and b name the run."""
    doc = Window.partitionBy("id", "k").orderBy("j")
    island = ["id", "k", "island"]
    rows = lines.withColumn("island", F.col("j") - F.row_number().over(doc))
    by_line = Window.partitionBy(*island).orderBy("j")
    rows = rows.withColumn("upto", F.sum("w").over(by_line)).withColumn("before", F.col("upto") - F.col("w"))
    levels = range(min_words.bit_length())
    rows = rows.withColumn("r0", F.col("h"))
    for i in levels[1:]:
        rows = rows.withColumn(f"r{i}", F.xxhash64(f"r{i - 1}", F.lead(f"r{i - 1}", 1 << (i - 1)).over(by_line), F.lit(i)))
    rows = rows.withColumns({f"q{i}": F.lag(f"r{i}", (1 << i) - 1).over(by_line) if i else F.col("r0") for i in levels})
    rows = rows.withColumns({"rs": F.array(*[f"r{i}" for i in levels]), "qs": F.array(*[f"q{i}" for i in levels])})
    rows = rows.select(*island, "j", "before", "upto", "rs", "qs")

    # from each line on, the fewest lines that hold min_words; and the fewest up to each line
    ahead = Window.partitionBy(*island).orderBy("before").rangeBetween(0, min_words - 1)
    back = Window.partitionBy(*island).orderBy("upto").rangeBetween(1 - min_words, 0)
    rows = rows.withColumn("on", F.struct(F.count("*").over(ahead).alias("n"), F.max("upto").over(ahead).alias("end"), F.last("qs").over(ahead).alias("qs")))
    rows = rows.withColumn("to", F.struct(F.count("*").over(back).alias("n"), F.min("before").over(back).alias("begin"), F.first("rs").over(back).alias("rs")))

    def level(n):
        return F.floor(F.log2(n.cast("double") + 0.5)).cast("int")

    left = rows.filter(F.col("on.end") - F.col("before") >= min_words).select(
        "id", "k", F.col("j").alias("start"), F.col("on.n").alias("n"), (F.col("on.end") - F.col("before")).alias("words"),
        F.get("rs", level(F.col("on.n"))).alias("a"), F.get(F.col("on.qs"), level(F.col("on.n"))).alias("b"))
    right = rows.filter(F.col("upto") - F.col("to.begin") >= min_words).select(
        "id", "k", (F.col("j") - F.col("to.n") + 1).alias("start"), F.col("to.n").alias("n"), (F.col("upto") - F.col("to.begin")).alias("words"),
        F.get(F.col("to.rs"), level(F.col("to.n"))).alias("a"), F.get("qs", level(F.col("to.n"))).alias("b"))
    return left.union(right)


def later_copies(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, k, dead): the lines of each document that lie in a later copy of a repeated run."""
    lines = written(line_table(docs, id_col, text_col), "lines")
    often = lines.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    runs = written(_runs(lines.join(often, "h").distinct(), min_words), "runs")
    key = ["n", "words", "a", "b"]
    place = F.struct("id", "start", "k")
    intervals = runs.groupBy(*key).agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").drop("last")
    late = runs.join(intervals, key).filter(place > F.col("first")).select("id", "k", "start", (F.col("start") + F.col("n")).alias("end"))
    late = late.groupBy("id", "k", "start").agg(F.max("end").alias("end"))
    covered = F.max("end").over(Window.partitionBy("id", "k").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    late = late.withColumn("start", F.greatest("start", F.coalesce(covered, F.col("start")))).filter("start < end")
    return late.groupBy("id", "k").agg(F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("end") - 1))).alias("dead"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with later copies of repeated line runs taken out of the text, and n_lines, n_removed (lines with a word).

    A run is deleted where the same lines, of at least ``min_words`` words together, occur before: at a smaller id, or
    earlier in the same text. Lines are compared without white space at their ends; blank lines go with the line before them. A
    text without repeats stays as it is; one of which nothing is left becomes empty; null stays null. A repeated row (same id, same text)
    is the same document, not a copy. A null id sorts first. Other columns stay, whatever their names; a new column whose name is taken gets
    an underscore.
    """
    return apart(docs, [id_col, text_col], lambda d: _without_copies(d, id_col, text_col, min_words))


def _without_copies(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    dead = later_copies(docs, id_col, text_col, min_words).withColumnsRenamed({"id": "_id", "k": "_k", "dead": "_dead"})
    t = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.join(dead, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(t) == F.col("_k")), "left").withColumn("_units", _units(t))
    left = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.size("_units").cast("bigint") - 1), F.col("_dead"))
    text = F.when(F.col("_dead").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_units"), i.cast("int"))), "\n"))
    return out.select(*[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns],
                      F.when(F.btrim(t, F.lit(_BLANK)) == "", 0).otherwise(F.size("_units")).cast("long").alias("n_lines"),
                      F.when(F.col("_dead").isNull(), 0).otherwise(F.size("_dead")).cast("long").alias("n_removed"))
