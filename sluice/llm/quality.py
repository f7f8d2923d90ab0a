"""Quality rules with thresholds that each language and source sets itself.

Fixed base rules drop texts that are too short or that mostly repeat themselves. Beyond these, a text is judged by ratios
(symbols, repeated words, repeated lines, word length). Each ratio has a quantile sketch per (language, source): counts of fixed
cells, which merge by addition over tasks and over groups. A text goes when a ratio lies far outside its group's own
distribution. Sketches of small groups are merged into their language's, and those into the whole corpus's.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, written

SPACE = r"[\x20\x09-\x0D]+"
#: Cells per unit of a ratio in a sketch.
CELLS = 1000
#: A group of fewer texts uses the sketch of the next larger group.
LEAST_TEXTS = 200
#: A text goes where a ratio is above the upper quartile by this many times the distance between median and upper quartile
#: (below the lower quartile likewise), and by an absolute margin as well, so that narrow distributions reject nothing.
REACH = 12
#: Ratios in thousandths: (name, numerator, denominator, margin, sides).
RATIOS = [
    ("symbols", "n_symbols", "n_words", 100, "high"),
    ("repeats", "n_repeat_words", "n_words", 300, "high"),
    ("duplicates", "n_dup_lines", "n_lines", 500, "high"),
    ("word_length", "word_chars", "n_words", 3000, "both"),
]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with word_chars, n_words, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words, base_failed."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    # Windows are 64-bit hashes of three words. Sorted with their position in the low bits, equal windows become neighbours;
    # the full hashes of neighbours are compared, and the union of the windows is measured.
    inner = ["_words", "_lines", "_n", "_windows", "_bits", "_sorted", "_at"]
    out = docs.withColumns({"_words": _words(t), "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumn("_n", F.size("_words"))
    w = F.col("_words")
    none = F.array().cast("array<bigint>")
    out = out.withColumn("_windows", F.when(F.col("_n") < 4, none).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    # low bits that hold a position
    out = out.withColumn("_bits", F.length(F.bin(F.size("_windows"))))
    out = out.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), none).otherwise(
        F.sort_array(F.expr("transform(_windows, (h, i) -> shiftleft(h, _bits) | i)"))))
    # positions of windows that equal a neighbour in sorted order
    out = out.withColumn("_at", F.sort_array(F.expr("""
        transform(filter(_sorted, (x, i) ->
            (shiftright(x, _bits) = shiftright(get(_sorted, i - 1), _bits)
             and get(_windows, int(x & (shiftleft(1L, _bits) - 1))) = get(_windows, int(get(_sorted, i - 1) & (shiftleft(1L, _bits) - 1))))
            or (shiftright(x, _bits) = shiftright(get(_sorted, i + 1), _bits)
             and get(_windows, int(x & (shiftleft(1L, _bits) - 1))) = get(_windows, int(get(_sorted, i + 1) & (shiftleft(1L, _bits) - 1))))),
          x -> x & (shiftleft(1L, _bits) - 1))""")))
    out = out.withColumns({
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr("""aggregate(_at, named_struct('end', -1L, 'sum', 0L),
            (s, x) -> named_struct('end', x + 2, 'sum', s.sum + least(3L, x + 2 - s.end)), s -> s.sum)"""),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.drop(*inner)


def _cell(over: str, under: str) -> Column:
    return F.expr(f"CASE WHEN {under} > 0 THEN ({over} * {CELLS}) div {under} ELSE 0 END")


def sketches(measures: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, cell, c): how many texts that pass the base rules have a ratio in a cell."""
    rows = measures.filter(~F.col("base_failed")).select(*keys, F.explode(F.array(*[
        F.struct(F.lit(name).alias("ratio"), _cell(over, under).alias("cell")) for name, over, under, _, _ in RATIOS])).alias("v"))
    return rows.groupBy(*keys, "v.ratio", "v.cell").agg(F.count("*").alias("c"))


def _bounds(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, n, low, high): the range that texts of a group keep to, from its merged cells."""
    group = Window.partitionBy(*keys, "ratio")
    ranked = cells.withColumns({"n": F.sum("c").over(group), "upto": F.sum("c").over(group.orderBy("cell"))})
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("n") * q, F.col("cell"))).alias(f"q{q}") for q in (1, 2, 3)]
    out = ranked.groupBy(*keys, "ratio").agg(F.max("n").alias("n"), *quartile)
    margin = F.create_map(*[x for name, *_, m, _ in RATIOS for x in (F.lit(name), F.lit(m))])
    return out.select(*keys, "ratio", "n",
                      (F.col("q1") - F.greatest(REACH * (F.col("q2") - F.col("q1")), margin[F.col("ratio")])).alias("low"),
                      (F.col("q3") + F.greatest(REACH * (F.col("q3") - F.col("q2")), margin[F.col("ratio")])).alias("high"))


def thresholds(measures: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per (language, source): the bounds of every ratio, from the smallest group that has enough texts."""
    named = measures.select(F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), "base_failed",
                            *dict.fromkeys(x for _, over, under, _, _ in RATIOS for x in (over, under)))
    fine = written(sketches(named, ["_lang", "_source"]), "cells")
    own = _bounds(fine, ["_lang", "_source"])
    merged = fine.groupBy("_lang", "ratio", "cell").agg(F.sum("c").alias("c"))
    lang = _bounds(merged, ["_lang"]).withColumnsRenamed({"n": "n2", "low": "low2", "high": "high2", "_lang": "_lang2", "ratio": "ratio2"})
    whole = _bounds(merged.groupBy("ratio", "cell").agg(F.sum("c").alias("c")), []).withColumnsRenamed(
        {"low": "low3", "high": "high3", "ratio": "ratio3"}).drop("n")
    both = (own.join(lang, F.col("_lang").eqNullSafe(F.col("_lang2")) & (F.col("ratio") == F.col("ratio2")))
            .join(whole, F.col("ratio") == F.col("ratio3")))

    def pick(name):
        return F.when(F.col("n") >= LEAST_TEXTS, F.col(name)).when(F.col("n2") >= LEAST_TEXTS, F.col(f"{name}2")).otherwise(F.col(f"{name}3"))

    def bound(ratio, name):
        return F.max(F.when(F.col("ratio") == ratio, pick(name))).alias(f"_{ratio}_{name}")

    return both.groupBy("_lang", "_source").agg(
        *[bound(r, "high") for r, *_ in RATIOS], *[bound(r, "low") for r, *_, sides in RATIOS if sides == "both"])


def judged(measures: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``measures`` (see ``measured``; a written table) with ``kept``.

    A text without words fails the base rules. A null language or source is a group like any other. Rows never are
    dropped here, extra columns stay, and an empty table gives an empty result."""
    limits = thresholds(measures, lang_col, source_col)
    inside = F.lit(True)
    for name, over, under, _, sides in RATIOS:
        inside = inside & (_cell(over, under) <= F.col(f"_{name}_high"))
        if sides == "both":
            inside = inside & (_cell(over, under) >= F.col(f"_{name}_low"))
    out = measures.join(limits, F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source")), "left")
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    return out.select(*measures.columns, "kept")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """Measures and verdict of every row, without the texts."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(text_col).alias("text"))
    return judged(written(measured(slim).drop("text"), "measures"))


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, whatever the names of further ones."""
    return apart(docs, [text_col, lang_col, source_col], lambda d: judged(
        written(measured(d, text_col), "measures"), lang_col, source_col).filter("kept").select(*d.columns))
