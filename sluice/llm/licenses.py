"""License notices in texts, by MinHash bands over overlapping windows and exact containment.

Templates and texts are cut into 5-word shingles. Short templates are looked for by windows of one shingle, long ones by windows of
``WINDOW`` shingles every ``STEP`` shingles; templates give a window at every shingle. A window's signature is the least of its shingles under
each of ``BANDS`` hashes, each a band of its own: a window that shares four fifths of its shingles with a template's collides with a probability of
1 - 0.2 ** BANDS, and an equal one always. Retrieved templates are verified by the share of their shingles that the text around the window
holds. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SHINGLE, WINDOW, STEP, BANDS = 5, 12, 6, 3
#: Templates of fewer shingles are looked for by single shingles.
LONG_TEMPLATE = WINDOW + STEP

# Notices of public licences.
TEMPLATES = {
    "apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0 line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "mit line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
           "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
           "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                  "License. You may obtain a copy of the License at",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
               "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met",
}


def _shingles(text: Column) -> Column:
    """Hashes of the 5-word shingles; words are lower-cased runs of letters and digits."""
    words = F.split(F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    # bound as a variable: an expression inside a lambda would be evaluated for every element
    return F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) < SHINGLE, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + j if j else i) for j in range(SHINGLE)])))), F.lit(0))


def _bands(starts: Column) -> Column:
    """Band keys of the windows from the given shingles on, as (at, key)."""
    def keys(at):
        own = F.slice(F.col("h"), at + 1, WINDOW)
        return F.array(*[F.struct(at.alias("at"), F.xxhash64(F.lit(b), F.array_min(F.transform(own, lambda x: F.xxhash64(x, F.lit(b))))).alias("key"))
                         for b in range(BANDS)])
    return F.flatten(F.transform(starts, keys))


def _single() -> Column:
    return F.transform(F.col("h"), lambda x, i: F.struct(i.alias("at"), x.alias("key")))


def _starts(step: int) -> Column:
    last = F.greatest(F.size("h") - WINDOW, F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(step))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, k, license, percent) for every template that a text holds: the share of its shingles, in percent, near one of its windows.

    ``k`` is the hash of the text. Null, empty and short texts hold nothing; a template of fewer than five words is an error. Repeated rows
    give one row; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    given = spark.createDataFrame(list((TEMPLATES if templates is None else templates).items()), "license string, text string")
    given = written(given.select("license", F.array_distinct(_shingles(F.col("text"))).alias("own"), _shingles(F.col("text")).alias("h")), "templates")
    if given.filter(F.size("own") == 0).take(1):
        raise ValueError(f"a template needs {SHINGLE} words or more")
    is_long = F.size("h") >= LONG_TEMPLATE
    keyed = given.filter(~is_long).select("license", "own", F.explode(_single()).alias("w")).union(
        given.filter(is_long).select("license", "own", F.explode(_bands(_starts(1))).alias("w")))
    keyed = keyed.select("license", "own", F.col("w.key").alias("key")).distinct()

    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k"), _shingles(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    windows = texts.filter(F.size("h") > 0).select("id", "k", F.explode(F.concat(_single(), _bands(_starts(STEP)))).alias("w"))
    hits = written(windows.select("id", "k", "w.at", "w.key").join(keyed, "key").select("id", "k", "at", "license").distinct(), "hits")
    # only the texts with a hit are read again; around the hit, the shingles are compared exactly
    some = hits.select(F.col("id").alias("_id"), F.col("k").alias("_k")).distinct()
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    again = docs.join(some, F.col(id_col).eqNullSafe(F.col("_id")) & (key == F.col("_k")), "left_semi")
    again = again.select(F.col(id_col).alias("_id"), key.alias("_k"), _shingles(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    near = hits.join(given.select("license", "own"), "license").join(again, F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")))
    reach = F.size("own") * 2 + WINDOW
    around = F.slice("h", F.greatest(F.col("at") - reach, F.lit(0)) + 1, 2 * reach + 1)
    share = F.floor(100 * F.size(F.array_intersect(F.col("own"), around)) / F.size("own")).cast("int")
    return near.select("id", "k", "license", share.alias("percent")).filter(F.col("percent") >= percent).groupBy("id", "k", "license").agg(
        F.max("percent").alias("percent"))


def license_report(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id_col, n_licenses, licenses) for every row of ``docs``; ``licenses`` is sorted and comma-joined, empty where there is none."""
    found = scan(docs, templates, id_col, text_col, percent).groupBy(F.col("id").alias("_id"), F.col("k").alias("_k")).agg(
        F.sort_array(F.collect_set("license")).alias("names"))
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("k")).join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("names").isNull(), 0).otherwise(F.size("names")).cast("long").alias("n_licenses"),
                       F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"))
