"""URL rules by a sort-merge range join.

A host's labels are reversed (``blog.example.org`` to ``org.example.blog.``), so that a host and all its subdomains are one interval of sorted
keys, and intervals are nested or apart. URLs and rules are sorted together into ranges of about equal size; a sweep over a range keeps
a stack of the rules whose interval is open, and a URL only looks at that stack. Rules that are open where a range
begins are found from the range's first key, and put in front of it. A hot host spreads over ranges, as the URL is part of the sort key.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each with a dot after it; an empty host has an empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class _Open:
    """Rules of one host, by length of their path, longest first."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths = key, host, {}

    def add(self, path: str, verdict: str):
        own = self.paths.setdefault(len(path), {})
        if len(own) == 0:
            self.paths = dict(sorted(self.paths.items(), reverse=True))
        # of two verdicts for one rule, the stricter one holds
        own[path] = max(own.get(path, ""), verdict, key=lambda v: (v == "block", v))

    def best(self, path: str):
        for n, own in self.paths.items():
            if n <= len(path) and path[:n] in own:
                return len(self.host) + n, self.host + path[:n], own[path[:n]]
        return None


def _sweep(batches):
    """Rows sorted by (part, key, kind); yields the URLs with their rule and its verdict."""
    stack: list[_Open] = []
    part = None
    for batch in batches:
        rule, verdict, keep = [], [], []
        cols = [batch.column(i).to_pylist() for i in range(6)]
        for i, (p, key, kind, host, path, own) in enumerate(zip(*cols)):
            if p != part:
                stack, part = [], p
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1].key != key:
                    stack.append(_Open(key, host))
                stack[-1].add(path, own)
                continue
            found = max((x for x in (s.best(path) for s in stack) if x), default=None)
            keep.append(i)
            rule.append(found[1] if found else None)
            verdict.append(found[2] if found else None)
        if keep:
            rows = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([rows.column(6), rows.column(3), rows.column(4), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             ["id", "host", "path", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains where the URL's path starts with the
    rule's; the longest rule (host and path together) wins, and ``default`` holds where none fits. A null URL or one without ``://``
    has an empty host and path, which no rule fits. Rules with a null host or path fit nothing; of equal rules with different verdicts,
    block holds. Repeated rows are judged alike; other columns are ignored; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("tie"))
    urls = urls.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("own"), "id", "tie")
    opened = rules.filter("host is not null and host <> '' and path is not null").select(
        host_key(ascii_lower(F.col("host"))).alias("key"), F.lit(0).alias("kind"), ascii_lower(F.col("host")).alias("host"), "path",
        F.col("verdict").alias("own"), F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("tie")).distinct()
    ranges = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = urls.union(opened).repartitionByRange(ranges, "key", "kind", "path", "id", "tie").withColumn("part", F.spark_partition_id())
    placed = written(placed.drop("tie"), "ranges")

    # rules already open where a range begins: their keys are prefixes of its first key
    labels = F.split("first", r"\.")
    carried = placed.groupBy("part").agg(F.min("key").alias("first")).select("part", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("key"))
    carried = carried.join(opened.drop("tie"), "key").select("part", "key", "kind", "host", "path", "own", "id")
    order = ["part", "key", "kind", "host", "path", "own", "id"]
    rows = placed.select(*order).union(carried.select(*order)).repartition("part").sortWithinPartitions("part", "key", "kind")
    found = rows.mapInArrow(_sweep, "id long, host string, path string, rule string, verdict string")
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
