"""URL allow and block rules by a sort-merge range join (DataFrame functions only).

A rule ``(host, path, verdict)`` fits its host and all subdomains where the URL's path starts with the rule's path.
Hosts become canonical reversed keys (``www.example.com`` -> ``com.example.www.``), so that a rule's host is a prefix,
that is an interval, of the sorted keys; intervals nest or are disjoint.  One sorted sweep over rule and URL keys
carries the stack of rules opened so far, one slot for each depth; a slot whose key is no prefix of the point has been
left behind and counts as popped.  A second sweep of the same kind finds, under each active host, the rules whose path
is a prefix of the URL's path.

The sweep is distributed: keys are range-partitioned (each distinct key once, so a hot host cannot fill a task), each
range is swept by itself, and what is open at a range's start comes from a summary of one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.llm._common import ascii_lower, col, empty_if_null, pack, unpack, written

#: First "://", then the host up to "/", "?" or "#", then the path up to "?" or "#".
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a dot; the empty host has the empty key, a prefix of all."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def sweep(events: DataFrame, order: Sequence[str], slots: Sequence[str]) -> DataFrame:
    """For each event, the last non-null value of each slot at or before it in the order of ``order``.

    Adds nothing but replaces the slot columns.  ``events`` is written once, range-partitioned.
    """
    ranged = written(events.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sweep")
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct(*order)
    ends = ranged.groupBy("part").agg(*[F.max_by(F.col(s), F.when(F.col(s).isNotNull(), place)).alias(f"open_{s}") for s in slots])
    # one row per range: bounded by the number of partitions, not by the data
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opened = ends.select("part", *[F.last(f"open_{s}", ignorenulls=True).over(earlier).alias(f"open_{s}") for s in slots])
    swept = ranged.select(*[c for c in ranged.columns if c not in slots], *[F.last(s, ignorenulls=True).over(before).alias(s) for s in slots])
    joined = swept.join(F.broadcast(opened), "part")
    return joined.select(*[c for c in events.columns if c not in slots], *[F.coalesce(s, f"open_{s}").alias(s) for s in slots])


def _rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path): key, rule string, verdict; block wins over allow for the same host and path."""
    host, path = ascii_lower(empty_if_null(F.col("host"))), empty_if_null(F.col("path"))
    named = rules.filter(F.col("verdict").isNotNull()).select(host_key(host).alias("rkey"), host.alias("rhost"), path.alias("rpath"), F.col("verdict"))
    return named.groupBy("rkey", "rhost", "rpath").agg(F.max("verdict").alias("verdict")).withColumn("rule", F.concat("rhost", "rpath"))


def _active_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rkey) for each rule host on the stack at the URL's host."""
    keys = rules.select("rkey").distinct().withColumn("depth", F.size(F.split("rkey", r"\.")))
    depths = sorted(r.depth for r in keys.select("depth").distinct().collect())  # at most the labels of a host
    depths = depths or [0]
    slots = [f"s{d}" for d in depths]
    opens = keys.select(F.col("rkey").alias("key"), F.lit(0).alias("is_url"), F.lit(None).cast("string").alias("host"),
                        *[F.when(F.col("depth") == d, F.col("rkey")).alias(s) for d, s in zip(depths, slots)])
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("is_url"), "host", *[F.lit(None).cast("string").alias(s) for s in slots])
    swept = sweep(opens.unionByName(points), ["key", "is_url", "host"], slots).filter("is_url = 1")
    stack = F.filter(F.array(*slots), lambda k: F.col("key").startswith(k))
    return swept.select("host", F.explode(stack).alias("rkey"))


def _chains(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of its host whose path is a prefix of its own, shortest first, itself last."""
    prefixes = rules.select("rkey", F.col("rpath").alias("of"), F.explode(F.transform(F.sequence(F.lit(0), F.length("rpath")), lambda i: F.col("rpath").substr(F.lit(1), i))).alias("rpath"))
    entry = F.struct(F.length("rpath").alias("n"), F.col("rpath").alias("path"), "rule", "verdict")
    return prefixes.join(rules, ["rkey", "rpath"]).groupBy("rkey", F.col("of").alias("path")).agg(F.sort_array(F.collect_list(entry)).alias("chain"))


def judge(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``(host, path)`` -> (host, path, rule, verdict) of the longest fitting rule; no row where none fits.

    Longest means most characters of host and path together, then the longer host, then the rule string.
    """
    rules = written(_rules(rules), "rules")
    active = _active_hosts(paths.select("host").distinct(), rules)
    asked = paths.join(active, "host")
    chains = _chains(rules)
    kind = chains.select(F.struct("rkey", "chain").alias("top")).schema["top"].dataType
    events = chains.select("rkey", "path", F.lit(0).alias("is_url"), F.struct("rkey", "chain").alias("top")).unionByName(
        asked.select("rkey", "path").distinct().select("rkey", "path", F.lit(1).alias("is_url"), F.lit(None).cast(kind).alias("top"))
    )
    swept = sweep(events, ["rkey", "path", "is_url"], ["top"]).filter("is_url = 1 AND top.rkey = rkey")
    fits = F.filter("top.chain", lambda r: F.col("path").startswith(r.path))
    found = swept.select("rkey", "path", F.element_at(F.when(F.size(fits) > 0, fits), -1).alias("hit")).filter("hit IS NOT NULL")
    best = F.max_by("hit", F.struct(F.length("hit.rule"), F.length("rkey"), "hit.rule"))
    return asked.join(found, ["rkey", "path"]).groupBy("host", "path").agg(best.alias("hit")).select("host", "path", "hit.rule", "hit.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default_verdict: str = "allow") -> DataFrame:
    """All rows of ``pages`` with ``host, path, rule, verdict`` added.

    ``rules`` has the columns ``host, path, verdict`` (``allow`` or ``block``); a null host or path counts as empty,
    a rule without verdict is left out.  A null URL or one without ``://`` has an empty host and path and is judged
    like any other, as is one of any length.  ``default_verdict`` is given where no rule fits.  Repeated rows are kept; equal URLs are judged
    once.  Input columns named like an added one are replaced.
    """
    url = empty_if_null(F.col("url"))
    parts = pack(pages, url=url_col).select("row", ascii_lower(F.regexp_extract(url, URL_PARTS, 1)).alias("host"), F.regexp_extract(url, URL_PARTS, 2).alias("path"))
    asked = pages.select(col(url_col).alias("url")).select(ascii_lower(F.regexp_extract(url, URL_PARTS, 1)).alias("host"), F.regexp_extract(url, URL_PARTS, 2).alias("path")).distinct()
    judged = parts.join(judge(asked, rules), ["host", "path"], "left")
    return unpack(judged, pages.columns, add={"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"), "verdict": F.coalesce("verdict", F.lit(default_verdict))})
