"""Secret scans with corpus-wide ownership frequency.

Each text is scanned once (Arrow batches, nothing of it is shuffled); its candidates are kept with a hash of the secret.
Candidate hashes are then aggregated over the corpus by distinct owners and repositories: a value that several owners have
in more than a few repositories is a widely copied example, and so is one that very many repositories have whose owner is
unknown, no owner in particular (a hot source that holds a large share of all rows) or not the only one.  What one known
owner has, in however many repositories, is specific to that owner: like any other that looks random it is a live-looking
credential.

Base spans (assignments, access keys, hexadecimal keys) are always reported.  The method adds ``token`` spans (mixed
random-looking strings) and ``pem`` spans (private key blocks) where the ownership says they are live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm._common import col, empty_if_null, pack, text_key, unpack, written

#: Fixed values of the contract: patterns and least lengths of the base kinds, in the order of listing; then the method's.
KINDS = ("assign", "access", "hex", "token", "pem")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs of 24 or more: the same spans as [0-9a-f]+ of at least 24
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----.*?-----END (?:[A-Z]+ )*PRIVATE KEY-----", re.S)

CANDIDATE = "struct<kind:int,start:bigint,stop:bigint,hash:binary,random:boolean>"


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return len(value) >= 12 and entropy(value) >= 3.0 and any(c.isdigit() for c in value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, secret): base spans by the contract, then method candidates that overlap none of them."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    more = [(3, m.start(), m.end(), m[0]) for m in TOKEN.finditer(text) if _mixed(m[0])]
    if "PRIVATE KEY-----" in text:
        more += [(4, m.start(), m.end(), m[0]) for m in PEM.finditer(text)]
    if more:
        taken = sorted((s, e) for _, s, e, _ in found)
        found += [c for c in more if c[0] == 4 or not any(s < c[2] and c[1] < e for s, e in taken)]
    return sorted(found, key=lambda c: (c[1], c[0]))


def _mixed(value: str) -> bool:
    return any(c.isdigit() for c in value) and value.lower() != value and value.upper() != value and entropy(value) >= 3.5


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("hash", pa.binary()), ("random", pa.bool_())])
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = []
            for text in part.column("text").to_pylist():
                spans = candidates(text) if text else []
                found.append([{"kind": k, "start": s, "stop": e, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).digest()[:16], "random": looks_random(v)} for k, s, e, v in spans])
            kept = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(found, pa.list_(entry))], names=[*kept, "found"])


def _scanned(df: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    text = empty_if_null(col(text_col))
    rows = df.select(col(id_col).cast("bigint").alias("id"), empty_if_null(col(owner_col).cast("string")).alias("owner"), empty_if_null(col(repo_col).cast("string")).alias("repo"),
                     text_key(text)["a"].alias("a"), text_key(text)["b"].alias("b"), text.alias("text"))
    return written(rows.mapInArrow(_scan, f"id bigint, owner string, repo string, a bigint, b bigint, found array<{CANDIDATE}>"), "secrets")


def hot_owners(scanned: DataFrame, share: float, rows: int) -> list[str]:
    """Owners that hold more than ``share`` of all rows and at least ``rows``: at most 1 / share of them."""
    sizes = scanned.groupBy("owner").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return [r.owner for r in sizes.filter((F.col("n") > share * total) & (F.col("n") >= rows)).collect()]


def ownership(scanned: DataFrame, unspecific: list[str] | None = None) -> DataFrame:
    """(hash, owners, repos, specific): distinct owners and repositories of each candidate over the corpus, and how many
    of the owners are known and none of ``unspecific``."""
    held = scanned.select("owner", "repo", F.explode("found.hash").alias("hash")).distinct()
    known = F.when((F.col("owner") != "") & ~F.col("owner").isin(unspecific or [""]), F.col("owner"))
    return held.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"), F.count_distinct(known).alias("specific"))


def _spans(scanned: DataFrame, max_owners: int, max_repos: int, many_repos: int, hot_share: float, hot_rows: int) -> DataFrame:
    """(a, b, spans): by text, the sorted spans that hold, each with ``label``."""
    held = scanned.select("a", "b", F.explode("found").alias("c")).distinct()
    common = written(ownership(scanned, hot_owners(scanned, hot_share, hot_rows)), "owners")
    joined = held.select("a", "b", "c", F.col("c.hash").alias("hash")).join(common, "hash")
    one_owner = (F.col("owners") == 1) & (F.col("specific") == 1)
    copied = (F.col("owners") > max_owners) & (F.col("repos") > max_repos) | (F.col("repos") > many_repos) & ~one_owner
    label = F.when(copied, "example").when(F.col("c.random") | (F.col("c.kind") >= 3), "live").otherwise("weak")
    stays = (F.col("c.kind") < 3) | ~copied
    spans = F.sort_array(F.collect_list(F.struct("c.start", "c.kind", "c.stop", label.alias("label"))))
    return joined.filter(stays).groupBy("a", "b").agg(spans.alias("spans"))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = 2, max_repos: int = 4, many_repos: int = 10, hot_share: float = 0.2, hot_rows: int = 1000) -> DataFrame:
    """One row per row of ``df``: id and ``spans``, an array of (start, kind, stop, label) sorted by start, then kind.

    ``kind`` indexes ``KINDS``; offsets are code points, the end exclusive; the span is the whole match.  ``label`` is
    ``example`` where more than ``max_owners`` owners hold the same secret in more than ``max_repos`` repositories, or
    more than ``many_repos`` repositories do, unless all are of one owner that is known and no hot one (more than
    ``hot_share`` of all rows, at least ``hot_rows``); else ``live`` where it looks random, else ``weak``.  Method spans
    that are examples are left out; base spans always stay.  Null and empty texts have no spans; texts of any length are
    scanned whole, a row at a time; a null owner or repository is one of its own; repeated rows are reported each; an
    empty table gives no row; other columns are not looked at.
    """
    scanned = _scanned(df, id_col, text_col, owner_col, repo_col)
    spans = written(_spans(scanned, max_owners, max_repos, many_repos, hot_share, hot_rows), "spans")
    joined = scanned.join(spans, ["a", "b"], "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,label:string>>")
    return joined.select(F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))


def redact_secrets(df: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = 2, mask: str = "[SECRET]", max_repos: int = 4, many_repos: int = 10, labels: tuple[str, ...] = ("live",), hot_share: float = 0.2, hot_rows: int = 1000) -> DataFrame:
    """All rows and columns of ``df``; in the text the spans with one of ``labels`` are replaced by ``mask`` (overlapping spans by one).

    An access key is a credential by its form, so among ``live`` ones it counts unless it is an example; other examples
    and weak matches stay unless their label is given.  A null text stays null.
    """
    scanned = _scanned(df, repo_col, text_col, owner_col, repo_col)
    wanted = F.filter("spans", lambda s: s.label.isin(*labels) | F.lit("live" in labels) & (s.kind == KINDS.index("access")) & (s.label == "weak"))
    edges = F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s.start, s.stop)), ",")
    spans = written(_spans(scanned, max_owners, max_repos, many_repos, hot_share, hot_rows).select("a", "b", edges.alias("edges")).filter("edges <> ''"), "spans")
    keyed = pack(df, text=text_col)
    key = text_key(empty_if_null(F.col("text")))
    joined = keyed.select("row", "text", key["a"].alias("a"), key["b"].alias("b")).join(spans, ["a", "b"], "left")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, edges: pd.Series) -> pd.Series:
        return pd.Series([t if e is None or t is None else mask_spans(t, [tuple(map(int, x.split(":"))) for x in e.split(",")], mask) for t, e in zip(texts, edges)], dtype="object")

    return unpack(joined, df.columns, replace={text_col: F.when(F.col("edges").isNull(), F.col("text")).otherwise(masked("text", "edges"))})


def mask_spans(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    out, at = [], 0
    for start, stop in sorted(spans):
        if stop <= at:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = stop
    return "".join(out) + text[at:]
