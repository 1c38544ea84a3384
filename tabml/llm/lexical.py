"""Ranked lexical search on K2-treaps: compressed quadtrees over the term-document grid that store impact maxima.

1. ``corpus_size`` counts documents with a term and terms, in one pass of the texts.
2. ``build_index``: each task cuts its documents into blocks of bounded text.  A block's grid has a row for each of its
   terms and a column for each of its documents (by id); a cell holds the integer impact of the term in the document.
   The cells' Morton codes are sorted and merged bottom-up into a quadtree without unary nodes; every node keeps the
   largest impact below it.  Blocks are rows of a written table, so an index can be kept and searched again.
3. ``search``: items come to the driver in chunks of bounded size.  A chunk's document frequencies are summed over the
   blocks; then every block is searched for every item.  An item's terms are paths into the quadtree, one for each row;
   they go down together over halves of the document range, best upper bound first (a few ranges at a time), until no
   range can beat the k-th best score.  A task carries that score from block to block; its candidates, at most k an
   item, meet in a ranking whose partial limit is applied before the shuffle.

Scores are exact: a range of one document has the sum of its cells' impacts as its bound.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.llm._common import coded_words, col, packed, text_bytes, unpacked, written

#: Fixed values of the contract: ASCII bytes that end a term (all but digits and letters); A-Z are lower-cased.
BREAKS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
LOWER = bytes(0x20 if b in BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
INSIDE = bytes(b not in BREAKS for b in range(256))
#: Impacts of a term in a document, in integers.
SCALE, TF_UNIT, LENGTH_UNIT, LENGTH_SHARE = 1_000_000_000, 1000, 12, 25
NO_ID = np.iinfo(np.int64).max  # null ids come last


def count_terms(texts: pa.Array) -> np.ndarray:
    """Number of terms of each text."""
    offsets, data = text_bytes(texts)
    inside = np.frombuffer(data.translate(INSIDE), np.bool_)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(inside)]
    begins[firsts] = inside[firsts]
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[offsets[1:]] - total[offsets[:-1]]


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms, and the term number and text number of every term in order."""
    return coded_words(texts, LOWER)


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of each number, moved to the even bits."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _bits(n: int) -> int:
    return max(0, int(n) - 1).bit_length()


class Treap:
    """Compressed quadtree over sorted cells: leaves first, then branching nodes, then one that is empty.

    ``depth`` and ``code`` of a node say which cell of the quadtree it is; ``best`` is the largest impact in it and
    ``child`` its four children (branching nodes only).  ``docs`` columns span the low ``width`` bits of a path.
    """

    def __init__(self, leaf_code: np.ndarray, leaf_best: np.ndarray, depth: np.ndarray, first: np.ndarray, best: np.ndarray, child: np.ndarray, levels: int, docs: int):
        self.levels, self.width, self.docs, self.n_leaves = levels, _bits(docs), docs, len(leaf_code)
        self.code = np.concatenate([leaf_code, leaf_code[first], np.zeros(1, np.int64)])
        self.depth = np.concatenate([np.full(len(leaf_code), levels, np.int16), depth, np.full(1, 255, np.int16)])
        self.best = np.concatenate([leaf_best, best, np.zeros(1, np.int32)]).astype(np.int64)
        self.child = np.concatenate([child.ravel(), np.full(4, -1, np.int32)])

    def halves(self, nodes: np.ndarray, rows: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (ranges x terms) one level down, for the lower and the upper half of each document range."""
        shift = (self.levels - 1 - level)[:, None]
        lower = ((rows[None, :] >> shift) & 1) * 2
        below = self.depth[nodes] > level[:, None]
        digit = (self.code[nodes] >> (2 * shift)) & 3
        at = np.where(below, 0, (nodes - self.n_leaves) * 4)
        out = []
        for quarter in (lower, lower + 1):
            stays = np.where(digit == quarter, nodes, -1)
            out.append(np.where(below, stays, self.child[at + np.where(below, 0, quarter)]))
        return out[0], out[1]

    def paths(self, rows: np.ndarray) -> np.ndarray:
        """The node of each row over all documents."""
        root = len(self.depth) - 2
        nodes = np.full((1, len(rows)), root if self.n_leaves else -1)
        for level in range(self.levels - self.width):
            nodes, _ = self.halves(nodes, rows, np.array([level]))
        return nodes


def build_treap(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, n_rows: int, n_cols: int) -> dict:
    """Arrays of the compressed quadtree over distinct cells (row, column, impact)."""
    levels = max(_bits(n_rows), _bits(n_cols))
    code = ((_spread(rows) << np.uint64(1)) | _spread(cols)).astype(np.int64)
    order = np.argsort(code, kind="stable")
    code, leaf_best = code[order], impacts[order].astype(np.int32)
    n = len(code)
    # neighbours part at the level of their highest differing digit
    parts = np.zeros(0, np.int16)
    if n > 1:
        differ = code[1:] ^ code[:-1]
        high = np.frexp(differ.astype(np.float64))[1] - 1  # exact below 2^53, beyond it the exponent may be one too high
        high = np.where((differ >> np.minimum(high, 62)) == 0, high - 1, high)
        parts = (levels - 1 - high // 2).astype(np.int16)
    nodes, first, best = np.arange(n), np.arange(n), leaf_best
    made_depth, made_first, made_best, made_child, count = [], [], [], [], n
    for level in range(levels - 1, -1, -1):
        joined = parts == level
        if not joined.any():
            continue
        begin = np.concatenate([[True], ~joined])
        starts = np.flatnonzero(begin)
        group = np.cumsum(begin) - 1
        sizes = np.diff(np.append(starts, len(nodes)))
        merged = sizes > 1
        number = np.full(len(starts), -1)
        number[merged] = count + np.arange(int(merged.sum()))
        inside = merged[group]
        child = np.full((int(merged.sum()), 4), -1, np.int32)
        digit = (code[first[inside]] >> (2 * (levels - 1 - level))) & 3
        child[number[group[inside]] - count, digit] = nodes[inside]
        best = np.maximum.reduceat(best, starts)
        made_depth.append(np.full(len(child), level, np.int16))
        made_first.append(first[starts][merged].astype(np.int32))
        made_best.append(best[merged])
        made_child.append(child)
        count += len(child)
        nodes, first = np.where(merged, number, nodes[starts]), first[starts]
        parts = parts[~joined]
    cat = lambda xs, kind, shape=(0,): np.concatenate(xs).astype(kind) if xs else np.zeros(shape, kind)
    return {
        "leaf_code": code, "leaf_best": leaf_best, "depth": cat(made_depth, np.int16), "first": cat(made_first, np.int32),
        "best": cat(made_best, np.int32), "child": cat(made_child, np.int32, (0, 4)), "levels": levels, "docs": n_cols,
    }


#: Arrays of an index row, zstd-compressed, with their types; the last two columns of ``INDEX`` are their lengths.
ARRAYS = {"ids": np.int64, "missing": np.bool_, "counts": np.int32, "leaf_step": np.int64, "leaf_best": np.int32, "depth": np.int16, "first": np.int32, "best": np.int32, "child": np.int32}
INDEX = "n_docs int, levels int, terms array<string>, " + ", ".join(f"{a} binary" for a in ARRAYS) + ", cells int, inner int"


def _block(ids: pa.Array, texts: pa.Array, n_docs: int, n_terms: int) -> dict | None:
    """One index row, or None where no document has a term."""
    terms, term, doc = terms_of(texts)
    if not len(terms):
        return None
    length = np.bincount(doc, minlength=len(texts))
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
    order = np.lexsort((np.arange(len(ids)), missing, number))
    order = order[length[order] > 0]
    place = np.full(len(texts), -1)
    place[order] = np.arange(len(order))
    cell, tf = np.unique(term.astype(np.int64) * len(order) + place[doc], return_counts=True)
    rows, cols = cell // len(order), cell % len(order)
    m = (100 - LENGTH_SHARE) + (LENGTH_SHARE * length[order].astype(np.int64) * n_docs) // n_terms
    impact = (SCALE * tf) // (TF_UNIT * tf + LENGTH_UNIT * m[cols])
    t = build_treap(rows, cols, impact, len(terms), len(order))
    arrays = {
        "ids": number[order], "missing": missing[order], "counts": np.bincount(rows, minlength=len(terms)), "leaf_step": np.diff(t["leaf_code"], prepend=0),
        **{name: t[name] for name in ("leaf_best", "depth", "first", "best", "child")},
    }
    sizes = {"n_docs": len(order), "levels": t["levels"], "cells": len(t["leaf_code"]), "inner": len(t["depth"])}
    return sizes | {"terms": terms.to_pylist()} | {name: packed(arrays[name], kind) for name, kind in ARRAYS.items()}


def _treap(batch: pa.RecordBatch, at: int) -> tuple[Treap, np.ndarray, np.ndarray]:
    """Quadtree, document ids and their null flags of an index row."""
    n_docs, levels, cells, inner = (batch.column(c)[at].as_py() for c in ("n_docs", "levels", "cells", "inner"))
    sizes = {"ids": n_docs, "missing": n_docs, "leaf_step": cells, "leaf_best": cells, "depth": inner, "first": inner, "best": inner, "child": 4 * inner}
    read = {name: unpacked(batch.column(name)[at], ARRAYS[name], n) for name, n in sizes.items()}
    treap = Treap(np.cumsum(read["leaf_step"]), *(read[name] for name in ("leaf_best", "depth", "first", "best", "child")), levels, n_docs)
    return treap, read["ids"], read["missing"]


def corpus_size(df: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and their terms."""

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        for batch in batches:
            n = count_terms(batch.column(0))
            docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})

    total = df.select(col(text_col)).mapInArrow(counts, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return int(total[0] or 0), int(total[1] or 0)


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2 << 20) -> tuple[DataFrame, int]:
    """Index blocks of ``df`` (rows of ``INDEX``, to be written by the caller) and the documents that have a term.

    Every row and whole text is indexed.  A block closes after ``block_bytes`` of text; a longer text makes its own
    block larger, so memory follows the longest text.  Null and empty texts and those without a term are in no block;
    repeated rows are columns of their own; other columns are not looked at.
    """
    n_docs, n_terms = corpus_size(df, text_col)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        ints = [(c, pa.int32()) for c in ("n_docs", "levels")], [(c, pa.int32()) for c in ("cells", "inner")]
        schema = pa.schema([*ints[0], ("terms", pa.list_(pa.string())), *[(c, pa.binary()) for c in ARRAYS], *ints[1]])

        def close():
            ids, texts = (pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))
            row = _block(ids, texts, n_docs, n_terms)
            if row is not None:
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                held.append(batch.slice(at, 100))
                size += pc.sum(pc.binary_length(held[-1].column(1))).as_py() or 0
                if size >= block_bytes:
                    yield from close()
                    held, size = [], 0
        if held:
            yield from close()

    rows = df.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    return rows.mapInArrow(blocks, INDEX), n_docs


class Ranking:
    """The k best (score, id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.missing = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        score, ids, missing = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.missing, missing])
        best = np.lexsort((missing, ids, -score))[: self.k]
        self.score, self.id, self.missing = score[best], ids[best], missing[best]

    def beats(self, bound: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Whether a range can still place a document: by score, or by a smaller id at the last place's score."""
        if len(self.score) < self.k:
            return bound > 0
        return (bound > self.score[-1]) | ((bound == self.score[-1]) & (least_id < self.id[-1]))


def search_block(treap: Treap, ids: np.ndarray, missing: np.ndarray, rows: np.ndarray, weights: np.ndarray, ranking: Ranking, at_once: int = 128) -> None:
    """Add the block's best documents for the rows (terms) and weights to ``ranking``."""
    levels, width = treap.levels, treap.width
    nodes = treap.paths(rows)
    bound = treap.best[nodes] @ weights
    level, column = np.array([levels - width]), np.zeros(1, np.int64)
    if width == 0:
        if bound[0] > 0:
            ranking.add(bound, ids[:1], missing[:1])
        return
    while len(bound):
        if len(bound) > at_once:
            take = np.argpartition(-bound, at_once)[:at_once]
            rest = np.ones(len(bound), bool)
            rest[take] = False
        else:
            take, rest = np.arange(len(bound)), np.zeros(len(bound), bool)
        deeper = np.concatenate(treap.halves(nodes[take], rows, level[take]))
        d_level, d_column = np.tile(level[take] + 1, 2), np.concatenate([column[take] * 2, column[take] * 2 + 1])
        d_bound = treap.best[deeper] @ weights
        done = d_level == levels
        hit = done & (d_bound > 0)
        if hit.any():
            ranking.add(d_bound[hit], ids[d_column[hit]], missing[d_column[hit]])
        nodes = np.concatenate([nodes[rest], deeper[~done]])
        bound, level, column = (np.concatenate([a[rest], b[~done]]) for a, b in ((bound, d_bound), (level, d_level), (column, d_column)))
        first = np.minimum(column << (levels - level), treap.docs - 1)
        open_ = ranking.beats(bound, ids[first]) & (bound > 0)
        nodes, bound, level, column = nodes[open_], bound[open_], level[open_], column[open_]


def _chunks(items: DataFrame, max_items: int, max_chars: int) -> Iterator[list]:
    """Items in lists of bounded number and text, streamed to the driver (a longer text is a list of its own)."""
    held, size = [], 0
    for row in items.toLocalIterator():
        if held and (len(held) >= max_items or size + len(row.text or "") > max_chars):
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row.text or "")
    if held:
        yield held


def search(index: DataFrame, n_docs: int, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text", max_items: int = 2000, max_chars: int = 4 << 20) -> DataFrame:
    """The ``k`` best documents of each item by score, then id (nulls last): item id, ``rank, doc_id, score``.

    ``index`` and ``n_docs`` are ``build_index``'s, the former written.  A term's weight is
    ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; repeated terms of an item count as often as they occur.  Items of null
    or empty text and items without a hit have no row; repeated items are ranked each; scores above 0 only.
    """
    spark, found = index.sparkSession, []
    kind = items.schema[id_col].dataType.simpleString()
    out = "item bigint, doc_id bigint, score bigint"
    for chunk in _chunks(items.select(col(id_col).alias("id"), col(text_col).alias("text")), max_items, max_chars):
        terms, term, owner = terms_of(pa.array([r.text for r in chunk], pa.string()))
        names = terms.to_pylist()
        wanted = {i: Counter() for i in range(len(chunk))}
        for t, i in zip(term.tolist(), owner.tolist()):
            wanted[i][t] += 1
        weight = _weights(index, names, n_docs)
        plans = [(i, np.array(list(c), np.int64), np.array([weight[t] * n for t, n in c.items()], np.int64)) for i, c in wanted.items() if c]

        def hits(batches: Iterable[pa.RecordBatch], names=names, plans=plans) -> Iterator[pa.RecordBatch]:
            rankings = [Ranking(k) for _ in plans]
            for batch in batches:
                for at in range(batch.num_rows):
                    known = pc.index_in(pa.array(names, pa.string()), value_set=batch.column("terms")[at].values).fill_null(-1).to_numpy(zero_copy_only=False)
                    treap, ids, missing = _treap(batch, at)
                    for (_, asked, weights), ranking in zip(plans, rankings):
                        rows = known[asked]
                        here = (rows >= 0) & (weights > 0)
                        if here.any():
                            search_block(treap, ids, missing, rows[here].astype(np.int64), weights[here], ranking)
            for (i, _, _), r in zip(plans, rankings):
                if len(r.score):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r.score), i)), pa.array(r.id, pa.int64(), mask=r.missing), pa.array(r.score)], names=["item", "doc_id", "score"])

        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = index.drop("counts").mapInArrow(hits, out).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        label = spark.createDataFrame([(i, r.id) for i, r in enumerate(chunk)], f"item bigint, id {kind}")
        found.append(written(ranked.join(label, "item").select(F.col("id").alias(id_col), "rank", "doc_id", "score"), "hits"))
    empty = spark.createDataFrame([], f"`{id_col}` {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found) if found else empty


def _weights(index: DataFrame, names: list[str], n_docs: int) -> list[int]:
    """Weights of the terms from their document frequencies over all blocks."""

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                known = pc.index_in(pa.array(names, pa.string()), value_set=batch.column("terms")[at].values).fill_null(-1).to_numpy(zero_copy_only=False)
                here = known >= 0
                total[here] += unpacked(batch.column("counts")[at], np.int32, len(batch.column("terms")[at]))[known[here]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    df = np.zeros(len(names), np.int64)
    for r in index.select("terms", "counts").mapInArrow(counts, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return [int(w) for w in np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1)))]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index ``docs`` (doc_id, text) in a written table and search it for ``items`` (item_id, text)."""
    index, n_docs = build_index(docs)
    index = written(index, "index", group_bytes=8 << 20)
    return search(index, n_docs, items, k)
