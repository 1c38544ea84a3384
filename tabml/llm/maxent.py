"""Language-model scoring: a hashed maximum-entropy model with a class-factored softmax.

1. ``encode``: tasks turn texts into blocks of token numbers over a block's own dictionary (one compressed row a block);
   the dictionaries' rows give the corpus counts, by word, and bring them back, by block.  All counts cover all texts.
2. Words get leaves: the most frequent ones a leaf each, the others share leaves by their last letters, and words of the
   training texts seen once stand for the unknown word (a leaf of its own).  ``WIDTH`` leaves make a class, so a word's
   probability is that of its class, of its leaf in the class, and of its share of the leaf's counts.
3. Both softmaxes are maximum-entropy models over hashed features: the previous word, the previous two, and the word
   before the previous one (a skip), for leaves together with the class; the unigram features are the logarithms of the
   counts.  Their tables have a fixed size.
4. Training goes over all training texts once, in rounds.  Every task of a round starts from the same weights and makes
   adaptive gradient updates in sparse batches (only the rows that a batch touches); the tasks' updates are summed by
   slices of the tables, each row weighted by the gradients the task saw for it.
5. Scoring is a pass over the blocks with the weights, in the same batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm._common import LOWER, UPPER, coded_words, col, packed, unpacked, written

#: Words are cut at ASCII white space; only A-Z are lower-cased.  No word is a space, which names the end of a text.
BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
END = " "
#: Shape of the model: leaves of a class (and classes), leaves of frequent words, hashed rows of each table.
WIDTH, FREQUENT, ROWS = 16, 192, 1 << 14
UNKNOWN = WIDTH * WIDTH - 1
FEATURES = 3
SLICE_ROWS = 1 << 11
#: Hash of the places before a text's first word; multipliers of the hashes.
BEFORE, BEFORE_THAT, MIX = np.uint32(7), np.uint32(11), np.uint32(2654435761)

BLOCK = "block bigint, n_docs int, n_tokens int, n_words int, ids binary, missing binary, train binary, lengths binary, tokens binary, hashes binary, leaves binary"
DOC_ARRAYS = {"ids": np.int64, "missing": np.bool_, "train": np.bool_, "lengths": np.int32}


def _encode_block(number: int, ids: pa.Array, texts: pa.Array, train: np.ndarray) -> tuple[dict, pa.Array, np.ndarray]:
    """A block's row, its distinct words (the end last) and their training counts."""
    words, word, owner = coded_words(texts, BYTES)
    n = len(texts)
    lengths = np.bincount(owner, minlength=n) + 1
    last = np.cumsum(lengths) - 1
    tokens = np.full(int(lengths.sum()), len(words), np.int32)
    inner = np.ones(len(tokens), bool)
    inner[last] = False
    tokens[inner] = word
    words = pa.concat_arrays([words, pa.array([END], pa.large_string())])
    raw = words.cast(pa.large_binary()).to_pylist()
    groups: dict[bytes, int] = {}
    leaves = [groups.get(w[-2:]) or groups.setdefault(w[-2:], FREQUENT + zlib.crc32(w[-2:]) % (UNKNOWN - FREQUENT)) for w in raw]
    row = {
        "block": number, "n_docs": n, "n_tokens": len(tokens), "n_words": len(words),
        "ids": packed(ids.fill_null(0).to_numpy(zero_copy_only=False), np.int64), "missing": packed(ids.is_null().to_numpy(zero_copy_only=False), np.bool_),
        "train": packed(train, np.bool_), "lengths": packed(lengths, np.int32), "tokens": packed(tokens, np.int32),
        "hashes": packed(np.array([zlib.crc32(w) & 0xFFFF for w in raw]), np.uint16),
        "leaves": packed(np.array(leaves), np.int16),
    }
    return row, words.cast(pa.string()), np.bincount(tokens[np.repeat(train, lengths)], minlength=len(words))


def encode(df: DataFrame, id_col: str, text_col: str, train: Column, block_bytes: int) -> DataFrame:
    """Rows of ``BLOCK`` and, beside them, (block, at, word, n) for each word of a block's dictionary; to be written."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, made = TaskContext.get().partitionId(), [], 0, 0
        schema = _schema(BLOCK + ", at int, word string, n bigint")

        def close():
            ids, texts, learned = (pa.concat_arrays([b.column(i) for b in held]) for i in range(3))
            row, words, counts = _encode_block((part << 32) + made, ids, texts, learned.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_pylist([row], schema=schema)
            for start in range(0, len(words), 10_000):
                some = words.slice(start, 10_000)
                given = {"block": pa.array(np.full(len(some), row["block"])), "at": pa.array(np.arange(start, start + len(some)), pa.int32()), "word": some, "n": pa.array(counts[start : start + len(some)])}
                yield pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(len(some), f.type)) for f in schema], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                held.append(batch.slice(start, 100))
                size += held[-1].column(1).nbytes
                if size >= block_bytes:
                    yield from close()
                    held, size, made = [], 0, made + 1
        if held:
            yield from close()

    rows = df.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    return rows.mapInArrow(blocks, BLOCK + ", at int, word string, n bigint")


@dataclass
class Counts:
    """Corpus totals of the training texts and what the leaves hold (arrays of WIDTH x WIDTH)."""

    tokens: int
    distinct: int
    targets: np.ndarray  # occurrences, words seen once counted as the unknown word
    shares: np.ndarray  # sum of count + 0.5 over the leaf's words


def count_words(rows: DataFrame) -> tuple[DataFrame, Counts]:
    """(block, at, c, frequent) of every block's dictionary, with the corpus count and the rank among frequent words."""
    words = rows.filter("word IS NOT NULL").select("block", "at", "word", "n")
    counts = written(words.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    top = counts.filter("c > 0").orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    ranks = counts.sparkSession.createDataFrame([(r.word, i) for i, r in enumerate(top)], "word string, frequent int")
    known = written(counts.join(F.broadcast(ranks), "word", "left"), "known")
    leaf = F.coalesce("frequent", (F.lit(FREQUENT) + F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % (UNKNOWN - FREQUENT)).cast("int"))
    sums = known.filter("c > 0").groupBy(leaf.alias("leaf")).agg(
        F.sum(F.when(F.col("c") > 1, F.col("c"))).alias("more"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("words"), F.sum(F.when(F.col("c") == 1, 1)).alias("once")
    )
    targets, shares, tokens, distinct = np.full(WIDTH * WIDTH, 0.5), np.zeros(WIDTH * WIDTH), 0, 0
    for r in sums.collect():
        targets[r.leaf] += r.more or 0
        targets[UNKNOWN] += r.once or 0
        shares[r.leaf] = r.all + 0.5 * r.words
        tokens, distinct = tokens + r.all, distinct + r.words
    return words.join(known, "word").select("block", "at", "c", "frequent"), Counts(tokens, distinct, targets, shares)


PARTS = "block bigint, n_words int, places binary, counts binary, ranks binary"
PART_ARRAYS = {"places": np.int32, "counts": np.int64, "ranks": np.int16}
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, at, c, frequent) rows, as they come, to a compressed row for each block."""

    def close():
        block, at, c, frequent = (np.concatenate([b.column(i).fill_null(-1).to_numpy(zero_copy_only=False) for b in held]) for i in range(4))
        order = np.lexsort((at, block))
        block, arrays = block[order], {"places": at[order], "counts": c[order], "ranks": frequent[order]}
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        for start, stop in zip(starts, np.append(starts[1:], len(block))):
            some = {name: array[start:stop] for name, array in arrays.items()}
            some["places"] = np.diff(some["places"], prepend=0)
            row = {"block": int(block[start]), "n_words": int(stop - start)} | {name: packed(some[name], kind) for name, kind in PART_ARRAYS.items()}
            yield pa.RecordBatch.from_pylist([row], schema=_schema(PARTS))

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 1 << 20:
            yield from close()
            held, size = [], 0
    if size:
        yield from close()


def join_counts(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks with their words' counts: a task packs its words by block, and a block's parts are dealt to its row."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for at in range(batch.num_rows):
                n = batch.column("n_words")[at].as_py()
                if batch.column("n_docs")[at].as_py() is None:  # a part; they come before the block's row
                    places, counts, ranks = (unpacked(batch.column(name)[at], kind, n) for name, kind in PART_ARRAYS.items())
                    found.setdefault("places", []).append(np.cumsum(places))
                    found.setdefault("counts", []).append(counts)
                    found.setdefault("ranks", []).append(ranks)
                    continue
                order = np.argsort(np.concatenate(found["places"]))
                row = {c: batch.column(c)[at].as_py() for c in schema.names}
                row |= {name: packed(np.concatenate(found[name])[order], PART_ARRAYS[name]) for name in ("counts", "ranks")}
                yield pa.RecordBatch.from_pylist([row], schema=schema)
                found = {}

    null = lambda kind: F.lit(None).cast(kind)
    kinds = [c.split() for c in BLOCK.split(", ")]
    blocks = rows.filter("n_docs IS NOT NULL").select(*[name for name, _ in kinds], *[null("binary").alias(a) for a in PART_ARRAYS])
    parts = placed.select("block", F.col("at").cast("int"), "c", F.col("frequent").cast("int")).mapInArrow(_parts, PARTS)
    parts = parts.select(*[F.col(name) if name in ("block", "n_words") else null(kind).alias(name) for name, kind in kinds], *PART_ARRAYS)
    result = BLOCK + ", counts binary, ranks binary"
    schema = _schema(result)
    dealt = blocks.unionByName(parts).repartition("block").sortWithinPartitions("block", F.col("n_docs").isNotNull())
    return dealt.mapInArrow(merge, result)


class Block:
    """Arrays of one block, or of some of its texts: features and leaves of every token."""

    def __init__(self, batch: pa.RecordBatch, at: int, model: Counts, turn: int | None = None, rounds: int = 1):
        n_docs, n_tokens, n_words = (batch.column(c)[at].as_py() for c in ("n_docs", "n_tokens", "n_words"))
        self.ids, self.missing, self.train, self.lengths = (unpacked(batch.column(c)[at], kind, n_docs) for c, kind in DOC_ARRAYS.items())
        tokens = unpacked(batch.column("tokens")[at], np.int32, n_tokens)
        if turn is not None:  # the training texts of a round
            mine = self.train & (np.arange(n_docs) % rounds == turn)
            tokens, self.lengths = tokens[np.repeat(mine, self.lengths)], self.lengths[mine]
        words = {c: unpacked(batch.column(c)[at], kind, n_words) for c, kind in {"hashes": np.uint16, "leaves": np.int16, "counts": np.int64, "ranks": np.int16}.items()}
        self.model, self.tokens, self.counts = model, tokens, words["counts"]
        self.words_leaf = np.where(words["ranks"] >= 0, words["ranks"], words["leaves"])
        self.first = np.cumsum(self.lengths) - self.lengths
        one = np.roll(words["hashes"].astype(np.uint32)[tokens], 1)
        one[self.first] = BEFORE
        two = np.roll(one, 1)
        two[self.first] = BEFORE_THAT
        self.features = [_mixed(one), _mixed(one * np.uint32(31) + _mixed(two)), _mixed(two + np.uint32(99))]

    def leaves(self, least: int) -> np.ndarray:
        """Leaf of every token; words with a count below ``least`` are the unknown word."""
        return np.where(self.counts >= least, self.words_leaf, UNKNOWN).astype(np.uint32)[self.tokens]

    def shares(self) -> np.ndarray:
        """log10 of each token's share of its leaf."""
        known = self.counts > 0
        return np.where(known, np.log10((self.counts + 0.5) / np.where(known, self.model.shares[self.words_leaf], 1.0)), 0.0)[self.tokens]

    def base(self) -> np.ndarray:
        return np.log10((self.counts + 0.5) / (self.model.tokens + 0.5 * (self.model.distinct + 1)))[self.tokens]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX
    return x ^ (x >> np.uint32(15))


class Weights:
    """Tables of both softmaxes (classes, leaves of a class): rows by hashed feature, and the gradients seen by each."""

    def __init__(self, model: Counts, tables: np.ndarray | None = None, seen: np.ndarray | None = None):
        mass = model.targets.reshape(WIDTH, WIDTH)
        self.class_bias = np.log(mass.sum(1) / mass.sum()).astype(np.float32)
        self.leaf_bias = np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)
        self.tables = np.zeros((2 * FEATURES, ROWS, WIDTH), np.float32) if tables is None else tables
        self.seen = np.full((2 * FEATURES, ROWS), 0.01, np.float32) if seen is None else seen

    def _softmax(self, level: int, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
        z = self.tables[level * FEATURES][rows[0]]
        for f in range(1, FEATURES):
            z += self.tables[level * FEATURES + f][rows[f]]
        z += bias
        np.exp(np.minimum(z, 60, out=z), out=z)  # biases are below 0 and weights small: no need to look for the largest
        z /= np.maximum(z @ np.ones(WIDTH, np.float32), 1e-30)[:, None]
        return z

    def _update(self, level: int, rows: list[np.ndarray], gradient: np.ndarray, rate: float) -> None:
        for f in range(FEATURES):
            order = np.argsort(rows[f], kind="stable")
            at = rows[f][order]
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            step, touched, t = np.add.reduceat(gradient[order], starts, axis=0), at[starts], level * FEATURES + f
            self.seen[t, touched] += np.einsum("ij,ij->i", step, step)
            self.tables[t][touched] -= step * (rate / np.sqrt(self.seen[t, touched]))[:, None]

    def batch(self, features: list[np.ndarray], leaf: np.ndarray, rate: float | None = None) -> np.ndarray:
        """Natural log-probability of each token's leaf; with a rate, one gradient update follows."""
        mask, at = np.uint32(ROWS - 1), np.arange(len(leaf))
        of, place = leaf // np.uint32(WIDTH), leaf % np.uint32(WIDTH)
        upper = [(f & mask).astype(np.uint16) for f in features]
        salt = _mixed(of + np.uint32(1))
        lower = [((((f + salt) * MIX) >> np.uint32(8)) & mask).astype(np.uint16) for f in features]
        p, q = self._softmax(0, upper, self.class_bias), self._softmax(1, lower, self.leaf_bias[of])
        out = np.log(np.maximum(p[at, of], 1e-30)) + np.log(np.maximum(q[at, place], 1e-30))
        if rate is not None:
            p[at, of] -= 1
            q[at, place] -= 1
            self._update(0, upper, p, rate)
            self._update(1, lower, q, rate)
        return out


def train(blocks: DataFrame, model: Counts, rounds: int, rate: float, batch_tokens: int, task_tokens: int) -> Weights:
    """One pass over the training texts in ``rounds``; the tables on the driver have a fixed size."""
    sc = blocks.sparkSession.sparkContext
    weights = Weights(model)
    n_tasks = max(sc.defaultParallelism, -(-model.tokens // (task_tokens * rounds)))
    n_slices = ROWS // SLICE_ROWS
    for turn in range(rounds):
        tables, seen = weights.tables, weights.seen

        def updates(batches: Iterable[pa.RecordBatch], tables=tables, seen=seen, turn=turn) -> Iterator[pa.RecordBatch]:
            local = Weights(model, tables.copy(), seen.copy())
            for batch in batches:
                for at in range(batch.num_rows):
                    block = Block(batch, at, model, turn, rounds)
                    target = block.leaves(2)  # a word seen once is unknown without this place
                    for start in range(0, len(target), batch_tokens):
                        some = slice(start, start + batch_tokens)
                        local.batch([f[some] for f in block.features], target[some], rate)
            gained, part = local.seen - seen, TaskContext.get().partitionId()
            moved = (local.tables - tables) * gained[:, :, None]
            for t in range(2 * FEATURES):
                for s in range(n_slices):
                    span = slice(s * SLICE_ROWS, (s + 1) * SLICE_ROWS)
                    if gained[t, span].any():
                        yield _slice_row(t * n_slices + s, part % 16, gained[t, span], moved[t, span])

        found = blocks.coalesce(n_tasks).mapInArrow(updates, SLICES)
        summed = found.repartition("slice", "salt").mapInArrow(_sum_slices, SLICES).repartition("slice").mapInArrow(_sum_slices, SLICES)
        tables, seen = tables.copy(), seen.copy()
        for r in summed.toLocalIterator():
            t, s = divmod(r.slice, n_slices)
            span = slice(s * SLICE_ROWS, (s + 1) * SLICE_ROWS)
            gained = np.frombuffer(r.gained, np.float32)
            moved = np.frombuffer(r.moved, np.float32).reshape(SLICE_ROWS, WIDTH)
            tables[t, span] += moved / np.maximum(gained, 1e-20)[:, None]
            seen[t, span] += gained
        weights = Weights(model, tables, seen)
    return weights


SLICES = "slice int, salt int, gained binary, moved binary"
SLICES_ARROW = pa.schema([("slice", pa.int32()), ("salt", pa.int32()), ("gained", pa.binary()), ("moved", pa.binary())])


def _slice_row(number: int, salt: int, gained: np.ndarray, moved: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"slice": number, "salt": salt, "gained": gained.astype(np.float32).tobytes(), "moved": moved.astype(np.float32).tobytes()}], schema=SLICES_ARROW)


def _sum_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by slice; there are few slices, so a task holds at most the tables once."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for number, gained, moved in zip(batch.column("slice").to_pylist(), batch.column("gained"), batch.column("moved")):
            pair = np.frombuffer(gained.as_buffer(), np.float32), np.frombuffer(moved.as_buffer(), np.float32)
            if number in sums:
                for total, more in zip(sums[number], pair):
                    total += more
            else:
                sums[number] = tuple(x.copy() for x in pair)
    for number, (gained, moved) in sums.items():
        yield _slice_row(number, 0, gained, moved)


def score(blocks: DataFrame, model: Counts, weights: Weights, batch_tokens: int) -> DataFrame:
    """A row for every text: id, train, n_tokens, n_known, base_score, score (log10)."""

    def scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch, at, model)
                leaf = block.leaves(1)
                logs = np.concatenate([weights.batch([f[s : s + batch_tokens] for f in block.features], leaf[s : s + batch_tokens]) for s in range(0, len(leaf), batch_tokens)])
                total = lambda x: np.add.reduceat(x, block.first)  # noqa: E731 (every text has at least its end)
                columns = [
                    pa.array(block.ids, pa.int64(), mask=block.missing), pa.array(block.train), pa.array(block.lengths.astype(np.int64)),
                    pa.array(total((block.counts > 0)[block.tokens].astype(np.int64))), pa.array(total(block.base())), pa.array(total(logs / np.log(10) + block.shares())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "train", "n_tokens", "n_known", "base_score", "score"])

    return blocks.mapInArrow(scores, "id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def score_texts(
    df: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, rate: float = 0.5, batch_tokens: int = 4096, block_bytes: int = 12 << 20, task_tokens: int = 64 << 20
) -> DataFrame:
    """One row per row of ``df``: id, ``train, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows where ``train_rows`` holds (or is null).  Tokens are the words and one end, so a null,
    empty or blank text has one token; ``n_known`` counts tokens that the training texts have; ``base_score`` is the sum
    of ``log10((c + 0.5) / (N + 0.5 (V + 1)))``, ``score`` the model's log10 probability, in which all words without a
    count are one event.  Frequent words of equal count take their leaves by the word.  Repeated rows and null ids are rows
    of their own; an empty table, or one without training rows, gives scores without learned features; other columns are
    not looked at.  A text is never cut: a block closes after ``block_bytes`` of text, and memory follows a longer text.
    Scores follow the deal of blocks to tasks in their last digits, as gradient updates do.
    """
    rows = written(encode(df, id_col, text_col, train_rows, block_bytes), "encoded", group_bytes=8 << 20)
    placed, model = count_words(rows)
    blocks = written(join_counts(rows, placed), "blocks", group_bytes=8 << 20)
    weights = train(blocks, model, rounds, rate, batch_tokens, task_tokens)
    found = score(blocks, model, weights, batch_tokens)
    return found.select(F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
