"""Best-fit packing of token sequences by the configuration linear program over the length histogram, rounded.

1. ``token_pieces``: tokens per document (Arrow batches), documents over the capacity cut into pieces.
2. ``solve``: the histogram has at most ``capacity`` lengths however large the corpus, so it is planned on the driver.
   The configuration linear program (weights of multisets of lengths that fit one sequence, so that every length is
   covered) is solved fractionally by multiplicative weights, priced by knapsack dynamic programming, up to a share of
   each length; its weights are rounded down, and best fit, longest first, over counts of equal open sequences places
   what that leaves.  The prices also give a lower bound on the sequences.
3. ``pack``: pieces of a length get ranks 0, 1, 2, ... (salted windows, so that a hot length is many small groups), and
   rank and length name the place in the plan.

The plan has a bounded number of configurations (rounds plus a few for each length), which does not follow the corpus.
"""

from __future__ import annotations

import bisect
import os
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm._common import checkpointed, col, text_bytes, written

Plan = list[tuple[dict[int, int], int]]  # configurations: length -> copies, and how many sequences use it

#: ASCII punctuation that can be cut from a word's end: each run of it is a token group of its own after a letter or digit.
TAIL = '.,;:!?%*#$&|"()[]'


def _byte_letters() -> dict[int, str]:
    """Byte -> letter of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


class WordIds:
    """Token ids of space-separated chunks, kept in two generations.

    The tokenizer never joins characters across a space, so a text's ids are its chunks' ids in order.  A chunk of
    Latin letters, perhaps with ASCII punctuation behind, goes straight to the tokenizer's merges: normalisation only
    lower-cases it and it is one word.  Any other chunk goes through the whole tokenizer.  When the young generation
    has ``limit`` entries it becomes the old one; entries used again move on, so memory is bounded.
    """

    def __init__(self, tokenizer, limit: int = 400_000) -> None:
        self.tokenizer, self.merges, self.limit = tokenizer, tokenizer.model.tokenize, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _whole(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _tail(self, tail: str) -> bytes:
        if (ids := self.tails.get(tail)) is None:
            ids = self._whole(tail)
            if len(tail) <= 4:
                self.tails[tail] = ids
        return ids

    def ids(self, chunk: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a chunk."""
        if (ids := self.young.get(chunk)) is not None:
            return ids
        ids = self.old.get(chunk)
        if ids is None:
            core = chunk.rstrip(TAIL)
            if core.isalpha() and (core.isascii() or max(core) < "\u0180" and "\u0130" not in core):
                low = core.lower()
                if low == chunk:
                    found = self.merges(low if low.isascii() else low.encode().decode("latin-1").translate(BYTE_LETTERS))
                    ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
                else:
                    ids = self.ids(low) if core is chunk else self.ids(low) + self._tail(chunk[len(core) :])
            else:
                ids = self._whole(chunk)
        if len(chunk) <= 64:
            self.young[chunk] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the place where each text begins (one place more: the end).

        Every distinct chunk is looked up once."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        offsets, data = text_bytes(texts)
        spaced = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.replace(b"\n", b" "))])
        lists = pc.split_pattern(spaced, " ")
        coded = lists.flatten().dictionary_encode()
        word, owner = coded.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        found = [*map(self.ids, coded.dictionary.to_pylist())]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, firsts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        size = sizes[word]
        ends = np.cumsum(size)
        ids = flat[np.repeat(firsts[word] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        per_text = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str, limit: int) -> WordIds:
    """One tokenizer for each file and worker process; ``limit`` bounds what it keeps."""
    if path not in _WORDS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _WORDS[path] = WordIds(Tokenizer.from_file(path))
    _WORDS[path].limit = limit
    return _WORDS[path]


def _pieces(batches: Iterable[pa.RecordBatch], path: str, end_id: int, capacity: int, with_ids: bool, kept_words: int) -> Iterator[pa.RecordBatch]:
    words, end = word_ids(path, kept_words), int(end_id).to_bytes(4, "little")
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = []
            found, places = words.encode(part.column("text"))
            raw = memoryview(found.tobytes())
            for k_doc, doc_id in enumerate(part.column("id").to_pylist()):
                ids = bytes(raw[4 * places[k_doc] : 4 * places[k_doc + 1]]) + end
                for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[start : start + 4 * capacity]
                    rows.append((doc_id, k, start // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 4096, with_ids: bool = False, kept_words: int = 400_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of each document: its tokens, then ``end_id``, cut at ``capacity``.

    A null or empty text is the end id alone.  ``ids`` (little-endian unsigned 32-bit) is null unless asked for.  A worker
    keeps the ids of about twice ``kept_words`` chunks (some 200 bytes each).
    """
    rows = df.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    return rows.mapInArrow(lambda b: _pieces(b, tokenizer_path, end_id, capacity, with_ids, kept_words), schema)


class Knapsack:
    """Most valuable multisets of (length, copies at most, value each) for every room up to the capacity."""

    def __init__(self, items: list[tuple[int, int, float]], capacity: int) -> None:
        self.best, self.takes = np.zeros(capacity + 1), []
        for length, copies, value in items:
            step = 1
            while copies > 0:  # copies in powers of two
                k = min(step, copies)
                size = k * length
                if size > capacity:
                    break
                tried = self.best[: capacity + 1 - size] + k * value
                better = tried > self.best[size:]
                self.takes.append((length, k, size, better))
                self.best[size:] = np.where(better, tried, self.best[size:])
                copies, step = copies - k, 2 * step

    def fill(self, room: int) -> dict[int, int]:
        """length -> copies of the best multiset within ``room``."""
        chosen = Counter()
        for length, k, size, better in reversed(self.takes):
            if room >= size and better[room - size]:
                chosen[length] += k
                room -= size
        return dict(chosen)


def knapsack(items: list[tuple[int, int, float]], capacity: int) -> dict[int, int]:
    """Most valuable multiset of (length, copies at most, value each) within ``capacity``: length -> copies."""
    return Knapsack(items, capacity).fill(capacity)


def best_value(values: np.ndarray) -> float:
    """Most valuable multiset of lengths within the capacity, any copies: the pricing problem over all lengths.

    ``values`` by length, 0 for none; its last place is the capacity."""
    capacity = len(values) - 1
    best = np.zeros(capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max(best[room - 1], float((best[room - 1 :: -1][:room] + values[1 : room + 1]).max()))
    return float(best[-1])


@dataclass
class Fractional:
    """A fractional solution of the configuration program: weights of configurations, and the best bound found."""

    weights: dict[tuple[tuple[int, int], ...], float]
    bound: float  # no packing has fewer sequences
    rounds: int


def fractional(lengths: dict[int, int], capacity: int, rounds: int = 24, block: int = 32, share: float = 0.5, eta: float = 10.0, pace: float = 0.1, near: float = 1e-3, seed: int = 0) -> Fractional:
    """Multiplicative weights on the covering constraints (each length as often as it occurs).

    A length's price is its share of the capacity times a weight that falls exponentially with its coverage.  Each round
    prices over all lengths, which gives a lower bound by duality (prices over the best configuration's value), and then
    takes columns from random blocks of lengths and of those that complete one of them: each length of a block with the
    knapsack's best filling of the room it leaves, if it wastes no more than ``near`` of the sequence or is worth the overall best but for that.  A column gains
    weight until one of its lengths has gained ``pace`` of its need in the round.  At most ``share`` of a length is
    covered, so that what is left keeps every length.  Ends when that share is covered or after ``rounds``."""
    rng, bound = np.random.default_rng(seed), 0.0
    names = np.array(sorted(lengths))
    need = np.array([lengths[int(n)] for n in names], float)
    covered, at = np.zeros(len(names)), {int(n): k for k, n in enumerate(names)}
    weights: dict[tuple[tuple[int, int], ...], float] = {}
    done = 0
    for done in range(1, rounds + 1):
        values = np.zeros(capacity + 1)
        values[names] = price = names / capacity * np.exp(-eta * (covered - covered.min()) / need)
        best = best_value(values)
        bound = max(bound, float((need * price).sum() / best))
        room = np.minimum(share * need, covered + pace * need) - covered  # what each length may gain in the round
        open_ = np.flatnonzero(room > 0.5)
        if not len(open_):
            break
        rng.shuffle(open_)
        for start in range(0, len(open_), block):
            some = open_[start : start + block]
            beside = [at[m] for m in (capacity - names[some]).tolist() if m in at]  # lengths that fill up one of the block's
            part = sorted({*some.tolist(), *beside}, reverse=True)
            sack = Knapsack([(int(names[k]), int(capacity // names[k]), float(price[k])) for k in part], capacity)
            for k in part:
                n = int(names[k])
                if room[k] <= 0.5:
                    continue
                chosen = Counter(sack.fill(capacity - n))
                chosen[n] += 1
                worth = sum(price[at[m]] * c for m, c in chosen.items())
                if sum(m * c for m, c in chosen.items()) < (1 - near) * capacity and worth < (1 - near) * best:
                    continue
                step = min(room[at[m]] / c for m, c in chosen.items())
                if step <= 0:
                    continue
                column = tuple(sorted(chosen.items()))
                weights[column] = weights.get(column, 0.0) + step
                for m, c in chosen.items():
                    covered[at[m]] += c * step
                    room[at[m]] -= c * step
    return Fractional(weights, bound, done)


def best_fit(left: dict[int, int], capacity: int) -> Plan:
    """Best fit, longest first, over groups of equal open sequences; the work follows the lengths, not the counts."""
    rooms: list[int] = []  # sorted rooms that some group has
    groups: dict[int, list[list]] = {}  # room -> [count, (length, copies, rest)]

    def add(room: int, count: int, items) -> None:
        if room not in groups:
            bisect.insort(rooms, room)
            groups[room] = []
        groups[room].append([count, items])

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            group = groups[room][-1]
            used = min(count, group[0])
            group[0] -= used
            if not group[0]:
                groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            add(room - length, used, (length, 1, group[1]))
            count -= used
        if count:
            each = capacity // length
            if count // each:
                add(capacity - each * length, count // each, (length, each, None))
            if count % each:
                add(capacity - count % each * length, 1, (length, count % each, None))
    plan = []
    for found in groups.values():
        for count, items in found:
            chosen = Counter()
            while items:
                chosen[items[0]] += items[1]
                items = items[2]
            plan.append((dict(chosen), count))
    return plan


def solve(lengths: dict[int, int], capacity: int, scales: tuple[float, ...] = (1, 1 / 2, 1 / 4, 1 / 8, 1 / 16), **options) -> Plan:
    """Sequences for all pieces of the histogram: the fractional solution rounded down, best fit for what that leaves.

    The weights are rounded at each of ``scales``, as a smaller share leaves best fit more to choose from; the rounding
    that needs the fewest sequences is the plan (of equal ones, the larger scale)."""
    if not lengths:
        return []
    found, plans = fractional(lengths, capacity, **options), []
    for scale in scales:
        rounded = [(dict(column), int(weight * scale)) for column, weight in found.weights.items() if weight * scale >= 1]
        left = Counter(lengths)
        for column, times in rounded:
            left.subtract({n: c * times for n, c in column.items()})
        plans.append(rounded + best_fit({n: k for n, k in left.items() if k}, capacity))
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def slots(plan: Plan) -> tuple[np.ndarray, ...]:
    """(key, sequence, offset, first rank): a run of places for each configuration, length and copy, sorted by length and rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                runs.setdefault(length, []).append((sequence, offset, times))
                offset += length
        sequence += times
    rows = []
    for length in sorted(runs):
        rank = 0
        for first, offset, times in runs[length]:
            rows.append((length << RANK_BITS | rank, first, offset, rank))
            rank += times
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4


RANK_BITS = 48  # ranks below 2^48, lengths below 2^15


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (any columns with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset`` added.

    Every piece is placed once; sequences are gapless from 0 and hold at most ``capacity``.  Equal lengths are
    interchangeable, so rows repeated whole need no identity.  Earlier ``sequence_id`` and ``offset`` columns are
    replaced.  ``pieces`` is read three times: pass a written table.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    lengths = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    if any(not 1 <= n <= capacity for n in lengths):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    places = spark.sparkContext.broadcast(slots(solve(lengths, capacity)))  # size bounded by the plan
    salts = max(256, sum(lengths.values()) // 1_000_000)
    salted = pieces.withColumn("_pack_salt", F.pmod(F.xxhash64(*pieces.columns), F.lit(salts)))
    sizes = salted.groupBy("length", "_pack_salt").agg(F.count(F.lit(1)).alias("_pack_n"))
    before = Window.partitionBy("length").orderBy("_pack_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = checkpointed(sizes.select("length", "_pack_salt", F.coalesce(F.sum("_pack_n").over(before), F.lit(0)).alias("_pack_first")))
    ranked = salted.withColumn("_pack_row", F.row_number().over(Window.partitionBy("length", "_pack_salt").orderBy(*pieces.columns)))
    ranked = ranked.join(firsts, ["length", "_pack_salt"]).select(*[col(c) for c in pieces.columns], (F.col("_pack_first") + F.col("_pack_row") - 1).alias("_pack_rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    given, names = pieces.columns, schema.names

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, offset, rank0 = places.value
        for batch in batches:
            rank = batch.column("_pack_rank").to_numpy()
            at = np.searchsorted(key, batch.column("length").to_numpy() << RANK_BITS | rank, side="right") - 1
            kept = [batch.column(c) for c in given]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(first[at] + rank - rank0[at]), pa.array(offset[at])], names=names)

    return ranked.mapInArrow(place, schema)


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 4096, with_ids: bool = False, kept_words: int = 400_000) -> DataFrame:
    """Every document's pieces with their places: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    Null and empty texts are one piece of the end id; documents over ``capacity`` are cut, others never; repeated rows
    are packed each; extra columns are not looked at; an empty table gives no row.
    """
    pieces = written(token_pieces(df, tokenizer_path, id_col, text_col, end_id, capacity, with_ids, kept_words), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids -> (sequence_id, length, ids, doc_starts): a training sequence in one row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``capacity`` tokens
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p.ids))
    return grouped.select("sequence_id", "length", joined.alias("ids"), F.col("parts.offset").alias("doc_starts"))
