"""Exact deduplication by Grace hashing: records are partitioned, recursively, until an open-addressing table holds a bucket.

1. Each input partition keeps one content per local class in a bounded table, so that a group of copies, however hot,
   ships at most one content per partition and table; the members carry their local class.
2. The contents are shuffled by digest.  A task that gets more than ``table_bytes`` of distinct content partitions
   what it has and what follows into spill files by the digest's next digit and goes on with each file, recursively.
   Spill files live in the task's own temporary folder and only as long as the task; a lost task starts anew.
3. Group sizes and the row that stays come from an ordinary aggregate over the slim member rows.

Tables compare complete contents; the digest only picks slots and files.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm._common import col, written

ASCII_SPACE = b" \t\n\x0b\x0c\r"
FANOUT = 16  # one hexadecimal digit of the digest for each level


class OpenTable:
    """Open addressing with linear probing; keys are complete contents, values are class ids."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 64
        self.entries: list[tuple[bytes, bytes, int]] = []
        self.bytes = 0

    def _slot(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (k := self.slots[at]) >= 0 and self.entries[k][1] != content:
            at = (at + 1) & mask
        return at

    def find_or_add(self, digest: bytes, content: bytes, class_id: int) -> int:
        at = self._slot(digest, content)
        if self.slots[at] >= 0:
            return self.entries[self.slots[at]][2]
        self.slots[at] = len(self.entries)
        self.entries.append((digest, content, class_id))
        self.bytes += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            for k, (d, c, _) in enumerate(self.entries):
                self.slots[self._slot(d, c)] = k
        return class_id


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, ASCII_SPACE)


def local_classes(batches: Iterable[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """(rid, id, text) -> members; the first of each local class carries the content."""
    found = OpenTable()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rids, chars, digests, classes, contents = part.column("rid").to_pylist(), [], [], [], []
            for rid, text in zip(rids, part.column("text").to_pylist()):
                content = normalised(text)
                digest = hashlib.sha256(content).digest()
                if found.bytes > table_bytes:
                    found = OpenTable()
                class_id = found.find_or_add(digest, content, rid)
                chars.append(len(text or ""))
                digests.append(digest)
                classes.append(class_id)
                contents.append(content if class_id == rid else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("id"), pa.array(chars, pa.int64()), pa.array(digests, pa.binary()), pa.array(classes, pa.int64()), pa.array(contents, pa.binary())],
                names=["rid", "id", "n_chars", "digest", "local_class", "content"],
            )


def grace(records: Iterable[tuple[bool, int, bytes, bytes]], table_bytes: int, folder: str, depth: int = 0) -> Iterator[tuple[int, int]]:
    """(known, id, digest, content) -> (id, class id); ``known`` records were given a class at a level above."""
    table, records = OpenTable(), iter(records)
    digits = 2 * 32
    for known, rid, digest, content in records:
        class_id = table.find_or_add(digest, content, rid)
        if not known:
            yield rid, class_id
        if table.bytes > table_bytes and len(table.entries) > 1 and depth < digits:
            break
    else:
        return
    paths = [os.path.join(folder, f"{depth}-{k}-{digest.hex()[:depth]}") for k in range(FANOUT)]
    files = [open(p, "wb") for p in paths]
    digit = lambda d: d[depth // 2] >> 4 if depth % 2 == 0 else d[depth // 2] & 15
    for digest, content, class_id in table.entries:
        pickle.dump((True, class_id, digest, content), files[digit(digest)])
    del table
    for record in records:
        pickle.dump(record, files[digit(record[2])])
    for f in files:
        f.close()
    for p in paths:
        with open(p, "rb") as f:
            yield from grace(_spilled(f), table_bytes, folder, depth + 1)
        os.unlink(p)


def _spilled(f) -> Iterator[tuple[bool, int, bytes, bytes]]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def global_classes(batches: Iterable[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    def records():
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield from ((False, *x) for x in zip(part.column("local_class").to_pylist(), part.column("digest").to_pylist(), part.column("content").to_pylist()))

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["local_class", "class_id"])

    with tempfile.TemporaryDirectory() as folder:
        found = []
        for pair in grace(records(), table_bytes, folder):
            found.append(pair)
            if len(found) >= 10_000:
                yield out(found)
                found = []
        if found:
            yield out(found)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = 64 << 20) -> DataFrame:
    """One row per row of ``df``: id, ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after deleting ASCII white space; null, empty and blank texts are equal to each
    other.  Of equal texts the row with the most code points in its original text stays, then the smallest id (nulls
    last), then the first in the table, so that of rows repeated whole exactly one stays.  Texts of any length are compared whole, one at a
    time in a task.  An empty table gives no
    row; other columns are not looked at.  ``table_bytes`` bounds each task's table.
    """
    rows = df.select(F.monotonically_increasing_id().alias("rid"), col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    members = written(
        rows.mapInArrow(lambda b: local_classes(b, table_bytes), "rid bigint, id bigint, n_chars bigint, digest binary, local_class bigint, content binary"), "members"
    )
    contents = members.filter("content IS NOT NULL").select("local_class", "digest", "content").repartition("digest")
    classes = contents.mapInArrow(lambda b: global_classes(b, table_bytes), "local_class bigint, class_id bigint")
    placed = written(members.select("rid", "id", "n_chars", "digest", "local_class").join(classes, "local_class").drop("local_class"), "classes")
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    # written, so that both sides of the join are plain shuffles, whose hot classes adaptive execution splits
    groups = written(placed.groupBy("class_id").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return placed.join(groups, "class_id").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
