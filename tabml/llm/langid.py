"""Language identification with blended-spectrum string kernels.

``k(x, y)`` is the mean over n = 1..3 of the normalised intersection of the sets of character n-grams (presence, not
counts).  A bounded, documented sample of labelled texts gives landmarks and training rows; their kernel rows are
computed in Spark tasks.  On the driver the landmark kernel's inverse root (Nystroem) turns kernel rows into features
and ridge regression fits one language against the rest.  As a score is linear in the kernel values, and those are
linear in the presence vectors, landmarks and weights fold into one matrix for each n, and a batch of texts is scored
by three matrix products in Arrow batches.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.llm._common import col, written

ORDERS = (1, 2, 3)
SLOT_BITS = 16  # n-grams of each order are hashed to so many slots
UNKNOWN = "und"
LEAST_TEXTS = 15  # texts of each language in the sample, however many languages there are
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(k).isalpha() for k in range(0x110000)])


def spectrum(text: str | None) -> list[np.ndarray] | None:
    """Distinct n-gram slots of each order, over lower-cased letters with anything else as one space; None without letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    if not letters.any():
        return None
    kept = letters.copy()
    kept[1:] |= letters[:-1]  # the first of a run of other characters stands for the space
    chars = np.where(letters, points, 32)[kept].astype(np.uint64)
    space = np.array([32], np.uint64)
    chars = np.concatenate((space, chars, space[: 1 if chars[-1] != 32 else 0]))
    out = []
    for n in ORDERS:
        code = np.zeros(len(chars) - n + 1, np.uint64)
        for k in range(n):
            code += chars[k : k + len(code)] * _MIX[k]
        seen = np.zeros(1 << SLOT_BITS, bool)
        seen[(code * _MIX[0]) >> np.uint64(64 - SLOT_BITS)] = True
        out.append(np.flatnonzero(seen))
    return out


@dataclass
class Landmarks:
    """Slots that some landmark has (in order), and for each order the presence matrix scaled by landmark norms."""

    slots: list[np.ndarray]
    scaled: list[np.ndarray]  # (slots, landmarks)

    @classmethod
    def of(cls, texts: list[str]) -> Landmarks:
        return cls.of_spectra([s for s in map(spectrum, texts) if s is not None])

    @classmethod
    def of_spectra(cls, sets: list[list[np.ndarray]]) -> Landmarks:
        slots, scaled = [], []
        for n in range(len(ORDERS)):
            used = np.unique(np.concatenate([s[n] for s in sets])) if sets else np.zeros(0, np.int64)
            matrix = np.zeros((len(used), len(sets)), np.float32)
            for j, s in enumerate(sets):
                matrix[np.searchsorted(used, s[n]), j] = 1 / np.sqrt(len(s[n])) / len(ORDERS)
            slots.append(used)
            scaled.append(matrix)
        return cls(slots, scaled)


def project(texts: list[str | None], slots: list[np.ndarray], matrices: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(values, known): sum over orders of (presence @ matrix) / norm, one row per text; ``known`` where it has a letter."""
    sets = [spectrum(t) for t in texts]
    known = np.array([s is not None for s in sets], bool)
    width = matrices[0].shape[1]
    values = np.zeros((len(texts), width), np.float32)
    for n in range(len(ORDERS)):
        presence = np.zeros((len(texts), len(slots[n])), np.float32)
        seen = np.zeros(1 << SLOT_BITS, np.float32)
        for i, s in enumerate(sets):
            if s is not None:
                seen[s[n]] = 1 / np.sqrt(len(s[n]))
                presence[i] = seen[slots[n]]
                seen[s[n]] = 0
        values += presence @ matrices[n]
    return values, known


def fit_scores(kernel: np.ndarray, labels: np.ndarray, classes: list[str], landmark_kernel: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """(landmarks, classes) weights on kernel values: Nystroem features, then one-versus-rest ridge regression."""
    value, vector = np.linalg.eigh(landmark_kernel.astype(float))
    good = value > 1e-8 * max(value.max(initial=0.0), 1e-12)
    root = vector[:, good] / np.sqrt(value[good])
    x = kernel @ root
    y = np.where(labels[:, None] == np.array(classes)[None, :], 1.0, -1.0)
    weight = 1 / np.maximum(1, (y > 0).sum(axis=0))[np.argmax(y, axis=1)]  # each language counts alike
    weight *= len(y) / weight.sum()
    xw = x * weight[:, None]
    return root @ np.linalg.solve(xw.T @ x + ridge * len(x) * np.eye(x.shape[1]), xw.T @ y)


@dataclass
class Model:
    classes: list[str]
    slots: list[np.ndarray]
    matrices: list[np.ndarray]  # (slots, classes)
    sharpness: float = 4.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.classes:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        values, known = project(texts, self.slots, self.matrices)
        odds = np.exp(self.sharpness * (values - values.max(axis=1, keepdims=True)).astype(float))
        share = odds / odds.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [self.classes[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
        return names, np.where(known, share.max(axis=1), 0.0).tolist()


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int) -> DataFrame:
    """(lang, text, place): the first texts by hash of each language, languages alike, every language with some.

    At most ``max_rows`` in all, or ``LEAST_TEXTS`` for each language if that is more.
    """
    rows = df.select(col(lang_col).alias("lang"), col(text_col).alias("text"), F.xxhash64(col(id_col).cast("string")).alias("hash")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language_sizes")
    each = max(LEAST_TEXTS, max_rows // max(1, sizes.count()))
    # a hash threshold thins each language to about 2 * each + 50 rows before they are ranked
    kept = rows.join(sizes, "lang").withColumn("u", F.pmod("hash", F.lit(1 << 30)) / float(1 << 30))
    thin = kept.filter(F.col("u") < F.least(F.lit(1.0), F.lit(2.0 * each + 50) / F.col("n"))).drop("n")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", "hash", F.xxhash64("text")))
    return thin.withColumn("place", place).filter(F.col("place") <= each).select("lang", "text", "place")


def _batched(batches: Iterable[pa.RecordBatch], size: int = 128) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _spectra(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, place, presence bits of all orders' slots) of the texts that have a letter."""
    for part in _batched(batches):
        sets = [spectrum(t) for t in part.column("text").to_pylist()]
        known = [i for i, s in enumerate(sets) if s is not None]
        rows = part.take(pa.array(known, pa.int64()))
        bits = pa.array([_to_bits(sets[i]) for i in known], pa.binary())
        yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("place"), bits], names=["lang", "place", "bits"])


def _to_bits(slots: list[np.ndarray]) -> bytes:
    seen = np.zeros((len(ORDERS), 1 << SLOT_BITS), bool)
    for n, s in enumerate(slots):
        seen[n, s] = True
    return pa.compress(np.packbits(seen).tobytes(), codec="zstd", asbytes=True)


def _from_bits(bits: bytes) -> list[np.ndarray]:
    raw = pa.decompress(bits, len(ORDERS) << SLOT_BITS >> 3, codec="zstd", asbytes=True)
    return [np.flatnonzero(order) for order in np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(len(ORDERS), -1)]


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 3000, n_landmarks: int = 192, ridge: float = 1e-3) -> Model:
    """Train on a sample of ``df``'s labelled rows (``max_rows`` texts, ``n_landmarks`` of them landmarks).

    Every language is learned: with many, each has ``LEAST_TEXTS`` texts and one landmark, and the sample grows with them.
    """
    sample = written(training_sample(df, id_col, text_col, lang_col, max_rows), "languages")
    classes = sorted(r.lang for r in sample.select("lang").distinct().collect())
    each = max(1, n_landmarks // max(1, len(classes)))
    # spectra are computed in tasks: a landmark's text may be long, its slots are at most three times 2^SLOT_BITS bits
    found = sample.filter(F.col("place") <= each).mapInArrow(_spectra, "lang string, place int, bits binary")
    marks = Landmarks.of_spectra([_from_bits(r.bits) for r in found.orderBy("lang", "place").collect()])  # at most n_landmarks rows, or one per language
    if not marks.scaled[0].shape[1]:
        return Model([], [], [])
    shared = df.sparkSession.sparkContext.broadcast((marks.slots, marks.scaled))

    def kernel_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, scaled = shared.value
        for part in _batched(batches):
            values, known = project(part.column("text").to_pylist(), slots, scaled)
            found = pa.RecordBatch.from_arrays([part.column("lang"), pa.array(list(values), pa.list_(pa.float32()))], names=["lang", "row"])
            yield found.filter(pa.array(known))

    rows = sample.mapInArrow(kernel_rows, "lang string, row array<float>").toPandas()
    own = np.zeros((0, 0))
    for n in range(len(ORDERS)):  # landmark against landmark: presence again from the scaled matrices
        m = marks.scaled[n].astype(float) * len(ORDERS)
        own = (m.T @ m) / len(ORDERS) + (own if own.size else 0)
    rows = rows.sort_values("lang", kind="stable")
    weights = fit_scores(np.array(rows["row"].tolist(), float), rows["lang"].to_numpy(), classes, own, ridge)
    return Model(classes, marks.slots, [(m @ weights).astype(np.float32) for m in marks.scaled])


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, ``lang_pred``, ``score`` (0 to 1); looks at the text alone.

    A null text or one without a letter is ``und`` with score 0; texts of any length are read whole; of languages of equal
    score the first by name is taken; repeated rows are judged alike; an empty table gives
    no row; without a trained language all rows are ``und``.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # slots of the landmarks times languages: bounded

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batched(batches):
            names, scores = shared.value.predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    rows = df.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    return rows.mapInArrow(score, "id bigint, lang_pred string, score double").withColumnRenamed("id", id_col)
