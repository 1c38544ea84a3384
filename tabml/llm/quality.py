"""Quality rules: text statistics and a decision list learned from labelled documents.

``text_stats`` counts what the rules look at (Arrow batches).  ``learn_rules`` fits an ordered list of threshold
conjunctions by sequential covering: a rule is grown on two thirds of the labelled statistics, condition by condition,
by information gain, pruned back on the other third, and kept while it is precise there; the rows it covers are then
set aside.  The list is emitted as one Spark conditional expression and evaluated in the JVM.

The fit reads at most ``max_rows`` labelled rows (by hash of the id); statistics and verdicts cover all documents.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm._common import col, pack, unpack, written

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_exclaim"]
FEATURES = ["n_words", "mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "exclaims"]


@functools.cache
def _classes() -> np.ndarray:
    """Code point -> 0 other, 1 ASCII white space, 2 upper case, 3 other letter, 4 digit, 5 symbol, 6 exclamation mark."""
    table = np.zeros(0x110000, np.uint8)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            table[k] = 2 if c.isupper() else 3
        elif c.isdigit():
            table[k] = 4
    for c in " \t\n\x0b\x0c\r":
        table[ord(c)] = 1
    for c in SYMBOLS:
        table[ord(c)] = 5
    table[ord("!")] = 6
    return table


def repeat_words(words: list) -> int:
    """Words in 3-word windows that occur twice or more, each word once."""
    n = len(words)
    if n < 4:
        return 0
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:  # three ids would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(windows, again))
    held = np.zeros(n, bool)
    for k in range(3):
        held[at + k] = True
    return int(held.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    kinds = np.bincount(_classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=7)
    lines = [s for s in raw.split(b"\n") if s.strip()]
    return (len(words), int(len(text) - kinds[1]), int(kinds[5]), len(lines) - len(set(lines)), repeat_words(words), len(lines), int(kinds[2]), int(kinds[2] + kinds[3]), int(kinds[4]), int(kinds[6]))


def text_stats(text: Column) -> Column:
    """Struct of ``COUNTS`` (bigint); a null text counts as empty."""

    @F.pandas_udf(", ".join(f"{c} bigint" for c in COUNTS))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([count_text(t) for t in texts], columns=COUNTS, dtype="int64")

    return of(text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """The measures that conditions compare with thresholds, 0 where the divisor is."""
    share = lambda a, b: F.when(s[b] > 0, s[a] / s[b]).otherwise(0.0)
    return {
        "n_words": s["n_words"].cast("double"), "mean_word": share("word_chars", "n_words"), "symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"), "upper": share("n_upper", "n_letters"), "digits": share("n_digits", "word_chars"), "exclaims": share("n_exclaim", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.threshold if self.above else of[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return functools.reduce(np.logical_and, (c.holds(x) for c in rule), np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray, max_conditions: int, cuts: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < max_conditions and inside.any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        base, best = math.log2(p0 / (p0 + n0)) if p0 else 0.0, (0.0, None)
        for f, name in enumerate(FEATURES):
            values = np.unique(x[inside, f])
            if len(values) > cuts:
                values = np.unique(np.quantile(values, np.linspace(0, 1, cuts)))
            order = np.argsort(x[inside, f], kind="stable")
            v, hit = x[inside, f][order], bad[inside][order]
            below = np.concatenate(([0], np.cumsum(hit)))
            for t in (values[1:] + values[:-1]) / 2:
                k = int(np.searchsorted(v, t, side="right"))
                for above, p, n in ((True, p0 - below[k], len(v) - k - (p0 - below[k])), (False, below[k], k - below[k])):
                    if p and (gain := p * (math.log2(p / (p + n)) - base)) > best[0] + 1e-9:
                        best = (gain, Condition(name, above, float(t)))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].holds(x)
    return rule


def learn_rules(x: np.ndarray, bad: np.ndarray, min_precision: float = 0.95, min_rows: int = 5, max_rules: int = 12, max_conditions: int = 4, cuts: int = 256, seed: int = 0) -> list[Rule]:
    """Ordered rules that reject; empty where there is nothing to learn from."""
    rng, rules = np.random.default_rng(seed), []
    prune = rng.random(len(x)) < 1 / 3
    left = np.ones(len(x), bool)
    while len(rules) < max_rules and (left & ~prune & bad).sum() >= min_rows:
        rule = _grow(x[left & ~prune], bad[left & ~prune], max_conditions, cuts)
        if not rule:
            break
        held, truth = x[left & prune], bad[left & prune]

        def worth(r: Rule) -> float:
            p, n = truth[c := covers(r, held)].sum(), (~truth[c]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        inside = covers(rule, x) & left
        if inside.sum() < min_rows or bad[inside].mean() < min_precision or worth(rule) < 2 * min_precision - 1:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = 20_000, **options) -> list[Rule]:
    """Learn the list from ``stats`` (id, ``stats``) of documents that pass the base rules and that ``labels`` covers (label 0: reject)."""
    x = stats.filter(~base_failed(F.col("stats"))).select(col(id_col).alias("id"), *[f.alias(k) for k, f in features(F.col("stats")).items()])
    rows = x.join(F.broadcast(sample_labels(labels, id_col, label_col, max_rows)), "id").orderBy("id", *FEATURES).limit(max_rows).toPandas()
    return learn_rules(rows[FEATURES].to_numpy(float), rows["label"].to_numpy() == 0, **options)


def sample_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = 20_000) -> DataFrame:
    """At most ``max_rows`` labelled ids (id, label), the same for any partitioning: the first by hash."""
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.min("label").alias("label"))
    return known.orderBy(F.xxhash64("id"), "id").limit(max_rows)


def rejected_by(rules: list[Rule], stats: Column) -> Column:
    """The first rule that holds, as text; null if none."""
    of, out = features(stats), None
    for rule in rules:
        holds = functools.reduce(lambda a, b: a & b, (c.column(of) for c in rule))
        name = F.lit(" and ".join(map(str, rule)))
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return F.lit(None).cast("string") if out is None else out


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed, rule`` and ``kept`` to rows with a ``stats`` struct."""
    s = F.col("stats")
    return stats.withColumn("base_failed", base_failed(s)).withColumn("rule", rejected_by(rules, s)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 20_000) -> DataFrame:
    """The rows of ``df`` that pass the base rules and the learned list, all columns; learned from ``df``'s own labelled rows.

    A null or empty text has no words and fails the base rules; texts of any length are counted whole; of conditions of equal
    gain the first feature (as listed), then the first threshold is taken; repeated rows are judged alike; without usable labels
    the list is empty.  Null ids are never labelled.
    """
    chosen = sample_labels(labels, id_col, label_col, max_rows).select(F.col("id").alias("wanted"))
    mine = df.select(col(id_col).alias(id_col), col(text_col).alias("text"))
    # written before the statistics: the optimiser would else move them, and the base rules, below the semi-join
    sampled = written(mine.join(F.broadcast(chosen), col(id_col) == F.col("wanted"), "left_semi"), "sampled")
    rules = fit(sampled.select(col(id_col), text_stats(F.col("text")).alias("stats")), labels, id_col, label_col, max_rows)
    judged = judge(pack(df, text=text_col).withColumn("stats", text_stats(F.col("text"))), rules)
    return unpack(judged.filter("kept"), df.columns)
