"""Feature stages: category indexing, one-hot encoding, scaling and vector assembly (Spark ML stages).

``FeatureSpec`` names the numeric inputs, the categorical inputs to index and one-hot encode, and the
categorical inputs used as a bare index.  ``feature_stages`` turns it into a stage list for a ``Pipeline``; all
indexers are one multi-column ``StringIndexer`` so fitting costs one pass over the data, not one per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureSpec:
    numeric: Sequence[str] = ()
    one_hot: Sequence[str] = ()  # indexed then one-hot encoded (last level dropped)
    indexed: Sequence[str] = ()  # indexed, used as a single numeric index column
    output: str = "features"
    handle_invalid: str = "error"  # StringIndexer: error | skip | keep
    scale: str | None = None  # None | "std" (unit stddev) | "zscore" (centre and unit stddev)
    drop_last: bool = True

    def __post_init__(self) -> None:  # tuples keep the spec hashable (it keys the fitted-feature cache)
        for name in ("numeric", "one_hot", "indexed"):
            object.__setattr__(self, name, tuple(getattr(self, name)))

    def assembled_inputs(self) -> list[str]:
        return list(self.numeric) + [f"{c}_index" for c in self.indexed] + [f"{c}_encoded" for c in self.one_hot]

    def check_target(self, target: str | None) -> None:
        """The target must never be a feature (directly, indexed or encoded)."""
        if target is None:
            return
        sources = set(self.numeric) | set(self.one_hot) | set(self.indexed)
        if target in sources:
            raise ValueError(f"target {target!r} is also a feature")


def string_indexer(
    cols: Sequence[str], handle_invalid: str = "error", suffix: str = "_index", order: str = "frequencyDesc"
) -> StringIndexer:
    """Index by descending frequency; equal counts are ordered by value ascending."""
    cols = list(cols)
    return StringIndexer(
        inputCols=cols,
        outputCols=[c + suffix for c in cols],
        handleInvalid=handle_invalid,
        stringOrderType=order,
    )


def level_table(df: DataFrame, c: str) -> DataFrame:
    """(level, index) by descending frequency, equal counts by value: ``StringIndexer``'s order for a column of any
    cardinality.  Levels are ranked by a range sort and never reach the driver; NULL is no level."""
    from tabml.operators.ranking import global_rank
    from tabml.operators.relational import col

    counts = df.groupBy(col(c).cast("string").alias("level")).agg(F.count("*").alias("_count")).filter("level IS NOT NULL")
    return global_rank(counts, [F.desc("_count"), F.asc("level")], "index").select("level", F.col("index").cast("double").alias("index"))


def index_by_table(df: DataFrame, c: str, levels: DataFrame, handle_invalid: str = "error", suffix: str = "_index") -> DataFrame:
    """``df`` with the index of column ``c`` from a level table, by a join that adaptive execution can broadcast or split.

    NULL and unseen values: an error when the row is computed, or ``skip`` drops them, or ``keep`` gives them the next index."""
    from tabml.operators.relational import col

    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    out, key = c + suffix, col(c).cast("string")
    joined = df.join(levels.select(F.col("level").alias("_level"), F.col("index").alias(out)), key == F.col("_level"), "inner" if handle_invalid == "skip" else "left").drop("_level")
    if handle_invalid == "error":
        bad = F.raise_error(F.concat(F.lit(f"unseen or NULL level in {c}: "), F.coalesce(key, F.lit("NULL")))).cast("double")
        joined = joined.withColumn(out, F.coalesce(col(out), bad))
    elif handle_invalid == "keep":
        size = levels.agg(F.count(F.lit(1)).cast("double").alias("_size"))  # one row
        joined = joined.crossJoin(F.broadcast(size)).withColumn(out, F.coalesce(col(out), F.col("_size"))).drop("_size")
    return joined


def label_indexer(col: str, out: str = "label", handle_invalid: str = "error") -> StringIndexer:
    return StringIndexer(inputCol=col, outputCol=out, handleInvalid=handle_invalid)


def one_hot_encoder(cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    cols = list(cols)
    return OneHotEncoder(
        inputCols=[c + "_index" for c in cols], outputCols=[c + "_encoded" for c in cols], dropLast=drop_last
    )


def assembler(inputs: Sequence[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid)


def scaler(inp: str, out: str, with_mean: bool = False, with_std: bool = True) -> StandardScaler:
    """Unit (sample) standard deviation; ``with_mean`` also centres, which densifies sparse input."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=with_mean, withStd=with_std)


def feature_stages(spec: FeatureSpec) -> list:
    stages: list = []
    cats = list(dict.fromkeys(list(spec.indexed) + list(spec.one_hot)))
    if cats:
        stages.append(string_indexer(cats, spec.handle_invalid))
    if spec.one_hot:
        stages.append(one_hot_encoder(spec.one_hot, spec.drop_last))
    raw_out = spec.output if spec.scale is None else spec.output + "_raw"
    stages.append(assembler(spec.assembled_inputs(), raw_out))
    if spec.scale == "std":
        stages.append(scaler(raw_out, spec.output, with_mean=False, with_std=True))
    elif spec.scale == "zscore":
        stages.append(scaler(raw_out, spec.output, with_mean=True, with_std=True))
    elif spec.scale is not None:
        raise ValueError(f"unknown scale {spec.scale!r}")
    return stages


def fit_features(spec: FeatureSpec, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=feature_stages(spec)).fit(df)


def vector_columns(vec: str, names: Sequence[str]) -> list:
    """Vector -> named double columns (vectors never leave a query)."""
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(n) for i, n in enumerate(names)]


def index_labels(model: PipelineModel | StringIndexer, col: str) -> list[str]:
    """Level names of one indexed column (bounded by the column's cardinality)."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    for st in stages:
        in_cols = st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]
        if col in in_cols and hasattr(st, "labelsArray"):
            return list(st.labelsArray[in_cols.index(col)])
    raise KeyError(col)
