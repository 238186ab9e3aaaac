"""Feature stages: category indexing, one-hot encoding, vector assembly.

These are Spark ML stages (JVM-side). The indexer fits all of its columns
in one aggregation job; only the label lists (one entry per distinct value)
reach the driver. Encoding and assembly are per-row projections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c

INVALID_MODES = ("keep", "error", "skip")


def index_categories(cols: Sequence[str], out_cols: Sequence[str] | None = None,
                     invalid: str = "keep", suffix: str = "_idx",
                     order: str = "frequencyDesc") -> StringIndexer:
    """Category -> index by descending frequency, ties by text ascending;
    numeric columns are indexed by their text form. ``invalid``: ``keep``
    gives unseen values and nulls one extra index (the label count),
    ``error`` fails on them, ``skip`` drops the row."""
    if invalid not in INVALID_MODES:
        raise ValueError(f"invalid must be one of {INVALID_MODES}")
    cols = list(cols)
    out_cols = list(out_cols) if out_cols else [col + suffix for col in cols]
    return StringIndexer(inputCols=cols, outputCols=out_cols, handleInvalid=invalid,
                         stringOrderType=order)


def one_hot(in_cols: Sequence[str], out_cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """Index -> one-hot vector. With ``drop_last`` the last category (the
    extra unseen slot of a ``keep`` indexer, else the least frequent label)
    is the all-zero vector."""
    return OneHotEncoder(inputCols=list(in_cols), outputCols=list(out_cols), dropLast=drop_last)


def assemble(cols: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    """Columns -> one feature vector. ``invalid``: ``error`` fails on null or
    NaN, ``skip`` drops such rows, ``keep`` emits NaN."""
    if invalid not in INVALID_MODES:
        raise ValueError(f"invalid must be one of {INVALID_MODES}")
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid)


def vector_elements(col: str | Column) -> Column:
    """A vector column as ``array<double>`` (for SQL-side inspection)."""
    return vector_to_array(c(col))


def one_hot_slot(col: str | Column) -> Column:
    """Position of the 1 in a one-hot vector, -1 for the all-zero vector."""
    return (F.array_position(vector_to_array(c(col)), F.lit(1.0)) - 1).cast("int")


def vector_width(col: str | Column) -> Column:
    """Length of a vector column."""
    return F.size(vector_to_array(c(col))).cast("int")


def index_mapping(model, df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``(value, index)`` for every distinct value of ``col`` in ``df`` under a
    fitted (possibly multi-column) indexer. The distinct values are found
    distributed; the label list is the one already held by the model."""
    pos = model.getInputCols().index(col) if model.isSet("inputCols") else 0
    labels = model.labelsArray[pos]
    idx = out or (model.getOutputCols()[pos] if model.isSet("outputCols") else model.getOutputCol())
    single = StringIndexerModel.from_labels(labels, inputCol=col, outputCol=idx,
                                            handleInvalid=model.getHandleInvalid())
    values = df.select(c(col)).where(c(col).isNotNull()).distinct()
    return single.transform(values.select(c(col).cast("string").alias(col))).select(c(col), F.col(idx))
