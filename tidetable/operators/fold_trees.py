"""Boosted trees for every expanding fold of every series in one pass.

Spark deals the series and feature sets out; the rows of one series, which the calendar bounds, are fitted together.  All
folds of a series grow side by side: their training sets are prefixes in time, so a fold is a mask over the same sorted
columns, and running sums along each column give the gain of every split of every fold at once.  A split stands half way
between two training values of its fold, and the rows that a tree draws depend on the row and the tree alone; so a fold
is what a fit of its training rows by themselves would be, and later rows cannot move it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.functions import numeric
from tidetable.operators.panel import Keys, as_list
from tidetable.operators.trees import FeatureSet

#: Cells (fold, node, column, row) that are held at once.
_CELLS = 1 << 21


@dataclass(frozen=True)
class Boosting:
    """Trees and their depth, learning rate, shares of rows and columns of a tree, ridge of a leaf, first window, seed."""

    trees: int = 200
    depth: int = 3
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    ridge: float = 1.0
    initial_window: int = 60
    seed: int = 42


def _drawn(rows: int, columns: int, how: Boosting) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows (trees x rows) and columns that each tree sees; a row's draws do not depend on how many there are."""
    share = np.array([np.random.default_rng([how.seed, r]).random(how.trees) for r in range(rows)]).reshape(rows, how.trees)
    wanted = max(1, int(np.ceil(how.columns * columns)))
    picks = [np.sort(np.random.default_rng([how.seed, 1 << 20, t]).permutation(columns)[:wanted]) for t in range(how.trees)]
    return share.T < how.rows, picks


def _best_splits(order: np.ndarray, values: np.ndarray, member: np.ndarray, slope: np.ndarray, ridge: float) -> tuple[np.ndarray, ...]:
    """(gain, column, border) of the best split of every fold and node; a gain of 0 stands for none.

    ``order`` and ``values`` are columns x rows, sorted; ``member`` (fold, node, row) marks the rows of a node, ``slope``
    (fold, row) is what they miss.
    """
    held = member[:, :, order]
    n = held.cumsum(axis=-1)
    s = np.where(held, slope[:, None, :][:, :, order], 0.0).cumsum(axis=-1)
    all_n, all_s = n[..., -1:], s[..., -1:]
    later = np.minimum.accumulate(np.where(held, values, np.inf)[..., ::-1], axis=-1)[..., ::-1]
    after = np.concatenate((later[..., 1:], np.full((*later.shape[:-1], 1), np.inf)), axis=-1)
    cuts = held & np.isfinite(after) & (after > values)
    gain = s * s / (n + ridge) + (all_s - s) ** 2 / (all_n - n + ridge) - all_s**2 / (all_n + ridge)
    flat = np.where(cuts, gain, 0.0).reshape(*gain.shape[:2], -1)
    # of gains that only rounding tells apart the first counts
    best = (flat >= flat.max(axis=-1, keepdims=True) * (1 - 1e-9)).argmax(axis=-1)
    column, place = np.divmod(best, values.shape[1])
    border = np.take_along_axis(after.reshape(flat.shape), best[..., None], -1)[..., 0] + values[column, place]
    found = np.take_along_axis(flat, best[..., None], -1)[..., 0]
    return found, column, np.where(found > 0, border / 2, 0.0)


def fit_folds(x: np.ndarray, y: np.ndarray, how: Boosting) -> tuple[np.ndarray, np.ndarray]:
    """(prediction of the row behind each fold's training rows, mean gain of each column's splits as a share).

    Row ``initial_window + f`` is predicted by fold ``f`` from the rows before it; rows stand in time order.
    """
    rows, columns = x.shape
    folds = rows - how.initial_window
    if folds <= 0:
        return np.zeros(0), np.zeros((0, columns))
    share, picks = _drawn(rows, columns, how)
    order = np.argsort(x, axis=0, kind="stable").T
    values = np.take_along_axis(x.T, order, 1)
    step = max(1, _CELLS // ((1 << (how.depth - 1)) * rows * columns))
    parts = []
    for a in range(0, folds, step):
        ends = how.initial_window + np.arange(a, min(folds, a + step))
        parts.append(_fit_some(x, y, ends, order, values, share, picks, how))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _fit_some(x, y, ends, order, values, share, picks, how: Boosting) -> tuple[np.ndarray, np.ndarray]:
    rows, columns = x.shape
    fold, row = np.arange(len(ends))[:, None], np.arange(rows)[None, :]
    train = row < ends[:, None]
    fit = np.repeat((np.cumsum(y)[ends - 1] / ends)[:, None], rows, axis=1)
    gains, splits = np.zeros((len(ends), columns)), np.zeros((len(ends), columns))
    for seen, picked in zip(share, picks):
        used = train & seen
        slope = np.where(used, y - fit, 0.0)
        node = np.zeros(fit.shape, np.int64)
        for level in range(how.depth):
            member = (node[:, None, :] == np.arange(1 << level)[None, :, None]) & used[:, None, :]
            gain, column, border = _best_splits(order[picked], values[picked], member, slope, how.ridge)
            column = picked[column]
            cut = gain > 1e-12
            node = 2 * node + (cut[fold, node] & (x[row, column[fold, node]] > border[fold, node]))
            at = np.nonzero(cut)
            np.add.at(gains, (at[0], column[at]), gain[at])
            np.add.at(splits, (at[0], column[at]), 1)
        leaf = fold * (1 << how.depth) + node
        size = len(ends) << how.depth
        total = np.bincount(leaf[used], slope[used], minlength=size) / (np.bincount(leaf[used], minlength=size) + how.ridge)
        fit += how.rate * total[leaf]
    mean = gains / np.maximum(splits, 1)
    return fit[np.arange(len(ends)), ends], mean / np.maximum(mean.sum(axis=1, keepdims=True), 1e-300)


def boosted_folds(
    df: DataFrame,
    target: str,
    sets: Sequence[FeatureSet],
    key: Keys = "series_key",
    time: str = "month",
    *,
    how: Boosting = Boosting(),
    log_target: bool = True,
) -> DataFrame:
    """Predictions of every fold of every series under every feature set, with each fold's importance by feature.

    Rows with a missing feature of a set are left out of it, as there is no value to split on; a series with no row
    behind its first window gives none.
    """
    keys = as_list(key)
    label = numeric.safe_ln(target) if log_target else F.col(target).cast("double")
    features = list(dict.fromkeys(f for s in sets for f in s.features))
    by_name = {s.name: list(s.features) for s in sets}
    measures = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.select(*keys, time, F.col(target).cast("double").alias("_actual"), label.alias("_label"), *measures).na.drop(subset=["_label"])
    each = rows.withColumn("model", F.explode(F.array(*[F.lit(s.name) for s in sets])))
    fields = [df.schema[k] for k in keys] + [
        T.StructField("model", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("step", T.IntegerType()),
        df.schema[time],
        T.StructField("actual", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("importance", T.MapType(T.StringType(), T.DoubleType())),
    ]

    def fit(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names = by_name[group[-1]]
        own = pdf.dropna(subset=names).sort_values(time)
        if len(own) <= how.initial_window:
            return pd.DataFrame()
        predicted, shares = fit_folds(own[names].to_numpy(float), own["_label"].to_numpy(float), how)
        tested = own.iloc[how.initial_window :]
        out = {k: [v] * len(tested) for k, v in zip([*keys, "model"], group)}
        out |= {"fold": np.arange(1, len(tested) + 1), "step": 1, time: tested[time].to_numpy(), "actual": tested["_actual"].to_numpy()}
        out |= {"prediction": np.exp(predicted) if log_target else predicted, "importance": pd.Series([dict(zip(names, s)) for s in shares.tolist()], dtype=object)}
        return pd.DataFrame(out)

    # so many tasks as partitions, whatever the size of the rows: the work is in the fits
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return each.repartition(tasks, *keys, "model").groupBy(*keys, "model").applyInPandas(fit, T.StructType(fields))


def importances(predictions: DataFrame, key: Keys = "series_key") -> DataFrame:
    """A row for each series, model, fold and feature."""
    return predictions.select(*as_list(key), "model", "fold", F.explode("importance").alias("feature", "importance"))
