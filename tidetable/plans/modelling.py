"""Model comparison over feature sets and model families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.operators import backtest, fold_trees, joins, regression, stats, trees
from tidetable.operators.panel import Keys, as_list
from tidetable.session import materialize


def backtest_models(
    df: DataFrame,
    target: str,
    sets: Sequence[trees.FeatureSet],
    key: Keys = "series_key",
    time: str = "month",
    *,
    how: fold_trees.Boosting = fold_trees.Boosting(),
) -> tuple[DataFrame, DataFrame]:
    """Boosted-tree predictions of every feature set and fold, and the mean importance of each feature over the folds.

    The fits run once; both results read what they wrote.
    """
    keys = as_list(key)
    fitted = materialize(fold_trees.boosted_folds(df, target, sets, keys, time, how=how), "trees")
    importance = stats.mean_importance(fold_trees.importances(fitted, keys), [*keys, "model"])
    return fitted.drop("importance"), importance


def final_comparison(
    series: DataFrame,
    value: str,
    specs: dict[str, regression.RegressionSpec],
    others: Sequence[DataFrame] = (),
    key: Keys = "series_key",
    time: str = "month",
    *,
    initial_window: int = 60,
    common_only: bool = True,
) -> DataFrame:
    """Scores of the naive models, the given regressions and any further predictions.

    By default only the periods that every model of a series predicted are
    scored, since scores over different periods must not be ranked.
    """
    keys = as_list(key)
    columns = [*keys, "fold", "step", time, "actual", "model", "prediction"]
    frames = [backtest.naive_backtest(series, value, keys, time, initial_window=initial_window)]
    for name, spec in specs.items():
        fitted = regression.one_step_backtest(series, spec, keys, time)
        frames.append(fitted.withColumn("model", F.lit(name)))
    frames += list(others)
    stacked = joins.stack([f.select(*columns) for f in frames])
    return backtest.compare_models(stacked, keys, common_only=common_only, time=time)
