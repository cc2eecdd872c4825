"""Boosted-tree forecasts over a panel, trained with Spark's own distributed trees.

One model per fold learns from all series together (their lags carry the level),
so the fit scales with the cluster and the driver loops over folds only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators import windows
from tidetable.operators.panel import Keys, as_list, columns_with_prefix, present_columns
from tidetable.session import materialize

TARGET_LAGS = (1, 2, 3, 6, 12)


@dataclass(frozen=True)
class FeatureSet:
    name: str
    features: tuple[str, ...]


def add_calendar_and_target_lags(
    df: DataFrame, target: str, key: Keys = "series_key", time: str = "month"
) -> DataFrame:
    return windows.target_lags(df, target, TARGET_LAGS, key, time).withColumn("month_of_year", F.month(time))


def feature_sets(
    df: DataFrame, target: str, drivers: Sequence[str], selected: Sequence[str]
) -> list[FeatureSet]:
    """The four variants: target lags; plus drivers; lagged drivers plus target lags; selected drivers."""
    own = present_columns(df, [f"{target}_lag_{k}" for k in TARGET_LAGS], "for the target lags", required=True)
    now = present_columns(df, drivers)
    lagged = columns_with_prefix(df, [f"{d}_lag_" for d in drivers], own)
    return [
        FeatureSet("calendar_and_target", ("month_of_year", *own)),
        FeatureSet("with_drivers", ("month_of_year", *own, *now)),
        FeatureSet("lagged_drivers", (*lagged, *own)),
        FeatureSet("selected", tuple(present_columns(df, selected, "among the selected drivers", required=True))),
    ]


def regressor(*, trees: int = 200, depth: int = 3, rate: float = 0.05, sample: float = 0.8, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_fit",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=sample,
        featureSubsetStrategy="0.8",
        seed=seed,
    )


def boosted_backtest(
    df: DataFrame,
    target: str,
    feature_set: FeatureSet,
    key: Keys = "series_key",
    time: str = "month",
    *,
    folds: int = 1,
    model: GBTRegressor | None = None,
    log_target: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Predictions of the last ``folds`` months and the importance of each feature per fold.

    Fold ``f`` trains on every earlier month of every series and predicts one
    month.  Rows with a missing feature are left out, as there is no value to
    split on.
    """
    keys = as_list(key)
    label = numeric.safe_ln(target) if log_target else F.col(target)
    rows = df.withColumn("_label", label).na.drop(subset=["_label", *feature_set.features])
    assembler = VectorAssembler(inputCols=list(feature_set.features), outputCol="_features")
    # one written table serves every fold's many passes
    rows = materialize(rows.select(*keys, time, target, "_label", *feature_set.features), "boosted")
    last = rows.agg(F.max(time).alias("last")).first()["last"]
    spark = df.sparkSession
    names = F.array(*[F.lit(f) for f in feature_set.features])
    predictions, importances = [], []
    for fold in range(1, folds + 1):
        cutoff = F.add_months(F.lit(last), fold - folds)
        train = assembler.transform(rows.filter(F.col(time) < cutoff))
        test = assembler.transform(rows.filter(F.col(time) == cutoff))
        fitted = (model or regressor()).fit(train)
        back = F.exp("_fit") if log_target else F.col("_fit")
        predictions.append(
            fitted.transform(test).select(
                *keys, time, F.lit(fold).alias("fold"), F.lit(1).alias("step"),
                F.col(target).alias("actual"), F.lit(feature_set.name).alias("model"), back.alias("prediction"),
            )
        )
        weights = F.array(*[F.lit(float(x)) for x in fitted.featureImportances.toArray()])
        importances.append(
            spark.range(1).select(
                F.lit(fold).alias("fold"), F.inline(F.arrays_zip(names.alias("feature"), weights.alias("importance")))
            )
        )
    result, importance = predictions[0], importances[0]
    for p, i in zip(predictions[1:], importances[1:]):
        result, importance = result.unionByName(p), importance.unionByName(i)
    return result, importance


