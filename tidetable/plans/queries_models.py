"""Catalog: folds, back-tests, scores, regression and boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidetable.functions import numeric
from tidetable.operators import backtest, calendar, fold_table, fold_trees, regression, stats, trees, windows
from tidetable.operators.panel import column_report, present_columns, require_columns
from tidetable.plans import features as feature_plans
from tidetable.plans import roles
from tidetable.plans.catalog import query, report
from tidetable.plans.modelling import backtest_models, final_comparison
from tidetable.plans.roles import BASE_MONTH, HORIZON_END, LAGS, START_MONTH, month, sql
from tidetable.session import materialize

YM = "strftime(month, '%Y-%m')"
W = "OVER (PARTITION BY series_key ORDER BY month)"
# 60 rows first, one step ahead: every row after the 60th is a test row
TESTS = f"""SELECT series_key, month, rn - 60 AS fold, price AS actual, l1, l12 FROM
    (SELECT series_key, month, price, row_number() {W} AS rn, lag(price, 1) {W} AS l1, lag(price, 12) {W} AS l12 FROM prices) WHERE rn > 60"""
PREDICTIONS = """SELECT series_key, month, fold, actual, 'naive' AS model, l1 AS prediction FROM tests
    UNION ALL SELECT series_key, month, fold, actual, 'seasonal_naive', l12 FROM tests"""
SCORED = """SELECT series_key, model, avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse,
    avg(CASE WHEN actual <> 0 THEN abs(actual - prediction) / actual END) * 100 AS mape,
    avg(CASE WHEN da IS NULL THEN NULL WHEN sign(da) = sign(dp) THEN 1.0 ELSE 0.0 END) AS directional_accuracy, count(*) AS n_obs FROM
    (SELECT *, actual - lag(actual) OVER w AS da, prediction - lag(prediction) OVER w AS dp FROM predictions
     WHERE actual IS NOT NULL AND prediction IS NOT NULL WINDOW w AS (PARTITION BY series_key, model ORDER BY month)) GROUP BY 1, 2"""


def _price(spark, sf_dir):
    return roles.prices(spark, sf_dir).select("series_key", "month", "price")


def _naive(spark, sf_dir):
    return backtest.naive_backtest(_price(spark, sf_dir), "price")


# --- folds --------------------------------------------------------------------


@query(
    "M1 J18",
    sql(
        """SELECT series_key, fold, fold + 59 AS train_end FROM (SELECT series_key, unnest(range(1, n - 59)) AS fold
        FROM (SELECT series_key, count(*) AS n FROM prices GROUP BY 1) WHERE n >= 61)""",
        "prices",
    ),
)
def folds(spark, sf_dir):
    return report(backtest.fold_table(_price(spark, sf_dir)))


@query(
    "J18 W11 M1",
    sql(
        """SELECT f.series_key, f.fold, count(*) AS n_train, max(r.qty) AS train_max, sum(r.qty) AS train_qty FROM
        (SELECT series_key, unnest(range(1, n - 59)) AS fold FROM (SELECT series_key, count(*) AS n FROM prices GROUP BY 1) WHERE n >= 61) f
        JOIN (SELECT series_key, qty, row_number() OVER (PARTITION BY series_key ORDER BY month) AS rn FROM prices) r
        ON r.series_key = f.series_key AND r.rn <= f.fold + 59 GROUP BY 1, 2""",
        "prices",
    ),
)
def fold_training(spark, sf_dir):
    past = windows.expanding(
        roles.prices(spark, sf_dir).select("series_key", "month", "qty"),
        {"n_train": F.count("qty"), "train_max": F.max("qty"), "train_qty": F.sum("qty")},
    )
    return report(backtest.test_rows(past).select("series_key", "fold", "n_train", "train_max", "train_qty"))


@query(
    "M10",
    sql("SELECT series_key, count(*) AS n_rows, count(*) < 10 AS is_excluded FROM spend GROUP BY 1", "spend"),
)
def row_minimum(spark, sf_dir):
    return report(backtest.row_counts(roles.spend(spark, sf_dir), minimum=10))


# --- naive models and scores --------------------------------------------------


@query(
    "M2",
    sql(
        f"SELECT series_key, fold, 1 AS step, {YM} AS month, actual, model, prediction FROM predictions WHERE model = 'naive'",
        "prices",
        tests=TESTS,
        predictions=PREDICTIONS,
    ),
)
def naive_cv(spark, sf_dir):
    return report(_naive(spark, sf_dir).filter(F.col("model") == "naive"))


@query(
    "M3",
    sql(
        f"""SELECT r.series_key, r.rn - s.step - 59 AS fold, s.step, strftime(r.month, '%Y-%m') AS month, r.price AS actual, 'seasonal_naive' AS model, p.price AS prediction
        FROM r CROSS JOIN (SELECT unnest(range(1, 4)) AS step) s JOIN (SELECT series_key, max(rn) AS n FROM r GROUP BY 1) c USING (series_key)
        LEFT JOIN r p ON p.series_key = r.series_key AND p.rn = r.rn - 11 - s.step
        WHERE r.rn - s.step >= 60 AND r.rn - s.step <= c.n - 3""",
        "prices",
        r=f"SELECT series_key, month, price, row_number() {W} AS rn FROM prices",
    ),
)
def seasonal_naive_cv(spark, sf_dir):
    out = backtest.naive_backtest(_price(spark, sf_dir), "price", horizon=3)
    return report(out.filter(F.col("model") == "seasonal_naive"))


@query(
    "A21 A22 A33 A9 X2",
    sql(
        """SELECT series_key, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape,
        round(directional_accuracy, 6) AS directional_accuracy, n_obs, n_folds FROM scored
        JOIN (SELECT series_key, model, count(DISTINCT fold) AS n_folds FROM predictions GROUP BY 1, 2) USING (series_key, model)""",
        "prices",
        tests=TESTS,
        predictions=PREDICTIONS,
        scored=SCORED,
    ),
)
def metrics_by_model(spark, sf_dir):
    return report(backtest.compare_models(_naive(spark, sf_dir)))


@query(
    "A23",
    sql(
        """SELECT series_key, model, round(1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(*)), 6) + 0.0 AS r2,
        round(avg(prediction - actual), 6) + 0.0 AS bias, round(avg(abs(actual - prediction) / (actual + 1e-8) * 100), 6) AS mape_guarded
        FROM predictions GROUP BY 1, 2""",
        "prices",
        tests=TESTS,
        predictions=PREDICTIONS,
    ),
)
def r2_bias(spark, sf_dir):
    return report(stats.fit_quality(_naive(spark, sf_dir), ["series_key", "model"]))


@query(
    "A24",
    sql(
        f"""SELECT series_key, round(sqrt(avg((price - l1) * (price - l1))), 6) AS training_rmse FROM
        (SELECT series_key, price, lag(price) {W} AS l1, row_number() {W} AS rn FROM prices) WHERE rn > 13 GROUP BY 1""",
        "prices",
    ),
)
def training_rmse(spark, sf_dir):
    fitted = windows.target_lags(_price(spark, sf_dir), "price", (1,)).select(
        "series_key", "month", F.col("price").alias("actual"), F.col("price_lag_1").alias("prediction")
    )
    return report(stats.training_rmse(fitted, "series_key"))


@query(
    "A25",
    sql(
        f"""SELECT series_key, model, {YM} AS month, prediction, round(prediction - 1.96 * s, 6) AS lower_bound, round(prediction + 1.96 * s, 6) AS upper_bound
        FROM predictions JOIN (SELECT series_key, model, stddev_samp(actual - prediction) AS s FROM predictions GROUP BY 1, 2) USING (series_key, model)""",
        "prices",
        tests=TESTS,
        predictions=PREDICTIONS,
    ),
)
def residual_band(spark, sf_dir):
    out = stats.residual_band(_naive(spark, sf_dir), ["series_key", "model"])
    return report(out.drop("fold", "step", "actual"))


@query(
    "M12 U1 A33",
    sql(
        """SELECT series_key, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape,
        round(directional_accuracy, 6) AS directional_accuracy, n_obs FROM scored""",
        "prices",
        tests=TESTS,
        naive_and_mean=f"""SELECT series_key, month, rn - 60 AS fold, price AS actual, 'trailing_max' AS model, m AS prediction FROM
        (SELECT series_key, month, price, row_number() {W} AS rn, max(price) OVER (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM prices)
        WHERE rn > 65""",
        every_prediction=PREDICTIONS + " UNION ALL SELECT * FROM naive_and_mean",
        predictions="""SELECT * FROM every_prediction JOIN (SELECT series_key, month FROM every_prediction WHERE prediction IS NOT NULL
        GROUP BY 1, 2 HAVING count(DISTINCT model) = 3) USING (series_key, month)""",
        scored=SCORED,
    ),
)
def common_period_comparison(spark, sf_dir):
    layer = roles.price_layer(spark, sf_dir).select("series_key", "month", "price")
    ceiling = windows.expanding(layer, {"prediction": F.max("price")})
    other = backtest.test_rows(ceiling).filter(F.col("fold") > 5).select(
        "series_key", "fold", "step", "month", F.col("price").alias("actual"), F.lit("trailing_max").alias("model"), "prediction"
    )
    stacked = backtest.naive_backtest(layer, "price").unionByName(other)
    return report(backtest.compare_models(stacked, common_only=True).drop("n_folds"))


@query(
    "M13 A6",
    sql(
        f"""SELECT series_key, {YM} AS month, actual, l1 AS naive, l12 AS seasonal_naive FROM tests""",
        "prices",
        tests=TESTS,
    ),
)
def model_wide(spark, sf_dir):
    return report(backtest.predictions_wide(_naive(spark, sf_dir), ["naive", "seasonal_naive"]))


@query(
    "A6 M9",
    sql(
        f"""SELECT series_key, {YM} AS month, actual, round((l1 + l12) / 2, 6) AS prediction FROM tests""",
        "prices",
        tests=TESTS,
    ),
)
def averaged_predictions(spark, sf_dir):
    return report(backtest.average_predictions(_naive(spark, sf_dir), ["series_key", "month"]))


@query(
    "M11",
    sql(
        f"""SELECT f.series_key, strftime(f.month, '%Y-%m') AS month, y.import_qty AS import_qty_imputed, f.tax_imputed,
        y.import_qty - f.import_qty AS import_qty_diff, round((y.import_qty - f.import_qty) / nullif(f.import_qty, 0) * 100, 6) + 0.0 AS import_qty_pct,
        round(f.tax_imputed - f.tax, 6) + 0.0 AS tax_diff, round((f.tax_imputed - f.tax) / nullif(f.tax, 0) * 100, 6) + 0.0 AS tax_pct
        FROM (SELECT *, lag(tax) {W} AS tax_imputed FROM features) f
        LEFT JOIN features y ON y.series_key = f.series_key AND y.month = f.month - INTERVAL 12 MONTH""",
        "features",
    ),
)
def imputed_backtest(spark, sf_dir):
    df = roles.features(spark, sf_dir).select("series_key", "month", "import_qty", "tax")
    filled = backtest.impute_drivers(df, ["import_qty"], ["tax"])
    return report(backtest.imputation_gap(filled, ["import_qty", "tax"]).drop("import_qty", "tax"))


@query(
    "P20 J13 W1 M3 A21 A1 A3",
    sql(
        """SELECT series_key, round(avg(abs(price_adjusted - l12)), 6) AS mae, count(*) AS n_obs FROM
        (SELECT a.series_key, a.price_adjusted, b.price_adjusted AS l12 FROM adjusted a
         JOIN adjusted b ON b.series_key = a.series_key AND b.month = a.month - INTERVAL 12 MONTH) GROUP BY 1""",
        "prices",
        "cpi",
        adjusted=f"""SELECT series_key, month, round(price * (SELECT cpi FROM cpi WHERE month = DATE '{BASE_MONTH}') / cpi, 2) AS price_adjusted
        FROM prices JOIN cpi USING (month)""",
    ),
)
def seasonal_naive_score(spark, sf_dir):
    from tidetable.plans.silver import adjusted_prices

    adjusted = adjusted_prices(roles.prices(spark, sf_dir), roles.index(spark, sf_dir), month(BASE_MONTH))
    lagged = windows.lag_map(adjusted, {"price_adjusted": 12}, keep=["price_adjusted"])
    pairs = lagged.na.drop(how="any")
    error = numeric.absolute_error("price_adjusted", "price_adjusted_lag_12")
    return report(pairs.groupBy("series_key").agg(F.avg(error).alias("mae"), F.count(F.lit(1)).alias("n_obs")))


# --- regression ---------------------------------------------------------------


def _with_drivers(spark, sf_dir):
    """Prices with drivers on a regular calendar; drivers filled, the price left as it is."""
    aligned = calendar.align(roles.feature_layer(spark, sf_dir))
    filled = windows.seasonal_fill(aligned, ["import_qty", "order_value"])
    return windows.forward_fill(filled, ["import_qty", "order_value", "discount", "tax"])


@query("M4")
def regression_backtest(spark, sf_dir):
    spec = regression.RegressionSpec("price", log_target=True)
    return report(regression.one_step_backtest(calendar.align(_price(spark, sf_dir)), spec), 4)


# a line fitted on the rows before each row, and its error; x and y are named by the caller
EXPANDING = """SELECT *, y - (a + b * x) AS e FROM (SELECT *, regr_slope(y, x) OVER before AS b, regr_intercept(y, x) OVER before AS a, count(x) OVER before AS n_train
    FROM pairs WINDOW before AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    "M4",
    sql(
        f"""SELECT series_key, {YM} AS month, rn - 60 AS fold, 1 AS step, round(price, 1) AS actual, round(exp(a + b * x), 1) AS prediction,
        round(exp(a + b * x - 0.67449 * s), 1) AS lower_bound, round(exp(a + b * x + 0.67449 * s), 1) AS upper_bound, FALSE AS is_fallback FROM
        (SELECT *, stddev_samp(CASE WHEN rn > 60 THEN e END) OVER (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM fitted)
        WHERE rn > 60""",
        "prices",
        pairs=f"SELECT series_key, month, price, ln(price) AS y, lag(ln(price)) {W} AS x, row_number() {W} AS rn FROM prices",
        fitted=EXPANDING,
    ),
)
def one_lag_backtest(spark, sf_dir):
    """The regression on the month before alone, which SQL can fit as well."""
    spec = regression.RegressionSpec("price", lags=(1,), log_target=True)
    return report(regression.one_step_backtest(_price(spark, sf_dir), spec), 1)


@query(
    "X1",
    sql(
        f"""SELECT series_key, {YM} AS month, rn - 60 AS fold, round(price, 1) AS actual, round(a + b * x, 1) AS prediction FROM fitted WHERE rn > 60""",
        "prices",
        pairs=f"SELECT series_key, month, price, price AS y, lag(price) {W} AS x, row_number() {W} AS rn FROM prices",
        fitted=EXPANDING,
    ),
)
def fold_table_function(spark, sf_dir):
    """The same folds through a table function that SQL calls on a partitioned table."""
    fold_table.register(spark)
    _price(spark, sf_dir).withColumnRenamed("price", "value").createOrReplaceTempView("fold_prices")
    return report(spark.sql("SELECT * FROM fit_folds(TABLE(fold_prices), 60)"), 1)


@query(
    "M6 F22",
    sql(
        f"""SELECT series_key, {YM} AS month, rn - 36 AS fold, 1 AS step, round(price, 1) AS actual, round(CASE WHEN ok THEN fit ELSE last_price END, 1) AS prediction,
        round(CASE WHEN ok THEN fit - 0.67449 * s END, 1) AS lower_bound, round(CASE WHEN ok THEN fit + 0.67449 * s END, 1) AS upper_bound, NOT ok AS is_fallback FROM
        (SELECT *, stddev_samp(CASE WHEN rn > 36 AND ok THEN e END) OVER before AS s, lag(price) OVER (PARTITION BY series_key ORDER BY month) AS last_price FROM
         (SELECT *, a + b * x AS fit, coalesce(a + b * x BETWEEN 900 AND 1500, FALSE) AS ok FROM fitted)
         WINDOW before AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE rn > 36""",
        "features",
        pairs=f"""SELECT f.series_key, f.month, p.price, p.price AS y, CAST(f.discount AS DOUBLE) AS x, row_number() OVER (PARTITION BY f.series_key ORDER BY f.month) AS rn
        FROM features f JOIN prices p USING (series_key, month)""",
        fitted=EXPANDING,
    ),
)
def one_driver_backtest(spark, sf_dir):
    """The regression on one driver, whose forecasts out of range fall back to the last price."""
    spec = regression.RegressionSpec("price", ("discount",), lags=(), initial_window=36, low=900.0, high=1500.0)
    return report(regression.one_step_backtest(roles.features(spark, sf_dir, with_price=True), spec), 1)


@query(
    "M5",
    sql(
        """SELECT series_key, strftime(last + to_months(CAST(step AS INT)), '%Y-%m') AS month, step, round(exp(fit), 1) AS prediction,
        round(exp(fit - 0.67449 * s * sqrt(grown)), 1) AS lower_bound, round(exp(fit + 0.67449 * s * sqrt(grown)), 1) AS upper_bound, FALSE AS is_fallback FROM ahead""",
        "prices",
        pairs=f"SELECT series_key, month, ln(price) AS y, lag(ln(price)) {W} AS x, row_number() {W} AS rn FROM prices",
        fitted=EXPANDING,
        final="""SELECT series_key, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, stddev_samp(CASE WHEN rn > 60 THEN e END) AS s,
        max(month) AS last, arg_max(y, month) AS y FROM fitted GROUP BY 1""",
        ahead="""SELECT series_key, CAST(1 AS BIGINT) AS step, last, a, b, s, a + b * y AS fit, CAST(1 AS DOUBLE) AS grown, b * b AS weight FROM final
        UNION ALL SELECT series_key, step + 1, last, a, b, s, a + b * fit, grown + weight, weight * b * b FROM ahead WHERE step < 6""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def one_lag_forecast(spark, sf_dir):
    """Six months ahead by the month before alone; an error goes on through the lag, so the bounds grow."""
    prices = roles.price_layer(spark, sf_dir).select("series_key", "month", "price")
    last = prices.groupBy("series_key").agg(F.max("month").alias("last"))
    future = last.select("series_key", F.explode(F.sequence(F.add_months("last", 1), F.add_months("last", 6), F.expr("interval 1 month"))).alias("month"))
    return report(regression.forecast(prices, future, regression.RegressionSpec("price", lags=(1,), log_target=True)), 1)


@query("C18 M12")
def model_comparison(spark, sf_dir):
    """Scores of the naive models, two regressions and the boosted trees over the months that all of them predicted."""
    df = _with_drivers(spark, sf_dir)
    fitted, _ = _trees(spark, sf_dir)
    specs = {
        "seasonal_regression": regression.RegressionSpec("price", log_target=True),
        "driver_regression": regression.RegressionSpec("price", ("import_qty", "discount"), log_target=True),
    }
    return report(final_comparison(materialize(df, "drivers"), "price", specs, [fitted], initial_window=36), 4)


@query("M6 F22 X1")
def driver_backtest(spark, sf_dir):
    spec = regression.RegressionSpec("price", ("import_qty", "discount"), log_target=True, low=0.0, high=100000.0)
    return report(regression.one_step_backtest(_with_drivers(spark, sf_dir), spec), 4)


@query("M11 M6")
def imputed_driver_backtest(spark, sf_dir):
    """Errors of the driver regression with known drivers beside those with imputed ones."""
    drivers = ("import_qty", "discount")
    imputed = backtest.impute_drivers(_with_drivers(spark, sf_dir), ["import_qty"], ["discount"])
    df = materialize(imputed, "imputed")
    known = regression.RegressionSpec("price", drivers, log_target=True)
    blind = regression.RegressionSpec(
        "price", drivers, log_target=True, predict_with={"import_qty": "import_qty_imputed", "discount": "discount_imputed"}
    )
    both = regression.one_step_backtest(df, known).withColumn("model", F.lit("known_drivers")).unionByName(
        regression.one_step_backtest(df, blind).withColumn("model", F.lit("imputed_drivers"))
    )
    return report(backtest.compare_models(both), 4)


@query("M5 A26")
def regression_forecast(spark, sf_dir):
    drivers = ["import_qty", "discount"]
    layer = roles.feature_layer(spark, sf_dir)
    extended = feature_plans.filled_features(layer.select("series_key", "month", "price", *drivers), ["import_qty"], end=month(HORIZON_END))
    # the calendar fill of the price serves the months without sales inside the history only
    last = layer.groupBy("series_key").agg(F.max("month").alias("last"))
    dated = materialize(extended.join(last, "series_key"), "extended")
    history = dated.filter(F.col("month") <= F.col("last")).drop("last")
    future = dated.filter(F.col("month") > F.col("last")).drop("last", "price")
    spec = regression.RegressionSpec("price", tuple(drivers), log_target=True)
    return report(regression.forecast(history, future, spec), 4)


# --- boosted trees ------------------------------------------------------------


def _tree_rows(spark, sf_dir):
    layer = roles.feature_layer(spark, sf_dir)
    now = layer.drop("price")
    gold = feature_plans.gold_features(now, layer.select("series_key", "month", "price"), LAGS, start=month(START_MONTH))
    return trees.add_calendar_and_target_lags(gold.join(now, ["series_key", "month"]), "price")


def _trees(spark, sf_dir):
    """Predictions of all folds from the first window on under all four feature sets, and the features' mean importance."""
    df = require_columns(_tree_rows(spark, sf_dir), ["series_key", "month", "price"])
    drivers = present_columns(df, ["import_qty", "order_value", "discount", "tax"])
    sets = trees.feature_sets(df, "price", drivers, ["import_qty_lag_0", "discount_lag_1"])
    return backtest_models(df, "price", sets, how=fold_trees.Boosting(initial_window=36))


@query("M7 X1")
def gbt_forecast(spark, sf_dir):
    """Boosted trees on all four feature sets and all folds, with the leading feature of each series and set."""
    predictions, importance = _trees(spark, sf_dir)
    top = importance.groupBy("series_key", "model").agg(
        F.max("importance").alias("top_importance"), F.max_by("feature", F.struct("importance", "feature")).alias("top_feature")
    )
    return report(predictions.join(top, ["series_key", "model"]), 4)


@query("A34 T2")
def gbt_importance(spark, sf_dir):
    """Mean importance of each feature over all folds, the greatest first."""
    _, importance = _trees(spark, sf_dir)
    return report(importance.orderBy(F.desc("importance"), "series_key", "model", "feature"), 4)


@query("M9 A21")
def gbt_scores(spark, sf_dir):
    """Scores of the trees, from actuals and predictions averaged by month over the folds that predicted it."""
    predictions, _ = _trees(spark, sf_dir)
    monthly = backtest.average_predictions(predictions, ["series_key", "model", "month"])
    return report(stats.scores(monthly, ["series_key", "model"], "month"), 4)


# --- models that SQL can fit as well ------------------------------------------

SMALL = fold_trees.Boosting(trees=2, depth=1, rate=0.5, rows=1.0, columns=1.0, initial_window=36)


def _stump_tables(rounds: int, rate: float) -> dict[str, str]:
    """SQL of boosted stumps on two columns: every fold's rows beside its test row, and what they miss after each round."""
    tables = {
        "series": f"""SELECT f.series_key, f.month, p.price, ln(p.price) AS y, CAST(f.import_qty AS DOUBLE) AS x0, CAST(f.discount AS DOUBLE) AS x1,
        row_number() OVER (PARTITION BY f.series_key ORDER BY f.month) AS rn FROM features f JOIN prices p USING (series_key, month)""",
        "fit_0": """SELECT *, avg(CASE WHEN used THEN y END) OVER (PARTITION BY series_key, fold) AS fit FROM
        (SELECT a.series_key, b.rn - 36 AS fold, a.month, a.price, a.y, a.x0, a.x1, a.rn < b.rn AS used FROM series a JOIN series b
        ON a.series_key = b.series_key AND a.rn <= b.rn WHERE b.rn > 36)""",
    }
    for k in range(1, rounds + 1):
        tables[f"sums_{k}"] = f"""SELECT series_key, fold, c, x, count(*) AS n, sum(miss) AS s FROM
        (SELECT series_key, fold, unnest([0, 1]) AS c, unnest([x0, x1]) AS x, y - fit AS miss FROM fit_{k - 1} WHERE used) GROUP BY 1, 2, 3, 4"""
        tables[f"gains_{k}"] = f"""SELECT series_key, fold, c, x, (x + after) / 2 AS border, s * s / (n + 1) + (all_s - s) * (all_s - s) / (all_n - n + 1) - all_s * all_s / (all_n + 1) AS gain FROM
        (SELECT series_key, fold, c, x, sum(n) OVER up AS n, sum(s) OVER up AS s, sum(n) OVER whole AS all_n, sum(s) OVER whole AS all_s, lead(x) OVER up AS after FROM sums_{k}
        WINDOW up AS (PARTITION BY series_key, fold, c ORDER BY x), whole AS (PARTITION BY series_key, fold, c)) WHERE after IS NOT NULL"""
        tables[f"split_{k}"] = f"""SELECT series_key, fold, c, border, gain FROM
        (SELECT *, max(gain) OVER (PARTITION BY series_key, fold) AS most FROM gains_{k}) WHERE gain > 1e-12 AND gain >= most * (1 - 1e-9)
        QUALIFY row_number() OVER (PARTITION BY series_key, fold ORDER BY c, x) = 1"""
        tables[f"fit_{k}"] = f"""SELECT * EXCLUDE (fit, side), fit + {rate} * sum(CASE WHEN used THEN y - fit ELSE 0 END) OVER leaf / (count(*) FILTER (WHERE used) OVER leaf + 1) AS fit FROM
        (SELECT t.*, coalesce(CASE WHEN c = 0 THEN x0 ELSE x1 END > border, FALSE) AS side FROM fit_{k - 1} t LEFT JOIN split_{k} USING (series_key, fold))
        WINDOW leaf AS (PARTITION BY series_key, fold, side)"""
    return tables


STUMPS = _stump_tables(SMALL.trees, SMALL.rate)
SPLITS = " UNION ALL ".join(f"SELECT * FROM split_{k}" for k in range(1, SMALL.trees + 1))


def _stumps(df):
    return fold_trees.boosted_folds(df, "price", [trees.FeatureSet("boosted_stumps", ("import_qty", "discount"))], how=SMALL)


@query(
    "M7 M9 A34 X1",
    sql(
        f"""SELECT series_key, 'boosted_stumps' AS model, fold, 1 AS step, {YM} AS month, round(price, 2) AS actual, round(exp(fit), 2) AS prediction,
        round(coalesce(qty_share, 0), 4) AS qty_importance FROM fit_{SMALL.trees} LEFT JOIN shares USING (series_key, fold) WHERE NOT used""",
        "features",
        "prices",
        **STUMPS,
        shares=f"""SELECT series_key, fold, sum(CASE WHEN c = 0 THEN gain ELSE 0 END) / sum(gain) AS qty_share FROM
        (SELECT series_key, fold, c, avg(gain) AS gain FROM ({SPLITS}) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    ),
)
def boosted_stumps(spark, sf_dir):
    """Two boosted stumps for every fold, and the share of the gain that the quantity has in each."""
    fitted = _stumps(roles.features(spark, sf_dir, with_price=True))
    return report(fitted.withColumn("importance", F.element_at("importance", "import_qty")).withColumnRenamed("importance", "qty_importance"), {"actual": 2, "prediction": 2, "qty_importance": 4})


@query(
    "C18 M12 A33",
    sql(
        """SELECT series_key, model, round(mae, 1) AS mae, round(rmse, 1) AS rmse, round(mape, 2) AS mape, round(directional_accuracy, 4) AS directional_accuracy, n_obs, n_folds
        FROM scored JOIN (SELECT series_key, model, count(DISTINCT fold) AS n_folds FROM predictions GROUP BY 1, 2) USING (series_key, model)""",
        "features",
        "prices",
        **STUMPS,
        lines="""SELECT *, exp(regr_intercept(y, z) OVER before + z * regr_slope(y, z) OVER before) AS one_lag,
        regr_intercept(price, x1) OVER before + x1 * regr_slope(price, x1) OVER before AS one_driver FROM
        (SELECT *, lag(y) OVER w AS z, lag(price) OVER w AS l1, lag(price, 12) OVER w AS l12 FROM series WINDOW w AS (PARTITION BY series_key ORDER BY month))
        WINDOW before AS (PARTITION BY series_key ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
        predictions=f"""SELECT series_key, month, rn - 36 AS fold, price AS actual, unnest(['naive', 'seasonal_naive', 'one_lag', 'one_driver']) AS model,
        unnest([l1, l12, one_lag, one_driver]) AS prediction FROM lines WHERE rn > 36
        UNION ALL SELECT series_key, month, fold, price, 'boosted_stumps', exp(fit) FROM fit_{SMALL.trees} WHERE NOT used""",
        scored=SCORED,
    ),
)
def five_model_comparison(spark, sf_dir):
    """The final comparison of naive models, two regressions and trees, each so small that SQL can fit it too."""
    df = roles.feature_layer(spark, sf_dir)
    specs = {
        "one_lag": regression.RegressionSpec("price", lags=(1,), initial_window=36, log_target=True),
        "one_driver": regression.RegressionSpec("price", ("discount",), lags=(), initial_window=36),
    }
    scores = final_comparison(df, "price", specs, [_stumps(df)], initial_window=36)
    return report(scores, {"mae": 1, "rmse": 1, "mape": 2, "directional_accuracy": 4})


@query(
    "P23 P24",
    sql(
        """SELECT 'import_qty' AS column_name, TRUE AS is_present, count(import_qty) AS n_values FROM features
        UNION ALL SELECT 'discount', TRUE, count(discount) FROM features UNION ALL SELECT 'no_such_column', FALSE, 0""",
        "features",
    ),
)
def column_checks(spark, sf_dir):
    """Which wanted columns a table has, and how many values each holds."""
    df = require_columns(roles.features(spark, sf_dir), ["series_key", "month"])
    return report(column_report(df, ["import_qty", "no_such_column", "discount"]))


# a row counts for a set if all its features are there; gold rows are complete, so only the target's lags decide
SETS = {"calendar_and_target": (6, 12), "with_drivers": (10, 12), "lagged_drivers": (9, 12), "selected": (2, 0)}


@query(
    "M8 P23",
    sql(
        " UNION ALL ".join(f"SELECT series_key, '{name}' AS model, {size} AS n_features, greatest(n - {lost}, 0) AS n_rows FROM gold" for name, (size, lost) in SETS.items()),
        "features",
        gold=f"""SELECT f.series_key, count(*) AS n FROM features f JOIN features a ON a.series_key = f.series_key AND a.month = f.month - INTERVAL 2 MONTH
        JOIN features b ON b.series_key = f.series_key AND b.month = f.month - INTERVAL 1 MONTH
        JOIN features c ON c.series_key = f.series_key AND c.month = f.month - INTERVAL 7 MONTH WHERE f.month >= DATE '{START_MONTH}' GROUP BY 1""",
    ),
)
def feature_set_columns(spark, sf_dir):
    """Complete rows per feature set: what each variant can train on."""
    df = _tree_rows(spark, sf_dir)
    sets = trees.feature_sets(df, "price", ["import_qty", "order_value", "discount", "tax"], ["import_qty_lag_0", "discount_lag_1"])
    complete = []
    for s in sets:
        ok = F.lit(True)
        for c in s.features:
            ok = ok & F.col(c).isNotNull()
        complete.append(F.struct(F.lit(s.name).alias("model"), F.lit(len(s.features)).alias("n_features"), ok.alias("ok")))
    cells = df.select("series_key", F.array(*complete).alias("_cells")).select("series_key", F.inline("_cells"))
    return report(cells.groupBy("series_key", "model", "n_features").agg(F.count_if("ok").alias("n_rows")))


@query(
    "T2",
    sql(
        """SELECT series_key, feature, round(avg(importance), 6) AS importance FROM
        (SELECT series_key, month, unnest(['discount', 'tax']) AS feature, unnest([discount, tax]) AS importance FROM features) GROUP BY 1, 2""",
        "features",
    ),
)
def mean_importance(spark, sf_dir):
    long = roles.features(spark, sf_dir).unpivot(["series_key", "month"], ["discount", "tax"], "feature", "importance")
    return report(stats.mean_importance(long, "series_key").orderBy(F.desc("importance")))
