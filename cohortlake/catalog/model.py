"""Model queries.

Metric operators are checked on the fixed score ``p1 = bucket(msno) / 100``
(FIXTURES.md section 4) so that the DuckDB oracle computes the same thing;
the fitted model is checked rows-only (it is not bit-stable across engines).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlake import oracle as O
from cohortlake.catalog.io import feature_stage
from cohortlake.config import CONFIG
from cohortlake.functions.columns import hash_bucket
from cohortlake.operators import model as M
from cohortlake.plans import pipeline
from cohortlake.plans.stages import stage
from cohortlake.registry import register
from cohortlake.sinks import writers as W

GRID_VALUES = ", ".join(f"(CAST({v / 100.0} AS DOUBLE))" for v in CONFIG.threshold_grid)


def fixed_score(frame):
    return frame.select("msno", "is_churn", (hash_bucket("msno") / 100.0).alias("p1"))


def splits(spark, sf):
    """M1 over the stored feature tables (the model reads the written stage)."""
    stored = feature_stage(spark, sf)
    return M.temporal_split(stored["february"], stored["march"])


def fitted_model(spark, sf) -> PipelineModel:
    """M6 + S18: fit once per application, save to the shared folder, load back."""
    path = stage(spark, sf, "model", lambda b: M.fit(splits(spark, sf)[0]).write().overwrite().save(b))
    return PipelineModel.load(path)


O.view("feb_scored", f"SELECT msno, is_churn, CAST({O.bucket()} AS DOUBLE) / 100.0 AS p1 FROM february_features")
O.view("mar_scored", f"SELECT msno, is_churn, CAST({O.bucket()} AS DOUBLE) / 100.0 AS p1 FROM march_features")


# ----------------------------------------------------------------- M1, M2
@register("ml_split_summary", f"""
SELECT 'February model training' AS dataset, COUNT(*) AS rows FROM february_features WHERE {O.bucket()} < 80
UNION ALL SELECT 'February threshold validation', COUNT(*) FROM february_features WHERE {O.bucket()} >= 80
UNION ALL SELECT 'March untouched temporal test', COUNT(*) FROM march_features""")
def ml_split_summary(spark, sf):
    stored = feature_stage(spark, sf)
    return M.split_summary_of(stored["february"], stored["march"])


@register("ml_class_weights", f"""
WITH c AS (SELECT COUNT(*) FILTER (WHERE is_churn = 0) AS neg, COUNT(*) FILTER (WHERE is_churn = 1) AS pos
           FROM february_features WHERE {O.bucket()} < 80)
SELECT 'non_churn' AS class, neg AS training_rows,
       CASE WHEN neg > 0 THEN (neg + pos) / (2.0 * neg) ELSE 0.0 END AS class_weight FROM c
UNION ALL
SELECT 'churn', pos, CASE WHEN pos > 0 THEN (neg + pos) / (2.0 * pos) ELSE 0.0 END FROM c""",
          doubles=("class_weight",))
def ml_class_weights(spark, sf):
    return M.class_weight_table(splits(spark, sf)[0])


# ----------------------------------------------------------------- M3, M5
@register("ml_imputed", f"""
WITH train AS (SELECT * FROM february_features WHERE {O.bucket()} < 80),
     m AS (SELECT {', '.join(f'quantile_disc({c}, 0.5) AS {c}' for c in CONFIG.nullable_features)} FROM train)
SELECT msno, {', '.join(f'CAST(COALESCE(train.{c}, m.{c}) AS DOUBLE) AS filled_{c}' for c in CONFIG.nullable_features)}
FROM train CROSS JOIN m""")
def ml_imputed(spark, sf):
    """M3: median-filled nullable features of the training split."""
    train = M.as_double_features(splits(spark, sf)[0])
    inputs = M.model_inputs(train)
    filled = [x.column for x in inputs if x.fill is not None]
    return M.input_stages(inputs)[0].transform(train).select("msno", *filled)


def _scaler_sql() -> str:
    nullable = set(CONFIG.nullable_features)
    med = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in nullable)
    cols = [
        f"COALESCE(CAST({c} AS DOUBLE), m.m_{c})" if c in nullable else f"CAST({c} AS DOUBLE)"
        for c in CONFIG.feature_columns
    ]
    parts = [
        f"SELECT '{c}' AS feature, AVG({e}) AS mean, STDDEV_SAMP({e}) AS std FROM train, m"
        for c, e in zip(CONFIG.feature_columns, cols)
    ]
    return (f"WITH train AS (SELECT * FROM february_features WHERE {O.bucket()} < 80), "
            f"m AS (SELECT {med} FROM train) " + " UNION ALL ".join(parts))


@register("ml_scaler_stats", _scaler_sql(), doubles=("mean", "std"))
def ml_scaler_stats(spark, sf):
    """M5: per-feature mean and sample deviation learnt by the scaler (after M3, M4)."""
    from pyspark.ml import Pipeline

    train = M.as_double_features(splits(spark, sf)[0])
    model = Pipeline(stages=M.input_stages(M.model_inputs(train))).fit(train)
    scaler = model.stages[-1]
    rows = [(c, float(m), float(s)) for c, m, s in zip(CONFIG.feature_columns, scaler.mean, scaler.std)]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


# ----------------------------------------------------------------- M6, M8, S18
@register("ml_fit")
def ml_fit(spark, sf):
    """M6: coefficients of the class-weighted logistic regression."""
    lr = fitted_model(spark, sf).stages[-1]
    rows = [(c, float(w)) for c, w in zip(CONFIG.feature_columns, lr.coefficients)]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def model_threshold(spark, sf, model):
    validation = M.score(model, splits(spark, sf)[1])
    return M.best_threshold(M.threshold_search(validation)).select("threshold").scalar()


@register("ml_predictions")
def ml_predictions(spark, sf):
    """March predictions at the threshold chosen on validation."""
    def write(base):
        model = fitted_model(spark, sf)
        t = model_threshold(spark, sf, model)
        scored = M.score(model, splits(spark, sf)[2])
        W.write_parquet(
            scored.select("msno", "is_churn", "p1", (F.col("p1") >= t).cast("int").alias("predicted_label")), base)

    return spark.read.parquet(stage(spark, sf, "predictions", write))


@register("ml_save_load")
def ml_save_load(spark, sf):
    """The saved pipeline, loaded back, scores the test cohort."""
    return M.score(fitted_model(spark, sf), splits(spark, sf)[2]).select("msno", "p1")


@register("ml_fit_check", f"""
SELECT feature, TRUE AS solves FROM (VALUES {', '.join(f"('{c}')" for c in (*CONFIG.feature_columns, 'intercept'))}) AS v(feature)""")
def ml_fit_check(spark, sf):
    """M6: the weighted score equation of each coefficient holds (to 1e-3 of the total weight)."""
    train = M.add_class_weights(splits(spark, sf)[0])
    made = fitted_model(spark, sf).transform(M.as_double_features(train))
    x, p = vector_to_array("vector"), F.get(vector_to_array("probability"), F.lit(1))
    names = (*CONFIG.feature_columns, "intercept")
    held = made.select("class_weight", (F.col("class_weight") * (F.col("is_churn") - p)).alias("e"), F.concat(x, F.array(F.lit(1.0))).alias("x"))
    sums = held.agg(*[(F.abs(F.sum(F.col("e") * F.get("x", F.lit(i)))) <= 1e-3 * F.sum("class_weight")).alias(c) for i, c in enumerate(names)])
    return sums.unpivot([], list(names), "feature", "solves")


@register("ml_predictions_check", "SELECT msno, is_churn, TRUE AS is_probability, TRUE AS follows_threshold FROM march_features")
def ml_predictions_check(spark, sf):
    """One prediction a test row, a probability, labelled by the validation threshold."""
    t = model_threshold(spark, sf, fitted_model(spark, sf))
    label = (F.col("p1") >= t).cast("int")
    return ml_predictions(spark, sf).select(
        "msno", "is_churn", F.col("p1").between(0, 1).alias("is_probability"), (F.col("predicted_label") == label).alias("follows_threshold"))


@register("ml_save_load_check", "SELECT msno, TRUE AS same_score FROM march_features")
def ml_save_load_check(spark, sf):
    """The loaded pipeline scores as a pipeline fitted in this session."""
    train, _, test = splits(spark, sf)
    fitted = M.score(M.fit(train), test).select("msno", F.col("p1").alias("p_fitted"))
    return ml_save_load(spark, sf).join(fitted, "msno").select("msno", (F.abs(F.col("p1") - F.col("p_fitted")) < 1e-6).alias("same_score"))


@register("ml_metrics_check", """
SELECT 'Logistic Regression - all combined features' AS model, COUNT(*) AS test_rows,
       COUNT(*) FILTER (WHERE is_churn = 1) AS positives, COUNT(*) FILTER (WHERE is_churn = 0) AS negatives, TRUE AS in_range
FROM march_features""")
def ml_metrics_check(spark, sf):
    """M10 on the fitted model: the counts add up to the rows of each class, the ratios are ratios."""
    ratios = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1", "threshold")]
    return ml_metrics(spark, sf).select(
        "model", "test_rows", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"),
        (ratios[0] & ratios[1] & ratios[2] & ratios[3] & (F.col("log_loss") >= 0)).alias("in_range"))


@register("ml_metrics")
def ml_metrics(spark, sf):
    """M10 / M14 on the fitted model: March metrics at the validation threshold."""
    model = fitted_model(spark, sf)
    t = model_threshold(spark, sf, model)
    return M.binary_metrics(M.score(model, splits(spark, sf)[2]), t)


# ----------------------------------------------------------------- M7, T2, M10, M11 on the fixed score
THRESHOLD_SQL = f"""
WITH g(threshold) AS (VALUES {GRID_VALUES}),
     c AS (SELECT g.threshold,
                  COUNT(*) FILTER (WHERE s.is_churn = 1 AND s.p1 >= g.threshold) AS tp,
                  COUNT(*) FILTER (WHERE s.is_churn = 0 AND s.p1 >= g.threshold) AS fp,
                  COUNT(*) FILTER (WHERE s.is_churn = 1 AND s.p1 < g.threshold) AS fn
           FROM g CROSS JOIN feb_scored s GROUP BY g.threshold),
     pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                      CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT threshold, tp, fp, fn, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM pr"""
O.view("feb_threshold_table", THRESHOLD_SQL)
O.view("feb_best_threshold", "SELECT * FROM feb_threshold_table ORDER BY f1 DESC, recall DESC, threshold ASC LIMIT 1")


@register("threshold_search", "SELECT * FROM feb_threshold_table", doubles=("threshold", "precision", "recall", "f1"))
def threshold_search(spark, sf):
    return M.threshold_search(fixed_score(pipeline.cohort_features(spark, sf, "february")))


@register("best_threshold", "SELECT * FROM feb_best_threshold", doubles=("threshold", "precision", "recall", "f1"))
def best_threshold(spark, sf):
    return M.best_threshold(M.threshold_search(fixed_score(pipeline.cohort_features(spark, sf, "february"))))


@register("binary_metrics", """
WITH t AS (SELECT threshold FROM feb_best_threshold),
     c AS (SELECT COUNT(*) AS test_rows,
                  COUNT(*) FILTER (WHERE is_churn = 1 AND p1 >= t.threshold) AS tp,
                  COUNT(*) FILTER (WHERE is_churn = 0 AND p1 >= t.threshold) AS fp,
                  COUNT(*) FILTER (WHERE is_churn = 0 AND p1 < t.threshold) AS tn,
                  COUNT(*) FILTER (WHERE is_churn = 1 AND p1 < t.threshold) AS fn,
                  AVG(-(is_churn * ln(GREATEST(1e-15, LEAST(p1, 1 - 1e-15)))
                        + (1 - is_churn) * ln(1 - GREATEST(1e-15, LEAST(p1, 1 - 1e-15))))) AS log_loss,
                  ANY_VALUE(t.threshold) AS threshold
           FROM mar_scored, t),
     p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                     CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT 'Logistic Regression - all combined features' AS model, test_rows, 11 AS feature_count, threshold,
       precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
       log_loss, tp, fp, tn, fn
FROM p""", doubles=("threshold", "precision", "recall", "f1", "log_loss"))
def binary_metrics(spark, sf):
    t = pipeline.clean(spark, sf)
    feb = fixed_score(pipeline.cohort_features(spark, sf, "february", t))
    mar = fixed_score(pipeline.cohort_features(spark, sf, "march", t))
    threshold = M.best_threshold(M.threshold_search(feb)).select("threshold").scalar()
    return M.binary_metrics(mar, threshold)


AUC_SQL = """
WITH h AS (SELECT p1 AS s, COUNT(*) FILTER (WHERE is_churn = 1) AS pos, COUNT(*) FILTER (WHERE is_churn = 0) AS neg
           FROM mar_scored GROUP BY p1),
     c AS (SELECT pos, neg, SUM(pos) OVER (ORDER BY s DESC) AS ctp, SUM(neg) OVER (ORDER BY s DESC) AS cfp,
                  ROW_NUMBER() OVER (ORDER BY s DESC) AS rn FROM h),
     t AS (SELECT SUM(pos) AS bp, SUM(neg) AS bn FROM h)
SELECT SUM((cfp / bn - (cfp - neg) / bn) * (ctp / bp + (ctp - pos) / bp) / 2) AS roc_auc,
       SUM((ctp / bp - (ctp - pos) / bp)
           * (ctp / (ctp + cfp)
              + CASE WHEN rn = 1 THEN ctp / (ctp + cfp) ELSE (ctp - pos) / ((ctp - pos) + (cfp - neg)) END) / 2) AS pr_auc
FROM c, t"""


@register("auc_exact", AUC_SQL, doubles=("roc_auc", "pr_auc"))
def auc_exact(spark, sf):
    return M.exact_auc(fixed_score(pipeline.cohort_features(spark, sf, "march")))


@register("ml_auc", AUC_SQL, doubles=("roc_auc", "pr_auc"))
def ml_auc(spark, sf):
    """M11 with Spark's evaluator; with 100 distinct scores it is not binned, so it equals the exact form."""
    scored = fixed_score(pipeline.cohort_features(spark, sf, "march"))
    roc, pr = M.evaluator_auc(scored, "p1")
    return spark.createDataFrame([(roc, pr)], "roc_auc double, pr_auc double")


@register("cross_join_broadcast", f"""
WITH g(threshold) AS (VALUES {GRID_VALUES})
SELECT g.threshold,
       COUNT(*) FILTER (WHERE s.is_churn = 1 AND s.p1 >= g.threshold) AS tp,
       COUNT(*) FILTER (WHERE s.is_churn = 0 AND s.p1 >= g.threshold) AS fp,
       COUNT(*) FILTER (WHERE s.is_churn = 1 AND s.p1 < g.threshold) AS fn
FROM g CROSS JOIN mar_scored s GROUP BY g.threshold""", doubles=("threshold",))
def cross_join_broadcast(spark, sf):
    """What rows x 17 thresholds + group-by gives, without pairing any rows.

    The oracle performs the real cross join; here each row is counted into the
    thresholds it passes by ``threshold_search``.
    """
    scored = fixed_score(pipeline.cohort_features(spark, sf, "march"))
    return M.threshold_search(scored).select("threshold", "tp", "fp", "fn")
