"""Spark ML classifiers: feature stages, cross-validated training, comparison.

Param grids are built on the estimator *instances* (a grid on class-level
params does not bind to the instance and silently trains the defaults).
Evaluation runs on the cluster with :mod:`tabqual.operators.evaluate`;
only the per-model metric rows (a handful of scalars) reach the driver.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.operators import evaluate as ev
from tabqual.session import materialize

# The compared classifiers, their settings and the grids they are tuned over.
CLASSIFIERS = {
    "logistic_regression": (LogisticRegression, {"maxIter": 80}, {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}),
    "random_forest": (RandomForestClassifier, {"numTrees": 80}, {"maxDepth": [4, 8], "numTrees": [40, 80]}),
    "gbt": (GBTClassifier, {"maxIter": 40}, {"maxDepth": [3, 6], "maxIter": [20, 40]}),
}
MODEL_NAMES = tuple(CLASSIFIERS)
# Fixed value: training rows per partition; tree training pays for every task of every job.
ROWS_PER_TRAINING_TASK = 50_000


def feature_stages(cat_cols: Sequence[str], num_cols: Sequence[str]) -> list:
    """Index + one-hot the string columns, impute numeric NULLs, assemble ``features``."""
    stages = []
    inputs: list[str] = []
    if cat_cols:
        idx = [f"{c}_idx" for c in cat_cols]
        ohe = [f"{c}_ohe" for c in cat_cols]
        stages.append(StringIndexer(inputCols=list(cat_cols), outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep"))
        inputs += ohe
    if num_cols:
        imp = [f"{c}_imp" for c in num_cols]
        stages.append(Imputer(inputCols=list(num_cols), outputCols=imp, strategy="mean"))
        inputs += imp
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def classifier_and_grid(name: str, seed: int = 42):
    """Estimator and its parameter grid (instance-level params)."""
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown model {name!r}")
    kind, settings, grid = CLASSIFIERS[name]
    seeded = {"seed": seed} if kind.__name__ != "LogisticRegression" else {}
    est = kind(featuresCol="features", labelCol="label", **settings, **seeded)
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(est.getParam(param), values)
    return est, builder.build()


def positive_score(pred: DataFrame, out: str = "score") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


@dataclass
class TrainedModels:
    comparison: DataFrame
    importances: DataFrame
    models: dict[str, PipelineModel] = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)  # test rows with ``score``


def train_and_compare(train: DataFrame, val: DataFrame, test: DataFrame, cat_cols: Sequence[str],
                      num_cols: Sequence[str], id_col: str, models: Sequence[str] = MODEL_NAMES,
                      folds: int = 3, parallelism: int = 2, seed: int = 42,
                      bootstrap_replicates: int = ev.BOOTSTRAP_REPLICATES,
                      concurrent_models: int = 3) -> TrainedModels:
    """Fit each classifier with k-fold CV on ROC-AUC and evaluate it on val/test.

    Feature stages are fitted once on the training split (vocabularies and
    imputation means come from training rows only); the assembled training
    vectors are written in partitions sized to their rows, so every CV fold and grid point reads written
    data instead of re-running the upstream plan. ``train_seconds`` is the
    wall-clock of each model's CV fit, which overlaps when
    ``concurrent_models > 1``.
    """
    spark = train.sparkSession
    as_double = F.col("label").cast("double")
    train, val, test = (d.withColumn("label", as_double) for d in (train, val, test))
    featurizer = Pipeline(stages=feature_stages(cat_cols, num_cols)).fit(train)
    keep = [id_col, "label", "features"]
    tasks = max(1, -(-train.count() // ROWS_PER_TRAINING_TASK))
    train_vec = materialize(featurizer.transform(train).select(*keep).coalesce(tasks))
    # every model evaluates on the same validation/test vectors several times
    val_vec = materialize(featurizer.transform(val).select(*keep))
    test_vec = materialize(featurizer.transform(test).select(*keep))
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")

    def fit_and_score(name: str):
        est, grid = classifier_and_grid(name, seed)
        cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator,
                            numFolds=folds, parallelism=parallelism, seed=seed)
        start = time.perf_counter()
        best = cv.fit(train_vec).bestModel
        seconds = time.perf_counter() - start
        val_pred = positive_score(best.transform(val_vec))
        test_pred = positive_score(best.transform(test_vec))
        v = ev.auc_metrics(val_pred).first()
        t = ev.auc_metrics(test_pred).first()
        ci = ev.bootstrap_auc_ci(test_pred, id_col=id_col, replicates=bootstrap_replicates, seed=seed).first()
        conf = ev.confusion_profit(test_pred).first()
        row = (name, v["roc_auc"], t["roc_auc"], t["pr_auc"], ci["auc_ci_low"], ci["auc_ci_high"],
               float(seconds), float(conf["expected_profit"]), int(conf["rows"]))
        return name, best, row, _importances(name, best, test_pred), test_pred

    # the models are independent Spark jobs: submit them from concurrent driver threads
    with ThreadPoolExecutor(max_workers=max(1, min(len(models), concurrent_models))) as pool:
        results = list(pool.map(fit_and_score, models))
    rows, imp_rows, fitted, predictions = [], [], {}, {}
    for name, best, row, imps, test_pred in results:
        predictions[name] = test_pred
        fitted[name] = PipelineModel(stages=list(featurizer.stages) + [best])
        rows.append(row)
        imp_rows += imps
    comparison = spark.createDataFrame(rows, "model string, val_roc_auc double, test_roc_auc double, "
                                             "test_pr_auc double, auc_ci_low double, auc_ci_high double, "
                                             "train_seconds double, expected_profit_index double, test_rows bigint")
    importances = spark.createDataFrame(imp_rows, "model string, feature_index int, feature_name string, "
                                                  "importance double")
    return TrainedModels(comparison, importances, fitted, predictions)


def feature_names(pred: DataFrame, col: str = "features") -> dict[int, str]:
    """Vector slot -> feature name from the assembler's ML attribute metadata."""
    meta = pred.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: a.get("name", str(a["idx"])) for group in meta.values() for a in group}


def _importances(name: str, model, pred: DataFrame) -> list[tuple]:
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not hasattr(last, "featureImportances"):
        return []
    names = feature_names(pred)
    values = last.featureImportances.toArray()
    return [(name, i, names.get(i, str(i)), float(values[i])) for i in range(len(values))]


def balanced_logistic(train: DataFrame, test: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str],
                      max_iter: int = 400) -> DataFrame:
    """Class-balanced logistic baseline on all rows (weight = n / (2 * n_class)).

    Returns ``model, roc_auc_train, roc_auc_test, train_rows, test_rows``;
    no row when a side is empty or has one class.
    """
    spark = train.sparkSession
    schema = "model string, roc_auc_train double, roc_auc_test double, train_rows bigint, test_rows bigint"
    train = ev.with_class_weights(train.withColumn("label", F.col("label").cast("double")), "label", "class_weight")
    test = test.withColumn("label", F.col("label").cast("double"))
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("k")).first()
    tsizes = test.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("k")).first()
    if sizes["n"] == 0 or tsizes["n"] == 0 or sizes["k"] < 2 or tsizes["k"] < 2:
        return spark.createDataFrame([], schema)
    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="class_weight", maxIter=max_iter)
    model = Pipeline(stages=feature_stages(cat_cols, num_cols) + [lr]).fit(train)
    a_train = ev.auc_metrics(positive_score(model.transform(train))).first()["roc_auc"]
    a_test = ev.auc_metrics(positive_score(model.transform(test))).first()["roc_auc"]
    return spark.createDataFrame([("balanced_logistic", a_train, a_test, sizes["n"], tsizes["n"])], schema)
