"""Machine-learning operators (ML1-ML15) on Spark ML and DataFrame expressions.

Splits and oversampling are exact and reproducible (md5 order keys ranked
per class with the distributed ``rank_within_groups``); models are Spark ML
tree learners; metrics are confusion sums and a rank-sum AUC computed with
distributed running totals over the distinct scores.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.functions.columns import md5_order
from sparkpanel.operators.panel import rank_within_groups, running_totals
from sparkpanel.operators.reshape import categories
from sparkpanel.session import scratch_path


def _safe_name(v: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", str(v)).strip("_").lower()


# ---------------------------------------------------------------- encoding (ML1)

def one_hot_drop_first(df: DataFrame, col: str, prefix: str | None = None) -> tuple[DataFrame, list[str]]:
    """``get_dummies(drop_first=True)``: one 0/1 column per category but the alphabetically first.

    The categories are one distinct job (the schema depends on them); the columns are plain
    comparisons.  Null: all zeros.
    """
    prefix = prefix or col
    kept = categories(df, col)[:0:-1]  # descending, without the first
    names = [f"{prefix}_{_safe_name(v)}" for v in kept]
    out = df.select("*", *[F.col(col).eqNullSafe(F.lit(v)).cast("int").alias(n) for v, n in zip(kept, names)])
    return out, names


# ---------------------------------------------------------------- splitting / sampling (ML3, ML4)

def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Exact per-class split: the first ceil(test_frac * n_class) rows by md5 order are 'test'."""
    keyed = df.withColumn("__h", md5_order(key, seed))
    ranked = rank_within_groups(keyed, [label], ["__h", key], name="__r")
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    j = ranked.join(n, label)
    # exact decimal product: in double, 3410 * 0.2 = 682.0000000000001 would round up to 683
    from decimal import Decimal

    frac = F.lit(Decimal(str(test_frac))).cast("decimal(12,8)")
    test_n = F.ceil(F.col("__n").cast("decimal(20,0)") * frac)
    return j.withColumn(split_col, F.when(F.col("__r") <= test_n, "test").otherwise("train")).drop("__h", "__r", "__n")


def oversample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Random oversampling made exact: every class grows to the majority size.

    Row r (md5 order) of a class with n rows and target M gets floor(M/n) copies
    plus one more when r <= M mod n; copies come from ``explode(sequence)``.
    """
    keyed = df.withColumn("__h", md5_order(key, seed))
    ranked = rank_within_groups(keyed, [label], ["__h", key], name="__r")
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    target = n.agg(F.max("__n")).scalar()
    j = ranked.join(n, label)
    copies = (F.floor(target / F.col("__n")) + F.when(F.col("__r") <= F.pmod(target, F.col("__n")), 1).otherwise(0)).cast("int")
    out = j.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
    return out.drop("__h", "__r", "__n")


# ---------------------------------------------------------------- models (ML5-ML7, ML13)

def classifier(kind: str, features: str = "features", label: str = "label", **params):
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=42, **params)
    if kind == "forest":
        return RandomForestClassifier(featuresCol=features, labelCol=label, seed=42, **params)
    if kind == "gbt":
        return GBTClassifier(featuresCol=features, labelCol=label, seed=42, **params)
    raise ValueError(kind)


def fit_score(train: DataFrame, test: DataFrame, feature_cols: list[str], label: str, kind: str, **params):
    """Fit a tree learner; return (model, scored test, scored train) with a ``score`` column = P(class 1)."""
    asm = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    pipe = Pipeline(stages=[asm, classifier(kind, label=label, **params)])
    model = pipe.fit(train.withColumn(label, F.col(label).cast("double")))

    def score(d):
        return model.transform(d.withColumn(label, F.col(label).cast("double"))).withColumn(
            "score", vector_to_array("probability")[1])

    return model, score(test), score(train)


def tree_rules(model, feature_cols: list[str], spark) -> DataFrame:
    """ML16: the decision rules of a fitted tree as text lines, feature indices replaced by names."""
    text = model.stages[-1].toDebugString
    for i in sorted(range(len(feature_cols)), reverse=True):
        text = text.replace(f"feature {i} ", f"{feature_cols[i]} ")
    lines = [ln.rstrip() for ln in text.splitlines() if ln.strip()]
    return spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line_no int, rule string")


def feature_importances(model, feature_cols: list[str], spark, k: int = 15) -> DataFrame:
    """ML9: top-k importances with their feature names (a k-row table)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(feature_cols, imp), key=lambda t: (-t[1], t[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


def per_item_forest(df: DataFrame, item: str, key: str, feature_cols: list[str], target: str, min_rows: int = 20,
                    n_trees: int = 300, max_depth: int = 15, test_frac: float = 0.2, seed: int = 42,
                    parallel: int = 8) -> DataFrame:
    """ML13: one random-forest regressor per item; items with < min_rows rows use the rule mode.

    The item list is the distinct keys (metadata-sized); every fit is a distributed
    Spark ML job.  Split by md5 order (temporal order is preferable, see ML14).
    R^2 is floored at 0.
    """
    from pyspark.ml.evaluation import RegressionEvaluator

    spark = df.sparkSession
    # the features are computed once: every fit reads its item from the written table
    path = scratch_path(spark, "per-item")
    df.dropna(subset=[target, *feature_cols]).write.partitionBy(item).parquet(path)
    data = spark.read.schema(df.schema).parquet(path)
    sizes = {r[item]: r["n"] for r in data.groupBy(item).agg(F.count(F.lit(1)).alias("n")).collect()}
    def fit_one(it):
        if sizes[it] < min_rows:
            return (str(it), int(sizes[it]), "rule", 0.0)
        d = data.where(F.col(item) == it).withColumn("__h", md5_order(key, seed))
        d = d.withColumn("__u", F.conv(F.substring("__h", 1, 8), 16, 10).cast("double") / 4294967296.0)
        train, test = d.where(F.col("__u") >= test_frac), d.where(F.col("__u") < test_frac)
        asm = VectorAssembler(inputCols=feature_cols, outputCol="features")
        rf = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=n_trees, maxDepth=max_depth,
                                   seed=seed, maxMemoryInMB=1024)
        model = Pipeline(stages=[asm, rf]).fit(train)
        r2 = RegressionEvaluator(labelCol=target, metricName="r2").evaluate(model.transform(test)) if test.take(1) else 0.0
        return (str(it), int(sizes[it]), "model", max(0.0, round(float(r2), 3)))

    # the per-item fits are independent Spark jobs: submit them concurrently
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(sizes)))) as pool:
        rows = list(pool.map(fit_one, sorted(sizes)))
    return spark.createDataFrame(rows, "item string, n_rows long, mode string, r2 double")


# ---------------------------------------------------------------- metrics (ML8-ML11)

def threshold_metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 at a probability threshold; 0 where undefined."""
    by = by or []
    y = F.col(label).cast("int")
    p = (F.col(score) >= threshold).cast("int")
    g = (scored.groupBy(*by) if by else scored).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), z)
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), z)
    acc = F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), z)
    return g.select(*by, "tp", "fp", "fn", "tn", acc.alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC by the rank-sum (Mann-Whitney) form with ties counted half.

    AUC = sum over distinct scores s of pos(s) * (neg below s + neg(s) / 2) / (P * N).
    Scores are grouped first; the "negatives below" are distributed running totals.
    NULL when one class is absent.
    """
    g = scored.groupBy(score).agg(F.sum(F.col(label).cast("bigint")).alias("pos"),
                                  F.sum((1 - F.col(label).cast("int")).cast("bigint")).alias("neg"))
    c = running_totals(g, score, ["neg"], descending=False)
    below = F.col("cum_neg") - F.col("neg")
    return c.agg(F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                              F.sum("pos") * F.sum("neg")).alias("auc"))


def fit_diagnosis(train_acc: Column, test_acc: Column, train_f1: Column, test_f1: Column) -> Column:
    """ML11: both accuracies < .70 -> underfit; gap in accuracy > .07 or F1 > .08 -> overfit."""
    return (F.when((train_acc < 0.70) & (test_acc < 0.70), "underfit")
            .when(((train_acc - test_acc) > 0.07) | ((train_f1 - test_f1) > 0.08), "overfit")
            .otherwise("good"))
