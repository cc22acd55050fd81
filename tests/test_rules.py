"""Tree models compiled to expressions, against the models themselves; metrics of the written scores in SQL."""

import random

import pytest
from pyspark.sql import functions as F

from sparkpanel.operators import ml, rules
from tests.conftest import SF_SMALL

NAMES = ["a", "b c", "d"]


def _table(spark, n=600):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        a, b, d = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0]), rng.choice([0.0, rng.random()])
        rows.append((i, a, b, d, int(a + b > 1 or d > 0.8)))
    return spark.createDataFrame(rows, "id int, a double, `b c` double, d double, y int")


@pytest.mark.parametrize("kind,params", [("tree", {"maxDepth": 4}), ("tree", {"maxDepth": 0}), ("forest", {"numTrees": 5, "maxDepth": 3}),
                                         ("gbt", {"maxIter": 6, "maxDepth": 2})])
def test_compiled_scores_are_the_models(spark, kind, params):
    df = _table(spark)
    model, scored, _ = ml.fit_score(df, df, NAMES, "y", kind, **params)
    trees = rules.tree_nodes(model, spark)
    own = rules.score_column(trees, NAMES, kind)
    assert scored.where(~(F.abs(own - F.col("score")) < 1e-9)).count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, 0)], df.schema)
    gone = model.transform(nulls.withColumn("y", F.col("y").cast("double"))).select(ml.vector_to_array("probability")[1]).first()[0]
    assert abs(nulls.select(own).first()[0] - gone) < 1e-9
    want = model.stages[-1].featureImportances.toArray().tolist()
    got = {r.feature: r.importance for r in rules.importances(trees, NAMES, spark, kind).collect()}
    assert [got[n] for n in NAMES] == pytest.approx(want, abs=1e-9)
    # a changed split shows
    if trees[0][0]["left"] >= 0:
        trees[0][0]["threshold"] += 0.5
        assert scored.where(~(F.abs(rules.score_column(trees, NAMES, kind) - F.col("score")) < 1e-9)).count() > 0


def test_leaves_partition_the_rows(spark):
    df = _table(spark)
    model, _, _ = ml.fit_score(df, df, ["a", "b c"], "y", "tree", maxDepth=3)
    found = rules.leaves(rules.tree_nodes(model, spark), ["a", "`b c`"], spark).collect()
    assert [r.leaf_no for r in found] == list(range(1, len(found) + 1)) and sum(r.n_rows for r in found) == df.count()
    for r in found:
        inside = df.where(r.rule).agg(F.count(F.lit(1)), F.avg("y")).first()
        assert (inside[0], inside[1]) == (r.n_rows, pytest.approx(r.share))


def test_large_models_are_refused(spark, monkeypatch):
    df = _table(spark, 100)
    model, _, _ = ml.fit_score(df, df, ["a"], "y", "tree", maxDepth=3)
    monkeypatch.setattr(rules, "MAX_NODES", 2)
    with pytest.raises(ValueError, match="more than 2 nodes"):
        rules.tree_nodes(model, spark)


def test_metrics_are_those_of_the_written_scores(spark, duck):
    """Accuracy, precision, recall, F1 and AUC recomputed in SQL from the files that the query scored."""
    from sparkpanel.plans import learning

    scores, _, _ = learning.fitted(spark, SF_SMALL, "tree", **learning.TREE)
    files = [f.removeprefix("file://") for f in scores.inputFiles()]
    got = {r.split: r for r in learning.decision_tree_eval(spark, SF_SMALL).collect()}
    for split, r in got.items():
        tp, fp, fn, tn = duck.execute("""select count(*) filter (quality = 1 and score >= 0.5), count(*) filter (quality = 0 and score >= 0.5),
            count(*) filter (quality = 1 and score < 0.5), count(*) filter (quality = 0 and score < 0.5)
            from read_parquet(?) where split = ?""", [files, split]).fetchone()
        pairs, wins = duck.execute("""select count(*), sum(case when a.score > b.score then 1 when a.score = b.score then 0.5 else 0 end)
            from (select * from read_parquet($f) where split = $s and quality = 1) a, (select * from read_parquet($f) where split = $s and quality = 0) b""",
                                   {"f": files, "s": split}).fetchone()
        assert r.accuracy == pytest.approx((tp + tn) / (tp + fp + fn + tn)) and r.auc == pytest.approx(float(wins) / pairs)
        assert r.precision == pytest.approx(tp / (tp + fp) if tp + fp else 0) and r.recall == pytest.approx(tp / (tp + fn))
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert learning.fitted(spark, SF_SMALL, "tree", **learning.TREE)[0] is scores
