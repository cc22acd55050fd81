"""Fitted tree models as expressions and tables (ML16, ML9).

A model's nodes are read from its saved form, which Spark writes as a Parquet table of
nodes (``model.write().save``).  From them come

* ``score_column``: one Column that scores rows without the model object, Python or
  vectors, so scoring is part of any query and stays inside code generation;
* ``leaves``: a row per leaf with its rule in words, its rows and its value;
* ``importances``: gain times rows, added up per feature.

Trees are driver-made objects of bounded size (``MAX_NODES``); the rows never leave the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.session import scratch_path

#: nodes of one expression or table; a deep forest has more and is scored by its model
MAX_NODES = 5_000


def tree_nodes(model, spark: SparkSession) -> list[list[dict]]:
    """The nodes of every tree of a fitted tree, forest or boosting model (the last stage of a pipeline
    model), by node number; each with its tree's weight."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    path = scratch_path(spark, "model")
    stage.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    else:
        data = data.withColumn("treeID", F.lit(0))
    if data.count() > MAX_NODES:
        raise ValueError(f"the model has more than {MAX_NODES} nodes: score with the model itself")
    weights = list(getattr(stage, "treeWeights", [1.0]))
    trees: list[list[dict]] = [[] for _ in weights]
    for r in data.orderBy("treeID", "id").collect():
        if r["leftChild"] >= 0 and r["split"]["numCategories"] != -1:
            raise ValueError("splits on categories are not supported: encode them as numbers")
        trees[r["treeID"]].append({
            "left": r["leftChild"], "right": r["rightChild"], "feature": r["split"]["featureIndex"], "weight": weights[r["treeID"]],
            "threshold": r["split"]["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else None,
            "prediction": r["prediction"], "stats": list(r["impurityStats"]), "gain": r["gain"], "n": r["rawCount"]})
    return trees


def _share(node: dict) -> float:
    """A classification leaf's share of class 1."""
    total = sum(node["stats"])
    return node["stats"][1] / total if total else 0.0


def _sql(tree: list[dict], names: list[str], value, at: int = 0) -> str:
    node = tree[at]
    if node["left"] < 0:
        return f"{value(node)!r}D"
    return (f"case when coalesce(cast(`{names[node['feature']]}` as double), double('NaN')) <= {node['threshold']!r}D "
            f"then {_sql(tree, names, value, node['left'])} else {_sql(tree, names, value, node['right'])} end")


def score_column(trees: list[list[dict]], names: list[str], kind: str) -> Column:
    """P(class 1) of a row with the feature columns ``names``.

    ``tree`` and ``forest``: the mean share of class 1 in the leaves; ``gbt``: the logistic of
    twice the weighted sum of the leaves.  Null and NaN features go right, as in the model.
    """
    if kind == "gbt":
        margin = " + ".join(f"{t[0]['weight']!r}D * ({_sql(t, names, lambda n: n['prediction'])})" for t in trees)
        return F.expr(f"1D / (1D + exp(-2D * ({margin})))")
    return F.expr(f"({' + '.join(f'({_sql(t, names, _share)})' for t in trees)}) / {float(len(trees))!r}D")


def leaves(trees: list[list[dict]], names: list[str], spark: SparkSession) -> DataFrame:
    """(tree_no, leaf_no, rule, n_rows, share, prediction): every leaf, from left to right; a lone leaf has an empty rule."""
    rows = []

    def walk(tree_no: int, tree: list[dict], at: int, path: list[str], found: list) -> None:
        node = tree[at]
        if node["left"] < 0:
            share = _share(node) if len(node["stats"]) == 2 else None
            found.append((tree_no, len(found) + 1, " and ".join(path), node["n"], share, node["prediction"]))
            return
        name = names[node["feature"]]
        walk(tree_no, tree, node["left"], [*path, f"{name} <= {node['threshold']!r}"], found)
        walk(tree_no, tree, node["right"], [*path, f"{name} > {node['threshold']!r}"], found)

    for i, tree in enumerate(trees):
        found: list = []
        walk(i, tree, 0, [], found)
        rows += found
    return spark.createDataFrame(rows, "tree_no int, leaf_no int, rule string, n_rows long, share double, prediction double")


def importances(trees: list[list[dict]], names: list[str], spark: SparkSession, kind: str = "tree") -> DataFrame:
    """(feature, importance): gain times rows of the nodes that split on the feature, as a share of all; a forest
    takes the mean share over its trees.  Features that no node uses have 0."""
    total = dict.fromkeys(names, 0.0)
    for tree in trees:
        own = dict.fromkeys(names, 0.0)
        for node in tree:
            if node["left"] >= 0:
                own[names[node["feature"]]] += node["gain"] * node["n"]
        whole = sum(own.values()) if kind != "gbt" else 1.0
        for f, g in own.items():
            total[f] += g / whole if whole else 0.0
    whole = sum(total.values())
    return spark.createDataFrame([(f, g / whole if whole else 0.0) for f, g in total.items()], "feature string, importance double")
