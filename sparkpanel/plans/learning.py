"""Machine-learning queries.

Classifier stand-in: documents joined to labels (quality = target), features
derived from the whole text.  A fixed score column (log10 of the document
length) exercises the metric code against SQL oracles; the large tree models
are checked rows-only (their results depend on Spark ML internals), a small
one leaf by leaf against a tree grown in SQL, and their scores against the
expressions compiled from their nodes.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sparkpanel.functions import columns as C
from sparkpanel.operators import linear, ml, panel, rules
from sparkpanel.plans.registry import query
from sparkpanel.session import scratch_path
from sparkpanel.sources.tables import Tables

R = 4
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot", """
select o_orderkey, {cols} from orders""".format(cols=", ".join(
    f"cast(o_orderpriority = '{p}' as int) as pri_{ml._safe_name(p)}" for p in sorted(PRIORITIES, reverse=True)[:-1])))
def one_hot(spark, sf):
    """ML1: one-hot with the first category dropped (plain comparisons, one column per category)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    out, names = ml.one_hot_drop_first(o, "o_orderpriority", "pri")
    return out.select("o_orderkey", *names)


_LABELLED_SQL = "(select l.doc_id, l.quality from labels l join documents d using (doc_id))"


def _labelled(spark, sf):
    t = Tables(spark, sf)
    return t.labels.select("doc_id", "quality").join(t.documents.select("doc_id"), "doc_id")


@query("stratified_split_counts", f"""
select quality, split, count(*) as n from (
  select quality, case when row_number() over (partition by quality order by md5(cast(doc_id as varchar) || '42'), doc_id)
                            <= ceil(count(*) over (partition by quality) * 0.2) then 'test' else 'train' end as split
  from {_LABELLED_SQL}) group by 1, 2""")
def stratified_split_counts(spark, sf):
    """ML3: exact stratified 80/20 split by md5 order, ranked per class without a per-class window."""
    s = ml.stratified_split(_labelled(spark, sf), "quality", "doc_id", 0.2, 42)
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


@query("oversample_counts", f"""
with r as (select quality, doc_id, row_number() over (partition by quality order by md5(cast(doc_id as varchar) || '42'), doc_id) as rn,
                  count(*) over (partition by quality) as n from {_LABELLED_SQL}),
m as (select max(n) as m from (select count(*) as n from {_LABELLED_SQL} group by quality)),
c as (select quality, doc_id, cast(floor(m / n) + case when rn <= m % n then 1 else 0 end as bigint) as copies from r, m)
select quality, cast(sum(copies) as bigint) as n_rows, count(*) filter (where copies > 0) as n_distinct from c group by quality""")
def oversample_counts(spark, sf):
    """ML4: minority class replicated exactly to the majority size."""
    o = ml.oversample(_labelled(spark, sf), "quality", "doc_id", 42)
    return o.groupBy("quality").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_distinct"))


# ------------------------------------------------------------------ features + models

def _features(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select(
        "doc_id", "lang", F.log10(F.col("n_chars") + 1).alias("log_chars"),
        F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("n_digits"),
        F.try_divide(F.length(F.regexp_replace("text", "[^A-Z]", "")), F.length("text")).alias("upper_share"))
    j = t.labels.select("doc_id", "quality").join(d, "doc_id")
    j, lang_cols = ml.one_hot_drop_first(j, "lang", "lang")
    return j, ["log_chars", "n_words", "n_lines", "n_digits", "upper_share", *lang_cols]


#: per application and folder: the written training table; per model: its written scores (tables in the shared folder)
_TRAINING: dict[tuple, tuple] = {}
_MODELS: dict[tuple, tuple] = {}

TREE = {"impurity": "gini", "maxDepth": 5, "minInstancesPerNode": 1}
FOREST = {"numTrees": 100, "maxDepth": 10}
GBT = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 3}


def _application(spark, sf) -> tuple:
    """The run and the files that a memo holds for."""
    t = Tables(spark, sf)
    return spark.sparkContext.applicationId, *sorted([*t.documents.inputFiles(), *t.labels.inputFiles()])


def training_table(spark, sf):
    """(train, test, feature columns): features, split and oversampled copies, computed and written once per run."""
    key = _application(spark, sf)
    if key not in _TRAINING:
        data, cols = _features(spark, sf)
        path = scratch_path(spark, "features")
        ml.stratified_split(data, "quality", "doc_id", 0.2, 42).write.partitionBy("split").parquet(path)
        split = spark.read.parquet(path)
        copies = scratch_path(spark, "train")
        ml.oversample(split.where(F.col("split") == "train"), "quality", "doc_id", 42).write.parquet(copies)
        _TRAINING[key] = (spark.read.parquet(copies), split.where(F.col("split") == "test"), cols)
    return _TRAINING[key]


def fitted(spark, sf, kind, **params):
    """(scores, model, feature columns): fitted once per run on the training table; scores of both sides, written,
    with the columns split, doc_id, quality, score and the features."""
    key = (*_application(spark, sf), kind, *sorted(params.items()))
    if key not in _MODELS:
        train, test, cols = training_table(spark, sf)
        model, scored_test, scored_train = ml.fit_score(train, test, cols, "quality", kind, **params)
        path = scratch_path(spark, "scores")
        keep = ["split", "doc_id", "quality", "score", *cols]
        scored_train.select(*keep).unionByName(scored_test.select(*keep)).write.parquet(path)
        _MODELS[key] = (spark.read.parquet(path), model, cols)
    return _MODELS[key]


def _eval_model(spark, sf, kind, **params):
    scores, _, _ = fitted(spark, sf, kind, **params)
    m = ml.threshold_metrics(scores, "quality", "score", 0.5, by=["split"]).select("split", "accuracy", "precision", "recall", "f1")
    a = [ml.auc(scores.where(F.col("split") == s), "quality", "score").withColumn("split", F.lit(s)) for s in ("train", "test")]
    return m.join(a[0].unionByName(a[1]), "split").select("accuracy", "precision", "recall", "f1", "auc", "split", F.lit(kind).alias("model"))


@query("decision_tree_eval")
def decision_tree_eval(spark, sf):
    """ML5 + ML8: gini tree, depth 5, min leaf 1; train/test metrics after exact oversampling."""
    return _eval_model(spark, sf, "tree", **TREE)


@query("random_forest_eval")
def random_forest_eval(spark, sf):
    """ML6 + ML8: random forest, 100 trees, depth 10."""
    return _eval_model(spark, sf, "forest", **FOREST)


@query("gbt_eval")
def gbt_eval(spark, sf):
    """ML7 + ML8: gradient boosting, 100 rounds, step 0.1, depth 3."""
    return _eval_model(spark, sf, "gbt", **GBT)


@query("tree_rules")
def tree_rules(spark, sf):
    """ML16: rule text of the fitted decision tree (feature names substituted)."""
    _, model, cols = fitted(spark, sf, "tree", **TREE)
    return ml.tree_rules(model, cols, spark)


@query("feature_importance")
def feature_importance(spark, sf):
    """ML9: top-15 feature importances of the forest, with feature names."""
    _, model, cols = fitted(spark, sf, "forest", **FOREST)
    return ml.feature_importances(model, cols, spark, 15)


# the training side has as many rows of each class as the larger class
_SPLIT_SIZES_SQL = """(
with d as (select quality, count(*) as n from labels join documents using (doc_id) where quality is not null group by 1),
t as (select quality, n, ceil(n::decimal(20,0) * 0.2)::bigint as test_n from d)
select 'train' as split, count(*) * max(n - test_n) as n_rows from t union all select 'test', sum(test_n) from t)"""


@query("rule_scores", f"""
select model, split, n_rows::bigint as n_rows, 0::bigint as n_differ from {_SPLIT_SIZES_SQL}, (values ('tree'), ('gbt')) m(model)""")
def rule_scores(spark, sf):
    """ML16: the fitted tree and the boosted trees compiled to one expression each; rows whose score differs from
    the model's own (none)."""
    out = []
    for kind, params in (("tree", TREE), ("gbt", GBT)):
        scores, model, cols = fitted(spark, sf, kind, **params)
        own = rules.score_column(rules.tree_nodes(model, spark), cols, kind)
        out.append(scores.select("split", (~(F.abs(own - F.col("score")) < 1e-9)).alias("differs")).groupBy("split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if("differs").alias("n_differ")).select(F.lit(kind).alias("model"), "split", "n_rows", "n_differ"))
    return out[0].unionByName(out[1])


# a tree of depth two over yes/no features, grown in SQL: the split with the largest gain, children of the same class merged
_FLAGS = ["is_en", "is_long", "has_digit", "has_break"]
_SMALL_TREE_SQL = """
with d as (select quality as y, [coalesce((lang = 'en')::int, 0), coalesce((n_chars >= 1000)::int, 0),
                  coalesce(regexp_matches(text, '[0-9]')::int, 0), coalesce(contains(text, chr(10))::int, 0)] as f
           from labels join documents using (doc_id) where quality is not null),
c as (select f, count(*) as n, sum(y) as p from d group by f),
u as (select f, n, p, i, f[i + 1] as v from c, range(4) t(i)),
g1 as (select i, coalesce(sum(n) filter (v = 0), 0) as n0, coalesce(sum(p) filter (v = 0), 0) as p0,
              coalesce(sum(n) filter (v = 1), 0) as n1, coalesce(sum(p) filter (v = 1), 0) as p1 from u group by i),
s1 as (select *, gini(p0 + p1, n0 + n1) - (n0 * gini(p0, n0) + n1 * gini(p1, n1)) / (n0 + n1) as gain from g1 where n0 > 0 and n1 > 0),
b1 as (select * from s1 where gain > 0 order by gain desc, i limit 1),
g2 as (select u.f[b1.i + 1] as side, u.i, coalesce(sum(u.n) filter (v = 0), 0) as n0, coalesce(sum(u.p) filter (v = 0), 0) as p0,
              coalesce(sum(u.n) filter (v = 1), 0) as n1, coalesce(sum(u.p) filter (v = 1), 0) as p1 from u, b1 group by 1, 2),
s2 as (select *, gini(p0 + p1, n0 + n1) - (n0 * gini(p0, n0) + n1 * gini(p1, n1)) / (n0 + n1) as gain from g2 where n0 > 0 and n1 > 0),
b2 as (select * from s2 where gain > 0 and (2 * p0 > n0) <> (2 * p1 > n1)
         and not exists (select 1 from s2 better where better.side = s2.side and (better.gain > s2.gain or (better.gain = s2.gain and better.i < s2.i))))
"""


def _with_gini(sql: str) -> str:
    """DuckDB has no gini(p, n): written out."""
    return re.sub(r"gini\(([^,()]+), ([^()]+)\)", r"(1 - ((\1) / (\2)) ** 2 - (1 - (\1) / (\2)) ** 2)", sql)


def _small_tree(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", (F.col("lang") == "en").alias("is_en"), (F.col("n_chars") >= 1000).alias("is_long"),
                           F.rlike("text", F.lit("[0-9]")).alias("has_digit"), F.contains("text", F.lit("\n")).alias("has_break"))
    d = d.select("doc_id", *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in _FLAGS])
    data = t.labels.select("doc_id", "quality").where("quality is not null").join(d, "doc_id")
    model, _, _ = ml.fit_score(data, data, _FLAGS, "quality", "tree", impurity="gini", maxDepth=2, minInstancesPerNode=1)
    return rules.tree_nodes(model, spark)


_NAME_SQL = "(['is_en', 'is_long', 'has_digit', 'has_break'])[{i} + 1]"


@query("small_tree_leaves", _with_gini(_SMALL_TREE_SQL) + f"""
, l as (
  select {_NAME_SQL.format(i='b1.i')} || case when b2.side = 0 then ' <= 0.5' else ' > 0.5' end || ' and ' || {_NAME_SQL.format(i='b2.i')} || ' <= 0.5' as rule,
         b2.n0 as n, b2.p0 as p from b1, b2
  union all select {_NAME_SQL.format(i='b1.i')} || case when b2.side = 0 then ' <= 0.5' else ' > 0.5' end || ' and ' || {_NAME_SQL.format(i='b2.i')} || ' > 0.5',
         b2.n1, b2.p1 from b1, b2
  union all select {_NAME_SQL.format(i='b1.i')} || ' <= 0.5', n0, p0 from b1 where not exists (select 1 from b2 where side = 0)
              and not ((2 * p0 > n0) = (2 * p1 > n1) and not exists (select 1 from b2))
  union all select {_NAME_SQL.format(i='b1.i')} || ' > 0.5', n1, p1 from b1 where not exists (select 1 from b2 where side = 1)
              and not ((2 * p0 > n0) = (2 * p1 > n1) and not exists (select 1 from b2))
  union all select '', sum(n), sum(p) from c having not exists (select 1 from b1)
              or (not exists (select 1 from b2) and (select (2 * p0 > n0) = (2 * p1 > n1) from b1)))
select rule, n::bigint as n_rows, round(p / n, {R}) as share, (2 * p > n)::int::double as prediction from l""")
def small_tree_leaves(spark, sf):
    """ML5 / ML16: a tree over four yes/no features, whose every leaf SQL can work out."""
    d = rules.leaves(_small_tree(spark, sf), _FLAGS, spark)
    return d.select("rule", "n_rows", C.round_half_away("share", R).alias("share"), "prediction")


@query("small_tree_importance", _with_gini(_SMALL_TREE_SQL) + f"""
, parts as (
  select b1.i, (b1.n0 + b1.n1) * b1.gain as w from b1 where exists (select 1 from b2) or (2 * p0 > n0) <> (2 * p1 > n1)
  union all select i, (n0 + n1) * gain from b2),
w as (select n.name, coalesce(sum(parts.w), 0) as w from (select i, {_NAME_SQL.format(i='i')} as name from range(4) t(i)) n left join parts using (i) group by 1)
select name as feature, round(coalesce(w / nullif((select sum(w) from w), 0), 0), {R}) as importance from w""")
def small_tree_importance(spark, sf):
    """ML9: importances of that tree."""
    d = rules.importances(_small_tree(spark, sf), _FLAGS, spark)
    return d.select("feature", C.round_half_away("importance", R).alias("importance"))


# ------------------------------------------------------------------ metric code on a fixed score column

def _scored(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", (F.log10(F.col("n_chars") + 1) / 5).alias("score"))
    return t.labels.select("doc_id", "quality").join(d, "doc_id")


_SCORED_SQL = "(select l.doc_id, l.quality, log10(d.n_chars + 1) / 5 as score from labels l join documents d using (doc_id))"


@query("threshold_metrics", f"""
with c as (select count(*) filter (where quality = 1 and score >= 0.6) as tp, count(*) filter (where quality = 0 and score >= 0.6) as fp,
                  count(*) filter (where quality = 1 and score < 0.6) as fn, count(*) filter (where quality = 0 and score < 0.6) as tn
           from {_SCORED_SQL})
select tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), {R}) as accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), {R}) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), {R}) as recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), {R}) as f1 from c""")
def threshold_metrics(spark, sf):
    m = ml.threshold_metrics(_scored(spark, sf), "quality", "score", 0.6)
    return m.select("tp", "fp", "fn", "tn", *[C.round_half_away(c, R).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


@query("auc_rank", f"""
with g as (select round(score, 2) as s, sum(quality) as pos, sum(1 - quality) as neg from {_SCORED_SQL} group by 1),
c as (select s, pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below from g)
select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), {R}) as auc from c""")
def auc_rank(spark, sf):
    """ML8: rank-sum AUC with ties (scores rounded to 2 digits so that ties occur)."""
    s = _scored(spark, sf).withColumn("score", C.round_half_away("score", 2))
    return ml.auc(s, "quality", "score").select(C.round_half_away("auc", R).alias("auc"))


@query("confusion", f"""
select quality as actual, cast(score >= 0.6 as int) as predicted, count(*) as n from {_SCORED_SQL} group by 1, 2""")
def confusion(spark, sf):
    """ML9: confusion matrix in long form."""
    s = _scored(spark, sf)
    return s.groupBy(F.col("quality").alias("actual"), (F.col("score") >= 0.6).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


@query("fit_diagnosis", f"""
with s as (select *, case when row_number() over (partition by quality order by md5(cast(doc_id as varchar) || '42'), doc_id)
                            <= ceil(count(*) over (partition by quality) * 0.2) then 'test' else 'train' end as split from {_SCORED_SQL}),
m as (select split, (count(*) filter (where (score >= 0.6) = (quality = 1)))::double / count(*) as acc,
             coalesce(2.0 * count(*) filter (where quality = 1 and score >= 0.6) /
               nullif(2 * count(*) filter (where quality = 1 and score >= 0.6) + count(*) filter (where quality = 0 and score >= 0.6)
                      + count(*) filter (where quality = 1 and score < 0.6), 0), 0) as f1 from s group by split),
w as (select max(acc) filter (where split = 'train') as train_acc, max(acc) filter (where split = 'test') as test_acc,
             max(f1) filter (where split = 'train') as train_f1, max(f1) filter (where split = 'test') as test_f1 from m)
select round(train_acc, {R}) as train_acc, round(test_acc, {R}) as test_acc, round(train_f1, {R}) as train_f1, round(test_f1, {R}) as test_f1,
  case when train_acc < 0.70 and test_acc < 0.70 then 'underfit'
       when train_acc - test_acc > 0.07 or train_f1 - test_f1 > 0.08 then 'overfit' else 'good' end as diagnosis from w""")
def fit_diagnosis(spark, sf):
    """ML11: train vs test metrics of the fixed-score classifier -> under/over-fit class."""
    s = ml.stratified_split(_scored(spark, sf), "quality", "doc_id", 0.2, 42)
    m = ml.threshold_metrics(s, "quality", "score", 0.6, by=["split"])
    w = m.agg(*[F.max(F.when(F.col("split") == sp, F.col(c))).alias(f"{sp}_{n}")
                for sp in ("train", "test") for c, n in (("accuracy", "acc"), ("f1", "f1"))])
    return w.select(*[C.round_half_away(c, R).alias(c) for c in ["train_acc", "test_acc", "train_f1", "test_f1"]],
                    ml.fit_diagnosis(F.col("train_acc"), F.col("test_acc"), F.col("train_f1"), F.col("test_f1")).alias("diagnosis"))


# ------------------------------------------------------------------ regression side (weather / price)

def _feature_frame(spark, sf):
    e = Tables(spark, sf).events
    d = panel.daily(e, "ts", [], [F.avg("value").alias("avg_temp"), F.max("value").alias("max_temp"),
                                  F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("rain")])
    d = d.withColumn("hot_flag", C.flag_at_least("max_temp", 480)).withColumn("rain_flag", (F.col("rain") > 0).cast("int"))
    d = d.withColumn("__s", F.lit(1))
    d = panel.rolling(d, ["__s"], "day", ["avg_temp", "rain", "hot_flag"], 30, fns=("sum", "avg"))
    return d.drop("__s").withColumn("doy_sin", C.cycle_sin("day")).withColumn("doy_cos", C.cycle_cos("day"))


@query("feature_frame", f"""
with d as (select cast(ts as date) as day, avg(value) as avg_temp, max(value) as max_temp,
                  sum(case when event_type = 'purchase' then value else 0 end) as rain from events group by 1),
f as (select *, coalesce(cast(max_temp >= 480 as int), 0) as hot_flag, cast(rain > 0 as int) as rain_flag from d)
select day, round(avg_temp, {R}) as avg_temp, max_temp, round(rain, {R}) as rain, hot_flag, rain_flag,
  round(sum(avg_temp) over w, {R}) as avg_temp_sum30, round(avg(avg_temp) over w, {R}) as avg_temp_avg30,
  round(sum(rain) over w, {R}) as rain_sum30, round(avg(rain) over w, {R}) as rain_avg30,
  cast(sum(hot_flag) over w as bigint) as hot_flag_sum30, round(avg(hot_flag) over w, {R}) as hot_flag_avg30,
  round(sin(2 * pi() * dayofyear(day) / 365.25), {R}) as doy_sin, round(cos(2 * pi() * dayofyear(day) / 365.25), {R}) as doy_cos
from f window w as (order by day rows between 29 preceding and current row)""")
def feature_frame(spark, sf):
    """ML12: daily features: 0/1 flags, 30-row rolling sums/means, yearly cycle encoding.

    The rolling window runs after the reduction to one row per day (bounded by
    the calendar), so its single series is small whatever the event volume.
    """
    f = _feature_frame(spark, sf)
    flt = ["avg_temp", "rain", "avg_temp_sum30", "avg_temp_avg30", "rain_sum30", "rain_avg30", "hot_flag_avg30", "doy_sin", "doy_cos"]
    return f.select("day", *[C.round_half_away(c, R).alias(c) if c in flt else F.col(c) for c in
                             ["avg_temp", "max_temp", "rain", "hot_flag", "rain_flag", "avg_temp_sum30", "avg_temp_avg30",
                              "rain_sum30", "rain_avg30", "hot_flag_sum30", "hot_flag_avg30", "doy_sin", "doy_cos"]]) \
        .withColumn("hot_flag_sum30", F.col("hot_flag_sum30").cast("bigint"))


@query("forest_per_item")
def forest_per_item(spark, sf):
    """ML13: one random forest (300 trees, depth 15) per item on daily price features; <20 rows -> rule mode."""
    o = Tables(spark, sf).orders
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [F.avg("o_totalprice").alias("price"),
                                                            F.count(F.lit(1)).cast("double").alias("n_orders")])
    d = d.withColumn("doy_sin", C.cycle_sin("day")).withColumn("doy_cos", C.cycle_cos("day")) \
        .withColumn("year", F.year("day").cast("double"))
    return ml.per_item_forest(d, "o_orderpriority", "day", ["n_orders", "doy_sin", "doy_cos", "year"], "price")


@query("mae_mape", f"""
with p as (select l_extendedprice as y, l_quantity * p_retailprice as yhat,
                  case when year(l_shipdate) <= 1999 then 'train'
                       when year(l_shipdate) = 2001 and month(l_shipdate) in (3, 4, 5, 6) then 'test' end as split
           from lineitem join part on l_partkey = p_partkey)
select split, count(*) as n, round(avg(abs(y - yhat)), {R}) as mae, round(avg(abs((y - yhat) / nullif(y, 0))) * 100, {R}) as mape,
       round(1 - sum((y - yhat) * (y - yhat)) / nullif(sum((y - (select avg(y) from p p2 where p2.split = p.split)) * (y - (select avg(y) from p p2 where p2.split = p.split))), 0), {R}) as r2
from p where split is not null group by split""")
def mae_mape(spark, sf):
    """ML14: temporal hold-out (train <= 1999, test Mar-Jun 2001): MAE, MAPE %, R^2 of a price formula."""
    from sparkpanel.operators.clean import temporal_split

    t = Tables(spark, sf)
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = t.lineitem.select("l_partkey", "l_extendedprice", "l_quantity", "l_shipdate").join(parts, "l_partkey")
    p = j.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"),
                 temporal_split(F.col("l_shipdate"), 1999, 2001, [3, 4, 5, 6]).alias("split")).where(F.col("split").isNotNull())
    e = F.col("y") - F.col("yhat")
    # squares around the mean from the variance: joining the means would send all rows of a split to one task
    around = F.var_pop("y") * F.count("y")
    g = p.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                               (F.avg(F.abs(F.try_divide(e, F.col("y")))) * 100).alias("mape"),
                               (1 - F.try_divide(F.sum(e * e), around)).alias("r2"))
    return g.select("split", "n", *[C.round_half_away(c, R).alias(c) for c in ["mae", "mape", "r2"]])


# Rule-mode coefficients of the scenario scorer (temperature, rain) and the clamp range.
SCENARIO_RULES = [("normal", 0.0, 0.0), ("heatwave", 4.0, 0.0), ("monsoon", 0.0, 150.0), ("cold_snap", -6.0, 20.0)]
TEMP_COEF, RAIN_COEF, CLAMP = 0.012, 0.0004, (0.5, 2.0)


@query("scenario_rule_score", """
with s as (select * from (values {vals}) t(scenario, temp_delta, rain))
select p.p_partkey, s.scenario, round(p.p_retailprice * greatest({lo}, least({hi}, 1 + {tc} * s.temp_delta + {rc} * s.rain)), {R}) as predicted,
       round(p.p_retailprice * greatest({lo}, least({hi}, 1 + {tc} * s.temp_delta + {rc} * s.rain)) - p.p_retailprice, {R}) as change,
       round((greatest({lo}, least({hi}, 1 + {tc} * s.temp_delta + {rc} * s.rain)) - 1) * 100, {R}) as change_pct
from part p, s""".format(vals=", ".join(f"('{n}', {t}, {r})" for n, t, r in SCENARIO_RULES), lo=CLAMP[0], hi=CLAMP[1],
                         tc=TEMP_COEF, rc=RAIN_COEF, R=R))
def scenario_rule_score(spark, sf):
    """ML15 (rule mode): every scenario scored for every item; factor clamped; change and % vs base price.

    Scenarios are a literal array exploded per item (a generator, no join).
    """
    p = Tables(spark, sf).part.select("p_partkey", "p_retailprice")
    arr = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(t)).alias("temp_delta"), F.lit(float(r)).alias("rain"))
                    for n, t, r in SCENARIO_RULES])
    x = p.select("p_partkey", "p_retailprice", F.explode(arr).alias("s"))
    factor = C.clamp(1 + TEMP_COEF * F.col("s.temp_delta") + RAIN_COEF * F.col("s.rain"), CLAMP[0], CLAMP[1])
    pred = F.col("p_retailprice") * factor
    return x.select("p_partkey", F.col("s.scenario").alias("scenario"), C.round_half_away(pred, R).alias("predicted"),
                    C.round_half_away(pred - F.col("p_retailprice"), R).alias("change"), C.round_half_away((factor - 1) * 100, R).alias("change_pct"))


# Scenarios of the model mode (change of the daily order count) and the clamp around the last price.
MODEL_SCENARIOS = [("quiet", -2.0), ("normal", 0.0), ("busy", 3.0)]


@query("scenario_model_score", """
with d as (select o_orderpriority as item, cast(o_orderdate as date) as day, avg(o_totalprice) as price, count(*)::double as n from orders group by 1, 2),
f as (select item, regr_slope(price, n) as b, regr_intercept(price, n) as a, arg_max(price, day) as last_price, arg_max(n, day) as last_n from d group by 1),
s as (select * from (values {vals}) t(scenario, delta)),
p as (select item, scenario, last_price, greatest({lo} * last_price, least({hi} * last_price, coalesce(a + b * (last_n + delta), last_price))) as predicted from f, s)
select item, scenario, round(last_price, {R}) as last_price, round(predicted, {R}) as predicted, round(predicted - last_price, {R}) as change,
       round((predicted - last_price) * 100 / nullif(last_price, 0), {R}) as change_pct from p""".format(
    vals=", ".join(f"('{n}', {d})" for n, d in MODEL_SCENARIOS), lo=CLAMP[0], hi=CLAMP[1], R=R))
def scenario_model_score(spark, sf):
    """ML15 (model mode): one least-squares model per item, all fitted by one aggregation; every scenario
    scored from the item's last day; clamped around the last price; items without a slope keep it."""
    o = Tables(spark, sf).orders
    d = panel.daily(o, "o_orderdate", ["o_orderpriority"], [F.avg("o_totalprice").alias("price"), F.count(F.lit(1)).cast("double").alias("n")])
    f = d.groupBy(F.col("o_orderpriority").alias("item")).agg(
        F.regr_slope("price", "n").alias("b"), F.regr_intercept("price", "n").alias("a"),
        F.max_by("price", "day").alias("last_price"), F.max_by("n", "day").alias("last_n"))
    scenarios = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(x).alias("delta")) for n, x in MODEL_SCENARIOS])
    x = f.select("*", F.inline(scenarios))
    last = F.col("last_price")
    predicted = F.coalesce(F.col("a") + F.col("b") * (F.col("last_n") + F.col("delta")), last)
    x = x.withColumn("p", F.greatest(CLAMP[0] * last, F.least(CLAMP[1] * last, predicted)))
    return x.select("item", "scenario", C.round_half_away("last_price", R).alias("last_price"), C.round_half_away("p", R).alias("predicted"),
                    C.round_half_away(F.col("p") - last, R).alias("change"),
                    C.round_half_away(F.try_divide((F.col("p") - last) * 100, last), R).alias("change_pct"))


# Scenarios of the all-feature mode (changes of the daily order count and of the yearly cycle).
LINEAR_SCENARIOS = [("quiet", -2.0, 0.0), ("normal", 0.0, 0.0), ("summer", 1.0, 0.5)]


@query("scenario_linear_score", """
with o as (select case when o_custkey % 50 = 0 then 'few ' || (o_custkey % 7) else o_orderpriority end as item, o_orderdate::date as day, o_totalprice from orders),
d as (select item, day, avg(o_totalprice) as price, count(*)::double as n, sin(2 * pi() * dayofyear(day) / 365.25) as s from o group by 1, 2),
m as (select item, count(*) as rows, avg(price) as y, avg(n) as a1, avg(s) as a2, var_pop(n) as v1, var_pop(s) as v2, covar_pop(n, s) as c12,
             covar_pop(n, price) as c1, covar_pop(s, price) as c2, arg_max(price, day) as last_price, arg_max(n, day) as last_n, arg_max(s, day) as last_s from d group by 1),
f as (select *, rows >= 40 and v1 > 0 and v2 > 0 as ok, (c1 * v2 - c2 * c12) / nullif(v1 * v2 - c12 * c12, 0) as b1,
             (c2 * v1 - c1 * c12) / nullif(v1 * v2 - c12 * c12, 0) as b2 from m),
p as (select item, scenario, case when ok then 'model' else 'rule' end as mode, last_price,
             case when ok then greatest({lo} * last_price, least({hi} * last_price, y + b1 * (last_n + dn - a1) + b2 * (last_s + ds - a2)))
                  else last_price * greatest({lo}, least({hi}, 1 + {tc} * dn)) end as predicted
      from f, (values {vals}) t(scenario, dn, ds))
select item, scenario, mode, round(last_price, {R}) as last_price, round(predicted, {R}) as predicted,
       round((predicted - last_price) * 100 / nullif(last_price, 0), {R}) as change_pct from p""".format(
    vals=", ".join(f"('{n}', {a}, {b})" for n, a, b in LINEAR_SCENARIOS), lo=CLAMP[0], hi=CLAMP[1], tc=TEMP_COEF, R=R))
def scenario_linear_score(spark, sf):
    """ML15 (model mode, all features): one model per item by normal equations from one aggregation; items with few
    days or features that do not determine a model are scored by the rule."""
    o = Tables(spark, sf).orders
    item = F.when(F.col("o_custkey") % 50 == 0, F.concat(F.lit("few "), (F.col("o_custkey") % 7).cast("string"))).otherwise(F.col("o_orderpriority"))
    d = panel.daily(o.withColumn("item", item), "o_orderdate", ["item"], [F.avg("o_totalprice").alias("price"), F.count(F.lit(1)).cast("double").alias("n")])
    d = d.withColumn("s", C.cycle_sin("day"))
    last = d.groupBy("item").agg(F.max_by(F.struct("price", "n", "s"), "day").alias("last"))
    x = linear.fit_items(d, ["item"], ["n", "s"], "price", min_rows=40).join(last, "item")
    x = x.select("*", F.inline(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(a).alias("dn"), F.lit(b).alias("ds")) for n, a, b in LINEAR_SCENARIOS])))
    price = F.col("last.price")
    by_model = C.clamp(linear.predicted([F.col("last.n") + F.col("dn"), F.col("last.s") + F.col("ds")]), CLAMP[0] * price, CLAMP[1] * price)
    by_rule = price * C.clamp(1 + TEMP_COEF * F.col("dn"), CLAMP[0], CLAMP[1])
    x = x.withColumn("p", F.when(F.col("mode") == "model", by_model).otherwise(by_rule))
    return x.select("item", "scenario", "mode", C.round_half_away(price, R).alias("last_price"), C.round_half_away("p", R).alias("predicted"),
                    C.round_half_away(F.try_divide((F.col("p") - price) * 100, price), R).alias("change_pct"))
