"""Split, preparation and metric queries on the plain tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assay.operators import metrics, prepare, splits, strata
from assay.operators.counts import KEY, with_dataset
from assay.operators.ranks import shuffled_rank
from assay.functions import values as fv
from assay.queries.base import duck, query, table
from assay.queries.findings import scores_sql
from assay.settings import PUBLISHED

SEED = 42


def _hex(c: str) -> str:
    return f"('0x' || substr({c}, 1, 7))::int"


# --- splits and folds ---

@query("stratified_split", """
    with r as (select *, row_number() over (partition by o_orderstatus order by md5(o_orderkey || '|42')) - 1 as i,
                 count(*) over (partition by o_orderstatus) as n from orders)
    select o_orderkey, o_orderstatus, i < ceil(n * 0.2) as is_test from r""")
def stratified_split(spark, folder):
    out = splits.stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus", 0.2, SEED)
    return out.select("o_orderkey", "o_orderstatus", "is_test")


@query("random_split", f"select o_orderkey, {_hex(chr(109) + 'd5(o_orderkey || ' + repr('|42') + ')')} < {int(0.2 * 16**7)} as is_test from orders")
def random_split(spark, folder):
    return splits.random_split(table(spark, folder, "orders"), "o_orderkey", 0.2, SEED).select("o_orderkey", "is_test")


@query("stratified_folds", """
    select o_orderkey, o_orderstatus, cast((row_number() over (partition by o_orderstatus order by md5(o_orderkey || '|42')) - 1) % 5 as int) as fold from orders""")
def stratified_folds(spark, folder):
    out = splits.stratified_folds(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus", 5, SEED)
    return out.select("o_orderkey", "o_orderstatus", "fold")


@query("kfolds", f"select o_orderkey, cast({_hex(chr(109) + 'd5(o_orderkey || ' + repr('|42') + ')')} % 3 as int) as fold from orders")
def kfolds(spark, folder):
    return splits.folds(table(spark, folder, "orders"), "o_orderkey", 3, SEED).select("o_orderkey", "fold")


# The month of an order: twelve values, all frequent.
BY_MONTH = "select o_orderkey, cast(month(o_orderdate) as double) as y from {orders}"
# Months, prices in steps of 5,000 for one order in 20, none for one in 50: values from one row to thousands.
MIXED = """
    select o_orderkey, case when o_orderkey % 50 = 7 then null when o_orderkey % 20 = 0 then floor(o_totalprice / 5000) + 100
           else month(o_orderdate) end as y from (select o_orderkey, o_orderdate, o_totalprice from {orders}) o"""


def _strata_sql(rows: str, least: int, run: int) -> str:
    """Common tables up to r(o_orderkey, y, place): the row's number, stratum by stratum."""
    return f"""
    with t as (select o_orderkey, cast(y as double) as y from ({rows.replace('{orders}', 'orders')}) x where y is not null),
    v as (select y, count(*) as n, count(*) < {least} as rare from t group by y),
    b as (select *, coalesce(sum(n) over (order by rare desc, y rows between unbounded preceding and 1 preceding), 0) as before,
            (select sum(n) from v where rare) as rare_rows from v),
    s as (select *, case when rare then -1 - least(before // {run}, greatest(rare_rows // {run}, 1) - 1) else before end as stratum from b),
    f as (select y, stratum, min(before) over (partition by stratum) as first from s),
    r as (select o_orderkey, y, cast(first + row_number() over (partition by stratum order by md5(o_orderkey || '|42')) - 1 as bigint) as place
          from t join f using (y))"""


def _targets(spark, folder, text):
    return spark.sql(text, orders=table(spark, folder, "orders")).withColumn("y", F.col("y").cast("double"))


@query("value_split", _strata_sql(BY_MONTH, 10, 100) + " select o_orderkey, y, (place + 1) // 5 > place // 5 as is_test from r")
def value_split(spark, folder):
    return strata.value_split(_targets(spark, folder, BY_MONTH), "o_orderkey", "y", 0.2, SEED)


@query("value_split_rare", _strata_sql(MIXED, 10, 100) + " select o_orderkey, y, ((place + 1) * 3) // 10 > (place * 3) // 10 as is_test from r")
def value_split_rare(spark, folder):
    return strata.value_split(_targets(spark, folder, MIXED), "o_orderkey", "y", 0.3, SEED)


@query("value_folds", _strata_sql(MIXED, 10, 100) + " select o_orderkey, y, cast(place % 5 as int) as fold from r")
def value_folds(spark, folder):
    return strata.value_folds(_targets(spark, folder, MIXED), "o_orderkey", "y", 5, SEED)


@query("time_folds", """
    with c as (select quantile_cont(epoch_us(ts)::double, [0.25, 0.5, 0.75]) as q from events)
    select event_id, cast(len(list_filter(q, lambda x: x <= epoch_us(ts))) as int) as time_block from events cross join c""")
def time_folds(spark, folder):
    return splits.time_folds(table(spark, folder, "events"), "ts", 3).select("event_id", "time_block")


@query("fold_count", """
    with c as (select o_orderpriority as g, count(*) as n, min(k) as smallest from (select o_orderpriority, count(*) over (partition by o_orderpriority, o_orderstatus) as k from orders) group by 1)
    select g, n as n_row, least(case when n < 1000 then 5 else 3 end, smallest) as folds from c""")
def fold_count(spark, folder):
    per = table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("k"))
    whole = per.groupBy(F.col("o_orderpriority").alias("g")).agg(F.sum("k").alias("n_row"), F.min("k").alias("smallest"))
    return whole.select("g", "n_row", splits.fold_count(F.col("n_row"), F.col("smallest"), PUBLISHED.small_rows).alias("folds"))


@query("tuning_sample", """
    with r as (select *, row_number() over (partition by o_orderstatus order by md5(o_orderkey || '|42')) - 1 as i,
                 count(*) over (partition by o_orderstatus) as n, count(*) over () as total from orders)
    select o_orderkey, o_orderstatus from r where total <= 10000 or i < ceil(10000 * n / total)""")
def tuning_sample(spark, folder):
    return splits.tuning_sample(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus", PUBLISHED.tune_rows, seed=SEED).select("o_orderkey", "o_orderstatus")


PREPARED = f"""with t as (select l_orderkey, l_linenumber, l_quantity as q, disc_q as d, flag_h as h, l_orderkey % 97 as c, cast(l_quantity > 25 as int) as y
        from {duck('v_missing')}),
    m as (select quantile_cont(q, 0.5) as mq, quantile_cont(d, 0.5) as md from t),
    mode as (select h from t where h is not null group by h order by count(*) desc, h limit 1),
    f as (select t.*, coalesce(q, mq) as q1, coalesce(d, md) as d1 from t cross join m),
    s as (select *, (q1 - avg(q1) over ()) / stddev_pop(q1) over () as sq, (d1 - avg(d1) over ()) / stddev_pop(d1) over () as sd from f),
    p as (select *, sq * sq as qq, sq * sd as qd, sd * sd as dd from s),
    e as (select c, count(y) as n, avg(y) as m, var_pop(y) as v from t group by c),
    g as (select avg(y) as gm, var_pop(y) as gv from t),
    te as (select c, n * gv / (n * gv + v) * m + (1 - n * gv / (n * gv + v)) * gm as mean from e cross join g)
    select l_orderkey, l_linenumber,
      {", ".join(f"round(({x} - avg({x}) over ()) / stddev_pop({x}) over (), 5) as f{i}" for i, x in enumerate(("sq", "sd", "qq", "qd", "dd")))},
      {", ".join(f"cast(case when coalesce(p.h, mode.h) = '{x}' then 1 else 0 end as double) as f{i}" for i, x in enumerate("ANR", 5))},
      round(te.mean, 5) as f8
    from p cross join mode join te on te.c = p.c"""


@query("prepared_features", PREPARED)
def prepared_features(spark, folder):
    """What models learn from: medians, scaling, degree-two terms, one-hot levels and encoded categories, fitted and applied."""
    from pyspark.ml.functions import vector_to_array

    from assay.operators.fitting import FeaturePlan, fit_preparation
    df = table(spark, folder, "v_missing").withColumn("c", F.col("l_orderkey") % 97)
    plan = FeaturePlan(("l_quantity", "disc_q"), (), ("flag_h",), ("c",), polynomial=True)
    fitted = fit_preparation(df, plan, [(F.col("l_quantity") > 25).cast("double")])
    rows = fitted.transform(df).withColumn("x", vector_to_array("features"))
    return rows.select("l_orderkey", "l_linenumber", *[F.round(F.col("x")[i], 5).alias(f"f{i}") for i in range(9)])


# --- preparation ---

GAPS = """select l_orderkey, l_linenumber, l_quantity, case when l_orderkey % 4 = 0 then null else l_discount end as disc_q,
    case when l_orderkey % 2 = 0 then null else l_returnflag end as flag_h from lineitem"""


@query("impute_median", f"""
    with v as ({GAPS}), m as (select median(disc_q) as m from v)
    select l_orderkey, l_linenumber, coalesce(disc_q, m) as disc_q, l_quantity from v cross join m""")
def impute_median(spark, folder):
    out = prepare.impute_median(table(spark, folder, "v_missing"), ["disc_q", "l_quantity"])
    return out.select("l_orderkey", "l_linenumber", "disc_q", "l_quantity")


@query("impute_mode", f"""
    with v as ({GAPS}), m as (select flag_h as m from v where flag_h is not null group by 1 order by count(*) desc, 1 limit 1)
    select l_orderkey, l_linenumber, coalesce(flag_h, m) as flag_h from v cross join m""")
def impute_mode(spark, folder):
    return prepare.impute_mode(table(spark, folder, "v_missing"), ["flag_h"]).select("l_orderkey", "l_linenumber", "flag_h")


@query("impute_indicator", f"""
    with v as ({GAPS}), m as (select median(disc_q) as m from v)
    select l_orderkey, l_linenumber, coalesce(disc_q, m) as disc_q, cast(disc_q is null as int) as disc_q_missing,
           coalesce(flag_h, '__missing__') as flag_h from v cross join m""")
def impute_indicator(spark, folder):
    out = prepare.impute_robust(table(spark, folder, "v_missing"), ["disc_q"], ["flag_h"])
    return out.select("l_orderkey", "l_linenumber", "disc_q", "disc_q_missing", "flag_h")


@query("standard_scale", """
    with s as (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as d, avg(o_custkey) as m2, stddev_pop(o_custkey) as d2 from orders)
    select o_orderkey, round((o_totalprice - m) / d, 6) as o_totalprice, round((o_custkey - m2) / d2, 6) as o_custkey, cast(0 as double) as flat
    from orders cross join s""")
def standard_scale(spark, folder):
    df = table(spark, folder, "orders").withColumn("flat", F.lit(7.0))
    out = prepare.standard_scale(df, ["o_totalprice", "o_custkey", "flat"])
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), F.round("o_custkey", 6).alias("o_custkey"), "flat")


def _robust(divisor: str) -> str:
    return f"""
    with q as (select quantile_cont(o_totalprice, 0.25) as a, quantile_cont(o_totalprice, 0.5) as b, quantile_cont(o_totalprice, 0.75) as c from orders)
    select o_orderkey, round((o_totalprice - b) / ((c - a) / {divisor}), 6) as o_totalprice,
           round(near - 0.0, 6) as near from (select *, cast(case when o_orderkey % 50 = 0 then 1 else 0 end as double) as near from orders) cross join q"""


def _robust_query(spark, folder, unit):
    near = F.when(F.col("o_orderkey") % 50 == 0, 1.0).otherwise(0.0)
    out = prepare.robust_scale(table(spark, folder, "orders").withColumn("near", near), ["o_totalprice", "near"], unit)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), F.round("near", 6).alias("near"))


@query("robust_scale", _robust("1.0"))
def robust_scale(spark, folder):
    return _robust_query(spark, folder, False)


@query("robust_scale_unit", _robust("1.3489795003921634"))
def robust_scale_unit(spark, folder):
    return _robust_query(spark, folder, True)


POLY = {"a": "a", "b": "b", "a_x_a": "a * a", "a_x_b": "a * b", "b_x_b": "b * b"}


@query("poly_features", f"""
    with v as (select o_orderkey, o_totalprice / 100000.0 as a, o_custkey / 1000.0 as b from orders),
    t as (select o_orderkey, {', '.join(f'{e} as {n}' for n, e in POLY.items())} from v),
    s as (select {', '.join(f'avg({n}) as {n}_m, stddev_pop({n}) as {n}_d' for n in POLY)} from t)
    select o_orderkey, {', '.join(f'round(({n} - {n}_m) / {n}_d, 5) as {n}' for n in POLY)} from t cross join s""")
def poly_features(spark, folder):
    v = table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 100000.0).alias("a"), (F.col("o_custkey") / 1000.0).alias("b"))
    return prepare.polynomial(v, ["a", "b"], ["o_orderkey"]).select("o_orderkey", *[F.round(n, 5).alias(n) for n in POLY])


STATUS = ["F", "O", "P"]


@query("one_hot", f"""select o_orderkey, {', '.join(f"cast(o_orderstatus = '{v}' as double) as o_orderstatus_{v}" for v in STATUS)},
    cast(o_orderkey % 2 = 0 as double) as yn_yes from orders""")
def one_hot(spark, folder):
    v = table(spark, folder, "v_bool")
    hot = prepare.one_hot_columns(prepare.category_levels(v, ["o_orderstatus", "yn"]))
    return v.select("o_orderkey", *[e.alias(n) for n, e in hot.items()])


@query("target_encode_oof", f"""
    with v as (select p_partkey, p_name, p_retailprice as y, cast({_hex("md5(p_partkey || '|42')")} % 5 as int) as fold from part),
    g as (select fold, sum(y) as s, count(*) as n from v group by 1), t as (select sum(y) as s, count(*) as n from v),
    c as (select p_name, fold, sum(y) as s, count(*) as n from v group by 1, 2), ca as (select p_name, sum(y) as s, count(*) as n from v group by 1)
    select p_partkey, v.fold, round((ca.s - c.s + 10.0 * (t.s - g.s) / (t.n - g.n)) / (ca.n - c.n + 10.0), 5) as encoded
    from v join c on c.p_name = v.p_name and c.fold = v.fold join ca on ca.p_name = v.p_name join g on g.fold = v.fold cross join t""")
def target_encode_oof(spark, folder):
    v = splits.folds(table(spark, folder, "part"), "p_partkey", 5, SEED)
    out = prepare.target_encode(v, "p_name", "p_retailprice", "fold", smoothing=10.0)
    return out.select("p_partkey", "fold", F.round("encoded", 5).alias("encoded"))


@query("class_weights", """
    with c as (select quality as class_label, count(*) as class_rows from labels group by 1), t as (select sum(class_rows) as n, count(*) as k from c)
    select class_label, class_rows, round(n / (k * class_rows), 6) as class_weight from c cross join t""")
def class_weights(spark, folder):
    return prepare.class_weights(table(spark, folder, "labels"), "quality").withColumn("class_weight", F.round("class_weight", 6))


# --- metrics on rule-made predictions ---

PRED = f"(select k, model, label, prediction from {duck('v_pred')})"


def _confusion(spark, folder) -> DataFrame:
    return metrics.confusion_counts(table(spark, folder, "v_pred"), ["model"])


@query("confusion_matrix", f"""
    with p as {PRED}, l as (select distinct model, label from (select model, label from p union all select model, prediction from p))
    select l.model, l.label, {', '.join(f"count(case when prediction = '{c}' then 1 end) as {c}" for c in ('F', 'O', 'P', 'X'))}
    from l left join p on p.model = l.model and p.label = l.label group by all""")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_confusion(spark, folder), ["model"], ["F", "O", "P", "X"])


@query("cls_metrics", f"""with p as {PRED}, {scores_sql('m', 'p', 'model')}
    select model, {', '.join(f'round({c}, 6) as {c}' for c in ('accuracy', 'balanced_accuracy', 'f1_macro', 'precision_macro', 'recall_macro'))} from m""")
def cls_metrics(spark, folder):
    m = metrics.score_classes(table(spark, folder, "v_pred"), ["model"])
    return m.select("model", *[F.round(c, 6).alias(c) for c in ("accuracy", "balanced_accuracy", "f1_macro", "precision_macro", "recall_macro")])


@query("per_class_report", f"""with p as {PRED}, {scores_sql('m', 'p', 'model')}
    select model, class_label, cast(support as bigint) as support, round(precision, 6) as precision, round(recall, 6) as recall,
           round(f1, 6) as f1, f1 < 0.6 as below_floor from m_rep""")
def per_class_report(spark, folder):
    r = metrics.class_scores(metrics.class_report(_confusion(spark, folder), ["model"]))
    return r.select("model", "class_label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "below_floor")


@query("reg_metrics", f"""select model, round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) as r2,
    round(avg(abs(label - prediction)), 4) as mae, round(sqrt(avg((label - prediction) * (label - prediction))), 4) as rmse
    from {duck('v_regpred')} group by model""")
def reg_metrics(spark, folder):
    m = metrics.score_numbers(table(spark, folder, "v_regpred"), ["model"])
    return m.select("model", F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"))


@query("pred_vs_actual", f"""select l_orderkey, l_linenumber, label, prediction, round(label - prediction, 4) as residual
    from {duck('v_regpred')} where model = 'per_unit'""")
def pred_vs_actual(spark, folder):
    out = metrics.residuals(table(spark, folder, "v_regpred").where("model = 'per_unit'"))
    return out.select("l_orderkey", "l_linenumber", "label", F.col("prediction").cast("double").alias("prediction"), F.round("residual", 4).alias("residual"))


def _parity(group: str, top: str = "") -> str:
    return f"""select '{group}' as attribute, group_value, n, round(rate, 6) as selection_rate, round(min(rate) over () / max(rate) over (), 6) as parity_ratio
      from (select cast({group} as varchar) as group_value, count(*) as n, avg(prediction) as rate,
              row_number() over (order by count(*) desc, cast({group} as varchar)) as r from {duck('v_sensitive')} group by 1) {top}"""


def _parity_of(spark, folder, top=None):
    df = with_dataset(table(spark, folder, "v_sensitive"))
    parts = [metrics.demographic_parity(df, [KEY], g, top).select(
        F.lit(g).alias("attribute"), "group_value", "n", F.round("selection_rate", 6).alias("selection_rate"),
        F.round("parity_ratio", 6).alias("parity_ratio")) for g in ("gender", "age_band")]
    return parts[0].unionByName(parts[1])


@query("demographic_parity", " union all ".join(f"select * from ({_parity(g)})" for g in ("gender", "age_band")))
def demographic_parity(spark, folder):
    """Selection rates of all groups and the ratio over them."""
    return _parity_of(spark, folder)


@query("demographic_parity_top5", " union all ".join(f"select * from ({_parity(g, 'where r <= 5')})" for g in ("gender", "age_band")))
def demographic_parity_top5(spark, folder):
    """The same audit over the five largest groups."""
    return _parity_of(spark, folder, 5)


@query("permute_column", """
    with a as (select o_orderkey, row_number() over (order by md5(o_orderkey || '|rows')) as r from orders),
         b as (select o_totalprice, row_number() over (order by md5(o_orderkey || '|42|0')) as r from orders)
    select a.o_orderkey, b.o_totalprice as shuffled from a join b using (r)""")
def permute_column(spark, folder):
    from assay.operators.importance import permuted
    return permuted(table(spark, folder, "orders"), "o_orderkey", ["o_totalprice"], SEED, 0).select("o_orderkey", F.col("o_totalprice").alias("shuffled"))


@query("ols_single", """select round(regr_slope(l_extendedprice, l_quantity), 5) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept,
    count(*) as n_rows from lineitem""")
def ols_single(spark, folder):
    from assay.operators.models import single_feature_line
    fit = single_feature_line(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return fit.select(F.round("slope", 5).alias("slope"), F.round("intercept", 3).alias("intercept"), "n_rows")


PENALTIES = (0.0, 0.01, 0.1, 1.0, 10.0, 100.0)


@query("cross_validate_linear", f"""
    with t as (select l_orderkey % 5 as fold, cast(l_quantity as double) as x, cast(l_extendedprice as double) as y from lineitem),
    g as (select fold, count(*) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx, sum(x * y) as sxy, sum(y * y) as syy from t group by fold),
    a as (select sum(n) as n, sum(sx) as sx, sum(sy) as sy, sum(sxx) as sxx, sum(sxy) as sxy from g),
    r as (select g.fold, g.n as nc, g.sx as cx, g.sy as cy, g.sxx as cxx, g.sxy as cxy, g.syy as cyy,
                 a.n - g.n as n, a.sx - g.sx as sx, a.sy - g.sy as sy, a.sxx - g.sxx as sxx, a.sxy - g.sxy as sxy from g cross join a),
    b as (select *, unnest([{", ".join(f"cast({p} as double)" for p in PENALTIES)}]) as penalty from r),
    w as (select *, (sxy - sx * sy / n) / (sxx - sx * sx / n + penalty) as slope from b),
    v as (select *, (sy - slope * sx) / n as intercept from w),
    e as (select *, cyy - 2 * (intercept * cy + slope * cxy) + intercept * intercept * nc + 2 * intercept * slope * cx + slope * slope * cxx as sse from v)
    select penalty, cast(fold as integer) as fold, cast(n as bigint) as n_train, cast(nc as bigint) as n_check, round(slope, 3) as slope, round(intercept, 2) as intercept,
           round(1 - sse / (cyy - cy * cy / nc), 6) as r2, round(sqrt(sse / nc), 2) as rmse from e""")
def cross_validate_linear(spark, folder):
    """Least squares and Ridge of five penalties over five folds of lineitem, from one pass."""
    from assay.operators import normal
    df = table(spark, folder, "lineitem").withColumn("fold", F.col("l_orderkey") % 5)
    s = normal.fold_scores(df, ["l_quantity"], "l_extendedprice", "fold", list(PENALTIES))
    return s.select("penalty", "fold", "n_train", "n_check", F.round(F.get("coefficients", 0), 3).alias("slope"),
                    F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), F.round("rmse", 2).alias("rmse"))


@query("cross_validate_two", """
    with t as (select l_orderkey % 3 as fold, cast(l_quantity as double) as x, cast(l_discount as double) as z, cast(l_extendedprice as double) as y from lineitem),
    r as (select f.fold, count(*) as n, regr_sxx(y, x) as xx, regr_sxx(y, z) as zz, covar_pop(x, z) * count(*) as xz, regr_sxy(y, x) as xy,
                 regr_sxy(y, z) as zy, avg(x) as mx, avg(z) as mz, avg(y) as my
          from (select distinct fold from t) f join t on t.fold != f.fold group by f.fold),
    b as (select *, unnest([cast(0 as double), cast(50 as double)]) as p from r),
    c as (select fold, p, n, mx, mz, my, (xy * (zz + p) - zy * xz) / ((xx + p) * (zz + p) - xz * xz) as bx,
                 (zy * (xx + p) - xy * xz) / ((xx + p) * (zz + p) - xz * xz) as bz from b)
    select p as penalty, cast(fold as integer) as fold, n as n_train, round(bx, 3) as slope_x, round(bz, 1) as slope_z, round(r2, 6) as r2
    from (select c.p, c.fold, c.n, c.bx, c.bz, 1 - sum((y - my - bx * (x - mx) - bz * (z - mz)) * (y - my - bx * (x - mx) - bz * (z - mz))) / (var_pop(y) * count(*)) as r2
          from c join t on t.fold = c.fold group by all)""")
def cross_validate_two(spark, folder):
    """The same with two features, least squares and one penalty over three folds."""
    from assay.operators import normal
    df = table(spark, folder, "lineitem").withColumn("fold", F.col("l_orderkey") % 3)
    s = normal.fold_scores(df, ["l_quantity", "l_discount"], "l_extendedprice", "fold", [0.0, 50.0])
    b = F.col("coefficients")
    return s.select("penalty", "fold", "n_train", F.round(F.get(b, 0), 3).alias("slope_x"), F.round(F.get(b, 1), 1).alias("slope_z"), F.round("r2", 6).alias("r2"))


@query("baseline_mode", """
    with m as (select o_orderstatus as prediction, count(*) as n from orders group by 1 order by n desc, 1 limit 1)
    select prediction, (select count(*) from orders) as n_rows, round(n / (select count(*) from orders), 6) as accuracy from m""")
def baseline_mode(spark, folder):
    from assay.operators.models import baseline_class
    df = table(spark, folder, "orders")
    hit = F.col("o_orderstatus") == F.col("prediction")
    return baseline_class(df, "o_orderstatus").groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(hit.cast("int")), 6).alias("accuracy"))


@query("baseline_mean", """with m as (select avg(l_extendedprice) as p from lineitem)
    select round(p, 4) as prediction, count(*) as n_rows, round(avg(abs(l_extendedprice - p)), 4) as mae from lineitem cross join m group by p""")
def baseline_mean(spark, folder):
    from assay.operators.models import baseline_number
    out = baseline_number(table(spark, folder, "lineitem"), "l_extendedprice")
    return out.groupBy(F.round("prediction", 4).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(F.abs(F.col("l_extendedprice") - F.col("prediction"))), 4).alias("mae"))


@query("smote_counts", """
    with c as (select quality as class_label, count(*) as class_rows from labels group by 1), t as (select max(class_rows) as top, min(class_rows) as low from c)
    select class_label, class_rows, top - class_rows as copies, least(5, low - 1) as neighbours from c cross join t""")
def smote_counts(spark, folder):
    from assay.operators.oversample import copies_needed
    return copies_needed(table(spark, folder, "labels"), "quality").select("class_label", "class_rows", "copies", "neighbours")
