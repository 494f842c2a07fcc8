"""Scan, coercion and profile queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import leakage, pairs, quality, schema, sketches, target as tg
from assay.operators.counts import KEY, TableInfo, value_counts, with_dataset
from assay.queries.base import columns_of, duck, duck_number, duck_stats, query, table
from assay.session import materialise
from assay.sources.tables import missing_to_null


def dataset(spark, folder: str, name: str) -> DataFrame:
    return with_dataset(table(spark, folder, name), name=name)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def stats_of(spark, folder: str, name: str) -> DataFrame:
    return schema.profile_columns(dataset(spark, folder, name))


# --- scan, dedupe, coercion ---

TOKENS = ", ".join("'" + t + "'" for t in th.NULL_TOKENS)


@query("scan_null_tokens", f"""
    select case when status_tok in ({TOKENS}) then null else status_tok end as status_tok,
           count(*) as n_rows, count(case when isnan(price_nan) then null else price_nan end) as n_price,
           round(sum(case when isnan(price_nan) then null else price_nan end), 2) as sum_price
    from {duck('v_tokens')} group by 1""")
def scan_null_tokens(spark, folder):
    clean = missing_to_null(table(spark, folder, "v_tokens"))
    return clean.groupBy("status_tok").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("price_nan").alias("n_price"),
        F.round(F.sum("price_nan"), 2).alias("sum_price"),
    )


@query("dedupe_rows", f"select distinct * from {duck('v_dups')}")
def dedupe_rows(spark, folder):
    return quality.drop_duplicates(table(spark, folder, "v_dups"))


@query("duplicate_stats", f"""
    select 'v_dups' as dataset_id, count(*) as n_rows, count(*) - count(distinct row(v.*)) as duplicate_count,
           (count(*) - count(distinct row(v.*))) / greatest(count(*), 1) * 100 as duplicate_pct
    from {duck('v_dups')} v""".replace("row(v.*)", "v"))
def duplicate_stats(spark, folder):
    return quality.duplicate_stats(dataset(spark, folder, "v_dups"))


@query("coerce_numeric", f"""
    select o_orderkey, {duck_number('dirty_num', 't')} as dirty_num, {duck_number('odd_num', 't')} as odd_num
    from {duck('v_dirty')}""")
def coerce_numeric(spark, folder):
    return table(spark, folder, "v_dirty").select(
        "o_orderkey", fv.parse_number(F.col("dirty_num")).alias("dirty_num"),
        fv.parse_number(F.col("odd_num")).alias("odd_num"),
    )


# --- schema and column statistics ---

SCHEMA_TABLES = ["lineitem", "orders", "customer", "part", "events", "documents", "v_bool", "v_dirty", "v_missing"]


@query("infer_schema", " union all ".join(
    f"select dataset_id, pos, column_name, kind, n_unique from ({duck_stats(t)})" for t in SCHEMA_TABLES))
def infer_schema(spark, folder):
    return union([schema.infer_schema(dataset(spark, folder, t)) for t in SCHEMA_TABLES])


@query("infer_schema_sketch", " union all ".join(
    f"select dataset_id, pos, column_name, kind, n_rows, n_present, min_num, max_num, top_count / n_rows >= 0.95 as near_constant from ({duck_stats(t)})"
    for t in (*SCHEMA_TABLES, "v_nearconst")))
def infer_schema_sketch(spark, folder):
    """Decisions of the two-pass profile: as exact as those of full counts."""
    parts = [sketches.profile_columns(dataset(spark, folder, t)) for t in (*SCHEMA_TABLES, "v_nearconst")]
    numbers = [F.when(F.col("family") != "time", F.col(c)).alias(c) for c in ("min_num", "max_num")]
    return union(parts).select(
        KEY, "pos", "column_name", "kind", "n_rows", "n_present", *numbers, (F.col("top_share") >= th.NEAR_CONSTANT).alias("near_constant"))


@query("n_unique_sketch", f"""select dataset_id, column_name, n_rows, n_unique, true as unique_within, true as top_within
    from ({duck_stats('lineitem')} union all {duck_stats('events')} union all {duck_stats('documents')})""")
def n_unique_sketch(spark, folder):
    """Approximate distinct counts beside the exact ones: are these within the stated error."""
    names = ("lineitem", "events", "documents")
    rough = union([sketches.estimated_stats(sketches.sketch_columns(dataset(spark, folder, t))) for t in names])
    exact = union([stats_of(spark, folder, t) for t in names]).select(KEY, "pos", F.col("n_unique").alias("true_unique"), F.col("top_count").alias("true_top"))
    return rough.join(exact, [KEY, "pos"]).select(
        KEY, "column_name", "n_rows", F.col("true_unique").alias("n_unique"),
        F.col("true_unique").between(F.col("unique_low"), F.col("unique_high")).alias("unique_within"),
        F.col("true_top").between(F.col("top_low"), F.col("top_high")).alias("top_within"))


@query("sketch_merge", f"""select column_name, kind, n_rows, n_present, n_unique, min_num, max_num
    from ({duck_stats('lineitem')}) where n_unique <= 100""")
def sketch_merge(spark, folder):
    """Sketches of lineitem's parts by return flag, merged: the profile of the whole without a second scan."""
    df = dataset(spark, folder, "lineitem")
    parts = [sketches.sketch_columns(df.where(F.col("l_returnflag") == flag)) for flag in ("A", "N", "R")]
    merged = sketches.estimated_stats(sketches.merge_sketches(*parts)).where("n_unique <= 100")
    return merged.select("column_name", "kind", "n_rows", "n_present", "n_unique", "min_num", "max_num")


@query("missing_pct", " union all ".join(
    f"select '{t}' as dataset_id, '{c}' as column_name, round(avg(case when {c} is null then 1 else 0 end) * 100, 6) as missing_pct from {duck(t)}"
    for t in ("lineitem", "v_missing") for c, _ in columns_of(t)))
def missing_pct(spark, folder):
    parts = [schema.missing_pct(dataset(spark, folder, t)) for t in ("lineitem", "v_missing")]
    return union(parts).withColumn("missing_pct", F.round("missing_pct", 6))


@query("n_unique", f"select column_name, n_rows, n_present, n_unique, top_count from ({duck_stats('lineitem')})")
def n_unique(spark, folder):
    return stats_of(spark, folder, "lineitem").select("column_name", "n_rows", "n_present", "n_unique", "top_count")


@query("near_constant", f"""
    select column_name, round(top_count / n_rows, 6) as top_share
    from ({duck_stats('v_nearconst')}) where top_count / n_rows >= 0.95""")
def near_constant(spark, folder):
    flagged = schema.near_constant(stats_of(spark, folder, "v_nearconst"))
    return flagged.select("column_name", F.round("top_share", 6).alias("top_share"))


@query("ordinal_report", " union all ".join(
    f"select dataset_id, column_name, n_unique, round(int_share, 6) as int_share from ({duck_stats(t)}) where kind = 'ordinal'"
    for t in ("lineitem", "orders", "v_nearconst", "v_leak")))
def ordinal_report(spark, folder):
    parts = [schema.ordinal_report(stats_of(spark, folder, t)) for t in ("lineitem", "orders", "v_nearconst", "v_leak")]
    return union(parts).select(KEY, "column_name", "n_unique", F.round("int_share", 6).alias("int_share"))


@query("feature_groups", " union all ".join(
    f"""select dataset_id, column_name, n_unique,
        case when kind = 'boolean' or (kind = 'categorical' and n_unique <= 2) then 'binary'
             when kind = 'categorical' then 'multiclass' else kind end as feature_group
        from ({duck_stats(t)}) where column_name <> '{y}'"""
    for t, y in (("lineitem", "l_returnflag"), ("v_bool", "o_orderstatus"), ("v_dirty", "o_orderkey"))))
def feature_groups(spark, folder):
    parts = [
        schema.feature_groups(stats_of(spark, folder, t), y)
        for t, y in (("lineitem", "l_returnflag"), ("v_bool", "o_orderstatus"), ("v_dirty", "o_orderkey"))
    ]
    return union(parts).select(KEY, "column_name", "n_unique", "feature_group")


@query("task_type", " union all ".join(
    f"""select dataset_id, column_name,
        case when fam = 't' then true
             when fam = 'f' then n_present > 0 and n_whole = n_present and n_unique <= 20
             else n_unique / n_rows <= 0.05 or n_unique <= 50 end as is_classification
        from ({duck_stats(t)})""" for t in ("lineitem", "orders", "part")))
def task_type(spark, folder):
    parts = [schema.task_type(stats_of(spark, folder, t)) for t in ("lineitem", "orders", "part")]
    return union(parts).drop("pos")


@query("factorize_codes", """
    with codes as (select p_name, dense_rank() over (order by p_name) - 1 as code from (select distinct p_name from part))
    select p.p_partkey, c.code from part p join codes c using (p_name)""")
def factorize_codes(spark, folder):
    from assay.operators.prepare import factorize
    return factorize(table(spark, folder, "part"), "p_name").select("p_partkey", "code")


# --- outliers, scale, correlation ---

@query("outlier_share", f"""
    with v as (select * from {duck('v_outlier')}),
    long as (select 'l_orderkey' as column_name, cast(l_orderkey as double) as x from v
             union all select 'l_linenumber', l_linenumber from v union all select 'l_quantity', l_quantity from v
             union all select 'price', price from v),
    f as (select column_name, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3 from long group by 1)
    select column_name, round(q1, 4) as q1, round(q3, 4) as q3,
           round(avg(case when x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1) then 1.0 else 0.0 end), 6) as outlier_share,
           avg(case when x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1) then 1.0 else 0.0 end) > 0.05 as is_outlier_column
    from long join f using (column_name) where q3 - q1 <> 0 group by column_name, q1, q3""")
def outlier_share(spark, folder):
    df = dataset(spark, folder, "v_outlier")
    counts = value_counts(df)
    shares = quality.outlier_shares(counts, schema.column_stats(counts, TableInfo.of(df)))
    return shares.select(
        "column_name", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"),
        F.round("outlier_share", 6).alias("outlier_share"), "is_outlier_column",
    )


@query("scale_range", f"""
    with s as (select column_name, min_num, max_num, max_num - min_num as num_range from ({duck_stats('lineitem')})
               where kind in ('ordinal', 'continuous')),
    r as (select max(num_range) / median(num_range) as scale_ratio from s where num_range > 0)
    select column_name, round(min_num, 4) as min_num, round(max_num, 4) as max_num, round(num_range, 4) as num_range,
           round(scale_ratio, 4) as scale_ratio, scale_ratio >= 50 as scale_mismatch from s cross join r""")
def scale_range(spark, folder):
    out = quality.scale_ranges(stats_of(spark, folder, "lineitem"))
    return out.select(
        "column_name", *[F.round(c, 4).alias(c) for c in ("min_num", "max_num", "num_range", "scale_ratio")],
        "scale_mismatch",
    )


CORR_COLUMNS = ["a", "b", "c", "d", "k", "e"]
CORR_PAIRS = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]]
CORR_SQL = " union all ".join(
    f"""select '{a}' as col_a, '{b}' as col_b,
        covar_pop({a}, {b}) / sqrt(nullif(var_pop(case when {b} is not null then {a} end) * var_pop(case when {a} is not null then {b} end), 0)) as corr,
        count(case when {a} is not null and {b} is not null then 1 end) as n_pairs from v""" for a, b in CORR_PAIRS)


@query("corr_pairs", f"""
    with v as (select * from {duck('v_corr')}), p as ({CORR_SQL})
    select col_a, col_b, round(corr, 6) as corr, round(abs(corr), 6) as abs_corr, n_pairs from p where corr is not null""")
def corr_pairs(spark, folder):
    out = pairs.correlation_pairs(dataset(spark, folder, "v_corr")).where("corr is not null")
    return out.select(
        "col_a", "col_b", F.round("corr", 6).alias("corr"), F.round("abs_corr", 6).alias("abs_corr"), "n_pairs"
    )


@query("corr_top", f"""
    with v as (select * from {duck('v_corr')}), p as ({CORR_SQL})
    select col_a, col_b, round(corr, 4) as corr, n_pairs from p where abs(corr) >= 0.8 and col_a <> 'k' and col_b <> 'k'""")
def corr_top(spark, folder):
    df = dataset(spark, folder, "v_corr")
    top = pairs.strongest_pairs(pairs.correlation_pairs(df), schema.infer_schema(df), th.HIGH_CORR)
    return top.select("col_a", "col_b", F.round("corr", 4).alias("corr"), "n_pairs")


@query("corr_pvalue")
def corr_pvalue(spark, folder):
    """Every numeric pair of lineitem with its p-value."""
    return pairs.with_p_value(pairs.correlation_pairs(dataset(spark, folder, "lineitem")))


@query("corr_matrix", f"""
    with v as (select * from {duck('v_corr')}), p as ({CORR_SQL}),
    m as (select col_a, col_b, corr from p union all select col_b, col_a, corr from p
          union all select c, c, 1.0 from (values {', '.join(f"('{c}')" for c in CORR_COLUMNS)}) t(c))
    select col_a, {', '.join(f"round(max(case when col_b = '{c}' then corr end), 4) as {c}" for c in CORR_COLUMNS)}
    from m group by col_a""")
def corr_matrix(spark, folder):
    m = pairs.correlation_matrix(pairs.correlation_pairs(dataset(spark, folder, "v_corr")), CORR_COLUMNS)
    return m.select("col_a", *[F.round(c, 4).alias(c) for c in CORR_COLUMNS])


# --- target, leakage, names ---

@query("class_balance", """
    with c as (select o_orderstatus as k, count(*) as n from orders group by 1),
         q as (select quality as k, count(*) as n from labels group by 1)
    select 'orders' as dataset_id, count(*) as n_classes, round(max(n) / greatest(min(n), 1), 6) as imbalance_ratio from c
    union all select 'labels', count(*), round(max(n) / greatest(min(n), 1), 6) from q""")
def class_balance(spark, folder):
    parts = [
        quality.class_balance(dataset(spark, folder, "orders"), "o_orderstatus"),
        quality.class_balance(dataset(spark, folder, "labels"), "quality"),
    ]
    return union(parts).withColumn("imbalance_ratio", F.round("imbalance_ratio", 6))


LEAK_LONG = f"""
    v as (select * from {duck('v_leak')}),
    long as (
      select 'o_orderkey' as column_name, cast(o_orderkey as varchar) as f, target as y from v
      union all select 'copy_status', lower(trim(copy_status)), target from v
      union all select 'remap_status', cast(remap_status as varchar), target from v
      union all select 'o_orderpriority', lower(trim(o_orderpriority)), target from v
      union all select 'o_totalprice', cast(o_totalprice as varchar), target from v)"""


@query("leak_exact_copy", f"""
    with {LEAK_LONG}
    select column_name, bool_and(f = lower(trim(y))) as is_copy from long group by 1""")
def leak_exact_copy(spark, folder):
    hard = _hard(spark, folder)
    return hard.select("column_name", (F.coalesce("reason", F.lit("")) == "exact_target_copy").alias("is_copy"))


@query("leak_bijection", f"""
    with {LEAK_LONG}
    select column_name, count(distinct f) as n_values,
           count(distinct f) between 2 and greatest(20, 4 * count(distinct y)) and count(distinct f) = count(distinct y)
           and count(distinct f) = count(distinct (f, y)) and not bool_and(f = lower(trim(y))) as is_mapping
    from long group by 1""")
def leak_bijection(spark, folder):
    hard = _hard(spark, folder)
    mapped = F.coalesce("reason", F.lit("")) == "deterministic_target_mapping"
    return hard.select("column_name", "n_values", mapped.alias("is_mapping"))


def _hard(spark, folder):
    df = dataset(spark, folder, "v_leak")
    joint = materialise(value_counts(df, target="target"))
    return leakage.hard_leakage(joint, schema.column_stats(joint, TableInfo.of(df)), "target")


MI_BIN = "(select list(quantile) from cuts)"


@query("mi_leakage", f"""
    with v as (select * from {duck('v_leak')}),
    num as (select 'o_orderkey' as column_name, cast(o_orderkey as double) as x, target as y from v
            union all select 'remap_status', remap_status, target from v
            union all select 'o_totalprice', o_totalprice, target from v),
    cuts as (select column_name, quantile_cont(x, [{', '.join(f'{i}/20.0' for i in range(1, 20))}]) as q from num group by 1),
    b as (select column_name, cast(len(list_filter(q, lambda c: c <= x)) as varchar) as b, y from num join cuts using (column_name)
          union all select 'copy_status', copy_status, target from v
          union all select 'o_orderpriority', o_orderpriority, target from v),
    xy as (select column_name, b, y, count(*) as n from b group by all),
    ax as (select column_name, sum(n * ln(n)) as a, count(*) as k, sum(n) as total from (select column_name, b, sum(n) as n from xy group by all) group by 1),
    ay as (select column_name, sum(n * ln(n)) as a, count(*) as k from (select column_name, y, sum(n) as n from xy group by all) group by 1),
    axy as (select column_name, sum(n * ln(n)) as a, count(*) as k from xy group by 1)
    select column_name, round(ln(total) + (axy.a - ax.a - ay.a) / total - (axy.k - ax.k - ay.k + 1) / (2 * total), 6) as mi,
           round(greatest(ln(total) + (axy.a - ax.a - ay.a) / total - (axy.k - ax.k - ay.k + 1) / (2 * total), 0)
                 / (ln(total) - ay.a / total), 6) as normalised_mi
    from ax join ay using (column_name) join axy using (column_name)""")
def mi_leakage(spark, folder):
    df = dataset(spark, folder, "v_leak")
    joint = value_counts(df, target="target")
    mi = leakage.mutual_information(joint, schema.column_stats(joint, TableInfo.of(df)), "target")
    return mi.select("column_name", F.round("mi", 6).alias("mi"), F.round("normalised_mi", 6).alias("normalised_mi"))


@query("target_entropy", """
    with c as (select o_orderstatus as k, count(*) as n from orders group by 1)
    select round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 8) as target_entropy from c""")
def target_entropy(spark, folder):
    classes = quality.class_counts(dataset(spark, folder, "orders"), "o_orderstatus")
    return leakage.target_entropy(classes).select(F.round("target_entropy", 8).alias("target_entropy"))


SENSITIVE_SQL = " or ".join(f"contains(lower(column_name), '{w}')" for w in th.SENSITIVE_WORDS)


@query("sensitive_columns", " union all ".join(
    f"select dataset_id, column_name, n_unique, ({SENSITIVE_SQL}) as is_sensitive from ({duck_stats(t)})"
    for t in ("pages", "v_sensitive", "conversations")))
def sensitive_columns(spark, folder):
    stats = union([stats_of(spark, folder, t) for t in ("pages", "v_sensitive", "conversations")])
    return quality.sensitive_columns(stats).select(KEY, "column_name", "n_unique", "is_sensitive")


SCORE_TABLES = ["lineitem", "orders", "events", "labels", "v_leak", "v_sensitive"]


def _score_sql(t: str) -> str:
    last = len(columns_of(t)) - 1
    return f"""select dataset_id, column_name, pos,
        (case when lower(column_name) in ('target', 'label', 'y', 'outcome', 'class') then 3.0 else 0.0 end
        + case when n_unique between 2 and 20 then 2 else 0 end + case when n_unique between 2 and 5 then 1 else 0 end
        + case when pos = {last} then 4 else 0 end
        - case when n_unique / n_rows > 0.5 and not (kind = 'datetime' or (kind = 'continuous' and fam = 'f')) then 3 else 0 end
        - case when kind = 'text' then 2 else 0 end - case when kind = 'all_missing' then 5 else 0 end
        - case when {SENSITIVE_SQL} then 10 else 0 end)::double as score from ({duck_stats(t)})"""


@query("target_scores", " union all ".join(
    f"select dataset_id, column_name, score from ({_score_sql(t)})" for t in SCORE_TABLES))
def target_scores(spark, folder):
    return union([_scores(spark, folder, t) for t in SCORE_TABLES]).select(KEY, "column_name", "score")


def _scores(spark, folder, t):
    df = dataset(spark, folder, t)
    return tg.target_scores(schema.profile_columns(df), TableInfo.of(df))


@query("target_candidates", f"""
    with s as ({' union all '.join(_score_sql(t) for t in SCORE_TABLES)}),
    failed as (select dataset_id, column_name from (select *, row_number() over (partition by dataset_id order by score desc, pos) as r from s) where r = 2),
    o as (select s.dataset_id, s.column_name, score, row_number() over (partition by s.dataset_id order by score desc, pos) as rank
          from s anti join failed using (dataset_id, column_name) where score > 0)
    select dataset_id, cast(rank as integer) as rank, column_name, score from o where rank <= 3""")
def target_candidates(spark, folder):
    from assay.sources.tables import read_table  # noqa: F401
    from pyspark.sql import Window
    scores = union([_scores(spark, folder, t) for t in SCORE_TABLES])
    # The second-best target of every dataset counts as failed before.
    order = Window.partitionBy(KEY).orderBy(F.col("score").desc(), "pos")
    failed = scores.withColumn("r", F.row_number().over(order)).where("r = 2").select(KEY, "column_name")
    return tg.target_candidates(scores, failed)


@query("fingerprint", " union all ".join(
    f"""select '{t}' as dataset_id, 'fp_' || substr(md5('{t}.parquet|{y}|{','.join(c for c, _ in columns_of(t))}'), 1, 12) as fingerprint,
        count(*) as n_rows from {t}""" for t, y in (("lineitem", "l_returnflag"), ("orders", "o_orderstatus"))))
def fingerprint(spark, folder):
    parts = []
    for t, y in (("lineitem", "l_returnflag"), ("orders", "o_orderstatus")):
        stats = schema.profile_columns(dataset(spark, folder, t))
        ids = tg.fingerprints(stats, y, f"{t}.parquet")
        parts.append(ids.join(stats.where("pos = 0").select(KEY, "n_rows"), KEY))
    return union(parts)
