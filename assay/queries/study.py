"""Many datasets at once: lineitem keyed three ways, with planted properties per dataset.

A dataset is one supplier (S..), one line number (L..) or one return flag (F..), so sizes differ by
orders of magnitude. The leading hex digit h of md5(dataset_id) decides what is planted.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import prepare, schema
from assay.operators.counts import KEY, TableInfo, value_counts
from assay.operators.signals import profile_long, profile_notes, signals
from assay.plans import replan as rp
from assay.plans import rules
from assay.queries.base import query
from assay.session import materialise
from assay.sources.tables import read_table
from assay.settings import PUBLISHED

TARGET = "target"
# name, family
STUDY_COLUMNS = [
    ("qty", "f"), ("line", "n"), ("price", "f"), ("price2", "f"), ("disc", "f"), ("near_c", "n"), ("flag", "t"),
    ("proxy", "n"), ("wave", "n"), ("code", "t"), ("ship", "d"), ("age_band", "n"), ("target", "t"),
]

STUDY = """
    select dataset_id, l_quantity as qty, l_linenumber as line,
      case when h < '4' and l_orderkey % 10 = 0 then l_extendedprice * 100 else l_extendedprice end as price,
      case when h < '8' then 2 * l_extendedprice + 1 else l_discount * l_quantity end as price2,
      case when h in ('2', '3', '6') and l_orderkey % 4 = 0 then null else l_discount end as disc,
      case when h >= 'c' then l_orderkey % 2 when l_orderkey % 50 = 0 then 1 else 0 end as near_c,
      l_returnflag as flag,
      case when h in ('a', 'b') then (case when y in ('F', 'R') then 10 else 20 end) else l_orderkey % 3 end as proxy,
      case when h in ('9', 'b') then (case when y in ('F', 'R') then 1000 else 2000 end) + l_partkey % 500
           else l_partkey % 500 end as wave,
      concat('P', l_partkey % 200) as code,
      case when h < 'c' then null else l_shipdate end as ship,
      l_partkey % 7 as age_band,
      y as target
    from (
      select *, case when h in ('c', 'd') then (case when l_orderkey % 12 = 0 then 'R' else 'N' end)
                     when h = 'e' then (case when l_orderkey % 5 = 0 then 'R' else 'N' end)
                     else l_linestatus end as y
      from (select *, substring(md5(dataset_id), 1, 1) as h from (<each>) e) e2) e3"""
EACH_SPARK = (
    "select *, explode(array(concat('S', l_suppkey), concat('L', l_linenumber), concat('F', l_returnflag)))"
    " as dataset_id from {lineitem}"
)
EACH_DUCK = (
    "select *, unnest([concat('S', l_suppkey), concat('L', l_linenumber), concat('F', l_returnflag)])"
    " as dataset_id from lineitem"
)


def study(spark, folder: str) -> DataFrame:
    return spark.sql(STUDY.replace("<each>", EACH_SPARK), lineitem=read_table(spark, folder, "lineitem"))


_SIGNAL_TABLES: dict[tuple, tuple[DataFrame, DataFrame]] = {}
_KEPT_TABLES: dict[tuple, DataFrame] = {}


def _stamp(spark, folder: str) -> tuple:
    """What a rewrite of the input changes: files, sizes, times."""
    meta = read_table(spark, folder, "lineitem").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    row = meta.distinct().agg(
        F.count(F.lit(1)), F.sum("file_size"), F.max("file_modification_time"), F.bit_xor(F.xxhash64("file_path", "file_modification_time"))).first()
    return tuple(row)


def _study_tables(spark, folder: str) -> tuple[DataFrame, DataFrame]:
    """Signals and column statistics of the study; written once for the queries of a session while its input files stay as they are."""
    key = (spark.sparkContext.applicationId, folder, *_stamp(spark, folder))
    if key not in _SIGNAL_TABLES:
        df = study(spark, folder)
        joint = materialise(value_counts(df, target=TARGET))
        stats = materialise(schema.column_stats(joint, TableInfo.of(df)))
        _SIGNAL_TABLES[key] = (materialise(signals(df, TARGET, joint=joint, stats=stats, limits=PUBLISHED)), stats)
    return _SIGNAL_TABLES[key]


def kept(spark, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A reduced table over lineitem; written once for the queries of a session while its input files stay as they are."""
    key = (spark.sparkContext.applicationId, folder, name, *_stamp(spark, folder))
    if key not in _KEPT_TABLES:
        _KEPT_TABLES[key] = materialise(make())
    return _KEPT_TABLES[key]


def study_signals(spark, folder: str) -> DataFrame:
    """One row of signals per dataset of the study."""
    return _study_tables(spark, folder)[0]


def study_stats(spark, folder: str) -> DataFrame:
    """Statistics of every column of the study, which its signals were made from."""
    return _study_tables(spark, folder)[1]


def forget_signals() -> None:
    """Make the next query compute the signals and scores anew, as a bench of single queries needs."""
    _SIGNAL_TABLES.clear()
    _KEPT_TABLES.clear()


def _long_sql() -> str:
    parts = []
    for pos, (c, fam) in enumerate(STUDY_COLUMNS):
        x = {"t": "cast(null as double)", "d": f"cast(epoch_us({c}) as double)"}.get(fam, f"cast({c} as double)")
        s = c if fam == "t" else "cast(null as varchar)"
        parts.append(f"select dataset_id, {pos} as pos, '{c}' as column_name, '{fam}' as fam, {x} as x, {s} as s, target as y from d")
    return " union all ".join(parts)


NUMERIC = [c for c, fam in STUDY_COLUMNS if fam in "nf"]
SENSITIVE = " or ".join(f"contains(lower(column_name), '{w}')" for w in th.SENSITIVE_WORDS)
TEXT_KINDS = "('categorical', 'text', 'boolean', 'all_missing')"

# Statistics of every (dataset, column) and the signals built on them, as DuckDB common tables.
STATS_CTES = f"""
  d as ({STUDY.replace('<each>', EACH_DUCK)}),
  long as ({_long_sql()}),
  vc as (select dataset_id, pos, column_name, fam, x, s, y, count(*) as cnt from long group by all),
  top as (select dataset_id, pos, max(k) as top_count from
          (select dataset_id, pos, x, s, sum(cnt) as k from vc group by all) group by all),
  st0 as (select dataset_id, pos, column_name, fam, sum(cnt) as n_rows,
            coalesce(sum(case when x is not null or s is not null then cnt end), 0) as n_present,
            count(distinct coalesce(s, cast(x as varchar))) as n_unique,
            sum(case when x is null then null when abs(x - round_even(x, 0)) <= 1e-6 then cnt else 0 end)
              / sum(case when x is not null then cnt end) as int_share,
            coalesce(bool_and(x in (0, 1)), false) as zero_one, min(x) as lo, max(x) as hi
          from vc group by all),
  st as (select st0.*, top_count, (n_rows - n_present) / n_rows * 100 as missing_pct,
           case when n_present = 0 then 'all_missing' when zero_one and fam <> 'd' then 'boolean'
                when fam in ('n', 'f') then (case when n_unique between 1 and 20 and int_share >= 0.95 then 'ordinal' else 'continuous' end)
                when fam = 'd' then 'datetime' when n_unique <= 20 then 'categorical' else 'text' end as kind
         from st0 join top using (dataset_id, pos))"""

SIGNAL_CTES = STATS_CTES + f""",
  q as (select dataset_id, pos, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.75) as q3 from long
        where x is not null group by all),
  outs as (select dataset_id, column_name from long join q using (dataset_id, pos) join st using (dataset_id, pos, column_name)
           where kind in ('ordinal', 'continuous') and q3 - q1 <> 0 and x is not null and column_name <> 'target'
           group by all having avg(case when x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1) then 1.0 else 0.0 end) > 0.05),
  outl as (select dataset_id, list(column_name order by column_name) as outlier_cols from outs group by all),
  rng as (select dataset_id, case when count(*) < 2 then 1.0 else max(hi - lo) / median(hi - lo) end as scale_ratio, count(*) as k
          from st where kind in ('ordinal', 'continuous') and hi - lo > 0 group by all),
  dup as (select dataset_id, count(*) - count(distinct d) as duplicate_count from d group by all),
  nf as (select dataset_id, pos, column_name,
           case when kind in {TEXT_KINDS} then coalesce(lower(trim(coalesce(s, cast(cast(x as bigint) as varchar)))), 'nan')
                else cast(x as varchar) end as f, lower(trim(y)) as y
         from vc join st using (dataset_id, pos, column_name) where column_name <> 'target'),
  ny as (select dataset_id, count(distinct target) as ny from d group by all),
  hard as (select dataset_id, column_name from nf join ny using (dataset_id) where f is not null group by all
           having bool_and(f = y) or (count(distinct f) between 2 and greatest(20, 4 * max(ny))
             and count(distinct f) = count(distinct y) and count(distinct f) = count(distinct (f, y)))),
  hardl as (select dataset_id, list(column_name order by column_name) as hard_cols from hard group by all),
  cut as (select dataset_id, pos, quantile_cont(x, [{', '.join(f'{i}/20.0' for i in range(1, 20))}]) as cuts,
            quantile_cont(x, 0.5) as med from long where x is not null group by all),
  bins as (select vc.dataset_id, vc.pos, vc.column_name, y, cnt,
             case when kind in {TEXT_KINDS} then coalesce(s, cast(x as varchar), 'null')
                  else cast(len(list_filter(cuts, lambda c: c <= coalesce(x, med))) as varchar) end as b
           from vc join st using (dataset_id, pos, column_name) left join cut using (dataset_id, pos)
           where vc.column_name <> 'target' and not (kind = 'text' and n_unique / n_rows > 0.5)),
  xy as (select dataset_id, pos, column_name, b, y, sum(cnt) as n from bins group by all),
  axy as (select dataset_id, pos, column_name, sum(n * ln(n)) as a, count(*) as k, sum(n) as n from xy group by all),
  ax as (select dataset_id, pos, sum(n * ln(n)) as a, count(*) as k from (select dataset_id, pos, b, sum(n) as n from xy group by all) group by all),
  ay as (select dataset_id, pos, sum(n * ln(n)) as a, count(*) as k from (select dataset_id, pos, y, sum(n) as n from xy group by all) group by all),
  mi as (select dataset_id, column_name,
           (ln(n) + (axy.a - ax.a - ay.a) / n - (axy.k - ax.k - ay.k + 1) / (2 * n)) / (ln(n) - ay.a / n) as score
         from axy join ax using (dataset_id, pos) join ay using (dataset_id, pos) where ay.k > 1),
  softl as (select dataset_id, list(column_name order by column_name) as soft_cols
            from mi anti join hard using (dataset_id, column_name) where score >= 0.9 group by all),
  pairs as ({' union all '.join(
      f"select dataset_id, '{a}' as ca, '{b}' as cb, covar_pop({a}, {b}) / sqrt(nullif(var_pop(case when {b} is not null then {a} end)"
      f" * var_pop(case when {a} is not null then {b} end), 0)) as r from d group by dataset_id"
      for a, b in combinations(NUMERIC, 2))}),
  strong as (select p.dataset_id, cb, abs(r) as r from pairs p
             join st a on a.dataset_id = p.dataset_id and a.column_name = ca and a.kind in ('ordinal', 'continuous')
             join st b on b.dataset_id = p.dataset_id and b.column_name = cb and b.kind in ('ordinal', 'continuous')
             where abs(r) >= 0.8),
  corrl as (select dataset_id, max(r) as max_abs_corr,
              list_sort(list(distinct cb) filter (where round(r, 4) >= 0.95)) as corr_cols from strong group by all),
  bal as (select dataset_id, count(*) as n_classes, case when count(*) >= 2 then max(n) / greatest(min(n), 1) else 1.0 end as imbalance_ratio
          from (select dataset_id, target, count(*) as n from d group by all) group by all),
  base as (select dataset_id, max(n_rows) as n_row, count(*) as n_col, max(missing_pct) as max_missing,
             coalesce(list(column_name order by column_name) filter (where column_name <> 'target' and top_count / n_rows >= 0.95), []) as near_cols,
             coalesce(list(column_name order by column_name) filter (where {SENSITIVE}), []) as sensitive_cols,
             coalesce(list(column_name order by column_name) filter (where kind = 'ordinal' and column_name <> 'target'), []) as ordinal_cols,
             bool_or(kind = 'datetime' and column_name <> 'target') as has_datetime,
             bool_or(column_name <> 'target' and ((kind = 'categorical' and n_unique > 50)
                     or (kind = 'text' and n_unique > 50 and n_unique < n_rows * 0.1))) as high_card
           from st group by all),
  sig as (select base.*, coalesce(scale_ratio, 1.0) as scale_ratio, coalesce(rng.k >= 2 and scale_ratio >= 50, false) as scale_mismatch,
            duplicate_count, coalesce(outlier_cols, []) as outlier_cols, coalesce(hard_cols, []) as hard_cols,
            coalesce(soft_cols, []) as soft_cols, coalesce(corr_cols, []) as corr_cols, coalesce(max_abs_corr, 0) as max_abs_corr,
            n_classes, imbalance_ratio, greatest(n_col - 1, 1) as features,
            (greatest(n_col - 1, 1) >= 100 or greatest(n_col - 1, 1) / greatest(n_row, 1) >= 0.25) as high_dim
          from base left join rng using (dataset_id) join dup using (dataset_id) left join outl using (dataset_id)
          left join hardl using (dataset_id) left join softl using (dataset_id) left join corrl using (dataset_id)
          join bal using (dataset_id))"""

LISTS = ["near_cols", "sensitive_cols", "ordinal_cols", "outlier_cols", "hard_cols", "soft_cols", "corr_cols"]


@query("signals", f"""with {SIGNAL_CTES}
    select dataset_id, cast(n_row as bigint) as n_row, n_col, round(max_missing, 4) as max_missing,
      {', '.join(f"array_to_string({c}, ',') as {c}" for c in LISTS)},
      has_datetime, high_card, round(scale_ratio, 4) as scale_ratio, scale_mismatch, duplicate_count,
      round(max_abs_corr, 4) as max_abs_corr, n_classes, round(imbalance_ratio, 4) as imbalance_ratio, high_dim from sig""")
def signals_query(spark, folder):
    s = signals(study(spark, folder), TARGET, limits=PUBLISHED)
    return s.select(
        KEY, F.col("rows").alias("n_row"), F.col("cols").alias("n_col"), F.round("max_missing", 4).alias("max_missing"),
        F.concat_ws(",", "near_constant_cols").alias("near_cols"),
        *[F.concat_ws(",", c).alias(c) for c in LISTS[1:]],
        "has_datetime", "high_card", F.round("scale_ratio", 4).alias("scale_ratio"),
        F.coalesce("scale_mismatch", F.lit(False)).alias("scale_mismatch"), "duplicate_count",
        F.round("max_abs_corr", 4).alias("max_abs_corr"), "n_classes",
        F.round("imbalance_ratio", 4).alias("imbalance_ratio"), "high_dim",
    )


@query("profile_by_group", f"""with {STATS_CTES}
    select dataset_id, column_name, kind, cast(n_rows as bigint) as n_rows, cast(n_present as bigint) as n_present, n_unique,
           round(top_count / n_rows, 6) as top_share, round(missing_pct, 6) as missing_pct from st""")
def profile_by_group(spark, folder):
    s = schema.profile_columns(study(spark, folder))
    return s.select(
        KEY, "column_name", "kind", "n_rows", "n_present", "n_unique",
        F.round("top_share", 6).alias("top_share"), F.round("missing_pct", 6).alias("missing_pct"),
    )


@query("profile")
def profile(spark, folder):
    """Whole profile of lineitem in long form."""
    from assay.operators.counts import with_dataset
    return profile_long(with_dataset(read_table(spark, folder, "lineitem"), name="lineitem"), "l_returnflag")


def _note(cond: str, text: str) -> str:
    return f"case when {cond} then {text} end"


NOTES = ", ".join([
    _note("n_row < 1000", "'small_dataset'"),
    _note("n_col > 100", "'high_dimensionality'"),
    _note("len(ordinal_cols) > 0", "'ordinal: ' || array_to_string(ordinal_cols[1:5], ', ')"),
    _note("duplicate_count > 0", "'duplicates: ' || duplicate_count"),
    _note("len(near_cols) > 0", "'near_constant: ' || array_to_string(near_cols[1:5], ', ')"),
    _note("len(outlier_cols) > 0", "'outliers: ' || array_to_string(outlier_cols[1:5], ', ')"),
    "case when len(hard_cols) > 0 then 'hard_leakage: ' || array_to_string(hard_cols, ', ') "
    "when len(soft_cols) > 0 then 'soft_leakage: ' || array_to_string(soft_cols, ', ') end",
    _note("len(sensitive_cols) > 0", "'sensitive: ' || array_to_string(sensitive_cols, ', ')"),
    _note("scale_mismatch", "'scale_mismatch'"),
    _note("imbalance_ratio >= 3", "'imbalance'"),
])


@query("profile_notes", f"""with {SIGNAL_CTES},
    n as (select dataset_id, list_filter([{NOTES}], lambda x: x is not null) as notes from sig)
    select dataset_id, cast(generate_subscripts(notes, 1) - 1 as integer) as pos, unnest(notes) as note from n""")
def notes_query(spark, folder):
    return profile_notes(study_signals(spark, folder))


# --- plan rules ---

# A dataset's hint: the steps that worked for the dataset whose name follows it, a third have none.
HINT = """case when h in ('0', '4', '8', 'c', 'f') then ['apply_robust_scaling', 'profile_dataset', 'apply_regularization',
          'use_ensemble_models', 'drop_near_constant_features'] when h in ('1', '5', '9') then ['consider_imbalance_strategy',
          'apply_target_encoding', 'handle_outliers'] end"""
HINT_MODEL = "case when h in ('0', '4', '8', 'c', 'f') then 'RandomForest' end"


def study_hints(sig: DataFrame) -> DataFrame:
    h = F.substring(F.md5(KEY), 1, 1)
    arr = lambda *s: F.array(*[F.lit(x) for x in s])
    rich = h.isin("0", "4", "8", "c", "f")
    steps = F.when(rich, arr("apply_robust_scaling", "profile_dataset", "apply_regularization", "use_ensemble_models",
                             "drop_near_constant_features")).when(
        h.isin("1", "5", "9"), arr("consider_imbalance_strategy", "apply_target_encoding", "handle_outliers"))
    return sig.select(KEY, F.when(rich, F.lit("RandomForest")).alias("hint_model"), steps.alias("hint_steps"))


def _rule(order: float, step: str, cond: str, place: int | str) -> str:
    step_sql = step if step.startswith("'") else f"'{step}'"
    return f"select dataset_id, {order} as rule, {place} as place, {step_sql} as step from hs where {cond}"


CORR_APPLIES = "len(corr_cols) > 0 and features > len(corr_cols) + 1"
REPLAY_PLACE = (
    "case when s in ('apply_robust_scaling', 'handle_outliers', 'handle_severe_missing_data', 'apply_target_encoding',"
    " 'drop_near_constant_features', 'drop_correlated_features', 'drop_leaky_features', 'drop_sensitive_features',"
    " 'apply_feature_engineering') then 9 when s in ('consider_imbalance_strategy', 'apply_oversampling',"
    " 'apply_regularization') then 29 when s in ('use_simple_models_only', 'use_ensemble_models') then 19 end"
)
# place: core steps at 0, 10, ..., 70; a step in front of one at its place - 1; appended ones at 99.
PLAN_CTES = SIGNAL_CTES + f""",
  hs as (select *, {HINT} as hint, {HINT_MODEL} as hint_model from (select *, substring(md5(dataset_id), 1, 1) as h from sig)),
  fired as (
    {' union all '.join(_rule(0, s, 'true' if s != 'validate_with_cross_validation' else 'not (n_row * n_col > 2000000 or features >= 250)', i * 10) for i, s in enumerate(rules.CORE_STEPS))}
    union all {' union all '.join([
        _rule(1, 'apply_oversampling', 'imbalance_ratio >= 5', 29),
        _rule(2, 'consider_imbalance_strategy', 'imbalance_ratio >= 3 and imbalance_ratio < 5', 29),
        _rule(3, 'apply_regularization', 'n_row < 1000 or high_dim', 99),
        _rule(4, 'use_simple_models_only', 'n_row < 1000 or high_dim', 99),
        _rule(3, 'use_ensemble_models', 'n_row >= 10000 and not high_dim', 99),
        _rule(5, 'use_time_aware_validation', 'has_datetime', 49),
        _rule(6, 'apply_target_encoding', 'high_card', 9),
        _rule(7, "'prioritize_model:' || hint_model", 'hint_model is not null', 99),
    ])}
    union all select dataset_id, 8 + i / 100.0, {REPLAY_PLACE}, s from
      (select dataset_id, unnest(hint) as s, generate_subscripts(hint, 1) as i from hs) where {REPLAY_PLACE} is not null
    union all {' union all '.join([
        _rule(20, 'handle_outliers', 'len(outlier_cols) > 0', 9),
        _rule(21, 'handle_severe_missing_data', 'max_missing > 20', 9),
        _rule(22, 'reduce_tuning_budget', 'n_row >= 1000 and not high_dim and n_row * n_col > 500000', 39),
        _rule(23, 'tune_hyperparameters', 'n_row >= 1000 and not high_dim', 39),
        _rule(24, 'apply_robust_scaling', 'scale_mismatch', 9),
        _rule(25, 'drop_leaky_features', 'len(hard_cols) > 0', 9),
        _rule(26, 'drop_near_constant_features', 'len(near_cols) > 0', 9),
        _rule(27, 'drop_correlated_features', CORR_APPLIES, 9),
        _rule(28, 'drop_sensitive_features', 'len(sensitive_cols) > 0', 9),
        _rule(29, 'apply_feature_engineering', 'features <= 15', 9),
    ])}),
  once as (select * from fired qualify row_number() over (partition by dataset_id, step order by rule) = 1),
  plan as (select dataset_id, step, cast(row_number() over (partition by dataset_id order by place, rule) - 1 as integer) as pos from once)"""


def study_plan(spark, folder) -> DataFrame:
    s = study_signals(spark, folder)
    return rules.recommend(s, study_hints(s), PUBLISHED)


@query("plan_rules", f"with {PLAN_CTES} select dataset_id, pos, step from plan")
def plan_rules(spark, folder):
    return rules.plan_rows(study_plan(spark, folder)).drop("reason")


@query("step_flags", f"""with {PLAN_CTES}, s as (select dataset_id, list(step) as steps from plan group by all)
    select dataset_id, {', '.join(f"list_contains(steps, '{s}') as {f}" for s, f in rules.STEP_FLAGS.items())} from s""")
def step_flags(spark, folder):
    return rules.flags(study_plan(spark, folder))


# Issues per dataset, worded as the diagnostics word them.
ISSUES = """case when h in ('0', '1') then ['High balanced accuracy but low F1 macro suggests overfitting.']
  when h in ('2', '3') then ['Severe class imbalance (ratio 6.0x)', 'Macro F1 (0.310) is below the expected threshold (0.45).']
  when h in ('4', '5') then ['Held-out r2 (0.500) differs noticeably from cross-validation mean (0.200).', 'imbalance']
  when h in ('6', '7', '8') then ['Numerical instability warnings present'] else ['other'] end"""


def study_issues(planned: DataFrame) -> DataFrame:
    issues = ISSUES.replace("[", "array(").replace("]", ")")
    return rules.steps_of(planned).selectExpr(KEY, "steps", f"{issues.replace('h in', 'substring(md5(dataset_id), 1, 1) in')} as issues")


REPLAN_CTES = PLAN_CTES + f""",
  iss as (select dataset_id, lower(array_to_string(issues, ' ')) as t from
          (select dataset_id, {ISSUES} as issues from (select dataset_id, substring(md5(dataset_id), 1, 1) as h from sig))),
  edits as (
    select dataset_id, 100 as rule, 'apply_regularization' as step, 'train_models' as anchor from iss where contains(t, 'overfitting')
    union all select dataset_id, 101, 'consider_imbalance_strategy', 'train_models' from iss where contains(t, 'imbalance')
    union all select dataset_id, 102, 'use_ensemble_models', null from iss where contains(t, 'f1') or contains(t, 'r²') or contains(t, 'r2') or contains(t, 'baseline')
    union all select dataset_id, 103, 'apply_robust_scaling', 'build_preprocessor' from iss where contains(t, 'instability') or contains(t, 'scaling')
    union all select dataset_id, 104, 'apply_regularization', 'train_models' from iss where contains(t, 'cross-validation mean')
    union all select dataset_id, 105, 'replan_attempt', null from iss),
  fresh as (select e.dataset_id, e.step, rule, coalesce((select a.pos from plan a where a.dataset_id = e.dataset_id and a.step = e.anchor) - 0.5, 1000) as spot
            from edits e anti join plan p on p.dataset_id = e.dataset_id and p.step = e.step
            qualify row_number() over (partition by e.dataset_id, e.step order by rule) = 1),
  newplan as (select dataset_id, step, row_number() over (partition by dataset_id order by spot, rule) - 1 as pos
              from (select dataset_id, step, pos as spot, 0 as rule from plan union all select dataset_id, step, spot, rule from fresh))"""


def study_replan(spark, folder) -> DataFrame:
    return rp.replan(study_issues(study_plan(spark, folder)))


@query("replan_edits", f"""with {REPLAN_CTES} select n.dataset_id, cast(n.pos as integer) as pos, n.step,
    contains(t, 'cross-validation mean') as widen_test,
    round(case when contains(t, 'cross-validation mean') then greatest(0.2, least(0.2 + 0.1, 0.35)) else 0.2 end, 6)::double as test_share
    from newplan n join iss using (dataset_id)""")
def replan_edits(spark, folder):
    share = F.when(F.col("widen_test"), rp.widened_test_share(F.lit(0.2))).otherwise(F.lit(0.2))
    edited = study_replan(spark, folder).select(KEY, F.posexplode("new_steps").alias("pos", "step"), "widen_test")
    return edited.withColumn("test_share", F.round(share, 6))


@query("plan_diff", f"""with {REPLAN_CTES} select dataset_id, 'added' as change, step from newplan anti join plan using (dataset_id, step) where step <> 'replan_attempt'
    union all select dataset_id, 'removed', step from plan anti join newplan using (dataset_id, step)""")
def plan_diff(spark, folder):
    return rp.plan_diff(study_replan(spark, folder))


# --- routes and keep list ---

ROUTE_CTES = SIGNAL_CTES + """,
  grp as (select dataset_id, column_name, n_unique, n_rows, missing_pct,
            case when kind = 'boolean' or (kind = 'categorical' and n_unique <= 2) then 'binary'
                 when kind = 'categorical' then 'multiclass' else kind end as g from st where column_name <> 'target'),
  route as (select dataset_id, column_name,
      case when missing_pct > (case when n_rows < 1000 then 60 when n_rows < 10000 then 50 else 40 end) then 'too_many_missing'
           when g in ('ordinal', 'continuous') then 'numeric'
           when g = 'binary' or (g = 'multiclass' and n_unique < 50 and n_unique / greatest(n_rows, 1) < 0.05) then 'one_hot'
           when g = 'multiclass' or (g = 'text' and n_unique > 50 and n_unique < n_rows * 0.1) then 'target_encoding'
           else 'left_out' end as route from grp),
  gone as (select dataset_id, unnest(near_cols) as column_name from sig
           union select dataset_id, unnest(corr_cols) from sig where """ + CORR_APPLIES + """
           union select dataset_id, unnest(hard_cols) from sig union select dataset_id, unnest(sensitive_cols) from sig)"""


def study_keep(spark, folder) -> DataFrame:
    sig, stats = _study_tables(spark, folder)
    groups = schema.feature_groups(stats, TARGET).join(
        stats.select(KEY, "pos", "n_rows", "missing_pct"), [KEY, "pos"]
    )
    return prepare.keep_list(prepare.encoding_route(groups, PUBLISHED), rules.dropped_columns(sig))


@query("encoding_route", f"""with {ROUTE_CTES} select dataset_id, column_name, route from route""")
def encoding_route(spark, folder):
    stats = materialise(schema.profile_columns(study(spark, folder)))  # read twice below
    groups = schema.feature_groups(stats, TARGET).join(stats.select(KEY, "pos", "n_rows", "missing_pct"), [KEY, "pos"])
    return prepare.encoding_route(groups, PUBLISHED).select(KEY, "column_name", "route")


@query("feature_keep_list", f"""with {ROUTE_CTES},
    m as (select dataset_id, column_name, route in ('numeric', 'one_hot', 'target_encoding') and gone.column_name is null as kept
          from route left join gone using (dataset_id, column_name))
    select dataset_id, count(*) filter (where kept) as n_kept,
           coalesce(array_to_string(list(column_name order by column_name) filter (where kept), ','), '') as kept_cols,
           count(*) filter (where kept) = 0 as feature_cascade from m group by all""".replace("gone.column_name is null", "g.column_name is null")
    .replace("left join gone using (dataset_id, column_name)", "left join gone g using (dataset_id, column_name)"))
def feature_keep_list(spark, folder):
    kept = study_keep(spark, folder)
    names = kept.groupBy(KEY).agg(fv.joined(F.collect_list(F.when(F.col("kept"), F.col("column_name")))).alias("kept_cols"))
    return prepare.cascade(kept).join(names, KEY)
