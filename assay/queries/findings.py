"""Scores, diagnostics and history over the study's many datasets.

Three rule-made models per dataset predict its target with a quality that depends on h, the leading
hex digit of md5(dataset_id); folds come from a row digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from assay import thresholds as th
from assay.functions import values as fv
from assay.operators import diagnose, history, metrics
from assay.operators.counts import KEY
from assay.plans import rules
from assay.queries.base import query
from assay.queries.study import EACH_DUCK, EACH_SPARK, PLAN_CTES, SIGNAL_CTES, kept, study_plan, study_signals
from assay.session import materialise, shared_folder
from assay.sources import runlog
from assay.sources.artefacts import append_history
from assay.sources.tables import read_table

BASE = """
    select *, case when substring(dataset_id, 1, 1) = 'S' then 5 else 3 end as k,
      case y when 'F' then 'O' when 'O' then 'F' when 'R' then 'N' else 'R' end as other,
      md5(concat(l_orderkey, '|', l_partkey, '|', l_suppkey, '|', l_linenumber)) as dg
    from (
      select *, case when h in ('c', 'd') then (case when l_orderkey % 12 = 0 then 'R' else 'N' end)
                     when h = 'e' then (case when l_orderkey % 5 = 0 then 'R' else 'N' end)
                     else l_linestatus end as y
      from (select *, substring(md5(dataset_id), 1, 1) as h from (<each>) e) e2) e3"""
CLS = """
    select dataset_id, m.pos as pos, m.model as model, cast(<hex> % k as int) as fold, y as label, m.prediction as prediction
    from (select *, <unnest>([
        {'pos': 0, 'model': 'DummyMostFrequent', 'prediction': case when h in ('c', 'd', 'e') then 'N' else 'F' end},
        {'pos': 1, 'model': 'LogisticRegression', 'prediction': case when md5(concat(dg, '|lr')) <
           (case when h < '4' then '9' when h < '8' then 'c' when h < 'c' then 'f' else 'g' end) then y else other end},
        {'pos': 2, 'model': 'RandomForest', 'prediction': case when md5(concat(dg, '|rf')) <
           (case when h in ('0', '8', 'c', 'd', 'f') then 'g' when h < '8' then 'b' else 'e' end) then y else other end}
      ]) as m from (<base>) b) p"""
REG = """
    select dataset_id, m.pos as pos, m.model as model, cast(<hex> % k as int) as fold, l_extendedprice as label, m.prediction as prediction
    from (select *, <unnest>([
        {'pos': 0, 'model': 'DummyMean', 'prediction': cast(38000 as double)},
        {'pos': 1, 'model': 'LinearRegression', 'prediction': cast(case when h in ('e', 'f') then l_extendedprice + l_quantity
            when h < '8' then 1500 * l_quantity else 100 * l_quantity + 30000 end as double)},
        {'pos': 2, 'model': 'Ridge', 'prediction': cast(case when h in ('e', 'f') then l_extendedprice + 2 * l_quantity
            when h in ('4', '5') then 1490 * l_quantity + 500 else 20 * l_quantity + 35000 end as double)}
      ]) as m from (<base>) b) p"""


def _duck(text: str) -> str:
    return (
        text.replace("<base>", BASE.replace("<each>", EACH_DUCK)).replace("<unnest>", "unnest")
        .replace("<hex>", "('0x' || substr(dg, 1, 7))::int")
    )


def _spark(text: str) -> str:
    import re
    items = re.sub(r"\{'pos': (\d), 'model': '(\w+)', 'prediction': ", r"named_struct('pos', \1, 'model', '\2', 'prediction', ", text)
    items = items.replace("},", "),").replace("}\n      ])", ")\n      ))").replace("<unnest>([", "explode(array(")
    return (
        items.replace("<base>", BASE.replace("<each>", EACH_SPARK))
        .replace("<hex>", "cast(conv(substring(dg, 1, 7), 16, 10) as bigint)")
    )


def predictions(spark, folder: str, classification: bool = True) -> DataFrame:
    text = _spark(CLS if classification else REG)
    return spark.sql(text, lineitem=read_table(spark, folder, "lineitem"))


def scores_sql(name: str, src: str, by: str) -> str:
    """Class scores per group as DuckDB common tables: <name>_rep per class, <name> per group."""
    cols = by.split(", ")
    return f"""
  {name}_rep as (select {by}, c as class_label, sum(support) as support,
      coalesce(sum(hit) / nullif(sum(predicted), 0), 0) as precision, coalesce(sum(hit) / nullif(sum(support), 0), 0) as recall,
      coalesce(2 * sum(hit) / nullif(sum(predicted) + sum(support), 0), 0) as f1, sum(hit) as hit
    from (select {by}, label as c, 1 as support, 0 as predicted, case when label = prediction then 1 else 0 end as hit from {src}
          union all select {by}, prediction, 0, 1, 0 from {src}) u group by {by}, c),
  {name} as (select {', '.join(cols)}, sum(hit) / sum(support) as accuracy, avg(case when support > 0 then recall end) as balanced_accuracy,
      avg(f1) as f1_macro, avg(precision) as precision_macro, avg(recall) as recall_macro from {name}_rep group by {by})"""


def number_scores_sql(name: str, src: str, by: str) -> str:
    return f"""
  {name} as (select {by}, 1 - sum((label - prediction) * (label - prediction)) / nullif(var_pop(label) * count(*), 0) as r2,
      avg(abs(label - prediction)) as mae, sqrt(avg((label - prediction) * (label - prediction))) as rmse from {src} group by {by})"""


def _boards(classification: bool) -> str:
    src = "p"
    ctes = f"p as ({_duck(CLS if classification else REG)}),"
    score, order = ("balanced_accuracy", "balanced_accuracy desc, f1_macro desc") if classification else ("r2", "r2 desc")
    maker = scores_sql if classification else number_scores_sql
    ctes += maker("m", src, "dataset_id, model, pos") + "," + maker("fm", src, "dataset_id, model, fold") + ","
    return ctes + f"""
  board as (select *, row_number() over (partition by dataset_id order by {order}, pos) as rank from m),
  cv as (select dataset_id, model, avg({score}) as cv_mean, stddev_pop({score}) as cv_std, list({score} order by fold) as fs,
           count(*) as n_splits from fm group by all),
  cvr as (select *, row_number() over (partition by dataset_id order by cv_mean desc, model) as cv_rank from cv)"""


# Paired t-test of the two best models, p in closed form for one to four degrees of freedom.
T_CTES = """
  two as (select dataset_id, max(model) filter (where cv_rank = 1) as model_a, max(model) filter (where cv_rank = 2) as model_b,
            first(fs) filter (where cv_rank = 1) as a, first(fs) filter (where cv_rank = 2) as b from cvr group by all),
  dif as (select dataset_id, model_a, model_b, unnest(a) - unnest(b) as d from two),
  tt as (select dataset_id, model_a, model_b, count(*) as k, avg(d) as mean, stddev_samp(d) as sd, bool_and(d = 0) as same from dif group by all),
  tp as (select *, case when same then 0 else mean / nullif(sd / sqrt(k), 0) end as t,
           atan(abs(case when same then 0 else mean / nullif(sd / sqrt(k), 0) end) / sqrt(k - 1)) as th from tt),
  test as (select dataset_id, model_a, model_b, t, case when same then 1.0 when sd = 0 then 0.0 else 1 - case k - 1
             when 1 then 2 * th / pi() when 2 then sin(th) when 3 then (th + sin(th) * cos(th)) * 2 / pi()
             when 4 then sin(th) * (1 + cos(th) * cos(th) / 2) end end as p_value from tp)"""

WARNINGS = """case when h in ('5', '6') then ['RuntimeWarning: overflow encountered in matmul', 'DeprecationWarning: old call']
    when h = '7' then ['FutureWarning: changed default', 'Could not find the number of physical cores'] end"""


def study_warnings(sig: DataFrame) -> DataFrame:
    text = WARNINGS.replace("[", "array(").replace("]", ")").replace("h in", "substring(md5(dataset_id), 1, 1) in").replace(
        "when h =", "when substring(md5(dataset_id), 1, 1) =")
    return sig.selectExpr(KEY, f"{text} as warnings")


def study_counts(spark, folder) -> DataFrame:
    """Confusion counts of every dataset, model and fold: all that class scores need, written once for the queries of a session like its signals."""
    return kept(spark, folder, "confusion", lambda: metrics.confusion_counts(predictions(spark, folder), [KEY, "model", "pos", "fold"]))


def study_report(spark, folder) -> DataFrame:
    """Class report of every dataset and model, folds put together."""
    by = [KEY, "model", "pos"]
    whole = study_counts(spark, folder).groupBy(*by, "label", "prediction").agg(F.sum("n").alias("n"))
    return metrics.class_report(whole, by)


def study_board(spark, folder, classification=True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaderboard, fold summary, fold metrics)"""
    by, folds = [KEY, "model", "pos"], [KEY, "model", "fold"]
    if classification:
        m = metrics.class_metrics(study_report(spark, folder), by)
        fm = metrics.class_metrics(metrics.class_report(study_counts(spark, folder), folds), folds)
    else:
        scored = lambda g: metrics.score_numbers(predictions(spark, folder, False), g)
        m, fm = kept(spark, folder, "numbers", lambda: scored(by)), kept(spark, folder, "fold numbers", lambda: scored(folds))
    board = metrics.leaderboard(m, [KEY], classification, F.col("pos"))
    return board, metrics.cv_summary(fm, [KEY], classification), fm


def study_evidence(spark, folder, classification=True) -> DataFrame:
    sig = study_signals(spark, folder)
    board, summary, fm = study_board(spark, folder, classification)
    score = "balanced_accuracy" if classification else "r2"
    h = F.substring(F.md5(KEY), 1, 1)
    flags = sig.select(KEY, (h == "a").alias("drop_leaky"), h.isin("0", "2").alias("is_replan"))
    first = fm.where("fold = 0").select(KEY, "model", F.col(score).alias("prev_score"))
    past = board.where("rank = 1").select(KEY, "model").join(first, [KEY, "model"]).select(KEY, "prev_score")
    reports = None
    if classification:
        reports = study_report(spark, folder).join(board.where("rank = 1").select(KEY, "model"), [KEY, "model"])
    return diagnose.evidence(sig, board, summary, flags, study_warnings(sig), reports, past, classification)


def _evidence(classification: bool) -> str:
    score = "balanced_accuracy" if classification else "r2"
    near = "balanced_accuracy >= 0.99 and f1_macro >= 0.99" if classification else "r2 >= 0.99"
    extra = ", max(f1_macro) filter (where rank = 1) as f1, max(f1_macro) - min(f1_macro) as f1_range" if classification else ""
    weak = (
        "left join (select r.dataset_id, min(r.f1) as weak_f1 from m_rep r join board using (dataset_id, model, pos) where rank = 1 and r.f1 < 0.4 group by all) w using (dataset_id)"
        if classification else ""
    )
    return SIGNAL_CTES + "," + _boards(classification) + "," + T_CTES + f""",
  b as (select dataset_id, max(model) filter (where rank = 1) as best_model, max({score}) filter (where rank = 1) as score,
          max({score}) filter (where contains(model, 'Dummy')) as base_score, count(*) as n_models,
          count(*) filter (where not contains(model, 'Dummy') and {near}) as n_perfect{extra} from board group by all),
  ev as (select sig.*, b.* exclude (dataset_id), cvr.cv_mean, cvr.cv_std, cw.model as cv_best, p_value, p_value <= 0.05 as significant, model_a, model_b,
           substring(md5(dataset_id), 1, 1) as h, fm.{score} as prev_score{', weak_f1' if classification else ''},
           substring(md5(dataset_id), 1, 1) = 'a' as drop_leaky, substring(md5(dataset_id), 1, 1) in ('0', '2') as is_replan,
           substring(md5(dataset_id), 1, 1) in ('5', '6') as unstable, coalesce(imbalance_ratio, 1) as imb
         from sig join b using (dataset_id) left join cvr on cvr.dataset_id = sig.dataset_id and cvr.model = b.best_model
         left join cvr cw on cw.dataset_id = sig.dataset_id and cw.cv_rank = 1 left join test using (dataset_id)
         left join fm on fm.dataset_id = sig.dataset_id and fm.model = b.best_model and fm.fold = 0 {weak})"""


FLOOR = "(case when imb >= 5 then 0.45 when imb >= 3 then 0.5 else 0.6 end)"
NO_GAIN = "base_score is not null and score - base_score < 0.05"


def _rule_rows(classification: bool) -> list[tuple[str, str, bool, str, str]]:
    gap, std = (0.08, 0.05) if classification else (0.15, 0.1)
    cv = [
        ("cv_gap", "issue", True, f"abs(score - cv_mean) > {gap}", "abs(score - cv_mean)"),
        ("cv_unstable", "issue", True, f"cv_std > {std}", "cv_std"),
        ("cv_other_winner", "suggestion", False, "cv_mean is not null and cv_best <> best_model", "null"),
    ]
    last = [
        ("tied_models", "suggestion", False, "not significant", "p_value"),
        ("history_gain", "suggestion", False, "score - prev_score > 0.02", "score - prev_score"),
        ("history_drop", "issue", False, "score - prev_score < -0.02", "score - prev_score"),
    ]
    first = [
        ("hard_leakage", "issue", True, "len(hard_cols) > 0 and not drop_leaky", "null"),
        ("hard_leakage_dropped", "suggestion", False, "len(hard_cols) > 0 and drop_leaky", "null"),
        ("soft_leakage", "issue", True, "len(soft_cols) > 0 and not drop_leaky", "null"),
        ("sensitive_columns", "suggestion", False, "len(sensitive_cols) > 0", "null"),
        ("no_gain_after_replan", "issue", False, f"{NO_GAIN} and is_replan", "score - base_score"),
        ("weak_margin", "issue", False, f"{NO_GAIN} and not is_replan", "score - base_score"),
    ]
    if not classification:
        return first + [
            ("low_r2", "issue", False, "score < 0.1", "score"), ("instability", "suggestion", False, "unstable", "null"),
            ("instability_low_r2", "issue", True, "unstable and score < 0.1", "null"),
            ("near_perfect", "issue", True, "n_perfect >= 2", "null"),
            ("outliers_low_r2", "issue", False, "len(outlier_cols) > 0 and score < 0.1", "score"),
        ] + cv + last
    return first + [
        ("overfitting", "issue", False, "score > 0.9 and f1 < 0.7", "f1"),
        ("f1_below_floor", "issue", False, f"f1 < {FLOOR}", "f1"),
        ("severe_imbalance_weak", "issue", False, "imb >= 5 and score - coalesce(base_score, 0) < 0.1", "score - coalesce(base_score, 0)"),
        ("severe_imbalance", "suggestion", False, "imb >= 5", "imb"),
        ("imbalance", "suggestion", False, "imb >= 3 and imb < 5", "imb"),
        ("near_perfect", "issue", True, "n_perfect >= 2", "null"),
        ("weak_class", "issue", False, "weak_f1 is not null", "weak_f1"),
    ] + cv + [
        ("low_diversity", "issue", False, "n_models > 1 and f1_range < 0.05", "f1_range"),
        ("instability", "suggestion", False, "unstable", "null"),
        ("instability_weak_f1", "issue", True, "unstable and f1 < 0.6", "f1"),
    ] + last


def _findings(classification: bool) -> str:
    return _evidence(classification) + ", found as (" + " union all ".join(
        f"select dataset_id, {i} as pos, '{r}' as rule, '{s}' as severity, {str(rev).lower()} as review, cast({v} as double) as value from ev where {c}"
        for i, (r, s, rev, c, v) in enumerate(_rule_rows(classification))) + ")"


def _reflected(classification: bool) -> str:
    weak = f"f1 < {FLOOR}" if classification else "score < 0.1"
    return _findings(classification) + f""",
  agg as (select dataset_id, bool_or(severity = 'issue') as issues, bool_or(severity = 'issue' and rule <> 'history_drop') as early,
            bool_or(review) as review, bool_or(rule in ('cv_gap', 'cv_unstable')) as cv, bool_or(rule = 'no_gain_after_replan') as garbage
          from found group by all),
  refl as (select ev.*, case when coalesce(issues, false) then 'needs_attention' else 'ok' end as status, coalesce(review, false) as review_required,
             coalesce(early, false) and (coalesce({weak}, false) or coalesce(cv, false)) and not coalesce(garbage, false) as replan_recommended,
             coalesce(cv, false) as cv_concern from ev left join agg using (dataset_id)),
  ver as (select *, case when len(hard_cols) > 0 and not drop_leaky then '{th.INVALID}'
      when (len(soft_cols) > 0 and not drop_leaky) or cv_concern or review_required or status = 'needs_attention' or replan_recommended
           or contains(best_model, 'Dummy') then '{th.CAUTION}' else '{th.RELIABLE}' end as verdict from refl)"""


def _diagnostics(classification: bool) -> str:
    return f"with {_findings(classification)} select dataset_id, pos, rule, severity, review, round(value, 6) as value from found"


@query("diagnostics_cls", _diagnostics(True))
def diagnostics_cls(spark, folder):
    return diagnose.findings(study_evidence(spark, folder)).withColumn("value", F.round("value", 6))


@query("diagnostics_reg", _diagnostics(False))
def diagnostics_reg(spark, folder):
    return diagnose.findings(study_evidence(spark, folder, False), False).withColumn("value", F.round("value", 6))


@query("cv_consistency", f"with {_boards(True)}" """
    select b.dataset_id, b.model, round(b.balanced_accuracy, 6) as score, round(c.cv_mean, 6) as cv_mean, round(c.cv_std, 6) as cv_std,
           abs(b.balanced_accuracy - c.cv_mean) > 0.08 as gap_alert, c.cv_std > 0.05 as std_alert, w.model as cv_winner
    from board b join cvr c on c.dataset_id = b.dataset_id and c.model = b.model join cvr w on w.dataset_id = b.dataset_id and w.cv_rank = 1
    where b.rank = 1""")
def cv_consistency(spark, folder):
    board, summary, _ = study_board(spark, folder)
    won = summary.where("cv_rank = 1").select(KEY, F.col("model").alias("cv_winner"))
    best = board.where("rank = 1").select(KEY, "model", F.col("balanced_accuracy").alias("score"))
    out = best.join(summary, [KEY, "model"]).join(won, KEY)
    return out.select(
        KEY, "model", F.round("score", 6).alias("score"), F.round("primary_mean", 6).alias("cv_mean"),
        F.round("primary_std", 6).alias("cv_std"),
        (F.abs(F.col("score") - F.col("primary_mean")) > th.CV_GAP_CLS).alias("gap_alert"),
        (F.col("primary_std") > th.CV_STD_CLS).alias("std_alert"), "cv_winner",
    )


@query("paired_t", f"with {_boards(True)},{T_CTES} select dataset_id, model_a, model_b, round(t, 5) as t_statistic, round(p_value, 6) as p_value, p_value <= 0.05 as significant from test")
def paired_t(spark, folder):
    _, summary, _ = study_board(spark, folder)
    return diagnose.paired_t(summary).select(
        KEY, "model_a", "model_b", F.round("t_statistic", 5).alias("t_statistic"), F.round("p_value", 6).alias("p_value"), "significant"
    )


@query("replan_flag", f"with {_reflected(True)} select dataset_id, status, review_required, replan_recommended from refl")
def replan_flag(spark, folder):
    return diagnose.reflection(study_evidence(spark, folder)).select(KEY, "status", "review_required", "replan_recommended")


@query("replan_flag_reg", f"with {_reflected(False)} select dataset_id, status, review_required, replan_recommended from refl")
def replan_flag_reg(spark, folder):
    return diagnose.reflection(study_evidence(spark, folder, False), False).select(KEY, "status", "review_required", "replan_recommended")


def study_verdicts(spark, folder, classification=True) -> DataFrame:
    return diagnose.verdicts(diagnose.reflection(study_evidence(spark, folder, classification), classification))


@query("verdict", f"with {_reflected(True)} select dataset_id, best_model, verdict from ver")
def verdict(spark, folder):
    return study_verdicts(spark, folder).select(KEY, "best_model", "verdict")


RANKS = "case m when 'DummyMostFrequent' then 0 when 'LogisticRegression' then 1 when 'RandomForest' then 4 else 50 end"


@query("tie_break", f"""with {_evidence(True)},
    c as (select dataset_id, best_model, case when not significant then case when (({RANKS.replace(' m ', ' model_a ')}, model_a) <= ({RANKS.replace(' m ', ' model_b ')}, model_b))
          then model_a else model_b end end as tied_choice from ev)
    select dataset_id, best_model, tied_choice, coalesce(tied_choice, best_model) as final_model from c""")
def tie_break(spark, folder):
    return diagnose.tie_break(study_evidence(spark, folder))


@query("target_unsuitable", f"""with {_reflected(True)} select dataset_id, best_model, verdict,
    verdict = '{th.INVALID}' or contains(best_model, 'Dummy') or score - coalesce(base_score, 0) < 0.05 as unsuitable from ver""")
def target_unsuitable(spark, folder):
    return diagnose.target_unsuitable(study_verdicts(spark, folder))


@query("tuning_skip", f"""with {_boards(True)},
    b as (select dataset_id, max(model) filter (where rank = 1) as best_model, max(balanced_accuracy) filter (where rank = 1) as score,
          max(balanced_accuracy) filter (where contains(model, 'Dummy')) as base_score, substring(md5(dataset_id), 1, 1) as h from board group by all)
    select dataset_id, best_model, case when contains(best_model, 'Dummy') then 'baseline_wins' when h in ('5', '6') then 'unstable'
      when score >= 0.99 then 'near_perfect' when score - base_score < 0.05 then 'weak_margin' end as skip_reason from b""")
def tuning_skip(spark, folder):
    board, _, _ = study_board(spark, folder)
    warned = study_warnings(board.select(KEY).distinct())
    return diagnose.tuning_skip(board, warned).select(KEY, "best_model", "skip_reason")


TEXTS = {
    "sensitive_columns": "Consider a fairness audit of sensitive attributes.",
    "severe_imbalance": "Consider class weights or oversampling.",
    "imbalance": "Consider class weight tuning or a threshold.",
    "instability": "Numerical instability: consider robust scaling.",
    "tied_models": "Consider the simpler model.",
    "cv_other_winner": "Prefer the cross-validation ranking.",
    "history_gain": "Better than the prior run.",
    "hard_leakage_dropped": "Verify that the leakage columns stay out.",
}
CRITICAL = " or ".join(f"contains(lower(t), '{w}')" for w in th.CRITICAL_WORDS)
MEDIUM = " or ".join(f"contains(lower(t), '{w}')" for w in th.MEDIUM_WORDS)


@query("suggestion_rank", f"""with {_findings(True)},
    s as (select dataset_id, pos, rule, case rule {' '.join(f"when '{r}' then '{t}'" for r, t in TEXTS.items())} end as t from found where severity = 'suggestion'),
    pr as (select *, case when {CRITICAL} then 0 when {MEDIUM} then 1 else 2 end as priority from s)
    select dataset_id, rule, priority, cast(row_number() over (partition by dataset_id order by priority, pos) as int) as rank from pr""")
def suggestion_rank(spark, folder):
    found = diagnose.findings(study_evidence(spark, folder)).where("severity = 'suggestion'")
    text = F.create_map(*[F.lit(x) for kv in TEXTS.items() for x in kv])[F.col("rule")]
    return diagnose.suggestion_rank(found.withColumn("t", text), "t").select(KEY, "rule", "priority", "rank")


@query("warning_triage", f"""with d as (select dataset_id, substring(md5(dataset_id), 1, 1) as h, count(*) as n_rows from ({EACH_DUCK}) group by 1),
    w as (select dataset_id, n_rows, unnest({WARNINGS}) as warning from d)
    select dataset_id, n_rows, warning, case when {' or '.join(f"contains(lower(warning), '{x}')" for x in th.NOTICE_WORDS)} then 'notice' else 'actionable' end as triage from w""")
def warning_triage(spark, folder):
    sizes = spark.sql(EACH_SPARK, lineitem=read_table(spark, folder, "lineitem")).groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = study_warnings(sizes).join(sizes, KEY).select(KEY, "n_rows", F.explode("warnings").alias("warning"))
    return diagnose.warning_triage(rows, "warning")


# --- scores over the study ---

@query("fold_metrics", f"with {_boards(True)} select dataset_id, model, fold, {', '.join(f'round({c}, 6) as {c}' for c in ('accuracy', 'balanced_accuracy', 'f1_macro'))} from fm")
def fold_metrics(spark, folder):
    _, _, fm = study_board(spark, folder)
    return fm.select(KEY, "model", "fold", *[F.round(c, 6).alias(c) for c in ("accuracy", "balanced_accuracy", "f1_macro")])


@query("cv_summary", f"with {_boards(True)} select dataset_id, model, n_splits, round(cv_mean, 6) as primary_mean, round(cv_std, 6) as primary_std, cast(cv_rank as int) as cv_rank, array_to_string(list_transform(fs, lambda x: cast(cast(round(x * 1000000) as bigint) as varchar)), ',') as fold_scores from cvr")
def cv_summary(spark, folder):
    _, s, _ = study_board(spark, folder)
    micro = F.transform("fold_scores", lambda x: F.round(x * 1000000).cast("bigint").cast("string"))
    return s.select(
        KEY, "model", "n_splits", F.round("primary_mean", 6).alias("primary_mean"), F.round("primary_std", 6).alias("primary_std"),
        "cv_rank", F.concat_ws(",", micro).alias("fold_scores"),
    )


@query("leaderboard", f"with {_boards(True)} select dataset_id, model, cast(rank as int) as rank, round(balanced_accuracy, 6) as balanced_accuracy, round(f1_macro, 6) as f1_macro from board")
def leaderboard(spark, folder):
    board, _, _ = study_board(spark, folder)
    return board.select(KEY, "model", "rank", F.round("balanced_accuracy", 6).alias("balanced_accuracy"), F.round("f1_macro", 6).alias("f1_macro"))


@query("leaderboard_reg", f"with {_boards(False)} select dataset_id, model, cast(rank as int) as rank, round(r2, 6) as r2 from board")
def leaderboard_reg(spark, folder):
    board, _, _ = study_board(spark, folder, False)
    return board.select(KEY, "model", "rank", F.round("r2", 6).alias("r2"))


# --- run history ---

# Every dataset leaves one record; its time is the last ship date, its origin follows h.
LOG_CTES = f"""{_reflected(True)},
  seen as (select dataset_id, max(l_shipdate) as seen_at from ({EACH_DUCK}) group by all),
  log as (select dataset_id as dataset, 'fp_' || substr(md5(dataset_id || '|target'), 1, 12) as fingerprint, 'target' as target,
            cast(n_row as bigint) as rows_, n_col as cols_, verdict, best_model, seen_at, imbalance_ratio, max_missing,
            case when h < '8' then 'manual' else 'inferred' end as target_origin
          from ver join seen using (dataset_id)),
  s1 as (select * from log qualify row_number() over (partition by target, rows_, cols_ order by seen_at desc, fingerprint desc) = 1),
  store as (select * from s1 qualify row_number() over (partition by fingerprint order by seen_at desc) = 1)"""


def study_log(spark, folder) -> DataFrame:
    judged = study_verdicts(spark, folder)
    lines = spark.sql(EACH_SPARK, lineitem=read_table(spark, folder, "lineitem"))
    seen = lines.groupBy(KEY).agg(F.max("l_shipdate").alias("seen_at"))
    h = F.substring(F.md5(KEY), 1, 1)
    return judged.join(seen, KEY).select(
        F.col(KEY).alias("dataset"), F.concat(F.lit("fp_"), F.substring(fv.md5_of(F.col(KEY), "target"), 1, 12)).alias("fingerprint"),
        F.lit("target").alias("target"), "rows", "cols", "verdict", "best_model", "seen_at", "imbalance_ratio", "max_missing",
        F.when(h < "8", "manual").otherwise("inferred").alias("target_origin"), F.lit(True).alias("is_classification"),
        F.lit(None).cast("array<string>").alias("steps"),
    )


@query("history_latest", f"with {LOG_CTES} select dataset, fingerprint, rows_ as n_row, cols_ as n_col, verdict, best_model from store")
def history_latest(spark, folder):
    return history.latest(study_log(spark, folder)).select(
        "dataset", "fingerprint", F.col("rows").alias("n_row"), F.col("cols").alias("n_col"), "verdict", "best_model")


@query("history_compacted", f"with {LOG_CTES} select dataset, fingerprint, rows_ as n_row, cols_ as n_col, verdict, best_model from store")
def history_compacted(spark, folder):
    """The store out of a log that was appended to three times and compacted in between."""
    log = study_log(spark, folder).withColumns({
        "seen_at": F.col("seen_at").cast("timestamp"), "score": F.lit(None).cast("double"), "status": F.lit(None).cast("string")})
    log = materialise(log)
    home = f"{shared_folder(spark).rstrip('/')}/runlog-{uuid.uuid4().hex}"
    for part in range(3):
        append_history(log.where(F.pmod(F.xxhash64("fingerprint"), F.lit(3)) == part), home)
        if part < 2:
            runlog.compact(spark, home)
    return history.latest(runlog.read(spark, home)[0]).select(
        "dataset", "fingerprint", F.col("rows").alias("n_row"), F.col("cols").cast(log.schema["cols"].dataType).alias("n_col"), "verdict", "best_model")


# Requests: a third of the datasets come back unchanged, a third renamed in the file only, a third renamed altogether.
@query("history_lookup", f"""with {LOG_CTES},
    want as (select dataset_id, cast(n_row as bigint) as rows_, n_col as cols_, 'target' as target,
        case when substr(md5(dataset_id), 2, 1) < '5' then 'fp_' || substr(md5(dataset_id || '|target'), 1, 12) else 'fp_new' end as fingerprint,
        case when substr(md5(dataset_id), 2, 1) < 'a' then dataset_id else 'renamed' end as dataset from sig),
    ok as (select * from store where target_origin = 'manual'),
    r as (select w.dataset_id, f.fingerprint as f1, n.fingerprint as f2, s.fingerprint as f3 from want w
          left join ok f using (fingerprint) left join ok n on n.dataset = w.dataset
          left join ok s on s.target = w.target and s.rows_ = w.rows_ and s.cols_ = w.cols_)
    select dataset_id, case when f1 is not null then 'fingerprint' when f2 is not null then 'dataset' else 'shape' end as matched_by,
           coalesce(f1, f2, f3) as found_fingerprint from r where coalesce(f1, f2, f3) is not null""")
def history_lookup(spark, folder):
    store = materialise(history.latest(study_log(spark, folder)))  # read three times below
    digit = F.substring(F.md5(KEY), 2, 1)
    want = study_signals(spark, folder).select(
        KEY, "rows", "cols", F.lit("target").alias("target"),
        F.when(digit < "5", F.concat(F.lit("fp_"), F.substring(fv.md5_of(F.col(KEY), "target"), 1, 12))).otherwise("fp_new").alias("fingerprint"),
        F.when(digit < "a", F.col(KEY)).otherwise("renamed").alias("dataset"),
    )
    return history.lookup(want, store, origins=["manual"]).select(KEY, "matched_by", "found_fingerprint")


@query("similar_runs", f"""with {LOG_CTES},
    st as (select fingerprint, best_model, case when rows_ < 1000 then 's' when rows_ < 10000 then 'm' else 'l' end as bk, imbalance_ratio >= 3 as im, max_missing > 20 as gp,
             greatest(0.5, pow(0.5, greatest(floor((epoch(timestamp '2002-01-01') - epoch(seen_at)) / 86400), 0) / 90.0)) as w from store where verdict = '{th.RELIABLE}'),
    cur as (select dataset_id, case when n_row < 1000 then 's' when n_row < 10000 then 'm' else 'l' end as bk, imbalance_ratio >= 3 as im, max_missing > 20 as gp from sig),
    sc as (select dataset_id, fingerprint, best_model, ((c.bk = s.bk)::int + (c.im = s.im)::int + (c.gp = s.gp)::int) / 3.0 * w as similarity from cur c cross join st s),
    t as (select * from sc where similarity >= 0.5 qualify row_number() over (partition by dataset_id order by similarity desc, fingerprint) = 1)
    select dataset_id, round(similarity, 6) as similarity, fingerprint as found_fingerprint, best_model as hint_model from t""".replace("st as (select fingerprint", "rel as (select fingerprint").replace("cross join st s", "cross join rel s"))
def similar_runs(spark, folder):
    store = history.latest(study_log(spark, folder))
    out = history.similar_runs(study_signals(spark, folder), store, "2002-01-01 00:00:00")
    return out.select(KEY, F.round("similarity", 6).alias("similarity"), "found_fingerprint", "hint_model")


@query("size_bucket", f"with d as (select dataset_id, count(*) as n_row from ({EACH_DUCK}) group by all) select dataset_id, n_row, case when n_row < 1000 then 'small' when n_row < 10000 then 'medium' else 'large' end as bucket from d")
def size_bucket(spark, folder):
    sizes = spark.sql(EACH_SPARK, lineitem=read_table(spark, folder, "lineitem")).groupBy(KEY).agg(F.count(F.lit(1)).alias("n_row"))
    return sizes.withColumn("bucket", history.size_bucket(F.col("n_row")))


@query("history_record", f"""with {PLAN_CTES}, {_reflected(True)[len(SIGNAL_CTES) + 1:]},
    ps as (select dataset_id, string_agg(step, ',' order by pos) as steps from plan group by all)
    select dataset_id, verdict, status, case when verdict = '{th.RELIABLE}' then best_model end as reusable_model,
      case when verdict <> '{th.RELIABLE}' then best_model end as diagnostic_model, coalesce(case when verdict = '{th.RELIABLE}' then steps end, '') as successful_steps,
      verdict = '{th.INVALID}' or (status = 'needs_attention' and contains(best_model, 'Dummy')) as target_failed
    from ver join ps using (dataset_id)""")
def history_record(spark, folder):
    judged = study_verdicts(spark, folder).join(rules.steps_of(study_plan(spark, folder)), KEY).withColumn("target", F.lit("target"))
    return history.records(judged).select(
        KEY, "verdict", "status", "reusable_model", "diagnostic_model",
        F.concat_ws(",", "successful_steps").alias("successful_steps"), "target_failed",
    )


@query("failed_targets", f"""with {_reflected(True)}
    select dataset_id, 'target' as target from ver where (verdict = '{th.INVALID}' or (status = 'needs_attention' and contains(best_model, 'Dummy')))
      and substr(md5(dataset_id), 2, 1) >= '4'""")
def failed_targets(spark, folder):
    judged = materialise(study_verdicts(spark, folder)).withColumns({"target": F.lit("target"), "steps": F.lit(None).cast("array<string>")})
    fresh = history.records(judged).where("target_failed").select(KEY, "target")
    log = judged.where(F.substring(F.md5(KEY), 2, 1) < "4").select(KEY, "target")  # noted by earlier runs
    return history.failed_targets(log, fresh.unionByName(fresh))
