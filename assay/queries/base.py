"""Query registry, portable views and helpers for the check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assay.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a (spark, folder) -> DataFrame query with its check SQL, if one exists."""
    def keep(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECK_SQL[name] = check
        return fn
    return keep


# The same text runs in Spark and in DuckDB; each view plants a property the plain tables lack.
VIEWS = {
    "v_missing": """
        select l_orderkey, l_linenumber, l_quantity,
               case when l_orderkey % 4 = 0 then null else l_discount end as disc_q,
               case when l_orderkey % 2 = 0 then null else l_returnflag end as flag_h from {lineitem}""",
    "v_dups": """
        select * from {orders} union all select * from {orders} where o_orderkey % 20 = 0""",
    "v_leak": """
        select o_orderkey, o_orderstatus as target, lower(o_orderstatus) as copy_status,
               case o_orderstatus when 'F' then 10 when 'O' then 20 else 30 end as remap_status,
               o_orderpriority, o_totalprice from {orders}""",
    "v_nearconst": """
        select o_orderkey, case when o_orderkey % 50 = 0 then 1 else 0 end as near_c, 7 as const_c,
               o_totalprice from {orders}""",
    "v_corr": """
        select l_extendedprice as a, l_extendedprice * 2 + 1 as b, l_quantity as c, l_tax as d,
               cast(1 as double) as k,
               case when l_orderkey % 3 = 0 then null else l_extendedprice + l_quantity end as e
        from {lineitem}""",
    "v_dirty": """
        select o_orderkey,
               case when o_orderkey % 10 = 0 then ' ' else cast(o_custkey as string) end as dirty_num,
               case when o_orderkey % 7 = 0 then '12d' when o_orderkey % 7 = 1 then ' 1e3 '
                    when o_orderkey % 7 = 2 then '0x10' when o_orderkey % 7 = 3 then '1,000'
                    when o_orderkey % 7 = 4 then '-.5' else cast(o_custkey as string) end as odd_num
        from {orders}""",
    "v_outlier": """
        select l_orderkey, l_linenumber, l_quantity,
               case when l_orderkey % 10 = 0 then l_extendedprice * 100 else l_extendedprice end as price
        from {lineitem}""",
    "v_bool": """
        select o_orderkey, case when o_orderkey % 2 = 0 then 'yes' else 'no' end as yn,
               case when o_orderkey % 3 = 0 then ' T' else 'f ' end as tf,
               o_orderkey % 2 as zero_one, o_orderkey % 2 = 0 as flag, o_orderstatus from {orders}""",
    "v_sensitive": """
        select c_custkey, c_mktsegment as gender, c_nationkey as age_band, c_acctbal,
               case when md5(concat(c_custkey, '|p')) < '8' then 1 else 0 end as prediction from {customer}""",
    "v_tokens": """
        select o_orderkey,
               case o_orderkey % 6 when 0 then '?' when 1 then 'N/A' when 2 then '' when 3 then 'NULL'
                    when 4 then 'nan' else o_orderstatus end as status_tok,
               case when o_orderkey % 5 = 0 then cast('NaN' as double) else o_totalprice end as price_nan
        from {orders}""",
    "v_pred": """
        select o_orderkey as k, 'm1' as model, o_orderstatus as label,
               case when md5(concat(o_orderkey, '|m1')) < 'c' then o_orderstatus else 'F' end as prediction
        from {orders}
        union all
        select o_orderkey, 'm2', o_orderstatus,
               case when md5(concat(o_orderkey, '|m2')) < '8' then o_orderstatus else 'O' end from {orders}
        union all
        select o_orderkey, 'm3', o_orderstatus, 'X' from {orders}""",
    "v_regpred": """
        select l_orderkey, l_linenumber, 'per_unit' as model, l_extendedprice as label,
               1500.0 * l_quantity as prediction from {lineitem}
        union all
        select l_orderkey, l_linenumber, 'flat', l_extendedprice, cast(50000 as double) from {lineitem}""",
}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table or one of the views over them."""
    if name not in VIEWS:
        return read_table(spark, folder, name)
    text = VIEWS[name]
    used = {t: read_table(spark, folder, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duck(name: str) -> str:
    """The same table or view as DuckDB text for a FROM clause."""
    if name not in VIEWS:
        return name
    text = VIEWS[name].replace("as string)", "as varchar)")
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return f"({text})"


# Column families per table, in order, for the per-column check SQL.
COLUMNS = {
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:f l_extendedprice:f "
    "l_discount:f l_tax:f l_returnflag:t l_linestatus:t l_shipdate:d",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:t o_totalprice:f o_orderdate:d o_orderpriority:t",
    "customer": "c_custkey:n c_name:t c_nationkey:n c_acctbal:f c_mktsegment:t",
    "part": "p_partkey:n p_name:t p_brand:t p_type:t p_size:n p_retailprice:f",
    "supplier": "s_suppkey:n s_name:t s_nationkey:n s_acctbal:f",
    "nation": "n_nationkey:n n_name:t n_regionkey:n",
    "events": "event_id:n ts:d user_id:n event_type:t value:f props:t",
    "documents": "doc_id:n text:t lang:t source:t n_chars:n",
    "labels": "doc_id:n quality:n toxic:n",
    "pages": "page_id:n url:t html:t",
    "conversations": "conv_id:n turn:n role:t text:t",
    "v_missing": "l_orderkey:n l_linenumber:n l_quantity:f disc_q:f flag_h:t",
    "v_leak": "o_orderkey:n target:t copy_status:t remap_status:n o_orderpriority:t o_totalprice:f",
    "v_nearconst": "o_orderkey:n near_c:n const_c:n o_totalprice:f",
    "v_dirty": "o_orderkey:n dirty_num:t odd_num:t",
    "v_bool": "o_orderkey:n yn:t tf:t zero_one:n flag:b o_orderstatus:t",
    "v_outlier": "l_orderkey:n l_linenumber:n l_quantity:f price:f",
    "v_sensitive": "c_custkey:n gender:t age_band:n c_acctbal:f prediction:n",
}


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in COLUMNS[name].split()]


NUMBER_RE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)$"


def duck_number(c: str, family: str) -> str:
    """A column as a number in DuckDB, null where it is none."""
    if family == "t":
        return f"case when regexp_matches(trim({c}), '{NUMBER_RE}') then try_cast(trim({c}) as double) end"
    if family in ("d",):
        return "cast(null as double)"
    return f"cast({c} as double)"


def duck_stats(name: str, dataset: str | None = None) -> str:
    """Per-column statistics of a table as a union of one plain aggregate per column."""
    parts = []
    pairs = [("true", "false"), ("yes", "no"), ("y", "n"), ("t", "f")]
    for pos, (c, fam) in enumerate(columns_of(name)):
        x = duck_number(c, fam)
        words = " or ".join(
            f"(bool_and(lower(trim(cast({c} as varchar))) in ('{a}', '{b}')) and count(distinct lower(trim(cast({c} as varchar)))) = 2)"
            for a, b in pairs
        )
        distinct_numbers = f"count(distinct {x})" if fam == "t" else f"count(distinct {c})"
        numeric = (
            f"case when {distinct_numbers} between 1 and 20 and "
            f"avg(case when {x} is null then null when abs({x} - round_even({x}, 0)) <= 1e-6 then 1.0 else 0.0 end) >= 0.95 "
            "then 'ordinal' else 'continuous' end"
        )
        bool_rule = f"count(case when {x} in (0, 1) then 1 end) = count({c})"
        kind = f"case when count({c}) = 0 then 'all_missing' "
        if fam == "b":
            kind += "else 'boolean' end"
        elif fam == "d":
            kind += "else 'datetime' end"
        elif fam == "t":
            kind += (
                f"when {bool_rule} or {words} then 'boolean' "
                f"when count({x}) > 0.8 * count({c}) then {numeric} "
                f"when count(distinct {c}) <= 20 then 'categorical' else 'text' end"
            )
        else:
            kind += f"when {bool_rule} then 'boolean' else {numeric} end"
        whole = f"count(case when {x} % 1 = 0 then 1 end)"
        parts.append(
            f"select '{dataset or name}' as dataset_id, {pos} as pos, '{c}' as column_name, '{fam}' as fam, "
            f"count(*) as n_rows, count({c}) as n_present, count(distinct {c}) as n_unique, "
            f"{whole} as n_whole, min({x}) as min_num, max({x}) as max_num, {kind} as kind, "
            f"avg(case when {x} is null then null when abs({x} - round_even({x}, 0)) <= 1e-6 then 1.0 else 0.0 end) as int_share, "
            f"(select max(k) from (select count(*) as k from {duck(name)} group by {c})) as top_count "
            f"from {duck(name)}"
        )
    return " union all ".join(parts)
