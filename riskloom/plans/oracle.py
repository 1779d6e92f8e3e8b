"""The registered queries in plain SQL, for a check by another engine."""

from __future__ import annotations

from riskloom.plans.catalog import (
    BOX_COLUMNS,
    SEARCH_GRIDS,
    NUMBERS,
    SEVERITY_STAND_INS,
    STAND_INS,
)
from riskloom.operators.training import LGD_MODELS, PD_MODELS
from riskloom.sources.tables import RAW_COLUMNS


def _hash(seed: int, digits: int = 8) -> str:
    return f"cast(('0x' || substr(md5(concat(cast(loan_id as varchar), '{seed}')), 1, {digits})) as bigint)"


BASE = f"""
with l as (
  select l_orderkey, max(l_extendedprice) as max_bal_owed, count(*) as num_inq,
         round(100 * avg(l_discount), 6) as interest_rate,
         sum(case when l_returnflag = 'R' then 1 else 0 end) as n_returned
  from lineitem group by l_orderkey),
raw as (
  select o_orderkey as loan_id, o_totalprice as funded_amnt, l.max_bal_owed,
         cast(l.num_inq as bigint) as num_inq, l.interest_rate,
         c_acctbal as bal_to_cred_lim, o_orderpriority as emp_length,
         c_mktsegment as purpose, c_name as emp_title,
         cast(l.n_returned as bigint) as princ_rec,
         cast(case when 10 * l.n_returned >= 6 * l.num_inq then 1 else 0 end as integer) as y
  from orders left join customer on c_custkey = o_custkey
       left join l on l_orderkey = o_orderkey),
filled as (
  select loan_id, funded_amnt, coalesce(max_bal_owed, 0) as max_bal_owed,
         coalesce(num_inq, 0) as num_inq, interest_rate, coalesce(bal_to_cred_lim, 0) as bal_to_cred_lim,
         emp_length, purpose, y as PD,
         100 * coalesce(max_bal_owed, 0) / nullif(funded_amnt, 0) as LGD,
         funded_amnt as EAD
  from raw),
clean as (select * from filled where LGD < 300),
hashed as (select *, {_hash(42)} as h from clean),
scored as (
  select *, h % 700 + 300 * PD as k, cast(h % 700 + 300 * PD as double) / 1000 as p,
         case when h % 700 + 300 * PD >= 100 then 1 else 0 end as flag
  from hashed),
lossy as (
  select *, p * (greatest(cast(0 as double), least(cast(100 as double), LGD)) / 100) * EAD as el from scored)
"""

CELLS = """
, cells as (
  select count(*) filter (where PD = 0 and flag = 0) as tn,
         count(*) filter (where PD = 0 and flag = 1) as fp,
         count(*) filter (where PD = 1 and flag = 0) as fn,
         count(*) filter (where PD = 1 and flag = 1) as tp from scored)
, rates as (
  select *, coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as p1,
         coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as r1,
         coalesce(cast(tn as double) / nullif(tn + fn, 0), 0) as p0,
         coalesce(cast(tn as double) / nullif(tn + fp, 0), 0) as r0,
         cast(tp + tn as double) / (tp + tn + fp + fn) as acc from cells)
, figures as (
  select *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) as f1,
         coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) as f0 from rates)
"""

SWEEP = """
, t as (select unnest([0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50]::double[]) as threshold)
, tc as (
  select threshold, count(*) filter (where PD = 1 and p >= threshold) as tp,
         count(*) filter (where PD = 0 and p >= threshold) as fp,
         count(*) filter (where PD = 1 and p < threshold) as fn
  from scored, t group by threshold)
, tr as (
  select threshold, coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as pr,
         coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as re from tc)
, sweep as (
  select threshold, round_even(pr, 3) as precision, round_even(re, 3) as recall,
         round_even(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 3) as f1 from tr)
"""

ROC = """
, g as (
  select k, count(*) filter (where PD = 1) as pos, count(*) filter (where PD = 0) as neg
  from scored group by k)
, c as (
  select k, sum(pos) over (order by k desc) as tp, sum(neg) over (order by k desc) as fp,
         sum(pos) over () as n1, sum(neg) over () as n0 from g)
, curve as (
  select cast(k as double) / 1000 as threshold, cast(fp as double) / n0 as fpr,
         cast(tp as double) / n1 as tpr from c
  union all select null, 0, 0)
"""

SEVERITY = ", severity as (" + " union all ".join(
    f"select loan_id, '{m}' as model, LGD, LGD + cast(h % {w} - {w // 2} as double) / 4 as lgd_hat from hashed"
    for m, w in SEVERITY_STAND_INS.items()
) + ")" + """
, lgd_board as (
  select model, avg(abs(LGD - lgd_hat)) as mae, sqrt(avg((LGD - lgd_hat) * (LGD - lgd_hat))) as rmse,
         1 - avg((LGD - lgd_hat) * (LGD - lgd_hat)) / var_pop(LGD) as r2
  from severity group by model)
, lgd_rounded as (select model, round(mae, 6) as mae, round(rmse, 6) as rmse, round(r2, 6) as r2 from lgd_board)
"""

BOARD = ", ms as (" + " union all ".join(
    f"select '{m}' as model, PD, {_hash(seed)} % {1000 - w} + {w} * PD as k from clean"
    for m, (w, seed) in STAND_INS.items()
) + ")" + """
, mg as (select model, k, sum(PD) as pos, count(*) - sum(PD) as neg from ms group by model, k)
, mc as (select *, sum(neg) over (partition by model order by k) - neg as below from mg)
, areas as (
  select model, cast(sum(pos * (below + cast(neg as double) / 2)) as double) / (sum(pos) * sum(neg)) as roc_auc
  from mc group by model)
, mcells as (
  select model, count(*) filter (where PD = 1 and k >= 500) as tp,
         count(*) filter (where PD = 0 and k >= 500) as fp,
         count(*) filter (where PD = 1 and k < 500) as fn,
         count(*) filter (where PD = 0 and k < 500) as tn from ms group by model)
, mrates as (
  select model, cast(tp + tn as double) / (tp + tn + fp + fn) as accuracy,
         coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as precision,
         coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as recall from mcells)
, board as (
  select model, round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall,
         round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) as f1,
         round(roc_auc, 6) as roc_auc
  from mrates join areas using (model))
"""

CLEAN_COLUMNS = (
    "loan_id, funded_amnt, max_bal_owed, num_inq, interest_rate, bal_to_cred_lim, "
    "emp_length, purpose, PD, round(LGD, 6) as LGD, EAD"
)

# The values of the two text columns without the first one.
LEVELS = {
    "emp_length": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "purpose": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}

ONE_HOT = (
    "select loan_id, funded_amnt, max_bal_owed, num_inq, interest_rate, bal_to_cred_lim, PD, "
    "round(LGD, 6) as LGD, EAD, "
    + ", ".join(
        f"cast(case when {c} = '{v}' then 1 else 0 end as {{kind}}) as \"{c}_{v}\"" for c, vs in LEVELS.items() for v in vs
    )
    + " from clean"
)


def _union(rows) -> str:
    return " union all ".join(rows)


def _quartiles(c: str, where: str = "true") -> str:
    return (
        f"(select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as med, "
        f"quantile_cont({c}, 0.75) as q3 from clean where {where})"
    )


def _iqr_column(c: str) -> str:
    return (
        f"round(case when {c} < q_{c}.q1 - 1.5 * (q_{c}.q3 - q_{c}.q1) then q_{c}.q1 "
        f"when {c} > q_{c}.q3 + 1.5 * (q_{c}.q3 - q_{c}.q1) then q_{c}.q3 "
        f"else cast({c} as double) end, 6) as {c}"
    )


DUMMIES = [f"{c}_{v}" for c, vs in LEVELS.items() for v in vs]
RAW_NUMBERS = [c for c in RAW_COLUMNS if c not in ("emp_length", "purpose", "emp_title")]
TYPE_NAMES = (
    "case column_type when 'DOUBLE' then 'double' when 'BIGINT' then 'bigint' "
    "when 'INTEGER' then 'int' else 'string' end"
)
CLEAN_NAMES = [
    "loan_id", "funded_amnt", "max_bal_owed", "num_inq", "interest_rate", "bal_to_cred_lim",
    "emp_length", "purpose", "PD", "LGD", "EAD",
]


def _described() -> str:
    """Name, type and position of the cleaned columns."""
    names = " union all ".join(
        f"select cast({i} as integer) as position, '{c}' as \"column\", typeof({c}) as column_type "
        f"from (select {c} from clean limit 1)"
        for i, c in enumerate(CLEAN_NAMES)
    )
    return f", described as ({names})"


KIND = (
    "case when \"column\" in ('PD', 'LGD', 'EAD') then 'target' "
    "when column_type = 'VARCHAR' then 'text' else 'numeric' end"
)


def _models(names: list[str]) -> str:
    return ", models as (select unnest([" + ", ".join(f"'{n}'" for n in names) + "]) as model)"


def _tree_splits(label: str, rows: str, columns: str) -> str:
    """Best cut of all rows, then of the rows on either side of it: running totals over the values."""
    numbers = ["funded_amnt", "max_bal_owed", "num_inq", "interest_rate", "bal_to_cred_lim"]
    cells = _union(
        f"select loan_id, {i} as feature, '{c}' as name, cast({'coalesce(interest_rate, 0)' if c == 'interest_rate' else c} as double) as v, "
        f"cast({label} as double) as y from clean where {rows}"
        for i, c in enumerate(numbers)
    )

    def level(k: int, source: str) -> str:
        return f"""
, v{k} as (select node, feature, name, v, count(*) as n, sum(y) as s from {source} group by all)
, r{k} as (
  select node, feature, name, (v + lead(v) over w) / 2 as threshold, sum(n) over w as n_left, sum(s) over w as s_left,
         sum(n) over (partition by node, feature) as n, sum(s) over (partition by node, feature) as s
  from v{k} window w as (partition by node, feature order by v))
, g{k} as (
  select *, s_left * s_left / n_left + (s - s_left) * (s - s_left) / (n - n_left) - s * s / n as gain
  from r{k} where threshold is not null)
, b{k} as (
  select * from (select *, row_number() over (partition by node order by gain desc, feature, threshold) as place from g{k}
                 where gain > 1e-9 * greatest(1.0, s * s / n)) where place = 1)"""

    return BASE + f"""
, cells as ({cells})
, c0 as (select *, 0 as node from cells)""" + level(0, "c0") + """
, sides as (
  select loan_id, case when cells.v <= b0.threshold then 1 else 2 end as node from cells join b0 using (feature))
, c1 as (select cells.*, node from cells join sides using (loan_id))""" + level(1, "c1") + f"""
, found as (select * from b0 union all select * from b1)
select case node when 0 then 'root' when 1 then 'left' else 'right' end as place, name as feature,
       round(threshold, 6) as threshold, cast(n as bigint) as n, cast(n_left as bigint) as n_left, {columns} from found"""


def _candidates(kind: str) -> str:
    rows = []
    for name, grid in SEARCH_GRIDS[kind].items():
        size = 1
        for values in grid.values():
            size *= len(values)
        rows.append(
            f"select '{name}' as model, cast({size} as integer) as candidates, "
            f"cast({len(grid)} as integer) as dimensions, true as has_score"
        )
    return _union(rows)


def _split_cut(share: str) -> str:
    return f"ceil(cast({share} as double) * n)"


ORACLE: dict[str, str] = {
    # Sources and joins
    "csv_clean_nulls": BASE + """
select loan_id, case when purpose = 'BUILDING' then null else emp_length end as emp_length,
       interest_rate, num_inq from raw""",
    "csv_round_trip": BASE + ONE_HOT.format(kind="bigint").replace(" PD,", " cast(PD as bigint) as PD,"),
    "csv_quoted_text": BASE + """
select loan_id, '  say "' || emp_length || '", now ' as note, '"' || purpose || '"' as quoted,
       9223372036854775807 - loan_id as wide, '9223372036854775808' || cast(loan_id as varchar) as wider from raw""",
    "join_by_row_position": BASE + "select loan_id, funded_amnt, y from raw",
    "join_features_target": """
select coalesce(o_orderkey, l_orderkey) as loan_id, o_totalprice as funded_amnt, y
from orders full outer join (
  select l_orderkey, case when 10 * count(*) filter (where l_returnflag = 'R') >= 6 * count(*) then 1 else 0 end as y
  from lineitem group by l_orderkey) on o_orderkey = l_orderkey""",
    "join_ead_lookup": BASE + "select loan_id, PD, EAD from hashed where h % 5 = 0",
    "metadata_json": BASE + CELLS + """
select cast(json_object('pd_model', 'stand-in', 'dataset', 'loans', 'pd_cv_auc', null,
    'pd_best_params', json_object('max_depth', '8', 'learning_rate', '0.1'),
    'pd_threshold', cast(0.1 as double), 'pd_test_precision', round_even(p1, 3),
    'pd_test_recall', round_even(r1, 3),
    'expected_loss_pct', round_even((select sum(el) / sum(EAD) from lossy), 4),
    'positive_class', 1, 'positive_label', 'default') as varchar) as document
from figures""",
    # Projections and filters
    "drop_leakage": BASE + "select " + ", ".join(c for c in RAW_COLUMNS if c != "princ_rec") + " from raw",
    "drop_high_cardinality": BASE + "select " + ", ".join(c for c in RAW_COLUMNS if c != "emp_title") + " from raw",
    "rename_target": BASE + "select loan_id, y as PD from raw",
    "fill_zero": BASE + """
select loan_id, coalesce(max_bal_owed, 0) as max_bal_owed, coalesce(num_inq, 0) as num_inq, interest_rate,
       coalesce(bal_to_cred_lim, 0) as bal_to_cred_lim from raw""",
    "derive_lgd": BASE + """
select loan_id, max_bal_owed, funded_amnt, round(100 * max_bal_owed / nullif(funded_amnt, 0), 6) as LGD from raw""",
    "derive_ead": BASE + "select loan_id, funded_amnt, funded_amnt as EAD from raw",
    "filter_lgd": BASE + "select loan_id, round(LGD, 6) as LGD from filled where LGD < 300",
    "cleaned_table": BASE + f"select {CLEAN_COLUMNS} from clean",
    "columns_by_kind": BASE + _described() + ", n as (" + _union(
        f"select '{c}' as \"column\", count({c}) as non_null from clean" for c in CLEAN_NAMES
    ) + f""") select position, "column", {TYPE_NAMES} as type, {KIND} as kind, non_null
from described join n using ("column")""",
    "feature_label_select": BASE + """
select loan_id, PD as label, funded_amnt, max_bal_owed, num_inq, interest_rate, bal_to_cred_lim,
       emp_length, purpose from clean""",
    "defaulted_only": BASE + f"select {CLEAN_COLUMNS} from clean where PD = 1",
    "class_subset_counts": BASE + """
select case when y = 1 then 'Default' else 'No Default' end as class, count(*) as count,
       round(100 * cast(count(*) as double) / (select count(*) from raw), 2) as pct from raw group by y""",
    "flag_threshold": BASE + "select loan_id, p, flag from scored",
    "preview": BASE + f"select {CLEAN_COLUMNS} from clean order by loan_id limit 5",
    # Profiling
    "numeric_profile": BASE + _union(
        f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 4) as mean, "
        f"round(stddev_samp({c}), 4) as std, round(cast(min({c}) as double), 4) as min, "
        f"round(quantile_cont(cast({c} as double), 0.25), 4) as q25, "
        f"round(quantile_cont(cast({c} as double), 0.5), 4) as q50, "
        f"round(quantile_cont(cast({c} as double), 0.75), 4) as q75, "
        f"round(cast(max({c}) as double), 4) as max from raw"
        for c in RAW_NUMBERS
    ),
    "value_counts": BASE + """
select emp_length as "value", count(*) as count from raw where emp_length is not null group by emp_length""",
    "class_value_counts": BASE + 'select PD as "value", count(*) as count from clean group by PD',
    "imbalance": BASE + """
select count(*) filter (where y = 1) as positives, count(*) filter (where y = 0) as negatives,
       round(100 * (cast(count(*) filter (where y = 1) as double) / nullif(count(*) filter (where y = 0), 0)), 6)
         as imbalance_ratio_pct,
       round(avg(y), 6) as default_rate from raw""",
    "imbalance_by_column": BASE + _union(
        f"select '{c}' as \"column\", round(100 * (cast(count({c}) filter (where y = 1) as double) "
        f"/ nullif(count({c}) filter (where y = 0), 0)), 6) as imbalance_ratio_pct from raw"
        for c in RAW_COLUMNS
    ),
    "null_counts": BASE + "select * from (" + _union(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as nulls from raw" for c in RAW_COLUMNS
    ) + ') order by nulls desc, "column" limit 15',
    "null_rates": BASE + "select * from (" + _union(
        f"select '{c}' as \"column\", round(cast(count(*) filter (where {c} is null) as double) / count(*), 6) "
        f"as null_rate from raw"
        for c in RAW_COLUMNS
    ) + ') order by null_rate desc, "column" limit 5',
    "distinct_counts": BASE + _union(
        f"select '{c}' as \"column\", count(distinct {c}) as \"distinct\" from raw"
        for c in ("emp_length", "purpose", "emp_title")
    ),
    "correlation_matrix": BASE + _union(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from clean" for a in NUMBERS for b in NUMBERS
    ),
    "box_summary_by_class": BASE + _union(
        f"""select cast({k} as integer) as PD, '{c}' as "column", round(q1, 6) as q1, round(med, 6) as median,
        round(q3, 6) as q3,
        round(cast(min({c}) filter (where {c} >= q1 - 1.5 * (q3 - q1) and {c} <= q3 + 1.5 * (q3 - q1)) as double), 6)
          as whisker_low,
        round(cast(max({c}) filter (where {c} >= q1 - 1.5 * (q3 - q1) and {c} <= q3 + 1.5 * (q3 - q1)) as double), 6)
          as whisker_high,
        count(*) filter (where {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outliers
        from clean, {_quartiles(c, f'PD = {k}')} as q where PD = {k} group by q1, med, q3"""
        for c in BOX_COLUMNS
        for k in (0, 1)
    ),
    "five_number_by_class": BASE + """
, f as (
  select PD, min(interest_rate) as mn, quantile_cont(interest_rate, 0.25) as q1,
         quantile_cont(interest_rate, 0.5) as md, quantile_cont(interest_rate, 0.75) as q3,
         max(interest_rate) as mx from clean group by PD)
""" + _union(
        f"select PD, '{n}' as stat, round({c}, 6) as \"value\" from f"
        for n, c in (("Min", "mn"), ("Q1", "q1"), ("Median", "md"), ("Q3", "q3"), ("Max", "mx"))
    ),
    "quartiles": BASE + _union(
        f"select '{c}' as \"column\", round(q1, 6) as q1, round(q3, 6) as q3 from {_quartiles(f'cast({c} as double)')}"
        for c in BOX_COLUMNS
    ),
    "table_info": BASE + _described() + ", n as (" + _union(
        f"select '{c}' as \"column\", count({c}) as non_null from clean" for c in CLEAN_NAMES
    ) + f""") select position, "column", non_null, {TYPE_NAMES} as type, {KIND} as kind
from described join n using ("column")""",
    "shape": BASE + f'select count(*) as rows, cast({len(CLEAN_NAMES)} as bigint) as columns from clean',
    "outlier_counts": BASE + _union(
        f"select '{c}' as \"column\", round(q1, 6) as q1, round(q3, 6) as q3, "
        f"count(*) filter (where {c} < q1 - 1.5 * (q3 - q1)) as below, "
        f"count(*) filter (where {c} > q3 + 1.5 * (q3 - q1)) as above "
        f"from clean, {_quartiles(f'cast({c} as double)')} as q group by q1, q3"
        for c in BOX_COLUMNS
    ),
    "headline": BASE + """
select count(*) as total_loans, cast(7 as bigint) as features, round(avg(PD), 6) as default_rate from clean""",
    # Transforms
    "iqr_treatment": BASE + "select loan_id, " + ", ".join(_iqr_column(c) for c in NUMBERS) + " from clean, "
    + ", ".join(f"{_quartiles(f'cast({c} as double)')} as q_{c}" for c in NUMBERS),
    "one_hot": BASE + ONE_HOT.format(kind="integer"),
    "one_hot_sparse": BASE + """
, cells as (
  select loan_id, unnest([0, 1, 2]) as c, unnest([emp_title, purpose, emp_length]) as v from raw)
, levels as (
  select c, v, row_number() over (partition by c order by v) - 1 as r from cells where v is not null group by c, v)
, sizes as (select c, count(*) - 1 as n from levels group by c)
, offsets as (select c, coalesce(sum(n) over (order by c rows between unbounded preceding and 1 preceding), 0) as first, sum(n) over () as dims from sizes)
, placed as (
  select loan_id, list(cast(first + r - 1 as bigint) order by first + r) filter (where r > 0) as spots
  from cells left join levels using (c, v) left join offsets using (c) group by loan_id)
select loan_id, '(' || cast((select max(dims) from offsets) as bigint) || ',[' || coalesce(array_to_string(spots, ','), '') || '],['
       || coalesce(rtrim(repeat('1.0,', len(spots)), ','), '') || '])' as dummies from placed""",
    "standard_scale": BASE + ", enc as (" + ONE_HOT.format(kind="integer") + f""")
, e as (select *, {_hash(42)} % 5 as fifth from enc)
, m as (select """ + ", ".join(
        f"avg(\"{c}\") as m{i}, stddev_pop(\"{c}\") as s{i}" for i, c in enumerate([*NUMBERS, *DUMMIES])
    ) + " from e where fifth <> 0) select loan_id, " + ", ".join(
        f"round((\"{c}\" - m{i}) / case when s{i} = 0 then 1 else s{i} end, 6) as \"{c}\""
        for i, c in enumerate([*NUMBERS, *DUMMIES])
    ) + " from e, m where fifth = 0",
    "train_test_split": BASE + "select loan_id, cast(case when h % 5 = 0 then 1 else 0 end as integer) as test from hashed",
    "exact_split": BASE + f"""
, r as (select loan_id, PD, row_number() over (order by {_hash(42, 13)}, loan_id) as i, count(*) over () as n from clean)
select loan_id, PD from r where i <= {_split_cut('0.2')}""",
    "exact_stratified_split": BASE + f"""
, r as (
  select loan_id, PD, row_number() over (partition by PD order by {_hash(42, 13)}, loan_id) as i,
         count(*) over (partition by PD) as n from clean)
select loan_id, PD from r where i <= {_split_cut('0.2')}""",
    "stratified_folds": BASE + f"""
, r as (
  select loan_id, PD, row_number() over (partition by PD order by {_hash(42, 13)}, loan_id) as i,
         count(*) over (partition by PD) as n from clean)
select loan_id, PD, cast(case when i <= n // 2 + n % 2 then 0 else 1 end as integer) as fold from r""",
    "plain_folds": BASE + f"""
, r as (
  select loan_id, row_number() over (order by {_hash(42, 13)}, loan_id) as i, count(*) over () as n
  from clean where PD = 1)
select loan_id, cast(case when i <= n // 2 + n % 2 then 0 else 1 end as integer) as fold from r""",
    # Metrics
    "confusion": BASE + CELLS + "select tn, fp, fn, tp from cells",
    "binary_metrics": BASE + CELLS + """
select round(acc, 6) as accuracy, round(p1, 6) as precision, round(r1, 6) as recall, round(f1, 6) as f1 from figures""",
    "classification_report": BASE + CELLS + """
, rep as (
  select 'No Default' as "row", p0 as precision, r0 as recall, f0 as f1, tn + fp as support from figures
  union all select 'Defaulter', p1, r1, f1, tp + fn from figures
  union all select 'accuracy', null, null, acc, tp + tn + fp + fn from figures
  union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tp + tn + fp + fn from figures
  union all select 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / (tp + tn + fp + fn),
    (r0 * (tn + fp) + r1 * (tp + fn)) / (tp + tn + fp + fn),
    (f0 * (tn + fp) + f1 * (tp + fn)) / (tp + tn + fp + fn), tp + tn + fp + fn from figures)
select "row", round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from rep""",
    "flagged_vs_actual": BASE + """
select count(*) filter (where flag = 1) as flagged, count(*) filter (where PD = 1) as actual,
       round(cast(count(*) filter (where flag = 1) as double) / nullif(count(*) filter (where PD = 1), 0), 6)
         as flagged_to_actual_ratio from scored""",
    "roc_auc": BASE + ROC + """
, b as (select *, sum(neg) over (order by k) - neg as below from g)
select round(cast(sum(pos * (below + cast(neg as double) / 2)) as double) / (sum(pos) * sum(neg)), 9) as roc_auc from b""",
    "roc_curve": BASE + ROC + "select threshold, round(fpr, 6) as fpr, round(tpr, 6) as tpr from curve",
    "roc_on_grid": BASE + ROC + """
, slots as (select cast(ceil(round(fpr * 49, 9)) as integer) as i, max(tpr) as tpr from curve group by 1)
, grid as (select cast(unnest(range(50)) as integer) as i)
select round(cast(i as double) / 49, 6) as fpr, round(max(tpr) over (order by i), 6) as tpr,
       round(cast(i as double) / 49, 6) as random
from grid left join slots using (i)""",
    "threshold_counts": BASE + SWEEP + "select threshold, tp, fp, fn from tc",
    "threshold_sweep": BASE + SWEEP + "select * from sweep",
    "operating_point": BASE + SWEEP + "select * from sweep where threshold = cast(0.1 as double)",
    "choose_threshold": BASE + SWEEP + "select sweep.* from sweep join tr using (threshold) "
    "where re >= cast(0.95 as double) order by threshold desc limit 1",
    "regression_metrics": BASE + SEVERITY + "select mae, rmse, r2 from lgd_rounded where model = 'model_b'",
    "ols_single_feature": BASE + """
select round(regr_slope(LGD, max_bal_owed / 1000), 5) as slope,
       round(regr_intercept(LGD, max_bal_owed / 1000), 5) as intercept from clean""",
    # Leaderboards
    "leaderboard_sort": BASE + BOARD + "select * from board order by roc_auc desc, model",
    "lgd_leaderboard": BASE + SEVERITY + "select * from lgd_rounded order by mae, model",
    "best_row": BASE + SEVERITY + "select * from lgd_rounded order by mae, model limit 1",
    "filter_leaderboard": BASE + SEVERITY + "select * from lgd_rounded where mae < 5",
    "arg_best_model": BASE + BOARD + "select model, roc_auc from board order by roc_auc desc, model limit 1",
    "best_per_metric": BASE + SEVERITY + """
select 'r2' as measure, arg_max(model, r2) as best, max(r2) as "value" from lgd_rounded
union all select 'mae', arg_min(model, mae), min(mae) from lgd_rounded
union all select 'rmse', arg_min(model, rmse), min(rmse) from lgd_rounded""",
    "best_threshold_per_metric": BASE + SWEEP + _union(
        f"(select '{m}' as measure, threshold as best, {m} as \"value\" from sweep order by {m} desc, threshold limit 1)"
        for m in ("precision", "recall", "f1")
    ),
    # Expected loss
    "expected_loss_per_loan": BASE + "select loan_id, EAD, p, round(el, 6) as el from lossy",
    "expected_loss_summary": BASE + """
select round(sum(EAD), 2) as portfolio_value, round(sum(el), 2) as expected_loss,
       round(sum(el) / sum(EAD), 6) as expected_loss_pct, count(*) filter (where el is null) as unscored from lossy""",
    "expected_loss_formatted": BASE + """
select '$' || format('{:,.2f}', sum(EAD)) as portfolio_value, '$' || format('{:,.2f}', sum(el)) as expected_loss,
       format('{:.2f}', 100 * sum(el) / sum(EAD)) || '%' as expected_loss_pct from lossy""",
    "portfolio_composition": BASE + """
, s as (select sum(EAD) as v, sum(el) as l from lossy)
select 'Expected Loss' as part, round(l, 2) as amount, round(100 * (l / v), 2) as share_pct from s
union all select 'Safe Capital', round(v - l, 2), round(100 * ((v - l) / v), 2) from s""",
    "el_histogram": BASE + """
, b as (select min(el) as lo, max(el) as hi, avg(el) as mean, (max(el) - min(el)) / 40 as step from lossy)
, guess as (
  select el, lo, step, cast(least(39, floor((el - lo) / (hi - lo) * 40)) as integer) as g from lossy, b)
, placed as (
  select case when el < lo + g * step then g - 1
              when el >= lo + (g + 1) * step and g < 39 then g + 1 else g end as bin from guess)
, n as (select bin, count(*) as count from placed group by bin)
, grid as (select cast(unnest(range(40)) as integer) as bin)
select bin, round(lo + bin * step, 4) as low, round(case when bin = 39 then hi else lo + (bin + 1) * step end, 4) as high,
       coalesce(count, 0) as count, round(mean, 4) as mean
from grid left join n using (bin), b""",
    "top_risk_loans": BASE + """
select 'L-' || cast(loan_id as varchar) as loan, EAD as ead, round(el, 6) as expected_loss,
       round_even(el / EAD * 100, 1) as el_pct from lossy order by el desc, loan_id limit 10""",
    # Models: the first splits of the trees, and what can be decided without fitting
    "product_matrix": BASE + """
, numbers as (
  select loan_id, unnest(['ones', 'funded_amnt', 'max_bal_owed', 'num_inq', 'interest_rate', 'bal_to_cred_lim', 'LGD']) as c,
         unnest(range(7)) as i,
         unnest([cast(1 as double), cast(funded_amnt as double), cast(max_bal_owed as double), cast(num_inq as double),
                 coalesce(interest_rate, 0), cast(bal_to_cred_lim as double), LGD]) as v
  from clean where PD = 1)
, own as (select i, sum(v * v) as s from numbers group by i)
, pairs as (
  select a.c as a, b.c as b, a.i as i, b.i as j, sum(a.v * b.v) as s
  from numbers a join numbers b on a.loan_id = b.loan_id and a.i <= b.i group by all)
select a, b, round(pairs.s / nullif(sqrt(x.s * y.s), 0), 9) as share from pairs join own x using (i) join own y on y.i = j""",
    "tree_splits": _tree_splits("PD", "true", "cast(s as bigint) as defaults, cast(s_left as bigint) as defaults_left, round(gain, 6) as gain"),
    "severity_splits": _tree_splits("LGD", "PD = 1", "round(s / n, 4) as mean, round(s_left / n_left, 4) as mean_left"),
    "pd_baseline": BASE + _models(PD_MODELS) + """
select model, count(*) as loans, cast(sum(PD) as bigint) as defaults, true as in_range, true as classes,
       true as board_in_order from hashed, models where h % 5 = 0 group by model""",
    "pd_grid_search": _candidates("pd"),
    "pd_final": BASE + _models(PD_MODELS) + """
, t as (select count(*) as n, count(*) filter (where PD = 0) as n0, count(*) filter (where PD = 1) as n1
        from hashed where h % 5 = 0)
, r as (select 'No Default' as "row", n0 as support, n as loans from t union all select 'Defaulter', n1, n from t
        union all select 'accuracy', n, n from t union all select 'macro avg', n, n from t
        union all select 'weighted avg', n, n from t)
select model, "row", support, loans, true as area_in_range from models, r""",
    "lgd_baseline": BASE + _models(LGD_MODELS) + """
select model, count(*) as loans, true as errors_consistent, true as board_in_order
from hashed, models where h % 5 = 0 and PD = 1 group by model""",
    "lgd_grid_search": _candidates("lgd"),
    "lgd_final": BASE + _models(LGD_MODELS) + """
select model, count(*) as loans, true as errors_consistent, true as board_in_order
from hashed, models where h % 5 = 0 and PD = 1 group by model""",
    "score_portfolio": BASE + """
select loan_id, PD, round(LGD, 6) as LGD, EAD, true as p_in_range, true as has_severity, true as el_bounded
from hashed where h % 5 = 0""",
    "expected_loss_end_to_end": BASE + """
select round(sum(EAD), 2) as portfolio_value, cast(0 as bigint) as unscored, true as loss_is_the_sum,
       true as share_in_range from hashed where h % 5 = 0""",
    "run_metadata": BASE + """
select true as pd_model, true as lgd_model, strftime(current_date, '%Y-%m') as trained_on, 'loans' as dataset,
       cast(0.1 as double) as pd_threshold, round_even(sum(EAD), 2) as portfolio_value,
       cast(1 as integer) as positive_class, 'default' as positive_label, cast(null as bigint) as max_fit_rows,
       true as pd_cv_auc, true as pd_best_params, true as lgd_best_params, true as pd_test_precision,
       true as pd_test_recall, true as pd_test_f1, true as lgd_mae, true as lgd_rmse, true as expected_loss,
       true as expected_loss_pct, true as spark_version
from hashed where h % 5 = 0""",
    "model_round_trip": BASE + f"""
select loan_id, cast({len(PD_MODELS)} as integer) as equal_families from hashed where h % 5 = 0""",
}
