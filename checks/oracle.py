"""Independent SQL for the registered queries, over the same given tables."""

from __future__ import annotations

import re

from vintara.sources import driver_tables as D


def _view(view: dict[str, str], source: str, where: str = "") -> str:
    fields = ", ".join(f"{text} as {name}" for name, text in view.items())
    return f"select {fields} from {source}" + (f" where {where}" if where else "")


_NULLS = "('', ' ', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
_NUM = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def _num(c: str) -> str:
    return f"(case when {c} in {_NULLS} then null when regexp_matches(trim({c}), {_NUM}) then try_cast(trim({c}) as double) end)"


def _int(c: str, kind: str, sentinel: int | None = None) -> str:
    value = _num(c) if sentinel is None else f"nullif({_num(c)}, {sentinel})"
    return f"try_cast(case when {value} = floor({value}) then {value} end as {kind})"


def _f4(c: str, sentinel: int | None = None) -> str:
    value = _num(c) if sentinel is None else f"nullif({_num(c)}, {sentinel})"
    return f"round(cast(cast({value} as float) as double), 4)"


def _month(c: str) -> str:
    ok = f"regexp_matches(trim({c}), '^[0-9]{{6}}$')"
    return f"(case when {ok} then cast(try_strptime(trim({c}) || '01', '%Y%m%d') as date) end)"


def _code(c: str) -> str:
    drop = "('')" if c == "LOAN_PURPOSE" else "('', '9', '99')"
    return f"(case when {c} in {_NULLS} or trim({c}) in {drop} then null else trim({c}) end)"


_CODES = (
    "FIRST_TIME_HOMEBUYER_FLAG", "MSA", "OCC_STATUS", "CHANNEL", "PPM_FLAG", "PRODUCT_TYPE", "PROPERTY_STATE",
    "PROPERTY_TYPE", "POSTAL_CODE", "LOAN_SEQUENCE_NUMBER", "LOAN_PURPOSE", "NUMBER_OF_BORROWERS", "SELLER_NAME",
    "SERVICER_NAME", "SUPER_CONFORMING_FLAG", "PRE_HARP_LOAN_SEQUENCE_NUMBER", "PROGRAM_INDICATOR", "HARP_INDICATOR",
    "PROPERTY_VALUATION_METHOD", "IO_INDICATOR", "MI_CANCELLATION_INDICATOR",
)
_SVCG_DOUBLES = (
    "CURRENT_ACTUAL_UPB", "CURRENT_INTEREST_RATE", "CURRENT_DEFERRED_UPB", "MI_RECOVERIES", "NET_SALES_PROCEEDS",
    "NON_MI_RECOVERIES", "EXPENSES", "LEGAL_COSTS", "MAINTENANCE_PRESERVATION_COSTS", "TAXES_INSURANCE",
    "MISCELLANEOUS_EXPENSES", "ACTUAL_LOSS_CALCULATION", "MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB",
    "PRINCIPAL_FORGIVENESS_UPB", "ORIGINAL_LIST_PRICE", "CURRENT_LIST_PRICE", "VALUE_OF_DELINQUENT_ACCRUED_INTEREST",
    "CURRENT_NON_INTEREST_BEARING_UPB", "CURRENT_UPB_SCHEDULED",
)
_SVCG_TEXT = (
    "LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD", "REPURCHASE_MAKE_WHOLE_PROCEEDS_FLAG", "MODIFICATION_FLAG",
    "ZERO_BALANCE_CODE", "ZERO_BALANCE_EFFECTIVE_DATE", "DDLPI", "ORIGINAL_LIST_START_DATE", "CURRENT_LIST_START_DATE",
    "BORROWER_ASSISTANCE_PLAN",
)


def _flags(status: str, code: str) -> str:
    serious = f"coalesce(try_cast({status} as double) >= 3, false) or coalesce({status} in ('XX', 'RA'), false)"
    liquidated = f"coalesce(trim({code}) in ('02', '03', '04', '05', '06', '09'), false)"
    return (
        f"({serious}) as IS_SERIOUSLY_DELINQUENT, coalesce(trim({code}) <> '', false) as IS_ZERO_BALANCE, "
        f"coalesce(trim({code}) = '01', false) as IS_PREPAID, {liquidated} as IS_LIQUIDATED, "
        f"({serious} or {liquidated}) as IS_DEFAULTED"
    )


def _clip(x: str, lo: str, hi: str) -> str:
    return f"(case when {x} is null then null when {x} < {lo} then cast({lo} as double) when {x} > {hi} then cast({hi} as double) else {x} end)"


_DLQ = "cast(case CURRENT_LOAN_DELINQUENCY_STATUS when 'XX' then 999 when 'RA' then 998 else coalesce(cast(trunc(try_cast(CURRENT_LOAN_DELINQUENCY_STATUS as double)) as int), 0) end as smallint)"
_AGE = "coalesce(LOAN_AGE, cast(round_even(date_diff('day', ORIGINATION_DATE, REPORTING_DATE) / cast(30.44 as double), 0) as int))"
_FICO_BAND = "case when coalesce(CREDIT_SCORE, 650) <= 0 then null when coalesce(CREDIT_SCORE, 650) <= 620 then '<620' when coalesce(CREDIT_SCORE, 650) <= 660 then '620-659' when coalesce(CREDIT_SCORE, 650) <= 700 then '660-699' when coalesce(CREDIT_SCORE, 650) <= 740 then '700-739' when coalesce(CREDIT_SCORE, 650) <= 800 then '740-799' when coalesce(CREDIT_SCORE, 650) <= 900 then '800+' end"
_LTV_BAND = "case when coalesce(ORIGINAL_LTV, 80) <= 0 then null when coalesce(ORIGINAL_LTV, 80) <= 60 then '<60' when coalesce(ORIGINAL_LTV, 80) <= 70 then '60-69' when coalesce(ORIGINAL_LTV, 80) <= 80 then '70-79' when coalesce(ORIGINAL_LTV, 80) <= 90 then '80-89' when coalesce(ORIGINAL_LTV, 80) <= 100 then '90-99' when coalesce(ORIGINAL_LTV, 80) <= 200 then '100+' end"
_BAND_ORDER = "case {0} when '<620' then 0 when '620-659' then 1 when '660-699' then 2 when '700-739' then 3 when '740-799' then 4 when '800+' then 5 when '<60' then 0 when '60-69' then 1 when '70-79' then 2 when '80-89' then 3 when '90-99' then 4 when '100+' then 5 end"
_HPD = "1.0 / (1.0 + exp(-(cast(-4.5 as double) + (700 - coalesce(CREDIT_SCORE, 700)) * cast(0.01 as double) + (coalesce(ORIGINAL_LTV, 80) - 80) * cast(0.03 as double) + (coalesce(ORIGINAL_DTI, 35) - 35) * cast(0.01 as double) + ({u} - 5) * cast(0.15 as double))))"


def _hlgd(h: str) -> str:
    growth = f"least(greatest(1 + {h} / 100.0, cast(0.5 as double)), cast(1.5 as double))"
    inner = f"((coalesce(ORIGINAL_LTV, 80) / ({growth})) / 100.0 - cast(0.85 as double))"
    return f"least(greatest(least(greatest({inner}, cast(0 as double)), cast(0.8 as double)) + cast(0.15 as double), cast(0.05 as double)), cast(0.9 as double))"


def _stage(pd: str, dlq: str) -> str:
    return f"case when {pd} > cast(0.10 as double) or coalesce({dlq}, 0) >= 3 then 3 when {pd} > cast(0.01 as double) or coalesce({dlq}, 0) >= 1 then 2 else 1 end"


def _cents(x: str) -> str:
    """Half-up rounding of the decimal value a double prints as (2202.615 -> 2202.62)."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 14)), 2) as double)"


def _last(c: str, where: str = "") -> str:
    return f"arg_max({c}, rn) filter (where {c} is not null{' and ' + where if where else ''})"


def _pd_sql(age: int, horizon: int) -> str:
    return f"""
select s.LOAN_SEQUENCE_NUMBER, s.VINTAGE_YEAR, cast(coalesce(f.hit, false) as int) as PD_TARGET, s.CREDIT_SCORE, s.ORIGINAL_LTV,
       s.ORIGINAL_CLTV, s.ORIGINAL_DTI, s.ORIGINAL_UPB, s.ORIGINAL_INTEREST_RATE, s.ORIGINAL_LOAN_TERM, s.OCC_STATUS,
       s.LOAN_PURPOSE, s.PROPERTY_TYPE, s.PROPERTY_STATE, s.PRODUCT_TYPE, s.CHANNEL, s.FIRST_TIME_HOMEBUYER_FLAG, s.MI_PCT,
       s.ORIGINAL_INTEREST_RATE - m.mortgage_rate_30y as RATE_SPREAD, {age} as LOAN_AGE_AT_OBS, s.CURRENT_ACTUAL_UPB,
       s.CURRENT_LOAN_DELINQUENCY_STATUS, s.DLQ_STATUS_INT, m.unemployment_rate, m.hpi_yoy_chg, m.mortgage_rate_30y,
       m.financial_stress_idx, m.unrate_chg_mom
from (select *, row_number() over (partition by LOAN_SEQUENCE_NUMBER order by rn) as k from panel where LOAN_AGE_MONTHS = {age}) s
left join (select LOAN_SEQUENCE_NUMBER, bool_or(IS_DEFAULTED) as hit from panel
           where LOAN_AGE_MONTHS > {age} and LOAN_AGE_MONTHS <= {age + horizon} group by 1) f
  on f.LOAN_SEQUENCE_NUMBER = s.LOAN_SEQUENCE_NUMBER
left join macro m on m.date = date_trunc('month', s.REPORTING_DATE)
where s.k = 1 and not s.IS_ZERO_BALANCE"""


_SEGMENT_COLUMNS = {
    "state": "PROPERTY_STATE", "fico_band": _FICO_BAND, "ltv_band": _LTV_BAND,
    "vintage": "cast(VINTAGE_YEAR as varchar)", "product_type": "PRODUCT_TYPE", "ifrs9_stage": "cast(ifrs9_stage as varchar)",
}
_FIGURES = "round(sum(ead), 2) as ead, round(sum(ecl), 2) as ecl, count(*) as loan_count, round(avg(pd_pred), 6) as mean_pd, round(avg(lgd_pred), 6) as mean_lgd"
_RATE = "round(sum(ecl) / nullif(sum(ead), 0), 8) as ecl_rate"
_KPI = "round(sum(ead), 2) as total_ead, round(sum(ecl), 2) as total_ecl, round(sum(ecl) / greatest(sum(ead), 1), 8) as ecl_rate, count(*) as loan_count, round(avg(pd_pred), 6) as mean_pd, round(avg(lgd_pred), 6) as mean_lgd"


def _segment(name: str) -> str:
    order = f", {_BAND_ORDER.format(name)} as band_order" if name.endswith("_band") else ""
    return f"""select {name}, ead, ecl, loan_count, mean_pd, mean_lgd, ecl_rate{order} from (
  select {_SEGMENT_COLUMNS[name]} as {name}, {_FIGURES}, {_RATE}
  from scored where scenario_name = 'baseline' group by 1) where {name} is not null"""


_MACRO_COLUMNS = {
    "UNRATE": "unemployment_rate", "USSTHPI": "hpi_us", "MORTGAGE30US": "mortgage_rate_30y",
    "STLFSI4": "financial_stress_idx", "GDPC1": "real_gdp", "CPIAUCSL": "cpi",
}

# Common table expressions; a query carries only the ones it needs.
CTES = {
    "raw_orig": _view({**D.RAW_ORIGINATION, "VINTAGE_YEAR": D.ORIGINATION["VINTAGE_YEAR"], "row_no": "o_orderkey"}, D.FROM_ORDERS),
    "c_orig": "select row_no, VINTAGE_YEAR, "
    + ", ".join([
        f"{_int('CREDIT_SCORE', 'smallint', 9999)} as CREDIT_SCORE", f"{_int('NUMBER_OF_UNITS', 'tinyint')} as NUMBER_OF_UNITS",
        f"{_int('ORIGINAL_LOAN_TERM', 'smallint')} as ORIGINAL_LOAN_TERM", f"{_num('ORIGINAL_UPB')} as ORIGINAL_UPB",
        f"{_f4('MI_PCT')} as MI_PCT", f"{_f4('ORIGINAL_CLTV')} as ORIGINAL_CLTV", f"{_f4('ORIGINAL_DTI', 999)} as ORIGINAL_DTI",
        f"{_f4('ORIGINAL_LTV')} as ORIGINAL_LTV", f"{_f4('ORIGINAL_INTEREST_RATE')} as ORIGINAL_INTEREST_RATE",
        f"{_month('FIRST_PAYMENT_DATE')} as FIRST_PAYMENT_DATE", f"{_month('MATURITY_DATE')} as MATURITY_DATE",
        f"cast({_month('FIRST_PAYMENT_DATE')} - interval 1 month as date) as ORIGINATION_DATE",
        *[f"{_code(c)} as {c}" for c in _CODES],
    ]) + " from raw_orig",
    "raw_svcg": _view({**D.RAW_SERVICING, "VINTAGE_YEAR": D.ORIGINATION["VINTAGE_YEAR"], "row_no": D.SERVICING["ROW_SEQ"]}, D.FROM_LINES),
    "t_svcg": "select row_no, VINTAGE_YEAR, "
    + ", ".join([
        *[f"{_num(c)} as {c}" for c in _SVCG_DOUBLES],
        f"{_int('LOAN_AGE', 'smallint')} as LOAN_AGE", f"{_int('REMAINING_MONTHS_TO_MATURITY', 'smallint')} as REMAINING_MONTHS_TO_MATURITY",
        *[f"case when {c} in {_NULLS} then null else {c} end as {c}" for c in _SVCG_TEXT],
        f"upper(trim(case when CURRENT_LOAN_DELINQUENCY_STATUS in {_NULLS} then null else CURRENT_LOAN_DELINQUENCY_STATUS end)) as CURRENT_LOAN_DELINQUENCY_STATUS",
    ]) + " from raw_svcg",
    "c_svcg": f"select *, {_month('MONTHLY_REPORTING_PERIOD')} as REPORTING_DATE, {_month('ZERO_BALANCE_EFFECTIVE_DATE')} as ZERO_BALANCE_DATE, "
    + _flags("CURRENT_LOAN_DELINQUENCY_STATUS", "ZERO_BALANCE_CODE") + " from t_svcg",
    "orig": _view(D.ORIGINATION, D.FROM_ORDERS),
    "svcg0": _view(D.SERVICING, D.FROM_LINES),
    "svcg1": "select * replace (upper(trim(CURRENT_LOAN_DELINQUENCY_STATUS)) as CURRENT_LOAN_DELINQUENCY_STATUS) from svcg0",
    "svcg": "select *, " + _flags("CURRENT_LOAN_DELINQUENCY_STATUS", "ZERO_BALANCE_CODE") + " from svcg1",
    "panel": f"select s.*, o.* exclude (LOAN_SEQUENCE_NUMBER), {_AGE} as LOAN_AGE_MONTHS, {_DLQ} as DLQ_STATUS_INT, "
    "row_number() over (partition by s.LOAN_SEQUENCE_NUMBER order by REPORTING_DATE asc nulls last, ROW_SEQ) as rn "
    "from svcg s join orig o on o.LOAN_SEQUENCE_NUMBER = s.LOAN_SEQUENCE_NUMBER",
    "obs": f"select {', '.join(f'{t} as {n}' for n, t in D.MACRO_OBSERVATION.items())} from (select *, unnest([{', '.join(repr(i) for i in D.MACRO_IDS)}]) as series_id from orders) where {D.MACRO_FILTER}",
    "resampled": "select series_id, cast(date_trunc('month', obs_date) as date) as month, value from (select *, row_number() over (partition by series_id, date_trunc('month', obs_date) order by obs_date desc, obs_seq desc) as k from obs where value is not null) where k = 1",
    "grid": f"select unnest([{', '.join(repr(s) for s in _MACRO_COLUMNS)}]) as series_id, month from (select cast(unnest(generate_series(date '2010-01-01', date '2023-12-01', interval 1 month)) as date) as month)",
    "filled": "select g.series_id, g.month, last_value(r.value ignore nulls) over (partition by g.series_id order by g.month rows between unbounded preceding and current row) as value from grid g left join resampled r on r.series_id = g.series_id and r.month = g.month",
    "changes": "select *, (value / nullif(lag(value, 12) over w, 0) - 1) * 100 as yoy, value - lag(value, 1) over w as mom from filled window w as (partition by series_id order by month)",
    "macro": "select month as date, " + ", ".join(f"max(case when series_id = '{s}' then value end) as {n}" for s, n in _MACRO_COLUMNS.items())
    + ", max(case when series_id = 'USSTHPI' then yoy end) as hpi_yoy_chg, max(case when series_id = 'UNRATE' then mom end) as unrate_chg_mom from changes group by month",
    "base": "select coalesce(avg(unemployment_rate), 4.87) as unemployment_rate, coalesce(avg(hpi_us), 199.0) as hpi_us, coalesce(avg(mortgage_rate_30y), 3.65) as mortgage_rate_30y, coalesce(avg(financial_stress_idx), -0.5) as financial_stress_idx, avg(real_gdp) as real_gdp, avg(cpi) as cpi, coalesce(avg(hpi_yoy_chg), 5.6) as hpi_yoy_chg, coalesce(avg(unrate_chg_mom), 0.0) as unrate_chg_mom from macro where extract(year from date) = 2016",
    "losses": f"select LOAN_SEQUENCE_NUMBER, rn, ead_upb, {_clip('raw', '0', '1')} as lgd from (select p.LOAN_SEQUENCE_NUMBER, p.rn, e.ead_upb, coalesce(p.ACTUAL_LOSS_CALCULATION, e.ead_upb - coalesce(p.NET_SALES_PROCEEDS, 0) - coalesce(p.MI_RECOVERIES, 0) - coalesce(p.NON_MI_RECOVERIES, 0) + coalesce(p.EXPENSES, 0)) / nullif(e.ead_upb, 0) as raw from panel p left join (select LOAN_SEQUENCE_NUMBER, arg_max(CURRENT_ACTUAL_UPB, rn) as ead_upb from panel where CURRENT_ACTUAL_UPB > 0 group by 1) e on e.LOAN_SEQUENCE_NUMBER = p.LOAN_SEQUENCE_NUMBER where p.IS_LIQUIDATED)",
    "loss": "select LOAN_SEQUENCE_NUMBER, arg_max(lgd, rn) filter (where lgd is not null) as lgd_observed, arg_max(ead_upb, rn) filter (where ead_upb is not null) as EAD from losses group by 1",
    "history": f"select LOAN_SEQUENCE_NUMBER, bool_or(IS_SERIOUSLY_DELINQUENT) as d, bool_or(IS_PREPAID) as p, min(LOAN_AGE_MONTHS) filter (where IS_SERIOUSLY_DELINQUENT) as t_default, min(LOAN_AGE_MONTHS) filter (where IS_PREPAID) as t_prepay, coalesce(bool_or(MODIFICATION_FLAG = 'Y'), false) as modified, max(DLQ_STATUS_INT) as max_dlq_status, {_last('ZERO_BALANCE_CODE', 'IS_ZERO_BALANCE')} as zb_code, {_last('ZERO_BALANCE_DATE', 'IS_ZERO_BALANCE')} as zb_date, {_last('LOAN_AGE_MONTHS', 'IS_ZERO_BALANCE')} as zb_age, max(LOAN_AGE_MONTHS) as observed_months from panel group by 1",
    "outcomes": "select o.*, coalesce(h.d, false) as defaulted, coalesce(h.p, false) as prepaid, l.LOAN_SEQUENCE_NUMBER is not null as liquidated, h.t_default as time_to_default_months, h.t_prepay as time_to_prepay_months, l.lgd_observed, l.EAD, coalesce(h.modified, false) as ever_modified, h.max_dlq_status, h.zb_code as ZERO_BALANCE_CODE, h.zb_date as ZERO_BALANCE_DATE, h.zb_age as zero_balance_age_months, h.observed_months from orig o left join history h on h.LOAN_SEQUENCE_NUMBER = o.LOAN_SEQUENCE_NUMBER left join loss l on l.LOAN_SEQUENCE_NUMBER = o.LOAN_SEQUENCE_NUMBER",
    "latest": "select LOAN_SEQUENCE_NUMBER, " + ", ".join(f"{_last(c)} as {c}" for c in (
        "REPORTING_DATE", "CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS", "LOAN_AGE", "ZERO_BALANCE_CODE", "ZERO_BALANCE_DATE",
        "IS_SERIOUSLY_DELINQUENT", "IS_ZERO_BALANCE", "IS_PREPAID", "IS_LIQUIDATED", "IS_DEFAULTED", "MODIFICATION_FLAG",
        "NET_SALES_PROCEEDS", "ACTUAL_LOSS_CALCULATION", "EXPENSES", "MI_RECOVERIES", "NON_MI_RECOVERIES", "DLQ_STATUS_INT",
        "VINTAGE_YEAR", "ORIGINATION_DATE", "CREDIT_SCORE", "ORIGINAL_LTV", "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB",
        "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TERM", "OCC_STATUS", "LOAN_PURPOSE", "PROPERTY_TYPE", "PROPERTY_STATE",
        "PRODUCT_TYPE", "CHANNEL", "FIRST_TIME_HOMEBUYER_FLAG", "MI_PCT", "LOAN_AGE_MONTHS")) + " from panel group by 1",
    "active": "select * from latest where not IS_ZERO_BALANCE",
    "shocks": "select * from (values ('baseline', 0.0, 0.0, 0.0, 'Baseline', '#22d3ee'), ('mild', 2.0, -5.0, 1.0, 'Mild Stress', '#f59e0b'), ('severe', 5.0, -20.0, 2.5, 'Severe Stress', '#ef4444'), ('gfc', 8.0, -33.0, 0.5, 'GFC-like', '#7c3aed'), ('custom', 3.5, -12.0, 1.25, 'Custom', '#888')) t(scenario_name, u, h, r, label, color)",
    "stressed": "select scenario_name, label, color, cast(u as double) as u, cast(h as double) as h, unemployment_rate + cast(u as double) as unemployment_rate, hpi_yoy_chg + cast(h as double) as hpi_yoy_chg, mortgage_rate_30y + cast(r as double) as mortgage_rate_30y, financial_stress_idx, unrate_chg_mom + cast(u as double) / 12.0 as unrate_chg_mom from shocks cross join base",
    "scored0": f"select a.*, s.scenario_name, coalesce(CURRENT_ACTUAL_UPB, ORIGINAL_UPB, 0) as ead, {_HPD.format(u='s.unemployment_rate')} as pd_pred, {_hlgd('s.hpi_yoy_chg')} as lgd_pred from active a cross join stressed s",
    "scored1": f"select *, {_stage('pd_pred', 'DLQ_STATUS_INT')} as ifrs9_stage from scored0",
    "scored_all": "select *, least(pd_pred * case when ifrs9_stage = 1 then 1.0 else 3.0 end, 1.0) * lgd_pred * ead as ecl from scored1",
    "scored": "select * from scored_all where scenario_name <> 'custom'",
    "kpi": f"select scenario_name, {_KPI} from scored group by 1",
    "pd12": _pd_sql(12, 12),
    "pd24": _pd_sql(12, 24),
    "pd0": _pd_sql(0, 12),
    "lgd0": f"select * replace (case when liquidated and lgd_observed is not null then lgd_observed else {_clip('(cast(0.30 as double) + greatest(coalesce(ORIGINAL_LTV, 80) / 100.0 - cast(0.80 as double), 0))', '0.05', '0.90')} end as lgd_observed, coalesce(EAD, ORIGINAL_UPB) as EAD), case when liquidated and lgd_observed is not null then 'observed' else 'synthetic_ltv' end as lgd_source, date_trunc('month', ORIGINATION_DATE + to_days(cast(floor(coalesce(time_to_default_months, 0) * cast(30.44 as double)) as int))) as default_month from outcomes where defaulted",
    "lgd_rows": "select LOAN_SEQUENCE_NUMBER, VINTAGE_YEAR, lgd_observed, CREDIT_SCORE, ORIGINAL_LTV, ORIGINAL_CLTV, ORIGINAL_DTI, ORIGINAL_UPB, ORIGINAL_INTEREST_RATE, ORIGINAL_LOAN_TERM, OCC_STATUS, PROPERTY_TYPE, PROPERTY_STATE, LOAN_PURPOSE, MI_PCT, cast(coalesce(time_to_default_months, observed_months) as float) as LOAN_AGE_AT_DEFAULT, m.unemployment_rate as unemployment_rate_at_default, m.hpi_yoy_chg as hpi_yoy_chg_at_default, m.mortgage_rate_30y as rate_at_default, m.financial_stress_idx as fsi_at_default, EAD, lgd_source from lgd0 left join macro m on m.date = default_month where lgd_observed between 0 and 1 and EAD > 0",
    "pd_scores": f"select case when VINTAGE_YEAR <= 2013 then 'train' when VINTAGE_YEAR = 2014 then 'valid' else 'test' end as split, PD_TARGET as label, round({_HPD.format(u='(select unemployment_rate from base)')}, 12) as score from pd12 where VINTAGE_YEAR between 2010 and 2016",
    "lgd_scores": f"select case when VINTAGE_YEAR <= 2013 then 'train' when VINTAGE_YEAR = 2014 then 'valid' else 'test' end as split, lgd_observed as label, round({_hlgd('(select hpi_yoy_chg from base)')}, 12) as severity from lgd_rows where VINTAGE_YEAR between 2010 and 2016",
    "lgd_edges": "select split, q[1] as lo, q[11] as hi, unnest(q) as edge from (select split, quantile_cont(severity, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as q from lgd_scores group by 1)",
    "by_score": "select split, score, cast(count(*) filter (where label = 1) as bigint) as pos, cast(count(*) filter (where label = 0) as bigint) as neg from pd_scores group by 1, 2",
    "roc": "select *, cast(sum(pos) over w as bigint) as cum_pos, cast(sum(neg) over w as bigint) as cum_neg from by_score window w as (partition by split order by score desc)",
    "roc_total": "select split, sum(pos) as p, sum(neg) as n from by_score group by 1",
    "loan_year": "select LOAN_SEQUENCE_NUMBER, VINTAGE_YEAR as vintage_year, cast(extract(year from REPORTING_DATE) as int) as obs_year, IS_DEFAULTED from panel where REPORTING_DATE is not null",
    "curves": "select vintage_year, obs_year, count(distinct LOAN_SEQUENCE_NUMBER) as total_loans, count(*) filter (where IS_DEFAULTED) as defaulted from loan_year group by 1, 2",
    "apps": _view(D.APPLICATIONS, D.FROM_ORDERS),
    "filled_apps": "select application_id, coalesce(credit_score, 700) as credit_score, coalesce(original_ltv, 80) as original_ltv, original_cltv, original_dti, original_upb, original_interest_rate, original_loan_term, mi_pct, coalesce(unemployment_shock, 0) as unemployment_shock, coalesce(hpi_shock, 0) as hpi_shock, coalesce(rate_shock, 0) as rate_shock from apps",
    "checked_apps": "select *, concat_ws('; ', case when credit_score < 300 then 'credit_score below 300' end, case when credit_score > 850 then 'credit_score above 850' end, case when original_ltv < 0 then 'original_ltv below 0' end, case when original_ltv > 200 then 'original_ltv above 200' end, case when original_cltv < 0 then 'original_cltv below 0' end, case when original_cltv > 200 then 'original_cltv above 200' end, case when original_dti < 0 then 'original_dti below 0' end, case when original_dti > 70 then 'original_dti above 70' end, case when original_upb < 1000 then 'original_upb below 1000' end, case when original_interest_rate < 0 then 'original_interest_rate below 0' end, case when original_interest_rate > 20 then 'original_interest_rate above 20' end, case when original_loan_term < 60 then 'original_loan_term below 60' end, case when original_loan_term > 480 then 'original_loan_term above 480' end, case when mi_pct < 0 then 'mi_pct below 0' end, case when mi_pct > 35 then 'mi_pct above 35' end, case when unemployment_shock < -5 then 'unemployment_shock below -5' end, case when unemployment_shock > 20 then 'unemployment_shock above 20' end, case when hpi_shock < -50 then 'hpi_shock below -50' end, case when hpi_shock > 20 then 'hpi_shock above 20' end, case when rate_shock < -3 then 'rate_shock below -3' end, case when rate_shock > 10 then 'rate_shock above 10' end) as violations from filled_apps",
    "app_pd": f"select application_id, ORIGINAL_UPB as ead, {_HPD.format(u='(b.unemployment_rate + unemployment_shock)')} as pd, {_hlgd('(b.hpi_yoy_chg + hpi_shock)')} as lgd from checked_apps cross join base b where violations = ''",
    "app_stage": f"select *, {_stage('pd', '0')} as ifrs9_stage from app_pd",
    "app_scored": f"select application_id, round(pd, 6) as pd_12m, round(lgd, 4) as lgd, {_cents('ead')} as ead, {_cents('ecl')} as ecl, round(ecl / greatest(ead, 1), 6) as ecl_rate, ifrs9_stage, case when pd < cast(0.01 as double) then 'LOW' when pd < cast(0.03 as double) then 'MEDIUM' when pd < cast(0.08 as double) then 'HIGH' else 'VERY HIGH' end as risk_level from (select *, least(pd * case when ifrs9_stage = 1 then 1.0 else 3.0 end, 1.0) * lgd * ead as ecl from app_stage)",
}


def _histogram(source: str, value: str, bins: int, group: str = "") -> str:
    over = f"over (partition by {group})" if group else "over ()"
    lead = f"{group}, " if group else ""
    return f"""select {lead}cast(least(floor((x - lo) / ((hi - lo) / {bins}.0)), {bins - 1}) as int) as bin, count(*) as rows from (
  select {lead}x, case when lo = hi then lo - 0.5 else lo end as lo, case when lo = hi then hi + 0.5 else hi end as hi from (
    select {lead}cast({value} as double) as x, min(cast({value} as double)) {over} as lo, max(cast({value} as double)) {over} as hi
    from {source} where {value} is not null)) group by all"""


_METRIC = "from roc r join roc_total t on t.split = r.split group by r.split"
_PD_NUMERIC = (
    "CREDIT_SCORE", "ORIGINAL_LTV", "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB", "ORIGINAL_INTEREST_RATE",
    "ORIGINAL_LOAN_TERM", "MI_PCT", "RATE_SPREAD", "LOAN_AGE_AT_OBS", "unemployment_rate", "hpi_yoy_chg",
    "mortgage_rate_30y", "financial_stress_idx", "unrate_chg_mom", "DLQ_STATUS_INT",
)
_FLAG_NAMES = "IS_SERIOUSLY_DELINQUENT, IS_ZERO_BALANCE, IS_PREPAID, IS_LIQUIDATED, IS_DEFAULTED"

BODIES = {
    "clean_orig": "select * from c_orig",
    "parse_numbers": "select row_no, CREDIT_SCORE, MI_PCT, NUMBER_OF_UNITS, ORIGINAL_CLTV, ORIGINAL_DTI, ORIGINAL_UPB, ORIGINAL_LTV, ORIGINAL_INTEREST_RATE, ORIGINAL_LOAN_TERM from c_orig",
    "sentinel_nulls": "select VINTAGE_YEAR, count(*) filter (where CREDIT_SCORE is null) as fico_missing, count(*) filter (where ORIGINAL_DTI is null) as dti_missing, count(*) filter (where ORIGINAL_LTV = 999) as ltv_999_kept from c_orig group by 1",
    "parse_yyyymm": "select row_no, FIRST_PAYMENT_DATE, MATURITY_DATE from c_orig",
    "code_sentinels": f"select row_no, {', '.join(_CODES)} from c_orig",
    "loan_purpose_nine": "select LOAN_PURPOSE, OCC_STATUS, count(*) as loans from c_orig group by 1, 2",
    "null_tokens": "select VINTAGE_YEAR, count(*) filter (where CURRENT_ACTUAL_UPB is null) as upb_missing, count(*) filter (where CURRENT_LIST_PRICE is null) as list_price_missing, count(*) filter (where ORIGINAL_LIST_PRICE is null) as original_price_missing, count(*) filter (where MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB is null) as deferred_missing from c_svcg group by 1",
    "origination_date": "select row_no, VINTAGE_YEAR, FIRST_PAYMENT_DATE, ORIGINATION_DATE from c_orig",
    "dedupe_first": "select VINTAGE_YEAR, LOAN_SEQUENCE_NUMBER, row_no, CREDIT_SCORE, ORIGINAL_UPB, CHANNEL from (select *, row_number() over (partition by VINTAGE_YEAR, LOAN_SEQUENCE_NUMBER order by row_no) as k from c_orig) where k = 1",
    "load_audit": "select VINTAGE_YEAR, count(*) as raw_rows, count(*) - count(distinct LOAN_SEQUENCE_NUMBER) as duplicate_rows, count(distinct LOAN_SEQUENCE_NUMBER) as clean_rows from c_orig group by 1",
    "clean_svcg": "select * from c_svcg",
    "clean_svcg_flags": f"select LOAN_SEQUENCE_NUMBER, ROW_SEQ as row_no, CURRENT_LOAN_DELINQUENCY_STATUS, {_FLAG_NAMES} from svcg",
    "io_orig_text": "select * exclude (row_no) from c_orig",
    "io_svcg_text": "select * exclude (row_no) from c_svcg",
    "io_svcg_stream": "select VINTAGE_YEAR, count(*) as loan_months, count(*) filter (where IS_DEFAULTED) as defaulted, count(*) filter (where IS_PREPAID) as prepaid, round(sum(CURRENT_ACTUAL_UPB), 2) as upb from c_svcg group by 1",
    "io_partitioned_parquet": "select VINTAGE_YEAR, count(*) as loan_months, count(distinct LOAN_SEQUENCE_NUMBER) as loans, round(sum(CURRENT_ACTUAL_UPB), 2) as upb from panel where VINTAGE_YEAR in (2012, 2015) group by 1",
    "io_json_results": "select scenario_name, count(*) as loan_count, round(sum(ecl), 2) as total_ecl, cast(count(distinct PROPERTY_STATE) as int) as states from scored group by 1",
    "io_column_projection": "select LOAN_SEQUENCE_NUMBER, VINTAGE_YEAR, CREDIT_SCORE from orig",
    "io_select_available": "select LOAN_SEQUENCE_NUMBER, ORIGINAL_UPB from orig",
    "io_years_subset": "select VINTAGE_YEAR, count(*) as loans from orig where VINTAGE_YEAR in (2011, 2013) group by 1",
    "combine_years": "select LOAN_SEQUENCE_NUMBER, VINTAGE_YEAR, ORIGINAL_UPB, case when VINTAGE_YEAR = 2010 then 'x' end as EXTRA from orig where VINTAGE_YEAR between 2010 and 2016",
    "macro_monthly": "select * from macro",
    "macro_resample_last": "select * from resampled",
    "macro_ffill": "select * from filled",
    "hpi_yoy": "select date, hpi_us, hpi_yoy_chg from macro",
    "unrate_mom": "select date, unemployment_rate, unrate_chg_mom from macro",
    "macro_baseline": "select " + ", ".join(f"round({c}, 6) as {c}" for c in (*_MACRO_COLUMNS.values(), "hpi_yoy_chg", "unrate_chg_mom")) + " from base",
    "panel_rows": "select * exclude (rn, ROW_SEQ), ROW_SEQ as row_no from panel",
    "loan_age_fallback": "select LOAN_AGE_MONTHS, LOAN_AGE is null as computed, count(*) as loan_months from panel group by 1, 2",
    "delinquency_int": "select CURRENT_LOAN_DELINQUENCY_STATUS, DLQ_STATUS_INT, count(*) as loan_months from panel group by 1, 2",
    "panel_macro": "select p.LOAN_SEQUENCE_NUMBER, p.ROW_SEQ as row_no, p.REPORTING_DATE, p.LOAN_AGE_MONTHS, m.unemployment_rate, m.hpi_us, m.hpi_yoy_chg, m.mortgage_rate_30y, m.financial_stress_idx, m.unrate_chg_mom from panel p left join macro m on m.date = date_trunc('month', p.REPORTING_DATE)",
    "first_default": "select LOAN_SEQUENCE_NUMBER, defaulted, time_to_default_months from outcomes",
    "first_prepay": "select LOAN_SEQUENCE_NUMBER, prepaid, time_to_prepay_months from outcomes",
    "ead_last_nonzero": "select LOAN_SEQUENCE_NUMBER, EAD from outcomes where liquidated",
    "lgd_observed": "select LOAN_SEQUENCE_NUMBER, lgd_observed from outcomes where liquidated",
    "ever_modified": "select LOAN_SEQUENCE_NUMBER, ever_modified from outcomes",
    "max_delinquency": "select LOAN_SEQUENCE_NUMBER, max_dlq_status, observed_months from outcomes",
    "zero_balance_final": "select LOAN_SEQUENCE_NUMBER, ZERO_BALANCE_CODE, ZERO_BALANCE_DATE, zero_balance_age_months from outcomes",
    "loan_outcomes": "select * from outcomes",
    "outcomes_liquidation_basis": "select VINTAGE_YEAR, count(*) filter (where defaulted or liquidated) as defaulted from outcomes group by 1",
    "outcomes_macro": "select LOAN_SEQUENCE_NUMBER, defaulted, m.unemployment_rate as unrate_at_orig, m.hpi_us as hpi_at_orig, m.hpi_yoy_chg as hpi_yoy_at_orig, m.mortgage_rate_30y as rate_at_orig, m.financial_stress_idx as fsi_at_orig, ORIGINAL_INTEREST_RATE - m.mortgage_rate_30y as RATE_SPREAD from outcomes left join macro m on m.date = date_trunc('month', ORIGINATION_DATE)",
    "pd_12m": "select * from pd12",
    "pd_24m": "select * from pd24",
    "pd_orig": "select * from pd0",
    "forward_default_labels": "select LOAN_SEQUENCE_NUMBER, " + ", ".join(f"coalesce(bool_or(IS_DEFAULTED) filter (where LOAN_AGE_MONTHS > {a} and LOAN_AGE_MONTHS <= {a + h}), false) as label_{n}" for n, a, h in (("pd_12m", 12, 12), ("pd_24m", 12, 24), ("pd_orig", 0, 12))) + " from panel where LOAN_AGE is null or LOAN_AGE between 0 and 36 group by 1",
    "lgd_dataset": "select * replace (round(lgd_observed, 9) as lgd_observed) from lgd_rows",
    "lgd_synthetic": "select lgd_source, count(*) as loans, round(avg(lgd_observed), 6) as mean_lgd, round(sum(EAD), 2) as ead from lgd_rows group by 1",
    "split_counts": "select split, count(*) as loans from pd_scores group by 1",
    "logit_scored_rows": "select LOAN_SEQUENCE_NUMBER, 'logit' as model, case when VINTAGE_YEAR = 2014 then 'valid' else 'test' end as split, cast(PD_TARGET as double) as label, true as in_range from pd12 where VINTAGE_YEAR between 2014 and 2016",
    "ridge_scored_rows": "select LOAN_SEQUENCE_NUMBER, 'ridge' as model, case when VINTAGE_YEAR = 2014 then 'valid' else 'test' end as split, cast(lgd_observed as double) as label, true as in_range from lgd_rows where VINTAGE_YEAR between 2014 and 2016",
    "split_fallback": "select unnest(case when cast('0x' || substr(md5(LOAN_SEQUENCE_NUMBER), 1, 8) as bigint) % 5 = 4 then ['valid', 'test'] else ['train'] end) as split, count(*) as loans from pd12 where VINTAGE_YEAR between 2010 and 2016 group by 1",
    "class_weights": "select n as negatives, p as positives, round(n / greatest(p, 1), 6) as scale_pos_weight, round((n + p) / (2.0 * n), 6) as weight_negative, round((n + p) / (2.0 * p), 6) as weight_positive from (select count(*) filter (where label = 0) as n, count(*) filter (where label = 1) as p from pd_scores where split = 'train')",
    "dataset_summary": "select VINTAGE_YEAR, count(*) as loans, round(avg(PD_TARGET), 6) as default_rate from pd12 group by 1",
    "lgd_summary": "select round(avg(lgd_observed), 6) as mean_value, round(median(lgd_observed), 6) as median_value from lgd_rows",
    "snapshot_active": "select * from active",
    "snapshot_row_mode": "select LOAN_SEQUENCE_NUMBER, REPORTING_DATE, CURRENT_ACTUAL_UPB, CURRENT_LOAN_DELINQUENCY_STATUS, DLQ_STATUS_INT, LOAN_AGE_MONTHS, MODIFICATION_FLAG from (select *, row_number() over (partition by LOAN_SEQUENCE_NUMBER order by rn desc) as k from panel) where k = 1 and not IS_ZERO_BALANCE",
    "scenario_macro": "select PRODUCT_TYPE, loans, scenario_name, round(unemployment_rate, 6) as unemployment_rate, round(hpi_yoy_chg, 6) as hpi_yoy_chg, round(mortgage_rate_30y, 6) as mortgage_rate_30y, round(financial_stress_idx, 6) as financial_stress_idx, round(unrate_chg_mom, 6) as unrate_chg_mom from (select PRODUCT_TYPE, count(*) as loans from active group by 1) cross join stressed where scenario_name <> 'custom'",
    "heuristic_pd": "select LOAN_SEQUENCE_NUMBER, scenario_name, round(pd_pred, 6) as pd_pred from scored",
    "heuristic_lgd": "select LOAN_SEQUENCE_NUMBER, scenario_name, round(lgd_pred, 6) as lgd_pred from scored",
    "pd_scoring_features": "select a.LOAN_SEQUENCE_NUMBER, s.scenario_name, a.LOAN_AGE_MONTHS as LOAN_AGE_AT_OBS, a.DLQ_STATUS_INT, round(a.ORIGINAL_INTEREST_RATE - b.mortgage_rate_30y, 6) as RATE_SPREAD, round(s.unemployment_rate, 6) as unemployment_rate, round(s.hpi_yoy_chg, 6) as hpi_yoy_chg, round(s.mortgage_rate_30y, 6) as mortgage_rate_30y, round(s.unrate_chg_mom, 6) as unrate_chg_mom from active a cross join stressed s cross join base b where s.scenario_name <> 'custom'",
    "lgd_scoring_features": "select a.LOAN_SEQUENCE_NUMBER, s.scenario_name, a.LOAN_AGE_MONTHS as LOAN_AGE_AT_DEFAULT, round(s.unemployment_rate, 6) as unemployment_rate_at_default, round(s.hpi_yoy_chg, 6) as hpi_yoy_chg_at_default, round(s.mortgage_rate_30y, 6) as rate_at_default, round(s.financial_stress_idx, 6) as fsi_at_default from active a cross join stressed s where s.scenario_name <> 'custom'",
    "ead_selection": "select LOAN_SEQUENCE_NUMBER, ead from scored where scenario_name = 'baseline'",
    "ifrs9_stage": "select LOAN_SEQUENCE_NUMBER, scenario_name, ifrs9_stage from scored",
    "loan_ecl": "select LOAN_SEQUENCE_NUMBER, scenario_name, round(ecl, 4) as ecl from scored",
    "portfolio_kpi": "select * from kpi",
    "ecl_by_state": _segment("state"),
    "ecl_by_fico": _segment("fico_band"),
    "ecl_by_ltv": _segment("ltv_band"),
    "ecl_by_vintage": _segment("vintage"),
    "ecl_by_product": _segment("product_type"),
    "ecl_by_stage": "select scenario_name, ifrs9_stage, count(*) as loan_count, round(sum(ead), 2) as ead, round(sum(ecl), 2) as ecl from scored group by 1, 2",
    "scenario_all": f"select scenario_name, 'portfolio' as segment, 'all' as segment_value, {_FIGURES}, round(sum(ecl) / greatest(sum(ead), 1), 8) as ecl_rate from scored group by 1 "
    + " ".join(f"union all select * from (select scenario_name, '{n}' as segment, {c} as segment_value, {_FIGURES}, {_RATE} from scored group by 1, 2, 3) where segment_value is not null" for n, c in _SEGMENT_COLUMNS.items()),
    "scenario_custom": f"select k.*, round(b.e, 2) as baseline_ecl, round(k2.e - b.e, 2) as ecl_delta, round((k2.e - b.e) / greatest(b.e, 1) * 100, 4) as ecl_delta_pct from (select scenario_name, {_KPI} from scored_all where scenario_name in ('baseline', 'custom') group by 1) k join (select scenario_name, sum(ecl) as e from scored_all group by 1) k2 on k2.scenario_name = k.scenario_name cross join (select sum(ecl) as e from scored_all where scenario_name = 'baseline') b",
    "scenario_delta": "select k.scenario_name, round(k.e, 2) as total_ecl, round(b.e, 2) as baseline_ecl, round(k.e - b.e, 2) as ecl_delta, round((k.e - b.e) / greatest(b.e, 1) * 100, 4) as ecl_delta_pct from (select scenario_name, sum(ecl) as e from scored group by 1) k cross join (select sum(ecl) as e from scored where scenario_name = 'baseline') b",
    "scenario_summary": "select k.scenario_name, total_ecl, ecl_rate, mean_pd, mean_lgd, label as scenario_label, color from kpi k join shocks s on s.scenario_name = k.scenario_name",
    "risk_dimensions": "select k.scenario_name, round(least(mp * 2000, 100), 4) as dim_pd, round(least(ml * 100, 100), 4) as dim_lgd, round(least(er * 5000, 100), 4) as dim_ecl, round(least((cast(4.87 as double) + u) * 6, 100), 4) as dim_unemployment, round(greatest(0, 50 + h * 2), 4) as dim_hpi from (select scenario_name, avg(pd_pred) as mp, avg(lgd_pred) as ml, sum(ecl) / greatest(sum(ead), 1) as er from scored group by 1) k join stressed s on s.scenario_name = k.scenario_name",
    "formatted_kpis": "select scenario_name, "
    + ", ".join(f"case when abs({c}) >= 1e9 then '$' || printf('%.2f', {c} / 1e9) || 'B' when abs({c}) >= 1e6 then '$' || printf('%.2f', {c} / 1e6) || 'M' when abs({c}) >= 1e3 then '$' || printf('%.1f', {c} / 1e3) || 'K' else '$' || printf('%.0f', {c}) end as {n}" for c, n in (("te", "total_ead"), ("tl", "total_ecl")))
    + ", printf('%.0f', er * 10000) || ' bps' as ecl_rate, printf('%.2f', mp * 100) || '%' as mean_pd, printf('%.2f', ml * 100) || '%' as mean_lgd from (select scenario_name, sum(ead) as te, sum(ecl) as tl, sum(ecl) / greatest(sum(ead), 1) as er, avg(pd_pred) as mp, avg(lgd_pred) as ml from scored group by 1)",
    "top_states_ecl": f"select PROPERTY_STATE as state, {_FIGURES}, {_RATE} from scored where scenario_name = 'baseline' and PROPERTY_STATE is not null group by 1 order by sum(ecl) / nullif(sum(ead), 0) desc nulls last, 1 limit 20",
    "vintage_curves": "select *, round(defaulted / total_loans, 6) as default_rate from curves",
    "vintage_curves_cumulative": "select c.vintage_year, c.obs_year, (select count(distinct LOAN_SEQUENCE_NUMBER) from loan_year l where l.vintage_year = c.vintage_year) as vintage_loans, (select count(distinct LOAN_SEQUENCE_NUMBER) from loan_year l where l.vintage_year = c.vintage_year and l.obs_year <= c.obs_year and l.IS_DEFAULTED) as cumulative_defaults, round((select count(distinct LOAN_SEQUENCE_NUMBER) from loan_year l where l.vintage_year = c.vintage_year and l.obs_year <= c.obs_year and l.IS_DEFAULTED) / (select count(distinct LOAN_SEQUENCE_NUMBER) from loan_year l where l.vintage_year = c.vintage_year), 6) as cumulative_default_rate from curves c",
    "vintage_pivot": "select obs_year, " + ", ".join(f'max(case when vintage_year = {y} then round(defaulted / total_loans * 100, 3) end) as "{y}"' for y in range(2010, 2017)) + " from curves group by 1",
    "vintage_series": "select vintage_year, string_agg(obs_year || ':' || total_loans, ',' order by obs_year) as points from curves group by 1",
    "roc_points": "select split, score, pos, neg, cum_pos, cum_neg from roc",
    "auc": f"select r.split, round(sum(neg * (cum_pos - pos + pos * cast(0.5 as double))) / (max(t.p) * max(t.n)), 6) as auc {_METRIC}",
    "average_precision": f"select r.split, round(sum(pos * (cum_pos / (cum_pos + cum_neg))) / max(t.p), 6) as ap {_METRIC}",
    "ks": f"select r.split, round(greatest(max(cum_pos / t.p - cum_neg / t.n), 0), 6) as ks {_METRIC}",
    "brier": "select split, round(avg((score - label) * (score - label)), 6) as brier, count(*) as rows from pd_scores group by 1",
    "regression_metrics": "select split, round(sqrt(avg((label - severity) * (label - severity))), 6) as rmse, round(avg(abs(label - severity)), 6) as mae, round(1 - sum((label - severity) * (label - severity)) / sum((label - m) * (label - m)), 6) as r2, count(*) as rows from (select *, avg(label) over (partition by split) as m from lgd_scores) group by 1",
    "decile_calibration": "select split, decile_bin, round(avg(severity), 6) as mean_pred, round(avg(label), 6) as mean_actual, count(*) as rows from (select s.split, s.severity, s.label, cast((select count(distinct edge) from lgd_edges e where e.split = s.split and edge > lo and edge < hi and edge < s.severity) as int) as decile_bin from lgd_scores s) group by 1, 2",
    "calibration_curve": "select split, cast(" + " + ".join(f"(case when score > cast({i * 0.1!r} as double) then 1 else 0 end)" for i in range(1, 10)) + " as int) as bin, round(avg(score), 6) as mean_predicted, round(avg(label), 6) as fraction_positive, count(*) as rows from pd_scores group by 1, 2",
    "default_rate_by_vintage": "select VINTAGE_YEAR, round(avg(cast(defaulted as int)), 6) as default_rate, count(*) as loans from outcomes group by 1",
    "default_rate_by_fico": f"select fico_band, round(avg(cast(defaulted as int)) * 100, 6) as default_rate_pct, {_BAND_ORDER.format('fico_band')} as band_order from (select {_FICO_BAND} as fico_band, defaulted from outcomes) where fico_band is not null group by fico_band",
    "histogram_fico": _histogram("orig", "CREDIT_SCORE", 50, "VINTAGE_YEAR"),
    "histogram_ltv": _histogram("orig", "ORIGINAL_LTV", 40),
    "histogram_lgd": _histogram("outcomes", "lgd_observed", 40),
    "ltv_markers": "select round(avg(ORIGINAL_LTV), 6) as mean_value, round(median(ORIGINAL_LTV), 6) as median_value from orig",
    "lgd_markers": "select round(avg(lgd_observed), 6) as mean_value, round(median(lgd_observed), 6) as median_value from outcomes",
    "top_states_by_loans": "select PROPERTY_STATE, count(*) as loans from orig where PROPERTY_STATE is not null group by 1 order by 2 desc, 1 limit 15",
    "portfolio_summary": "select count(*) as total_loans, round(sum(ORIGINAL_UPB), 2) as total_upb, round(avg(CREDIT_SCORE), 6) as avg_fico, round(avg(ORIGINAL_LTV), 6) as avg_ltv, round(avg(ORIGINAL_INTEREST_RATE), 6) as avg_rate, round(avg(cast(defaulted as int)), 6) as default_rate, round(avg(cast(prepaid as int)), 6) as prepay_rate, round(avg(lgd_observed), 6) as mean_lgd, round(avg(case when PRODUCT_TYPE = 'FRM' then 1 else 0 end), 6) as frm_share, round(avg(case when LOAN_PURPOSE = 'C' then 1 else 0 end), 6) as purchase_share from outcomes",
    "score_applications": "select * from app_scored",
    "request_violations": "select application_id, violations from checked_apps where violations <> ''",
    "scenario_request_violations": "select coalesce(unemployment_shock, 0) between -5 and 20 and coalesce(hpi_shock, 0) between -50 and 20 and coalesce(rate_shock, 0) between -3 and 10 as accepted, count(*) as requests from apps group by 1",
    "risk_level_counts": "select risk_level, ifrs9_stage, count(*) as applications from app_scored group by 1, 2",
    "impute_medians": "select * from (" + " union all ".join(f"select '{c}' as feature, median(cast({c} as double)) as median_value from pd12 where VINTAGE_YEAR between 2010 and 2013" for c in _PD_NUMERIC) + ")",
    "scale_stats": "select * from (" + " union all ".join(f"select '{c}' as feature, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as deviation from (select coalesce(cast({c} as double), (select median(cast({c} as double)) from pd12 where VINTAGE_YEAR between 2010 and 2013)) as v from pd12 where VINTAGE_YEAR between 2010 and 2013)" for c in _PD_NUMERIC) + ")",
}


def with_ctes(body: str) -> str:
    """Prefix a body with the common table expressions it needs, in definition order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", pending.pop()))
        for name in words & (CTES.keys() - needed):
            needed.add(name)
            pending.append(CTES[name])
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in CTES if n in needed) + "\n" + body


ORACLE = {name: with_ctes(body) for name, body in BODIES.items()}
