"""Oracle SQL (DuckDB) for the registered queries.

Written as plain SQL over the pre-registered tables: a global window where
the Spark plan uses halo blocks, ``row_number()`` where it uses partition
offsets, scalar subqueries for fitted constants. Queries that depend on a
KMeans fit or on JSON text formatting return what holds for every fit and format.
"""

from __future__ import annotations

from vigil import config as C
from vigil.functions.columns import sql_double
from vigil.plans.catalog import ALERT_AS_OF, CAP, PLACES, PROCESSED_AT, RUN_ID, STREAM_FILES
from vigil.plans.fixture_model import FIXED_CENTERS, FIXED_MEAN, FIXED_STD
from vigil.sources.fixture import raw_text_view_sql, sensor_view_sql

A, D = C.ANALOGUE_COLS, C.DIGITAL_COLS

# Written out here, not taken from the code that is checked.
NUMBER_PATTERN = r"^[+-]?(([0-9](_?[0-9])*\.?|([0-9](_?[0-9])*)?\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?|(?i:nan|inf|infinity))$"
FAULTS = [("LOW_COMPRESSOR_PRESSURE", "TP2", "<", 8.0), ("HIGH_MOTOR_CURRENT", "Motor_current", ">", 25.0),
          ("OVERHEATING", "Oil_temperature", ">", 90.0), ("VALVE_PRESSURE_DROP", "DV_pressure", "<", 0.5)]
RAW_NULLS = ["timestamp:required", "TP2:not_double", "TP3:not_double", "H1:not_double", "DV_pressure:not_double",
             "Reservoirs:not_double", "Oil_temperature:not_double", "Motor_current:not_double", "COMP:not_int", "DV_eletric:not_int",
             "Towers:not_int", "MPG:not_int", "LPS:not_int", "Pressure_switch:not_int", "Oil_level:not_int", "Caudal_impulses:not_int"]
PREDICTION_NULLS = ["source_timestamp:required", "anomaly_score:required", "is_anomaly:required", "processed_at:required",
                    "fault_hint:not_string", "cluster_id:not_int", "threshold_used:not_double", "TP2:not_double",
                    "Motor_current:not_double", "Oil_temperature:not_double", "DV_pressure:not_double",
                    "pressure_diff_TP2_TP3:not_double", "motor_oil_ratio:not_double", "rolling_mean_TP2:not_double",
                    "rolling_mean_motor:not_double", "spark_run_id:not_string", "data_split:not_string"]
SENSOR = ["event_id", "ts", "asset_id"] + A + D


def r(col: str, alias: str | None = None) -> str:
    return f"round({col}, {PLACES}) + 0e0 as {alias or col}"


def sel(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(r(c) if c in doubles else c for c in cols)


DOUBLES = set(A + C.DERIVED_COLS + C.ROLLING_COLS + ["anomaly_score", "threshold_used", "threshold"])

_W = "window w as (order by row_idx rows between 180 preceding and current row)"


def _seq_avg(c: str) -> str:
    """Frame mean summed in row order (as a sliding row frame does), not by a segment tree."""
    return f"list_reduce(list({c} order by row_idx) over w, lambda a, b: a + b) / count({c}) over w"


def _fault_case() -> str:
    parts = " ".join(f"when {c} {op} {sql_double(v)} then '{label}'" for label, c, op, v in FAULTS)
    return f"case {parts} else '{C.FAULT_OTHER}' end"


def _z(i: int, f: str) -> str:
    s = FIXED_STD[i]
    return "0e0" if s == 0 else f"({f} - {sql_double(FIXED_MEAN[i])}) / {sql_double(s)}"


def _d2(j: int) -> str:
    return " + ".join(f"(z{i} - {sql_double(c)}) * (z{i} - {sql_double(c)})" for i, c in enumerate(FIXED_CENTERS[j]))


def ctes(stream: bool = False) -> str:
    not_null = " and ".join(f"{c} is not null and not isnan({c})" for c in A)
    feat_cols = ", ".join(["event_id", "ts", "asset_id"] + A + [f"coalesce({c}, 0) as {c}" for c in D])
    k = len(FIXED_CENTERS)
    least = f"least({', '.join(f'd{j}' for j in range(k))})"
    cluster = "case " + " ".join(f"when d{j} = {least} then {j}" for j in range(k)) + " end"
    zs = ", ".join(f"{_z(i, f)} as z{i}" for i, f in enumerate(C.EXTENDED_COLS))
    ds = ", ".join(f"{_d2(j)} as d{j}" for j in range(k))

    def chain(p: str, source: str) -> str:
        """From clean rows to scored ones, under names that start with ``p``."""
        return f"""
{p}idx as (select *, row_number() over (order by ts, event_id) - 1 as row_idx, count(*) over () as n from {source}),
{p}feat as (
  select {feat_cols}, row_idx, n,
    TP2 - TP3 as pressure_diff_TP2_TP3, H1 - DV_pressure as pressure_diff_H1_DV,
    coalesce(Motor_current / nullif(Oil_temperature + 1e0, 0e0), 0e0) as motor_oil_ratio,
    {_seq_avg("TP2")} as rolling_mean_TP2, coalesce(stddev_samp(TP2) over w, 0e0) as rolling_std_TP2,
    {_seq_avg("Motor_current")} as rolling_mean_motor,
    coalesce(stddev_samp(Motor_current) over w, 0e0) as rolling_std_motor
  from {p}idx {_W}),
{p}split as (
  select *, case when row_idx < floor(n * {sql_double(C.TRAIN_RATIO)}) then 'train'
                 when row_idx < floor(n * ({sql_double(C.TRAIN_RATIO)} + {sql_double(C.TEST_RATIO)})) then 'test'
                 else 'demo' end as data_split
  from {p}feat),
{p}zs as (select *, {zs} from {p}split),
{p}ds as (select *, {ds} from {p}zs),
{p}scored as (select *, cast({cluster} as integer) as cluster, sqrt({least}) as anomaly_score from {p}ds)"""

    def labels(p: str) -> str:
        return f"""{p}labeled as (
  select s.*, s.anomaly_score > t.threshold as is_anomaly, t.threshold,
         case when s.anomaly_score > t.threshold then {_fault_case()} else '{C.FAULT_NONE}' end as fault_hint
  from {p}scored s cross join thr t)"""

    arrivals = ""
    if stream:
        # file k holds a fourteenth of the readings and those of earlier ones that were on their way too long; in micro-batch k the
        # readings up to the watermark of micro-batch k - 1, which rests on the files before that one, are late
        arrivals = f""",
arrived as (select *, event_id * {STREAM_FILES} // (select count(*) from sensor) + case when event_id % 97 = 5 then 5 when event_id % 41 = 3 then 1 else 0 end as k from clean),
newest as (select k, max(max(ts)) over (order by k) as newest from arrived group by k),
passed as (select k, date_trunc('millisecond', newest) - interval 3 days as mark, row_number() over (order by k) as nth from newest),
ontime as (
  select a.* exclude (k) from arrived a join passed p on p.k = a.k left join passed w on w.nth = p.nth - 2
  where w.mark is null or a.ts > w.mark),
{chain("s_", "ontime")},
{labels("s_")}"""
    return f"""
sensor as ({sensor_view_sql()}),
clean as (select * from sensor where {not_null}),
{chain("", "clean")},
thr as (select avg(anomaly_score) as score_mean, stddev_samp(anomaly_score) as score_std,
               avg(anomaly_score) + {sql_double(C.THRESHOLD_SIGMAS)} * stddev_samp(anomaly_score) as threshold
        from scored where data_split = 'train'),
{labels("")},
preds as (
  select ts as source_timestamp, anomaly_score, is_anomaly, fault_hint, cluster as cluster_id,
         threshold as threshold_used, TP2, Motor_current, Oil_temperature, DV_pressure, pressure_diff_TP2_TP3,
         motor_oil_ratio, rolling_mean_TP2, rolling_mean_motor, timestamp '{PROCESSED_AT}' as processed_at,
         '{RUN_ID}' as spark_run_id, data_split
  from labeled where data_split = 'demo'),
test as (select * from labeled where data_split = 'test'),
rawtext as ({raw_text_view_sql()}),
coerced as (select event_id, {_coerce_list()} from rawtext){arrivals}"""


def _strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _pyfloat(x: str) -> str:
    s = _strip(x)
    special = (f"case when ends_with(lower({s}), 'nan') then cast('nan' as double) "
               f"when starts_with({s}, '-') then cast('-inf' as double) else cast('inf' as double) end")
    return (f"(case when regexp_matches({s}, '{NUMBER_PATTERN}') then (case when contains(lower({s}), 'n') "
            f"then {special} else try_cast(replace({s}, '_', '') as double) end) end)")


def _pyint(x: str) -> str:
    f = _pyfloat(x)
    return f"(case when not isnan({f}) then try_cast(trunc({f}) as integer) end)"


def _coerce_list() -> str:
    parts = [f"nullif({_strip('timestamp')}, '') as timestamp"]
    parts += [f"{_pyfloat(c)} as {c}" for c in A]
    parts += [f"{_pyint(c)} as {c}" for c in D]
    return ", ".join(parts)


def q(body: str, stream: bool = False) -> str:
    return f"with {ctes(stream)}\n{body}"


PRED_COLS = list(C.PREDICTION_COLS)
PRED_DOUBLES = {"anomaly_score", "threshold_used", "TP2", "Motor_current", "Oil_temperature", "DV_pressure",
                "pressure_diff_TP2_TP3", "motor_oil_ratio", "rolling_mean_TP2", "rolling_mean_motor"}
FEATURE_OUT = SENSOR + ["row_idx"] + C.DERIVED_COLS + C.ROLLING_COLS


def _pct(part: str, whole: str) -> str:
    return f"100e0 * {part} / nullif(cast({whole} as double), 0e0)"


def _validate() -> str:
    def counts(table: str, src: str, rules) -> str:
        cases = ", ".join(f"case when {rule.split(':')[0]} is null then '{rule}' end" for rule in rules)
        return (f"select '{table}' as table_name, rule, count(*) as violations from "
                f"(select unnest(list_value({cases})) as rule from {src}) where rule is not null group by rule")
    return q(counts(C.RAW_TABLE, "coerced", RAW_NULLS) + " union all " + counts(C.PREDICTIONS_TABLE, "preds", PREDICTION_NULLS))


def _cluster_quality(src: str) -> str:
    return (f"select cluster, count(*) as size, {r('avg(anomaly_score)', 'mean_dist')}, "
            f"{r('coalesce(stddev_samp(anomaly_score), 0e0)', 'std_dist')} from {src} group by cluster")


def _fault_breakdown(src: str) -> str:
    return (f"select fault_hint, count, {r(_pct('count', 'sum(count) over ()'), 'pct')} from "
            f"(select fault_hint, count(*) as count from {src} where is_anomaly group by fault_hint)")


def _quality_body() -> str:
    rate = _pct("a", "n")
    gap = "(ma - mn)"
    strong = f"coalesce({gap} > {sql_double(C.STRONG_GAP)}, false)"
    agg = ("(select count(*) as n, count_if(is_anomaly) as a, "
           "avg(case when not is_anomaly then anomaly_score end) as mn, "
           "avg(case when is_anomaly then anomaly_score end) as ma from test) agg_")
    return f"""select 'anomaly_rate' as "check",
       case when {rate} >= {sql_double(C.RATE_LOW_PCT)} and {rate} <= {sql_double(C.RATE_HIGH_PCT)}
            then 'PASS' else 'WARN' end as status,
       {r(rate, 'value')},
       case when {rate} < {sql_double(C.RATE_LOW_PCT)} then 'rate below healthy range, threshold may be too strict'
            when {rate} > {sql_double(C.RATE_HIGH_PCT)} then 'rate above healthy range, threshold may be too lenient'
            when {rate} is null then 'no rows' else 'rate in healthy range' end as note
from {agg}
union all
select 'class_separation', case when {strong} then 'PASS' else 'WARN' end, {r(gap, 'value')},
       case when {strong} then 'strong class separation' else 'weak class separation' end
from {agg}"""


def _sections() -> dict[str, str]:
    pcts = ", ".join(f"quantile_disc(anomaly_score, {sql_double(p)}) as p{int(round(p * 100))}" for p in C.PERCENTILES)
    pct_round = ", ".join(r(f"p{int(round(p * 100))}") for p in C.PERCENTILES)
    breaches = ", ".join(f"count_if({c} {op} {sql_double(v)}) as breach_{c}" for _, c, op, v in FAULTS)
    return {
        "dataset_overview": (f"select n as total_records, n - a as normal_records, a as anomaly_records, "
                             f"round(100e0 - {_pct('a', 'n')}, 6) + 0e0 as normal_pct, round({_pct('a', 'n')}, 6) "
                             f"+ 0e0 as anomaly_pct, round((select threshold from thr), 6) + 0e0 as threshold from "
                             f"(select count(*) as n, count_if(is_anomaly) as a from test)"),
        "score_distribution": (f"select {r('score_mean')}, {r('score_std')}, {r('score_min')}, {r('score_max')}, "
                               f"{pct_round} from (select avg(anomaly_score) as score_mean, "
                               f"stddev_samp(anomaly_score) as score_std, min(anomaly_score) as score_min, "
                               f"max(anomaly_score) as score_max, {pcts} from test)"),
        "class_separation": (f"select {r('normal_mean')}, {r('anomaly_mean')}, {r('anomaly_mean - normal_mean', 'gap')},"
                             f" case when anomaly_mean - normal_mean is null then 'NO_ANOMALIES' "
                             f"when anomaly_mean - normal_mean > {sql_double(C.GOOD_GAP_FACTOR)} * "
                             f"(select threshold from thr) then 'GOOD' else 'LOW' end as verdict from "
                             f"(select avg(case when not is_anomaly then anomaly_score end) as normal_mean, "
                             f"avg(case when is_anomaly then anomaly_score end) as anomaly_mean from test)"),
        "cluster_quality": _cluster_quality("test"),
        "wcss_proxy": ("select round(coalesce(sum(m * s), 0e0), 6) + 0e0 as wcss_proxy from "
                       "(select avg(anomaly_score) as m, count(*) as s from test group by cluster)"),
        "fault_breakdown": _fault_breakdown("test"),
        "sensor_breaches": f"select {breaches} from test",
        "quality_checks": _quality_body(),
    }


def _evaluation_report() -> str:
    sec = _sections()

    def tidy(section, src, key, metrics, note="cast(null as varchar)"):
        return [f"select '{section}' as section, cast({key} as varchar) as key, '{m}' as metric, "
                f"round(cast({m} as double), 6) + 0e0 as value, {note} as note from ({src})" for m in metrics]

    parts = []
    parts += tidy("overview", sec["dataset_overview"], "''", ["total_records", "normal_records", "anomaly_records",
                                                              "normal_pct", "anomaly_pct", "threshold"])
    parts += tidy("score_distribution", sec["score_distribution"], "''",
                  ["score_mean", "score_std", "score_min", "score_max"]
                  + [f"p{int(round(p * 100))}" for p in C.PERCENTILES])
    parts += tidy("class_separation", sec["class_separation"], "''", ["normal_mean", "anomaly_mean", "gap"],
                  "verdict")
    parts += tidy("cluster_quality", sec["cluster_quality"], "cluster", ["size", "mean_dist", "std_dist"])
    parts += tidy("cluster_quality", sec["wcss_proxy"], "''", ["wcss_proxy"])
    parts += tidy("fault_breakdown", sec["fault_breakdown"], "fault_hint", ["count", "pct"])
    parts += tidy("sensor_breaches", sec["sensor_breaches"], "''", [f"breach_{c}" for _, c, _, _ in FAULTS])
    parts += tidy("quality_checks", sec["quality_checks"], '"check"', ["value"], "status")
    return q("\nunion all\n".join(parts))


def oracle_sql() -> dict[str, str]:
    sections = _sections()
    sensor_sel = sel(SENSOR, DOUBLES)
    landed = ", ".join(
            f"case when event_id % 50 <> 7 then round(TP3, 6) + 0e0 end as TP3" if c == "TP3" else r(c) if c in DOUBLES else c
            for c in A + D)
    pred_sel = sel(PRED_COLS, PRED_DOUBLES)
    breach_flags = ", ".join(f"{c} {op} {sql_double(v)} as breach_{c}" for _, c, op, v in FAULTS)
    as_of_alert = f"timestamp '{ALERT_AS_OF}' - interval {C.ALERT_WINDOW_MINUTES} minute"
    ts_summary = ("select '{name}' as table_name, {ncols} as n_columns, '{names}' as column_names, count(*) as records, "
                  "min({ts}) as first_ts, max({ts}) as last_ts, {anom} as anomalies, "
                  "round({pct}, 6) + 0e0 as anomaly_pct from {src}")
    sensor_names = ",".join(SENSOR)
    pred_names = ",".join(PRED_COLS)

    def kpis(hours: str, t: str, where: str) -> str:
        return (f"select cast({hours} as integer) as hours, {t} as threshold, total_records, anomalies, "
                f"round({_pct('anomalies', 'total_records')}, 6) + 0e0 as anomaly_pct, round(avg_score, 6) + 0e0 as avg_score, "
                f"round(latest_score, 6) + 0e0 as latest_score, case when latest_score > {t} then 'ANOMALY' else 'NORMAL' end as status "
                f"from (select count(*) as total_records, count_if(anomaly_score > {t}) as anomalies, avg(anomaly_score) as avg_score, "
                f"arg_max(anomaly_score, source_timestamp) as latest_score from preds {where})")

    levels = ("30e-1", "60e-1", "62e-1", "975e-2", "150e-1")
    last_hours = "where source_timestamp >= (select max(source_timestamp) from preds) - interval 6 hour"
    return {
        # 2.1
        "read_raw": q(f"select {sensor_sel} from sensor"),
        "coerce_sensor_rows": q(f"select event_id, {sel(A + D, DOUBLES)} from coerced"),
        "resolve_timestamp": q("select event_id, try_cast(timestamp as timestamp) as ts from coerced "
                               "where timestamp is not null"),
        "ingest_counts": q("select count_if(timestamp is not null) as inserted, count_if(timestamp is null) as skipped "
                           "from coerced"),
        "stamp_ingest": q(f"select event_id, timestamp '{PROCESSED_AT}' as _loaded_at from coerced "
                          f"where timestamp is not null"),
        "validate_schema": _validate(),
        "decode_json": q("select event_id, " + ", ".join(
            f"case when event_id % 50 <> 3{' and event_id % 50 <> 7' if c == 'TP3' else ''} then "
            f"{f'round({c}, 6) + 0e0' if c in A else c} end as {c}" for c in A + D) + ", event_id % 50 = 3 as corrupt from sensor"),
        "encode_json": q(f"select event_id, ts, {sel(A + D, DOUBLES)} from sensor"),
        # 2.2
        "drop_incomplete": q(f"select {sensor_sel} from clean"),
        "cap_rows": q(f"select event_id, row_idx from idx where row_idx < {CAP}"),
        "pressure_diff_TP2_TP3": q("select event_id, round(TP2 - TP3, 6) + 0e0 as pressure_diff_TP2_TP3 from clean"),
        "pressure_diff_H1_DV": q("select event_id, round(H1 - DV_pressure, 6) + 0e0 as pressure_diff_H1_DV from clean"),
        "motor_oil_ratio": q("select event_id, round(Motor_current / nullif(Oil_temperature + 1e0, 0e0), 6) "
                             "as motor_oil_ratio from clean"),
        "fill_zero": q("select event_id, ts, asset_id, "
                       + ", ".join(f"round(coalesce(case when isnan({c}) then 0e0 else {c} end, 0e0), 6) + 0e0 as {c}"
                                   for c in A)
                       + ", " + ", ".join(f"coalesce({c}, 0) as {c}" for c in D) + " from sensor"),
        "flag_anomaly": q("select event_id, data_split, is_anomaly from labeled"),
        "fault_hint": q("select event_id, is_anomaly, fault_hint from labeled"),
        "sensor_breach_flags": q(f"select event_id, {breach_flags} from clean"),
        "prediction_projection": q(f"select {pred_sel} from preds"),
        "stamp_run": q(f"select event_id, round(threshold, 6) + 0e0 as threshold_used, timestamp '{PROCESSED_AT}' as "
                       f"processed_at, '{RUN_ID}' as spark_run_id, 'demo' as data_split from labeled "
                       f"where data_split = 'demo'"),
        "recent_sensor_slice": q(f"select {sensor_sel} from sensor where ts >= (select max(ts) from sensor) - "
                                 f"interval {C.DEFAULT_RECENT_HOURS} hour"),
        "recent_prediction_slice": q(f"select {pred_sel} from preds where source_timestamp >= "
                                     f"(select max(source_timestamp) from preds) - interval "
                                     f"{C.DEFAULT_RECENT_HOURS} hour"),
        "parse_timestamp": q(f"select event_id, try_cast({_strip('timestamp')} as timestamp) as ts from rawtext"),
        "rethreshold": q(f"select source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, "
                         f"anomaly_score > {sql_double(C.DASHBOARD_THRESHOLD)} as is_anomaly, fault_hint from preds"),
        "score_series": q("select source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, anomaly_score > 6e0 as is_anomaly "
                          "from preds"),
        "anomaly_points": q("select source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, fault_hint "
                            "from preds where anomaly_score > 6e0"),
        "sensor_signals": q("select ts, sensor, round(value, 6) + 0e0 as value from (select ts, 'TP2' as sensor, TP2 as value "
                            "from sensor union all select ts, 'Motor_current', Motor_current from sensor union all "
                            "select ts, 'Oil_temperature', Oil_temperature from sensor)"),
        "recent_alerts": q(f"select source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, fault_hint from preds "
                           f"where is_anomaly and processed_at >= {as_of_alert} order by source_timestamp desc "
                           f"limit {C.ALERTS_SHOWN}"),
        "alert_count": q(f"select count(*) as alerts from preds where is_anomaly and processed_at >= {as_of_alert}"),
        # 2.3
        "rolling_mean_TP2": q("select event_id, round(rolling_mean_TP2, 6) + 0e0 as rolling_mean_TP2 from feat"),
        "rolling_std_TP2": q("select event_id, round(rolling_std_TP2, 6) + 0e0 as rolling_std_TP2 from feat"),
        "rolling_mean_motor": q("select event_id, round(rolling_mean_motor, 6) + 0e0 as rolling_mean_motor from feat"),
        "rolling_std_motor": q("select event_id, round(rolling_std_motor, 6) + 0e0 as rolling_std_motor from feat"),
        "engineer_features": q(f"select {sel(FEATURE_OUT, DOUBLES)} from feat"),
        "row_index": q("select event_id, row_idx from idx"),
        "temporal_split": q("select event_id, row_idx, data_split from split"),
        # 2.4
        "scale_features": q("select event_id, " + ", ".join(
            f"round(coalesce(({f} - (select avg({f}) from split where data_split = 'train')) / "
            f"nullif((select stddev_samp({f}) from split where data_split = 'train'), 0e0), 0e0), 6) + 0e0 as z_{f}"
            for f in C.EXTENDED_COLS) + " from split where data_split = 'test'"),
        "assemble_features": q("select event_id, " + ", ".join(r(f, f"raw_{f}") for f in C.EXTENDED_COLS)
                               + " from split where data_split = 'test'"),
        "assign_cluster": q("select event_id, cluster from labeled"),
        "anomaly_score": q("select event_id, cluster, round(anomaly_score, 6) + 0e0 as anomaly_score from labeled"),
        "fit_threshold": q("select round(score_mean, 6) + 0e0 as score_mean, round(score_std, 6) + 0e0 as score_std, "
                           "round(threshold, 6) + 0e0 as threshold from thr"),
        # 2.5
        "stage_counts": q("select 'raw' as stage, count(*) as rows from sensor union all "
                          "select 'clean', count(*) from clean union all select 'featured', count(*) from feat "
                          "union all select data_split, count(*) from split group by data_split"),
        "dataset_overview": q(sections["dataset_overview"]),
        "score_distribution": q(sections["score_distribution"]),
        "class_separation": q(sections["class_separation"]),
        "cluster_quality": q(sections["cluster_quality"]),
        "wcss_proxy": q(sections["wcss_proxy"]),
        "fault_breakdown": q(sections["fault_breakdown"]),
        "sensor_breaches": q(sections["sensor_breaches"]),
        "quality_checks": q(sections["quality_checks"]),
        "evaluation_report": _evaluation_report(),
        "run_summary": q(f"select '{RUN_ID}' as spark_run_id, count(*) as records_processed, "
                         f"count_if(is_anomaly) as anomalies_found, "
                         f"round({_pct('count_if(is_anomaly)', 'count(*)')}, 6) + 0e0 as anomaly_pct, "
                         f"round((select threshold from thr), 6) + 0e0 as threshold_used "
                         f"from labeled where data_split = 'demo'"),
        "table_summary": q(
            ts_summary.format(name=C.RAW_TABLE, ncols=len(SENSOR), names=sensor_names, ts="ts",
                              anom="cast(null as bigint)", pct="cast(null as double)", src="sensor")
            + " union all "
            + ts_summary.format(name=C.PREDICTIONS_TABLE, ncols=len(PRED_COLS), names=pred_names, ts="source_timestamp",
                                anom="count_if(is_anomaly)", pct=_pct("count_if(is_anomaly)", "count(*)"), src="preds")
            + " union all select 'run_log', 7, 'spark_run_id,processed_at,records_processed,anomalies_found,threshold_used,"
              f"model_loaded_from_cache,data_split', 1, timestamp '{PROCESSED_AT}', timestamp '{PROCESSED_AT}', null, null"),
        "dashboard": q("select total_records, anomalies, " + r(_pct("anomalies", "total_records"), "anomaly_pct") + ", "
                       + r("avg_score") + ", " + r("latest_score") + ", case when latest_score > 6e0 then 'ANOMALY' else 'NORMAL' end as status "
                       "from (select count(*) as total_records, count_if(anomaly_score > 6e0) as anomalies, avg(anomaly_score) as avg_score, "
                       "arg_max(anomaly_score, source_timestamp) as latest_score from preds "
                       "where source_timestamp >= (select max(source_timestamp) from preds) - interval 6 hour)"),
        "freshness_check": q("select count(*) as records from sensor"),
        "dashboard_kpis": q(f"select total_records, anomalies, round({_pct('anomalies', 'total_records')}, 6) + 0e0 as "
                            f"anomaly_pct, round(avg_score, 6) + 0e0 as avg_score, round(latest_score, 6) + 0e0 as latest_score, "
                            f"case when latest_score > {sql_double(C.DASHBOARD_THRESHOLD)} then 'ANOMALY' else 'NORMAL' "
                            f"end as status from (select count(*) as total_records, count_if(anomaly_score > "
                            f"{sql_double(C.DASHBOARD_THRESHOLD)}) as anomalies, avg(anomaly_score) as avg_score, "
                            f"arg_max(anomaly_score, source_timestamp) as latest_score from preds)"),
        "fault_distribution": q(f"select fault_hint, count(*) as count from preds where anomaly_score > "
                                f"{sql_double(C.DASHBOARD_THRESHOLD)} group by fault_hint"),
        "score": q("select event_id, cluster, round(anomaly_score, 6) + 0e0 as anomaly_score, is_anomaly, fault_hint from test"),
        "fit_kmeans": q("select count(*) as train_rows, 8 as clusters, true as none_empty from split where data_split = 'train'"),
        "train_model": q("select 8 as k, 14 as n_features, round(avg(TP2), 6) + 0e0 as mean_TP2, round(stddev_samp(TP2), 6) + 0e0 as std_TP2, "
                         "true as threshold_holds from split where data_split = 'train'"),
        # sinks, streams and jobs (round trips)
        "load_model": q("select event_id, cluster, round(anomaly_score, 6) + 0e0 as anomaly_score, round(threshold, 6) + 0e0 as threshold from test"),
        "run_batch": q(f"select {pred_sel} from preds"),
        "run_checks": q(f"select (select count(*) from sensor) as landed_rows, (select count(*) from clean) as job_rows, "
                        f"(select count(*) from preds) as demo_rows, (select count(*) from preds where is_anomaly and "
                        f"processed_at >= {as_of_alert}) as alerts, least(5, (select count(*) from preds where is_anomaly)) as shown"),
        "write_raw_batches": q(f"select {sensor_sel} from sensor"),
        "append_predictions": q(f"select {pred_sel} from preds"),
        "save_report": _evaluation_report(),
        "load_raw": q(f"select try_cast(timestamp as timestamp) as ts, {sel(A + D, DOUBLES)}, "
                      f"timestamp '{PROCESSED_AT}' as _loaded_at from coerced where timestamp is not null"),
        "append_run_log": q(f"select '{RUN_ID}' as spark_run_id, count(*) as records_processed, "
                            f"count_if(is_anomaly) as anomalies_found, "
                            f"round((select threshold from thr), 6) + 0e0 as threshold_used, "
                            f"false as model_loaded_from_cache, 'demo' as data_split "
                            f"from labeled where data_split = 'demo'"),
        "stream_ingest": q(f"select ts, {landed}, cast(null as varchar) as reason from sensor where event_id % 50 not in (3, 11) "
                          "union all select null, " + ", ".join("null" for _ in A + D)
                          + ", case when event_id % 50 = 3 then 'not_json' else 'no_timestamp' end from sensor "
                            "where event_id % 50 in (3, 11)"),
        # those that the last watermark has passed, with the frames of the readings that were not late
        "stream_score": q("select ts as source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, is_anomaly, "
                          "fault_hint, cluster as cluster_id, round(rolling_mean_TP2, 6) + 0e0 as rolling_mean_TP2, "
                          "round(rolling_mean_motor, 6) + 0e0 as rolling_mean_motor "
                          "from s_labeled where ts <= (select max(mark) from passed)", stream=True),
        "stream_once": q(f"select ts, {sel(A + D, DOUBLES)} from sensor"),
        "replay_batch": q(f"select ts, {sel(A + D, DOUBLES)}, cast((row_number() over (order by ts, event_id) - 1) // ((count(*) over () + 11) // 12) as int) as run from sensor"),
        # 2.6
        "latest_n": q(f"select {sensor_sel} from sensor order by ts desc limit {C.RECENT_LIMIT}"),
        "last_alerts": q(f"select source_timestamp, round(anomaly_score, 6) + 0e0 as anomaly_score, fault_hint from preds "
                         f"where anomaly_score > 6e0 order by source_timestamp desc limit {C.LAST_ALERTS}"),
        "sample_record": q(f"select {sensor_sel} from sensor order by ts, event_id limit 1"),
        "zone_summary": q(
            ts_summary.format(name=C.RAW_TABLE, ncols=len(SENSOR), names=sensor_names, ts="ts",
                              anom="cast(null as bigint)", pct="cast(null as double)", src="sensor")
            + " union all "
            + ts_summary.format(name=C.PREDICTIONS_TABLE, ncols=len(PRED_COLS), names=pred_names, ts="source_timestamp",
                                anom="count_if(is_anomaly)", pct=_pct("count_if(is_anomaly)", "count(*)"), src="preds")),
        "zone_recent_slice": q(f"select {sensor_sel} from sensor where ts >= (select max(ts) from sensor) - interval 6 hour"),
        "zone_latest_n": q(f"select {sensor_sel} from sensor order by ts desc limit 5000"),
        "partial_kpis": q(" union all ".join([kpis("null", t, "") for t in levels] + [kpis("6", t, last_hours) for t in levels])),
        "partial_faults": q(" union all ".join(f"select {t} as threshold, fault_hint, count(*) as count from preds where anomaly_score > {t} "
                                               "group by fault_hint" for t in levels)),
        "time_bounds": q("select min(ts) as first_ts, max(ts) as last_ts from sensor"),
        "clusters_by_id": q(_cluster_quality("labeled")),
        "faults_by_count": q(_fault_breakdown("labeled")),
    }
