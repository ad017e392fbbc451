"""Evaluation and run reports as tidy DataFrames.

Each report is one aggregation pass (conditional aggregates), never one job
per number; group-level results are at most k or a handful of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config as C
from vigil.functions import columns as X
from vigil.session import write_table


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def dataset_overview(labeled: DataFrame, threshold: float) -> DataFrame:
    agg = labeled.agg(F.count(F.lit(1)).alias("total_records"),
                      F.count_if(F.col("is_anomaly")).alias("anomaly_records"))
    return agg.select(
        "total_records",
        (F.col("total_records") - F.col("anomaly_records")).alias("normal_records"),
        "anomaly_records",
        (F.lit(100.0) - _pct(F.col("anomaly_records"), F.col("total_records"))).alias("normal_pct"),
        _pct(F.col("anomaly_records"), F.col("total_records")).alias("anomaly_pct"),
        F.lit(float(threshold)).alias("threshold"),
    )


SKETCH_K = 4096                     # a sketch of about 100 kB, whatever the number of rows
RANK_ERROR = 0.004                  # share of the rows by which a bracket reaches below and above its rank: three times the sketch's error
FEW_VALUES = 65_536                 # different values of all brackets that the driver takes; more are selected in Spark


def quantile_sketch(value: Column) -> Column:
    """A mergeable quantile sketch (KLL) of the values that are numbers: an aggregate like any other of the same scan."""
    return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(SKETCH_K))


def _kth(counts: DataFrame, k: int) -> float | None:
    """The k-th smallest of values ``v`` that stand ``c`` times each: ranges of values are counted, and the one that holds it again."""
    n, low, high = counts.agg(F.sum("c"), F.min("v"), F.max("v")).first()
    v = F.col("v")
    while low < high:
        if math.isinf(low) or math.isinf(high):
            place = (v > F.lit(low)).cast("long") + (v >= F.lit(high)).cast("long")
        elif (width := high / 4096 - low / 4096) > 0:
            place = F.greatest(F.lit(0), F.least(F.floor(v / F.lit(width) - F.lit(low / width)), F.lit(4095)))
        else:
            place = (v > F.lit(low)).cast("long")
        parts = counts.filter(v.between(F.lit(low), F.lit(high))).groupBy(place.alias("p")).agg(
            F.sum("c").alias("c"), F.min("v").alias("a"), F.max("v").alias("b")).orderBy("p").collect()        # 4,096 rows at most
        for row in parts:
            if k <= row["c"]:
                break
            k -= row["c"]
        low, high = row["a"], row["b"]
    return low


def exact_quantiles(df: DataFrame, col: str, quantiles=C.PERCENTILES, sketch: bytes | None = None, few: int = FEW_VALUES) -> list[float | None]:
    """The values at rank ``ceil(q n)``, exact at any size, from two scans whatever the number of ranks: one for the sketch
    (none, if the caller has it from a scan of its own), one that counts.

    The sketch gives every rank a bracket of values. The second scan counts, in one aggregation, the rows between the
    brackets and, within them, the rows of each value; the sum of the counts up to a bracket says which of its values has the
    rank. A rank outside its bracket (a sketch is a matter of chance) is looked for in a wider one. NULL and NaN are no
    values.
    """
    v = F.col(col).cast("double")
    if sketch is None:
        sketch = df.agg(quantile_sketch(v).alias("s")).first()["s"]
    spark = df.sparkSession

    def asked(expression: str):
        """Of the sketch, which is a row of constants: no job runs."""
        return spark.sql(f"select {expression} as x from values (X'{bytes(sketch).hex()}') as t(s)").first()["x"]

    n = asked("kll_sketch_get_n_double(s)") if sketch is not None else 0
    if not n:
        return [None] * len(quantiles)
    ranks = {q: max(1, n - math.floor(n - q * n)) for q in quantiles}
    found: dict[int, float] = {}
    reach = RANK_ERROR
    while len(found) < len(set(ranks.values())):
        left = sorted({r for r in ranks.values() if r not in found})
        at = [min(1.0, max(0.0, r / n + d)) for r in left for d in (-reach, reach)]
        ends = asked(f"kll_sketch_get_quantile_double(s, array({', '.join(f'{x!r}d' for x in at)}))")
        # an end of the sketch's range is no bound: a bracket that reaches it is open
        spans = [(-math.inf if lo <= 0 else a, math.inf if hi >= 1 else b)
                 for lo, hi, a, b in zip(at[::2], at[1::2], ends[::2], ends[1::2], strict=True)]
        merged: list[list[float]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        # 2 i + 1 within bracket i, 2 i before it: the first condition that holds, so that the value is computed once
        x, place = F.col("v"), F.when(F.isnan("v"), F.lit(None))
        for i, (a, b) in enumerate(merged):
            place = place.when(x < F.lit(a), F.lit(2 * i)).when(x <= F.lit(b), F.lit(2 * i + 1))
        place = place.when(x.isNotNull(), F.lit(2 * len(merged)))
        counts = df.select(v.alias("v")).groupBy(place.alias("p"), F.when(place % 2 == 1, x).alias("v")).agg(
            F.count(F.lit(1)).alias("c"))           # no filter on it: that would be pushed below the score, and repeat it
        few_rows = n * 2 * reach * len(left) <= few         # the brackets hold about that many rows, so no more values
        rows = counts.coalesce(1).limit(few + 1).collect() if few_rows else None        # one part: one job
        held = None
        if rows is None or len(rows) > few:
            held = write_table(counts, "bracket-counts")    # a small share of the rows; the input is not read again
            rows = held.groupBy("p").agg(F.sum("c").alias("c")).collect()
        sums: dict[int, int] = {}
        rows = [r for r in rows if r["p"] is not None]
        for r in rows:
            sums[r["p"]] = sums.get(r["p"], 0) + r["c"]
        for rank in left:
            below = 0
            for p in sorted(sums):
                if below + sums[p] >= rank:
                    break
                below += sums[p]
            if p % 2 == 0:
                continue                                    # between the brackets
            if held is not None:
                found[rank] = _kth(held.filter(F.col("p") == p), rank - below)
            else:
                for r in sorted((r for r in rows if r["p"] == p), key=lambda r: r["v"]):
                    below += r["c"]
                    if below >= rank:
                        break
                found[rank] = r["v"]
        reach *= 8
    return [found[ranks[q]] for q in quantiles]


def score_distribution(labeled: DataFrame, percentiles=C.PERCENTILES) -> DataFrame:
    """Moments and exact percentiles: one scan for moments and sketch, one for the percentiles (``exact_quantiles``)."""
    s = F.col("anomaly_score")
    names = ["score_mean", "score_std", "score_min", "score_max", *(f"p{int(round(p * 100))}" for p in percentiles)]
    row = labeled.agg(F.avg(s), F.stddev_samp(s), F.min(s), F.max(s), quantile_sketch(s)).first()
    values = [*row[:4], *exact_quantiles(labeled, "anomaly_score", percentiles, row[4])]
    return labeled.sparkSession.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))


def class_separation(labeled: DataFrame, threshold: float) -> DataFrame:
    s = F.col("anomaly_score")
    agg = labeled.agg(F.avg(F.when(~F.col("is_anomaly"), s)).alias("normal_mean"),
                      F.avg(F.when(F.col("is_anomaly"), s)).alias("anomaly_mean"))
    gap = F.col("anomaly_mean") - F.col("normal_mean")
    return agg.select("normal_mean", "anomaly_mean", gap.alias("gap"),
                      F.when(gap.isNull(), F.lit("NO_ANOMALIES"))
                      .when(gap > F.lit(C.GOOD_GAP_FACTOR * float(threshold)), F.lit("GOOD"))
                      .otherwise(F.lit("LOW")).alias("verdict"))


def cluster_quality(labeled: DataFrame) -> DataFrame:
    """Per cluster: size, mean and sample stddev of the distance (one row -> 0.0)."""
    s = F.col("anomaly_score")
    return (labeled.groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("size"), F.avg(s).alias("mean_dist"),
                 F.coalesce(F.stddev_samp(s), F.lit(0.0)).alias("std_dist"))
            .orderBy("cluster"))


def wcss_proxy(labeled: DataFrame) -> DataFrame:
    """Sum over clusters of mean distance * size (unsquared distances)."""
    per = cluster_quality(labeled)
    return per.agg(F.coalesce(F.sum(F.col("mean_dist") * F.col("size")), F.lit(0.0)).alias("wcss_proxy"))


def fault_breakdown(labeled: DataFrame) -> DataFrame:
    """Anomalies by label with share of all anomalies; most frequent first, ties by label.

    The total comes from a window over the grouped result, which has at most
    one row per rule label.
    """
    counts = (labeled.filter(F.col("is_anomaly")).groupBy("fault_hint").agg(F.count(F.lit(1)).alias("count")))
    total = F.sum("count").over(Window.partitionBy())
    return (counts.select("fault_hint", "count", _pct(F.col("count"), total).alias("pct"))
            .orderBy(F.desc("count"), F.asc("fault_hint")))


def sensor_breaches(df: DataFrame, rules=C.FAULT_RULES) -> DataFrame:
    """Rows of the split beyond each rule bound, in one pass."""
    return df.agg(*[F.count_if(X.rule_condition(c, op, v)).alias(f"breach_{c}") for _, c, op, v in rules])


def quality_checks(labeled: DataFrame) -> DataFrame:
    """Rate and separation checks as (check, status, value, note) rows, from one aggregate pass."""
    s = F.col("anomaly_score")
    one = labeled.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("is_anomaly")).alias("_a"),
                      F.avg(F.when(~F.col("is_anomaly"), s)).alias("_mn"),
                      F.avg(F.when(F.col("is_anomaly"), s)).alias("_ma"))
    rate = _pct(F.col("_a"), F.col("_n"))
    gap = F.col("_ma") - F.col("_mn")
    rate_status = (F.when((rate >= F.lit(C.RATE_LOW_PCT)) & (rate <= F.lit(C.RATE_HIGH_PCT)), F.lit("PASS"))
                   .otherwise(F.lit("WARN")))
    rate_note = (F.when(rate < F.lit(C.RATE_LOW_PCT), F.lit("rate below healthy range, threshold may be too strict"))
                 .when(rate > F.lit(C.RATE_HIGH_PCT), F.lit("rate above healthy range, threshold may be too lenient"))
                 .when(rate.isNull(), F.lit("no rows"))
                 .otherwise(F.lit("rate in healthy range")))
    strong = F.coalesce(gap > F.lit(C.STRONG_GAP), F.lit(False))
    rows = F.array(
        F.struct(F.lit("anomaly_rate").alias("check"), rate_status.alias("status"), rate.alias("value"),
                 rate_note.alias("note")),
        F.struct(F.lit("class_separation").alias("check"),
                 F.when(strong, F.lit("PASS")).otherwise(F.lit("WARN")).alias("status"), gap.alias("value"),
                 F.when(strong, F.lit("strong class separation")).otherwise(F.lit("weak class separation"))
                 .alias("note")),
    )
    return one.select(F.inline(rows))


def evaluation_report(labeled: DataFrame, threshold: float, percentiles=C.PERCENTILES,
                      rules=C.FAULT_RULES) -> DataFrame:
    """All sections in one tidy table ``(section, key, metric, value, note)`` from two scans: one for all metrics and the
    sketch of the scores, one for the exact percentiles.

    A single grouping-sets aggregation computes the overall metrics (grouping
    set ``()``), the per-cluster metrics (``(cluster)``) and the per-label
    anomaly counts (``(fault_hint)``); partial aggregation happens before the
    only shuffle, whose output is 1 + k + (labels) rows. These go through the driver (the
    sketch of the overall row says where the percentiles are looked for) and are then
    reshaped; fault shares use a window over those rows only.
    """
    s = F.col("anomaly_score")
    anom = F.col("is_anomaly")
    pct_names = [f"p{int(round(p * 100))}" for p in percentiles]
    breach_names = [f"breach_{c}" for _, c, _, _ in rules]
    aggs = [
        F.count(F.lit(1)).alias("n"), F.count_if(anom).alias("a"),
        F.avg(s).alias("score_mean"), F.stddev_samp(s).alias("score_std"),
        F.min(s).alias("score_min"), F.max(s).alias("score_max"),
        F.avg(F.when(~anom, s)).alias("normal_mean"), F.avg(F.when(anom, s)).alias("anomaly_mean"),
        *[F.count_if(X.rule_condition(c, op, v)).alias(f"breach_{c}") for _, c, op, v in rules],
    ]
    g = (labeled.groupingSets([[], ["cluster"], ["fault_hint"]], "cluster", "fault_hint")
         .agg(*aggs, F.grouping_id().alias("_gid"), quantile_sketch(s).alias("_sketch")))
    few = g.collect()                                     # 1 + k + labels rows
    sketch = next((r["_sketch"] for r in few if r["_gid"] == 3), None)
    exact = exact_quantiles(labeled, "anomaly_score", percentiles, sketch)
    kept = [f for f in g.schema.fields if f.name != "_sketch"]
    g = labeled.sparkSession.createDataFrame([tuple(r[f.name] for f in kept) for r in few], T.StructType(kept))
    # _gid: 3 = overall, 1 = per cluster (fault_hint rolled up), 2 = per label (cluster rolled up)
    everything = Window.partitionBy()                     # over the 1 + k + labels result rows only
    g = g.withColumns({
        "_total_a": F.max(F.when(F.col("_gid") == 3, F.col("a"))).over(everything),
        "_wcss": F.sum(F.when(F.col("_gid") == 1, F.col("score_mean") * F.col("n"))).over(everything),
    })

    def rows(metrics: list[tuple[str, Column]], key: Column, section: str, note: Column | None = None):
        nt = note if note is not None else F.lit(None).cast("string")
        return F.array(*[F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"),
                                  F.lit(m).alias("metric"), v.cast("double").alias("value"), nt.alias("note"))
                         for m, v in metrics])

    n, a = F.col("n"), F.col("a")
    rate = _pct(a, n)
    gap = F.col("anomaly_mean") - F.col("normal_mean")
    verdict = (F.when(gap.isNull(), F.lit("NO_ANOMALIES"))
               .when(gap > F.lit(C.GOOD_GAP_FACTOR * float(threshold)), F.lit("GOOD")).otherwise(F.lit("LOW")))
    rate_status = (F.when((rate >= F.lit(C.RATE_LOW_PCT)) & (rate <= F.lit(C.RATE_HIGH_PCT)), F.lit("PASS"))
                   .otherwise(F.lit("WARN")))
    sep_status = F.when(F.coalesce(gap > F.lit(C.STRONG_GAP), F.lit(False)), F.lit("PASS")).otherwise(F.lit("WARN"))
    blank = F.lit("")
    overall = F.concat(
        rows([("total_records", n), ("normal_records", n - a), ("anomaly_records", a),
              ("normal_pct", F.lit(100.0) - rate), ("anomaly_pct", rate), ("threshold", F.lit(float(threshold)))],
             blank, "overview"),
        rows([("score_mean", F.col("score_mean")), ("score_std", F.col("score_std")),
              ("score_min", F.col("score_min")), ("score_max", F.col("score_max"))]
             + [(nm, F.lit(v)) for nm, v in zip(pct_names, exact)], blank, "score_distribution"),
        rows([("normal_mean", F.col("normal_mean")), ("anomaly_mean", F.col("anomaly_mean")), ("gap", gap)],
             blank, "class_separation", verdict),
        rows([("wcss_proxy", F.coalesce(F.col("_wcss"), F.lit(0.0)))], blank, "cluster_quality"),
        rows([(b, F.col(b)) for b in breach_names], blank, "sensor_breaches"),
        rows([("value", rate)], F.lit("anomaly_rate"), "quality_checks", rate_status),
        rows([("value", gap)], F.lit("class_separation"), "quality_checks", sep_status),
    )
    per_cluster = rows([("size", n), ("mean_dist", F.col("score_mean")),
                        ("std_dist", F.coalesce(F.col("score_std"), F.lit(0.0)))], F.col("cluster"), "cluster_quality")
    per_label = rows([("count", a), ("pct", _pct(a, F.col("_total_a")))], F.col("fault_hint"), "fault_breakdown")
    out = g.select(F.explode(
        F.when(F.col("_gid") == 3, overall)
        .when(F.col("_gid") == 1, per_cluster)
        .when((F.col("_gid") == 2) & (a > 0), per_label)).alias("r"))
    return out.select("r.*")


def stage_counts(raw: DataFrame, clean: DataFrame, labeled: DataFrame) -> DataFrame:
    """Rows per stage: raw, clean, featured and per split, as (stage, rows)."""
    def total(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("rows"))

    per_split = labeled.groupBy(F.col("data_split").alias("stage")).agg(F.count(F.lit(1)).alias("rows"))
    return total(raw, "raw").unionByName(total(clean, "clean")).unionByName(total(labeled, "featured")) \
        .unionByName(per_split)


def run_summary(labeled: DataFrame, threshold: float, run_id: str) -> DataFrame:
    agg = labeled.agg(F.count(F.lit(1)).alias("records_processed"),
                      F.count_if(F.col("is_anomaly")).alias("anomalies_found"))
    return agg.select(F.lit(run_id).alias("spark_run_id"), "records_processed", "anomalies_found",
                      _pct(F.col("anomalies_found"), F.col("records_processed")).alias("anomaly_pct"),
                      F.lit(float(threshold)).alias("threshold_used"))


def table_summary(df: DataFrame, name: str, ts_col: str) -> DataFrame:
    """Rows, time bounds and (for predictions) anomaly count and share of one table."""
    aggs = [F.count(F.lit(1)).alias("records"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts")]
    has_flag = "is_anomaly" in df.columns
    if has_flag:
        aggs.append(F.count_if(F.col("is_anomaly")).alias("anomalies"))
    return summary_row(df.agg(*aggs), name, df.columns, has_flag)


def summary_row(totals: DataFrame, name: str, columns: list[str], has_flag: bool) -> DataFrame:
    """The summary of a table from its ``totals`` (records, first_ts, last_ts and, with a flag, anomalies)."""
    anomalies = F.col("anomalies") if has_flag else F.lit(None).cast("long")
    return totals.select(F.lit(name).alias("table_name"), F.lit(len(columns)).alias("n_columns"),
                         F.lit(",".join(columns)).alias("column_names"), "records", "first_ts", "last_ts",
                         anomalies.alias("anomalies"), _pct(anomalies, F.col("records")).alias("anomaly_pct"))


def freshness(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def freshness_check(df: DataFrame) -> int:
    """Raise when the landed table is empty; otherwise return its row count."""
    n = freshness(df).first()["records"]
    if n == 0:
        raise ValueError("no records found: ingestion may have failed")
    return int(n)
