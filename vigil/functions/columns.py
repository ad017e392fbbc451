"""Column expressions: all built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import config as C

_OPS = {"<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}

# Number text accepted the way Python's float() accepts it: surrounding
# whitespace, sign, digits with single underscores between them, optional
# fraction and exponent, or inf / infinity / nan in any case.
NUMBER_PATTERN = (r"^[+-]?((([0-9](_?[0-9])*)?\.[0-9](_?[0-9])*|[0-9](_?[0-9])*\.?)([eE][+-]?[0-9](_?[0-9])*)?"
                  r"|(?i:inf|infinity|nan))$")
WHITESPACE = " \t\n\x0b\x0c\r"


def pressure_diff_tp2_tp3() -> Column:
    return (F.col("TP2") - F.col("TP3")).alias("pressure_diff_TP2_TP3")


def pressure_diff_h1_dv() -> Column:
    return (F.col("H1") - F.col("DV_pressure")).alias("pressure_diff_H1_DV")


def motor_oil_ratio() -> Column:
    # ANSI mode raises on x/0; the original gave NULL (later filled with 0.0).
    return F.try_divide(F.col("Motor_current"), F.col("Oil_temperature") + F.lit(1.0)).alias("motor_oil_ratio")


def derived_columns() -> list[Column]:
    return [pressure_diff_tp2_tp3(), pressure_diff_h1_dv(), motor_oil_ratio()]


def rule_condition(col_name: str, op: str, value: float) -> Column:
    return _OPS[op](F.col(col_name), F.lit(value))


def fault_label(rules: Sequence = C.FAULT_RULES) -> Column:
    """First matching rule wins; GENERAL_ANOMALY when none fires."""
    expr = None
    for label, col_name, op, value in rules:
        cond = rule_condition(col_name, op, value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.FAULT_OTHER))


def fault_hint(is_anomaly: Column | None = None, rules: Sequence = C.FAULT_RULES) -> Column:
    flag = F.col("is_anomaly") if is_anomaly is None else is_anomaly
    return F.when(flag, fault_label(rules)).otherwise(F.lit(C.FAULT_NONE)).alias("fault_hint")


def breach_flags(rules: Sequence = C.FAULT_RULES) -> list[Column]:
    """One boolean column per rule, named ``breach_<sensor>``."""
    return [rule_condition(c, op, v).alias(f"breach_{c}") for _, c, op, v in rules]


def strip_ws(c: Column) -> Column:
    """Trim ASCII whitespace at both ends (no regex)."""
    return F.btrim(c, F.lit(WHITESPACE))


def float_of_stripped(s: Column) -> Column:
    """Stripped text to double with float() acceptance rules; anything else is NULL.

    Pass a column reference (not an expression): the text is used twice.
    """
    low = F.lower(s)
    # Within the accepted shapes only inf / infinity / nan contain an "n"; they are mapped
    # here because Spark's cast knows no signed nan.
    special = (F.when(low.endswith("nan"), F.lit(float("nan")))
               .when(s.startswith("-"), F.lit(float("-inf")))
               .otherwise(F.lit(float("inf"))))
    number = F.replace(s, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(s.rlike(NUMBER_PATTERN), F.when(low.contains("n"), special).otherwise(number))


def int_of_double(d: Column) -> Column:
    """int(): truncate toward zero; NaN, inf or out-of-range is NULL. Pass a column reference."""
    return F.when(~F.isnan(d), d.try_cast("int"))


def python_float(c: Column) -> Column:
    return float_of_stripped(strip_ws(c))


def python_int_of_float(c: Column) -> Column:
    return int_of_double(python_float(c))


def scaled_expr(name: str, mean: float, std: float) -> Column:
    """z-score with a fixed mean and sample stddev; a constant feature maps to 0.0."""
    if std == 0.0 or std != std:
        return F.lit(0.0)
    return (F.col(name) - F.lit(mean)) / F.lit(std)


def squared_distance(cols: Sequence[Column], center: Sequence[float]) -> Column:
    terms = [(c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(cols, center)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def nearest_center(dist_cols: Sequence[str]) -> tuple[Column, Column]:
    """(cluster, distance) from per-center squared-distance columns; first index wins a tie.

    The distances are plain arithmetic over a fixed number of centers,
    generated once on the driver: no UDF, no vector type, fully code-generated.
    """
    best = F.least(*[F.col(d) for d in dist_cols]) if len(dist_cols) > 1 else F.col(dist_cols[0])
    cluster = None
    for j, d in enumerate(dist_cols):
        cluster = F.when(F.col(d) == best, F.lit(j)) if cluster is None else cluster.when(F.col(d) == best, F.lit(j))
    return cluster.cast("int"), F.sqrt(best)


def sql_double(v: float) -> str:
    """A double literal that parses to exactly ``v`` in Spark SQL and DuckDB."""
    r = repr(float(v))
    return r if "e" in r else f"{r}e0"
