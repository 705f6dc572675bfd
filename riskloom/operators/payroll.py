"""Employees x payroll with overtime pay.

``pay = h * r`` for ``h <= 40``; ``(h - 40) * 1.5 * r + 40 * r`` above; NULL
hours give NULL pay (no ``otherwise``).  Inner equi-join: duplicate keys
multiply, NULL keys drop.  The employee side is broadcast only when its row
count (footer-only for a table scan) proves it small; otherwise a sort-merge
join, where AQE splits a hot employee's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, ExecConfig
from .joins import broadcast_dimension

STANDARD_HOURS = 40
OVERTIME_RATE = 1.5


def pay_expr(hours, rate):
    return (F.when(hours <= STANDARD_HOURS, hours * rate)
             .when(hours > STANDARD_HOURS, (hours - STANDARD_HOURS) * OVERTIME_RATE * rate + STANDARD_HOURS * rate))


def overtime_pay(employees: DataFrame, payroll: DataFrame, exec_cfg: ExecConfig = DEFAULT_EXEC) -> DataFrame:
    e = broadcast_dimension(employees.select("employee_id", "name"), exec_cfg.max_broadcast_dim_rows).alias("e")
    p = payroll.select("employee_id", "hours_worked", "hourly_rate", "position").alias("p")
    joined = p.join(e, F.col("e.employee_id") == F.col("p.employee_id"), "inner")
    return joined.select(
        F.col("e.employee_id").alias("employee_id"),
        F.col("e.name").alias("name"),
        pay_expr(F.col("p.hours_worked"), F.col("p.hourly_rate")).alias("pay"),
        F.col("p.position").alias("position"),
    )
