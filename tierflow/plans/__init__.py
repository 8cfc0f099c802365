"""Plan shapes that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def counts(column: str, values: dict[str, tuple[str, ...] | str]) -> list[Column]:
    """One conditional count per name: all of a report's counters in one aggregate."""
    out = []
    for name, wanted in values.items():
        wanted = (wanted,) if isinstance(wanted, str) else wanted
        out.append(F.count_if(F.col(column).isin(*wanted)).alias(name))
    return out


def ratio(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage rounded half up; 0 where the whole is 0."""
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def preagg_left_join(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """Counts ``right`` by key before joining: a correlated count in a grouped select, as one aggregate and one join."""
    n = right.groupBy(key).agg(F.count("*").alias(name))
    return left.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def chain(model, *extra: str) -> DataFrame:
    """Projects with their body and district: columns p_*, lb_*, d_* chosen by name."""
    p = model.projects.select(*(F.col(c).alias(f"p_{c}") for c in model.projects.columns))
    lb = model.bodies.select(*(F.col(c).alias(f"lb_{c}") for c in model.bodies.columns))
    d = model.districts.select(*(F.col(c).alias(f"d_{c}") for c in model.districts.columns))
    out = p.join(lb, F.col("p_local_body_id") == F.col("lb_id")).join(d, F.col("lb_district_id") == F.col("d_id"))
    return out.select(*extra) if extra else out


def bodies_with_district(model) -> DataFrame:
    lb = model.bodies.select(*(F.col(c).alias(f"lb_{c}") for c in model.bodies.columns))
    d = model.districts.select(*(F.col(c).alias(f"d_{c}") for c in model.districts.columns))
    return lb.join(d, F.col("lb_district_id") == F.col("d_id"))
