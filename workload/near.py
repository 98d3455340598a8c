"""Estimated rollups held against exact ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.operators import rollup


def compare(exact: DataFrame, estimate: DataFrame, dims: list[str], counts: list[str], bins: list[str] = ()) -> DataFrame:
    """``exact`` with ``<name>_near``: whether the estimate lies within its stated error of the exact count.

    Distinct counts are estimated with 5 % standard deviation (three of them, or 1, are allowed); a histogram must hold every value.
    """
    known = estimate.select(*[F.col(d).alias(f"e_{d}") for d in dims], *[F.col(c).alias(f"e_{c}") for c in [*counts, *bins]])
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"e_{d}")) for d in dims])
    near = {f"{c}_near": F.abs(F.col(f"e_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 0.15 * F.col(c)) for c in counts}
    near |= {f"{b}_near": F.aggregate(f"e_{b}", F.lit(0).cast("bigint"), lambda a, x: a + x) == F.col(f"{b}_inside") for b in bins}
    return exact.join(known, same, "left").withColumns(near).select(*exact.columns, *near)


def near_exact(df: DataFrame, spec: rollup.RollupSpec, extra_dims: tuple[str, ...] = ()) -> DataFrame:
    exact = rollup.rollup(df, spec, "exact", extra_dims=extra_dims)
    counts = [name for name, (kind, _) in spec.aggs.items() if kind == "distinct"]
    bins = [name for name, (kind, _) in spec.aggs.items() if kind == "histogram"]
    made = set(spec.aggs) | {f"{b}_{side}" for b in bins for side in ("below", "above", "inside")}
    return compare(exact, rollup.rollup(df, spec, extra_dims=extra_dims), [c for c in exact.columns if c not in made], counts, bins)


def near_sql(exact: str, spec: rollup.RollupSpec) -> str:
    names = [name for name, (kind, _) in spec.aggs.items() if kind in ("distinct", "histogram")]
    return f"select *, {', '.join(f'true as {n}_near' for n in names)} from ({exact}) exact_rows"
