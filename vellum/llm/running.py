"""Running sums inside segments, with no window over a whole segment.

Rows are sorted by range, so that a segment that holds a third of all rows
lies in many parts; a window runs inside (segment, part) only, and the totals
of a segment's earlier parts are added by a join. Rows whose order columns are
equal fall in one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellum.session import shared_path


def stored(df: DataFrame, *names: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and
    survives lost executors."""
    path = shared_path(df.sparkSession, *names, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running(df: DataFrame, segment: list[str], order: list[str], values: dict[str, tuple[str, callable]]) -> DataFrame:
    """Add, for each name in ``values``, the aggregate (F.sum, F.bit_xor, ...)
    of a column over the rows up to and with this one in its segment.
    ``order`` columns have nulls first; both lists name non-null or null-safe
    sortable columns. Empty tables stay empty."""
    keys = [F.col(c).asc_nulls_first() for c in (*segment, *order)]
    parts = stored(df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), "running", "parts")
    inside = Window.partitionBy(*segment, "__part").orderBy(*keys[len(segment):]).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumns({name: how(F.col(source)).over(inside) for name, (source, how) in values.items()})
    totals = parts.groupBy(*segment, "__part").agg(*(how(F.col(source)).alias(f"__{name}") for name, (source, how) in values.items()))
    earlier = Window.partitionBy(*segment).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*segment, "__part", *(how(F.col(f"__{name}")).over(earlier).alias(f"__{name}") for name, (_, how) in values.items()))
    both = local.join(carry, [*segment, "__part"])
    added = {name: _plus(how, F.col(name), F.coalesce(F.col(f"__{name}"), F.lit(0))) for name, (_, how) in values.items()}
    return both.withColumns(added).drop("__part", *(f"__{name}" for name in values))


def _plus(how, a: Column, b: Column) -> Column:
    if how is F.bit_xor:
        return a.bitwiseXOR(b)
    if how is F.sum:
        return a + b
    raise ValueError("only F.sum and F.bit_xor have a carry")
