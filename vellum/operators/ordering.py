"""Rows in a total order, with their positions (S3, O1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellum.session import cut_lineage


def with_positions(rows: DataFrame, key: str, weight: Column | None = None, partitions: int | None = None,
                   position: str = "position", before: str = "before") -> DataFrame:
    """The rows sorted by ``key``, with their place from 0 (``position``) and,
    given a ``weight``, the sum of the weights of the rows before them.

    Ranges of the key are cut by Spark's range partitioner and stored, with
    their number, so that a lost task reads the same cut again. Counts and sums
    run inside a range; what comes before a range is a sum over the totals,
    one row a range. No window sees all rows. Repeated keys fall into one
    range; their order is that of the other columns, and of equal rows any.
    Null keys come first, a null weight counts as 0; other columns are kept,
    ``position`` and ``before`` are written anew; an empty table stays empty.
    """
    spark = rows.sparkSession
    number = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                               spark.sparkContext.defaultParallelism)
    rows = rows.drop(position, before)
    columns = rows.columns
    amount = F.coalesce(weight.cast("bigint"), F.lit(0).cast("bigint")) if weight is not None else F.lit(0).cast("bigint")
    # ties are dealt by all columns that can be sorted, so a hot key is cut as well
    order = [key, *(c for c, t in rows.dtypes if c != key and not t.startswith(("map", "variant")))]
    ranged = rows.withColumn("__weight", amount).repartitionByRange(number, *[F.col(f"`{c}`") for c in order])
    stored = cut_lineage(ranged.withColumn("__range", F.spark_partition_id()), spark)
    totals = stored.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"), F.sum("__weight").alias("__sum"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = totals.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"),
                           F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy(*[F.col(f"`{c}`") for c in order])
    placed = stored.withColumns({
        "__at": F.row_number().over(inside),
        "__inside": F.coalesce(F.sum("__weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    out = placed.join(F.broadcast(starts), "__range").withColumn(
        position, (F.col("__first") + F.col("__at") - 1).cast("bigint"))
    if weight is None:
        return out.select(*columns, position)
    return out.withColumn(before, (F.col("__start") + F.col("__inside")).cast("bigint")).select(*columns, position, before)
