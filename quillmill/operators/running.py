"""Running totals and surrogate ids without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.session import written

#: monotonically_increasing_id() keeps the task above this bit and the row inside it below
TASK_BITS = 33


def laid_in_order(df: DataFrame, order: Sequence[str | Column], out: str, purpose: str = "in-order", parts: int | None = None) -> DataFrame:
    """The rows with ``out``, a number that grows along ``order`` and is different for every row, with gaps.

    Ranges of the order are dealt out, so that neither a key nor a group meets in one task, and the
    numbers are written with the rows: reading them again gives the same ones. Rows equal in the whole order
    are told apart by chance, so ``order`` has to name all that later steps tell rows apart by.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(placed.withColumn(out, F.monotonically_increasing_id()), purpose)


def ranked(placed: DataFrame, at: str, out: str, by: Sequence[str] = (), groups: DataFrame | None = None) -> DataFrame:
    """Add ``out``: how many rows of the same ``by`` stand before the row along ``at`` (from ``laid_in_order``).

    The order has to begin with ``by``. What meets in one window is a count for each task that holds rows of
    the group; without ``by`` the counts, one row a task, go by the driver. ``groups`` has one row for each
    ``by`` with further columns: they come along with the counts, so that no join has a group as its key.
    """
    task = F.shiftright(F.col(at), TASK_BITS)
    counts = placed.groupBy(*by, task.alias("_task")).agg(F.count("*").alias("_rows"), F.min(at).alias("_first"))
    further = [c for c in groups.columns if c not in by] if groups is not None else []
    if by:
        before = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        if further:
            known = groups.select(*[F.col(k).alias(f"_in_{k}") for k in by], *further)
            counts = counts.join(known, [F.col(k).eqNullSafe(F.col(f"_in_{k}")) for k in by])
    else:
        total, told = 0, []
        for row in sorted(counts.collect(), key=lambda r: r["_task"]):  # one row a task
            told.append((row["_task"], row["_first"], total))
            total += row["_rows"]
        counts = F.broadcast(placed.sparkSession.createDataFrame(told, "_task bigint, _first bigint, _before bigint"))
    starts = counts.select(*[F.col(k).alias(f"_of_{k}") for k in by], F.col("_task"), "_first", "_before", *further)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]
    joined = placed.join(starts, [task == F.col("_task"), *same])
    return joined.select(*[F.col(c) for c in [*placed.columns, *further]], (F.col("_before") + F.col(at) - F.col("_first")).alias(out))


def running_total(
    df: DataFrame,
    value: Column,
    order: str,
    out: str,
    by: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int = 65536,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows (by the integer column ``order``,
    then ``ties``).

    A plain window would put every row of a group, or of the whole table, into one task.
    Here rows are cut into ranges of ``width`` order values; only one subtotal per range
    meets in a window, and the rest is done inside the ranges.
    """
    keys = list(by)
    ranged = df.withColumn("_range", F.expr(f"`{order}` div {width}")).withColumn("_value", value)
    subtotals = ranged.groupBy(*keys, "_range").agg(F.sum("_value").alias("_subtotal"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = subtotals.select(
        *[F.col(k).alias(f"_of_{k}") for k in [*keys, "_range"]],
        F.coalesce(F.sum("_subtotal").over(before), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_range"]]
    joined = ranged.join(offsets, same, "inner").select(*ranged.columns, "_offset")
    total = F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return joined.withColumn(out, total).drop("_range", "_value", "_offset")


def assign_ids(df: DataFrame, order: str, out: str, after: Column | int = 0, ties: Sequence[str] = ()) -> DataFrame:
    """Serial ids in arrival order, from ``after`` + 1 without gaps.

    ``order`` is the arrival number, of any type that can be ordered and however sparse; ``ties`` tell rows of one arrival
    apart. Rows are laid in order by ranges, and a task's rows are numbered from how many stand before it.
    """
    after = after if isinstance(after, Column) else F.lit(after)
    placed = laid_in_order(df, [order, *ties], "_at", "numbered")
    ids = (after + F.col("_rank") + 1).cast("bigint")
    return ranked(placed, "_at", "_rank").select(*[c for c in df.columns if c != out], ids.alias(out))
