"""Row numbers and halo buckets: windows over one long series without one long task.

A window over a single series would send all rows to one task. Instead rows are numbered by a range
sort (each partition counts for itself and adds the counts of those before), dealt to buckets of
consecutive rows, and the rows near a border are copied to the neighbour that needs them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sunframe.sources.scratch import materialised

#: Rows of a bucket: enough for any halo, small enough for a task.
BUCKET_ROWS = 1 << 17


def numbered(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """``df`` with ``name``, its place (from 0) in ascending ``order``, nulls first. Ties are broken arbitrarily but once.

    No task sees more than its range: only one count a partition is gathered.
    """
    local, part = f"_{name}_local", f"_{name}_part"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(local, F.monotonically_increasing_id())
    placed = materialised(placed.withColumns({part: F.shiftright(local, 33), local: F.col(local).bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    counts = placed.groupBy(part).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col(part).alias("_p"), before.alias("_before"))
    return placed.join(F.broadcast(offsets), F.col(part) == F.col("_p")).withColumn(name, F.col(local) + F.col("_before")).drop(local, part, "_p", "_before")


def with_halo(df: DataFrame, lag: int, lead: int, rn: str = "rn", rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``bucket`` and ``owned``: windows by bucket see ``lag`` rows before and ``lead`` after each owned row.

    Every row is owned once; at most one copy goes to either neighbour.
    """
    if max(lag, lead) > rows:
        raise ValueError(f"a halo of {max(lag, lead)} rows needs buckets of at least as many")
    home, at = F.floor(F.col(rn) / rows), F.pmod(F.col(rn), F.lit(rows))
    near = F.array_compact(F.array(home, F.when(at >= rows - lag, home + 1), F.when((at < lead) & (home > 0), home - 1)))
    return df.withColumn("bucket", F.explode(near)).withColumn("owned", F.col("bucket") == F.floor(F.col(rn) / rows))


def bucket_window(rn: str = "rn") -> WindowSpec:
    return Window.partitionBy("bucket").orderBy(rn)


def owned(df: DataFrame, keep_bucket: bool = False) -> DataFrame:
    """The rows of :func:`with_halo` without their copies."""
    return df.filter("owned").drop(*(["owned"] if keep_bucket else ["bucket", "owned"]))


def has_halo(df: DataFrame) -> bool:
    return {"bucket", "owned"} <= set(df.columns)


def numbered_in_buckets(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` (with ``bucket``) and ``name``, its place in ``order``: rows of a lower bucket come first.

    A row's place in its bucket comes from the windows that are there; one count a bucket makes it the
    place in the whole. So nothing is sorted or dealt anew.
    """
    local = f"_{name}_local"
    placed = materialised(df.withColumn(local, F.row_number().over(bucket_window(order)) - 1), "placed")
    before = F.coalesce(F.sum("count").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = placed.groupBy("bucket").count().select(F.col("bucket").alias("_p"), before.alias("_before"))
    # One row a bucket of BUCKET_ROWS rows.
    return placed.join(F.broadcast(offsets), F.col("bucket") == F.col("_p")).withColumn(name, F.col(local) + F.col("_before")).drop(local, "bucket", "_p", "_before")
