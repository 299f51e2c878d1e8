"""What the corpus operators share: session set-up, shared-folder tables, Arrow maps."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.session import prepared
from sunframe.sources.scratch import materialised as written
from sunframe.sources.scratch import remove, shared_path

__all__ = ["begin", "forgotten", "fresh", "give_back", "id_and_text", "map_texts", "prepare", "release", "remove", "shared_path", "small", "spread_join", "table", "text_column", "text_filter", "written"]

#: Rows and bytes of one Arrow batch: bounds a worker's memory when texts are long.
TEXT_BATCH_ROWS, TEXT_BATCH_BYTES = 2000, 32 << 20

#: A key is hot with over so many rows, and over one row in so many: so there are never more hot keys than the latter.
HOT_ROWS, HOT_KEYS = 1_000_000, 10_000
#: Rows of two numbers that may be broadcast.
MOST_BROADCAST = 1_000_000

_UPPER = bytes(range(65, 91))
ASCII_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches and let Python workers find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))
    return prepared(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession, path: str | None = None) -> None:
    """Give back disk that nothing needs any more: ``path``, and the shuffle files of frames out of reach."""
    gc.collect()
    spark._jvm.System.gc()
    if path:
        remove(spark, path)


#: What a worker process remembers from task to task, as functions that forget it, and the operator it last worked for.
_FORGET: list[Callable[[], object]] = []
_OWNER = [""]


def forgotten(forget: Callable[[], object]) -> None:
    """``forget`` is called when a worker process passes to another operator."""
    _FORGET.append(forget)


def begin(owner: str) -> None:
    """A task of ``owner`` begins: Spark keeps worker processes, so what they remember for another operator goes."""
    if _OWNER[0] != owner:
        _OWNER[0] = owner
        for forget in _FORGET:
            forget()
        give_back()


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where the allocators can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until it clashes with no column."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read; everything else stays in the file."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list[str | None]], list[pa.Array]]], schema: str) -> DataFrame:
    """``doc_id`` and, for each text, the columns of ``schema``; ``make()`` runs once a task."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(make.__module__)
        work = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1).to_pylist())], ["doc_id", *names])

    return id_and_text(docs).mapInArrow(run, f"doc_id long, {schema}")


def text_filter(docs: DataFrame, make: Callable[[], Callable[[list[str | None]], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text ``make()`` accepts."""
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begin(make.__module__)
        work = make()
        for part in parts:
            yield pd.Series(work([x if isinstance(x, str) else None for x in part]), dtype=bool)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.filter(F.pandas_udf(run, "boolean")(text_column(docs)))


def text_column(docs: DataFrame) -> Column:
    return docs["text"].cast("string")


def spread_join(many: DataFrame, one: DataFrame, on: dict[str, str], how: str = "inner", salt: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``many.join(one)`` where columns of ``many`` equal those of ``one`` (``on``), whatever share of ``many`` one key holds.

    Rows of a hot key are dealt to parts by ``salt`` (a hash of all columns unless given) and the rows of
    ``one`` with it are copied to every part. ``many`` should be a written table: it is counted first.
    The two must have no column names in common; ``how`` is inner or left.
    """
    limit = max(hot_rows, many.count() // HOT_KEYS)
    part, parts, copy = (fresh(n, [*many.columns, *one.columns]) for n in ("salt_part", "salt_parts", "salt_copy"))
    keys = list(on)
    hot = many.groupBy(*keys).count().filter(F.col("count") > limit)
    hot = written(hot.select(*[F.col(k).alias(f"hot_{i}") for i, k in enumerate(keys)], F.ceil(F.col("count") / limit).cast("int").alias(parts)), "hot-keys")
    if hot.isEmpty():
        return many.join(one, [many[a] == one[b] for a, b in on.items()], how)
    hot = F.broadcast(hot)  # at most HOT_KEYS rows
    dealt = F.pmod(F.xxhash64(*many.columns) if salt is None else salt, F.coalesce(F.col(parts), F.lit(1)).cast("long")).cast("int")
    left = many.join(hot, [many[k] == F.col(f"hot_{i}") for i, k in enumerate(keys)], "left").select(*many.columns, dealt.alias(part))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))
    right = one.join(hot, [one[b] == F.col(f"hot_{i}") for i, b in enumerate(on.values())], "left").select(*one.columns, copies.alias(copy))
    met = left.join(right, [*[left[a] == right[b] for a, b in on.items()], left[part] == right[copy]], how)
    return met.drop(part, copy)


def small(keys: DataFrame, most: int | None = None) -> DataFrame | None:
    """``keys`` (a written table of a few numbers a row) marked for broadcast if it has at most ``most`` rows, else None."""
    limit = MOST_BROADCAST if most is None else most
    return F.broadcast(keys) if keys.limit(limit + 1).count() <= limit else None
