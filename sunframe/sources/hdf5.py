"""HDF5 telemetry as a Python data source: one partition a block of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

#: Rows of one partition, and of one Arrow batch.
ROWS, BATCH = 1 << 20, 1 << 16


class HDF5Source(DataSource):
    """Group ``DATA``: ``axis0`` column names, ``axis1`` epoch nanoseconds, ``block0_values`` rows of values."""

    @classmethod
    def name(cls) -> str:
        return "sunframe_hdf5"

    def _names(self) -> list[str]:
        import h5py

        with h5py.File(self.options["path"]) as f:
            return [n.decode() if isinstance(n, bytes) else str(n) for n in f["DATA/axis0"][:]]

    def schema(self) -> StructType:
        return StructType([StructField("ts", LongType())] + [StructField(n, DoubleType()) for n in self._names()])

    def reader(self, schema: StructType) -> DataSourceReader:
        return HDF5Reader(self.options["path"])


class HDF5Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        import h5py

        with h5py.File(self.path) as f:
            n = f["DATA/axis1"].shape[0]
        return [InputPartition(i) for i in range(0, max(n, 1), ROWS)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """A block of rows as Arrow batches; only so many rows of the file are in memory."""
        import h5py

        with h5py.File(self.path) as f:
            names = ["ts", *(n.decode() if isinstance(n, bytes) else str(n) for n in f["DATA/axis0"][:])]
            ts, values = f["DATA/axis1"], f["DATA/block0_values"]
            for at in range(partition.value, min(partition.value + ROWS, ts.shape[0]), BATCH):
                rows = slice(at, min(at + BATCH, partition.value + ROWS))
                block = np.asarray(values[rows], float)
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(ts[rows], np.int64)), *(pa.array(np.ascontiguousarray(c)) for c in block.T)], names)
