from __future__ import annotations

import numpy as np
import pytest

from sunframe.operators.thermal import thermal_model
from sunframe.queries import QUERIES
from sunframe.streaming.telemetry import COLUMNS, hourly, thermal_stream
from tests.conftest import SF


def test_hourly_stream_equals_batch(spark):
    stream = {r["t"]: r["n"] for r in QUERIES["stream_hourly"](spark, SF).collect()}
    batch = {r["t"]: r["n"] for r in QUERIES["resample_hourly"](spark, SF).collect()}
    assert stream == batch


def test_late_events_beyond_the_watermark_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "event_id long, ts timestamp, user_id long, value double"
    for k, hours in enumerate((["2024-01-01 00:10", "2024-01-01 00:50"], ["2024-01-02 00:00"], ["2024-01-01 00:30", "2024-01-03 00:00"], ["2024-01-04 00:00"])):
        rows = [(k, h, 1, 2.0) for h in hours]
        spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double").selectExpr("event_id", "cast(ts as timestamp) ts", "user_id", "value").coalesce(1).write.mode("append").parquet(folder)
        q = hourly(spark.readStream.schema(schema).parquet(folder)).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {str(r["ts"]): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["2024-01-01 00:00:00"] == 2


@pytest.mark.parametrize("holes", [False, True])
def test_thermal_stream_equals_batch_one_row_late(spark, tmp_path, holes):
    r = np.random.default_rng(0)
    rows = [(s, i, float(r.uniform(0, 1)), float(r.uniform(0, 30)), float(r.uniform(0, 8)), 1010.0, 0.5, 20.0) for s in "ab" for i in range(12)]
    if holes:  # at the start, within and across the files; None and NaN
        gone = {("a", 0): 2, ("a", 1): 7, ("a", 4): 3, ("a", 5): 3, ("b", 3): 5, ("b", 8): 6, ("b", 9): 4}
        rows = [(*row[: gone[row[:2]]], None if row[1] % 2 else float("nan"), *row[gone[row[:2]] + 1 :]) if row[:2] in gone else row for row in rows]
    df = spark.createDataFrame(rows, COLUMNS)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    store = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for low in (0, 5, 9):
            high = {0: 5, 5: 9, 9: 12}[low]
            df.filter(f"rn >= {low} and rn < {high}").coalesce(1).write.mode("append").parquet(folder)
            q = thermal_stream(spark.readStream.schema(df.schema).parquet(folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.conf.unset(store)
    got = {(x["series"], x["rn"]): x["temp_module_rp"] for x in spark.read.parquet(out).collect()}
    want = {(x["series"], x["rn"]): x["temp_module_rp"] for x in thermal_model(df, series="series").collect() if x["rn"] < 11}
    assert set(got) == set(want) and {k for k, v in got.items() if v is None} == {k for k, v in want.items() if v is None}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want if want[k] is not None)
    assert (sum(v is None for v in want.values()) == 7) == holes
