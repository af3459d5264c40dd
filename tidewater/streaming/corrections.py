"""Gold tables that late rows correct.

A windowed aggregate behind a watermark closes its windows once and leaves late rows out. Here a window is never
closed: each micro-batch adds its new rows to silver and writes the gold windows of the days it touches anew, from what silver
holds of these days. Nothing is kept between batches, rows may be late by any time, and a batch that is retried finds its
rows in silver and writes the same windows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.gold import gold_zone_hour_window
from tidewater.sinks import overwrite_partitions
from tidewater.streaming.layers import append_batch


def corrected_gold(
    rows: DataFrame,
    silver: str,
    gold: str,
    checkpoint: str,
    keys: list[str],
    ts: str = "pickup_ts",
    zone: str = "pickup_zone",
    fare: str = "fare_amount",
    trigger: str | None = None,
) -> StreamingQuery:
    """Start keeping a silver and a gold table up to date with a stream.

    ``keys`` tell rows apart and include ``ts``; copies are dropped whenever they come. Gold has trips and average
    fare per zone and hour, partitioned by ``gold_day``; only the partitions of a batch's days are read and replaced. Hours do
    not cross days as long as the session's time zone is whole hours from UTC. Rows without a time are in silver only.
    """
    if ts not in keys:
        raise ValueError(f"{ts} has to be one of the keys, so that copies are found on one day")

    def write(batch: DataFrame, _: int) -> None:
        days = append_batch(batch, silver, keys, ts)
        if not days:
            return
        held = batch.sparkSession.read.parquet(silver).filter(F.col(f"{ts}_day").isin(days))
        windows = gold_zone_hour_window(held, zone, ts, fare)
        overwrite_partitions(windows.withColumn("gold_day", F.to_date("pickup_hour")), gold, "gold_day")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
