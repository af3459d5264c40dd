"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _role(zones: DataFrame, key: str, names: dict[str, str], role: str) -> DataFrame:
    return zones.select(
        F.col(key).alias(f"__{role}"), *[F.col(c).alias(f"{role}_{n}") for c, n in names.items()]
    )


def enrich_zones(
    trips: DataFrame,
    zones: DataFrame,
    pickup: str | None = "PULocationID",
    dropoff: str | None = "DOLocationID",
    key: str = "LocationID",
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Look one zone table up twice, as the pickup and as the dropoff zone.

    Trips without a match keep NULL names. ``names`` maps zone columns to the
    suffix they get behind ``pickup_`` and ``dropoff_``. A role without a column is
    left out. Spark picks the join by its own statistics of the zone table, and
    splits hot zones of a shuffle join. Works on streams as well, with a static zone table.
    """
    names = names or {"Zone": "zone", "Borough": "borough", "service_zone": "service_zone"}
    names = {c: n for c, n in names.items() if c in zones.columns}
    lookup = zones.select(key, *names)
    out = trips
    for role, col in (("pickup", pickup), ("dropoff", dropoff)):
        if col is None:
            continue
        side = _role(lookup, key, names, role)
        out = out.join(side, out[col] == side[f"__{role}"], "left").drop(f"__{role}")
    return out
