"""Zone names for trips, by pickup and by drop-off place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 1_000_000
# A place with this share of the trips is heavy; a sketch of fixed size finds them.
HEAVY_SHARE = 0.01
MOST_HEAVY = 100
SALTS = 64
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024

# role -> (trip column with the place, column to add)
ROLES = {
    "dropoff": ("dolocation_id", "dropoff_zone"),
    "pickup": ("pulocation_id", "pickup_zone"),
}


@dataclass(frozen=True)
class DimensionFacts:
    rows: int
    name_bytes: int
    most_copies: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROW_LIMIT and self.name_bytes <= BROADCAST_BYTE_LIMIT


def dimension_facts(zones: DataFrame) -> DimensionFacts:
    """Size and key uniqueness of a zone dimension, measured in one distributed job."""
    per_key = (
        zones.filter(F.col("LocationID").isNotNull())
        .groupBy("LocationID")
        .agg(F.count("*").alias("copies"), F.sum(F.octet_length("Zone")).alias("bytes"))
    )
    row = per_key.agg(
        F.sum("copies").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.max("copies").alias("most"),
    ).first()
    return DimensionFacts(row["rows"] or 0, row["bytes"] or 0, row["most"] or 0)


def enrich_zones(
    trips: DataFrame,
    zones: DataFrame,
    roles: Sequence[str] = ("pickup", "dropoff"),
    facts: DimensionFacts | None = None,
    heavy: Mapping[str, Sequence[int]] | None = None,
) -> DataFrame:
    """Left-join the zone name for each role; a trip without a known place keeps a null zone.

    The dimension is measured first. A repeated key would multiply trips, so it is refused.
    A dimension inside the limits is broadcast. A larger one is joined by shuffle, where
    adaptive execution splits a partition that one place has made too large. With the
    ``heavy_places`` of the trips these are dealt out before the shuffle, and so are trips
    without a place, which adaptive execution cannot tell from a heavy key.
    """
    facts = facts or dimension_facts(zones)
    if facts.most_copies > 1:
        raise ValueError(f"a LocationID occurs {facts.most_copies} times in the zone dimension")
    joined = trips
    for role in roles:
        place, zone_name = ROLES[role]
        named = zones.select(F.col("LocationID").alias(place), F.col("Zone").alias(zone_name))
        if facts.fits_broadcast:
            joined = joined.join(F.broadcast(named), on=place, how="left")
        elif heavy is None:
            joined = joined.join(named, on=place, how="left")
        else:
            joined = _salted(joined, named, place, heavy.get(role, ()))
    return joined


def heavy_places(trips: DataFrame, roles: Sequence[str] = ("pickup", "dropoff")) -> dict[str, list[int]]:
    """Places that hold a large share of the trips, for ``enrich_zones``.

    One pass over the place columns with a sketch of fixed size per role; it may name a few places
    too many, which costs copies of their dimension rows, but leaves no heavy one out.
    """
    sketches = [F.call_function("approx_top_k", F.col(ROLES[role][0]), F.lit(MOST_HEAVY), F.lit(100 * MOST_HEAVY)).alias(role) for role in roles]
    row = trips.agg(F.count("*").alias("trips"), *sketches).first()
    least = HEAVY_SHARE * row["trips"]
    return {role: [top["item"] for top in row[role] if top["item"] is not None and top["count"] >= least] for role in roles}


def _salted(trips: DataFrame, named: DataFrame, place: str, heavy: Sequence[int]) -> DataFrame:
    """A left join in which heavy places, and trips without one, are dealt to ``SALTS`` groups each.

    Rows of the dimension are copied only for heavy places. The salt is a hash of the trip, so a
    repeated task gives the same one.
    """
    known = F.col(place).isin(list(heavy))
    deal = F.pmod(F.xxhash64(*trips.columns), F.lit(SALTS)).cast("int")
    salted = trips.withColumn("_salt", F.when(F.col(place).isNull() | known, deal).otherwise(0))
    salts = F.when(known, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = named.withColumn("_salt", F.explode(salts))
    return salted.join(copies, [place, "_salt"], "left").drop("_salt")
