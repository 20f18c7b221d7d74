"""Which aircraft models the airlines of a country fly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import flown
from skyledger.operators.joins import broadcast_if_small, fits_broadcast
from skyledger.operators.profiling import rows_per
from skyledger.operators.ranking import first_within, ranked_within
from skyledger.sources.colocated import SLICE

TIES = ("keep", "exact")


def flights_per_tail(
    flights: DataFrame,
    airlines: DataFrame,
    *,
    country: str | None = None,
    flown_only: bool = True,
) -> DataFrame:
    """Flights per airline and tail: name, carrier_code, tail_number, country, count.

    A few airlines are broadcast, which drops the flights of all others at the scan.
    Otherwise the flights are counted per (carrier, tail) before they meet the airlines,
    so that a busy carrier is spread over its tails and never joined row by row.
    """
    carriers = airlines.select("carrier_code", "name", "country")
    if country is not None:
        carriers = carriers.filter(F.col("country") == country)
    if flown_only:
        flights = flights.filter(flown(F.col("actual_departure_time")))
    legs = flights.select("carrier_code", "tail_number")
    keys = ["name", "carrier_code", "tail_number", "country"]

    if fits_broadcast(carriers):
        return rows_per(
            legs.join(F.broadcast(carriers), "carrier_code"), *keys, alias="count"
        )
    pairs = rows_per(legs, "carrier_code", "tail_number", alias="legs")
    # An airline row that occurs twice counts its flights twice, as a plain join would.
    copies = rows_per(carriers, "carrier_code", "name", "country", alias="copies")
    total = F.col("legs") * F.col("copies")
    return pairs.join(copies, "carrier_code").select(*keys, total.alias("count"))


def rollup_delta(
    airlines: DataFrame, *, flown: DataFrame | None = None, cancelled: DataFrame | None = None
) -> DataFrame:
    """Signed changes of the counts per tail: flights newly flown, and flights counted
    before that turn out to be cancelled."""
    parts = [
        flights_per_tail(flights, airlines, flown_only=flown_only).withColumn(
            "count", F.col("count") * sign
        )
        for flights, flown_only, sign in ((flown, True, 1), (cancelled, False, -1))
        if flights is not None
    ]
    if not parts:
        raise ValueError("a delta needs flown or cancelled flights")
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("name", "carrier_code", "tail_number", "country")
        .agg(F.sum("count").alias("count"))
        .filter("count <> 0")
    )


def flights_with_airline(
    flights: DataFrame, airlines: DataFrame, *, flown_only: bool = True
) -> DataFrame:
    """Each flight with the name and country of its airline."""
    if flown_only:
        flights = flights.filter(flown(F.col("actual_departure_time")))
    carriers = airlines.select("carrier_code", "name", "country")
    return flights.join(broadcast_if_small(carriers), "carrier_code")


def known_aircrafts(aircrafts: DataFrame, *carried: str) -> DataFrame:
    return aircrafts.filter(
        F.col("manufacturer").isNotNull() & F.col("model").isNotNull()
    ).select("tailnum", "manufacturer", "model", *carried)


def flights_per_model(per_tail: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Per-tail counts summed per (name, manufacturer, model) of known aircraft."""
    known = known_aircrafts(aircrafts)
    return (
        per_tail.filter(F.col("tail_number").isNotNull())
        .join(known, F.col("tail_number") == F.col("tailnum"))
        .groupBy("name", "manufacturer", "model")
        .agg(F.sum("count").alias("numFlights"))
    )


def rank_models(
    per_model: DataFrame, n: int = 5, *, ties: str = "keep", descending: bool = True
) -> DataFrame:
    """The ``n`` first models per airline by flights, in report order.

    ``ties="keep"`` keeps every model of rank ``n`` or better, ``"exact"`` takes ``n``
    rows per airline, equal counts in order of manufacturer and model.
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, got {ties!r}")
    if ties == "keep":
        ranked = ranked_within(
            per_model, "name", "numFlights", n, descending=descending
        )
    else:
        flights = F.col("numFlights")
        order = flights.desc() if descending else flights.asc()
        ranked = first_within(
            per_model, "name", [order, F.col("manufacturer"), F.col("model")], n
        )
    return ranked.orderBy("name", "rank", "manufacturer", "model")


def top_models_per_airline(
    flights: DataFrame,
    airlines: DataFrame,
    aircrafts: DataFrame,
    country: str,
    n: int = 5,
    *,
    ties: str = "keep",
) -> DataFrame:
    per_tail = flights_per_tail(flights, airlines, country=country)
    return rank_models(flights_per_model(per_tail, aircrafts), n, ties=ties)


def top_models_from_rollup(
    rollup: DataFrame, aircrafts: DataFrame, country: str, n: int = 5, *, ties: str = "keep"
) -> DataFrame:
    """``top_models_per_airline`` from the rollup, of which one country is read."""
    per_tail = rollup.filter(F.col("country") == country)
    return rank_models(flights_per_model(per_tail, aircrafts), n, ties=ties)


def flights_per_model_colocated(
    flights: DataFrame, airlines: DataFrame, aircrafts: DataFrame, country: str
) -> DataFrame:
    """``flights_per_model`` from tables that ``write_colocated`` wrote.

    Flights and aircraft meet bucket by bucket, without a shuffle of either; what is
    shuffled are counts per (carrier, manufacturer, model).
    """
    carriers = airlines.filter(F.col("country") == country).select("carrier_code", "name")
    legs = flights.filter(
        flown(F.col("actual_departure_time")) & F.col("tail_number").isNotNull()
    ).select("carrier_code", "tail_number", SLICE)
    wanted = carriers.select("carrier_code").distinct()
    if fits_broadcast(wanted):
        legs = legs.join(F.broadcast(wanted), "carrier_code", "left_semi")
    known = known_aircrafts(aircrafts.withColumnRenamed(SLICE, "own_slice"), "own_slice")
    same = (F.col("tail_number") == F.col("tailnum")) & (F.col(SLICE) == F.col("own_slice"))
    per_carrier = rows_per(
        legs.join(known.hint("merge"), same),
        "carrier_code",
        "manufacturer",
        "model",
        alias="legs",
    )
    # An airline row that occurs twice counts its flights twice, as a plain join would.
    return (
        per_carrier.join(carriers, "carrier_code")
        .groupBy("name", "manufacturer", "model")
        .agg(F.sum("legs").alias("numFlights"))
    )


def top_models_colocated(
    flights: DataFrame,
    airlines: DataFrame,
    aircrafts: DataFrame,
    country: str,
    n: int = 5,
    *,
    ties: str = "keep",
) -> DataFrame:
    """``top_models_per_airline`` from tables that ``write_colocated`` wrote."""
    per_model = flights_per_model_colocated(flights, airlines, aircrafts, country)
    return rank_models(per_model, n, ties=ties)


def least_flown_models(
    flights: DataFrame,
    airlines: DataFrame,
    aircrafts: DataFrame,
    country: str,
    n: int = 5,
) -> DataFrame:
    per_tail = flights_per_tail(flights, airlines, country=country)
    return rank_models(flights_per_model(per_tail, aircrafts), n, descending=False)
