"""Report lines as one text column, for ``write.text``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The field separator and the label of the report lines.
FIELD_SEPARATOR = " \t "
MODEL_LABEL = "Cessna"
DELAY_FIELDS = ("name", "numOfDelays", "avgDelays", "minDelay", "maxDelay")


def model_lines(top: DataFrame) -> DataFrame:
    model = F.concat_ws(" ", F.lit(MODEL_LABEL), "modelName")
    return top.select(
        F.concat_ws(FIELD_SEPARATOR, model, F.col("numFlights").cast("string")).alias(
            "line"
        )
    )


def delay_lines(stats: DataFrame) -> DataFrame:
    fields = (F.col(field).cast("string") for field in DELAY_FIELDS)
    return stats.orderBy(*DELAY_FIELDS).select(
        F.concat_ws(FIELD_SEPARATOR, *fields).alias("line")
    )


def fleet_lines(ranked: DataFrame) -> DataFrame:
    """One line per airline with its ranked models; give it a bounded ranking."""
    entry = F.struct("rank", "manufacturer", "model")
    models = F.transform(
        F.sort_array(F.collect_list(entry)),
        lambda e: F.concat_ws(" ", e["manufacturer"], e["model"]),
    )
    listing = F.concat(F.lit("["), F.array_join(models, ", "), F.lit("]"))
    return (
        ranked.groupBy("name")
        .agg(listing.alias("listing"))
        .orderBy("name")
        .select(F.concat_ws(FIELD_SEPARATOR, "name", "listing").alias("line"))
    )


def ranked_lines(ranked: DataFrame) -> DataFrame:
    """One line per airline and ranked model, for rankings with any number of ties."""
    model = F.concat_ws(" ", "manufacturer", "model")
    return ranked.orderBy("name", "rank", "manufacturer", "model").select(
        F.concat_ws(FIELD_SEPARATOR, "name", F.col("rank").cast("string"), model).alias(
            "line"
        )
    )
