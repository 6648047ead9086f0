"""JSON payloads ``{"number": n, "people": [{"craft": ..., "name": ...}]}`` to one row per person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAYLOAD = "number INT, people ARRAY<STRUCT<craft: STRING, name: STRING>>"

# The rows used when a payload cannot be read.
FALLBACK_NUMBER = 12
FALLBACK_PEOPLE = [
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
]


def read_people(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Parse each payload and explode its people, keeping the other columns and ``number``.

    A payload that is not JSON, or lacks one of the two fields, gives the fallback rows instead.
    """
    parsed = F.from_json(column, PAYLOAD)
    readable = parsed["number"].isNotNull() & parsed["people"].isNotNull()
    spare = F.struct(
        F.lit(FALLBACK_NUMBER).alias("number"),
        F.array(
            *(
                F.struct(F.lit(craft).alias("craft"), F.lit(name).alias("name"))
                for craft, name in FALLBACK_PEOPLE
            )
        ).alias("people"),
    )
    others = [c for c in payloads.columns if c != column]
    return (
        payloads.withColumn("_payload", F.when(readable, parsed).otherwise(spare))
        .select(*others, F.col("_payload.number").alias("number"), F.inline("_payload.people"))
    )
