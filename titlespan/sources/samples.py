"""Sample listings and sample submissions for a table of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.types import ENTITY_TYPES

# The vocabulary of the sample listings.
MAKERS = ["Bosch", "Valeo", "Brembo", "ATE", "Textar", "Mann-Filter"]
VEHICLE_MAKES = ["BMW", "Mercedes", "Audi", "VW", "Opel", "Ford"]
VEHICLE_MODELS = ["3er", "A4", "Golf", "Corsa", "Focus", "C-Klasse"]
PRODUCTS = ["Bremsscheibe", "Bremsbelag", "Luftfilter", "Ölfilter", "Wasserpumpe"]


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def sample_titles(id_table: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """One synthetic listing per id: id, title and the 11 type columns.

    Values are drawn by hashing id and seed, so a lost task writes the same rows again.
    """

    def draw(field: str, k: int) -> Column:
        return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(field)), F.lit(k))

    def pick(field: str, words: list[str]) -> Column:
        return F.get(F.array(*[F.lit(w) for w in words]), draw(field, len(words)).cast("int"))

    chosen = id_table.select(
        F.col(id_col).cast("string").alias("id"),
        pick("maker", MAKERS).alias("Hersteller"),
        pick("make", VEHICLE_MAKES).alias("Kompatible_Fahrzeug_Marke"),
        pick("model", VEHICLE_MODELS).alias("Kompatibles_Fahrzeug_Modell"),
        pick("product", PRODUCTS).alias("Produktart"),
        (draw("number", 900_000) + 100_000).cast("string").alias("Herstellernummer"),
        (draw("ean", 9_000_000_000_000) + 1_000_000_000_000).cast("string").alias("EAN"),
        F.when(draw("condition", 10) < 7, F.lit("Neu")).otherwise(F.lit("Gebraucht")).alias("Zustand"),
        *[F.lit("").alias(t) for t in ("Farbe", "Material", "Anzahl", "OEM")],
    )
    title = F.concat_ws(
        " ",
        "Hersteller",
        "Produktart",
        F.lit("für"),
        "Kompatible_Fahrzeug_Marke",
        "Kompatibles_Fahrzeug_Modell",
    )
    return chosen.select("id", title.alias("title"), *ENTITY_TYPES)


def sample_submission(id_table: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows cycle by id through one value, two values and none."""
    number = F.col(id_col)

    def value(t: str) -> Column:
        one = F.concat(F.lit(f"Sample{t}_"), number.cast("string"))
        two = F.concat_ws("|", one, F.concat(F.lit(f"Sample{t}_"), (number + 1).cast("string")))
        return F.when(number % 3 == 0, one).when(number % 3 == 1, two).otherwise(F.lit(""))

    return id_table.select(
        number.cast("string").alias("id"), *[value(t).alias(t) for t in ENTITY_TYPES]
    )
