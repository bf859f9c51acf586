"""Entity types, labels, column lists and schemas, defined once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The entity types, in output order.
ENTITY_TYPES = [
    "Hersteller",
    "Kompatible_Fahrzeug_Marke",
    "Kompatibles_Fahrzeug_Modell",
    "Produktart",
    "Herstellernummer",
    "EAN",
    "Zustand",
    "Farbe",
    "Material",
    "Anzahl",
    "OEM",
]

OUTSIDE = "O"
INPUT_COLUMNS = ["title", *ENTITY_TYPES]
SUBMISSION_COLUMNS = ["id", *ENTITY_TYPES]

SPAN_SCHEMA = "array<struct<type:string,start_pos:int,end_pos:int,text:string>>"


def labels(types: list[str] = ENTITY_TYPES) -> list[str]:
    """`O`, then `B-t`, `I-t` per type; a label's id is its place in the list."""
    return [OUTSIDE] + [f"{prefix}-{t}" for t in types for prefix in ("B", "I")]


def label_vocab(spark: SparkSession, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """The vocabulary as a table `(label_id, label)` of 2·types+1 rows."""
    return spark.range(1).selectExpr(f"posexplode({_vocabulary(types)}) AS (label_id, label)")


def type_table(spark: SparkSession, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """The types in order as a table `(type_no, type)`."""
    names = ", ".join(f"'{t}'" for t in types)
    return spark.range(1).selectExpr(f"posexplode(array({names})) AS (type_no, type)")


def _vocabulary(types: list[str]) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in labels(types)) + ")"


def encode_label(tag: str, types: list[str] = ENTITY_TYPES) -> str:
    """Label → id; NULL for a tag outside the vocabulary."""
    position = f"array_position({_vocabulary(types)}, {tag})"
    return f"CAST(nullif({position}, 0) - 1 AS INT)"


def decode_label(label_id: str, types: list[str] = ENTITY_TYPES) -> str:
    """Id → label; NULL for an id out of range."""
    return f"get({_vocabulary(types)}, {label_id})"
