"""Packed text: delimited pieces, fixed-width lines, JSON fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Piece names and types of the packed weather columns.
WEATHER_LAYOUTS: dict[str, list[tuple[str, str]]] = {
    "WND": [
        ("WND_Angle", "int"),
        ("WND_Qlty", "string"),
        ("WND_Obs", "string"),
        ("WND_Speed", "int"),
        ("WND_Speed_Qlty", "string"),
    ],
    "CIG": [
        ("CIG_Height", "int"),
        ("CIG_Qlty", "string"),
        ("CIG_Ceiling", "string"),
        ("CIG_CAVOK", "string"),
    ],
    "VIS": [
        ("VIS_Dis", "int"),
        ("VIS_Qlty", "string"),
        ("VIS_Var", "string"),
        ("VIS_Var_Qlty", "string"),
    ],
    "TMP": [("TMP_Degree", "int"), ("TMP_Qlty", "string")],
    "DEW": [("DEW_Degree", "int"), ("DEW_Qlty", "string")],
    "SLP": [("SLP_Pressure", "int"), ("SLP_Qlty", "string")],
}


def split_packed(
    df: DataFrame,
    layouts: Mapping[str, Sequence[tuple[str, str]]],
    sep: str = ",",
    drop: bool = True,
) -> DataFrame:
    """Split delimited columns into typed pieces.

    ``layouts`` maps a packed column to its (piece name, type) list. A piece that is
    absent or does not parse becomes null. All columns are split in one projection.
    """
    # a plain or escaped single character avoids compiling a pattern per row
    pattern = "".join(c if c.isalnum() or c in ",; -_/" else "\\" + c for c in sep)
    pieces = {
        name: F.get(F.split(F.col(packed), pattern), F.lit(i)).try_cast(kind)
        for packed, layout in layouts.items()
        for i, (name, kind) in enumerate(layout)
    }
    out = df.withColumns(pieces)
    return out.drop(*layouts) if drop else out


def parse_fixed_width(
    df: DataFrame, layout: Sequence[tuple[str, int, int, str]], line: str = "value"
) -> DataFrame:
    """Cut fixed-width lines by (name, 1-based start, length, type); blank text is null."""
    return df.select(
        *[
            F.nullif(F.trim(F.substring(F.col(line), start, length)), F.lit(""))
            .try_cast(kind)
            .alias(name)
            for name, start, length, kind in layout
        ]
    )


def json_fields(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Parse JSON records; a missing key or a malformed record gives nulls."""
    parsed = df.withColumn("_json", F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}))
    return parsed.select(*df.columns, "_json.*")


def rescale(df: DataFrame, factors: Mapping[str, float]) -> DataFrame:
    """Multiply columns by a factor, e.g. 0.1 for values stored times ten."""
    return df.withColumns({c: F.col(c) * F.lit(f) for c, f in factors.items()})


def composite_key(*cols: Column) -> Column:
    """Concatenated key; null when any part is null."""
    return F.concat(*[c.cast("string") for c in cols])
