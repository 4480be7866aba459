"""How a query hands its result over."""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry_lake.functions.numeric import GUARD_DIGITS, snap

DIGITS = 6


def present(df: DataFrame, *dropped: str) -> DataFrame:
    """Doubles on the 10^-6 grid, timestamps without zone, arrival time dropped."""

    def column(field) -> str:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        if kind == "double":  # the finer grid first: an average may lie halfway between two points
            return f"{snap(snap(name, DIGITS + GUARD_DIGITS), DIGITS)} AS {name}"
        if kind == "timestamp":
            return f"CAST({name} AS TIMESTAMP_NTZ) AS {name}"
        return name

    hidden = {"ingestion_time", *dropped}
    return df.selectExpr(*[column(f) for f in df.schema.fields if f.name not in hidden])
