"""Small helpers that keep the checking SQL readable."""

from __future__ import annotations

DUCKDB_TOKENS = {"S": "VARCHAR", "J": "json_extract_string(props, '$.k')", "EPOCH": "epoch(ts)"}
GUARD = 3


def snap(x: str, digits: int = 6) -> str:
    scale = f"{10**digits}e0"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def rnd(x: str, digits: int) -> str:
    """Half away from zero, decided on whole thousandths of the last digit."""
    return f"(round(round_even(({x}) * {10 ** (digits + GUARD)}e0, 0) / {10**GUARD}e0) / {10**digits}e0)"


def clip(x: str, low, high) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN greatest({low}, least({high}, {x})) END"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0e0))"


def ladder(x: str, steps: list[tuple], top) -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else f"{v}e0"

    arms = " ".join(f"WHEN {x} < {bound} THEN {q(label)}" for bound, label in steps)
    return f"CASE WHEN {x} IS NULL THEN NULL {arms} ELSE {q(top)} END"


def bucket(ts: str, minutes: int) -> str:
    """Start of the epoch-aligned bucket."""
    width = minutes * 60
    return f"make_timestamp(CAST(floor(epoch({ts}) / {width}) AS BIGINT) * {width} * 1000000)"


def values(rows: list[tuple], columns: str) -> str:
    def q(v):
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v}e0" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t ({columns})"
