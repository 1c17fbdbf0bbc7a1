"""Registry of named queries: a Spark callable and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def list6(expr: str) -> str:
    """SQL for a list of numbers as text, six decimals, scaled to whole numbers."""
    return f"array_to_string(list_transform({expr}, lambda v_: cast(floor(v_ * 1000000 + 0.5) as bigint)), ',')"


def rand_sql(*keys: str, seed) -> str:
    """SQL twin of portable_rand."""
    text = ", ".join(keys)
    return f"(('0x' || substr(md5(concat_ws(':', {text}, '{seed}')), 1, 13))::bigint / 4503599627370496.0)"


def normal_sql(*keys: str, seed) -> str:
    u1, u2 = rand_sql(*keys, seed=f"{seed}a"), rand_sql(*keys, seed=f"{seed}b")
    return f"(sqrt(-2.0 * ln(greatest({u1}, 1e-12))) * cos(6.283185307179586 * {u2}))"
