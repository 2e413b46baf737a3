"""Column names that an operator can use inside without meeting one of the user's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame | list[str], *names: str) -> list[str]:
    """Names like those asked for that no column has, whatever its case."""
    taken = {c.lower() for c in (df if isinstance(df, list) else df.columns)}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
