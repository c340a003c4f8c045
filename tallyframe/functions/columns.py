"""Find columns whose names vary between feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that ``df`` has (case-sensitive), else None."""
    present = set(df.columns)
    return next((name for name in names if name in present), None)


def pick(df: DataFrame, *names: str) -> str:
    """Like :func:`first_present`, but a missing column is an error."""
    found = first_present(df, names)
    if found is None:
        raise ValueError(f"no column among {list(names)}; the table has {df.columns}")
    return found


def pick_any_case(df: DataFrame, name: str) -> str:
    """The column of ``df`` equal to ``name`` when case is ignored."""
    wanted = name.lower()
    matches = [column for column in df.columns if column.lower() == wanted]
    if not matches:
        raise ValueError(f"no column '{name}' in any case; the table has {df.columns}")
    return matches[-1]


def require(df: DataFrame, *names: str) -> None:
    """Raise unless ``df`` has every column of ``names``."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
