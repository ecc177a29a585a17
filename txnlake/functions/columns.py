"""Schema-level helpers: column-name normalisation and optional drops."""

from __future__ import annotations

from pyspark.sql import DataFrame

INDEX_COLUMN = "Unnamed: 0"  # fixed value: index column of the raw CSV


def normalized_name(name: str) -> str:
    """' Trans Date ' -> 'trans_date': strip, lower case, spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Normalise every column name, then apply an explicit rename map
    (e.g. ``{"first": "first_name"}``). Two columns mapping to one name is an
    error, not a silent overwrite."""
    rename = rename or {}
    new = [rename.get(normalized_name(c), normalized_name(c)) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"column names collide after normalisation: {dup}")
    return df.toDF(*new)


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """Drop the named columns that exist; absent names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df
