"""Validation reports: counts per layer, key uniqueness, expected batch size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.schemas import KEY

EXPECTED_BATCH_ROWS = 5000  # fixed value


def row_count(df: DataFrame, name: str = "table") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")


def uniqueness(df: DataFrame, key: str = KEY, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Total rows vs distinct keys (equal when the key is unique).

    Exact by default (every key is shuffled once).  ``approx`` counts keys
    with HyperLogLog++ sketches merged map-side (no key shuffle), within
    ``rsd`` relative error; ``is_unique`` then only means "within error"."""
    distinct = F.approx_count_distinct(F.col(key), rsd) if approx else F.count_distinct(F.col(key))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct.alias("unique_rows"),
    ).withColumn("is_unique", F.col("total_rows") == F.col("unique_rows"))


def validate_layers(
    layers: dict[str, DataFrame],
    batch: DataFrame | None = None,
    expected_batch: int = EXPECTED_BATCH_ROWS,
    waiting: DataFrame | None = None,
) -> DataFrame:
    """One report: rows per layer, then the batch's actual against expected
    size.  With ``waiting`` (the unscored rows) the expectation is
    ``min(expected_batch, waiting rows)``: a short batch is right when fewer
    rows were waiting."""
    parts = [
        row_count(df, name).withColumn("expected", F.lit(None).cast("long")).withColumn("passed", F.col("rows") > 0)
        for name, df in layers.items()
    ]
    if batch is not None:
        expected = F.lit(expected_batch).cast("long")
        actual = row_count(batch, "batch")
        if waiting is not None:  # one row each: nothing is counted before the report runs
            actual = actual.join(F.broadcast(row_count(waiting, "batch").select(F.col("rows").alias("_waiting"))))
            expected = F.least(expected, F.col("_waiting"))
        parts.append(
            actual.withColumn("expected", expected)
            .drop("_waiting")
            .withColumn("passed", F.col("rows") == F.col("expected"))
        )
    return reduce(DataFrame.unionByName, parts)


def validation_report(layers: dict[str, DataFrame], key: str = KEY, approx: bool = False) -> DataFrame:
    """Per layer: rows, distinct keys, duplicate copies, pass flag (no duplicates
    in any layer after Bronze).  ``approx`` as in ``uniqueness``."""
    parts = []
    for name, df in layers.items():
        u = uniqueness(df, key, approx=approx)
        parts.append(
            u.select(
                F.lit(name).alias("layer"),
                "total_rows",
                "unique_rows",
                (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"),
                (F.lit(name == "bronze") | F.col("is_unique")).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
