"""Clean rows -> 12-month examples per pixel-year -> train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracube.operators.windows import example_arrays, example_steps, split_by_year
from terracube.schema import VALUE_COLS


def engineer_steps(scaled: DataFrame, test_year: int = 2016,
                   features=VALUE_COLS) -> DataFrame:
    """Long examples: (lat, lon, gb_year, split, step, <features>, y)."""
    steps = example_steps(scaled, list(features))
    return split_by_year(steps, test_year)


def engineer_arrays(scaled: DataFrame, test_year: int = 2016,
                    features=VALUE_COLS) -> DataFrame:
    """Nested examples: (lat, lon, gb_year, split, x array<array<double>>, y)."""
    return example_arrays(engineer_steps(scaled, test_year, features), list(features))


def example_summary(steps: DataFrame) -> DataFrame:
    """Flagship report: examples and mean target per gb_year and split."""
    one = steps.where(F.col("step") == 1)
    return (one.groupBy("gb_year", "split")
               .agg(F.count(F.lit(1)).alias("n_examples"),
                    F.round(F.avg("y"), 6).alias("mean_y")))
