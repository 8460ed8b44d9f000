"""Parameter grids and best-run choice.

The grid is the product of short parameter lists, first list varying
slowest (``itertools.product`` order). Scoring a grid never multiplies
the data rows: every grid point is one conditional aggregate in a single
pass, then the per-point results are unpivoted into a runs table.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_points(params: dict[str, Sequence[float]]) -> list[dict[str, float]]:
    """Grid points in product order (first parameter slowest)."""
    names = list(params)
    return [dict(zip(names, vals)) for vals in itertools.product(*params.values())]


def score_grid(df: DataFrame, params: dict[str, Sequence[float]],
               loss: Callable[[dict[str, float]], Column]) -> DataFrame:
    """Runs table (ordinal, params..., loss): one pass over ``df``.

    ``loss(point)`` returns an aggregate Column for one grid point.
    """
    points = grid_points(params)
    wide = df.agg(*[loss(p).alias(f"loss__{i}") for i, p in enumerate(points)])
    rows = [F.struct(F.lit(i + 1).cast("bigint").alias("ordinal"),
                     *[F.lit(float(v)).alias(k) for k, v in p.items()],
                     F.col(f"loss__{i}").cast("double").alias("loss"))
            for i, p in enumerate(points)]
    return wide.select(F.inline(F.array(*rows)))


def best_run(runs: DataFrame, param_cols: Sequence[str]) -> DataFrame:
    """The run with the smallest loss; the first (lowest ordinal) wins ties;
    NaN or null losses never win (D20)."""
    ok = runs.filter(F.col("loss").isNotNull() & ~F.isnan("loss"))
    best = ok.agg(F.min_by(F.struct("ordinal", *param_cols, "loss"),
                           F.struct("loss", "ordinal")).alias("b"))
    return best.select("b.*")
