"""Score band, income band, grid lookup and the limit formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeline.config import CURRENT, PolicyConfig


def score_band(score: Column, cfg: PolicyConfig = CURRENT) -> Column:
    """Band of a score. NaN and null compare below every bound, so they are in the lowest."""
    known = score.isNotNull() & ~F.isnan(score.cast("double"))
    expr = F.when(~known, cfg.lowest_band)
    for band, bound in cfg.score_bands:
        expr = expr.when(score >= bound, band)
    return expr.otherwise(cfg.lowest_band)


def income_band(
    low: Column, high: Column, open_ended: Column | None = None, cfg: PolicyConfig = CURRENT
) -> Column:
    """Band of an exact (low, high) bracket.

    ``open_ended`` says that no upper bound was sent; it defaults to
    ``high IS NULL`` and is passed when ``high`` comes from lenient parsing.
    """
    open_ended = high.isNull() if open_ended is None else open_ended
    known = ", ".join(
        f"'{float(lo)}:{'open' if hi is None else float(hi)}', {band}"
        for lo, hi, band in cfg.income_brackets
    )
    upper = F.when(open_ended, "open").otherwise(high.cast("double").cast("string"))
    bracket = F.concat_ws(":", low.cast("double").cast("string"), upper)
    return F.coalesce(F.expr(f"map({known})")[bracket], F.lit(cfg.default_income_band))


def grid_value(table: dict[str, tuple], band: Column, income: Column) -> Column:
    """One cell of a grid (score band x income band), as a literal-map lookup (no join)."""
    cells = ", ".join(
        f"'{name}{i}', {float(value)!r}D"
        for name, row in table.items()
        for i, value in enumerate(row, 1)
    )
    return F.expr(f"map({cells})")[F.concat(band, income.cast("string"))]


def grid_frame(spark: SparkSession, cfg: PolicyConfig = CURRENT) -> DataFrame:
    """The policy's three grids as a table with a row for each cell."""
    cells = [
        F.struct(
            F.lit(band).alias("score_band"),
            F.lit(i + 1).alias("income_band"),
            F.lit(float(row[i])).alias("multiplier"),
            F.lit(float(cfg.limit_ceiling[band][i])).alias("max_cap"),
            F.lit(float(cfg.limit_floor[band][i])).alias("min_cap"),
        )
        for band, row in cfg.limit_multiplier.items()
        for i in range(len(row))
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*cells)))


def with_grid(applicants: DataFrame, grid: DataFrame) -> DataFrame:
    """Attach multiplier and caps by (score_band, income_band).

    The grid has one row per cell of a fixed 7 x 4 table, so it is broadcast.
    """
    return applicants.join(F.broadcast(grid), ["score_band", "income_band"], "left")


def limit_amount(
    base: Column, multiplier: Column, max_cap: Column, min_cap: Column, cfg: PolicyConfig = CURRENT
) -> Column:
    """Scale, cap from above, then from below, then round up to the policy's next step."""
    scaled = base * multiplier
    capped = F.greatest(F.least(scaled, max_cap), min_cap)
    return F.when(
        scaled.isNotNull() & ~F.isnan(scaled), (F.ceil(capped / cfg.limit_step) * cfg.limit_step).cast("bigint")
    )


def credit_limit(
    base: Column,
    score: Column,
    low: Column,
    high: Column,
    open_ended: Column | None = None,
    cfg: PolicyConfig = CURRENT,
) -> Column:
    """The whole limit as one expression; null without a score, or without a base (or a NaN one).

    A score that is NaN is in the lowest band.
    """
    band, income = score_band(score, cfg), income_band(low, high, open_ended, cfg)
    limit = limit_amount(
        base,
        grid_value(cfg.limit_multiplier, band, income),
        grid_value(cfg.limit_ceiling, band, income),
        grid_value(cfg.limit_floor, band, income),
        cfg,
    )
    return F.when(score.isNotNull(), limit)
