"""Unit-root tests over many series with the lag order chosen over all lags.

Every regression of the test, whatever its lag order and sample, is solved from one table of
cross products per series.  A row of the series holds [1, previous level, earlier changes
1..L, change]; rows are grouped by how many earlier changes exist for them, so the sample
common to all orders and the longer sample of each single order are sums over these groups.
Sweeping the columns of a product matrix one after the other solves the nested regressions:
after the constant, the level and p changes are swept, the matrix holds the coefficient, the
residual sum and the inverse entry for order p.  Sums are map-side combined, earlier changes are
read inside blocks of positions with a copied border, so a long series is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import materialize

#: Positions of a series that one block holds, besides its copied border.
BLOCK = 4096


def positions(series: DataFrame, key: str, period: str = "t", name: str = "pos", width: int = BLOCK) -> DataFrame:
    """Rows numbered from 1 within their key in order of an integer period, by buckets of periods."""
    rows = series.withColumn("_bucket", F.floor(F.col(period) / width))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(period))
    return (rows.withColumn("_own", own).join(shift, [key, "_bucket"])
            .withColumn(name, (F.col("_own") + F.col("_shift")).cast("long")).drop("_bucket", "_own", "_shift"))


def with_border(rows: DataFrame, pos: str, border: int, width: int = BLOCK) -> DataFrame:
    """Rows dealt to blocks of positions (_block); the last ``border`` rows of a block are copied to the next (_copy)."""
    block, inside = F.floor((F.col(pos) - 1) / width), F.pmod(F.col(pos) - 1, F.lit(width))
    to = F.when(inside >= width - border, F.array(block, block + 1)).otherwise(F.array(block))
    rows = rows.withColumn("_home", block).withColumn("_block", F.explode(to))
    return rows.withColumn("_copy", F.col("_block") != F.col("_home")).drop("_home")


def sweep(matrix: Column, k: Column, size: int) -> Column:
    """A symmetric matrix (array by rows) swept on the diagonal entry k; a zero entry leaves it as it is."""
    pivot = F.get(matrix, k * size + k)

    def entry(v: Column, at: Column) -> Column:
        i, j = (at / size).cast("int"), at % size
        row, col = F.get(matrix, i * size + k), F.get(matrix, k * size + j)
        return (F.when((i == k) & (j == k), F.lit(-1.0) / pivot).when(i == k, col / pivot).when(j == k, row / pivot)
                .otherwise(v - row * col / pivot))
    return F.when(F.abs(pivot) > 1e-12, F.transform(matrix, entry)).otherwise(matrix)


def cross_products(series: DataFrame, key: str, period: str, longest: DataFrame, top: int) -> DataFrame:
    """(key, lags, i, row): row i of the products summed over the key's rows with exactly ``lags`` earlier changes (at most longest)."""
    size = top + 3
    stats = series.groupBy(key).agg(F.avg("y").alias("_mean"), F.stddev_pop("y").alias("_sd"))
    rows = positions(series.select(key, period, F.col("y").cast("double").alias("y")), key, period)
    rows = (rows.join(stats, key).where("_sd > 0")
            .select(key, "pos", ((F.col("y") - F.col("_mean")) / F.col("_sd")).alias("y")))
    rows = with_border(rows, "pos", top + 1)
    w = Window.partitionBy(key, "_block").orderBy("pos")
    level = F.lag("y").over(w)
    rows = rows.withColumn("_level", level).withColumn("_change", F.col("y") - level)
    back = [F.coalesce(F.lag("_change", i).over(w), F.lit(0.0)) for i in range(1, top + 1)]
    rows = rows.withColumn("_back", F.array(*back) if back else F.array().cast("array<double>")).where("not _copy and pos > 1")
    rows = rows.join(longest, key).withColumn("lags", F.least(F.col("pos") - 2, F.col("longest")).cast("int"))
    z = F.concat(F.array(F.lit(1.0), F.col("_level")), F.transform(
        "_back", lambda v, i: F.when(i < F.col("lags"), v).otherwise(0.0)), F.array("_change"))
    rows = rows.select(key, "lags", z.alias("z")).select(key, "lags", "z", F.posexplode("z").alias("i", "zi"))
    return rows.groupBy(key, "lags", "i").agg(
        F.array(*[F.sum(F.col("zi") * F.get("z", F.lit(j))) for j in range(size)]).alias("row"))


def _summed(products: DataFrame, by: list[str], size: int) -> DataFrame:
    """Whole matrices (by, m): the rows of equal ``by`` and i added up."""
    rows = products.groupBy(*by, "i").agg(F.array(*[F.sum(F.get("row", F.lit(j))) for j in range(size)]).alias("row"))
    whole = F.array_sort(F.collect_list(F.struct("i", "row")))  # ``size`` rows
    return rows.groupBy(*by).agg(F.flatten(F.transform(whole, lambda r: r["row"])).alias("m"))


def _swept(m: Column, count: Column, size: int) -> Column:
    """The matrix after sweeping the constant, the level and the first ``count`` changes."""
    return F.aggregate(F.sequence(F.lit(0), count + 1), m, lambda a, k: sweep(a, k, size))


def _fit(m: Column, lag: Column, size: int) -> list[Column]:
    """(n, ssr, t): rows, residual sum and the level's t from a matrix swept for order ``lag``."""
    ssr = F.greatest(F.get(m, F.lit(size * size - 1)), F.lit(0.0))
    beta, inverse = F.get(m, F.lit(size + size - 1)), -F.get(m, F.lit(size + 1))
    return [ssr.alias("ssr"), beta.alias("beta"), inverse.alias("inverse")]


def lag_table(series: DataFrame, key: str, period: str = "t", max_lag: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(key, lag, n, ssr, t, aic) of every order on each key's common sample, the cross products, and their size.

    Without ``max_lag`` the longest lag of a series of n points is ceil(12 (n/100)^(1/4)), at
    most n / 2 - 2.  Constant series and those too short for a residual have no rows.  ssr is in
    units of the series' variance.
    """
    n = F.count("y")
    rule = F.ceil(12 * F.pow(n / 100, F.lit(0.25))) if max_lag is None else F.lit(max_lag)
    longest = materialize(series.where("y is not null").groupBy(key).agg(
        F.least(rule, F.floor(n / 2) - 2).cast("int").alias("longest")).where("longest >= 0"))
    top = longest.agg(F.max("longest")).first()[0]
    top = 0 if top is None else top
    size = top + 3
    products = materialize(cross_products(series.where("y is not null"), key, period, longest, top))
    common = products.join(longest, key).where(F.col("lags") == F.col("longest"))
    whole = _summed(common, [key, "longest"], size)
    # the sweeps of one order continue those of the one before it
    first = _swept(F.col("m"), F.lit(0), size)
    steps = F.aggregate(F.sequence(F.lit(1), F.col("longest")), F.array(first), lambda a, p: F.concat(
        a, F.array(sweep(F.element_at(a, -1), p + 1, size))))
    steps = F.when(F.col("longest") > 0, steps).otherwise(F.array(first))
    fits = whole.select(key, F.get("m", F.lit(0)).cast("long").alias("n"), F.posexplode(steps).alias("lag", "m"))
    fits = fits.select(key, "lag", "n", *_fit(F.col("m"), F.col("lag"), size))
    free = F.col("n") - F.col("lag") - 2
    t = F.when(free > 0, F.col("beta") / F.sqrt(F.col("ssr") / free * F.col("inverse")))
    aic = F.col("n") * F.log(F.try_divide(F.col("ssr"), F.col("n"))) + 2 * (F.col("lag") + 2)
    return fits.select(key, "lag", "n", "ssr", t.alias("adf_t"), aic.alias("aic")), products, size


def adf(series: DataFrame, key: str, period: str = "t", max_lag: int | None = None, min_rows: int = 4) -> DataFrame:
    """FC-3: unit-root t with a constant; the order by AIC over all lags of the common sample, then on its own longer sample.

    Returns key, n_points, lag, adf_stat, n, p_value and stationary.  Series of fewer than
    ``min_rows`` points and constant ones get p = 1; orders whose regression leaves no residual
    degree of freedom are not considered.  Null values are left out.
    """
    from panelforge.operators.forecast import adf_pvalue
    table, products, size = lag_table(series, key, period, max_lag)
    best = materialize(table.where("adf_t is not null and aic is not null").groupBy(key)
                       .agg(F.min_by("lag", F.struct("aic", "lag")).alias("lag")))
    own = _summed(products.join(best, key).where(F.col("lags") >= F.col("lag")), [key, "lag"], size)
    own = own.select(key, "lag", F.get("m", F.lit(0)).cast("long").alias("n"), _swept(F.col("m"), F.col("lag"), size).alias("m"))
    own = own.select(key, "lag", "n", *_fit(F.col("m"), F.col("lag"), size))
    free = F.col("n") - F.col("lag") - 2
    own = own.select(key, "lag", "n", (F.col("beta") / F.sqrt(F.col("ssr") / free * F.col("inverse"))).alias("adf_stat"))
    info = series.where("y is not null").groupBy(key).agg(
        F.count(F.lit(1)).alias("n_points"), (F.min("y") == F.max("y")).alias("_flat"))
    p = F.udf(adf_pvalue, "double")  # once a series
    out = info.join(own, key, "left")
    out = out.withColumn("p_value", F.when((F.col("n_points") < min_rows) | F.col("_flat") | F.col("adf_stat").isNull(), 1.0)
                         .otherwise(p("adf_stat")))
    return out.withColumn("stationary", F.col("p_value") < 0.05).drop("_flat")
