"""Verbs on ordered rows. All take an explicit order; groups bound what one task sorts."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliotab.functions import sem
from heliotab.operators.store import written


def _w(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def cumulative(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.sum(value).over(_w(by, order).rowsBetween(Window.unboundedPreceding, 0)))


def running_total(df: DataFrame, ordinal: str, value: str, out: str, block: int = 1 << 16, blocks: int = 1 << 12) -> DataFrame:
    """A running sum over a whole table by a gapless or gappy integer ordinal: sums inside blocks of ordinals, of blocks inside groups of so many, and of the groups before, of which there are few. Equal ordinals count in no particular order."""
    rows = df.withColumn("_block", F.floor(F.col(ordinal) / block))
    sums = rows.groupBy("_block").agg(F.sum(value).alias("s")).withColumn("_group", F.floor(F.col("_block") / blocks))
    groups = sums.groupBy("_group").agg(F.sum("s").alias("g"))
    earlier = groups.select("_group", (F.sum("g").over(Window.orderBy("_group")) - F.col("g")).alias("_earlier"))
    within = F.sum("s").over(Window.partitionBy("_group").orderBy("_block")) - F.col("s")
    before = sums.withColumn("_within", within).join(earlier, "_group").select("_block", (F.coalesce("_within", F.lit(0)) + F.coalesce("_earlier", F.lit(0))).alias("_before"))
    inner = F.sum(value).over(Window.partitionBy("_block").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, inner).join(before, "_block").withColumn(out, F.col(out) + F.col("_before")).drop("_block", "_before")


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """The rows with their places in an order over the whole table, from 0. They are dealt to ranges of the order and written to the shared folder once; each range is numbered by itself, on from the rows of those before. Ties are numbered in no particular order."""
    names = df.columns
    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # a row a partition
    first = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_first"))
    inner = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_inner", inner).join(F.broadcast(first), "_range").select(*names, (F.col("_first") + F.col("_inner")).alias(out))


def shift(df: DataFrame, by: list[str], order: list[str], value: str, out: str, n: int = 1, roll: bool = False) -> DataFrame:
    """Values n places later; the first n are 0, or with roll the last n: those are numbered by the places they go to and joined, so the order must leave no ties."""
    w = _w(by, order)
    moved = F.lag(value, n).over(w)
    if roll:
        rows = df.withColumn("_k", F.row_number().over(w)).withColumn("_n", F.count("*").over(Window.partitionBy(*by))).withColumn("_moved", moved)
        last = rows.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], (F.pmod(F.col("_k") - 1 + n, F.col("_n")) + 1).alias("_to"), F.col(value).alias("_last")).where(F.col("_to") <= n)
        same = F.col("_k") == F.col("_to")
        for i, c in enumerate(by):
            same = same & rows[c].eqNullSafe(F.col(f"_by{i}"))
        return rows.join(last, same, "left").withColumn(out, F.when(F.col("_k") <= n, F.col("_last")).otherwise(F.col("_moved"))).drop("_k", "_n", "_moved", "_to", "_last", *[f"_by{i}" for i in range(len(by))])
    return df.withColumn(out, F.when(F.row_number().over(w) <= n, F.lit(0)).otherwise(moved))


def median_filter(df: DataFrame, by: list[str], order: list[str], value: str, out: str, n: int) -> DataFrame:
    """The median of 2n + 1 values around each, fewer at the ends; NaN are left out."""
    clean = F.when(~F.isnan(value), F.col(value))
    return df.withColumn(out, F.percentile(clean, 0.5).over(_w(by, order).rowsBetween(-n, n)))


def smooth(df: DataFrame, by: list[str], order: list[str], value: str, out: str, weights: list[float]) -> DataFrame:
    """A weighted mean with the weights centred on each row; at the ends those that fall outside are left out."""
    w, half = _w(by, order), len(weights) // 2
    terms = [(F.lag(value, half - k).over(w), float(x)) for k, x in enumerate(weights)]
    top = sum((F.coalesce(v * x, F.lit(0.0)) for v, x in terms), F.lit(0.0))
    bottom = sum((F.when(v.isNotNull(), F.lit(x)).otherwise(0.0) for v, x in terms), F.lit(0.0))
    return df.withColumn(out, top / bottom)


def roll_first(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Values one place earlier; the first becomes the last."""
    w = _w(by, order)
    head = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.when(F.row_number().over(_w(by, [F.desc(c) for c in order])) == 1, head).otherwise(F.lead(value).over(w)))


def pop_first(df: DataFrame, by: list[str], order: list[str], ordinal: str) -> DataFrame:
    """The rows but the first of each group, numbered from 0."""
    return df.withColumn(ordinal, F.row_number().over(_w(by, order)).cast("bigint") - 2).where(F.col(ordinal) >= 0)


def bins_of(df: DataFrame, by: list[str], order: list[str], value: str, n: int) -> DataFrame:
    """(by, bin, total, mean) of each n values in order; the last ones, where they are fewer, are left out."""
    rows = df.select(*by, F.col(value).alias("_v"), F.floor((F.row_number().over(_w(by, order)) - 1) / n).alias("bin"))
    return rows.groupBy(*by, "bin").agg(F.count("*").alias("_n"), F.sum("_v").alias("total"), F.avg("_v").alias("mean")).where(F.col("_n") == n).drop("_n")


def peak(df: DataFrame, by: list[str], x: str, y: str, start: float, end: float) -> DataFrame:
    """(by, x, y) of the greatest finite y with x in [start, end], the last x of equals."""
    rows = df.where(sem.is_finite(F.col(y)) & F.col(x).between(start, end))
    return rows.groupBy(*by).agg(F.max(F.struct(F.col(y).alias("y"), F.col(x).alias("x"))).alias("_m")).select(*by, "_m.x", "_m.y")


def peaks(df: DataFrame, by: list[str], order: list[str], value: str, least: float | None = None, plateaus: bool = True) -> DataFrame:
    """Rows that end a rise and begin a fall, of values from `least` on; of a plateau the last row, or none without `plateaus`; the ends of a series are none."""
    w = _w(by, order)
    rows = df.withColumn("_next", F.lead(value).over(w)).withColumn("_new", F.when(F.lag(value).over(w) == F.col(value), F.lit(None)).otherwise(F.lag(value).over(w)))
    before = F.last("_new", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) if plateaus else F.lag(value).over(w)
    high = F.lit(True) if least is None else F.col(value) >= least
    return rows.withColumn("_before", before).where((F.col("_before") < F.col(value)) & (F.col("_next") < F.col(value)) & high).drop("_next", "_new", "_before")


def transitions(df: DataFrame, by: list[str], order: list[str], value: str, level: float, x: str | None = None) -> DataFrame:
    """Rows at which the series crosses the level, with `rising` and, if x is given, the position `at` where the line from the row before crosses it."""
    w, v = _w(by, order), F.col(value)
    rows = df.withColumn("rising", v > level).withColumn("_v", F.lag(v).over(w)).withColumn("_b", F.lag(v > level).over(w))
    if x is not None:
        before = F.lag(x).over(w)
        rows = rows.withColumn("_x", before).withColumn("at", F.col("_x") + (level - F.col("_v")) * (F.col(x) - F.col("_x")) / F.when(v != F.col("_v"), v - F.col("_v"))).drop("_x")
    return rows.where("_b IS NOT NULL AND _b <> rising").drop("_b", "_v")


def threshold(df: DataFrame, by: list[str], order: list[str], x: str, y: str, level: float) -> DataFrame:
    """(by, at): where a monotonic y reaches the level, on the line between the rows around it; groups that never do are absent."""
    found = transitions(df, by, order, y, level, x)
    return found.groupBy(*by).agg(F.min("at").alias("at"))


def clip(x: Column, low: float, low_value: float, high: float, high_value: float, infinite: float | None = None, nan: float | None = None) -> Column:
    """Values below `low` and above `high` replaced, and infinities and NaN where replacements are given."""
    out = F.when(x < low, F.lit(low_value)).when((x > high) & ~F.isnan(x), F.lit(high_value)).otherwise(x)
    if infinite is not None:
        out = F.when(F.abs(x) == sem.INF, F.lit(infinite)).otherwise(out)
    return out if nan is None else F.when(F.isnan(x), F.lit(nan)).otherwise(out)


def integrate(df: DataFrame, by: list[str], order: list[str], x: str, y: str, start: float, end: float) -> DataFrame:
    """The trapezoids of all segments whose left x lies in [start, end]."""
    w = _w(by, order)
    area = (F.lead(x).over(w) - F.col(x)) * (F.lead(y).over(w) + F.col(y)) / 2
    return df.withColumn("_a", area).where(F.col(x).between(start, end)).groupBy(*by).agg(F.sum("_a").alias("integral"))


def time_groups(df: DataFrame, by: list[str], order: list[str], gap: Column) -> DataFrame:
    """`tgroup`, from 0 in each group: a row begins the next one where `gap` holds (a condition on the row and _last, the order column's value before)."""
    w = _w(by, order)
    begins = F.coalesce(gap, F.lit(False)).cast("int")
    return df.withColumn("_last", F.lag(order[0]).over(w)).withColumn("_begins", begins).withColumn("tgroup", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_last", "_begins")
