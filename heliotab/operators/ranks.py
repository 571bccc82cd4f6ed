"""Order statistics of groups of any size and any distribution. A group of more than MANY values is narrowed down first: approximate percentiles, which Spark combines before the shuffle, bracket each wanted rank, again and again until a bracket holds few values. Then the values inside the brackets are counted, and only these, at most MANY for each rank but for repeats, are sorted."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliotab.functions import sem
from heliotab.operators.store import written

#: Bins between a group's least and greatest value.
BINS = 1000
#: Distinct values of a group that a task sorts for a rank; steps of the percentiles that bracket ranks in larger groups, and their accuracy, of a quarter of a step.
MANY, STEPS = 10_000, 256
ACCURACY = 4 * STEPS


def join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """A join on the columns in `by`, in which null equals null."""
    renamed = right.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *[c for c in right.columns if c not in by])
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return left.join(renamed, same, how).drop(*[f"_by{i}" for i in range(len(by))])


def binned(df: DataFrame, by: list[str], value: str, limits: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, limits): the finite values of each group as `_v` with their `_bin`, and n, low and high of each group."""
    rows = _finite(df, by, value)
    limits = limits_of(rows, by) if limits is None else limits
    width = (F.col("high") - F.col("low")) / BINS
    place = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("low")) / width), F.lit(BINS - 1))).otherwise(0)
    return join_groups(rows, limits, by).select(*by, "_v", place.cast("int").alias("_bin")), limits


def _counted(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """(by, key, m, s, before) for each key: rows, their sum, and the rows of the group with lower keys."""
    sums = rows.groupBy(*by, key).agg(F.count("*").alias("m"), F.sum("_v").alias("s"))
    return sums.withColumn("before", F.sum("m").over(Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)) - F.col("m"))


def _finite(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.select(*by, F.col(value).cast("double").alias("_v")).where(sem.is_finite(F.col("_v")))


def limits_of(rows: DataFrame, by: list[str]) -> DataFrame:
    return written(rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")))


def _narrowed(rows: DataFrame, by: list[str], state: DataFrame, names: list[str], shared: bool) -> DataFrame:
    """The brackets _lo and _hi (structs by name) of the ranks _at, made narrower where they may hold more than MANY values (_left), by percentiles of what is inside: two steps beyond those around the rank, eight times the percentiles' error. shared: all ranks still have the same bracket."""
    v, grid = F.col("_v"), F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    of = (lambda k: names[0]) if shared else (lambda k: k)
    inside = lambda k: v.between(F.col(f"_lo.{k}"), F.col(f"_hi.{k}"))
    large = join_groups(rows, state.where(F.greatest(F.lit(0), *[F.col(f"_left.{k}") for k in names]) > MANY).select(*by, "_lo", "_hi"), by)
    sums = large.groupBy(*by).agg(*[x for k in (names[:1] if shared else names) for x in (F.count_if(v < F.col(f"_lo.{k}")).alias(f"_before_{k}"), F.count_if(inside(k)).alias(f"_m_{k}"), F.percentile_approx(F.when(inside(k), v), grid, ACCURACY).alias(f"_grid_{k}"))])
    both = join_groups(state, sums, by, "left")
    many = lambda k: (F.col(f"_left.{k}") > MANY) & F.col(f"_m_{of(k)}").isNotNull()
    step = lambda k: F.floor((F.col(f"_at.{k}") - F.col(f"_before_{of(k)}")) * STEPS / F.col(f"_m_{of(k)}")).cast("int")
    low = {k: F.when(many(k), F.get(f"_grid_{of(k)}", F.greatest(step(k) - 2, F.lit(0)))).otherwise(F.col(f"_lo.{k}")) for k in names}
    high = {k: F.when(many(k), F.get(f"_grid_{of(k)}", F.least(step(k) + 3, F.lit(STEPS)))).otherwise(F.col(f"_hi.{k}")) for k in names}
    left = {k: F.when(many(k), F.when(low[k] == high[k], 1).otherwise(F.ceil(F.col(f"_m_{of(k)}") * 6 / STEPS))).otherwise(F.col(f"_left.{k}")) for k in names}
    pack = lambda cs, out: F.struct(*[c.alias(k) for k, c in cs.items()]).alias(out)
    return written(both.select(*by, "n", "low", "high", "_at", pack(low, "_lo"), pack(high, "_hi"), pack(left, "_left")))


def at_ranks(df: DataFrame, by: list[str], value: str, wanted: dict[str, Column], limits: DataFrame | None = None) -> DataFrame:
    """(by, n, and each name): the values at ranks, from 0 on, of each group's sorted finite values. wanted: by name, whole numbers as expressions of n, the group's size; what is beyond the group counts as its end.

    The groups' sizes and limits are read first and written to the shared folder, and with groups of more than MANY values the brackets too, so jobs run while the plan is built; one number comes to the driver each time. A round narrows a bracket to some 6 in STEPS of its values.
    """
    rows, names = _finite(df, by, value), list(wanted)
    state = limits_of(rows, by) if limits is None else limits
    same = lambda c: F.struct(*[c.alias(k) for k in names])
    ranks = F.struct(*[F.greatest(F.least(c.cast("long"), F.col("n") - 1), F.lit(0).cast("long")).alias(k) for k, c in wanted.items()])
    state = state.select(*by, "n", "low", "high", ranks.alias("_at"), same(F.col("low")).alias("_lo"), same(F.col("high")).alias("_hi"), same(F.when(F.col("low") == F.col("high"), 1).otherwise(F.col("n"))).alias("_left"))
    narrowed = False
    while (state.agg(F.max(F.greatest(F.lit(0), *[F.col(f"_left.{k}") for k in names]))).first()[0] or 0) > MANY:
        state, narrowed = _narrowed(rows, by, state, names, not narrowed), True
    v = F.col("_v")
    if narrowed:
        # A value below or above a rank's bracket counts under one key, so only those inside are told apart.
        place = lambda k: F.when(v < F.col(f"_lo.{k}"), -1).when(v > F.col(f"_hi.{k}"), 1).otherwise(0)
        keys = F.array(*[F.struct(F.lit(k).alias("name"), place(k).alias("place"), F.when(place(k) == 0, v).alias("v")) for k in names])
        counts = join_groups(rows, state.select(*by, "_lo", "_hi"), by).select(*by, F.explode(keys).alias("_k")).groupBy(*by, F.col("_k.name").alias("_name"), F.col("_k.place").alias("_place"), F.col("_k.v").alias("_v")).agg(F.count("*").alias("m"))
        over = Window.partitionBy(*by, "_name").orderBy("_place", "_v")
    else:
        counts = rows.groupBy(*by, "_v").agg(F.count("*").alias("m"))
        over = Window.partitionBy(*by).orderBy("_v")
    counts = counts.withColumn("_to", F.sum("m").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    both = join_groups(counts, state.select(*by, "n", "_at"), by)
    hit = lambda k: (F.col(f"_at.{k}") < F.col("_to")) & (F.col(f"_at.{k}") >= F.col("_to") - F.col("m")) & ((F.col("_name") == k) if narrowed else F.lit(True))
    return both.groupBy(*by).agg(F.first("n").alias("n"), *[F.max(F.when(hit(k), v)).alias(k) for k in names])


def quantiles(df: DataFrame, by: list[str], value: str, wanted: dict[str, float], limits: DataFrame | None = None) -> DataFrame:
    """The exact quantiles of each group, by name, linear between neighbouring values; those that aren't finite are left out."""
    at = {name: (F.col("n") - 1) * F.lit(float(q)) for name, q in wanted.items()}
    ends = at_ranks(df, by, value, {f"_{name}_{k}": F.floor(x) + k for name, x in at.items() for k in (0, 1)}, limits)
    a, b = lambda name: F.col(f"_{name}_0"), lambda name: F.col(f"_{name}_1")
    return ends.select(*by, *[(a(name) + (b(name) - a(name)) * (x - F.floor(x))).alias(name) for name, x in at.items()])


def window_mean(df: DataFrame, by: list[str], value: str, first: Column, end: Column) -> DataFrame:
    """(by, value, used): the mean of each group's sorted finite values from rank `first` to before rank `end` (expressions of n, the group's size), and how many these are. The values at both ends are found first; of those equal to them, as many count as ranks say."""
    state = at_ranks(df, by, value, {"_a": first, "_b": end - 1})
    state = written(state.withColumn("_from", F.greatest(first.cast("long"), F.lit(0))).withColumn("_to", F.least(end.cast("long"), F.col("n"))).where("_from < _to"))
    rows, v, a, b = join_groups(_finite(df, by, value), state, by), F.col("_v"), F.col("_a"), F.col("_b")
    inner = (v > a) & (v < b)
    sums = rows.groupBy(*by).agg(F.sum(F.when(inner, v)).alias("s"), F.count_if(inner).alias("m"), F.count_if(v <= a).alias("upto"), *[F.first(c).alias(c) for c in ("_a", "_b", "_from", "_to")])
    used = F.col("_to") - F.col("_from")
    low = F.when(F.col("_a") == F.col("_b"), used).otherwise(F.col("upto") - F.col("_from"))
    total = F.coalesce("s", F.lit(0.0)) + F.col("_a") * low + F.col("_b") * (used - low - F.col("m"))
    return sums.select(*by, (total / used).alias("value"), used.alias("used"))


def modes(df: DataFrame, by: list[str], value: str, limits: DataFrame | None = None) -> DataFrame:
    """(by, mode, binned_median): the lower edge of the fullest of BINS bins (the first of equals), and of the bin in which half of the values is reached."""
    rows, limits = binned(df, by, value, limits)
    counts = _counted(rows, by, "_bin")
    both = join_groups(counts, limits, by)
    edge = F.col("low") + F.col("_bin") * (F.col("high") - F.col("low")) / BINS
    half = F.when((F.col("before") + F.col("m")) * 2 >= F.col("n"), edge)
    return both.groupBy(*by).agg(F.min_by(edge, F.struct(-F.col("m"), F.col("_bin"))).alias("mode"), F.min(half).alias("binned_median"))
