"""Joins that an equality of keys doesn't say: first matches, bands, nearest values, brackets, intervals and the sky."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliotab.functions import libm, sky
from heliotab.operators.store import written


#: Degrees a side of the tiles that tell whether a position is in the catalogue's reach.
TILE = 10.0


def first_match(left: DataFrame, right: DataFrame, key: str, order: str, index: str) -> DataFrame:
    """Each left row with `index` of the first right row by `order` that has its key, or -1. The right side is reduced to one row a key before the join."""
    first = right.groupBy(key).agg(F.min_by(index, order).alias(index))
    return left.join(first, key, "left").fillna({index: -1})


def full_of_few_keys(left: DataFrame, right: DataFrame, a: str, b: str, salt: list[str], rows: int = 1024) -> DataFrame:
    """The full join on a = b where few keys have many rows on either side. Left rows are dealt by a hash of the columns in salt into parts, one for each `rows` of them, and right rows sent to each part, in tasks as many as parts; so what a task makes grows with the right side alone. Rows without a partner are found by the keys."""
    parts = max(1, -(-left.count() // rows))
    dealt = left.withColumn("_part", F.pmod(F.xxhash64(*salt), F.lit(parts)))
    sent = right.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    tasks = max(parts, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = dealt.repartition(tasks, a, "_part").join(sent.repartition(tasks, b, "_part"), (dealt[a] == sent[b]) & (dealt["_part"] == sent["_part"])).drop("_part")
    alone = left.join(right.select(F.col(b).alias("_key")).distinct(), F.col(a) == F.col("_key"), "left_anti")
    other = right.join(left.select(F.col(a).alias("_key")).distinct(), F.col(b) == F.col("_key"), "left_anti")
    return both.unionByName(alone, allowMissingColumns=True).unionByName(other, allowMissingColumns=True)


def band(left: DataFrame, right: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    """All pairs with |x - y| < radius. Values fall into cells of the radius' width; the right side stands in its own cell and both neighbours, so the join is one of equal keys."""
    a = left.withColumn("_cell", F.floor(F.col(x) / radius))
    own = F.floor(F.col(y) / radius)
    b = right.withColumn("_cell", F.explode(F.array(own - 1, own, own + 1)))
    return a.join(b, "_cell").where(F.abs(F.col(x) - F.col(y)) < radius).drop("_cell")


def nearest_within(left: DataFrame, right: DataFrame, key: str, x: str, y: str, radius: float, tie: str) -> DataFrame:
    """Each left row's key and x with `tie`, the number of the nearest right row strictly within the radius, the least among equals, or -1. Right rows are reduced to one a value; rows and values are merged by one sort in either direction of each cell of the radius' width, so no pairs are made."""
    marks = right.where(F.col(y).isNotNull()).groupBy(F.col(y).alias("_at")).agg(F.min(tie).alias("_tie"))
    own = F.floor(F.col("_at") / radius)
    marks = marks.select("_at", F.explode(F.array(own - 1, own, own + 1)).alias("_cell"), F.struct("_at", "_tie").alias("_mark"), F.lit(0).alias("_row"))
    rows = left.where(F.col(x).isNotNull()).select(key, x, F.col(x).alias("_at"), F.floor(F.col(x) / radius).alias("_cell"), F.lit(1).alias("_row"))
    up = Window.partitionBy("_cell").orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_cell").orderBy(F.desc("_at"), "_row").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn("_below", F.last("_mark", ignorenulls=True).over(up)).withColumn("_above", F.last("_mark", ignorenulls=True).over(down)).where("_row = 1")
    reached = lambda m: F.when(F.abs(F.col(x) - F.col(f"{m}._at")) < radius, F.struct(F.abs(F.col(x) - F.col(f"{m}._at")).alias("d"), F.col(f"{m}._tie").alias(tie)))
    found = both.select(key, x, F.coalesce(F.least(reached("_below"), reached("_above"))[tie], F.lit(-1)).alias(tie))
    return found.unionByName(left.where(F.col(x).isNull()).select(key, x, F.lit(-1).cast(found.schema[tie].dataType).alias(tie)))


def bracket(df: DataFrame, steps: DataFrame, by: list[str], x: str, at: str, value: str) -> DataFrame:
    """Each row with `value` of the last step of its group at or before x (null before the first). Rows and steps are merged by one sort for each group; no pairs are made."""
    rows = df.withColumn("_v", F.lit(None).cast(steps.schema[value].dataType)).withColumn("_at", F.col(x)).withColumn("_row", F.lit(1))
    marks = steps.select(*by, F.col(value).alias("_v"), F.col(at).alias("_at"), F.lit(0).alias("_row"))
    w = Window.partitionBy(*by).orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn(value, F.last("_v", ignorenulls=True).over(w))
    return both.where("_row = 1").drop("_v", "_at", "_row")


def inside(points: DataFrame, spans: DataFrame, t: str, start: str, end: str, width: float) -> DataFrame:
    """All pairs of a point and a span with start <= t < end; numbers. Spans stand in each cell of `width` that they touch, so choose it near their usual length."""
    p = points.withColumn("_cell", F.floor(F.col(t) / width))
    s = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(s, "_cell").where((F.col(t) >= F.col(start)) & (F.col(t) < F.col(end))).drop("_cell")


def _cells(ra: Column, dec: Column, size: float, around: bool) -> Column:
    """Cells of unit-vector space of the given size: a position's own, or it and its 26 neighbours. Such cells know no pole and no seam at right ascension 0."""
    x, y, z = (F.floor(c / size) for c in sky.unit_vector(ra, dec))
    if not around:
        return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    return F.flatten(F.flatten(F.transform(near, lambda i: F.transform(near, lambda j: F.transform(near, lambda k: F.struct((x + i).alias("x"), (y + j).alias("y"), (z + k).alias("z")))))))


#: Right rows of a cell that are met in one place: of a cell with more, they are dealt out, and what meets them goes to each part. Half of what Spark's merge join keeps of a key without a spill, since parts differ in size.
CROWD = 2048


def sky_cells(left: DataFrame, right: DataFrame, size: float, a: tuple[str, str], b: tuple[str, str], by: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """All pairs of neighbouring cells of unit-vector space, with equal columns `by`, and the unit vectors _lx, _ly, _lz and _rx, _ry, _rz. Pairs grow with the square of a crowd, where rows stay few: so cells are dealt out by their right rows, merged, and not put together by size. The left side is the one to be repeated: give the smaller."""
    keys = ["_x", "_y", "_z", *(by or [])]
    vector = lambda side, c: [v.alias(f"_{side}{k}") for k, v in zip("xyz", sky.unit_vector(F.col(c[0]), F.col(c[1])))]
    r_ = right.select("*", *vector("r", b)).select("*", *[F.floor(F.col(f"_r{k}") / size).alias(f"_{k}") for k in "xyz"])
    l_ = left.select("*", *vector("l", a), F.explode(_cells(F.col(a[0]), F.col(a[1]), size, True)).alias("_cell")).select("*", *[F.col(f"_cell.{k}").alias(f"_{k}") for k in "xyz"]).drop("_cell")
    crowds = F.broadcast(r_.groupBy(*keys).agg(F.ceil(F.count("*") / CROWD).alias("_parts")).where("_parts > 1"))
    parts = F.coalesce("_parts", F.lit(1))
    l_ = l_.join(crowds, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    r_ = r_.join(crowds, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*right.columns), parts)).drop("_parts")
    tasks = tasks or 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys.append("_part")
    return l_.repartition(tasks, *keys).hint("merge").join(r_.repartition(tasks, *keys), keys).drop("_x", "_y", "_z", "_part")


_VECTORS = ("_lx", "_ly", "_lz", "_rx", "_ry", "_rz")


def _chord2() -> Column:
    x, y, z = (F.col(f"_l{k}") - F.col(f"_r{k}") for k in "xyz")
    return x * x + y * y + z * z


def sky_near(left: DataFrame, right: DataFrame, radians: float, a: tuple[str, str], b: tuple[str, str], by: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """All pairs within the radius with equal columns `by`, and such as are beyond it by rounding. A chord is shorter than its arc, so pairs in reach are in neighbouring cells of the radius' size."""
    chord2 = 4 * math.sin(min(radians, math.pi) / 2) ** 2
    return sky_cells(left, right, max(radians, 1e-9) * 1.0001, a, b, by, tasks).where(_chord2() <= chord2 * (1 + 1e-9) + 1e-24).drop(*_VECTORS)


#: Pairs that a task tells, and rows that it is sent, about.
_PAIRS, _SENT = 50_000_000, 500_000


def sky_tasks(left: DataFrame, right: DataFrame, radians: float) -> int:
    """Tasks for a join of all pairs within a radius, by the pairs of neighbouring cells that there are if positions are spread over the sky. Counts both sides."""
    few, many = left.count(), right.count()
    pairs = few * many * min(1.0, 2 * radians**2)
    return int(max(2 * left.sparkSession.sparkContext.defaultParallelism, pairs / _PAIRS, (27 * few + many) / _SENT))


def sky_radius(left: DataFrame, right: DataFrame, radius_arcsec: float, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """All pairs within the radius, with `arcsec`. Pairs of neighbouring cells are merged and told by chords, so neither side is broadcast and angles are taken of pairs in reach alone. The left side is the one to be repeated: give the smaller. Counts both sides while the plan is built."""
    radians = radius_arcsec / 206264.806247
    pairs = sky_near(left, right, radians, a, b, tasks=sky_tasks(left, right, radians))
    return pairs.withColumn("arcsec", sky.separation_arcsec(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1]))).where(F.col("arcsec") < radius_arcsec)


def nearest(left: DataFrame, right: DataFrame, key: str, tie: str, radius_arcsec: float, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """(key, _m): arcsec and tie of each left row's nearest right row within the radius. Distances are the C library's, so that those which are equal but for rounding are ordered as SQL orders them."""
    pairs = sky_near(left.select(key, *a), right.select(tie, *b), radius_arcsec / 206264.806247, a, b)
    pairs = pairs.select(key, tie, libm.separation_arcsec(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1])).alias("arcsec"))
    return pairs.groupBy(key).agg(F.min(F.struct("arcsec", tie)).alias("_m")).where(F.col("_m.arcsec") < radius_arcsec)


def sky_nearest(left: DataFrame, right: DataFrame, key: str, radius_arcsec: float, a: tuple[str, str], b: tuple[str, str], tie: str) -> DataFrame:
    """Each left row's key and position with `tie`, the number of its nearest right row within the radius, the least among equals, and `arcsec`. Without one, the number is -2, or -1 where the tile of TILE degrees that holds the position has no right row at all. The nearest is a minimum, combined before the shuffle; tiles of the sky are few and broadcast. A null declination is in no tile, and those that aren't numbers have tiles of their own."""
    best = nearest(left, right, key, tie, radius_arcsec, a, b)
    row = lambda dec: F.when(F.isnan(dec), -1).when(F.col(dec).isNotNull(), F.least(F.floor((F.col(dec) + 90) / TILE), F.lit(int(180 / TILE) - 1)))
    tile = lambda ra, dec: (F.floor(F.pmod(F.col(ra), F.lit(360.0)) / TILE).alias("_ra"), row(dec).alias("_dec"))
    tiles = right.select(*tile(*b)).distinct().withColumn("_there", F.lit(True))
    found = left.select(key, *a, *tile(*a)).join(best, key, "left").join(F.broadcast(tiles), ["_ra", "_dec"], "left")
    missing = F.when(F.col("_there"), F.lit(-2)).otherwise(-1)
    return found.select(key, *a, F.coalesce(f"_m.{tie}", missing).alias(tie), F.col("_m.arcsec").alias("arcsec"))


def nearest_of_group(left: DataFrame, right: DataFrame, by: str, key: str, a: tuple[str, str], b: tuple[str, str], tie: str) -> DataFrame:
    """(key, tie, radians) of each left row's nearest right row of the same group, however far, the least `tie` among equals. Positions in degrees; rows with a null or without a partner in their group are left out.

    Pairs are joined by group and cell within a radius at which the largest group has about sixteen partners in reach, were it spread over the sky; rows that find none go on with three times the radius. So a group is never paired with itself whole, and a large one is spread over its cells. Runs jobs while the plan is built.
    """
    left = left.select(key, by, *a).where(reduce(lambda m, c: m & F.col(c).isNotNull() & ~F.isnan(c), a, F.lit(True)))
    right = written(right.select(by, tie, *b).where(reduce(lambda m, c: m & F.col(c).isNotNull() & ~F.isnan(c), b, F.lit(True))))
    most = right.groupBy(by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    rest = written(left.join(right.select(by).distinct(), by, "left_semi").select(key, by, *a))
    radius, found = min(1.0, 4.0 / math.sqrt(most or 1)), []
    while True:
        last = radius >= math.pi
        l1, b1, l2, b2 = (F.radians(c) for c in (*a, *b))
        pairs = sky_near(rest, right, radius, a, b, [by]).select(key, tie, libm.arc(b1, b2, b2 - b1, l2 - l1).alias("radians"))
        best = pairs.groupBy(key).agg(F.min(F.struct("radians", tie)).alias("_m")).where(F.lit(last) | (F.col("_m.radians") < radius))
        found.append(written(best.select(key, f"_m.{tie}", "_m.radians")))
        rest = written(rest.join(found[-1].select(key), key, "left_anti"))
        if last or not rest.limit(1).count():
            return reduce(DataFrame.unionByName, found)
        radius = min(3 * radius, math.pi)
