"""Moving objects among detections: pairs, triples on a line, and tracks of these, by cells of time and place. The triples of a field are found tile by tile, so that pairs, of which there are far more than detections, are not shuffled.

Spark takes rows that are sent to several cells for as few as they were before, and would broadcast millions of them through the driver; so such joins are merges.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from heliotab.functions import sem
from heliotab.operators.graphs import components
from heliotab.operators.store import written


#: Second detections of a tile that one task takes at most; detections that a task is sent, about; candidates tested at once, and triples given back at once.
_CROWD, _SENT, _TESTED, _OUT = 8192, 200_000, 500_000, 100_000


def _cell(c: Column | str, size: float) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / size)


def _apart(x: Column, y: Column) -> Column:
    """The length of (x, y), as SQL writes it."""
    return F.sqrt(x * x + y * y)


def _around(df: DataFrame, x: Column, y: Column, size: float) -> DataFrame:
    """Each row for the cell of (x, y) and its eight neighbours, as cx and cy."""
    near = F.array(*[F.struct((_cell(x, size) + i).alias("cx"), (_cell(y, size) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return df.withColumn("_c", F.explode(near)).withColumn("cx", F.col("_c.cx")).withColumn("cy", F.col("_c.cy")).drop("_c")


def standing(detections: DataFrame, tolerance: float) -> DataFrame:
    """The ids of detections (id, t, x, y) that have one of another time within the tolerance: of what doesn't move. Cells around which all detections are of one time are left out first."""
    size = tolerance * 1.0001  # what is just in reach isn't two cells away
    own = detections.select("id", "t", "x", "y", _cell("x", size).alias("cx"), _cell("y", size).alias("cy"))
    places = written(own.groupBy("t", "cx", "cy").agg(F.count("*").alias("n")))
    spread = places.select("cx", "cy", "t").groupBy("cx", "cy").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    around = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = spread.select(F.explode(around).alias("c"), "first", "last").groupBy(F.col("c.cx").alias("cx"), F.col("c.cy").alias("cy")).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    maybe = own.join(near.hint("merge"), ["cx", "cy"]).where("first < t OR last > t").drop("first", "last")  # few, unless things stand
    other = _around(maybe.select(F.col("t").alias("t2"), F.col("x").alias("x2"), F.col("y").alias("y2")), F.col("x2"), F.col("y2"), size).drop("x", "y")
    met = maybe.join(other.hint("merge"), ["cx", "cy"]).where((F.col("t") != F.col("t2")) & (_apart(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")) <= tolerance))
    return met.select("id").distinct()


def tracklets(detections: DataFrame, speed: float, gap: float) -> DataFrame:
    """(a, b, t, t2, x, y, x2, y2): pairs of detections (id, t, x, y), the second up to `gap` later and no further than speed times the time between. Both are found in cells of time and place that are as large as what is in reach, so each detection meets its neighbourhood alone."""
    size = speed * gap * 1.0001
    own = detections.select(F.col("id").alias("a"), "t", "x", "y", _cell("t", gap).alias("ct"))
    own = own.withColumn("ct", F.explode(F.array(F.col("ct"), F.col("ct") + 1)))
    own = _around(own, F.col("x"), F.col("y"), size)
    other = detections.select(F.col("id").alias("b"), F.col("t").alias("t2"), F.col("x").alias("x2"), F.col("y").alias("y2"), _cell("t", gap).alias("ct"), _cell("x", size).alias("cx"), _cell("y", size).alias("cy"))
    dt = F.col("t2") - F.col("t")
    near = own.join(other.hint("merge"), ["ct", "cx", "cy"]).where((dt > 0) & (dt <= gap) & (_apart(F.col("x2") - F.col("x"), F.col("y2") - F.col("y")) <= speed * dt))
    return near.select("a", "b", "t", "t2", "x", "y", "x2", "y2")


def triples(detections: DataFrame, pairs: DataFrame, gap: float, tolerance: float) -> DataFrame:
    """(a, b, c, vx, vy, off): pairs carried on to each time at which there are detections, up to `gap` after the second, and the detections there within the tolerance of the place foretold. Pairs meet detections by time and cell of that place, so no pair meets more than what stands there; detections, which are fewer, are sent to the cells around their own."""
    times = detections.select(F.col("t").alias("t3")).distinct().withColumn("ct", _cell("t3", gap))
    later = pairs.withColumn("ct", F.explode(F.array(_cell("t2", gap), _cell("t2", gap) + 1))).join(times, "ct").where((F.col("t3") > F.col("t2")) & (F.col("t3") <= F.col("t2") + gap))
    rate = lambda c: F.try_divide(F.col(f"{c}2") - F.col(c), F.col("t2") - F.col("t"))
    size, later_by = tolerance * 1.0001, F.col("t3") - F.col("t2")
    foretold = later.select("a", "b", "t2", "t3", "x2", "y2", rate("x").alias("vx"), rate("y").alias("vy"), *[_cell(F.col(f"{c}2") + rate(c) * later_by, size).alias(f"c{c}") for c in "xy"])
    third = _around(detections.select(F.col("id").alias("c"), F.col("t").alias("t3"), "x", "y"), F.col("x"), F.col("y"), size)
    off = _apart(F.col("x") - F.col("x2") - F.col("vx") * later_by, F.col("y") - F.col("y2") - F.col("vy") * later_by)
    return foretold.join(third.hint("merge"), ["t3", "cx", "cy"]).withColumn("off", off).where(F.col("off") <= tolerance).select("a", "b", "c", "vx", "vy", "off")


class _Cells:
    """Places that are sorted by square cells; `wide`: cells from one column to the next."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, y: np.ndarray, size: float, wide: int):
        self.size, self.wide = size, wide
        codes = self.code(x[rows], y[rows])
        order = np.argsort(codes, kind="stable")
        self.rows, self.codes = rows[order], codes[order]

    def code(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x / self.size).astype(np.int64) * self.wide + (y / self.size).astype(np.int64)

    def around(self, x: np.ndarray, y: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number, row) of the given places and the rows in up to `reach` cells from theirs, some _TESTED at once."""
        own = self.code(x, y)
        for column in range(-reach, reach + 1):
            first = np.searchsorted(self.codes, own + column * self.wide - reach)
            sizes = np.searchsorted(self.codes, own + column * self.wide + reach, "right") - first
            ends = np.cumsum(sizes)
            i = 0
            while i < len(own):
                before = ends[i] - sizes[i]
                j = max(i + 1, int(np.searchsorted(ends, before + _TESTED, "right")))
                n = np.repeat(np.arange(i, j), sizes[i:j])
                yield n, self.rows[np.arange(len(n)) + (first - ends + sizes)[n] + before]
                i = j


def _lines(t: np.ndarray, x: np.ndarray, y: np.ndarray, mine: np.ndarray, speed: float, gap: float, tolerance: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(a, b, c, vx, vy, off) of all triples of detections, by their numbers, whose second is one of `mine`. Times are taken one by one, or by sixteenths of the gap where they are many. Pairs are found by cells of half of what is in reach; the places they lead to are looked up in a map of where detections are, and only what is found there is compared."""
    halo = 2 * (speed * gap + tolerance)
    px, py = x - x.min() + halo, y - y.min() + halo
    wide = max(px.max(), py.max()) + halo
    times, of = np.unique(t, return_inverse=True)
    if len(times) > 64:
        of = np.unique(np.floor(t * 16 / gap), return_inverse=True)[1]
    order = np.argsort(of, kind="stable")
    slots = np.split(order, np.searchsorted(of[order], np.arange(1, of.max() + 1)))
    low, high = [float(t[s].min()) for s in slots], [float(t[s].max()) for s in slots]
    size = max(speed * gap / 2 * 1.0001, wide / 1024)
    cells = [_Cells(s, px, py, size, int(wide / size) + 4) for s in slots]
    maps: dict[int, tuple[_Cells, np.ndarray]] = {}

    def mapped(k: int) -> tuple[_Cells, np.ndarray]:
        if k not in maps:
            fine = max((tolerance + speed * (high[k] - low[k]) / 2) * 1.0001, wide / 1024)
            there = _Cells(slots[k], px, py, fine, int(wide / fine) + 4)
            marks = np.zeros(there.wide * there.wide, dtype=bool)
            for column in (-1, 0, 1):
                for row in (-1, 0, 1):
                    marks[there.codes + column * there.wide + row] = True
            maps[k] = there, marks
        return maps[k]

    for j, own in enumerate(slots):
        second = own[mine[own]]
        for i in range(len(slots) if len(second) else 0):
            if high[j] <= low[i] or low[j] - high[i] > gap:
                continue
            for n, a in cells[i].around(px[second], py[second], math.ceil(speed * min(gap, high[j] - low[i]) * 1.0001 / size)):
                b = second[n]
                dt, dx, dy = t[b] - t[a], x[b] - x[a], y[b] - y[a]
                good = np.flatnonzero((dt > 0) & (dt <= gap) & (np.sqrt(dx * dx + dy * dy) <= speed * dt))
                a, b, dt = a[good], b[good], dt[good]
                vx, vy = dx[good] / dt, dy[good] / dt
                for k in range(len(slots) if len(a) else 0):
                    if high[k] <= low[j] or low[k] > high[j] + gap:
                        continue
                    there, marks = mapped(k)
                    later = (low[k] + high[k]) / 2 - t[b]
                    fx, fy = px[b] + vx * later, py[b] + vy * later
                    hit = np.flatnonzero(marks[there.code(fx, fy)])
                    for m, c in there.around(fx[hit], fy[hit], 1):
                        m = hit[m]
                        dt = t[c] - t[b[m]]
                        ox, oy = x[c] - x[b[m]] - vx[m] * dt, y[c] - y[b[m]] - vy[m] * dt
                        off = np.sqrt(ox * ox + oy * oy)
                        good = (dt > 0) & (t[c] <= t[b[m]] + gap) & (off <= tolerance)
                        m = m[good]
                        yield a[m], b[m], c[good], vx[m], vy[m], off[good]


def _tiles(detections: DataFrame, speed: float, gap: float, tolerance: float) -> DataFrame:
    """A row for each square tile of the field, with a list _rows of the detections (id, t, x, y, mine) that are in reach of it; those of the tile itself are `mine`. Tiles of many detections are several rows, each with all that is in reach, and each detection `mine` in one of them. Counts the detections while the plan is built."""
    halo = (speed * gap + tolerance) * 1.0001
    rows = detections.select("id", *[F.col(c).cast("double").alias(c) for c in "txy"])
    for c in "txy":
        rows = rows.where(sem.is_finite(F.col(c)))
    tile = {c: _cell(c, 4 * halo) for c in "xy"}
    crowds = rows.groupBy(tile["x"].alias("_i"), tile["y"].alias("_j")).agg(F.ceil(F.count("*") / _CROWD).alias("_parts")).where("_parts > 1")  # of each some thousand detections one at most, so it may be broadcast
    sent = rows.withColumn("_i", F.explode(F.sequence(_cell(F.col("x") - halo, 4 * halo), _cell(F.col("x") + halo, 4 * halo)))).withColumn("_j", F.explode(F.sequence(_cell(F.col("y") - halo, 4 * halo), _cell(F.col("y") + halo, 4 * halo))))
    sent = sent.join(F.broadcast(crowds), ["_i", "_j"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    sent = sent.withColumn("mine", (F.col("_i") == tile["x"]) & (F.col("_j") == tile["y"]) & (F.pmod(F.xxhash64("id"), F.col("_parts")) == F.col("_part")))
    tasks = max(2 * detections.sparkSession.sparkContext.defaultParallelism, 5 * rows.count() // (2 * _SENT))  # stated: detections are few for their work, and would be put together
    return sent.repartition(tasks, "_i", "_j", "_part").groupBy("_i", "_j", "_part").agg(F.collect_list(F.struct("id", "t", "x", "y", "mine")).alias("_rows"))


def _each(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, tuple[np.ndarray, ...]]]:
    """The ids, and t, x, y, mine, of each tile of a batch."""
    held = batch.column("_rows")
    ends = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))])
    every = held.flatten()
    ids, numbers = every.field("id"), [every.field(c).to_numpy(zero_copy_only=False) for c in ("t", "x", "y", "mine")]
    for i, j in zip(ends[:-1], ends[1:]):
        yield ids[i:j], tuple(v[i:j] for v in numbers)


def lines(detections: DataFrame, speed: float, gap: float, tolerance: float) -> DataFrame:
    """(a, b, c, vx, vy, off): the same as triples(detections, tracklets(detections, speed, gap), gap, tolerance), but for rows that aren't finite, which are left out. Each tile finds the triples whose second detection it holds, so what is shuffled is some two to three times the detections, and neither pairs nor the places they lead to."""
    kind = detections.schema["id"].dataType
    schema = StructType([*[StructField(c, kind) for c in "abc"], *[StructField(c, DoubleType()) for c in ("vx", "vy", "off")]])

    def given(ids, out):
        whole = [np.concatenate(v) for v in zip(*out)]
        return pa.RecordBatch.from_arrays([*[ids.take(pa.array(v)) for v in whole[:3]], *map(pa.array, whole[3:])], names=schema.names)

    def run(batches):
        for batch in batches:
            for ids, numbers in _each(batch):
                out, size = [], 0
                for found in _lines(*numbers, speed, gap, tolerance):
                    out.append(found)
                    size += len(found[0])
                    if size >= _OUT:
                        yield given(ids, out)
                        out, size = [], 0
                if size:
                    yield given(ids, out)

    return _tiles(detections, speed, gap, tolerance).select("_rows").mapInArrow(run, schema)


def _chained(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, root) of all pairs in triples (a, b, c) of n detections; pairs (a, b) and (b, c) are linked, and root is the number of the least pair of a chain of them."""
    pairs, of = np.unique(np.concatenate([a * n + b, b * n + c]), return_inverse=True)
    u, w = of[: len(a)], of[len(a) :]
    root = np.arange(len(pairs))
    while True:
        low, high = np.minimum(root[u], root[w]), np.maximum(root[u], root[w])
        apart = low != high
        if not apart.any():
            return pairs // n, pairs % n, root
        u, w = u[apart], w[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def tracks_of(detections: DataFrame, speed: float, gap: float, tolerance: float) -> DataFrame:
    """(track, id): the same as tracks(lines(...)); ids are whole numbers. Triples are linked in the tile that finds them. Only chains with a pair that another tile may have as well, one of its detections being there, are linked further, by these pairs; so the graph of all triples is never made."""
    long_ = LongType()
    schema = StructType([StructField(c, long_) for c in ("ra", "rb", "id", "name", "la", "lb")] + [StructField("open", BooleanType())])

    def run(batches):
        for batch in batches:
            for ids, (t, x, y, mine) in _each(batch):
                found = [v[:3] for v in _lines(t, x, y, mine, speed, gap, tolerance)]
                if not sum(len(v[0]) for v in found):
                    continue
                n, name = len(ids), ids.to_numpy(zero_copy_only=False).astype(np.int64)
                first, second, root = _chained(*(np.concatenate(v) for v in zip(*found)), n)
                shared = ~(mine[first] & mine[second])
                open_ = np.zeros(len(root), dtype=bool)
                open_[root[shared]] = True
                members = np.unique(np.concatenate([root * n + first, root * n + second]))
                of, detection = members // n, name[members % n]
                least = np.full(len(root), np.iinfo(np.int64).max)
                np.minimum.at(least, of, detection)
                at = np.concatenate([of, root[shared]])
                empty = [np.zeros(k, dtype=np.int64) for k in (len(of), int(shared.sum()))]
                link = np.arange(len(at)) >= len(of)
                columns = [name[first[at]], name[second[at]], pa.array(np.concatenate([detection, empty[1]]), mask=link), pa.array(np.concatenate([least[of], empty[1]]), mask=link), pa.array(np.concatenate([empty[0], name[first[shared]]]), mask=~link), pa.array(np.concatenate([empty[0], name[second[shared]]]), mask=~link), open_[at]]
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns], names=schema.names)

    found = written(_tiles(detections, speed, gap, tolerance).select("_rows").mapInArrow(run, schema))
    node = F.struct(F.col("ra").alias("a"), F.col("rb").alias("b"))
    links = found.where("la IS NOT NULL").groupBy("la", "lb").agg(F.min(node).alias("a"), F.max(node).alias("b")).where("a <> b").select("a", "b")
    open_ = found.where("open AND id IS NOT NULL").select(node.alias("node"), "id", "name")
    chains = open_.groupBy("node").agg(F.min("name").alias("name")).join(components(links).hint("merge"), "node", "left").select("node", "name", F.coalesce("root", "node").alias("root"))
    chains = written(chains)
    names = chains.groupBy("root").agg(F.min("name").alias("track"))
    named = chains.select("node", "root").join(names.hint("merge"), "root").select("node", "track")
    whole = open_.select("node", "id").join(named.hint("merge"), "node").select("track", "id")
    return whole.unionByName(found.where("NOT open").select(F.col("name").alias("track"), "id")).distinct()


def tracks(found: DataFrame) -> DataFrame:
    """(track, id): detections of triples (a, b, c), of which two with a pair in common, the last of one and the first of the other, are of one track. A track's name is its least detection; a detection may be on several."""
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    nodes = found.select(F.explode(F.array(pair("a", "b"), pair("b", "c"))).alias("p")).distinct()
    nodes = written(nodes.select("p.a", "p.b").withColumn("n", F.monotonically_increasing_id()))
    of = lambda a, b, out: nodes.select(F.col("a").alias(a), F.col("b").alias(b), F.col("n").alias(out))
    edges = found.select("a", "b", "c").join(of("a", "b", "u").hint("merge"), ["a", "b"]).join(of("b", "c", "v").hint("merge"), ["b", "c"]).select(F.col("u").alias("a"), F.col("v").alias("b"))
    roots = components(edges).select(F.col("node").alias("n"), "root")
    own = nodes.join(roots.hint("merge"), "n", "left").select(F.coalesce("root", "n").alias("root"), F.explode(F.array("a", "b")).alias("id")).distinct()
    names = own.groupBy("root").agg(F.min("id").alias("track"))
    return own.join(names.hint("merge"), "root").select("track", "id").distinct()
