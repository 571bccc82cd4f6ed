"""Sums of sines and cosines of many rows at many frequencies, with work that grows with rows and frequencies and not with their product.

Over a stretch of time, a sum of waves is a smooth function of frequency, the smoother the shorter the stretch. So it is known from its values at Chebyshev nodes: NODES of them for all frequencies over a block of time, NODES for each of as many bands of frequency over as many blocks. With ARGUMENT a quarter of the product of a block's length and the width of all frequencies, the error is that of J_36(10), below 1e-15 of the sum of the magnitudes.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Nodes; a quarter of block length times width; blocks in a stretch, which are also bands, at most; rows and frequencies worked on at once.
NODES, ARGUMENT, BLOCKS, _ROWS, _TARGETS = 36, 5.0, 256, 4096, 512

_X = np.cos((2 * np.arange(NODES) + 1) * math.pi / (2 * NODES))
_SIGNS = np.where(np.arange(NODES) % 2, -1.0, 1.0) * np.sin((2 * np.arange(NODES) + 1) * math.pi / (2 * NODES))


def _weights(x: np.ndarray) -> np.ndarray:
    """What the values at the nodes count for at each x in -1 to 1."""
    apart = x[:, None] - _X
    here = apart == 0
    parts = _SIGNS / np.where(here, 1.0, apart)
    return np.where(here.any(axis=1)[:, None], here.astype(float), parts / parts.sum(axis=1)[:, None])


def wave_sums(rows: DataFrame, first: float, last: float, low: float, high: float, grid: Callable[[float], Iterator[float]]) -> DataFrame:
    """(period, yc, ys, c2, s2): sums of d cos w t, d sin w t, cos 2 w t and sin 2 w t over all rows, w = 2 pi / period, t from the middle of first and last, at the periods of grid, which goes on from a period that it is given, rises, and lies in low to high. rows: t and d, finite. The driver walks the grid once and keeps a period for each band."""
    slow, fast = 2 * math.pi / high, 2 * math.pi / low
    length = 4 * ARGUMENT / (fast - slow)
    bands = max(1, min(BLOCKS, math.ceil((last - first) / length)))
    stretch, width, middle = bands * length, (fast - slow) / bands, (first + last) / 2
    band_of = lambda p: min(bands - 1, max(0, int((2 * math.pi / p - slow) / width)))
    starts: dict[int, float] = {}
    for p in grid(low):
        starts.setdefault(band_of(p), p)
    centres = (np.arange(bands) + 0.5) * length - stretch / 2
    nodes = slow + (fast - slow) * (_X + 1) / 2
    names = ("yr", "yi", "er", "ei")

    def stretches(batches):
        """Sums by block at the nodes of all frequencies; of a stretch, at the nodes of each band."""
        shifts, inner = None, None
        at, total = None, np.zeros((4, bands, NODES))

        def out():
            nonlocal shifts, inner
            if shifts is None:
                wanted = slow + width * (np.arange(bands)[:, None] + (_X + 1) / 2)
                shifts = np.exp(1j * wanted[:, :, None] * centres)
                inner = _weights((2 * (wanted.ravel() - slow) / (fast - slow)) - 1).reshape(bands, NODES, NODES)
            y, e = total[0] + 1j * total[1], total[2] + 1j * total[3]
            found = np.empty((2, bands, NODES), dtype=complex)
            for k in range(bands):
                found[0, k] = (shifts[k] * (inner[k] @ y.T)).sum(axis=1)
                found[1, k] = (shifts[k] ** 2 * (inner[k] @ e.T)).sum(axis=1)
            parts = (found[0].real, found[0].imag, found[1].real, found[1].imag)
            return pa.RecordBatch.from_arrays([pa.array(range(bands), pa.int32()), pa.array([at] * bands, pa.int64()), *[pa.array(list(x), pa.list_(pa.float64())) for x in parts]], names=["band", "stretch", *names])

        for batch in batches:
            own, t, d = (batch.column(k).to_numpy() for k in range(3))
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for i, j in zip(edges, edges[1:]):
                if i == j:
                    continue
                if own[i] != at:
                    if at is not None:
                        yield out()
                    at = int(own[i])
                    total[:] = 0
                for r in range(i, j, _ROWS):
                    some = slice(r, min(j, r + _ROWS))
                    place = t[some] - at * stretch
                    block = np.clip((place / length).astype(int), 0, bands - 1)
                    phase = np.outer(place - stretch / 2 - centres[block], nodes)
                    s, c = np.sin(phase), np.cos(phase)
                    begins = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
                    for k, x in enumerate((d[some, None] * c, d[some, None] * s, c * c - s * s, 2 * s * c)):
                        np.add.at(total[k], block[begins], np.add.reduceat(x, begins, axis=0))
        if at is not None:
            yield out()

    def powers(table: pa.Table) -> pa.Table:
        """The sums over all stretches at the periods of a band."""
        band = table["band"][0].as_py()
        middles = table["stretch"].to_numpy() * stretch + stretch / 2 + first - middle
        value = lambda re, im: np.stack(table[re].to_pylist()) + 1j * np.stack(table[im].to_pylist())
        y, e = value("yr", "yi").T, value("er", "ei").T
        held, periods = [], []

        def add():
            p = np.array(periods)
            w = 2 * math.pi / p
            inner, shift = _weights(np.clip(2 * (w - slow - band * width) / width - 1, -1, 1)), np.exp(1j * np.outer(w, middles))
            a, b = (shift * (inner @ y)).sum(axis=1), (shift * shift * (inner @ e)).sum(axis=1)
            held.append(pa.table({"period": p, "yc": a.real, "ys": a.imag, "c2": b.real, "s2": b.imag}))
            periods.clear()

        for p in grid(starts[band]) if band in starts else ():
            if band_of(p) != band:
                break
            periods.append(p)
            if len(periods) == _TARGETS:
                add()
        if periods:
            add()
        return pa.concat_tables(held) if held else pa.table({c: pa.array([], pa.float64()) for c in ("period", "yc", "ys", "c2", "s2")})

    t = F.col("t") - first
    dealt = rows.select(F.floor(t / stretch).alias("stretch"), t.alias("t"), "d")
    parts = max(1, min(4096, math.ceil((last - first) / stretch)))  # stated: rows are few for their work, and would be put together
    sums = dealt.repartition(parts, "stretch").sortWithinPartitions("stretch", "t").mapInArrow(stretches, "band int, stretch long, " + ", ".join(f"{c} array<double>" for c in names))
    return sums.repartition(bands, "band").groupBy("band").applyInArrow(powers, "period double, yc double, ys double, c2 double, s2 double")
