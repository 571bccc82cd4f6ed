"""Shards by histogram sort: bytes below candidate boundaries are counted exactly, probes are refined until the splitters meet the tolerance, and rows are exchanged once.

A row's place is told by its key and, among rows with equal keys, by a tie: a hash of a number of its own. Both are longs; together they count as one number of 128 bits, of which a round of probes resolves BITS.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliotab.llm.common import materialised

#: Bits of key and tie that one round of probes resolves.
BITS = 8
#: A task of the exchange gets a cell. A shard has CELLS of them at least, and as many as hold CELL_BYTES each, but all shards MOST_CELLS together, since the splitters between cells come to the driver. These needn't be exact: a probe within this part of a cell settles them.
CELLS, CELL_BYTES, MOST_CELLS, CELL_TOLERANCE = 4, 256 << 20, 4096, 0.25

_SIGN, _LONG = 1 << 63, 1 << 64


@dataclass
class Splitter:
    """A boundary, as a number of 128 bits: exactly so many bytes and rows are below it."""

    key: int
    bytes: int
    rows: int


def _signed(x: int) -> int:
    return x - _LONG if x >= _SIGN else x


def _leading(bits: int) -> tuple[Column, Column]:
    """The first so many bits of _key and _tie, as unsigned numbers, in two longs; the second is 0 as long as the key's bits suffice."""
    key, tie = (F.col(c).bitwiseXOR(F.lit(-_SIGN)) for c in ("_key", "_tie"))
    if bits <= 64:
        return (F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")), F.lit(0).cast("long")
    return key, F.shiftrightunsigned(tie, 128 - bits)


def splitters(sized: DataFrame, bits: int, start: int, targets: list[tuple[int, int]], shares: int) -> list[Splitter]:
    """One splitter for each (shares * bytes wanted below it, shares * tolerance in bytes), in order, for the columns _key, _tie and _size (long), whose first `bits` bits are those of the number `start` in all rows.

    Probes are the boundaries of ranges of keys and ties with the same leading bits. Each round counts the bytes and rows of the ranges inside those that still hold a splitter, which are joined as a table of no more rows than splitters, in one aggregation that is combined before the shuffle; its rows, 2^BITS a range at most, come to the driver. A splitter is settled once a probe is within its tolerance, or else where one row lies between two probes, or all bits are used: then it is the first boundary with at least the wanted bytes below.
    """
    waiting = {i: start for i in range(len(targets))}  # splitter -> the range that holds it
    below = {start: (0, 0)}  # range -> bytes and rows below it
    found: dict[int, Splitter] = {}
    while waiting:
        outer = [(_signed(r), 0) if bits <= 64 else (_signed(r >> (bits - 64)), r & ((1 << (bits - 64)) - 1)) for r in sorted(below)]
        values = ", ".join(f"({n}, CAST('{a}' AS BIGINT), CAST('{b}' AS BIGINT))" for n, (a, b) in enumerate(outer))
        table = sized.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(range, first, second)")
        first, second = _leading(bits)
        inner = _leading(bits + BITS)[0 if bits < 64 else 1]
        keyed = sized.select(first.alias("first"), second.alias("second"), inner.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("digit"), "_size")
        counted = keyed.join(F.broadcast(table), ["first", "second"]).groupBy("range", "digit").agg(F.sum("_size").alias("b"), F.count("*").alias("n")).collect()
        counts = {(r["range"], r["digit"]): (r["b"], r["n"]) for r in counted}
        probes: dict[int, list[tuple[int, int, int]]] = {}
        for k, r in enumerate(sorted(below)):
            b, n = below[r]
            probes[r] = [(r << BITS, b, n)]
            for d in range(1 << BITS):
                more = counts.get((k, d), (0, 0))
                b, n = b + more[0], n + more[1]
                probes[r].append(((r << BITS) + d + 1, b, n))
        bits += BITS
        left, below, waiting = waiting, {}, {}
        for i, r in left.items():
            want, tolerance = targets[i]
            p, b, n = min(probes[r], key=lambda e: (abs(shares * e[1] - want), e[0]))
            if abs(shares * b - want) > tolerance:
                k = next((k for k, e in enumerate(probes[r]) if shares * e[1] >= want), len(probes[r]) - 1)
                p, b, n = probes[r][k]
                if bits < 128 and k and n - probes[r][k - 1][2] > 1:
                    waiting[i], below[probes[r][k - 1][0]] = probes[r][k - 1][0], probes[r][k - 1][1:]
                    continue
            found[i] = Splitter(p << (128 - bits), b, n)
    return [found[i] for i in range(len(targets))]


def cell_of(splits: list[int]) -> Column:
    """How many of the sorted splitters are at or below the row, by binary search in two constant arrays."""
    inside = [s for s in splits if s < 1 << 128]
    if not inside:
        return F.lit(0)
    array = lambda part: F.expr("array(" + ",".join(f"CAST('{_signed(part(s) ^ _SIGN)}' AS BIGINT)" for s in inside) + ")")
    keys, ties = array(lambda s: s >> 64), array(lambda s: s & (_LONG - 1))
    steps = F.array(*[F.lit(1 << k) for k in range(len(inside).bit_length() - 1, -1, -1)])

    def reached(at: Column) -> Column:
        k = F.get(keys, at - 1)
        return (at <= len(inside)) & ((k < F.col("_key")) | ((k == F.col("_key")) & (F.get(ties, at - 1) <= F.col("_tie"))))

    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))


def shard(df: DataFrame, key: Column, size: Column, shards: int, tolerance: float = 0.0) -> DataFrame:
    """The same rows with `shard` (0 to shards - 1, by rising key) and `slot` (gapless from 0 in each shard, by rising key).

    key: long; null counts as the least long; size: positive. Rows with equal keys are told apart by a hash of a number of their own, so any number of them is spread like others. A shard's bytes differ from an even share by at most the tolerance (a part of a share) and the rows at its two boundaries; with tolerance 0 a boundary is the first row with at least its share of bytes before it. An empty table gives an empty one. Columns named like those added are replaced, and no other name can clash.

    The rows are written to the checkpoint folder first, so that their numbers stay as they are: give ids and sizes, and join texts to the result where they are large.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    own = [f"c{i}" for i in range(len(names))]
    keyed = df.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(names, own)], F.coalesce(key.cast("long"), F.lit(-_SIGN)).alias("_key"), size.cast("long").alias("_size"))
    rows = materialised(keyed.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())))
    low, high, total = rows.agg(F.min("_key"), F.max("_key"), F.sum("_size")).first()
    low, high, total = (0 if x is None else x for x in (low, high, total))
    cells = shards * max(CELLS, min(-(-total // (CELL_BYTES * shards)), MOST_CELLS // shards))
    a, b = (x + _SIGN for x in (low, high))
    same = max(k for k in range(0, 65, BITS) if a >> (64 - k) == b >> (64 - k))
    per = cells // shards
    targets = [(total * i, int(total * (tolerance * per if i % per == 0 else CELL_TOLERANCE))) for i in range(1, cells)]
    found = splitters(rows, same, a >> (64 - same), targets, cells) if total else [Splitter(1 << 128, 0, 0)] * (cells - 1)
    starts = [Splitter(0, 0, 0), *found]
    before = [s.rows - starts[i // per * per].rows for i, s in enumerate(starts)]
    out = rows.withColumn("_cell", cell_of([s.key for s in found]))
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("_key", "_tie")) - 1
    first = F.element_at(F.expr("array(" + ",".join(f"{b}L" for b in before) + ")"), F.col("_cell") + 1)
    return out.select(*[F.col(x).alias(c) for c, x in zip(names, own)], F.floor(F.col("_cell") / per).cast("int").alias("shard"), (rank + first).alias("slot"))
