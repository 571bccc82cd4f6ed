"""Token ids as packed matrices: best-fit-decreasing packing with a segment tree over the room left, lossless pieces of overlong documents, cumulative segment lengths and positions that begin anew in each segment."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from heliotab.llm import rank_bpe
from heliotab.llm.common import chunks, materialised

#: Pieces that are packed together; sequences that they fill on average at least, unless there is one block only; blocks a task of the exchange.
BLOCK, FULL, BLOCKS_A_TASK = 2048, 128, 16


class Rooms:
    """How many bins have each room, in a segment tree, with the search for the least room that suffices."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: dict[int, list[int]] = {}

    def put(self, room: int, b: int) -> None:
        self.bins.setdefault(room, []).append(b)
        self._add(room, 1)

    def _add(self, room: int, n: int) -> None:
        k = room + self.size
        while k:
            self.tree[k] += n
            k //= 2

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, bin) with the least room of at least so much, taken out."""
        k = least + self.size
        while not self.tree[k]:
            while k & 1:  # up to the next subtree on the right
                k //= 2
            if not k:
                return None
            k += 1
        while k < self.size:
            k = 2 * k if self.tree[2 * k] else 2 * k + 1
        room = k - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece."""
    out, rooms, count = np.zeros(len(lengths), dtype=np.int64), Rooms(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = rooms.take(n)
        if found is None:
            found, count = (capacity, count), count + 1
        room, out[i] = found
        rooms.put(room - n, found[1])
    return out


def _pieces(docs: DataFrame, ranks_path: str, end: int, capacity: int, key: str) -> DataFrame:
    """(key, row, start, length, ids): the ids of each text and `end`, cut after each `capacity`, as little-endian unsigned 16-bit integers if all ids fit."""
    own = docs.select(F.col(key).alias("key"), "text")
    schema = StructType([own.schema["key"], *StructType.fromDDL("row long, start long, length int, ids binary")])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        bpe, row = rank_bpe.loaded(ranks_path), TaskContext.get().partitionId() << 33
        kind = "<u2" if max(bpe.largest, end) < 1 << 16 else "<u4"
        for chunk in chunks(batches):
            out: list[tuple] = []
            for k, text in enumerate(chunk.column("text").to_pylist()):
                ids = np.array([*bpe.encode(text or ""), end], dtype=kind)
                for s in range(0, len(ids), capacity):
                    part = ids[s : s + capacity]
                    out.append((k, row, s, len(part), part.tobytes()))
                    row += 1
            which, *rest = zip(*out)
            yield pa.RecordBatch.from_arrays([chunk.column(0).take(pa.array(which)), *(pa.array(c, type=t) for c, t in zip(rest, types[1:]))], names=schema.names)

    return own.mapInArrow(run, schema)


def packed(docs: DataFrame, ranks_path: str, end: int, capacity: int, *, key: str = "doc_id", pad: int | None = None) -> DataFrame:
    """One row a sequence: sequence_id (any numbers), n_tokens, input_ids (array of int, padded to the capacity), position_ids (from 0 in each segment, 0 in the padding), cu_seqlens (cumulative segment lengths from 0 on), keys and starts (of each segment: the document's key, and the document's ids before it).

    pad: the padding's id, `end` unless given. Full pieces of overlong documents are sequences as they are, without a shuffle; all others, one a document at most, are dealt to blocks of about BLOCK, or of more where these would fill fewer than FULL sequences, and packed there: each block leaves one sequence at most that could take more, less than 1 in FULL. Null and empty texts are one `end`; null keys are carried; repeated rows each have their place; an empty table gives no sequence; texts may be of any length and shape. Other columns are ignored.
    """
    pad = end if pad is None else pad
    rows = materialised(_pieces(docs, ranks_path, end, capacity, key))  # two branches read it: encoded once
    many = lambda kind: ArrayType(kind)
    fields = [("sequence_id", LongType()), ("n_tokens", IntegerType()), ("input_ids", many(IntegerType())), ("position_ids", many(IntegerType())), ("cu_seqlens", many(IntegerType())), ("keys", many(rows.schema["key"].dataType)), ("starts", many(LongType()))]
    schema = StructType([StructField(*f) for f in fields])
    types = [to_arrow_type(k) for _, k in fields]

    def lists(values: np.ndarray | pa.Array, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
        values = values if isinstance(values, pa.Array) else pa.array(values, type=kind.value_type)
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values.cast(kind.value_type))

    def matrices(table: pa.Table, bins: np.ndarray, numbers: np.ndarray) -> pa.Table:
        """The pieces of the table, in the order of their bins, as one sequence for each bin from 0 on."""
        lengths = table.column("length").to_numpy().astype(np.int64)
        segments = np.bincount(bins, minlength=len(numbers))
        first = np.concatenate([[0], np.cumsum(segments)])  # the first segment of each sequence
        ends = np.concatenate([[0], np.cumsum(lengths)])
        totals = ends[first[1:]] - ends[first[:-1]]
        flat = b"".join(table.column("ids").to_pylist())
        ids = np.frombuffer(flat, dtype="<u2" if len(flat) == 2 * ends[-1] else "<u4")
        at = np.repeat(np.arange(len(numbers)) * capacity - ends[first[:-1]], totals) + np.arange(ends[-1])
        input_ids, positions = np.full(len(numbers) * capacity, pad, dtype=np.int32), np.zeros(len(numbers) * capacity, dtype=np.int32)
        input_ids[at], positions[at] = ids, np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
        rows_of = np.arange(len(numbers) + 1) * capacity
        cumulative = np.insert(ends[1:] - np.repeat(ends[first[:-1]], segments), first[:-1], 0)
        columns = [pa.array(numbers), pa.array(totals, type=types[1]), lists(input_ids, rows_of, types[2]), lists(positions, rows_of, types[3]), lists(cumulative, first + np.arange(len(first)), types[4])]
        columns += [lists(table.column(c).combine_chunks(), first, k) for c, k in ((0, types[5]), ("start", types[6]))]
        return pa.Table.from_arrays(columns, names=schema.names)

    def block(key_: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        bins = best_fit_decreasing(group.column("length").to_numpy().astype(np.int64), capacity)
        order = np.argsort(bins, kind="stable")
        return matrices(group.take(order), bins[order], (key_[0].as_py() << 20) + np.arange(bins.max() + 1))

    def alone(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = pa.Table.from_batches([batch.slice(i, 256)])
                yield from matrices(some, np.arange(len(some)), -1 - some.column("row").to_numpy()).to_batches()

    short = rows.where(F.col("length") < capacity)
    count, total = short.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    blocks = max(1, min(-(-count // BLOCK), total // (FULL * capacity)))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks // BLOCKS_A_TASK)
    dealt = short.select(*rows.columns, F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")).repartition(tasks, "block")
    return dealt.groupBy("block").applyInArrow(block, schema).unionByName(rows.where(F.col("length") == capacity).mapInArrow(alone, schema))
