"""Nearest vectors of a stated set of queries, in blocks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: Vectors of a block of queries.
BLOCK = 512


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vector: str, *, digits: int = 6) -> DataFrame:
    """(query, key, distance): for each row of queries the vector with another key at the least Euclidean distance, rounded to digits, and of equals the least key.

    Queries are packed into blocks, one row each. Every batch of vectors meets each block once, as one product of matrices, which leaves the pairs that can be nearest within rounding; these are measured exactly. A batch gives one row for each query, so what is shuffled grows with batches times queries and not with pairs. Null vectors are left out; lengths must agree.
    """
    kind = vectors.schema[key].dataType
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("q"), F.col(vector).cast("array<double>").alias("v"))
    count = asked.count()
    blocks = max(1, -(-count // BLOCK))
    packed = asked.groupBy(F.pmod(F.xxhash64("q"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("q", "v")).alias("asked"))
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    schema = StructType([StructField("q", kind), StructField("id", kind), *StructType.fromDDL("distance double")])
    types = [to_arrow_type(f.dataType) for f in schema]

    def chunks(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                some = batch.slice(i, 4096)
                yield pa.RecordBatch.from_arrays([pa.array([some.column(c).to_pylist()], type=pa.list_(some.column(c).type)) for c in ("id", "v")], names=["ids", "vs"])

    def matrix(lists: pa.ListArray) -> np.ndarray:
        lengths = set(lists.value_lengths().to_pylist())
        if len(lengths) != 1:
            raise ValueError(f"vectors of lengths {sorted(lengths)}")
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

    def measured(batches):
        for batch in batches:
            out = []
            for r in range(batch.num_rows):  # a row at a time: as Python's numbers a batch takes many times its room
                ids, own = batch.column("ids")[r].as_py(), batch.column("asked")[r].values
                asked_ids, a, b = own.field("q").to_pylist(), matrix(own.field("v")), matrix(batch.column("vs")[r].values)
                square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
                near = square - 2 * (a @ b.T)
                number = {k: j for j, k in enumerate(ids)}
                for i, q in enumerate(asked_ids):
                    if q in number:
                        near[i, [j for j, k in enumerate(ids) if k == q]] = np.inf
                    least = near[i].min()
                    if np.isfinite(least):
                        reach = (np.sqrt(max(least, 0)) + 2 * 10.0**-digits) ** 2 + 1e-9 * square[i].max()
                        at = np.flatnonzero(near[i] <= reach)
                        exact = np.round(np.sqrt(((b[at] - a[i]) ** 2).sum(axis=1)), digits)
                        out.append((q, *min((ids[j], d) for d, j in zip(exact.tolist(), at.tolist()) if d == exact.min())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)], names=schema.names)

    ids = rows.schema["id"].dataType.simpleString()
    whole = rows.mapInArrow(chunks, f"ids array<{ids}>, vs array<array<double>>").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = whole.join(packed, "block").select("ids", "vs", "asked").mapInArrow(measured, schema)
    best = pairs.groupBy("q").agg(F.min(F.struct("distance", "id")).alias("m"))
    return best.select(F.col("q").alias("query"), F.col("m.id").alias(key), F.col("m.distance").alias("distance"))
