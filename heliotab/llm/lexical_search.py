"""Ranked lexical search: postings of document shards in compressed sparse rows, with integer impacts computed once; each query adds the weighted impacts of its terms, term by term, to one dense array of a shard's documents, of which the best are selected, and those of all shards are merged.

The index is a table with a row for each shard of some thousand documents, so that it is built, stored and searched by as many tasks as there are. Queries are broadcast in blocks of a bounded size; each block reads the index twice, for document frequencies and for scores.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from heliotab.llm.common import chunks, materialised, written
from heliotab.llm.words import words_of

#: Bytes of text of a shard, and its documents at most; a longer text is a shard by itself.
SHARD_BYTES, SHARD_DOCS = 6_000_000, 1 << 15
#: Queries of a block, and bytes of their texts at most; a longer query is a block by itself.
BLOCK_QUERIES, BLOCK_BYTES = 4096, 16_000_000
#: Impact: 1,000,000,000 tf div (1000 tf + 8 m), with m = 100 - 75 + 75 n N div L.
SCALE, TF, NORM, BASE, LENGTH = 1_000_000_000, 1000, 8, 100, 75
#: Bytes between terms: ASCII other than digits and letters.
BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Index:
    """shards: (shard, keys, terms, starts, docs, impacts): the documents' keys, the shard's terms, where the postings of each begin, and the postings' documents (16 bits) and impacts (32 bits). documents and terms: how many documents have terms, and all their terms."""

    shards: DataFrame
    documents: int
    terms: int


def statistics(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms)."""

    def run(batches):
        documents = terms = 0
        for chunk in chunks(batches):
            for text in chunk.column("text").cast(pa.binary()).to_pylist():
                if text:
                    inside = ~BETWEEN[np.frombuffer(text, dtype=np.uint8)]
                    n = int(inside[0]) + int(np.count_nonzero(inside[1:] & ~inside[:-1]))
                    documents, terms = documents + (n > 0), terms + n
        yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [terms]})

    return tuple(x or 0 for x in docs.select("text").mapInArrow(run, "documents long, terms long").agg(F.sum("documents"), F.sum("terms")).first())


def _norms(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """The m of documents with so many terms; in Python's integers where 64 bits are too few."""
    if LENGTH * int(lengths.max(initial=0)) * documents < 1 << 63:
        return BASE - LENGTH + LENGTH * lengths * documents // max(terms, 1)
    return np.array([BASE - LENGTH + LENGTH * int(n) * documents // terms for n in lengths], dtype=np.int64)


def postings(texts: list[bytes], documents: int, terms: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, starts, docs, impacts) of a shard's texts."""
    words, at = words_of(b" ".join(texts), BETWEEN)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    doc = np.searchsorted(ends, at, side="right")
    coded = words.dictionary_encode()
    names = coded.dictionary
    key, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(texts) + doc, return_counts=True)
    term, doc_of = key // len(texts), key % len(texts)
    lengths = np.bincount(doc, minlength=len(texts))
    impacts = SCALE * tf // (TF * tf + NORM * _norms(lengths, documents, terms)[doc_of])
    starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(names)))])
    return names, starts.astype("<u4"), doc_of.astype("<u2"), impacts.astype("<u4")


def build(docs: DataFrame, *, key: str = "doc_id") -> Index:
    """The index of the column `text`, written to the shared folder. Null texts and those without terms are in no result and don't count; repeated rows count each. Other columns are ignored."""
    documents, terms = statistics(docs)
    own = docs.select(F.col(key).alias("key"), "text")
    schema = StructType([*StructType.fromDDL("shard long"), StructField("keys", _list_of(own.schema["key"])), *StructType.fromDDL("terms array<binary>, starts binary, docs binary, impacts binary")])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        shard, keys, texts, size = TaskContext.get().partitionId() << 33, [], [], 0

        def closed():
            names, *arrays = postings(texts, documents, terms)
            values = [[shard], [pa.concat_arrays(keys).to_pylist()], [names.to_pylist()], *([x.tobytes()] for x in arrays)]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(values, types)], names=schema.names)

        for chunk in chunks(batches):
            for i, text in enumerate(chunk.column("text").cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                if texts and (size + len(text) > SHARD_BYTES or len(texts) == SHARD_DOCS):
                    yield closed()
                    shard, keys, texts, size = shard + 1, [], [], 0
                keys.append(chunk.column("key").slice(i, 1))
                texts.append(text)
                size += len(text)
        if texts:
            yield closed()

    return Index(written(own.mapInArrow(run, schema), "search_index"), documents, terms)


def _list_of(field: StructField):
    from pyspark.sql.types import ArrayType

    return ArrayType(field.dataType)


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """The queries (_q, text) as terms with their repeats, a block at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        text = (row["text"] or "").encode()
        if block and (len(block) == BLOCK_QUERIES or size + len(text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row["_q"], Counter(words_of(text, BETWEEN)[0].to_pylist())))
        size += len(text)
    if block:
        yield block


def _frequencies(index: Index, terms: list[bytes]) -> np.ndarray:
    """The documents that hold each term."""
    shared = index.shards.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        wanted = pa.array(shared.value, type=pa.binary())
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at, there = _places(wanted, batch.column("terms"), i)
                starts = np.frombuffer(batch.column("starts")[i].as_py(), dtype="<u4").astype(np.int64)
                total[there] += starts[at + 1] - starts[at]
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["term", "n"])

    found = index.shards.select("terms", "starts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # the block's terms at most
    out = np.zeros(len(terms), dtype=np.int64)
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out


def _places(wanted: pa.Array, terms: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a shard has the wanted terms, and which of them it has."""
    at = pc.index_in(wanted, value_set=terms[i].values.cast(pa.binary()))
    there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), there


def best(scores: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest positive scores, highest first, equal ones by their order; all, if fewer."""
    if len(scores) > k:
        least = scores[np.argpartition(scores, len(scores) - k)[len(scores) - k :]].min()
        found = np.flatnonzero(scores >= max(least, 1))  # with all that equal the last one
    else:
        found = np.flatnonzero(scores > 0)
    return found[np.lexsort((order[found], -scores[found]))][:k]


def search(index: Index, queries: DataFrame, k: int = 10, *, query_key: str = "item_id", key: str = "doc_id") -> DataFrame:
    """(query key, rank, key, score): the k best documents of each row of queries by the terms of its `text`, repeats included.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))) in doubles; a score, of integers, is the sum of weight times impact, of which only those above 0 count. Equal scores go by rising key, null keys last; ranks are unique. Queries without known terms give no rows; queries with equal or null keys are each answered.
    """
    asked = materialised(queries.select(F.col(query_key).alias("_key"), "text").withColumn("_q", F.monotonically_increasing_id()))
    kind = index.shards.schema["keys"].dataType.elementType
    schema = StructType([*StructType.fromDDL("_q long"), StructField("_doc", kind), *StructType.fromDDL("score long")])
    types = [to_arrow_type(f.dataType) for f in schema]
    out = index.shards.sparkSession.createDataFrame([], schema)
    for block in _blocks(asked.select("_q", "text")):
        terms = sorted({t for _, own in block for t in own})
        number = {t: i for i, t in enumerate(terms)}
        df = _frequencies(index, terms)
        weight = [math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()]
        coded = [(q, [(number[t], weight[number[t]] * times) for t, times in own.items() if df[number[t]] and weight[number[t]]]) for q, own in block]
        shared = index.shards.sparkSession.sparkContext.broadcast((terms, coded))

        def run(batches):
            wanted = pa.array(shared.value[0], type=pa.binary())
            for batch in batches:
                for i in range(batch.num_rows):
                    at = np.full(len(wanted), -1)
                    found, there = _places(wanted, batch.column("terms"), i)
                    at[there] = found
                    starts, docs, impacts = (np.frombuffer(batch.column(c)[i].as_py(), dtype=t) for c, t in (("starts", "<u4"), ("docs", "<u2"), ("impacts", "<u4")))
                    keys = batch.column("keys")[i].values
                    order = np.empty(len(keys), dtype=np.int64)
                    order[pc.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
                    made = []
                    for q, own in shared.value[1]:
                        scores = np.zeros(len(keys), dtype=np.int64)
                        for term, w in own:
                            if at[term] >= 0:
                                part = slice(starts[at[term]], starts[at[term] + 1])
                                scores[docs[part]] += w * impacts[part].astype(np.int64)
                        first = best(scores, order, k)
                        made += [(q, d, s) for d, s in zip(first.tolist(), scores[first].tolist())]
                    if made:
                        q, d, s = zip(*made)
                        yield pa.RecordBatch.from_arrays([pa.array(q, types[0]), keys.take(pa.array(d)), pa.array(s, types[2])], names=schema.names)

        out = out.unionByName(materialised(index.shards.select("keys", "terms", "starts", "docs", "impacts").mapInArrow(run, schema)))
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.col("score").desc(), F.col("_doc").asc_nulls_last()))
    ranked = out.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(asked.select("_q", "_key"), "_q").select(F.col("_key").alias(query_key), F.col("rank").cast("int").alias("rank"), F.col("_doc").alias(key), "score")
