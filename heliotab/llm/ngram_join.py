"""Near-duplicate documents by the Jaccard similarity of word n-grams, exactly, with prefix filters under several global orders.

Two sets of at least SIMILARITY must share one of the first |s| - ceil(SIMILARITY * |s|) + 1 shingles of any order that both are sorted by. Each order here puts shingles of rarer classes first and breaks ties by a hash of its own. Sets that share a prefix shingle under the first order are candidates; candidates must also share one under the second and the third, fit in size and in a parity signature, before the sets themselves are compared. Equal sets are one node from the start.

Within a bucket of one prefix shingle and one range of sizes no pairs are made at first: each node is compared with the bucket's most ordinary one, that in most buckets. Once these links have joined most of a group of near copies, only pairs of different components are left to try, and of these only pairs that share a shingle which stands early enough in both sets for the sizes of the two: similar sets of n and m shingles share at least t = SIMILARITY * (n + m) / (100 + SIMILARITY), so they share one of the first n - t + 1 and m - t + 1. Sets that share a passage alone have t or more of their own, rarer ones before it, and so make no pairs. Joins by bucket deal the rows of large buckets to several tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from heliotab.llm.common import chunks, materialised
from heliotab.llm.components import components

#: Words a shingle; similarity in percent.
WORDS, SIMILARITY = 5, 80
#: Slots of the table of shingle classes (a byte each, broadcast), a quarter of which are used at most; shingles that a worker holds before it counts them.
SLOTS, HELD = 1 << 22, 6_000_000
#: Orders besides the first that candidates must share a prefix under; longs of the parity signature.
MORE_ORDERS, SIGNATURE = 2, 8
#: Rows of a bucket in one task of a join; buckets that are split are no more than MOST_SPLIT (with more rows, larger ones are split), so their list is broadcast.
BUCKET_ROWS, MOST_SPLIT = 1024, 8192
#: Ratio of the sizes in a range of sizes within which pairs are made.
FINE = 1.02
#: Rows of one or two longs that are broadcast, once they are counted, to join large tables; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """64-bit hashes of a text's words, by whole-array steps: eight bytes after the other are mixed into a word's hash, so words of up to eight bytes have different ones for sure. Words of more than LONG bytes are hashed by XXH3."""

    SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
    MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
    LONG = 64

    def hashes(self, text: bytes) -> np.ndarray:
        """Words are runs of other than ASCII white space; A-Z count as a-z."""
        text = text.lower()  # of bytes: ASCII letters alone
        space = np.concatenate([[True], self.SPACE[np.frombuffer(text, dtype=np.uint8)], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        lanes = np.ndarray((len(text) + 1,), dtype="<u8", buffer=text + bytes(8), strides=(1,))  # the eight bytes from each place on
        out = mixed((lanes[starts] & self.MASKS[np.minimum(sizes, 8)]) ^ sizes.astype(np.uint64) * _ODD[0])
        for k in range(8, self.LONG, 8):
            more = np.flatnonzero(sizes > k)
            if not len(more):
                return out
            out[more] = mixed(out[more] * _ODD[1] ^ (lanes[starts[more] + k] & self.MASKS[np.minimum(sizes[more] - k, 8)]))
        for i in np.flatnonzero(sizes > self.LONG).tolist():
            from xxhash import xxh3_64_intdigest

            out[i] = xxh3_64_intdigest(text[starts[i] : starts[i] + sizes[i]])
        return out


def shingles(text: bytes | None, words: Words) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles: WORDS words in a row; all words where there are fewer."""
    h = words.hashes(text or b"")
    n = len(h)
    if n < WORDS:
        return mixed((h * _ODD[:n]).sum(keepdims=True) + np.uint64(n)) if n else h
    out = h[: n - WORDS + 1] * _ODD[0]
    for k in range(1, WORDS):
        out += h[k : n - WORDS + 1 + k] * _ODD[k]
    out = np.sort(mixed(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def texts_of(chunk: pa.RecordBatch) -> list[bytes | None]:
    return chunk.column("text").cast(pa.binary()).to_pylist()


def node_of(found: np.ndarray) -> int | None:
    """One number for equal sets; null for the empty one."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(found.tobytes())).astype(np.int64)) if len(found) else None


def prefix_length(n: int) -> int:
    return n - -(-SIMILARITY * n // 100) + 1


def prefix(found: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """The first shingles of a set under an order, in that order: by class, then by the order's hash."""
    p = prefix_length(len(found))
    key = classes[(found & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    key = key | (mixed(found + _ODD[order]) >> np.uint64(8))
    first = np.argpartition(key, p - 1)[:p]
    return found[first[np.argsort(key[first])]]


def signature(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles fall on each bit of 64 * SIGNATURE or, for large sets, of the power of two from twice the size on. Where two signatures differ, so do the sets; the halves of one, combined by XOR, are the signature of half the width."""
    bits = max(64 * SIGNATURE, 1 << (2 * len(found) - 1).bit_length()) if len(found) else 64 * SIGNATURE
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def narrow(wide: np.ndarray) -> np.ndarray:
    """The signature of the least width."""
    return np.bitwise_xor.reduce(wide.reshape(-1, SIGNATURE), axis=0)


def sets(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: (id, text_hash, n, node, signature, wide) of each document, with the signature in its least and its own width, and (token, times) of shingles that some task has met in several sets (of HELD shingles at a time)."""
    own = docs.select("id", "text", F.xxhash64("text").alias("text_hash"))
    schema = StructType([own.schema["id"], *StructType.fromDDL("text_hash long, n int, node long, signature array<long>, wide array<long>, token long, times int")])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        words, held, size, known = Words(), [], 0, set()

        def counted():
            tokens = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            times = np.diff(np.append(first, len(tokens)))
            tokens, times = tokens[first[times > 1]].view(np.int64), times[times > 1].astype(np.int32)
            for i in range(0, len(tokens), 100_000):
                t = tokens[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(t), k) for k in types[:6]), pa.array(t), pa.array(times[i : i + 100_000])], names=schema.names)

        for chunk in chunks(batches):
            n, node, narrows, wides = [], [], [], []
            for x in texts_of(chunk):
                found = shingles(x, words)
                n.append(len(found))
                node.append(node_of(found))
                wides.append(signature(found))
                narrows.append(narrow(wides[-1]))
                if len(found) and node[-1] not in known:
                    known.add(node[-1])
                    held.append(found)
                    size += len(found)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), chunk.column("text_hash"), *(pa.array(c, t) for c, t in zip((n, node, narrows, wides), types[2:])), *(pa.nulls(len(n), t) for t in types[6:])], names=schema.names)
            if size > HELD:
                yield from counted()
                held, size, known = [], 0, set()
        if held:
            yield from counted()

    return own.mapInArrow(run, schema)


def class_table(found: DataFrame) -> np.ndarray:
    """For each slot the class of its most frequent shingle: the binary logarithm of the times that tasks have met it together with others of its kind, 0 for those that none has met twice, and for so many of the lowest classes that a quarter of the slots holds the others. Those come to the driver."""
    times = materialised(found.where("token IS NOT NULL").groupBy("token").agg(F.floor(F.log2(F.sum("times"))).cast("int").alias("c")))
    sizes = {r["c"]: r["n"] for r in times.groupBy("c").agg(F.count("*").alias("n")).collect()}
    lowest = next(c for c in range(1, 65) if sum(n for k, n in sizes.items() if k >= c) <= SLOTS // 4)
    slots = times.where(F.col("c") >= lowest).select(F.col("token").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot"), "c").toArrow()
    table = np.zeros(SLOTS, dtype=np.uint8)
    np.maximum.at(table, slots["slot"].to_numpy(), slots["c"].to_numpy().astype(np.uint8))
    return table


def size_class(n: Column, ratio: float) -> Column:
    """The number of a range of sizes. With a ratio of 100 / SIMILARITY, sizes of similar sets are in the same or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(ratio)) + 1e-9).cast("int")


def few(rows: DataFrame) -> bool:
    return rows.count() <= BROADCAST_ROWS


def _prefix_rows(docs: DataFrame, shared) -> DataFrame:
    """(token, node, detail) of the first order's prefixes; a task gives each node once. The detail packs, from the high bits on, the size of the set, the token's place in it, and whether the table of classes knows the token."""

    def run(batches):
        words, classes, known = Words(), shared.value, set()
        for chunk in chunks(batches):
            tokens, nodes, sizes = [], [], []
            for x in texts_of(chunk):
                found = shingles(x, words)
                node = node_of(found)
                if len(found) and node not in known:
                    known.add(node)
                    tokens.append(prefix(found, classes, 0))
                    nodes.append(node)
                    sizes.append(len(found))
            if tokens:
                t, times = np.concatenate(tokens), list(map(len, tokens))
                place = np.arange(len(t)) - np.repeat(np.cumsum(times) - times, times)
                hot = classes[(t & np.uint64(SLOTS - 1)).astype(np.int64)] > 0
                detail = np.repeat(np.array(sizes, dtype=np.int64), times) << 33 | place << 1 | hot
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), times)), pa.array(detail)], names=["token", "node", "detail"])

    return docs.select("text").mapInArrow(run, "token long, node long, detail long")


def _buckets(rows: DataFrame) -> DataFrame:
    """(bucket, node, n, place, rows) for each prefix shingle and pair of neighbouring size classes that more than one node has, with about the number of rows of the bucket. Rare shingles, of few rows each, are thinned out in a window first: a row goes unless the row before or behind it by size has the same class or a neighbouring one. The others may have many rows; for them all, sums are combined before the shuffle and joined. Near copies share many shingles; of buckets with the same nodes, told by sums of hashes (a node has as many rows in each of its buckets), that of the shingle which is first by the order stays: its places are the lowest in all sets."""
    n, place, hot = F.shiftright("detail", 33).cast("int"), F.shiftright("detail", 1).bitwiseAND(F.lit((1 << 32) - 1)).cast("int"), F.col("detail").bitwiseAND(F.lit(1)) == 1
    size = size_class(n, 100 / SIMILARITY)
    at = Window.partitionBy("token").orderBy("size")
    beside = (F.lag("size").over(at) >= F.col("size") - 1) | (F.lead("size").over(at) <= F.col("size") + 1)
    rare = rows.where(~hot).withColumn("size", size).withColumn("beside", beside).where("beside")
    both = rare.select("token", "node", "detail").unionByName(rows.where(hot))
    dealt = both.select(F.explode(F.array(F.xxhash64("token", size), F.xxhash64("token", size + 1))).alias("bucket"), "node", n.alias("n"), place.alias("place"))
    dealt = materialised(dealt)
    h = F.xxhash64("node")
    halves = (F.sum(F.shiftright(h, 32)).alias("high"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"))
    several = dealt.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("rows"), F.sum("place").alias("places"), *halves).where("first <> last")
    one = materialised(several.groupBy("first", "last", "rows", "high", "low").agg(F.min(F.struct("places", "bucket")).alias("m")).select("m.bucket", "rows"))
    total = one.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    size = max(BUCKET_ROWS, total // MOST_SPLIT)
    split = F.broadcast(one.where(F.col("rows") > size))  # MOST_SPLIT rows at most
    return _by_bucket(dealt.join(split, "bucket", "left").withColumn("rows", F.coalesce("rows", F.lit(1))), one, size).dropDuplicates(["bucket", "node"])


def _by_bucket(rows: DataFrame, values: DataFrame, size: int = BUCKET_ROWS) -> DataFrame:
    """The rows of buckets, with the columns of the one row that `values` has for each bucket. Both know the number of rows of a bucket (`rows`; those of the left side may have any number up to `size` for buckets up to it); a bucket is dealt to a task for each `size` of them."""
    parts = F.ceil(F.col("rows") / size).cast("int")
    ours = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts)).drop("rows")
    return ours.join(values.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).hint("merge"), ["bucket", "part"]).drop("part")


def _details(docs: DataFrame, wanted: DataFrame, shared) -> DataFrame:
    """(node, orders, tokens) of the texts whose hashes are wanted."""
    wanted = materialised(wanted.select("text_hash").distinct())
    keyed = docs.select("text", F.xxhash64("text").alias("text_hash"))
    texts = keyed.join(F.broadcast(wanted) if few(wanted) else wanted, "text_hash", "left_semi")
    schema = StructType.fromDDL("node long, orders array<array<int>>, tokens array<long>")
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        words, classes, known = Words(), shared.value, set()
        for chunk in chunks(batches):
            out = []
            for x in texts_of(chunk):
                s = shingles(x, words)
                node = node_of(s)
                if len(s) and node not in known:
                    known.add(node)
                    orders = [np.sort((prefix(s, classes, k) >> np.uint64(32)).astype(np.uint32).view(np.int32)) for k in range(1, 1 + MORE_ORDERS)]
                    out.append((node, orders, s.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(map(list, zip(*out)), types)], names=schema.names)

    return materialised(texts.select("text").mapInArrow(run, schema).dropDuplicates(["node"]))


def _fits(a: str, b: str):
    """What sizes and signatures must satisfy: similar sets differ in no more shingles than (100 - s) / (100 + s) of their sizes' sum, and the signatures in no more bits than the sets in shingles."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.signature")[k].bitwiseXOR(F.col(f"{b}.signature")[k])) for k in range(SIGNATURE)), F.lit(0))
    return (100 * F.least(na, nb) >= SIMILARITY * F.greatest(na, nb)) & ((100 + SIMILARITY) * differ <= (100 - SIMILARITY) * (na + nb))


def _both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """The pairs (a, b) with the columns xa and xb of (node, x). Both grow with the corpus, so neither is broadcast, however small."""
    xa, xb = (values.select(F.col("node").alias(k), F.col("x").alias(f"x{k}")).hint("merge") for k in "ab")
    return pairs.join(xa, "a").join(xb, "b")


def _folded(x: Column, other: Column) -> Column:
    half = (F.size(x) / 2).cast("int")
    return F.when(F.size(x) > F.size(other), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))).otherwise(x)


def _fit_widely(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """The pairs (a, b), of sizes that fit, whose own signatures do too. Their widths differ by a factor of two at most."""
    both = _both(pairs, light.select("node", F.struct("n", "wide").alias("x")))
    a, b = F.col("xa.wide"), F.col("xb.wide")
    differ = F.aggregate(F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return both.where((100 + SIMILARITY) * differ <= (100 - SIMILARITY) * (F.col("xa.n") + F.col("xb.n"))).select("a", "b")


def _linked(pairs: DataFrame, light: DataFrame, docs: DataFrame, shared) -> DataFrame:
    """The pairs (a, b), which fit, whose sets are similar: their own signatures must fit and they must share a prefix under the further orders, then the sets themselves are compared."""
    pairs = materialised(_fit_widely(pairs, light))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    details = _details(docs, light.join(nodes, "node"), shared)
    near = _both(pairs, details.select("node", F.col("orders").alias("x")))
    for k in range(MORE_ORDERS):
        near = near.where(F.arrays_overlap(F.col("xa")[k], F.col("xb")[k]))
    full = _both(near.select("a", "b"), details.select("node", F.col("tokens").alias("x")))
    return materialised(full.where((100 + SIMILARITY) * F.size(F.array_intersect("xa", "xb")) >= SIMILARITY * (F.size("xa") + F.size("xb"))).select("a", "b"))


def _stars(buckets: DataFrame, light: DataFrame) -> DataFrame:
    """Pairs that fit of each node and the most ordinary node of a bucket it is in: the one in most buckets."""
    ranked = buckets.select("bucket", "node", "rows").join(buckets.groupBy("node").agg(F.count("*").alias("d")), "node")
    centres = ranked.groupBy("bucket").agg(F.min(F.struct(-F.col("d"), "node")).alias("c"), F.first("rows").alias("rows"))
    pairs = _by_bucket(ranked, centres).where("node <> c.node").select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
    return _both(pairs, light.select("node", F.struct("n", "signature").alias("x"))).where(_fits("xa", "xb")).select("a", "b")


def _reach(n: Column, place: Column) -> Column:
    """The largest set that can be similar to one of n shingles if the first shingle that both have stands at this place (from 0) in the latter."""
    return F.floor((100 + SIMILARITY) * (n - place) / SIMILARITY).cast("int") - n


def _crossing(buckets: DataFrame, light: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs that fit of nodes of one bucket and different components, of which each is in reach of the other.

    The rows of a bucket are dealt anew by two fine classes of sizes, their own and one in reach, and pairs are made between those of the lower and those of the upper class, in blocks.
    """
    labelled = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = labelled.groupBy("bucket").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.first("rows").alias("rows")).where("first <> last").select("bucket", "rows")
    rows = _by_bucket(labelled, several).drop("rows")
    n, own = F.col("n"), F.col("own")
    reach = F.least(_reach(n, F.col("place")), F.floor(100 * n / SIMILARITY).cast("int"))
    rows = rows.withColumn("own", size_class(n, FINE)).where(100 * reach >= SIMILARITY * n)
    other = F.explode(F.sequence(size_class(F.greatest(F.ceil(SIMILARITY * n / 100), F.lit(1)), FINE), size_class(reach, FINE)))
    dealt = rows.withColumn("other", other).withColumn("cell", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
    dealt = materialised(dealt.select("cell", "node", "root", "n", "place", (own <= F.col("other")).alias("low"), (own >= F.col("other")).alias("up")))
    counted = dealt.groupBy("cell").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count_if("low").alias("lows"), F.count_if("up").alias("ups"))
    counted = materialised(counted.where("first <> last AND lows > 0 AND ups > 0").select("cell", "lows", "ups"))
    size = max(BUCKET_ROWS, counted.agg(F.coalesce(F.sum(F.col("lows") + F.col("ups")), F.lit(0))).first()[0] // MOST_SPLIT)
    parts = lambda c: F.ceil(F.col(c) / size).cast("int")
    counted = counted.select("cell", parts("lows").alias("i"), parts("ups").alias("j"))
    split = F.broadcast(counted.where((F.col("i") > 1) | (F.col("j") > 1)).select("cell", F.greatest("i", "j").alias("parts")))  # 2 * MOST_SPLIT rows at most
    dealt = dealt.join(split, "cell", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1)))).drop("parts")
    known = dealt.join(counted.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest("i", "j") - 1))), ["cell", "part"])
    known = known.join(light.select("node", F.struct("n", "signature").alias("x")), "node")
    every, mine = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)), lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    side = lambda df, k: df.select("cell", "p", "q", F.col("node").alias(k), F.col("root").alias(f"r{k}"), F.col("n").alias(f"n{k}"), F.col("place").alias(f"p{k}"), F.col("x").alias(f"x{k}"))
    lower = side(known.where("low").withColumn("p", mine("i")).withColumn("q", every("j")), "a")
    upper = side(known.where("up").withColumn("q", mine("j")).withColumn("p", every("i")), "b")
    near = (_reach(F.col("na"), F.col("pa")) >= F.col("nb")) & (_reach(F.col("nb"), F.col("pb")) >= F.col("na"))
    pairs = lower.join(upper, ["cell", "p", "q"]).where((F.col("a") != F.col("b")) & (F.col("ra") != F.col("rb")) & near & _fits("xa", "xb"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, links): for each row of docs its id, text_hash (xxhash64), n_shingles, node (equal sets have equal nodes, null: empty), class (equal in a component) and component_id, the least id that links reach from it; and the verified links (a, b) of nodes that join them, not all of those inside a component.

    Texts are compared whole. Null and empty texts have no shingles and are linked with nothing: their component is their own id. Rows with a null id take part; a component of such rows alone has a null id. Repeated rows each give their row. Equal sets are told by a 64-bit hash of the set. Other columns are ignored.
    """
    own = docs.select(F.col(id_column).alias("id"), "text")
    found = materialised(sets(own))
    shared = docs.sparkSession.sparkContext.broadcast(class_table(found))
    buckets = materialised(_buckets(_prefix_rows(own, shared)))
    nodes = materialised(buckets.select("node").distinct())
    seen, broadcast = found.where("node IS NOT NULL"), few(nodes)
    if broadcast:
        seen = seen.join(F.broadcast(nodes), "node", "left_semi")
    light = seen.groupBy("node").agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("wide").alias("wide"), F.min("text_hash").alias("text_hash"))
    light = materialised(light if broadcast else light.join(nodes, "node", "left_semi"))
    links = _linked(_stars(buckets, light), light, own, shared)
    crossing = _linked(_crossing(buckets, light, components(links)), light, own, shared)
    links = links.unionByName(crossing).distinct()
    roots = components(links)
    rows = found.where("token IS NULL").select("id", "text_hash", "n", "node").join(F.broadcast(roots) if few(roots) else roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    least = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    least = materialised(least.where("rows > 1"))  # a row by itself has its own id
    size = max(BUCKET_ROWS, least.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] // MOST_SPLIT)
    parts = F.ceil(F.col("rows") / size).cast("int")
    split = F.broadcast(least.where(parts > 1).select("class", parts.alias("parts")))  # MOST_SPLIT rows at most
    rows = rows.join(split, "class", "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "text_hash"), F.col("parts"))))
    least = least.select("class", "least", F.lit(True).alias("several"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    out = rows.join(least, ["class", "part"], "left").select(F.col("id").alias(id_column), "text_hash", F.col("n").cast("long").alias("n_shingles"), "node", "class", F.when(F.col("several"), F.col("least")).otherwise(F.col("id")).alias("component_id"))
    return out, links
