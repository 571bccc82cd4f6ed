"""Phrases whose words stand together more often than apart, from position bitmaps of words: a phrase's bitmap is shifted by one position and ANDed with that of a word, and the bits that are left are counted.

The texts of a language are laid out, piece behind piece with a free position between two, in shards of some million positions. A shard's bitmaps are cut into bytes, of which only those with bits are kept. From its words on, each shard extends its phrases depth-first, a batch of them at once: with the bits of a phrase, shifted, meet the bytes of the words at the same place. What is left of them belongs to the longer phrases. The counts of all shards are summed.

A phrase counts only if it is frequent in all shards together, which no shard can tell by itself. So the depth grows by a word each round, and the next round goes down through phrases that all shards have found frequent alone; a phrase is tried only if it is so without its first word and without its last one. What comes back to a shard is as long as its own list of phrases; nothing grows with the corpus but the number of shards.
"""

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from heliotab.llm.common import chunks, written
from heliotab.llm.words import words_of

#: Bytes of text of a shard; a longer text is cut between pieces.
SHARD_BYTES = 12_000_000
#: Bytes of bitmaps that are extended at once; shards a task of a round.
BATCH, SHARDS_A_TASK = 1 << 17, 8
#: Bits of a count within a shard, beside the shard's number.
WITHIN = 28
#: Between pieces, and between words.
BREAKS = np.array([chr(b) in ".,;:!?\n\x0b\x0c\r" for b in range(256)])
BETWEEN = BREAKS | np.array([chr(b) in " \t" for b in range(256)])
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")


def _parts(text: bytes):
    """The text, cut behind the last break within each SHARD_BYTES, or behind the first one after that."""
    at = 0
    while len(text) - at > SHARD_BYTES:
        cut = max(text.rfind(b, at, at + SHARD_BYTES) for b in (b".", b",", b";", b":", b"!", b"?", b"\n", b"\x0b", b"\x0c", b"\r"))
        if cut < 0:
            m = _BREAK.search(text, at + SHARD_BYTES)
            if not m:
                break
            cut = m.start()
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(ids, words): for each position the number of its word from 1 on, frequent words first, or 0 between pieces, and the distinct words."""
    data = b"\n".join(texts)
    words, starts = words_of(data, BETWEEN)
    coded = words.dictionary_encode()
    breaks = np.cumsum(BREAKS[np.frombuffer(data, dtype=np.uint8)])[starts]
    places = np.arange(len(starts)) + np.cumsum(np.diff(breaks, prepend=breaks[:1]) > 0)
    found = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(found, minlength=len(coded.dictionary)), kind="stable")
    number = np.empty(len(order), dtype=np.int32)
    number[order] = np.arange(1, len(order) + 1)
    ids = np.zeros(int(places[-1]) + 1 if len(places) else 0, dtype=np.int32)
    ids[places] = number[found]
    return ids, coded.dictionary.take(pa.array(order))


def squeezed(ids: np.ndarray) -> bytes:
    """Numbers as compressed bytes: all lowest bytes, then all second ones, and so on, of which the higher ones are mostly 0."""
    from zstandard import ZstdCompressor

    return ZstdCompressor(level=3).compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    from zstandard import ZstdDecompressor

    planes = np.frombuffer(ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def shards(docs: DataFrame, lang: str) -> DataFrame:
    """(shard, lang, ids, words, counts): shards of texts of one language, with squeezed() ids."""
    schema = "shard long, lang string, ids binary, words array<string>, counts array<long>"

    def run(batches):
        number, held, sizes = TaskContext.get().partitionId() << 12, {}, {}

        def closed(which):
            nonlocal number
            ids, words = laid_out(held.pop(which))
            del sizes[which]
            counts = np.bincount(ids, minlength=len(words) + 1)[1:]
            row = {"shard": [number], "lang": [which], "ids": [squeezed(ids)], "words": [words.cast(pa.large_string()).to_pylist()], "counts": [counts.tolist()]}
            number += 1
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("ids", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]))

        for chunk in chunks(batches):
            for text, which in zip(chunk.column("text").cast(pa.binary()).to_pylist(), chunk.column("lang").to_pylist()):
                for part in _parts(text or b""):
                    if sizes.get(which, 0) + len(part) > SHARD_BYTES and sizes.get(which):
                        yield closed(which)
                    held.setdefault(which, []).append(part)
                    sizes[which] = sizes.get(which, 0) + len(part)
        for which in list(held):
            yield closed(which)

    return written(docs.select("text", F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")).mapInArrow(run, schema), "phrase_shards")


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places of the wanted values in sorted keys; -1 where they aren't."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Bitmaps:
    """The words of a shard, numbered from 0 on, as bitmaps in bytes without those that are 0: sorted by byte for what meets there, and by word."""

    def __init__(self, words: np.ndarray, n: int):
        """words: the word at each position, -1 for none; n: how many there are."""
        at = np.flatnonzero(words >= 0)
        key = (at >> 3) * n + words[at]
        order = np.argsort(key, kind="stable")
        key, bit = key[order], (1 << (at[order] & 7)).astype(np.uint8)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.bits = np.bitwise_or.reduceat(bit, first) if len(first) else bit
        self.block, self.word = key[first] // n, key[first] % n
        self.start = np.concatenate([[0], np.cumsum(np.bincount(self.block, minlength=(len(words) >> 3) + 3))])

    def roots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, block, bits) by word."""
        order = np.argsort(self.word, kind="stable")
        return self.word[order], self.block[order], self.bits[order]

    def extended(self, node: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(node, word, block, bits) of the phrases that are a word longer: each byte is shifted by one, what leaves it goes to the next, and both are ANDed with the bytes of all words at their places."""
        shifted = bits.astype(np.uint16) << 1
        node, block = np.concatenate([node, node]), np.concatenate([block, block + 1])
        bits = np.concatenate([shifted & 255, shifted >> 8]).astype(np.uint8)
        many = np.where(bits > 0, self.start[block + 1] - self.start[block], 0)
        rows = np.repeat(np.arange(len(many)), many)
        at = np.arange(len(rows)) + np.repeat(self.start[block] - np.cumsum(many) + many, many)
        both = bits[rows] & self.bits[at]
        hit = np.flatnonzero(both)
        return node[rows[hit]], self.word[at[hit]], block[rows[hit]], both[hit]


def longer(ids: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parents, suffixes, counts) of the phrases of one word more than the last level's, both by their places in that level.

    levels: the shard's frequent phrases of one, two, ... words. Of each level, keys and suffixes: the numbers of words, sorted, and nothing; then phrase without its last word << 32 | last word, sorted, and phrase without its first word, all by their places in the lists before.
    """
    words = levels[0][0]
    code = np.full(int(max(ids.max(initial=0), words.max(initial=0))) + 1, -1)
    code[words] = np.arange(len(words))
    maps = Bitmaps(code[ids], max(len(words), 1))
    cut = lambda depth, entries: [(depth, tuple(x[i : i + BATCH] for x in entries)) for i in range(0, len(entries[0]), BATCH)][::-1]
    found, stack = [], cut(1, maps.roots())
    while stack:
        depth, entries = stack.pop()
        node, word, block, bits = maps.extended(*entries)
        rest = word if depth == 1 else _find(levels[depth - 1][0], levels[depth - 1][1][node] << 32 | word)
        if depth == len(levels):
            keep = rest >= 0
            keys, which = np.unique(node[keep] << 32 | rest[keep], return_inverse=True)
            found.append((keys, np.bincount(which, np.bitwise_count(bits[keep]), len(keys)).astype(np.int64)))
        else:
            child = _find(levels[depth][0], node << 32 | word)
            keep = child >= 0
            stack += cut(depth + 1, (child[keep], block[keep], bits[keep]))
    keys, counts = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    keys, which = np.unique(keys, return_inverse=True)
    return keys >> 32, keys & 0xFFFFFFFF, np.bincount(which, counts, len(keys)).astype(np.int64)


def _levels(table: pa.Table, depth: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(levels as of longer(), ids of the last one) of rows (level, parent, suffix, id); those of level 1 have the word's number as parent."""
    level, parent, suffix, id_ = (table.column(c).to_numpy() for c in ("level", "parent", "suffix", "id"))
    out, last, ids, order = [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k in range(1, depth + 1):
        own = np.flatnonzero(level == k)
        if k == 1:
            keys, rest = parent[own], np.full(len(own), -1)
        else:
            head, rest = (order[_find(ids[order], x[own])] if len(own) else own for x in (parent, suffix))
            keys = head << 32 | last[rest]
        by = np.argsort(keys, kind="stable")
        out.append((keys[by], rest[by]))
        last = np.arange(len(by)) if k == 1 else keys[by] & 0xFFFFFFFF
        ids = id_[own][by]
        order = np.argsort(ids, kind="stable")
    return out, ids


def _round(laid: DataFrame, known: list[DataFrame], tasks: int) -> DataFrame:
    """The candidates of one word more of each shard: parent and suffix, the ids of the phrase without its last and without its first word, and at, the shard and the count. known: the frequent ones of each shard (parent, suffix, at, id), by length."""
    depth = len(known)

    def deepen(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if len(left) and len(right):
            levels, ids = _levels(right, depth)
            if len(ids):
                parents, suffixes, counts = longer(unsqueezed(left.column("ids")[0].as_py()), levels)
                out = [ids[parents], ids[suffixes], (left.column("shard")[0].as_py() << WITHIN) + counts]
        return pa.table(dict(zip(("parent", "suffix", "at"), map(pa.array, out))))

    back = reduce(DataFrame.unionByName, [k.select(F.shiftright("at", WITHIN).alias("shard"), F.lit(i).alias("level"), "parent", "suffix", "id") for i, k in enumerate(known, 1)])
    both = laid.select("shard", "ids").repartition(tasks, "shard").groupBy("shard").cogroup(back.repartition(tasks, "shard").groupBy("shard"))
    return both.applyInArrow(deepen, "parent long, suffix long, at long")


def _frequent(rows: DataFrame, by: list[str], least: int) -> DataFrame:
    """The rows whose counts, in the low bits of `at`, sum up to `least` or more over equal columns in `by`, with the sum as f, a number for each such group as id, and whether a row is its group's first. A group has a row for each shard at most."""
    w = Window.partitionBy(*by)
    kept = rows.withColumn("f", F.sum(F.col("at").bitwiseAND(F.lit((1 << WITHIN) - 1))).over(w)).where(F.col("f") >= least)
    numbered = kept.withColumn("n", F.monotonically_increasing_id()).withColumn("id", F.min("n").over(w))
    return written(numbered.withColumn("first", F.col("n") == F.col("id")).drop("n"), "frequent")


def collocations(docs: DataFrame, *, lang: str = "lang", least: int = 100, longest: int = 5, subsumed: int = 100, best: int | None = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of 2 to `longest` words that occur `least` times or more in the column `text`, per language (null: und).

    A-Z count as a-z; words are runs of other than space and tab within pieces, which end at .,;:!? and line breaks. n: all words of the language; a: occurrences of the phrase, overlaps included. Cut after its first k words, a phrase has l occurrences of the first part and r of the rest; score is floor(1000 a n / (l r)), exactly, of the cut with the lowest, or of the first of equals. A phrase goes if its words stand inside a longer candidate with at least `subsumed` percent of its occurrences. Of each language the first `best` by falling score, falling a and rising phrase (by bytes) are returned, all if None.

    Null, empty and blank texts have no words; repeated rows count each; an empty table gives no rows. Texts of any length are read whole. Other columns are ignored.
    """
    laid = shards(docs, lang)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-laid.count() // SHARDS_A_TASK))
    words = laid.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w"))
    words = words.select((F.shiftleft("shard", WITHIN) + F.col("w.counts")).alias("at"), (F.col("i") + 1).cast("long").alias("parent"), "lang", F.col("w.words").alias("word"))
    known = [_frequent(words, ["lang", "word"], least).withColumn("suffix", F.lit(0).cast("long"))]
    level = known[0].where("first").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("firsts"), F.array().cast("array<long>").alias("rests"))
    levels, links = [], []
    for k in range(2, longest + 1):
        known.append(_frequent(_round(laid, known, tasks), ["parent", "suffix"], least))
        own = known[-1].where("first").select("id", "parent", "suffix", "f")
        links.append(own.select(F.lit(k - 1).alias("k"), F.explode(F.array("parent", "suffix")).alias("id"), "f"))
        head = level.select(F.col("id").alias("parent"), "lang", F.col("phrase").alias("head"), "firsts")
        tail = level.select(F.col("id").alias("suffix"), F.col("f").alias("rest"), "rests", "last")
        level = own.join(head, "parent").join(tail, "suffix").select("id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", F.concat("firsts", F.array("f")).alias("firsts"), F.concat(F.array("rest"), "rests").alias("rests"))
        level = written(level, "phrases")
        levels.append(level.withColumn("k", F.lit(k)))
        if not level.limit(1).count():
            break
    inside = reduce(DataFrame.unionByName, links).groupBy("k", "id").agg(F.max("f").alias("longer"))
    found = reduce(DataFrame.unionByName, levels).join(inside, ["k", "id"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < subsumed * F.col("f")))
    sizes = laid.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
    cuts = F.transform(F.sequence(F.lit(1), F.size("rests")), lambda k: F.struct(k.alias("k"), F.element_at("firsts", k).alias("l"), F.element_at("rests", k).alias("r")))
    scored = found.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, "lang").withColumn("cuts", cuts)
    scored = scored.withColumn("cut", F.expr("array_min(transform(cuts, c -> struct((1000 * CAST(f AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(c.l AS DECIMAL(18,0)) * CAST(c.r AS DECIMAL(18,0))) AS score, c.k AS k, c.l AS l, c.r AS r)))"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("f").desc(), F.col("phrase").asc()))
    out = scored.select("lang", rank.cast("long").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    return out if best is None else out.where(F.col("rank") <= best)
