"""Packing of documents into sequences by local search: exchanges between underfull sequences that increase the sum of squared fills until sequences empty."""

import bisect
import zlib
from array import array
from functools import lru_cache
from os.path import commonprefix
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from heliotab.llm.byte_bpe import byte_table
from heliotab.llm.common import map_texts, materialised

#: Pieces that one search works on. What the searches leave in underfull sequences is packed again in fewer blocks.
BLOCK = 2048
#: Blocks a task searches at most where there are many; rows are small beside the work on them, so their bytes don't tell how to deal them.
BLOCKS_A_TASK = 64
#: Sequences that the pieces of a block fill on average at least, unless it is the only one.
FULL = 16
#: Sequences filled below this part are opened for the next round in the first ROUNDS rounds, as long as a round saves at least one sequence in SAVED of those that it opened; after that, the least filled one of each block alone.
OPEN, SAVED, ROUNDS = 15 / 16, 64, 8
#: Words whose ids a worker remembers; the memory is emptied when it is full.
MEMORY = 600_000
#: The id that ends a document.
END = 1


#: What is cut off the end of a word before it is looked up: none of these joins the pre-token of a letter or digit before it.
_TAIL = b".,!?;:*$%&#|"
#: Letters up to here have been letters in every Unicode version.
_LATIN = "\u024f"


class WordBPE:
    """A lower-casing vocabulary whose pre-tokens never cross white space (tokenizers JSON, byte-level, with word ends).

    The ids of a word between ASCII white space are the same wherever it stands and in either case of A-Z, so they are remembered. A word of lower-case Latin letters is one pre-token and goes to the library's BPE model directly; any other goes through the whole library. A text in which one of the file's added tokens stands (`<|endoftext|>`) goes there as it is, and gets that token's id, as the library has it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.begin = commonprefix(self.added)
        self.model = self.library.model
        self.memory: dict[bytes, bytes] = {}
        self.characters = {b: c for b, c in byte_table()[0].items() if chr(b) != c}

    def _ids(self, part: bytes) -> bytes:
        known = self.memory.get(part)
        if known is None:
            text = part.decode()
            if text.isalpha() and max(text) <= _LATIN and text == text.lower() and is_normalized("NFC", text):
                ids = [t.id for t in self.model.tokenize(part.decode("latin-1").translate(self.characters))]
            else:
                ids = self.library.encode(text, add_special_tokens=False).ids
            known = self.memory[part] = array("I", ids).tobytes()
        return known

    def _learn(self, word: bytes) -> bytes:
        start = word.rstrip(_TAIL)
        if start and len(start) < len(word) and start[-1:].isalnum():
            out = self._ids(start) + self._ids(word[len(start) :])
        else:
            out = self._ids(word)
        self.memory[word] = out
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for text in texts:
            if len(self.memory) > MEMORY:
                self.memory.clear()
            if self.begin in text and any(t in text for t in self.added):
                out.append(array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes())
                continue
            words = text.encode().lower().split()  # of bytes: ASCII letters and white space alone
            for w in words:
                if w not in self.memory:
                    self._learn(w)
            out.append(b"".join(map(self.memory.__getitem__, words)))
        return out


@lru_cache(2)
def _loaded(path: str) -> WordBPE:
    return WordBPE(path)


def pieces(docs: DataFrame, path: str, capacity: int, *keep: str, with_ids: bool = False) -> DataFrame:
    """Columns in keep, piece, start, length, ids_crc32 and, if wanted, `ids` of each piece of the column `text`: its ids and END, cut after each `capacity` ids. Null text counts as empty."""

    def setup():
        bpe, size = _loaded(path), 4 * capacity
        end = END.to_bytes(4, "little")

        def each(texts):
            cut = [[x[i : i + size] for i in range(0, len(x), size)] for x in (ids + end for ids in bpe.encode_batch([t or "" for t in texts]))]
            made = [[(len(p) // 4, zlib.crc32(p)) + ((np.frombuffer(p, dtype="<u4").astype(np.int32).tolist(),) if with_ids else ()) for p in x] for x in cut]
            return ([[dict(zip(("length", "crc", "ids"), p)) for p in x] for x in made],)

        return each

    kind = "struct<length:long,crc:long" + (",ids:array<int>" if with_ids else "") + ">"
    found = map_texts(docs, setup, f"pieces array<{kind}>", *keep).select(*keep, F.posexplode("pieces").alias("piece", "p"))
    return found.select(*keep, "piece", (F.col("piece").cast("long") * capacity).alias("start"), "p.length", F.col("p.crc").alias("ids_crc32"), *(["p.ids"] if with_ids else []))


def first_moves(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The start of the search, a bin for each piece: each piece has a bin of its own; then, from the shortest on, each piece that is still alone moves into the fullest bin with room for it, until one finds none. These are the search's own moves, looked up in a sorted list."""
    bin_of = np.arange(len(lengths))
    alone = [True] * len(lengths)
    fills = sorted(zip(lengths.tolist(), bin_of.tolist()))
    while len(fills) > 1:
        n, b = fills[0]
        k = bisect.bisect_left(fills, (capacity - n + 1, -1)) - 1
        if not alone[b] or k < 1:
            break
        f, target = fills.pop(k)
        del fills[0]
        bin_of[b], alone[target] = target, False
        bisect.insort(fills, (f + n, target))
    return np.unique(bin_of, return_inverse=True)[1]


def choices(pieces: np.ndarray, lengths: np.ndarray, bin_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What may leave the bins of these pieces together, by rising sum: (sum, piece, another piece of its bin or -1).

    Pieces of one length in one bin are as good as each other, so one of them stands for all, and two for their pairs. A bin of capacity c has fewer than sqrt(2c) different lengths, so pairs of lengths are no more than its tokens.
    """
    key = bin_of[pieces] << 32 | lengths[pieces]
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(order) else order
    times = np.diff(np.append(first, len(order)))
    one = pieces[order[first]]
    two = np.where(times > 1, pieces[order[np.minimum(first + 1, max(0, len(order) - 1))]], -1)
    left, right = [one, one[two >= 0]], [np.full(len(one), -1), two[two >= 0]]
    for d in range(1, len(one)):
        same = np.flatnonzero(bin_of[one[d:]] == bin_of[one[:-d]])
        if not len(same):
            break
        left.append(one[same])
        right.append(one[same + d])
    a, b = np.concatenate(left), np.concatenate(right)
    sums = lengths[a] + np.where(b >= 0, lengths[b], 0)
    order = np.argsort(sums, kind="stable")
    return sums[order], a[order], b[order]


class Offers:
    """The choices of all bins, one after the other in arrays; those of a bin that has changed are written anew at the end, and the arrays are made anew when they are full."""

    def __init__(self, lengths: np.ndarray, bin_of: np.ndarray, bins: int):
        self.lengths, self.bin_of = lengths, bin_of
        self.start, self.stop = np.zeros(bins, dtype=np.int64), np.zeros(bins, dtype=np.int64)
        self._gather()

    def _gather(self) -> None:
        sums, one, two = choices(np.arange(len(self.lengths)), self.lengths, self.bin_of)
        bins = self.bin_of[one]
        order = np.argsort(bins, kind="stable")
        self.used = len(order)
        self.sums, self.one, self.two, self.bins = (np.concatenate([x[order], np.zeros(len(order) + 8192, dtype=np.int64)]) for x in (sums, one, two, bins))
        every = np.arange(len(self.start))
        self.start, self.stop = np.searchsorted(bins[order], every), np.searchsorted(bins[order], every, side="right")

    def changed(self, b: int) -> None:
        found = choices(np.flatnonzero(self.bin_of == b), self.lengths, self.bin_of)
        self.bins[self.start[b] : self.stop[b]] = -1
        end = self.used + len(found[0])
        if end > len(self.sums):
            self._gather()
            return
        for have, new in zip((self.sums, self.one, self.two, self.bins), (*found, b)):
            have[self.used : end] = new
        self.start[b], self.stop[b], self.used = self.used, end, end

    def exchange(self, source: int, fill: np.ndarray, capacity: int) -> tuple[list[int], int, list[int]] | None:
        """The exchange by which an underfull bin, no less filled than the source, gains most: (pieces that leave the source, the other bin, pieces that come back). One piece goes for none, one or two, or two go for none or one. None if no bin can gain."""
        underfull = np.append((fill >= fill[source]) & (fill < capacity), False)  # the last one for what is out of date
        underfull[source] = False
        targets = np.flatnonzero(underfull)
        there = np.flatnonzero(underfull[self.bins[: self.used]])
        if not len(targets):
            return None
        given = np.arange(self.start[source], self.stop[source])
        pair = self.two[there] >= 0
        nothing = np.full(len(targets), -1)
        best: tuple[int, int, list[int], int, list[int]] | None = None
        for ours, theirs, bins in ((given, nothing, targets), (given, there[~pair], None), (given[self.two[given] < 0], there[pair], None)):
            if not len(theirs):
                continue
            bins = self.bins[theirs] if bins is None else bins
            back = np.where(theirs >= 0, self.sums[theirs], 0)
            sums = self.sums[ours]
            k = np.searchsorted(sums, back + capacity - fill[bins], side="right") - 1
            gain = np.where(k >= 0, sums[k] - back, 0)
            at = int(np.argmax(gain * (capacity + 1) + fill[bins]))
            if gain[at] > 0 and (best is None or (gain[at], fill[bins[at]]) > best[:2]):
                members = [[int(x) for x in (self.one[j], self.two[j]) if x >= 0] if j >= 0 else [] for j in (ours[k[at]], theirs[at])]
                best = int(gain[at]), int(fill[bins[at]]), members[0], int(bins[at]), members[1]
        return None if best is None else best[2:]


def local_search(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece. The least filled bin is the source: its pieces are moved or exchanged into other underfull bins. Each exchange makes a fuller bin fuller at the cost of one that is no fuller, so the sum of squared fills grows and the search ends: where the sum of lengths forbids fewer bins, or where no bin can gain from any other."""
    bin_of = first_moves(lengths, capacity)
    fill = np.bincount(bin_of, weights=lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    if len(fill) <= least:
        return bin_of
    offers = Offers(lengths, bin_of, len(fill))
    stuck, gained = np.zeros(len(fill), dtype=bool), False
    while (fill > 0).sum() > least:
        free = np.flatnonzero((fill > 0) & (fill < capacity) & ~stuck)
        if not len(free):
            if not gained:
                break
            stuck[:], gained = False, False
            continue
        source = int(free[np.argmin(fill[free])])
        while fill[source] and (found := offers.exchange(source, fill, capacity)):
            out, target, back = found
            moved = int(lengths[out].sum() - lengths[back].sum())
            bin_of[out], bin_of[back] = target, source
            fill[source] -= moved
            fill[target] += moved
            offers.changed(source)
            offers.changed(target)
            gained = True
        stuck[source] = fill[source] > 0
    return np.unique(bin_of, return_inverse=True)[1]


def _packer(turn: int, capacity: int, names: list[str]):
    def packed(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        lengths = group.column("n").to_numpy()
        bin_of = local_search(lengths, capacity)
        fill = np.bincount(bin_of, weights=lengths).astype(np.int64)
        order = np.argsort(bin_of, kind="stable")
        which = bin_of[order]
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.cumsum(fill) - fill
        out = group.take(order).drop_columns([c for c in ("sequence", "place", "fill", "least") if c in group.column_names])
        out = out.append_column("sequence", pa.array((turn << 58) + (key[0].as_py() << 18) + which)).append_column("place", pa.array(before - first[which]))
        return out.append_column("fill", pa.array(fill[which])).append_column("least", pa.array(which == fill.argmin())).select(names)

    return packed


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """The same rows with sequence_id (any numbers) and offset (gapless from 0 in each sequence).

    `length` is from 1 to capacity. Rows are dealt to blocks of about BLOCK, or of more where these would fill fewer than FULL sequences, by a hash of a number of their own, so equal rows spread. Each block is packed by local search; then the sequences below OPEN are opened and their rows packed again in fewer blocks, while that saves sequences; after that, the least filled sequence of each block, until one block is left. Each round of the latter kind leaves at most 1 / FULL of the tokens, so the rounds end. An empty table gives an empty one; nulls in other columns are carried; columns named like those added are replaced, and no other name can clash.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    own = [f"c{i}" for i in range(len(names))]
    rows = materialised(items.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(names, own)], F.col("length").cast("long").alias("n"), F.monotonically_increasing_id().alias("row")))
    schema = StructType([*rows.schema, *(StructField(x, LongType()) for x in ("sequence", "place", "fill")), StructField("least", BooleanType())])
    closed, turn, widely, before = [], 0, True, None
    while True:
        count, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        blocks = max(1, min(-(-count // BLOCK), total // (FULL * capacity)))
        tasks = max(min(blocks, 4 * items.sparkSession.sparkContext.defaultParallelism), blocks // BLOCKS_A_TASK)
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(blocks))).repartition(tasks, "block")
        done = materialised(dealt.groupBy("block").applyInArrow(_packer(turn, capacity, schema.names), schema))
        if blocks == 1:
            closed.append(done)
            break
        low = F.col("fill") < OPEN * capacity
        sequences, underfull = done.where("place = 0").agg(F.count("*"), F.sum(low.cast("long"))).first()
        widely = widely and turn < ROUNDS and (before is None or (before - sequences) * SAVED >= before)
        opened = (F.col("least") | low) if widely else F.col("least")
        before = max(underfull or 0, blocks) if widely else blocks
        closed.append(done.where(~opened))
        rows = done.where(opened).select(*own, "n", "row")
        turn += 1
    out = closed[0]
    for x in closed[1:]:
        out = out.unionByName(x)
    return out.select(*[F.col(x).alias(c) for c, x in zip(names, own)], F.col("sequence").alias("sequence_id"), F.col("place").alias("offset"))
