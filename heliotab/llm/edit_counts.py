"""Token counts that follow edits: a segment tree over the pre-tokens of each document, of which an edit re-encodes only what it touches and the context at its borders.

Pre-tokens depend on nothing but the text from their start on, and on at most LOOK code points behind their end. So an edit can change pre-tokens that end less than LOOK before it; from the first of these on, the new text is cut again until a boundary behind the edit falls on an old boundary. From there on all is as before.
"""

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from heliotab.llm import rank_bpe
from heliotab.llm.common import map_texts

#: Code points behind its end that can decide on a pre-token: the two letters of a contraction, and one for white space.
LOOK = 3
#: Pre-tokens a leaf at first; a leaf of more than GROWN times as many makes the tree anew. Distinct pre-tokens whose counts a worker remembers.
LEAF, GROWN, MEMORY = 64, 8, 500_000


class Counter:
    """Pre-tokens of a text and their token counts under a rank file."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import regex

        self.cut = regex.compile(public_tokenizers.PATTERN)
        self.bpe = rank_bpe.loaded(ranks_path)
        self.memory: dict[str, int] = {}

    def counts(self, pre_tokens: list[str]) -> list[int]:
        memory = self.memory
        if len(memory) > MEMORY:
            memory.clear()
        for p in pre_tokens:
            if p not in memory:
                memory[p] = len(self.bpe.piece(p))
        return list(map(memory.__getitem__, pre_tokens))


@lru_cache(2)
def _loaded(ranks_path: str) -> Counter:
    return Counter(ranks_path)


class Tree:
    """A text as leaves of LEAF pre-tokens, with sums of code points and tokens in a complete binary tree above them. Edits keep the number of leaves, which may grow or become empty, and update the sums on the paths above those that they touch; only when a leaf has become GROWN times as large, after at least as many insertions, is the tree made anew."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        self.encoded = 0
        self._build(self._leaves(counter.cut.findall(text)))

    def _leaves(self, pre_tokens: list[str]) -> list[tuple[list[str], list[int]]]:
        counts = self.counter.counts(pre_tokens)
        self.encoded += len(pre_tokens)
        return [(pre_tokens[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(pre_tokens), LEAF)]

    def _build(self, leaves: list[tuple[list[str], list[int]]]) -> None:
        self.leaves = leaves
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        if leaves:
            self.sums[self.size : self.size + len(leaves)] = [(sum(map(len, p)), sum(c)) for p, c in leaves]
        for level in range(self.size.bit_length() - 1, 0, -1):
            first = 1 << (level - 1)
            self.sums[first : 2 * first] = self.sums[2 * first : 4 * first : 2] + self.sums[2 * first + 1 : 4 * first : 2]

    @property
    def length(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def text(self) -> str:
        return "".join(p for pre_tokens, _ in self.leaves for p in pre_tokens)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf with code point `at` (the last leaf, if there is none), and the code points before the leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if at >= before + self.sums[node, 0] and self.sums[node + 1, 0]:
                before += int(self.sums[node, 0])
                node += 1
        return node - self.size, before

    def edit(self, start: int, stop: int, new: str) -> None:
        """Code points start to stop are replaced. Positions beyond the text count as its end."""
        stop = min(max(stop, 0), self.length)
        start = min(max(start, 0), stop)
        if not self.length:
            self._build(self._leaves(self.counter.cut.findall(new)))
            return
        first, at = self.find(max(0, start - LOOK))
        pre_tokens, counts = self.leaves[first]
        kept = 0  # pre-tokens of the first leaf that the edit can't change
        while kept < len(pre_tokens) and at + len(pre_tokens[kept]) <= start - LOOK:
            at += len(pre_tokens[kept])
            kept += 1
        shift = len(new) - (stop - start)
        last, _ = self.find(stop)
        while True:
            old = [p for leaf, _ in self.leaves[first : last + 1] for p in leaf][kept:]
            text = "".join(old)
            fresh = text[: start - at] + new + text[stop - at :]
            ahead, behind = "", last + 1  # the next leaves, with LOOK code points or more if there are so many
            while len(ahead) < LOOK and behind < len(self.leaves):
                ahead += "".join(self.leaves[behind][0])
                behind += 1
            ends, position = {}, at  # old boundaries behind the edit, where they are now
            for k, p in enumerate(old):
                position += len(p)
                if position >= stop:
                    ends[position + shift] = k + 1
            made: list[str] = []
            met = None
            for m in self.counter.cut.finditer(fresh + ahead):
                if m.end() > len(fresh):
                    break
                made.append(m[0])
                met = ends.get(at + m.end())
                if met is not None:
                    break
            if met is not None or not ahead:
                break
            last = min(len(self.leaves) - 1, max(behind - 1, 2 * last - first + 1))
        met = len(old) if met is None else met
        old_counts = [c for _, leaf in self.leaves[first : last + 1] for c in leaf][kept:]
        self.encoded += len(made)
        self._replace(first, last, pre_tokens[:kept] + made + old[met:], counts[:kept] + self.counter.counts(made) + old_counts[met:])

    def _replace(self, first: int, last: int, pre_tokens: list[str], counts: list[int]) -> None:
        """Deals the pre-tokens to the leaves from first to last and updates the sums above these."""
        step = -(-len(pre_tokens) // (last + 1 - first))
        self.leaves[first : last + 1] = [(pre_tokens[i * step : (i + 1) * step], counts[i * step : (i + 1) * step]) for i in range(last + 1 - first)]
        if step > GROWN * LEAF:
            every = [[x for leaf in self.leaves for x in leaf[k]] for k in (0, 1)]
            self._build([(every[0][i : i + LEAF], every[1][i : i + LEAF]) for i in range(0, len(every[0]), LEAF)])
            return
        nodes = range(self.size + first, self.size + last + 1)
        for node in nodes:
            p, c = self.leaves[node - self.size]
            self.sums[node] = sum(map(len, p)), sum(c)
        low, high = nodes[0], nodes[-1]
        while low > 1:
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


def count_edited(docs: DataFrame, ranks_path: str, *keep: str) -> DataFrame:
    """Columns in keep, n_tokens, n_tokens_edited, n_pre_tokens and n_reencoded of each row's `text` before and after its `edits`.

    edits: an array of structs (start, stop, new), applied in order, each on the text as the ones before it left it; code points; positions beyond the text count as its end. n_reencoded counts the pre-tokens that were encoded again for the edits. Null text counts as empty, null edits as none, a null part of an edit as 0 or empty. Texts of any length and shape are counted whole; a run of one kind of characters, blanks too, is one pre-token however long.
    """
    def setup():
        counter = _loaded(ranks_path)

        def each(texts, edits):
            out = []
            for text, own in zip(texts, edits):
                tree = Tree(text or "", counter)
                before, first = tree.tokens, tree.encoded
                for e in own or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                out.append((before, tree.tokens, first, tree.encoded - first))
            return list(zip(*out))

        return each

    return map_texts(docs, setup, "n_tokens long, n_tokens_edited long, n_pre_tokens long, n_reencoded long", *keep, extra="edits")
