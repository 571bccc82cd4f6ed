"""Byte-level BPE encoding and decoding over Arrow batches, with the tokenizers library."""

import codecs
import json
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from heliotab.llm.common import map_texts

#: Pieces whose ids a worker remembers; the memory is emptied when it is full.
MEMORY = 700_000
#: Ids that are decoded at once; a character whose bytes are split between two such steps waits for the second.
STEP = 4096


@lru_cache(1)
def byte_table() -> tuple[dict[int, str], dict[str, int]]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary, and the way back: printable Latin-1 characters stand for themselves, the others for those from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    forth = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return forth, {c: b for b, c in forth.items()}


class ByteBPE:
    """One vocabulary file (tokenizers JSON, byte-level BPE) with encoding, offsets and decoding.

    The JSON file holds the same tokens with the same ids as the rank file of the same name, and its merges in the order of the ranks, so its ids are those of tiktoken; a test compares the two files token by token.
    A text is cut before each single space between two characters that aren't white space. The pre-token pattern always has a boundary there and no merge crosses it, so each piece has the same ids wherever it stands; they are looked up in a memory before the library is asked.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        back = byte_table()[1]
        self.bytes_of: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        self.sizes = np.array(list(map(len, self.bytes_of)))
        self.memory: dict[str, bytes] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        parts = text.split(" ")
        out: list[str] = []
        begun, held, last = parts[0], [], parts[0]  # the piece at hand, what it goes on with, and its last part
        for part in parts[1:]:
            if part and last and not part[0].isspace() and not last[-1].isspace():
                out.append(" ".join([begun, *held]) if held else begun)
                begun = " " + part
                if held:
                    held = []
            else:
                held.append(part)
            last = part
        out.append(" ".join([begun, *held]) if held else begun)
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        cut = [self.pieces(x) if x else [] for x in texts]
        memory = self.memory
        missing = list({p for pieces in cut for p in pieces if p not in memory})
        if len(memory) + len(missing) > MEMORY:
            memory.clear()
            missing = list({p for pieces in cut for p in pieces})
        for start in range(0, len(missing), 4096):
            some = missing[start : start + 4096]
            e = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4")
            bounds = np.searchsorted(np.array(e.word_ids, dtype=np.int64), np.arange(len(some) + 1))
            for p, i, j in zip(some, bounds[:-1].tolist(), bounds[1:].tolist()):
                memory[p] = ids[i:j].tobytes()
        return [np.frombuffer(b"".join(map(memory.__getitem__, pieces)), dtype="<u4") for pieces in cut]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code points that each id covers in part at least, as starts and ends; a character that several ids share counts for each."""
        lead = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
        at = np.cumsum(lead)  # characters begun up to and with each byte
        ends = np.cumsum(self.sizes[ids])
        return at[ends - self.sizes[ids]] - 1, at[ends - 1]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_stream(self, ids, step: int = 1):
        """Text for `step` ids after the other; bytes of a character that isn't complete wait for the ids that complete it, and what never becomes one is replaced by U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in range(0, len(ids), step):
            yield decoder.decode(self.decode_bytes(ids[i : i + step]))
        yield decoder.decode(b"", True)


@lru_cache(2)
def loaded(path: str) -> ByteBPE:
    """One for each file and worker process, so that what it remembers serves all tasks of the worker."""
    return ByteBPE(path)


def encode(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """Columns in keep, `ids` (array of int) and `offsets` (array of the first code point of each id) of the column `text`.

    Null and empty texts: no ids. Repeated rows each give their row; texts of any length are encoded whole.
    """

    def setup():
        bpe = loaded(path)

        def each(texts):
            ids = bpe.encode_batch([x or "" for x in texts])
            return [i.astype(np.int32) for i in ids], [bpe.offsets(x, i)[0].astype(np.int32) if x else [] for x, i in zip(texts, ids)]

        return each

    return map_texts(docs, setup, "ids array<int>, offsets array<int>", *keep)


def decode(encoded: DataFrame, path: str, *keep: str) -> DataFrame:
    """Columns in keep and `decoded` (binary) of the column `ids`; null ids give null."""
    @F.pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        bpe = loaded(path)
        return pd.Series([None if x is None else bpe.decode_bytes(x) for x in ids], dtype=object)

    return encoded.select(*keep, run("ids").alias("decoded"))


def round_trip(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """Columns in keep, n_tokens, ids_sha256 of the ids as little-endian unsigned 32-bit integers, decoded_sha256 of the text that the ids decode to, STEP ids at a time, and of the offsets: n_split, the ids that end inside a character, and offsets_crc32 of the code points at which the ids start (little-endian unsigned 32-bit integers). Null text counts as empty."""

    def setup():
        import zlib
        from hashlib import sha256

        bpe = loaded(path)

        def one(text, ids):
            whole = sha256()
            for part in bpe.decode_stream(ids.tolist(), STEP):
                whole.update(part.encode())
            starts, ends = bpe.offsets(text, ids) if text else (ids, ids)
            return len(ids), sha256(ids.tobytes()).hexdigest(), whole.hexdigest(), int((ends[:-1] > starts[1:]).sum()), zlib.crc32(starts.astype("<u4").tobytes())

        def each(texts):
            texts = [x or "" for x in texts]
            return list(zip(*map(one, texts, bpe.encode_batch(texts))))

        return each

    return map_texts(docs, setup, "n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long, offsets_crc32 long", *keep)
