"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained with FTRL-proximal (L1 and L2 penalties) and calibrated by a temperature."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from heliotab.llm.common import map_texts

#: n-grams of 1 to 3 characters of the lower-cased text are hashed to so many features; one more, of weight 0, takes the padding.
FEATURES = 1 << 16
#: A language's documents in the training sample, as expected; training rows that a language must have to be learned. The model takes 0.26 MB a language.
PER_LANGUAGE, LEAST_ROWS = 600, 10
#: FTRL: learning rate, its smoothing, penalties, passes over the sample. SCALE: the sum of a document's feature values.
ALPHA, BETA, L1, L2, PASSES, SCALE = 0.1, 1.0, 0.01, 0.001, 4, 64.0
#: Code points that are looked up at once.
SLICE = 400_000
UNKNOWN = "und"
_MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def ngram_features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The hashed n-grams of all texts, one after the other, an array for each n; where each text starts, and its length. An n-gram that runs over the end holds zeros there."""
    low = [x.lower() for x in texts]
    lengths = np.array([len(x) for x in low], dtype=np.int64)
    codes = np.frombuffer(("\0\0".join(low) + "\0\0\0\0").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]]).astype(np.int64)
    padding = (starts + lengths)[:, None] + np.arange(2)
    size = int(starts[-1] + lengths[-1]) + 2
    one, two, three = codes[:size], codes[1 : size + 1], codes[2 : size + 2]
    out, value = [], one * np.uint32(_MIX[0])
    for n, more in enumerate((None, two, three)):
        if more is not None:
            value = (value ^ (value >> np.uint32(15))) * np.uint32(_MIX[n]) + more * np.uint32(_MIX[0])
        mixed = (value ^ (value >> np.uint32(13))) * np.uint32(_MIX[2])
        bucket = (mixed >> np.uint32(16)).astype(np.int32)
        bucket[padding] = FEATURES
        out.append(bucket)
    return out, starts, lengths


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    #: For each feature the weights by language times the inverse document frequency, and that frequency itself; the last row is 0.
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and its calibrated probability; UNKNOWN and 0 without text or letter, or if none was learned. Ties: the first language by name."""
        use = [i for i, x in enumerate(texts) if has_letter(x)] if self.languages else []
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if use:
            total = np.zeros((len(use), self.table.shape[1]))
            some: list[tuple[int, str, int]] = []  # a text's place, a part of it, and how many n-grams begin in the part
            size = 0
            for k, i in enumerate(use):
                low = texts[i].lower()
                for a in range(0, len(low), SLICE):
                    some.append((k, low[a : a + SLICE + 2], min(SLICE, len(low) - a)))
                    size += some[-1][2]
                    if size >= SLICE:
                        self._add(total, some)
                        some, size = [], 0
            if some:
                self._add(total, some)
            logits = (SCALE * total[:, :-1] / np.maximum(total[:, -1:], 1e-9) + self.bias) / self.temperature
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, k, s in zip(use, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                names[i], scores[i] = self.languages[k], s
        return names, scores


    def _add(self, total: np.ndarray, some: list[tuple[int, str, int]]) -> None:
        """Adds the table's rows of the n-grams that begin in each part; two characters more are there for those that run over its end."""
        grams, starts, _ = ngram_features([x for _, x, _ in some])
        for (_, x, n), at in zip(some, starts.tolist()):
            for g in grams:
                g[at + n : at + len(x)] = FEATURES
        step = max(1024, SLICE * 4 // self.table.shape[1])
        for a in range(0, len(grams[0]), step):
            b = min(a + step, len(grams[0]))
            first, last = np.searchsorted(starts, a, side="right") - 1, np.searchsorted(starts, b, side="left")
            bounds = np.maximum(starts[first:last], a) - a
            for g in grams:
                np.add.at(total, [k for k, _, _ in some[first:last]], np.add.reduceat(self.table[g[a:b]], bounds, axis=0))


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of all of `train` each feature is, and how many texts there are."""

    def run(batches):
        import pyarrow as pa

        from heliotab.llm.common import chunks

        found, count = np.zeros(FEATURES + 1, dtype=np.int64), 0
        for chunk in chunks(batches):
            texts = [x for x in chunk.column("text").to_pylist() if has_letter(x)]
            if not texts:
                continue
            count += len(texts)
            grams, starts, lengths = ngram_features(texts)
            for s, e in zip(starts.tolist(), (starts + lengths).tolist()):
                seen = np.zeros(FEATURES + 1, dtype=bool)
                for g in grams:
                    seen[g[s:e]] = True
                found += seen
        found[FEATURES] = count
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(found[there])], names=["feature", "n"])

    rows = train.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out[:FEATURES], int(out[FEATURES])


def sample(train: DataFrame, counts: dict[str, int], key: Column) -> DataFrame:
    """About PER_LANGUAGE rows of each language, by a hash of the key and the text: all rows of a language with fewer; of rows that repeat both, one. Returns lang, order, idx and n (the features and their counts as bytes)."""
    import itertools

    rate = F.element_at(F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(min(1.0, PER_LANGUAGE / n))) for k, n in counts.items())), F.col("lang"))
    order = F.xxhash64(key, F.col("text"))
    drawn = train.select("lang", "text", order.alias("order")).where(F.col("lang").isin(list(counts)) & (F.pmod("order", F.lit(1_000_000)) < rate * 1_000_000)).dropDuplicates(["lang", "order"])

    def setup():
        def each(texts):
            idx, n = [], []
            for x in texts:
                if not has_letter(x):
                    idx.append(b""), n.append(b"")
                    continue
                grams, _, length = ngram_features([x])
                values, times = np.unique(np.concatenate([g[: length[0]] for g in grams]), return_counts=True)
                idx.append(values.astype("<u4").tobytes()), n.append(times.astype("<u4").tobytes())
            return idx, n

        return each

    return map_texts(drawn, setup, "idx binary, n binary", "lang", "order")


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed form of FTRL-proximal with both penalties: 0 where |z| is at most L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features by classes) and bias from rows of (features, values, class), in a fixed random order."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))  # the last row is the bias
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        for r in order.permutation(len(rows)):
            idx, x, y = rows[r]
            idx, x = np.append(idx, FEATURES), np.append(x, 1.0)
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[idx] = ni + g * g
    w = weights(z, n)
    return w[:FEATURES], w[FEATURES]


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its logarithm. 1 without rows."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    a, b, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(train: DataFrame, key: Column) -> Model:
    """Learns from the columns text and lang. Document frequencies are over all rows; the weights come from a sample of about PER_LANGUAGE rows a language, a fifth of it kept for the temperature. Every value of lang with LEAST_ROWS rows or more is learned; rows of rarer ones, and those without text, letter or lang, are left out; an empty table gives a model that knows no language."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((FEATURES + 1, 1), dtype=np.float32), np.zeros(0), 1.0)
    df, total = document_frequencies(train)
    idf = np.log((1 + total) / (1 + df)) + 1
    rows = []
    drawn = sample(train, counts, key).toArrow().to_pandas().sort_values(["order", "lang"], kind="stable")
    for lang, idx, n in zip(drawn["lang"], drawn["idx"], drawn["n"]):
        i = np.frombuffer(idx, dtype="<u4").astype(np.int64)
        if len(i):
            x = np.frombuffer(n, dtype="<u4") * idf[i]
            rows.append((i, SCALE * x / x.sum(), languages.index(lang)))
    kept, checked = [r for k, r in enumerate(rows) if k % 5], [r for k, r in enumerate(rows) if not k % 5]
    w, bias = train_ftrl(kept or rows, len(languages))
    logits = np.array([x @ w[i] + bias for i, x, _ in checked]).reshape(len(checked), len(languages))
    temperature = calibrate(logits, np.array([y for *_, y in checked], dtype=np.int64))
    table = np.zeros((FEATURES + 1, len(languages) + 1), dtype=np.float32)
    table[:FEATURES, :-1], table[:FEATURES, -1] = w * idf[:, None], idf
    return Model(languages, table, bias, temperature)


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns in keep, lang_pred and score (0 to 1) of every row's whole text, and of nothing else; repeated rows each give their row, an empty table gives none. The model, whose size FEATURES and the number of languages bound, is broadcast. A kept column with the name of one of those added is left out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, lambda: shared.value.predict, "lang_pred string, score double", *keep)


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the key as text, modulo 3, is 1. Null keys are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
