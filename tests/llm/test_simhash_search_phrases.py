"""SimHash near-duplicates, ranked search and phrases against brute force, and on nulls, empty texts, ties, repeated rows, empty tables, long texts and clashing columns."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heliotab.llm import lexical_search, phrases, simhash_dedup

ODD = ["", None, " \t\n", "One", "two words", "a b c", "A B C", "é ü", "日本語 👍🏽 text", "\x00\x1c\x85", "word " * 30, "x" * 5000]


def prose(seed, n, alphabet="aeioulnrst"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(2, 6))) for _ in range(n))


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


# -- 13 SimHash -------------------------------------------------------------------------------------------------------


def by_hand(text):
    from xxhash import xxh64_intdigest

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words]
    k = min(3, len(words))
    h = [xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_by_hand(monkeypatch):
    monkeypatch.setattr(simhash_dedup, "STEP", 7)
    for text in [*ODD, prose(1, 50), prose(2, 3), "a a a a a a", "x y " * 200]:
        assert simhash_dedup.fingerprint(text) == by_hand(text)


def test_spark_hashes_shingles_alike(spark):
    from xxhash import xxh64_intdigest

    for text in ("a b c", "é ü 日本語"):
        assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("pairs", [0, 2, 32])
def test_links_against_all_pairs(spark, pairs, monkeypatch):
    """Random fingerprints, and groups that differ in a few bits of one half, of both, or of the last byte."""
    monkeypatch.setattr(simhash_dedup, "PAIRS", pairs)
    r = random.Random(pairs)
    values = {r.getrandbits(64) for _ in range(100)} | {0, 1, (1 << 64) - 1, 1 << 63}
    for reach in (range(64), range(32), range(32, 64), range(8), range(8, 16)):
        centre = r.getrandbits(64)
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in r.sample(list(reach), r.randint(0, 4))))
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    got = [tuple(x) for x in simhash_dedup.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_full_entry_makes_few_pairs(spark, monkeypatch):
    """1,500 fingerprints alike in one half."""
    made = []
    keep = simhash_dedup.materialised
    monkeypatch.setattr(simhash_dedup, "materialised", lambda df: made.append(df) or keep(df))
    r = random.Random(3)
    values = list({r.getrandbits(32) for _ in range(1500)})
    got = simhash_dedup.links(spark.createDataFrame([(v,) for v in values], "fp long")).count()
    assert got == sum((a ^ b).bit_count() <= 2 for i, a in enumerate(values) for b in values[:i])
    assert len(made) > 3


def test_simhash_near_duplicates(spark):
    r = random.Random(5)
    texts = [*ODD]
    for g in range(8):
        words = prose(g, 400).split()
        for _ in range(6):
            own = list(words)
            for _ in range(r.randint(0, 2)):
                own[r.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
    rows = [(i * 7 % 1000, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[20], "x", 1), (None, "alone among many words", "x", 1), (14, texts[2], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int").repartition(3)
    found, _ = simhash_dedup.near_duplicates(docs)
    fps = [by_hand(t) for _, t, *_ in rows]
    roots = closure(set(fps), [(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for (i, *_), f in zip(rows, fps):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    want = Counter((i, f"{f:016x}", least.get(roots[f])) for (i, *_), f in zip(rows, fps))
    assert Counter((x["doc_id"], x["fingerprint"], x["component_id"]) for x in found.collect()) == want
    assert len(set(roots.values())) < len(set(fps)) - 5


def test_simhash_of_nothing(spark):
    found, links = simhash_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert not found.collect() and not links.collect()


# -- 12 ranked search -------------------------------------------------------------------------------------------------


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def search_by_hand(docs, items, k):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in terms_of(text) if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        for r, (s, none, i) in enumerate(sorted(scored)[:k], 1):
            out[item, r, None if none else i, -s] += 1
    return out


@pytest.mark.parametrize("size,block", [(1 << 20, 4096), (300, 3)])
def test_search_by_hand(spark, size, block, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", size)
    monkeypatch.setattr(lexical_search, "BLOCK_QUERIES", block)
    texts = [*ODD, "It's 9 o'clock; IT'S nine", *[prose(i % 25, 5 + i % 40, "aeio") for i in range(60)], prose(3, 4000, "aei")]
    rows = [(i * 11 % 997, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, texts[20], "x", 1, 2), (33, texts[3], "x", 1, 2)]
    items = [(i, prose(i, 6, "aeio") + " It's") for i in range(8)] + [(8, None), (9, "..."), (10, "nowhere known"), (None, "one TWO one"), (3, texts[30]), (11, texts[14] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keys string, score int, rank int").repartition(3)
    index = lexical_search.build(docs)
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == search_by_hand([r[:2] for r in rows], items, 5)


def test_selection_is_safe_for_ties():
    import numpy as np

    r = random.Random(4)
    for _ in range(200):
        scores = np.array([r.randint(0, 4) for _ in range(r.randint(0, 30))], dtype=np.int64)
        order = np.array(r.sample(range(100), len(scores)), dtype=np.int64)
        want = sorted((i for i in range(len(scores)) if scores[i] > 0), key=lambda i: (-scores[i], order[i]))[:5]
        assert lexical_search.best(scores, order, 5).tolist() == want


def test_norms_of_many_documents():
    import numpy as np

    lengths = np.array([1, 10**7])
    assert lexical_search._norms(lengths, 10**12, 10**14).tolist() == [25 + 75 * n * 10**12 // 10**14 for n in lengths.tolist()]


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert not lexical_search.search(lexical_search.build(none), items).collect()
    assert not lexical_search.search(lexical_search.build(spark.createDataFrame([(1, "a")], "doc_id long, text string")), items.limit(0)).collect()


# -- 11 phrases -------------------------------------------------------------------------------------------------------


def phrases_by_hand(rows, least, longest, subsumed, best):
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    own[tuple(w[i : i + k])] += 1
    out = Counter()
    for lang, own in f.items():
        kept = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in kept.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        scored = []
        for p, a in kept.items():
            if not inside[p] or 100 * inside[p] < subsumed * a:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out[lang, r, p.decode(), -a, left, right, n[lang], -s] += 1
    return out


@pytest.mark.parametrize("size,batch,least,subsumed,best", [(1 << 20, 1 << 17, 3, 100, None), (500, 16, 3, 100, 20), (200, 7, 2, 60, None), (500, 64, 1, 100, None)])
def test_phrases_by_hand(spark, size, batch, least, subsumed, best, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", size)
    monkeypatch.setattr(phrases, "BATCH", batch)
    r = random.Random(size)
    texts = [*ODD, "a a a a a a a a", "New York, new york; NEW YORK", "x.y z x,y z"]
    for _ in range(40):
        words = [r.choice("one two three four five six é 日本".split()) for _ in range(r.randint(1, 80))]
        texts.append("".join(w + r.choice([" ", " ", "  ", "\t", ". ", "\n"]) for w in words))
    rows = [(t, r.choice(["en", "de", None, "und"])) for t in texts] + [(texts[20], "en")] * 3
    docs = spark.createDataFrame([(t, g, "x", 1, 2) for t, g in rows], "text string, lang string, phrase string, id int, shard int").repartition(3)
    got = phrases.collocations(docs, least=least, subsumed=subsumed, best=best)
    want = phrases_by_hand(rows, least, 5, subsumed, best)
    assert Counter(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == want and want


def test_phrases_of_nothing(spark):
    assert not phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    assert not phrases.collocations(spark.createDataFrame([(None, None), ("", "en"), (" . ", "en")], "text string, lang string"), least=1).collect()


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 10)
    for text in (b"aa bb. cc dd ee ff gg hh, ii", b"a" * 35, b".........................", b"", b"x y z w v u t s r q p o"):
        parts = list(phrases._parts(text))
        assert b"".join(parts) == text and all(p[-1:] in b".,;:!?\n" for p in parts[:-1])
