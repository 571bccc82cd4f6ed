"""Each registered query of the operators on texts over the whole smallest tables, against brute force, round trips or DuckDB."""

import os
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from heliotab.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def run(spark, texts):
    def rows(name):
        out = queries.queries()[name](spark, SF).collect()
        if name not in ("op10_token_matrix", "op11_phrases", "op12_lexical_search"):
            assert {r["doc_id"] for r in out} == set(texts)
        return out

    return rows


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(name, spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    theirs = con.sql(queries.oracle_sql()[name])
    ours = queries.queries()[name](spark, SF)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert Counter(tuple(r) for r in ours.select(*theirs.columns).collect()) == Counter(theirs.fetchall())


def test_op1(run, texts):
    for r in run("op1_quality_rules"):
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])
        places = {}
        for i in range(len(w) - 7):
            places.setdefault(tuple(w[i : i + 8]), []).append(i)
        again = len({j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)})
        lines = [x for x in texts[r["doc_id"]].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 20 or 100 * again > 30 * len(w)
        assert tuple(r)[1:7] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", texts[r["doc_id"]])), len(lines) - len(set(lines)), again, failed)
        assert r["kept"] == (not failed and r["rule"] is None)


def test_op3(run, spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = run("op3_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in out)
    told = [r for r in out if r["held_out"] and known[r["doc_id"]]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in told) >= 0.9 * len(told)


def test_op4(run, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, want = run("op4_local_search_pack"), Counter()
    for i, x in texts.items():
        ids = np.array([*t.encode(x, add_special_tokens=False).ids, 1], dtype="<u4")
        for p, s in enumerate(range(0, len(ids), 4096)):
            want[i, p, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    fill = Counter()
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 1


def test_op6(run, texts):
    kinds = (re.compile(r"""(?a:((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+"))
    for r in run("op6_secret_scan"):
        found = sorted((m.start(), k, m.end()) for k, p in enumerate(kinds) for m in p.finditer(texts[r["doc_id"]]) if (len(m[2]) >= 12 if k == 0 else len(m[0]) >= (18, 16)[k - 1]))
        listed = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in found) for x in range(3)]
        assert r["base_sha256"] == sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("inefficient")] == listed


def test_op7(run, texts):
    from heliotab.llm.secret_scan import _encoding

    e = _encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for r in run("op7_edit_counts"):
        x = texts[r["doc_id"]]
        n, new = len(x), "Draft: " + x
        new = new[: n // 2] + "a passage put in later" + new[n // 2 + 12 :]
        new = new[: n + 2] + new[n + 64 :]
        assert (r["n_tokens"], r["n_tokens_edited"]) == (len(e.encode_ordinary(x)), len(e.encode_ordinary(new)))


def test_op8(run, texts):
    from heliotab.llm.secret_scan import _encoding

    e = _encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for r in run("op8_byte_bpe"):
        x = texts[r["doc_id"]]
        ids = e.encode_ordinary(x)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha256(x.encode()).hexdigest())
        whole = [i for i, c in enumerate(x) for _ in c.encode()]
        sizes = [len(e.decode_single_token_bytes(i)) for i in ids]
        at = np.cumsum([0, *sizes])
        assert r["offsets_crc32"] == zlib.crc32(np.array([whole[i] for i in at[:-1]], dtype="<u4").tobytes())
        assert r["n_split"] == sum(whole[i] == whole[i - 1] for i in at[1:-1])


def test_op9(run, texts):
    for r in run("op9_ogg_media"):
        b = texts[r["doc_id"]].encode()
        p = b + bytes(-len(b) % 64 or (64 if not b else 0))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), sha256(p).hexdigest(), zlib.crc32(p[-64:])) and r["media_bytes"] > len(p)


def test_op10(run, texts):
    from heliotab.llm.secret_scan import _encoding

    e = _encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found, want = Counter(), Counter()
    for r in run("op10_token_matrix"):
        c = r["cu_seqlens"]
        for k, (a, b) in enumerate(zip(c, c[1:])):
            found[r["keys"][k], r["starts"][k], tuple(r["input_ids"][a:b])] += 1
            assert r["position_ids"][a:b] == list(range(b - a))
    for i, x in texts.items():
        ids = [*e.encode_ordinary(x), 50256]
        for s in range(0, len(ids), 2048):
            want[i, s, tuple(ids[s : s + 2048])] += 1
    assert found == want


def test_op13(run, texts):
    from xxhash import xxh64_intdigest

    fps = {}
    for i, text in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
        h = [xxh64_intdigest(" ".join(w[j : j + 3]).encode(), 42) for j in range(max(1, len(w) - 2))] if w else []
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    least = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2 and least[b] < least[a]:
                    least[a], changed = least[b], True
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run("op13_simhash_dedup")} == {i: (f"{f:016x}", least[i]) for i, f in fps.items()}
