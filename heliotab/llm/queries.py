"""One query for each operator on texts, over the whole of its table, and DuckDB SQL where that can say the same."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliotab.llm import byte_bpe, edit_counts, histogram_sort, language_id, lexical_search, local_search_pack, ngram_join, ogg_media, phrases, quality_rules, secret_scan, simhash_dedup, token_matrix
from heliotab.llm.common import documents


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file, the same on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, the base's verdict and that of rules learned from the table labels, of each document."""
    docs = documents(spark, sf_dir)
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.assess(docs, rules, "doc_id").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes (law `bytes`), by rising doc_id."""
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = histogram_sort.shard(docs, F.col("doc_id"), F.col("size"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, by a model of the documents that aren't held out."""
    docs = documents(spark, sf_dir)
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~held_out), F.col("doc_id"))
    return language_id.predict(docs.withColumn("held_out", held_out), model, "doc_id", "held_out")


def op4_local_search_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 4,096 tokens."""
    items = local_search_pack.pieces(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), 4096, "doc_id")
    return local_search_pack.pack(items, 4096)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document under links of similar shingle sets."""
    rows, _ = ngram_join.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "n_shingles", "component_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in each document."""
    return secret_scan.scan(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), "doc_id")


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document before and after three edits: a heading, a passage in the middle exchanged, and the end taken off."""
    n = F.coalesce(F.length("text"), F.lit(0))
    edits = F.array(
        F.struct(F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit("Draft: ").alias("new")),
        F.struct(F.floor(n / 2).cast("int").alias("start"), F.floor(n / 2 + 12).cast("int").alias("stop"), F.lit("a passage put in later").alias("new")),
        F.struct((n + 2).alias("start"), (n + 64).alias("stop"), F.lit("").alias("new")),
    )
    docs = documents(spark, sf_dir).withColumn("edits", edits)
    return edit_counts.count_edited(docs, tokenizer_path("byte_bpe_50k.tiktoken"), "doc_id")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document, what they decode to, and a digest of their offsets."""
    return byte_bpe.round_trip(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), "doc_id")


def op9_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document stored as an Ogg clip and read back."""
    return ogg_media.digest(documents(spark, sf_dir), "doc_id")


def op10_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed matrices of 2,048 ids a row, with the positions, segment lengths and documents of each."""
    return token_matrix.packed(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), 50256, 2048)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    return phrases.collocations(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical_search.search(lexical_search.build(documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of each document and its component under links of near ones."""
    rows, _ = simhash_dedup.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "fingerprint", "n_links", "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: The same shards: a boundary is the first row with at least its share of bytes before it. The checksum goes byte by byte through the usual table of 256 entries, made by its rule.
_SHARDS = """WITH RECURSIVE step(i, k, c) AS (SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
  crc AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
  d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
  s AS (SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32,
        CAST((sum(size) OVER w - size) * 24 // sum(size) OVER () AS INT) AS shard FROM d, crc WINDOW w AS (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING))
  SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM s"""

#: The same components, from all pairs of documents that share a shingle.
_COMPONENTS = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
  n AS (SELECT doc_id, len(s) AS n FROM s),
  e AS (SELECT doc_id, unnest(s) AS g FROM s),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.both >= 80 * (x.n + y.n - p.both)),
  k AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r AS (SELECT doc_id AS node, doc_id AS least FROM n UNION SELECT k.b, r.least FROM r JOIN k ON r.node = k.a)
  SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.least) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY ALL"""


_A_TO_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The same phrases, from the counts of all phrases of one to five words.
_PHRASES = rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_A_TO_Z}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
  g AS (SELECT lang, w[i:i + k - 1] AS p, k FROM i, range(1, 6) t(k) WHERE i + k - 1 <= len(w)),
  f AS MATERIALIZED (SELECT lang, p, any_value(k) AS k, count(*) AS a FROM g GROUP BY lang, p HAVING count(*) >= 100),
  n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
  inner_ AS (SELECT lang, p[j:j + m - 1] AS p, max(a) AS longer FROM f, range(2, 5) t(m), range(1, 5) u(j) WHERE m < k AND j + m - 1 <= k GROUP BY ALL),
  c AS (SELECT f.* FROM f LEFT JOIN inner_ x ON x.lang = f.lang AND x.p = f.p WHERE f.k > 1 AND (x.longer IS NULL OR 100 * x.longer < 100 * f.a)),
  s AS (SELECT c.lang, c.p, c.a, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * c.a * n.n // (l.a::HUGEINT * r.a))::BIGINT AS score, cut
        FROM c JOIN n USING (lang), range(1, 5) t(cut) JOIN f l ON l.lang = c.lang AND l.p = c.p[1:cut] JOIN f r ON r.lang = c.lang AND r.p = c.p[cut + 1:] WHERE cut < c.k),
  m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM m QUALIFY rank <= 2000"""

#: The same scores, from every document that holds a term of an item.
_SEARCH = rf"""WITH b AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_A_TO_Z}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
  s AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM b WHERE len(t) > 0),
  o AS (SELECT row, doc_id, 25 + (75 * len(t) * docs) // terms AS m, unnest(t) AS t FROM b, s WHERE len(t) > 0),
  f AS (SELECT row, doc_id, t, m, count(*) AS tf FROM o GROUP BY ALL),
  w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY t, docs),
  q AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all({_A_TO_Z}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
  x AS (SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN w USING (t) JOIN f USING (t) GROUP BY ALL)
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM x WHERE score > 0 QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for what it can say. Learned rules and models, tokenizers, packing by search, Ogg and XXH64 are tested against brute force, round trips and held-out rows instead."""
    return {"op2_histogram_sort": _SHARDS, "op5_ngram_join": _COMPONENTS, "op11_phrases": _PHRASES, "op12_lexical_search": _SEARCH}
