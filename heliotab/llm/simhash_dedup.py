"""Near-duplicates by SimHash fingerprints, with multi-index hashing: fingerprints within RADIUS bits of each other are found in tables by segments, of which small Hamming balls are enumerated, and are verified by their whole distance.

Two fingerprints that differ in at most 2 of some bits differ in at most 1 of the upper half of these bits or in none of the lower half. So each fingerprint is stored under its upper and its lower segment, and looked up under its own segments and under the upper ones that differ from its own in one bit. Of two fingerprints that differ there, one has a 0 where the other has a 1, so only zeros are turned.

What meets in a table entry is compared directly as long as that makes few pairs for each row. In fuller entries, of many fingerprints alike in one segment, the other segment is halved in the same way, again and again down to the last 8 bits, where an entry stores 256 different fingerprints at most. So the work grows with the rows and not with the square of a group.
"""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from heliotab.llm.common import map_texts, materialised
from heliotab.llm.components import components
from heliotab.operators.hot_keys import join_counted

#: Words a shingle; seed of XXH64; differing bits of linked fingerprints at most (the tables are laid out for 2).
WORDS, SEED, RADIUS = 3, 42, 2
#: Pairs for each row of a table entry, up to which it isn't halved; bits of the last segment.
PAIRS, LAST = 32, 8
#: Hashes whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: str | None) -> int:
    """64 bits: each is 1 if it is in over half of the XXH64 hashes of the text's shingles, repeats included: WORDS words in a row, A-Z in lower case, joined by a space; all words where there are fewer. 0 without words."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(WORDS, len(words))
    places = list(zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(places), STEP):
        digests = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in places[i : i + STEP]])  # most significant byte first
        ones += np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(places)).tobytes())


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns in keep and `fp`, the fingerprint as a signed long, of the column `text`."""

    def setup():
        return lambda texts: ([int(np.uint64(fingerprint(x)).astype(np.int64)) for x in texts],)

    return map_texts(docs, setup, "fp long", *keep)


def _dealt(items: DataFrame, size: int) -> DataFrame:
    """Table rows (lo, v, fp, at, stored) of items (lo, fp, at, stored), whose bits from lo on, so many, are still unknown: all others are equal in an entry. `at` is what they are stored or looked up by. One half of the unknown bits becomes known: `lo` is where the other begins, v the known bits."""
    half = size // 2
    known = F.array(F.struct(F.col("lo"), F.col("at"), F.col("stored")), F.struct((F.col("lo") + half).alias("lo"), F.col("at"), F.col("stored")))
    turned = F.expr(f"transform(filter(transform(sequence(0, {half - 1}), i -> shiftleft(1L, lo + {half} + i)), b -> stored AND (at & b) = 0), b -> struct(lo, at ^ b AS at, false AS stored))")
    rows = items.select("fp", F.explode(F.concat(known, turned)).alias("r")).select("fp", "r.*")
    return rows.withColumn("v", F.expr(f"at & ~shiftleft({(1 << half) - 1}L, lo)"))


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b as signed longs, of the distinct longs in the column `fp` that differ in at most RADIUS bits."""
    items, size, found, key = fps.select("fp", F.col("fp").alias("at"), F.lit(0).alias("lo"), F.lit(True).alias("stored")), 64, None, ["lo", "v"]
    while True:
        rows, size = _dealt(items, size), size // 2
        counts = rows.groupBy(*key).agg(F.count_if("stored").alias("s"), F.count_if(~F.col("stored")).alias("f"))
        counts = materialised(counts.where("s > 1 OR s > 0 AND f > 0").withColumn("rows", F.col("s") + F.col("f")))
        few = F.col("s") * (F.col("s") - 1) / 2 + F.col("s") * F.col("f") <= PAIRS * F.col("rows")
        light = (counts if size == LAST else counts.where(few)).select(*key, "rows")
        stored = join_counted(rows.where("stored"), light, key, ["fp"]).groupBy(*key).agg(F.collect_list("fp").alias("others"))  # 2 * PAIRS + 1, or 256 at most
        stored = materialised(stored.join(light, key))
        met = join_counted(rows, stored, key, ["fp", "at"]).select("fp", "stored", F.explode("others").alias("other"))
        near = met.where((~F.col("stored") | (F.col("fp") < F.col("other"))) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS))
        pairs = materialised(near.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct())
        found = pairs if found is None else found.unionByName(pairs)
        heavy = counts.where(~few).select(*key, "rows")
        if size == LAST or not heavy.limit(1).count():
            return found.distinct()
        items = materialised(join_counted(rows, heavy, key, ["fp", "at"]).select("lo", "fp", "at", "stored"))


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, links): for each row of docs its id, fingerprint (16 hexadecimal digits), fp (the same as a signed long), n_links (other fingerprints within RADIUS) and component_id, the least id that links reach from it; and the links (a, b) of fingerprints.

    Texts are read whole. Null, empty and blank texts have the fingerprint 0, which links like any other. Rows with a null id take part; a component of such rows alone has a null id. Repeated rows each give their row. An empty table gives no rows. Other columns are ignored.
    """
    rows = materialised(fingerprints(docs.select(F.col(id_column).alias("id"), "text"), "id"))
    fps = materialised(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("rows")))
    pairs = materialised(links(fps.select("fp")))
    degrees = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    linked = materialised(fps.join(degrees, "fp").join(components(pairs).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = linked.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("rows"))
    linked = join_counted(linked, materialised(least), ["root"], ["fp"]).select("fp", "component", "n_links", "rows")
    alone = fps.where("rows > 1").join(linked, "fp", "left_anti").select("fp", F.col("least").alias("component"), F.lit(0).cast("long").alias("n_links"), "rows")
    told = materialised(linked.unionByName(alone).withColumn("told", F.lit(True)))
    out = join_counted(rows, told, ["fp"], ["id"], "left")
    found = out.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "fp", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("told"), F.col("component")).otherwise(F.col("id")).alias("component_id"))
    return found, pairs
