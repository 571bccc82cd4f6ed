"""Quality rules: statistics of texts, and a decision list learned from labels by sequential covering, all in DataFrame functions."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from heliotab.llm.common import materialised

#: Labelled rows that the rules are learned from, as expected (all, if there are fewer).
TRAINING_ROWS = 20_000
#: Thresholds that are tried for a feature: these quantiles of the bad rows and of the others.
QUANTILES = (0.0, 0.02, *(i / 10 for i in range(1, 10)), 0.98, 1.0)
#: What a rule must reach on the rows that it wasn't grown on, and how many bad rows it must cover there.
PRECISION, COVERED = 0.9, 3
#: The statistics that rules may test, each a double.
FEATURES = ("words", "word_length", "symbols_per_100", "bangs_per_100", "bars_per_100", "upper_percent", "dup_lines_percent", "repeat_percent", "distinct_percent", "words_per_line")

_SPACE = "[\\\\x20\\\\x09-\\\\x0D]"


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns in keep; n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long); base_failed; and FEATURES.

    Words are maximal runs of other than ASCII white space. n_repeat_words counts the words in windows of 8 words that the text holds twice or more; windows are told apart by 64-bit hashes, sorted with their places, so that a text costs n log n. Null and empty texts have no words and fail. Columns are selected, so further ones can't clash.
    """
    text = F.coalesce("text", F.lit(""))
    without = lambda pattern: F.length("t") - F.length(F.regexp_replace("t", pattern, ""))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    cut = docs.select(*keep, text.alias("t")).select(
        *keep,
        F.array_remove(F.split("t", F.expr(f"'{_SPACE}+'")), "").alias("w"),
        F.length(F.regexp_replace("t", F.expr(f"'{_SPACE}+'"), F.lit(""))).cast("long").alias("word_chars"),
        without("[#*$%&|<>]").cast("long").alias("n_symbols"),
        lines.alias("lines"),
        without("!").alias("bangs"),
        without("\\|").alias("bars"),
        without("\\p{Lu}").alias("upper"),
    )
    w = F.col("w")
    windows = F.when(F.size(w) >= 8, F.transform(F.sequence(F.lit(1), F.size(w) - 7), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(8)]))).otherwise(F.array().cast("array<bigint>"))
    cut = cut.select(*keep, "word_chars", "n_symbols", "bangs", "bars", "upper", F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).alias("distinct"), F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("distinct_lines"), windows.alias("h"))
    # Places of windows by hash; the same hash next to each other means a repeated window.
    h = F.col("h")
    placed = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(1), F.size(h)).alias("i")))
    cut = cut.withColumn("s", F.when(F.size(F.array_distinct(h)) < F.size(h), placed))
    s, last = F.col("s"), F.size("s")
    same = lambda i, j: F.element_at(s, i)["h"] == F.element_at(s, j)["h"]
    repeated = F.filter(F.sequence(F.lit(1), last), lambda i: F.when(i > 1, same(i, F.greatest(i - 1, F.lit(1)))).otherwise(False) | F.when(i < last, same(i, F.least(i + 1, last))).otherwise(False))
    cut = cut.withColumn("r", F.when(s.isNotNull(), F.sort_array(F.transform(repeated, lambda i: F.element_at(s, i)["i"]))))
    r = F.col("r")
    gaps = F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: F.least(F.lit(8), b - a))
    covered = F.when(r.isNull(), 0).otherwise(F.lit(8) + F.aggregate(gaps, F.lit(0), lambda a, x: a + x))
    cut = cut.withColumn("n_dup_lines", (F.col("n_lines") - F.col("distinct_lines")).cast("long")).withColumn("n_repeat_words", covered.cast("long"))
    # A generator of one row: filters on what follows stay above it. Below it they would have the arrays computed once more for each of their elements.
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    cut = cut.select(*keep, F.inline(F.array(F.struct(*counts, "bangs", "bars", "upper", "distinct", "n_lines"))))
    n = F.greatest("n_words", F.lit(1))
    per = lambda c, of=n: (100.0 * F.col(c) / of).cast("double")
    return cut.select(
        *keep,
        *counts,
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        F.col("n_words").cast("double").alias("words"),
        (F.col("word_chars") / n).alias("word_length"),
        per("n_symbols").alias("symbols_per_100"),
        per("bangs").alias("bangs_per_100"),
        per("bars").alias("bars_per_100"),
        per("upper", F.greatest("word_chars", F.lit(1))).alias("upper_percent"),
        per("n_dup_lines", F.greatest("n_lines", F.lit(1))).alias("dup_lines_percent"),
        per("n_repeat_words").alias("repeat_percent"),
        per("distinct").alias("distinct_percent"),
        (F.col("n_words") / F.greatest("n_lines", F.lit(1))).alias("words_per_line"),
    )


@dataclass
class Rule:
    """All conditions (feature, is above, threshold) must hold."""

    conditions: list[tuple[str, bool, float]] = field(default_factory=list)

    def expression(self) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.conditions:
            out = out & ((F.col(name) > threshold) if above else (F.col(name) <= threshold))
        return out


def verdict(rules: list[Rule]) -> Column:
    """The rules in their order as one conditional expression: the number of the first that holds, from 1, or null."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(rules[k - 1].expression(), F.lit(k)).otherwise(out)
    return out


def labelled(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """About `rows` labelled documents, by a hash of doc_id: text and bad (the least quality of all labels is 0). The labels drawn, which `rows` bounds, are broadcast, so no text moves."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    count = known.count()
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(count, 1))))
    return docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id", (F.col("quality") == 0).cast("int").alias("bad"))), "doc_id")


def _counted(rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[int, int, dict[tuple[str, bool, float], tuple[int, int]]]:
    """Bad and good rows, in all and for each condition, from one aggregation: each feature's rows are counted by the number of thresholds below the value."""
    places = F.array(*[F.struct(F.lit(k).alias("f"), sum((F.col(name) > t).cast("int") for t in thresholds[name]).alias("b")) for k, name in enumerate(FEATURES) if thresholds[name]])
    found = rows.select("bad", F.explode(places).alias("p")).groupBy("p.f", "p.b").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
    cells = {(r["f"], r["b"]): (r["bad"], r["n"] - r["bad"]) for r in found}
    first = next((k for k, name in enumerate(FEATURES) if thresholds[name]), None)
    bad, good = (sum(v[i] for (k, _), v in cells.items() if k == first) for i in (0, 1))
    out = {}
    for k, name in enumerate(FEATURES):
        under = [0, 0]
        for b, t in enumerate(thresholds[name]):
            here = cells.get((k, b), (0, 0))
            under = [under[0] + here[0], under[1] + here[1]]
            out[name, False, t] = (under[0], under[1])
            out[name, True, t] = (bad - under[0], good - under[1])
    return bad, good, out


def _grown(rows: DataFrame, thresholds: dict[str, list[float]]) -> Rule:
    """Adds the condition of most FOIL gain until no good row is covered or none gains; each takes rows away, so this ends."""
    from math import log2

    rule = Rule()
    while True:
        bad, good, counts = _counted(rows.where(rule.expression()), thresholds)
        if not bad or not good:
            break
        base = log2(bad / (bad + good))
        gain = lambda c: counts[c][0] * (log2(counts[c][0] / sum(counts[c])) - base) if counts[c][0] else 0.0
        best = max(sorted(counts), key=gain, default=None)
        if best is None or gain(best) <= 1e-9:
            break
        name, above, t = best
        x = F.col(name)
        under, over = rows.where(rule.expression()).agg(F.max(F.when(x <= t, x)), F.min(F.when(x > t, x))).first()
        # in the middle of the gap, as far from the rows on either side as can be
        rule.conditions.append((name, above, t if under is None or over is None else (under + over) / 2))
    return rule


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, int, int]:
    """The start of the rule with the best (bad - good) / (bad + good) on other rows, the shortest of equals, and the bad and good rows that it covers there."""
    starts = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
    sums = [F.sum((x.expression() & (F.col("bad") == b)).cast("int")) for x in starts for b in (1, 0)]
    got = [v or 0 for v in rows.agg(*sums).first()]
    pairs = list(zip(got[::2], got[1::2]))
    worth = lambda k: (pairs[k][0] - pairs[k][1]) / max(1, sum(pairs[k]))
    best = max(range(len(starts)), key=lambda k: (worth(k), -k))
    return starts[best], *pairs[best]


def learn(training: DataFrame) -> list[Rule]:
    """A decision list that finds bad rows, from FEATURES and `bad` (0 or 1). Two thirds of the rows grow each rule and one third prunes it; what a rule covers is taken out before the next. Ends at the first rule that isn't precise enough or covers too few bad rows: each one before it covers COVERED bad rows or more of a bounded sample, so the list ends. No rows or no bad ones: no rules."""
    rows = materialised(training.select("bad", "doc_id", *FEATURES).repartition(8)).withColumn("_grow", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) > 0)
    marks = rows.groupBy("bad").agg(*[F.percentile_approx(name, list(QUANTILES), 1000).alias(name) for name in FEATURES]).collect()
    thresholds = {name: sorted({t for r in marks for t in r[name]}) for name in FEATURES}
    rules: list[Rule] = []
    if not any(thresholds.values()):
        return rules
    while True:
        left = rows.where(~F.coalesce(verdict(rules) > 0, F.lit(False)))
        rule = _grown(left.where("_grow"), thresholds)
        if not rule.conditions:
            break
        rule, bad, good = _pruned(rule, left.where("NOT _grow"))
        if bad < COVERED or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
    return rules


def assess(docs: DataFrame, rules: list[Rule], *keep: str) -> DataFrame:
    """Columns in keep, the statistics, `rule` (the first that holds, from 1, or null) and `kept`: neither the base nor a rule rejects the row."""
    found = statistics(docs, *keep).withColumn("rule", verdict(rules))
    return found.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def fit(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules from the labelled rows that pass the base."""
    drawn = labelled(docs, labels)
    return learn(statistics(drawn, "doc_id", "bad").where(~F.col("base_failed")))
