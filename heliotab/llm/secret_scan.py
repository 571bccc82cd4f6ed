"""Secrets in texts: three fixed patterns, and strings that a tokenizer's vocabulary spells badly."""

import re
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from heliotab.llm.common import map_texts

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "inefficient")
#: A string reads as random below so many code points a token, by what it is made of and by its least length; digits alone never do. Chosen so that random strings of 24 characters are found (9 of 10 or more in each alphabet) and prose, names in source code, paths and slugs aren't; the README has the figures.
LIMITS = {
    "letters and digits": ((20, 2.1), (16, 1.8), (12, 1.6)),
    "letters of mixed case": ((20, 1.75), (16, 1.6)),
    "letters of one case": ((24, 2.0), (20, 1.9)),
}
#: Of a longer string, parts may be random where the whole isn't; a part counts so many code points for each token, less its own.
RUN, RATIO = 20, 2.1
#: A random string has at most one separator in so many code points (base64 has one in 32): paths, dates and joined names have more.
SPARSE = 8
#: Hexadecimal digits of the usual digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_DIGITS = (32, 40, 56, 64, 96, 128)

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Maximal runs of the characters that keys are written in.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+={0,2}")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
#: Parts of a run: UUIDs, and what stands between separators.
_PART = re.compile(rf"(?<![A-Za-z0-9]){_UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+=*")
_MIXED = re.compile(r"[a-z][A-Z]|[A-Z][a-z]*[A-Z]+[a-z]")
_ONE_CASE = re.compile(r"[^A-Za-z]*(?:[a-z]+|[A-Z]+)[^A-Za-z]*")
_HEX_ONLY = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_INTEGRITY = re.compile(r"sha(?:256|384|512)-[A-Za-z0-9+/]+={0,2}")


@lru_cache(2)
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def known(run: str, assigned: bool = False) -> bool:
    """Integrity strings, UUIDs, and hexadecimal digits of a usual digest's length: random by design, and no secrets. Digests are printed in either case by common tools, so both are left out, but not where the digits are the value that a text assigns to a password, token or key."""
    return bool(_UUID.fullmatch(run) or _INTEGRITY.fullmatch(run) or not assigned and len(run) in DIGEST_DIGITS and _HEX_ONLY.fullmatch(run))


def limit(run: str) -> float:
    """The entry of LIMITS for a string; 0 if there is none."""
    if any(c.isdigit() for c in run):
        kind = "letters and digits" if any(c.isalpha() for c in run) else None
    elif _MIXED.search(run):
        kind = "letters of mixed case"
    else:
        kind = "letters of one case" if _ONE_CASE.fullmatch(run) else None
    return next((ratio for n, ratio in LIMITS.get(kind, ()) if len(run) >= n), 0.0)


def inefficient(run: str, encoding, assigned: bool = False) -> bool:
    """Not known, and below the limit of code points a token for its kind and length. A string with separators must have RUN code points, and SPARSE ones or more for each separator."""
    ratio, between = limit(run), sum(map(run.count, "/-_+"))
    if between and (len(run) < RUN or between * SPARSE > len(run)):
        return False
    return ratio > 0 and not known(run, assigned) and len(run) < ratio * len(encoding.encode_ordinary(run))


def inefficient_parts(run: str, encoding) -> list[tuple[int, int]]:
    """(start, end) of the inefficient stretches of parts of a run that is as a whole too readable, as a key behind a path is.

    A part counts RATIO for each token less 1 for each code point; the maximal stretches with positive sums are found in one pass (Ruzzo and Tompa) and tested. Of a stretch that fails, each part is tested alone. Parts that are known end a stretch.
    """
    found: list[tuple[int, int]] = []
    stretches: list[tuple[int, int, float, float]] = []  # first part, end, sums before and behind
    parts = list(_PART.finditer(run))

    def close():
        for first, end, _, _ in stretches:
            start, stop = parts[first].start(), parts[end - 1].end()
            if inefficient(run[start:stop], encoding):
                found.append((start, stop))
            else:
                found.extend(p.span() for p in parts[first:end] if inefficient(p[0], encoding))
        stretches.clear()

    total = least = 0.0
    for i, part in enumerate(parts):
        if known(part[0]):
            close()
            total = least = 0.0
            continue
        score = RATIO * len(encoding.encode_ordinary(part[0])) - len(part[0])
        first, before, total = i, total, total + score
        if total <= least:
            close()
            least = total
        if score <= 0:
            continue
        while True:
            j = next((j for j in reversed(range(len(stretches))) if stretches[j][2] < before), None)
            if j is None or stretches[j][3] >= total:
                break
            first, _, before, _ = stretches[j]
            del stretches[j:]
        stretches.append((first, i + 1, before, total))
    close()
    return found


def spans(text: str, encoding) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in order; code points, end exclusive."""
    found, values = [], []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        matches = [m for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
        found += [(m.start(), 0, m.end()) for m in matches]
        values = [m.span(1) for m in matches]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    for run in _RUN.finditer(text):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, run.start(), run.end())]
        k = bisect_right(values, (run.start(), len(text)))
        assigned = k > 0 and run.end() <= values[k - 1][1]
        if inefficient(run[0], encoding, assigned):
            found.append((run.start(), 3, run.end()))
        elif len(run[0]) > RUN and not known(run[0]):
            found += [(run.start() + a, 3, run.start() + b) for a, b in inefficient_parts(run[0], encoding)]
    return sorted(found)


def _listed(found) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan(docs: DataFrame, ranks_path: str, *keep: str) -> DataFrame:
    """Columns in keep, n_assign, n_access, n_hex, base_sha256 of the spans of these, and `spans` with those of the method besides.

    Null and empty texts: no span. Spans of different kinds may overlap; repeated rows give the same spans each.
    """

    def setup():
        from hashlib import sha256

        encoding = _encoding(ranks_path)

        def one(text):
            found = spans(text, encoding) if text else []
            base = [x for x in found if x[1] < 3]
            return *(sum(k == x[1] for x in base) for k in range(3)), sha256(_listed(base).encode()).hexdigest(), _listed(found)

        return lambda texts: list(zip(*map(one, texts)))

    return map_texts(docs, setup, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", *keep)


def redact(docs: DataFrame, ranks_path: str, mask: str = "[secret]") -> DataFrame:
    """The same rows and columns, with each secret of the column `text` (spans that overlap count as one) replaced by the mask. Nulls stay null."""

    def setup():
        encoding = _encoding(ranks_path)

        def one(text):
            if not text:
                return text
            out, at = [], 0
            for start, _, end in spans(text, encoding):
                if start >= at:
                    out += [text[at:start], mask]
                at = max(at, end)
            return "".join([*out, text[at:]])

        return lambda texts: [list(map(one, texts))]

    others = [c for c in docs.columns if c != "text"]
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("others") if others else F.lit(0).alias("others"), "text")
    made = map_texts(own, setup, "redacted string", "others")
    return made.select(*[F.col("redacted").alias(c) if c == "text" else F.col("others").getField(c).alias(c) for c in docs.columns])
