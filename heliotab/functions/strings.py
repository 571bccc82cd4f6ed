"""Words: paths, numbers written as text, and hashes."""

from pyspark.sql import Column, functions as F


def is_int(s: Column) -> Column:
    return F.rlike(s, F.lit(r"^\s*[-+]?[0-9]+\s*$"))


def is_number(s: Column) -> Column:
    return F.rlike(s, F.lit(r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"))


def basename(path: Column) -> Column:
    """What stands behind the last slash."""
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """What stands before the last slash; all, if there is none."""
    return F.regexp_replace(path, "/[^/]*$", "")


def find(s: Column, part: str) -> Column:
    """The place of a part's first occurrence, from 0; -1 if there is none."""
    return F.instr(s, part) - 1


def pop(s: Column, separator: str) -> tuple[Column, Column]:
    """The first word and what follows its separator."""
    head = F.substring_index(s, separator, 1)
    return head, F.substring(s, F.length(head) + len(separator) + 1, F.length(s))


def word_hash(s: Column, buckets: int) -> Column:
    """One of so many buckets, by the first 32 bits of the word's MD5; the same in every engine."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") % buckets
