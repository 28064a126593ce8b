"""Text columns: lengths, character classes, lines, sentence rewrites, shingles; all but shingles JVM-side."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: white space and line ends as Python's isspace() and splitlines() have them
WS = r"\x09-\x0d\x1c-\x20\x85\xa0  -     　"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# fixed values: the navigation bar and footer a page wrapper adds
WRAP_HEAD = "Home  News  Topics  About  Contact  Login  Search\n\n"
WRAP_FOOT = "\n\nShare this page  Subscribe for updates  Back to top  Print"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(c: Column | str) -> Column:
    """Unicode code points."""
    return F.length(col(c))


def symbol_ratio(c: Column | str) -> Column:
    """Share of characters that are no letter, number or white space; null for null, 0 for empty text."""
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(col(c), rf"[\p{{L}}\p{{N}}{WS}]+", "")), F.length(col(c))), F.when(col(c).isNotNull(), F.lit(0.0)))


def lines(c: Column | str) -> Column:
    """The lines without their ends; a final line end adds no empty line; empty text is one empty line."""
    a = F.split(col(c), LINE_END, -1)
    return F.when((F.size(a) > 1) & (F.element_at(a, -1) == ""), F.slice(a, 1, F.size(a) - 1)).otherwise(a)


def mean_line_length(c: Column | str) -> Column:
    """Mean length of lines(), from numbers of characters alone: no list of lines is made."""
    c = col(c)
    bare = F.length(F.translate(c, LINE_ENDS, ""))
    ends = F.length(c) - bare - (F.length(c) - F.length(F.replace(c, F.lit("\r\n"), F.lit("")))) / 2
    open_ = F.length(F.translate(F.right(c, F.lit(1)), LINE_ENDS, "")) + F.when(F.length(c) == 0, 1).otherwise(0)
    return bare / (ends + open_)


def contains_any(c: Column | str, parts: tuple[str, ...]) -> Column:
    """Whether the lower-cased text contains one of the parts."""
    low = F.lower(col(c))
    out = F.lit(False)
    for p in parts:
        out = out | low.contains(p)
    return out


def first_chars(c: Column | str, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def first_share(c: Column | str, share: float = 0.7) -> Column:
    """The first int(length * share) characters."""
    return F.left(col(c), (F.length(col(c)) * F.lit(share).cast("double")).cast("int"))


def sentences(c: Column | str) -> Column:
    """The stripped text, cut at white space after a full stop, exclamation or question mark."""
    stripped = F.regexp_replace(col(c), rf"^[{WS}]+|[{WS}]+$", "")
    return F.split(stripped, rf"(?<=[.!?])[{WS}]+")


def rotated(c: Column | str) -> Column:
    """The first sentence moved to the end, all joined by one blank."""
    a = sentences(c)
    return F.array_join(F.concat(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 1, 1)), " ")


def wrapped(c: Column | str) -> Column:
    """The text within a constant page head and foot."""
    return F.concat(F.lit(WRAP_HEAD), col(c), F.lit(WRAP_FOOT))


def words(c: Column | str) -> Column:
    """The white-space separated words of the lower-cased text."""
    return F.array_remove(F.split(F.lower(col(c)), f"[{WS}]+"), "")


def crc_set(text: str | None, size: int = 5) -> np.ndarray:
    """Distinct CRC-32 values of the word sequences of the given size; a shorter text is one sequence,
    an empty or null one none."""
    w = text.lower().split() if text else []
    if not w:
        return np.zeros(0, np.int64)
    grams = {" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
    return np.fromiter({zlib.crc32(g.encode("utf-8", "replace")) for g in grams}, np.int64)


def shingle_crcs(c: Column | str, size: int = 5) -> Column:
    """crc_set() of a column, in Arrow batches: as array expressions it is several times slower."""

    @F.pandas_udf("array<bigint>")
    def crcs(s: pd.Series) -> pd.Series:
        return s.map(lambda t: crc_set(t, size))

    return crcs(col(c))


def cache_key(c: Column | str, dim: int) -> Column:
    """Hex SHA-256 of the text, a colon, the dimension."""
    return F.concat_ws(":", F.sha2(col(c), 256), F.lit(str(dim)))
