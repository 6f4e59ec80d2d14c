"""Text functions: name normalisation (F1 built-in, X1 vectorised UDF),
ellipsis truncation (F10) and the lookup text template (F17)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import as_col

# Characters Python's ``str.strip()`` removes that survive the
# ASCII filter (the ASCII characters for which ``str.isspace()`` is true).
ASCII_WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"

# Fixed value: the ellipsis character appended by the truncation helper.
ELLIPSIS = "…"


def ascii_fold(ch: str) -> str:
    """The definition the normaliser must equal: compatibility decomposition,
    then drop everything outside ASCII."""
    return unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()


@lru_cache(maxsize=None)
def _fold_table() -> tuple[str, str, dict[str, str]]:
    """Built from the rule above for every code point of Unicode: one-character results for
    ``translate``, longer ones as a map; empty results are left to the non-ASCII filter."""
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp < 0xE000:                       # surrogates are no characters
            continue
        ch = chr(cp)
        out = ascii_fold(ch)
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif out:
            multi[ch] = out
    return "".join(src), "".join(dst), multi


def _ranges(chars: str) -> str:
    """A regular-expression class of these characters, neighbours as ranges."""
    points, out = sorted(map(ord, chars)), []
    for cp in points:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out) + "]"


def normalize_name(c) -> Column:
    """NFKD, drop non-ASCII, strip, upper -- as JVM expressions, for all of Unicode.

    A compatibility decomposition works character by character, and reordering moves marks only, which
    are dropped, so a map over code points is exact. Characters with one ASCII character go through
    ``translate`` (a hash lookup); the few with more (ligatures, fractions, units) are looked up in a literal
    map, and only in texts that hold one of them."""
    src, dst, multi = _fold_table()
    x = as_col(c)
    table = F.create_map(*[F.lit(v) for pair in multi.items() for v in pair])
    spelled = F.array_join(F.transform(F.split(x, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    # A class of few ranges settles nearly all texts before the class of all such characters is tried.
    low = "".join(ch for ch in multi if ord(ch) < 0x180)
    maybe = _ranges(low).removesuffix("]") + r"\x{180}-\x{10FFFF}]"
    x = F.when(x.rlike(maybe) & x.rlike(_ranges("".join(multi))), spelled).otherwise(x)
    x = F.regexp_replace(F.translate(x, src, dst), r"[^\x00-\x7F]", "")
    return F.upper(F.btrim(x, F.lit(ASCII_WHITESPACE)))


@F.pandas_udf(T.StringType())
def _normalize_name_pandas(s: pd.Series) -> pd.Series:
    """One decomposition for the whole batch: its texts are joined by U+0000, which no
    decomposition makes or takes; texts that hold it go in a batch of their own."""
    known = s.dropna()
    odd = known[known.str.contains("\x00", regex=False)].map(ascii_fold)
    plain = known.drop(odd.index)
    folded = ascii_fold("\x00".join(plain)).split("\x00") if len(plain) else []
    out = pd.concat([pd.Series(folded, index=plain.index, dtype=object), odd])
    return out.str.strip().str.upper().reindex(s.index)


def normalize_name_udf(c) -> Column:
    """The same definition as a Python function over Arrow batches (prefer :func:`normalize_name`)."""
    return _normalize_name_pandas(as_col(c))


def truncate_label(c, n: int) -> Column:
    """longer than ``n`` characters -> first ``n-1`` plus an ellipsis."""
    c = as_col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit(ELLIPSIS))).otherwise(c)


# Fixed value: the lookup text template of the enrichment search.
SEARCH_TEXT_TEMPLATE = "%s, %s, RS, Brasil"


def lead_search_text(company_name, municipality) -> Column:
    """the text sent to the place search for one lead."""
    return F.format_string(SEARCH_TEXT_TEMPLATE, as_col(company_name), as_col(municipality))
