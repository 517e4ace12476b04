"""Text column functions (cleaning, tokenising, stopwords, prompt).

Every public function maps ``Column -> Column`` and stays JVM-side, except the
rare multi-character ASCII folds (``½`` -> ``12``), which go through an Arrow
``pandas_udf`` that only receives the rows that need it.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# --------------------------------------------------------------------------

# Code points Python treats as whitespace (str.isspace, re's \s, str.strip()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters the lexicon tokeniser splits on, besides whitespace.
TOKEN_SPLIT_PUNCT = ",:'."

# Stopwords dropped before tagging (upper case, 121 words).
STOPWORDS = (
    "ME", "MY", "MYSELF", "WE", "OUR", "OURS", "OURSELVES", "YOU", "YOUR",
    "YOURS", "YOURSELF", "YOURSELVES", "HE", "HIM", "HIS", "HIMSELF", "SHE",
    "HER", "HERS", "HERSELF", "IT", "ITS", "ITSELF", "THEY", "THEM", "THEIR",
    "THEIRS", "THEMSELVES", "WHAT", "WHICH", "WHO", "WHOM", "THIS", "THAT",
    "THESE", "THOSE", "AM", "IS", "ARE", "WAS", "WERE", "BE", "BEEN", "BEING",
    "HAVE", "HAS", "HAD", "HAVING", "DO", "DOES", "DID", "DOING", "AN", "THE",
    "AND", "BUT", "IF", "OR", "BECAUSE", "AS", "UNTIL", "WHILE", "OF", "AT",
    "BY", "FOR", "WITH", "ABOUT", "BETWEEN", "INTO", "THROUGH", "DURING",
    "BEFORE", "AFTER", "ABOVE", "BELOW", "TO", "FROM", "UP", "DOWN", "IN",
    "OUT", "ON", "OFF", "OVER", "UNDER", "AGAIN", "FURTHER", "THEN", "ONCE",
    "HERE", "THERE", "WHEN", "WHERE", "WHY", "HOW", "ALL", "ANY", "BOTH",
    "EACH", "FEW", "MORE", "MOST", "OTHER", "SOME", "SUCH", "NO", "NOR",
    "NOT", "ONLY", "OWN", "SAME", "SO", "THAN", "TOO", "VERY", "CAN", "JUST",
    "SHOULD", "NOW", "AMONG",
)

# Contraction rewrites, applied in this order, case-insensitively.
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
)

# Instruction put in front of an article before summarising.
NEUTRAL_PROMPT_PREFIX = (
    "Provide a concise, factual summary. Avoid speculative language. "
    "Separate facts from opinions. Do not editorialise.\n\n"
    "Article:\n"
)

# --------------------------------------------------------------------------
# Regex helpers (Java regex for Spark; RE2 spelling for the DuckDB oracle).
# --------------------------------------------------------------------------


def _ranges(chars: str) -> list[tuple[int, int]]:
    cps = sorted(set(map(ord, chars)))
    out: list[tuple[int, int]] = []
    for cp in cps:
        if out and cp == out[-1][1] + 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


def java_class(chars: str) -> str:
    """Body of a Java regex character class matching exactly ``chars``.

    Consecutive code points become ranges: the regex engine tests a class
    alternative by alternative, so fewer, wider alternatives match faster.
    """
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}"
                   for a, b in _ranges(chars))


def re2_class(chars: str) -> str:
    """Same class body spelled for RE2 (DuckDB)."""
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}"
                   for a, b in _ranges(chars))


WS_CLASS = java_class(PY_WHITESPACE)
ASCII_WS_CLASS = java_class("".join(c for c in PY_WHITESPACE if ord(c) < 128))
TOKEN_SPLIT_REGEX = "[" + java_class(TOKEN_SPLIT_PUNCT + PY_WHITESPACE) + "]"


def py_strip(col: Column) -> Column:
    """``str.strip()``: trims Python's 29 whitespace code points (Spark's trim only does U+0020)."""
    return F.regexp_replace(col, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")


# --------------------------------------------------------------------------
# T1 ASCII fold: NFKD, then drop everything non-ASCII.
# --------------------------------------------------------------------------


@lru_cache(maxsize=None)
def fold_tables() -> tuple[str, str, str]:
    """Derive the fold from ``unicodedata`` (a rule, not a transcribed table).

    Returns ``(src, dst, multi)``: ``src[i]`` folds to the single ASCII
    character ``dst[i]``; characters in ``multi`` fold to several ASCII
    characters; everything else non-ASCII folds to nothing.
    """
    src, dst, multi = [], [], []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        decomposed = unicodedata.normalize("NFKD", ch)
        if decomposed == ch:
            continue
        ascii_part = decomposed.encode("ascii", "ignore").decode("ascii")
        if len(ascii_part) == 1:
            src.append(ch)
            dst.append(ascii_part)
        elif len(ascii_part) > 1:
            multi.append(ch)
    return "".join(src), "".join(dst), "".join(multi)


@F.pandas_udf(T.StringType())
def _nfkd_ascii(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def ascii_fold(col: Column) -> Column:
    src, dst, multi = fold_tables()
    native = F.regexp_replace(F.translate(col, src, dst), "[^\\x00-\\x7F]", "")
    # Only rows holding a multi-character fold are shipped to Python; the
    # others pass a null, which costs one validity bit in the Arrow batch.
    # The test deletes those characters with ``translate`` (a hash lookup per
    # character) and compares lengths; a 445-way regex class is ~40x slower.
    needs_python = F.when(F.length(F.translate(col, multi, "")) != F.length(col), col)
    return F.coalesce(_nfkd_ascii(needs_python), native)


# --------------------------------------------------------------------------
# T2-T6 cleaning.
# --------------------------------------------------------------------------


def strip_markup(col: Column) -> Column:
    """Tags and lower-case named entities become a space."""
    return F.regexp_replace(F.regexp_replace(col, "<[^>]+>", " "), "&[a-z]+;", " ")


def expand_contractions(col: Column) -> Column:
    """The ordered, case-insensitive contraction rewrites."""
    for pattern, replacement in CONTRACTIONS:
        col = F.regexp_replace(col, "(?i)" + pattern, replacement)
    return col


def normalise_case_space(col: Column) -> Column:
    """T4: lower, whitespace runs to one space, no ``?``, no space at the ends.

    Runs after the ASCII fold, so only the ASCII part of Python's whitespace
    set can still occur.
    """
    collapsed = F.regexp_replace(F.lower(col), f"[{ASCII_WS_CLASS}]+", " ")
    return F.trim(F.translate(collapsed, "?", ""))


def clean_text(col: Column) -> Column:
    """T5: fold -> markup -> contractions -> case/space/``?``."""
    return normalise_case_space(expand_contractions(strip_markup(ascii_fold(col))))


def light_clean(col: Column) -> Column:
    """CR/LF to space, drop ``?``, strip (Unicode whitespace)."""
    return py_strip(F.regexp_replace(F.translate(col, "\n\r", "  "), "\\?", ""))


# --------------------------------------------------------------------------
# T7-T9 tokens, stopwords, prompt.
# --------------------------------------------------------------------------


def split_tokens(col: Column) -> Column:
    """Raw split on ``, : ' . whitespace`` (keeps empty pieces; see ``is_word``)."""
    return F.split(col, TOKEN_SPLIT_REGEX)


def is_word(token: Column) -> Column:
    """Length filter applied before upper-casing, in code points."""
    return F.length(token) > 1


def tokenize(col: Column) -> Column:
    """``ARRAY<STRING>`` of kept tokens, in text order."""
    return F.filter(split_tokens(col), lambda t: F.length(t) > 1)


def is_stopword(token: Column) -> Column:
    """Membership in the fixed stopword list (planned as ``InSet``)."""
    return F.upper(token).isin(list(STOPWORDS))


def with_prompt(col: Column, enabled: bool = True) -> Column:
    """The neutral-summary instruction in front of the article."""
    return F.concat(F.lit(NEUTRAL_PROMPT_PREFIX), col) if enabled else col
