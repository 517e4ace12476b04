"""Porter's stemmer (1980) as staged SQL expressions over a table of distinct words.

Every stage maps a word to a word and is its own projection.  The same text is valid in Spark SQL and in DuckDB but for
the name of the regular-expression test.  Words are lower-case letters and digits; a digit counts as a consonant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of up to so many characters stay as they are (as in the public scorer's tokeniser).
SHORT = 3

# Consonant and vowel runs; ``y`` is a vowel after a consonant.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
MEASURE_0 = f"^({_C})?{_V}{_C}"  # at least one vowel-consonant turn
MEASURE_1 = f"^({_C})?{_V}{_C}({_V})?$"  # exactly one
MEASURE_2 = f"^({_C})?{_V}{_C}{_V}{_C}"  # at least two
HAS_VOWEL = f"^({_C})?[aeiouy]"
ENDS_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"

# The suffixes of the published steps 2, 3 and 4 and what replaces them.
STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
          "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
          "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
          "ous", "ive", "ize")


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _suffixes(rules: dict[str, str], test, extra: dict[str, str] | None = None) -> str:
    """The longest suffix that fits decides; it is replaced if what is left passes ``test``."""
    whens = []
    for end in sorted(rules, key=lambda x: (-len(x), x)):
        left = _cut(len(end))
        more = f" and {extra[end]}" if extra and end in extra else ""
        whens.append(f"when right(w, {len(end)}) = '{end}' and length(w) > {len(end)} then "
                     f"case when {test(left)}{more} then concat({left}, '{rules[end]}') else w end")
    return f"case {' '.join(whens)} else w end"


def stages(matches: str = "regexp_like") -> list[str]:
    """SQL expressions in ``w``, to be applied one after another; ``matches`` names the dialect's regular-expression
    test (``regexp_matches`` in DuckDB)."""
    def has(pattern: str):
        return lambda x: f"{matches}({x}, '{pattern}')"

    m0, m1, m2, vowel, cvc = map(has, (MEASURE_0, MEASURE_1, MEASURE_2, HAS_VOWEL, ENDS_CVC))
    plural = (f"case when right(w, 4) = 'sses' then {_cut(2)} when right(w, 3) = 'ies' then {_cut(2)} "
              f"when right(w, 2) = 'ss' then w when right(w, 1) = 's' then {_cut(1)} else w end")
    # A word that loses -ed or -ing is marked by a dot, which the next stage takes off.
    past = (f"case when right(w, 3) = 'eed' then case when {m0(_cut(3))} then {_cut(1)} else w end "
            f"when right(w, 2) = 'ed' then case when {vowel(_cut(2))} then concat({_cut(2)}, '.') else w end "
            f"when right(w, 3) = 'ing' then case when {vowel(_cut(3))} then concat({_cut(3)}, '.') else w end else w end")
    bare = _cut(1)
    mended = (f"case when right(w, 1) <> '.' then w "
              f"when right(w, 3) in ('at.', 'bl.', 'iz.') then concat({bare}, 'e') "
              f"when length(w) > 2 and substr(w, length(w) - 1, 1) = substr(w, length(w) - 2, 1) "
              f"and substr(w, length(w) - 1, 1) not in ('a', 'e', 'i', 'o', 'u', 'l', 's', 'z') then {_cut(2)} "
              f"when {m1(bare)} and {cvc(bare)} then concat({bare}, 'e') else {bare} end")
    final_y = f"case when right(w, 1) = 'y' and {vowel(_cut(1))} then concat({_cut(1)}, 'i') else w end"
    fourth = _suffixes(dict.fromkeys(STEP_4, ""), m2, {"ion": f"right({_cut(3)}, 1) in ('s', 't')"})
    final_e = (f"case when right(w, 1) = 'e' and ({m2(_cut(1))} or ({m1(_cut(1))} and not {cvc(_cut(1))})) "
               f"then {_cut(1)} else w end")
    final_l = f"case when right(w, 2) = 'll' and {m2(_cut(1))} then {_cut(1)} else w end"
    return [plural, past, mended, final_y, _suffixes(STEP_2, m0), _suffixes(STEP_3, m0), fourth, final_e, final_l]


def porter(words: DataFrame, word_col: str = "word", stem_col: str = "stem") -> DataFrame:
    """``words`` (lower-case letters and digits) with their stems; words of up to ``SHORT`` characters and nulls stay."""
    kept = [c for c in words.columns if c not in (stem_col, "w")]
    out = words.select(*kept, F.col(word_col).alias("w"))
    for stage in stages():
        out = out.select(*kept, F.expr(stage).alias("w"))
    return out.select(*kept, F.when(F.length(word_col) > SHORT, F.col("w")).otherwise(F.col(word_col)).alias(stem_col))
