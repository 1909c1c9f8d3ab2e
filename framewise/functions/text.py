"""Column expressions for text: tokens, n-grams, cleaning.

All of these are built-in Spark SQL expressions (regexp, higher-order array
functions), so they run inside whole-stage codegen with no Python worker.
Rules fixed here so that the SQL oracle can say the same thing:

* a token is a maximal run of letters and digits of any script, after
  lower-casing;
* n-grams are formed from consecutive tokens of one text value (one page);
  a text with fewer than n tokens yields none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = "[\\p{L}\\p{N}]+"
NUMBER_PATTERN = "^[0-9]+$"
SPECIAL_CHAR_PATTERN = "[/@|]"
# Fixed value: the separator of labels made unique within a group.
WITHIN_SEPARATOR = "___"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-case, then every maximal match of ``pattern`` as an array."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(pattern), 0)


def windows(words, n: int) -> Column:
    """Windows of n consecutive elements of an array column, as structs (w0, w1, ...).

    Built as ``arrays_zip`` of n shifted slices, so the input array is read a
    fixed number of times (linear in its length); pass a column, not an
    expression, so the array is computed once.
    """
    w = col_(words)
    k = F.greatest(F.size(w) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(w, i + 1, k).alias(f"w{i}") for i in range(n)])


def ngrams(words, n: int) -> Column:
    """Space-joined windows of n consecutive elements of an array column."""
    return F.transform(windows(words, n), lambda s: F.concat_ws(" ", *[s[f"w{i}"] for i in range(n)]))


def is_number(word) -> Column:
    """Digits only; the pattern is tried on words whose first character is one."""
    w = col_(word)
    return (w >= "0") & (w < ":") & w.rlike(NUMBER_PATTERN)


def cleaned_words(text, stop_words) -> Column:
    """The cleaning chain up to the stems, in order: punctuation, special
    characters, digits, lower case, stop words; an array of words.

    ``stop_words`` is a Python sequence (a bounded word list); membership is
    an IN list, which the optimizer turns into a hash-set lookup (no join).
    """
    t = F.regexp_replace(col_(text), "\\p{Punct}", "")
    t = F.regexp_replace(t, SPECIAL_CHAR_PATTERN, " ")
    t = F.regexp_replace(t, "\\d", "")
    t = F.lower(t)
    stops = list(stop_words)
    words = F.split(t, "\\s+")
    return F.filter(words, lambda w: (w != "") & ~w.isin(stops))  # IN list -> hash set


def strip_within_suffix(label, sep: str = WITHIN_SEPARATOR) -> Column:
    """Undo ``reorder_within`` labels: drop the separator and what follows."""
    return F.regexp_replace(col_(label), f"{sep}.+$", "")


def label_within(x, within, sep: str = WITHIN_SEPARATOR) -> Column:
    return F.concat_ws(sep, col_(x).cast("string"), col_(within).cast("string"))
