"""English stems by a cascade of suffix rules, as Spark expressions.

``stems_of`` takes a table of distinct words and runs the cascade once per
word; texts get their stems by a join on the word (``stem_column``).  Every
step is a projection over the column ``stem`` and the two positions behind
which suffixes may go (``p1``, ``p2``), so the whole cascade is one stage of
generated code.

Words of one or two characters stay as they are, so do all characters beyond
a-z (they count as consonants).  Null stays null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the published English stemmer.  A letter y that
# acts as a consonant is written Y while the cascade runs.
VOWEL = "[aeiouy]"
CONSONANT = "[^aeiouy]"
REGION_STARTS = ("gener", "commun", "arsen")
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
STAY_AFTER_PLURALS = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
SHORT_SYLLABLE = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
DERIVATIONS = (
    ("ational", "ate"), ("fulness", "ful"), ("iveness", "ive"), ("ization", "ize"), ("ousness", "ous"),
    ("biliti", "ble"), ("lessli", "less"), ("tional", "tion"), ("alism", "al"), ("aliti", "al"),
    ("ation", "ate"), ("entli", "ent"), ("fulli", "ful"), ("iviti", "ive"), ("ousli", "ous"),
    ("abli", "able"), ("alli", "al"), ("anci", "ance"), ("ator", "ate"), ("enci", "ence"),
    ("izer", "ize"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
BEFORE_OGI, BEFORE_LI = "l", "cdeghkmnrt"
ADJECTIVES = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("ative", ""), ("icate", "ic"),
    ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
ENDINGS = (
    "ement", "able", "ance", "ence", "ible", "ment", "ant", "ate", "ent", "ion", "ism", "iti", "ive",
    "ize", "ous", "al", "er", "ic",
)
BEFORE_ION = "st"


def _cut(w: Column, n: int) -> Column:
    return F.substring(w, F.lit(1), F.length(w) - n)


def _first_suffix(rules: Sequence[tuple[str, Column]]) -> Column:
    """The result of the first rule whose suffix the word has."""
    w = F.col("stem")
    out = None
    for suffix, result in rules:
        test = w.endswith(suffix)
        out = F.when(test, result) if out is None else out.when(test, result)
    return out.otherwise(w)


def _behind(suffix: str, start: str) -> Column:
    return F.length("stem") - len(suffix) >= F.col(start)


def _swap(suffix: str, to: str, allowed: Column) -> tuple[str, Column]:
    return suffix, F.when(allowed, F.concat(_cut(F.col("stem"), len(suffix)), F.lit(to))).otherwise(F.col("stem"))


def stems_of(words: DataFrame, column: str = "word") -> DataFrame:
    """(column, stem): the stem of every row of a table of distinct words."""
    w = F.col("stem")
    step = words.select(column, F.col(column).alias("stem"))
    for pattern, to in (("^'", ""), ("('s'|'s|')$", ""), ("^y", "Y"), (f"({VOWEL})y", "$1Y")):
        step = step.withColumn("stem", F.regexp_replace("stem", pattern, to))
    region = f"^.*?{VOWEL}{CONSONANT}"
    first = F.regexp_extract(w, f"^({'|'.join(REGION_STARTS)})|{region}", 0)
    step = step.withColumn("p1", F.when(first == "", F.length(w)).otherwise(F.length(first)))
    second = F.regexp_extract(F.substring(w, F.col("p1") + 1, F.length(w)), region, 0)
    step = step.withColumn("p2", F.when(second == "", F.length(w)).otherwise(F.col("p1") + F.length(second)))
    # plurals
    step = step.withColumn("stem", _first_suffix([
        ("sses", _cut(w, 2)),
        *[(s, F.concat(_cut(w, 3), F.when(F.length(w) > 4, F.lit("i")).otherwise("ie"))) for s in ("ied", "ies")],
        ("us", w), ("ss", w), ("s", F.when(w.rlike(f"{VOWEL}.+s$"), _cut(w, 1)).otherwise(w))]))
    step = step.withColumn("done", w.isin(*STAY_AFTER_PLURALS))
    # past tense and -ing
    stripped = F.when(F.col("done"), F.lit(None))
    for s in ("ingly", "eedly", "edly", "eed", "ing", "ed"):
        stripped = stripped.when(w.endswith(s), F.lit(None) if s.startswith("eed") else F.when(
            F.substring(w, F.lit(1), F.length(w) - len(s)).rlike(VOWEL), _cut(w, len(s))))
    step = step.withColumn("cut", stripped)
    c = F.col("cut")
    mended = (F.when(c.rlike("(at|bl|iz)$"), F.concat(c, F.lit("e")))
              .when(c.rlike(f"({'|'.join(DOUBLES)})$"), _cut(c, 1))
              .when((F.length(c) <= F.col("p1")) & c.rlike(SHORT_SYLLABLE), F.concat(c, F.lit("e"))).otherwise(c))
    eed = [_swap(s, "ee", _behind(s, "p1")) for s in ("eedly", "eed")]
    step = step.withColumn("stem", F.when(F.col("done"), w).when(c.isNotNull(), mended).otherwise(_first_suffix(eed)))
    # final y
    step = step.withColumn("stem", F.when(~F.col("done") & w.rlike(f"^.+{CONSONANT}[yY]$"),
                                          F.concat(_cut(w, 1), F.lit("i"))).otherwise(w))
    rules = []
    for s, to in DERIVATIONS:
        allowed = _behind(s, "p1")
        if s == "ogi":
            allowed = allowed & w.rlike(f"[{BEFORE_OGI}]ogi$")
        elif s == "li":
            allowed = allowed & w.rlike(f"[{BEFORE_LI}]li$")
        rules.append(_swap(s, to, allowed & ~F.col("done")))
    step = step.withColumn("stem", _first_suffix(rules))
    step = step.withColumn("stem", _first_suffix([
        _swap(s, to, _behind(s, "p2" if s == "ative" else "p1") & ~F.col("done")) for s, to in ADJECTIVES]))
    step = step.withColumn("stem", _first_suffix([
        _swap(s, "", _behind(s, "p2") & ~F.col("done") & (w.rlike(f"[{BEFORE_ION}]ion$") if s == "ion" else F.lit(True)))
        for s in ENDINGS]))
    # final e and l
    short = _cut(w, 1).rlike(SHORT_SYLLABLE)
    e = (_behind("e", "p2") | (_behind("e", "p1") & ~short)) & ~F.col("done")
    step = step.withColumn("stem", _first_suffix([
        _swap("e", "", e), _swap("l", "", _behind("l", "p2") & w.endswith("ll") & ~F.col("done"))]))
    given = F.col(column)
    chain = F.when(F.length(given) <= 2, given)
    for word, to in SPECIAL.items():
        chain = chain.when(given == word, F.lit(to))
    return step.select(column, chain.otherwise(F.translate("stem", "Y", "y")).alias("stem"))


def stem_column(rows: DataFrame, column: str = "word") -> DataFrame:
    """``rows`` with ``stem``: the cascade runs on the distinct words, the
    stems are joined back.  Rows whose word is null have a null stem."""
    stems = stems_of(rows.select(column).where(F.col(column).isNotNull()).distinct(), column)
    return rows.join(stems, column, "left")


__all__ = ["stems_of", "stem_column"]
