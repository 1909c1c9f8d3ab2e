"""Text analytics over (document, page, text) tables.

Plan shape: tokens are generated per row (no shuffle), counted with a
partial + final hash aggregate keyed on (document, word), and weighted with
group totals that are aggregated separately and joined back.  The
document-frequency of a word is a ``groupBy(word)`` aggregate, not a window
partitioned by word, so a very common word does not put all its rows in one
task: the join it feeds carries one row per (document, word) pair.
Stop-word and sentiment lists are joined without a hint: Spark broadcasts them
by their size and shuffles a longer list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions import text as tx
from framewise.functions.stemming import stem_column
from framewise.operators.keys import join_on
from framewise.operators.windows import row_number_global
from framewise.session import materialize


def unnest_pages(df: DataFrame, document: str = "document", pages: str = "pages") -> DataFrame:
    """One row per element of an array-of-pages column, numbered from 1."""
    return df.select(document, F.posexplode(pages).alias("pos", "text")).select(
        document, (F.col("pos") + 1).cast("bigint").alias("page"), "text")


def tokenize(df: DataFrame, text: str = "text", keep: Sequence[str] = ("document", "page"),
             strip_numeric: bool = False, pattern: str = tx.TOKEN_PATTERN) -> DataFrame:
    """One row per token (lower case, punctuation stripped); text column dropped."""
    out = df.select(*keep, F.explode(tx.tokens(text, pattern)).alias("word"))
    if strip_numeric:
        out = out.where(~tx.is_number("word"))
    return out


def remove_stop_words(df: DataFrame, stop_words: DataFrame, column: str = "word") -> DataFrame:
    """Anti join on a word list."""
    return df.join(stop_words.select(F.col("word").alias(column)), column, "left_anti")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def tf_idf(counts: DataFrame, term: str = "word", document: str = "document",
           n: str = "n") -> DataFrame:
    """tf = n / document total; idf = ln(#documents / #documents with term);
    tf_idf = tf * idf.  No smoothing.

    Document totals and document frequencies are aggregates joined back on
    their key (AQE broadcasts whichever side turns out small at run time).
    The counts are written once (``materialize``), so the text is tokenised once.
    """
    # the counts feed three aggregates and a join; materialise them once
    # (the written table also cuts the lineage back to the raw text)
    counts = materialize(counts, "term-counts")
    doc_tot = counts.groupBy(document).agg(F.sum(n).alias("_total"))
    df_term = counts.groupBy(term).agg(F.count(F.lit(1)).alias("_df"))
    n_docs = doc_tot.agg(F.count(F.lit(1))).scalar()
    out = join_on(join_on(counts, doc_tot, [document]), df_term, [term])
    scored = out.select(document, term, n, (F.col(n) / F.col("_total")).alias("tf"),
                        F.log(n_docs / F.col("_df")).alias("idf"))
    return scored.withColumn("tf_idf", F.col("tf") * F.col("idf"))


def ngrams(df: DataFrame, n: int, text: str = "text", keep: Sequence[str] = ("document",),
           name: str = "ngram") -> DataFrame:
    """Rows of n consecutive tokens of each text value (page); none if shorter.

    Tokens are projected to a column first so each text is tokenised once; the
    windows are joined to strings after they are rows, in generated code."""
    words = df.select(*keep, tx.tokens(text).alias("_w"))
    rows = words.select(*keep, F.explode(tx.windows("_w", n)).alias("_g"))
    return rows.select(*keep, F.concat_ws(" ", *[F.col(f"_g.w{i}") for i in range(n)]).alias(name))


def separate(df: DataFrame, column: str, into: Sequence[str], sep: str = " ") -> DataFrame:
    parts = F.split(F.col(column), sep)
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, *[parts[i].alias(c) for i, c in enumerate(into)])


def unite(df: DataFrame, name: str, columns: Sequence[str], sep: str = " ") -> DataFrame:
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.concat_ws(sep, *columns).alias(name))


def ngram_parts_without_stop_words(df: DataFrame, parts: Sequence[str],
                                   stop_words: DataFrame) -> DataFrame:
    """Drop n-grams with a stop word in any part: one anti join per part."""
    out = df
    for p in parts:
        out = out.join(stop_words.select(F.col("word").alias(p)), p, "left_anti")
    return out


def count_bigrams(df: DataFrame, stop_words: DataFrame, text: str = "text") -> DataFrame:
    """Bigram counts with no stop word in either part: (word1, word2, n)."""
    b = separate(ngrams(df, 2, text, keep=()), "ngram", ["word1", "word2"])
    b = ngram_parts_without_stop_words(b, ["word1", "word2"], stop_words)
    return count_by(b, ["word1", "word2"])


def sentiment_contribution(word_counts: DataFrame, lexicon: DataFrame,
                           min_n: int = 10) -> DataFrame:
    """Signed word contributions by document: (document, sentiment, word, n),
    n summed over the count column, kept when n >= min_n, negated for negative."""
    j = word_counts.join(lexicon, "word")
    g = j.groupBy("document", "sentiment", "word").agg(F.sum("count").alias("n"))
    g = g.where(F.col("n") >= min_n)
    return g.withColumn("n", F.when(F.col("sentiment") == "negative", -F.col("n"))
                        .otherwise(F.col("n")).cast("bigint"))


def clean_text(df: DataFrame, stop_words: Sequence[str], text: str = "text", name: str = "clean") -> DataFrame:
    """``df`` without its text but with the cleaned one: words without
    punctuation, digits and stop words, each replaced by its stem, joined by
    spaces.  Null text: null; a text without words: empty.

    The stems are worked out on the distinct words and joined back, so a word
    is stemmed once however often it occurs."""
    keep = [c for c in df.columns if c != text]
    rows = df.select(*keep, tx.cleaned_words(text, stop_words).alias("_words"),
                     F.monotonically_increasing_id().alias("_row"))
    rows = materialize(rows, "cleaned-words")  # row numbers stay as they are
    each = rows.select("_row", F.posexplode("_words").alias("_pos", "word"))
    joined = stem_column(each).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_pos", "stem"))).alias("_s"))
    clean = F.when(F.col("_words").isNull(), F.lit(None)).otherwise(
        F.coalesce(F.array_join(F.col("_s.stem"), " "), F.lit("")))
    return rows.join(joined, "_row", "left").select(*keep, clean.alias(name))


def stem_counts(words: DataFrame) -> DataFrame:
    """(stem, n): occurrences by stem, counted by word first."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stem_column(counts).groupBy("stem").agg(F.sum("n").alias("n"))


def polarity(words: DataFrame, label: str, least: int = 10, prior: float = 500.0,
             significant: float = 1.96) -> DataFrame:
    """(word, sentiment, weight): the words that tell two labelled classes
    apart.  ``words`` has a row per word of a labelled document, or per ``n``
    such words where it has that column; ``label`` is 1 (positive) or 0
    (negative); other labels are left out.

    The weight is the log odds of the word in the positive over the negative
    class, each class with ``prior`` more words that are shared out as in both
    classes together: rare words shrink towards 0.  A word is listed if it
    occurs ``least`` times and its weight is ``significant`` standard errors
    from 0; a weight of 0 is none, so no word is on both sides."""
    n = F.col("n") if "n" in words.columns else F.lit(1)
    one = words.where(F.col(label).isin(0, 1)).groupBy("word").agg(
        F.sum(n * F.col(label)).cast("double").alias("p"), F.sum(n * (1 - F.col(label))).cast("double").alias("q"))
    one = materialize(one, "class-counts")
    whole = one.agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("p"), F.coalesce(F.sum("q"), F.lit(0.0)).alias("q")).first()
    share = prior * (F.col("p") + F.col("q")) / (whole.p + whole.q or 1.0)

    def log_odds(n, total):
        return F.log((n + share) / F.nullif(F.lit(total + prior) - n - share, F.lit(0.0)))

    weight = log_odds(F.col("p"), whole.p) - log_odds(F.col("q"), whole.q)
    error = F.sqrt(1 / (F.col("p") + share) + 1 / (F.col("q") + share))
    return one.where(F.col("p") + F.col("q") >= least).select("word", weight.alias("weight"), error.alias("e")).where(
        F.abs("weight") >= significant * F.col("e")).select(
        "word", F.when(F.col("weight") > 0, "positive").otherwise("negative").alias("sentiment"), "weight")


def doc_term_matrix(word_counts: DataFrame, document: str = "document", term: str = "word",
                    count: str = "count") -> DataFrame:
    """Sparse document-term matrix as triples (document, term_id, term, n).

    ``term_id`` numbers the terms from 1 in alphabetical order, by a range
    sort of the distinct terms; nothing is collected per document."""
    counts = word_counts.where(F.col(term).isNotNull())
    ids = row_number_global(counts.select(F.col(term).alias("term")).distinct(), ["term"], name="term_id")
    return counts.join(ids, counts[term] == ids.term).select(
        document, "term_id", "term", F.col(count).cast("bigint").alias("n"))


def top_words(tokens: DataFrame, min_freq: int, max_words: int) -> DataFrame:
    """The ``max_words`` most frequent words with frequency >= min_freq
    (ties broken by word); the limit is the feature (a word-cloud list)."""
    c = count_by(tokens, ["word"]).where(F.col("n") >= min_freq)
    return c.orderBy(F.col("n").desc(), F.col("word")).limit(max_words)


def reorder_within(df: DataFrame, x: str, by: str, within: str, name: str,
                   sep: str = tx.WITHIN_SEPARATOR, fun=F.avg) -> DataFrame:
    """Label unique within a group plus its order key: ``fun`` (an aggregate,
    the mean by default) of ``by`` over the label's rows."""
    labelled = df.withColumn(name, tx.label_within(x, within, sep))
    keys = labelled.groupBy(name).agg(fun(by).alias(f"{name}_key"))
    return join_on(labelled, keys, [name])


__all__ = ["unnest_pages", "tokenize", "remove_stop_words", "count_by", "tf_idf",
           "ngrams", "separate", "unite", "ngram_parts_without_stop_words",
           "count_bigrams", "sentiment_contribution", "doc_term_matrix",
           "clean_text", "stem_counts", "polarity",
           "top_words", "reorder_within"]
