"""Line dedup with levelled sorted runs.

Batches of documents arrive one after another.  ``LineRuns.add`` turns a batch
into a *run*: one row (key hash, number of the batch's documents that hold the
line), sorted by the hash and written to the shared folder.  Runs stand on
levels; when a level holds ``fanout`` runs they are compacted into one run of
the next level (counts of equal keys are summed), so n batches leave
O(fanout * log n) runs.  ``frequent`` merges the runs to the keys found in at
least ``min_docs`` documents, and ``drop_lines`` anti-joins a batch's lines
with them.

A key is the line without white space at both ends, A-Z in lower case, hashed
to 128 bits.  Counting takes each key once per document and pre-aggregates
before its shuffle, so a line that every document holds is one row per task.
Only positions of dropped lines are collected per document, never lines of
many documents in one place.

Defined results.  Null or empty text: one empty line, never dropped.  Null or
repeated ids: every row is a document of its own.  Empty table: empty result.
Other columns of the input pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm.common import (SPACE_CHARS, drop_scratch, fresh, lower_ascii,
                                  maybe_broadcast, write_scratch)

#: Rows of 16 bytes up to which the frequent keys are broadcast (64 MB); more are joined by shuffle.
BROADCAST_ROWS = 4_000_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE_CHARS)))


def _hashed(keys: DataFrame, *others: str) -> DataFrame:
    """``others`` and the 128 bits of column ``key`` as ``a`` and ``b``; empty
    keys are left out."""
    return (keys.where(F.col("key") != "")
            .select(*others, F.xxhash64("key").alias("a"),
                    F.xxhash64(F.lit(1), "key").alias("b")))


class LineRuns:
    """Runs of (a, b, n): key hash and number of documents, by level."""

    def __init__(self, spark: SparkSession, fanout: int = 4) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, batch: DataFrame, text: str = "text") -> None:
        """The batch's run joins level 0; full levels are compacted."""
        keys = F.array_distinct(F.transform(lines_of(F.col(text)), line_key))
        rows = _hashed(batch.select(F.explode(keys).alias("key")))
        self._put(0, self._merged(rows.withColumn("n", F.lit(1))))

    def _merged(self, rows: DataFrame) -> DataFrame:
        run = rows.groupBy("a", "b").agg(F.sum("n").cast("long").alias("n"))
        return write_scratch(run.sortWithinPartitions("a", "b"), "line-run")

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(_union(full)))
            for old in full:
                drop_scratch(old)

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys held by at least ``min_docs`` documents over all runs."""
        runs = [r for level in self.levels for r in level]
        if len(runs) == 1:
            return runs[0].where(F.col("n") >= min_docs).select("a", "b")
        return (_union(runs).groupBy("a", "b").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= min_docs).select("a", "b"))

    def clear(self) -> None:
        for level in self.levels:
            for run in level:
                drop_scratch(run)
        self.levels = [[]]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def drop_lines(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``: the lines
    whose key is in ``frequent`` are gone, the others joined by a line feed.

    Matching lines travel as (document, position); a document is named by its
    id and its text's hash, so rows that share an id stay apart unless they
    are equal, and equal rows lose the same lines."""
    doc, tag, gone = fresh("doc"), fresh("tag"), fresh("gone")
    named = (docs.withColumn(doc, F.xxhash64(F.col(id_col)))
             .withColumn(tag, F.xxhash64(F.lit(7), F.coalesce(F.col(text), F.lit("")))))
    at = named.select(F.col(doc).alias("d"), F.col(tag).alias("t"),
                      F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    at = _hashed(at.withColumn("key", line_key(F.col("line"))), "d", "t", "pos")
    hits = (at.join(frequent, ["a", "b"], "left_semi")
            .groupBy("d", "t").agg(F.collect_set("pos").alias(gone))
            .withColumnsRenamed({"d": doc, "t": tag}))
    lines = lines_of(F.col(text))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    # the one-element array keeps the split out of the inner lambda
    joined = F.transform(
        F.array(F.struct(lines.alias("l"), left.alias("at"))),
        lambda x: F.array_join(F.transform(x["at"], lambda i: F.get(x["l"], i)), "\n"))[0]
    return (named.join(hits, [doc, tag], "left").withColumns({
        "kept_text": F.when(F.col(gone).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(joined),
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("long")})
        .drop(doc, tag, gone))


def dedup_lines(docs: DataFrame, min_docs: int = 10, batches: int = 3, fanout: int = 3,
                id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Drop every line found in at least ``min_docs`` documents of ``docs``.

    The table is dealt into ``batches`` by the hash of the id; every batch
    adds its run, then the merged runs are anti-joined with all of them."""
    spark = docs.sparkSession
    runs = LineRuns(spark, fanout)
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches))
    for i in range(batches):
        runs.add(docs.where(part == i), text)
    frequent = write_scratch(runs.frequent(min_docs), "line-frequent")
    runs.clear()
    return drop_lines(docs, maybe_broadcast(frequent, BROADCAST_ROWS), id_col, text)
