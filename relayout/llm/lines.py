"""Operator 1, line dedup by winnowing [native].

The lines of a document (blank ones aside) are hashed. Of every window of ``WINDOW`` consecutive lines the one with
the least hash (of equal ones the last) is selected: its hash is the window's fingerprint. Documents that share
``WINDOW`` lines in a row select the same line of them, which is winnowing's guarantee, and a line that is the least of several
windows is one position. A line of ``LONG`` words or more is a window by itself, and selected.

1. The selected positions are staged as a narrow table: the fingerprint, and for each window that selected it where the window
   begins and ends and the hashes of its lines before and after the position. There are fewer of them than windows, and no text.
2. Fingerprints found at two positions or more are joined back to the positions; most end here.
3. What is left is extended both ways to the ends of its windows: a window is repeated if its fingerprint and both
   hashes (192 bits) come at an earlier place, the first one by document id and line. A longer match is extended
   through the next windows, which overlap: together the windows that repeat make up the maximal run, since each of its windows
   selects a position of the run.
4. The later runs are cut out of the texts.

A result line is cut if and only if it lies in a run of ``WINDOW`` lines, or is a line of ``LONG`` words,
that the corpus holds earlier. Counting is combined in every task before a shuffle; hot fingerprints and
runs are joined by broadcast (there are at most a thousand of them, see ``common.lookup``), never as one
task's work. No two positions are ever paired with each other: each meets the first place of its kind.

Defined results: null and empty texts stay; a text whose lines are all cut becomes empty; blank lines
are cut only inside a cut run. Documents are ordered by id (null first), then by a hash of the text; rows
that agree in id and text are one document: both stay or lose the same lines. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, stage

WINDOW, LONG = 2, 50


def _place() -> Column:
    return F.struct("id", "th", "at")


def _blanks(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def positions(documents: DataFrame, *, id_col="doc_id", text_col="text", window=WINDOW, long=LONG) -> DataFrame:
    """``id, th, at, fp, spans`` per selected position: the document, the line, its hash, and the windows that selected it
    (``at`` and ``until``, their first and last line, ``left`` and ``right``, hashes of their lines around the position)."""
    lines = F.transform(
        F.split(F.col(text_col), "\n", -1),
        lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), (_blanks(x) >= long - 1).alias("long"),
                              x.rlike("[^ \t\r]").alias("some")))
    # generators pin the arrays: later expressions read them instead of working them out again
    one = (documents.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                            F.explode(F.array(F.filter(lines, lambda x: x["some"]))).alias("l"))
           .select("id", "th", "l", F.explode(F.array(F.transform("l", lambda x: x["h"]))).alias("h")))
    last = F.size("h") - window
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    least = F.transform(starts, lambda s: s - F.array_min(F.transform(
        F.slice("h", s + 1, F.lit(window)), lambda x, j: F.struct(x.alias("h"), (-j).alias("back"))))["back"])
    won = one.select("id", "th", "l", "h", F.explode(F.array(least)).alias("least"))
    none = F.xxhash64(F.array().cast("array<bigint>"))

    def spans(x: Column, p: Column) -> Column:
        # the windows a line lies in, and of them those that it is the least of
        first, upto = F.greatest(p - (window - 1), F.lit(0)), F.least(p, last)
        around = F.when(upto >= first, F.sequence(first, F.greatest(first, upto))).otherwise(F.array().cast("array<int>"))
        wins = F.transform(F.filter(around, lambda s: F.get("least", s) == p), lambda s: F.struct(
            F.get("l", s)["i"].alias("at"), F.get("l", s + (window - 1))["i"].alias("until"),
            F.xxhash64(F.slice("h", s + 1, p - s)).alias("left"), F.xxhash64(F.slice("h", p + 2, s + (window - 1) - p)).alias("right")))
        alone = F.array(F.struct(x["i"].alias("at"), x["i"].alias("until"), none.alias("left"), none.alias("right")))
        return F.when(x["long"], F.concat(wins, alone)).otherwise(wins)

    found = F.transform("l", lambda x, p: F.struct(x["i"].alias("at"), x["h"].alias("fp"), spans(x, p).alias("spans")))
    return (won.select("id", "th", F.explode(found).alias("p")).where(F.size("p.spans") > 0)
            .select("id", "th", "p.at", "p.fp", "p.spans"))


def repeated_runs(found: DataFrame) -> DataFrame:
    """``id, th, at, until`` of the windows whose lines come earlier too. Reads ``found`` twice: stage it."""
    fingerprints = (found.groupBy("fp").agg(F.min(_place()).alias("a"), F.max(_place()).alias("b"), F.count(F.lit(1)).alias("n"))
                    .where(F.col("a") != F.col("b")).select("fp", "n"))
    matched = stage(lookup(found, fingerprints, ["fp"], "n", "inner").select("id", "th", "fp", F.explode("spans").alias("s"))
                    .select("id", "th", "fp", "s.at", "s.until", "s.left", "s.right"), "positions")
    run = ["fp", "left", "right"]
    first = (matched.groupBy(*run).agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    return (lookup(matched, first, run, "n", "inner").where(_place() > F.col("first"))
            .select("id", "th", "at", "until"))


def dedup_lines(documents: DataFrame, *, id_col="doc_id", text_col="text", window=WINDOW, long=LONG) -> DataFrame:
    """``row`` (a struct of all columns of a document), ``new_text``, ``n_lines``, ``n_deleted``."""
    found = stage(positions(documents, id_col=id_col, text_col=text_col, window=window, long=long), "line_positions")
    cut = (repeated_runs(found).groupBy(F.col("id").alias("cut_id"), F.col("th").alias("cut_th"))
           .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", "until")))).alias("cut")))
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    joined = packed.join(cut, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("th") == F.col("cut_th")), "left")
    split = joined.select("row", "text", "cut", F.explode_outer(F.array(F.split("text", "\n", -1))).alias("lines"))
    n = F.coalesce(F.size("lines"), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("cut"))
    new = F.when(F.col("cut").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return split.select("row", new.alias("new_text"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_deleted"))


def unpacked(deduped: DataFrame, *, text_col="text", length_col: str | None = "n_chars") -> DataFrame:
    """The columns of the documents with the new text (and its length, if there is such a column),
    without documents that lost all their lines."""
    names = deduped.schema["row"].dataType.fieldNames()
    kept = deduped.where((F.col("n_deleted") == 0) | F.col("new_text").rlike("[^ \t\r\n]"))
    kinds = {f.name: f.dataType for f in deduped.schema["row"].dataType}

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("new_text").alias(name)
        old = F.col("row")[name]
        if name == length_col:
            old = F.when(F.col("n_deleted") > 0, F.length("new_text").cast(kinds[name])).otherwise(old)
        return old.alias(name)

    return kept.select(*[column(n) for n in names])


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's text without later repeated runs of lines."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("new_text").alias("text"), "n_lines", "n_deleted")


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT *, lead(line) OVER w AS next_line, lead(i) OVER w AS next_i
  FROM lines WHERE regexp_matches(line, '[^ \t\r]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
pairs AS (
  SELECT doc_id, i, next_i, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, i) AS n
  FROM filled WHERE next_i IS NOT NULL),
longs AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS n
  FROM filled WHERE length(line) - length(replace(line, ' ', '')) >= 49),
cut AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, next_i)) AS i FROM pairs WHERE n > 1
  UNION SELECT doc_id, i FROM longs WHERE n > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.i) AS n_deleted,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL) AS text
  FROM lines l LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
