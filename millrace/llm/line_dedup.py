"""Line dedup by overlapping windows of three lines, in DataFrame functions only.

Lines are hashed without the white space around them, and the hashes of each three
consecutive lines that are not blank make a window. A window that lies in several places
of the corpus keeps its first place, by document id and position; at all later places its
lines are covered. Covered places are merged by document and their lines removed. Line
breaks between kept lines stay as they were; blank lines are kept unless the lines on
both sides of them go.

Defined results: null text stays null and has no lines; a text of fewer than three
lines with words has no window; documents without an id come after all others; rows
with the same id and text are one document and keep or lose the same lines, and texts
with the same id are ordered by their hash; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACES, fresh, or_empty
from millrace.sources import files

WINDOW = 3


def _row_key(doc_id: Column, text: Column) -> Column:
    """Orders and names documents: by id, null last, then by text."""
    return F.struct(
        doc_id.isNull().alias("no_id"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"), F.md5(text).alias("text")
    )


def _lines(body: Column) -> Column:
    return F.split(body, "\n", -1)


def _solid(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, first_line, last_line, hash``: each window, by the places of its lines."""
    numbered = F.transform(
        _lines(F.col("body")),
        lambda line, n: F.struct(
            n.alias("n"), F.regexp_replace(line, rf"^{SPACES}+|{SPACES}+$", "").alias("line")
        ),
    )
    hashed = F.transform(
        F.filter(numbered, lambda x: x["line"] != ""),
        lambda x: F.struct(x["n"].alias("n"), F.md5(x["line"]).alias("hash")),
    )
    made = F.when(
        F.size("hashed") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("hashed") - WINDOW),
            lambda i: F.struct(
                F.get("hashed", i)["n"].alias("first_line"),
                F.get("hashed", i + (WINDOW - 1))["n"].alias("last_line"),
                F.unhex(F.md5(F.concat(*(F.get("hashed", i + k)["hash"] for k in range(WINDOW))))).alias("hash"),
            ),
        ),
    )
    return (
        docs.select(F.col(doc_id).alias("doc_id"), or_empty(F.col(text)).alias("body"))
        .select(_row_key(F.col("doc_id"), F.col("body")).alias("row"), hashed.alias("hashed"))
        .select("row", F.explode(made).alias("w"))
        .select("row", "w.first_line", "w.last_line", "w.hash")
    )


def covered(found: DataFrame) -> DataFrame:
    """``row, lines``: the places in each document that repeated windows cover, in order.

    ``found`` is read twice, so it should be a written table.
    """
    place = F.struct("row", "first_line")
    first = (
        found.groupBy("hash")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("hash", "first")
    )
    later = found.join(first, "hash").where(place > F.col("first"))
    places = F.flatten(F.collect_set(F.sequence("first_line", "last_line")))
    return later.groupBy("row").agg(F.array_sort(F.array_distinct(places)).alias("lines"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with later repeats taken out of the text, and two more columns.

    ``n_lines`` and ``n_removed`` count lines with words; if ``docs`` has such columns
    the new ones get an underscore.
    """
    later = covered(files.materialize(windows(docs, doc_id, text), "line-windows"))
    key, row, gone, kept, n_lines, n_removed = fresh(docs, "key", "row", "gone", "kept", "n_lines", "n_removed")
    body = or_empty(F.col(text))
    marked = docs.withColumn(key, _row_key(F.col(doc_id), body)).join(
        later.select(F.col("row").alias(row), F.col("lines").alias(gone)), F.col(key) == F.col(row), "left"
    )
    # Merged: where covered stretches begin and end. What lies between them stays.
    begins = F.filter(gone, lambda x, i: (i == 0) | (x - F.get(F.col(gone), i - 1) > 1))
    ends = F.filter(
        gone, lambda x, i: (i == F.size(F.col(gone)) - 1) | (F.get(F.col(gone), i + 1) - x > 1)
    )
    lines, begins_at, ends_at = fresh(marked, "lines", "begins", "ends")
    split = marked.withColumns({lines: _lines(body), begins_at: begins, ends_at: ends})
    all_lines = F.col(lines)

    def between(i: Column) -> Column:
        start = F.coalesce(F.get(F.col(ends_at), i - 1) + 1, F.lit(0))
        stop = F.coalesce(F.get(F.col(begins_at), i), F.size(all_lines))
        return F.slice(all_lines, start + 1, stop - start)

    pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.size(F.col(begins_at))), between))
    cut = split.withColumn(kept, F.when(F.col(gone).isNull(), all_lines).otherwise(pieces))
    before = F.size(F.filter(all_lines, _solid))
    after = F.size(F.filter(F.col(kept), _solid))
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return cut.select(
        *(cleaned.alias(c) if c == text else F.col(c) for c in docs.columns),
        before.cast("long").alias(n_lines),
        F.when(F.col(gone).isNull(), F.lit(0)).otherwise(before - after).cast("long").alias(n_removed),
    )
