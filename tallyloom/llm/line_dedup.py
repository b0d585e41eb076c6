"""Line dedup over overlapping windows of three lines.

Every run of three consecutive lines of a text is hashed (MD5 of the three, joined by line feeds).
A window whose hash stands at more than one place of the corpus is kept where it stands first (by
document id, then content, then line) and removed everywhere else: the lines that its later
occurrences cover are merged and dropped.  Each step from a removed line to the same line of the
first occurrence leads to an earlier place, so every line's content is kept somewhere.

Windows of three lines leave passages of one or two lines.  With ``passages`` every line and every two
lines of more words than that are windows too, and so are all lines of a text of one or two.

Only (place, 16-byte hash) rows are shuffled to find repeats; a hash with very many places is
reduced map-side to its first and last place, and the places come back by a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN

WINDOW = 3
#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\\x20\\x09-\\x0D]+"


def window_starts(passages: int | None) -> str:
    """SQL: (pos, n) of the windows of the lines ``l``, whose numbers of words are ``c`` where ``passages`` is given."""
    three = f"if(size(l) < {WINDOW}, array(), transform(sequence(0, size(l) - {WINDOW}), i -> named_struct('pos', i, 'n', {WINDOW})))"
    if passages is None:
        return three
    one = f"filter(transform(c, (x, i) -> named_struct('pos', i, 'n', 1)), y -> size(l) = 1 or c[y.pos] > {passages})"
    two = f"filter(transform(c, (x, i) -> named_struct('pos', i, 'n', 2)), y -> y.pos + 1 < size(l) and (size(l) = 2 or c[y.pos] + c[y.pos + 1] > {passages}))"
    return f"concat({three}, {one}, {two})"


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", passages: int | None = None) -> DataFrame:
    """(id, hash, lines): the sorted, distinct 0-based line numbers to remove, for texts that lose any.

    Windows of blank lines alone take no part.  Rows that repeat an id with an equal text are one
    document and share its outcome; an id with two different texts is two documents.  Null or empty
    texts have no window and lose nothing, nor do texts under three lines without ``passages``.
    """
    lines = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.split(F.col(f"`{text}`"), "\n").alias("l")).where(F.size("l") >= (WINDOW if passages is None else 1))
    if passages is not None:
        lines = lines.withColumn("c", F.expr(f"transform(l, x -> regexp_count(x, '{WORD}'))"))
    windows = lines.select("id", "h", F.explode(F.expr(
        f"transform({window_starts(passages)}, y -> named_struct('pos', y.pos, 'n', y.n, 'w', unhex(md5(array_join(slice(l, y.pos + 1, y.n), '\\n'))), 'blank', forall(slice(l, y.pos + 1, y.n), x -> trim(x) = '')))"
    )).alias("x")).where("not x.blank").select("id", "h", "x.pos", "x.n", "x.w")
    place = F.struct("id", "h", "pos")
    first = windows.groupBy("w").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("w", "first")
    later = windows.join(first, "w").where(~F.struct("id", "h", "pos").eqNullSafe(F.col("first")))
    spans = later.groupBy("id", "h").agg(F.collect_set(F.struct("pos", "n")).alias("starts"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p["pos"], p["pos"] + p["n"] - 1)))))
    return spans.select("id", "h", covered.alias("lines"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", removed: str | None = None, passages: int | None = None) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from their texts: of three lines, and with ``passages`` shorter ones.

    All rows and columns stay; ``removed`` names a column to add, or to replace, that holds the numbers
    of the lines cut (an empty array for an untouched text).  A text that loses all lines becomes
    empty; a null text stays null.  Repeated rows share their outcome; null ids are one id, the first.
    A text of any length is cut in one pass over its lines and the spans to cut.  An empty table
    gives no rows.
    """
    cut = repeated_lines(docs, id_col=id_col, text=text, passages=passages).select(F.col("id").alias(f"{OWN}id"), F.col("h").alias(f"{OWN}h"), F.col("lines").alias(f"{OWN}lines"))
    joined = docs.join(cut, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{OWN}id")) & F.xxhash64(F.col(f"`{text}`")).eqNullSafe(F.col(f"{OWN}h")), "left")
    # the lines between two cut ones are a slice each, so the work is that of the lines, however many are cut
    kept = F.expr(f"array_join(flatten(zip_with(array_insert({OWN}lines, 1, -1), array_append({OWN}lines, size({OWN}l)), (a, b) -> slice({OWN}l, a + 2, b - a - 1))), '\\n')")
    joined = joined.withColumn(f"{OWN}l", F.when(F.col(f"{OWN}lines").isNotNull(), F.split(F.col(f"`{text}`"), "\n")))
    new = F.when(F.col(f"{OWN}lines").isNull(), F.col(f"`{text}`")).otherwise(kept)
    columns = [new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != removed]
    return joined.select(*columns, *([F.coalesce(f"{OWN}lines", F.array().cast("array<int>")).alias(removed)] if removed else []))
