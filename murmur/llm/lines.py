"""Repeated runs of lines, found by winnowing over line hashes, and deleted but for their first occurrence.

A run is consecutive lines of one text with at least ``min_words`` words together; lines without a word don't count. The
definition: a line goes if it lies in a run whose lines, one by one equal, occur earlier, in the order of ids and of lines
inside a text (also inside the same text, where the two may overlap). Lines without a word between two lines that go,
go with them. What occurs first stays, so no line vanishes from the corpus altogether.

How: windows are the shortest runs from each line on, and up to each line; a repeated run holds a window from its first line on, and
its windows cover it. Of each window the line with the smallest hash is selected (the last one among equals): any
repeated run holds a selected line, its guaranteed fingerprint, wherever it stands. Selected positions are brought together
by hash; a fingerprint found at one position only is dropped with its windows. Where it is found again, the match is extended
both ways: the windows around it, which are compared as a whole by the first position of their content. Overlapping
and adjoining repeated windows of a text make up the runs that are deleted. Nothing is paired: of a hash or a content, only the first
and the last position are kept, which are combined in each task before a shuffle. Two lines are equal if two 64-bit hashes are.

Defined results: a very long text is handled whole, like any other (its lines are rows of their own); a null text stays null, an empty one empty; rows with a null id come last in the order; rows that repeat an id and a text
are one document and all get its result; rows that repeat an id with other texts are ordered by a hash of the text; an
empty table gives an empty one. Other columns are carried along whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from murmur.llm.common import WORD, cut_lineage, free_name

MIN_WORDS = 50


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, i, w, a, b): lines with a word; h tells texts of one id apart, w counts words, a and b are the line's hashes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = rows.select("id", F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    rows = rows.select("id", "h", "i", F.regexp_count("line", F.lit(WORD)).alias("w"), F.xxhash64("line").alias("a"),
                       F.xxhash64(F.lit(1), "line").alias("b")).where("w > 0")
    return rows.groupBy("id", "h", "i").agg(F.first("w").alias("w"), F.first("a").alias("a"), F.first("b").alias("b"))


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(id, h, i, j, oi, oj, fp, at, ka, kb): windows from line i to line j (among lines with a word, from the oi-th to the oj-th), the selected line's hash and place, the content's hashes."""
    text = Window.partitionBy("id", "h")
    rows = lines.withColumn("end", F.sum("w").over(text.orderBy("i"))).withColumn("start", F.col("end") - F.col("w"))
    rows = rows.withColumn("o", F.row_number().over(text.orderBy("i")))
    out = []
    for frame in (text.orderBy("start").rangeBetween(0, min_words - 1), text.orderBy("end").rangeBetween(1 - min_words, 0)):
        out.append(rows.select("id", "h", F.min("i").over(frame).alias("i"), F.max("i").over(frame).alias("j"), F.min("o").over(frame).alias("oi"),
                               F.max("o").over(frame).alias("oj"), F.sum("w").over(frame).alias("n"),
                               F.min(F.struct("a", (-F.col("i")).alias("at"))).over(frame).alias("low"),
                               F.collect_list("a").over(frame).alias("la"), F.collect_list("b").over(frame).alias("lb")))
    return out[0].unionByName(out[1]).where(F.col("n") >= min_words).select(
        "id", "h", "i", "j", "oi", "oj", F.col("low.a").alias("fp"), (-F.col("low.at")).alias("at"), F.xxhash64("la").alias("ka"), F.xxhash64("lb").alias("kb"))


def place(*at: str):
    """An order of positions, null ids last."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "h", *at)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, runs): for each text that has some, the first and last lines of the runs to delete, in order, none touching another."""
    found = windows(cut_lineage(line_table(docs, id_col, text_col)), min_words)
    anchors = (found.groupBy("fp").agg(F.min(place("at")).alias("first"), F.max(place("at")).alias("last"))
               .where(F.col("first") != F.col("last")).select("fp"))
    anchors = cut_lineage(anchors)  # so that a join to it can split the windows of a hot hash
    found = cut_lineage(found.join(anchors, "fp").select("id", "h", "i", "j", "oi", "oj", "ka", "kb"))
    first = found.groupBy("ka", "kb").agg(F.min(place("i")).alias("first"), F.max(place("i")).alias("last")).where(F.col("first") != F.col("last"))
    first = cut_lineage(first)
    later = found.join(first.select("ka", "kb", "first"), ["ka", "kb"]).where(place("i") > F.col("first")).select("id", "h", "i", "j", "oi", "oj").distinct()
    text = Window.partitionBy("id", "h")
    before = F.max("oj").over(text.orderBy("oi", "oj").rowsBetween(Window.unboundedPreceding, -1))
    runs = later.withColumn("new", F.when(F.col("oi") <= before + 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(text.orderBy("oi", "oj")))
    runs = runs.groupBy("id", "h", "run").agg(F.min("i").alias("i"), F.max("j").alias("j"))
    return runs.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("i", "j"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the runs deleted from ``text_col``, and one more column, whose name is returned: a struct of n_lines, n_deleted."""
    runs = repeated_runs(docs, min_words, id_col, text_col).select(F.col("id").alias("_rid"), F.col("h").alias("_rh"), F.col("runs").alias("_runs"))
    names, info = docs.columns, free_name(docs, "line_dedup")
    text, key = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`").cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), key.alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))
    rows = rows.join(runs, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_h") == F.col("_rh")), "left")
    lines = F.split("_text", "\n", -1)
    # what stands between the runs
    starts = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["j"] + 1))
    kept = F.zip_with(starts, F.concat(F.transform("_runs", lambda r: r["i"]), F.array(F.size("_lines"))), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    rows = rows.withColumn("_lines", F.when(F.col("_runs").isNotNull(), lines))
    left = F.flatten(F.transform(kept, lambda r: F.slice(F.col("_lines"), r["x"] + 1, r["y"] - r["x"])))
    rows = rows.withColumn("_left", F.when(F.col("_runs").isNotNull(), left))
    n = F.when(F.col("_text").isNull(), 0).when(F.col("_runs").isNull(), F.size(lines)).otherwise(F.size("_lines"))
    gone = F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0))
    new = F.when(F.col("_runs").isNull(), F.col("_text")).otherwise(F.array_join("_left", "\n"))
    return rows.select(*[new.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names],
                       F.struct(n.cast("long").alias("n_lines"), gone.cast("long").alias("n_deleted")).alias(info)), info
