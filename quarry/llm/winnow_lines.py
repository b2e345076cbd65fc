"""Repeated passages by winnowing over line hashes (operator 5, DataFrame only).

A window starts at a line and takes lines until it holds ``min_words``
words. Its fingerprint is the smallest line hash inside it, so two equal
passages of that many words always share a fingerprint. Fingerprints whose
line stands at one place only are dropped by a join; around the others the windows are
compared whole, which extends a match both ways to its full run, and every
line of a window that occurred earlier is deleted.

A run of equal lines may go on behind its last window by lines that hold fewer
than ``min_words`` words. ``whole_runs`` adds the windows that end at a line and
take lines backwards. In a run of ``min_words`` words each line lies in a window
of one of the two kinds that is inside the run, so their union is all such runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, Scratch, text_of, with_row_id

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _repeated(win: DataFrame) -> DataFrame:
    """Fingerprints whose line is the smallest of a window at two places or more."""
    place = F.struct("rid", "at")
    return win.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("z")).filter("a <> z").select("fp")


def winnow(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS,
           whole_runs: bool = False) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, spans, clean_text.

    Lines are compared without surrounding blanks; blank lines take no part
    and always stay. Order is by id (null last), then, for repeated ids, by
    row, then by line. A window equal to an earlier one is deleted unless the
    two overlap in one document. Every deleted line therefore still stands
    earlier. Null text is empty with one blank line, and stays as empty text; no text
    is cut. ``spans`` lists the deleted line numbers as [first, last], from 0.
    With ``whole_runs`` every line is deleted that lies in a run of ``min_words``
    words or more that stands earlier, also the end of a run behind its last window.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "winnow")
    base = scratch.keep(with_row_id(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))), "base")

    lines = base.select("rid", "id", F.posexplode(_lines(F.col("t"))).alias("line", "s"))
    lines = lines.select("rid", "id", "line", F.trim(F.col("s"), F.lit(" \t\n\x0b\x0c\r")).alias("s")).filter("s <> ''")
    lines = lines.select("rid", "id", "line", F.regexp_count("s", F.lit(WORD)).cast("bigint").alias("w"),
                         F.xxhash64(F.lit(1), "s").alias("h1"), F.xxhash64(F.lit(2), "s").alias("h2"))
    by_doc = Window.partitionBy("rid")
    run = by_doc.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"c": F.coalesce(F.sum("w").over(run), F.lit(0).cast("bigint")), "all": F.sum("w").over(by_doc)})
    # every line has a word, so c rises strictly: the lines of the window that starts here have c in [c, c + min_words)
    ahead = by_doc.orderBy("c").rangeBetween(Window.currentRow, min_words - 1)
    low = F.min(F.struct("h1", "line"))  # the fingerprint and its place, the first of equal lines
    win = lines.withColumns({"fp": low.over(ahead), "end": F.max("line").over(ahead),
                             "l1": F.collect_list("h1").over(ahead), "l2": F.collect_list("h2").over(ahead)})
    if whole_runs:  # the same from the end: those of the window that ends here have their own end in (to - min_words, to]
        back = by_doc.orderBy("to").rangeBetween(1 - min_words, Window.currentRow)
        win = win.withColumn("to", F.col("c") + F.col("w")).withColumns({
            "b_line": F.min("line").over(back), "b_c": F.min("c").over(back), "b_fp": low.over(back),
            "b1": F.collect_list("h1").over(back), "b2": F.collect_list("h2").over(back)})
        # a window that does not reach min_words without this line starts a window of the first kind, which is the same
        forward = F.when(F.col("all") - F.col("c") >= min_words, F.struct("line", "end", "fp", F.xxhash64("l1").alias("k1"), F.xxhash64("l2").alias("k2")))
        backward = F.when(F.col("c") - F.col("b_c") >= min_words, F.struct(
            F.col("b_line").alias("line"), F.col("line").alias("end"), F.col("b_fp").alias("fp"), F.xxhash64("b1").alias("k1"), F.xxhash64("b2").alias("k2")))
        win = win.select("rid", "id", F.explode(F.array_compact(F.array(forward, backward))).alias("x")).select("rid", "id", "x.*")
    else:
        win = win.filter(F.col("all") - F.col("c") >= min_words)
        win = win.select("rid", "id", "line", "end", "fp", F.xxhash64("l1").alias("k1"), F.xxhash64("l2").alias("k2"))
    win = scratch.keep(win.withColumns({"fp": F.col("fp.h1"), "at": F.col("fp.line")}), "windows")
    seen = _repeated(win)
    seen = scratch.keep(seen, "fingerprints")
    near = scratch.keep(win.join(seen, "fp", "left_semi").drop("fp", "at"), "seeded")
    scratch.drop(win)
    first = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "rid", "line", "end")).alias("f")
    firsts = scratch.keep(near.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first")
    later = near.join(firsts, ["k1", "k2"]).filter(
        (F.col("rid") != F.col("f.rid")) | (F.col("line") > F.col("f.end")))
    # windows of one document, merged to disjoint spans
    reach = F.max("end").over(Window.partitionBy("rid").orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    part = later.select("rid", "line", "end").withColumn("new", (F.coalesce(F.col("line") > reach, F.lit(True))).cast("int"))
    part = part.withColumn("g", F.sum("new").over(Window.partitionBy("rid").orderBy("line")))
    spans = part.groupBy("rid", "g").agg(F.min("line").alias("first"), F.max("end").alias("last"))
    spans = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))

    none = F.array().cast("array<struct<first:int,last:int>>")
    out = base.join(spans, "rid", "left").withColumn("spans", F.coalesce("spans", none))
    ls = _lines(F.col("t"))
    blank = lambda x: F.trim(x, F.lit(" \t\n\x0b\x0c\r")) == ""
    # the pieces between the spans, with the blank lines inside a span
    starts = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["last"] + 1))
    stops = F.concat(F.transform("spans", lambda s: s["first"]), F.array(F.size("ls")))
    out = out.withColumn("ls", ls).withColumns({"starts": starts, "stops": stops})
    nexts = F.concat(F.transform("spans", lambda s: s["last"] + 1), F.array(F.size("ls")))
    zipped = F.arrays_zip(F.col("starts").alias("x0"), F.col("stops").alias("x1"), F.col("nexts").alias("x2"))
    between = F.flatten(F.transform("z", lambda p: F.concat(
        F.slice("ls", p["x0"] + 1, p["x1"] - p["x0"]), F.filter(F.slice("ls", p["x1"] + 1, p["x2"] - p["x1"]), blank))))
    out = out.withColumn("nexts", nexts).withColumn("z", zipped).withColumn("keep", between)
    clean = F.when(F.size("spans") == 0, F.col("t")).otherwise(F.array_join("keep", "\n"))
    return out.select(F.col("id").alias(id_col), F.size("ls").alias("n_lines"),
                      F.when(F.size("spans") == 0, F.lit(0)).otherwise(F.size("ls") - F.size("keep")).alias("n_removed"),
                      "spans", clean.alias("clean_text"))
