"""Operator 2: repeated runs of lines, found in a suffix array over line numbers.

Lines that occur once cannot be part of a repeated run, so only the others get suffixes. Their first rank
orders them by line; prefix doubling then ranks the suffixes by their first 2, 4, 8 ... lines: ranks of a
suffix and of the one h lines on make a pair, the distinct pairs are sorted over all tasks, and a pair's
place is the rank by 2h lines. Suffixes whose rank is theirs alone drop out. A rank shared by several suffixes
is an interval of the suffix array whose common prefix has at least h lines; two overlapping ranks
name the interval for any other number of lines.

A run counts if it is not blank; callers may ask for more, with `min_words`. A line is deleted if it lies in
such a run that also occurs earlier: in a document with a smaller id, or further up in the same one. Every such
run is covered by the shortest runs that count and begin or end at one of its lines, so it is enough to
look up the intervals of those; what is deleted is the union of whole maximal runs. A word is up to eight
characters without white space, so that text in a script without spaces has words as well.

Pairs and lines are counted in tasks before they are shuffled, and positions are joined to ranks, never
gathered by rank, so a line that is everywhere is no hot spot. Main path: DataFrame functions only.

Defined cases: null texts stay null and empty ones empty; lines end at line feeds; blank lines have
no words but belong to runs; a null id comes before all others; rows equal in id and text are one
document and all get the same result; `dedup_lines` keeps other columns, but replaces those that have the
names of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fovea.llm.common import materialize

#: Fewest words of a run that counts: one, that is, all but blank runs.
MIN_WORDS = 1
WORD = r"\S{1,8}"
DOC = ["_id", "_text"]


def with_keys(docs: DataFrame) -> DataFrame:
    """`_id`, `_text`: the id without nulls, and a hash of the text, which tell documents apart."""
    return docs.withColumns(
        {"_id": F.coalesce("doc_id", F.lit(-(1 << 63))).cast("bigint"), "_text": F.xxhash64("text")}
    )


def lines_of(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(_id, _text, at, words, rank) of lines that occur at least twice; ranks order lines."""
    lines = with_keys(docs.select("doc_id", "text")).select(*DOC, F.posexplode(lines_of()).alias("at", "line"))
    lines = lines.select(
        *DOC, "at", F.regexp_count("line", F.lit(WORD)).alias("words"),
        F.xxhash64("line").alias("a"), F.xxhash64(F.lit("second"), "line").alias("b"),
    )
    often = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    named = ranked(often.select("a", "b"), ["a", "b"])
    return lines.join(named, ["a", "b"]).select(*DOC, "at", "words", "rank")


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys with a `rank` that grows in their order over all tasks."""
    return materialize(
        keys.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("rank", F.monotonically_increasing_id()),
        "ranks",
    )


def doubled(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks by `step` lines to ranks by twice as many, of suffixes that share them."""
    ahead = ranks.select(*DOC, (F.col("at") - step).alias("at"), F.col("rank").alias("next"))
    pairs = materialize(ranks.join(ahead, [*DOC, "at"]), "pairs")
    shared = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
    keys = shared.select(F.col("rank").alias("a"), F.col("next").alias("b"))
    named = ranked(keys, ["a", "b"]).select(
        F.col("a").alias("rank"), F.col("b").alias("next"), F.col("rank").alias("to")
    )
    found = pairs.join(named, ["rank", "next"]).select(*DOC, "at", F.col("to").alias("rank"))
    return materialize(found, "suffixes")


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(_id, _text, first, last): for each repeated line the shortest run of repeated lines with
    enough words that begins there, and the shortest that ends there."""
    in_doc = Window.partitionBy(*DOC).orderBy("at")
    rows = lines.withColumn("island", F.col("at") - F.row_number().over(in_doc))
    island = [*DOC, "island"]
    rows = rows.withColumn("upto", F.sum("words").over(Window.partitionBy(*island).orderBy("at")))
    rows = rows.withColumn("before", F.col("upto") - F.col("words"))
    whole = Window.partitionBy(*island)
    # both frames grow as the window goes on, so that each line is added to them once
    onward = whole.orderBy(F.desc("before")).rangeBetween(Window.unboundedPreceding, -min_words)
    backward = whole.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    rows = rows.select(
        *DOC, "at", "before", "upto",
        F.min("at").over(onward).alias("after"), F.max("at").over(backward).alias("ahead"),
        F.min("at").over(whole).alias("head"), F.max("at").over(whole).alias("tail"),
        F.max("upto").over(whole).alias("total"),
    )
    last = F.coalesce(
        F.col("after") - 1, F.when(F.col("total") - F.col("before") >= min_words, F.col("tail"))
    )
    first = F.coalesce(F.col("ahead") + 1, F.when(F.col("upto") >= min_words, F.col("head")))
    runs = rows.select(
        *DOC,
        F.inline(
            F.array(
                F.struct(F.col("at").alias("first"), last.alias("last")),
                F.struct(first.alias("first"), F.col("at").alias("last")),
            )
        ),
    )
    return runs.where("first is not null and last is not null").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _text, first, last): runs of lines that occur earlier, overlapping or not."""
    lines = materialize(repeated_lines(docs), "repeated-lines").dropDuplicates([*DOC, "at"])
    lines = materialize(lines, "lines")
    runs = materialize(
        shortest_runs(lines, min_words).withColumn("n", F.col("last") - F.col("first") + 1), "runs"
    )
    longest = runs.agg(F.max("n")).first()[0] or 0
    ranks, step, found = lines.select(*DOC, "at", "rank"), 1, []
    while step <= longest:
        some = runs.where((F.col("n") >= step) & (F.col("n") < 2 * step))
        begin = ranks.select(*DOC, F.col("at").alias("first"), F.col("rank").alias("r"))
        end = ranks.select(*DOC, (F.col("at") + step - 1).alias("last"), F.col("rank").alias("s"))
        interval = materialize(
            some.join(begin, [*DOC, "first"]).join(end, [*DOC, "last"]), "intervals"
        )
        place = F.struct("_id", "_text", "first")
        leads = materialize(interval.groupBy("n", "r", "s").agg(F.min(place).alias("lead")), "leads")
        later = interval.join(leads, ["n", "r", "s"]).where(place > F.col("lead"))
        found.append(later.select(*DOC, "first", "last"))
        step *= 2
        if step <= longest:
            ranks = doubled(ranks, step // 2)
    out = found[0] if found else runs.select(*DOC, "first", "last")
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def merged(runs: DataFrame) -> DataFrame:
    """(_id, _text, runs): each document's runs without overlap, in order."""
    earlier = Window.partitionBy(*DOC).orderBy("first", "last")
    reach = F.max("last").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    rows = runs.withColumn("new", F.coalesce((F.col("first") > reach + 1).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("new").over(earlier))
    rows = rows.groupBy(*DOC, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return rows.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of `docs` with `runs`, `n_lines`, `n_deleted` and the text that is left.

    A text without deleted lines stays as it is; one all of whose lines go becomes empty.
    """
    runs = merged(later_copies(docs, min_words))
    keyed = with_keys(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")))
    rows = keyed.join(runs, DOC, "left")
    lines = lines_of()
    stops = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))
    gaps = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    kept = F.transform(
        F.filter(gaps, lambda g: g["n"] > 0), lambda g: F.slice(lines, g["a"] + 1, g["n"])
    )
    left = F.array_join(F.flatten(kept), "\n")
    deleted = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    own = {"runs", "n_lines", "n_deleted"}
    return rows.select(
        *[F.when(F.col("runs").isNull(), F.col("text")).otherwise(left).alias("text")
          if name == "text" else F.col("_row")[name].alias(name)
          for name in docs.columns if name not in own],
        F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
        F.coalesce(F.size(F.when(F.col("text").isNotNull(), lines)), F.lit(0)).alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).alias("n_deleted"),
    )
