"""Line dedup: a suffix array over line sequences, built by distributed prefix
doubling, its longest-common-prefix intervals and maximal runs, with DataFrame
operations only.

The non-blank lines of a document are its sequence. A suffix starts at each
line; suffixes whose first ``k`` lines are equal share a rank, and a doubling
step ranks the first ``2 k`` lines by the pair of ranks (here, ``k`` lines on).
Ranks come from a range-partitioned sort of the distinct pairs, so their order
is the suffix order. A suffix that is alone in its rank has no copy at that
depth and leaves the work; the doubling ends when all have left. The depth is a
column, so that every step is the same plan.

A rank of the array at depth ``k`` is an interval whose longest common prefix is
``k`` or more. The ranks of depths ``k``, ``k / 2``, ... 1 refine it to the exact
one (``split``): members that go on alike for half as many lines form an
interval inside, which its first member stands for outside. At the end each
suffix is once a member, not the first, of an interval: the longest run of lines
from there that stands at an earlier place too. Runs that reach no further than
one that starts before them are not maximal and are left out.

A run of ``min_lines`` lines or more (or one line of ``min_chars`` characters)
that occurs more than once keeps its first copy, by document id and place; the
lines of later copies are deleted.

Defined results: blank lines belong to no run and stay; a null text stays null;
a document with a null id is left alone and gives no copies; rows with equal id
and text are one document; a text of very many lines or with a very long line is
treated like any other; an empty table gives no rows; columns other than id and text
stay as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AT = ["_doc", "_text", "_i"]


def lines_of(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Non-blank lines: document, text hash, place among the non-blank lines
    (``_i``) and among all (``_p``), 96 bits of line identity, length."""
    each = F.filter(F.transform(F.split(text, "\n"), lambda x, p: F.when(
        x.rlike(r"[^\x09-\x0D\x20]"), F.struct(p.alias("_p"), F.xxhash64(x).alias("_a"), F.hash(x).alias("_b"), F.length(x).alias("_size")))),
        lambda s: s.isNotNull())
    return (docs.filter(F.col(ident).isNotNull())
            .select(F.col(ident).alias("_doc"), F.xxhash64(text).alias("_text"), F.posexplode(each).alias("_i", "_line"))
            .select(*AT, "_line.*"))


def place() -> Column:
    return F.struct(*AT)


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` occur more than once, with the rank of the keys and
    the first place that has them. The distinct keys are sorted over the
    cluster; ids that grow along the sorted partitions are their ranks."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(place()).alias("_first")).filter("_n > 1").drop("_n")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = repeated.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_rank", F.monotonically_increasing_id())
    return rows.join(ranks.hint("merge"), keys).drop(*keys)


def shifted(ranks: DataFrame) -> DataFrame:
    """Pairs of the rank here (``_r1``) and ``_k`` lines on (``_r2``); a suffix
    without a ranked one there is alone at the greater depth and leaves."""
    here = ranks.select(*AT, "_k", F.col("_rank").alias("_r1"))
    there = ranks.select("_doc", "_text", (F.col("_i") - F.col("_k")).alias("_i"), F.col("_rank").alias("_r2"))
    return here.join(there.hint("merge"), AT)


def first_ranks(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Depth 1: the repeated lines."""
    lines = lines_of(docs, text, ident).checkpoint()
    return ranked(lines, ["_a", "_b"]).dropDuplicates(AT).withColumn("_k", F.lit(1)).checkpoint()


def levels(ranks: DataFrame) -> list[DataFrame]:
    """Ranks of the suffixes that are repeated to 1, 2, 4, ... lines, by
    doubling from those of depth 1 to the last depth at which any is."""
    found = [ranks]
    while True:
        deeper = ranked(shifted(found[-1]), ["_r1", "_r2"]).withColumn("_k", F.col("_k") * 2).checkpoint()
        if deeper.isEmpty():
            return found
        found.append(deeper)


def suffix_ranks(ranks: DataFrame) -> tuple[DataFrame, int]:
    """The last of the ``levels`` and its depth."""
    found = levels(ranks)
    return found[-1], 1 << (len(found) - 1)


def members(ranks: DataFrame, deeper: DataFrame | None) -> DataFrame:
    """The intervals of one level, each by its first place and its depth, with
    their members; of those that share a rank of the next level the first only."""
    rows = ranks.select("_first", F.col("_k").alias("_depth"), *AT)
    if deeper is None:
        return rows
    inner = deeper.select(*AT, F.col("_first").alias("_inner"))
    return rows.join(inner.hint("merge"), AT, "left").filter(F.col("_inner").isNull() | (F.col("_inner") == place())).drop("_inner").select(rows.columns)


def split(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Members of an interval that share a rank after its ``_depth`` lines form
    an interval inside it, ``_k`` lines deeper; its first stays in the outer."""
    after = ranks.select("_doc", "_text", F.col("_i").alias("_next"), F.col("_rank").alias("_r"), "_k")
    told = rows.withColumn("_next", F.col("_i") + F.col("_depth")).join(after.hint("merge"), ["_doc", "_text", "_next"], "left")
    keys = ["_first", "_depth", "_r"]
    # the one more column to join by has both sides shuffled, so that AQE can split a hot key
    alike = (told.filter(F.col("_r").isNotNull()).groupBy(*keys).agg(F.max("_k").alias("_k"), F.count("*").alias("_n"), F.min(place()).alias("_head"))
             .filter("_n > 1").drop("_n"))
    outer = F.struct("_first", "_depth")
    inner = F.struct(F.col("_head").alias("_first"), (F.col("_depth") + F.col("_k")).alias("_depth"))
    nodes = (F.when(F.col("_head").isNull(), F.array(outer)).when(F.col("_head") == place(), F.array(outer, inner))
             .otherwise(F.array(inner)))
    return told.join(alike.hint("merge"), [*keys, "_k"], "left").select(F.explode(nodes).alias("_node"), *AT).select("_node.*", *AT)


def intervals(found: list[DataFrame]) -> DataFrame | None:
    """The longest-common-prefix intervals of two lines or more: first place,
    exact depth, members (None: no two lines are repeated)."""
    rows = None
    for k in range(len(found) - 1, 0, -1):
        own = members(found[k], found[k + 1] if k + 1 < len(found) else None)
        rows = split(own if rows is None else rows.union(own), found[k - 1]).checkpoint()
    return rows


def copied(found: list[DataFrame]) -> DataFrame:
    """Per repeated suffix but the first of its kind, the lines (``_depth``)
    that it shares with an earlier place, as many as there are: its interval."""
    later = place() != F.col("_first")
    deep = intervals(found)
    ones = members(found[0], found[1] if len(found) > 1 else None)
    return (ones if deep is None else ones.union(deep)).filter(later).select(*AT, "_depth")


def maximal(runs: DataFrame) -> DataFrame:
    """Runs that reach beyond those before them in their document, with the
    places ``_from`` to ``_end`` (exclusive) that are theirs alone."""
    before = Window.partitionBy("_doc", "_text").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    ends = runs.withColumn("_end", F.col("_i") + F.col("_depth"))
    return (ends.withColumn("_from", F.greatest("_i", F.max("_end").over(before))).filter("_from < _end")
            .select("_doc", "_text", "_i", "_depth", "_from", "_end"))


def deletions(docs: DataFrame, min_lines: int = 2, min_chars: int = 100, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(document, text hash, sorted line numbers to delete)."""
    ranks = first_ranks(docs, text, ident)
    single = ranks.filter((place() != F.col("_first")) & (F.col("_size") >= min_chars)).select(*AT, F.col("_k").alias("_depth"))
    runs = maximal(copied(levels(ranks)).filter(F.col("_depth") >= min_lines).union(single))
    gone = runs.select("_doc", "_text", F.explode(F.sequence("_from", F.col("_end") - 1)).alias("_i"))
    return (ranks.select(*AT, "_p").join(gone, AT)
            .groupBy("_doc", "_text").agg(F.array_sort(F.collect_list("_p")).alias("_gone")))


def without(lines: Column, gone: Column) -> Column:
    """Lines whose number is not in the sorted array ``gone``, in linear time:
    a 0/1 mask is laid out from the gaps between the numbers."""
    before = lambda j: F.when(j > 0, F.get(gone, j - 1)).otherwise(-1)
    mask = F.flatten(F.transform(gone, lambda x, j: F.concat(F.array_repeat(F.lit(0), x - before(j) - 1), F.array(F.lit(1)))))
    return F.filter(lines, lambda x, p: F.coalesce(F.get(mask, p), F.lit(0)) == 0)


def dedup_lines(docs: DataFrame, min_lines: int = 2, min_chars: int = 100, text: str = "text", ident: str = "doc_id",
                removed: str | None = None) -> DataFrame:
    """The documents with later copies of runs deleted from ``text``; a column
    named by ``removed`` gets the number of lines deleted."""
    gone = deletions(docs, min_lines, min_chars, text, ident).withColumnRenamed("_doc", "_id").withColumnRenamed("_text", "_hash")
    d = docs.alias("d").join(gone.alias("g"), (docs[ident] == F.col("g._id")) & (F.xxhash64(docs[text]) == F.col("g._hash")), "left")
    lines = F.split(docs[text], "\n")
    clean = F.when(F.col("g._gone").isNull(), docs[text]).otherwise(F.array_join(without(lines, F.col("g._gone")), "\n"))
    cols = [clean.alias(c) if c == text else docs[c] for c in docs.columns]
    if removed:
        cols.append(F.coalesce(F.size("g._gone"), F.lit(0)).cast("long").alias(removed))
    return d.select(*cols)
