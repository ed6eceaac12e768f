"""Suffix-array dedup with sparse suffix arrays.

Of all suffixes of the documents' word sequences, those at minimiser positions
are retained: of every ``min_words - gram + 1`` consecutive word n-grams, the one
with the smallest hash. Which positions these are depends on the words alone, so
two copies of a passage of ``min_words`` words retain a suffix at the same place
inside it. Each suffix carries digests of the ``min_words``-word windows that its
position was chosen for, which reach left and right of it, and one digest of
all of them. Suffixes whose n-gram occurs once drop out first.

The others are sorted by n-gram and by what is around it, and equal neighbours are
copies: the first in document order stands for all of them, the rest are
later copies with all their words. Where an n-gram stands in different
surroundings, the match of those first ones is extended left and right over the
windows that agree, again by sorting and comparing neighbours. No step gathers the
suffixes of an n-gram: copies are counted before the shuffle and told by a
join whose hot keys AQE splits.

Defined results: null texts and texts of fewer than ``min_words`` words hold no
passage; repeats inside one document count; the first copy (smallest id, then
place) is kept and later ones are removed; rows with a null id take no part;
rows with equal ids are documents of their own; a very long text is read whole; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln import session
from feedkiln.llm.common import (
    LOWER, complete_groups, hashed_words, mix64, powers, ranges, slices, text_buffer, word_bounds,
)

MIN_WORDS, GRAM = 50, 10
#: Words worked on at once.
WORDS = 1 << 20
_ODD = 0xBF58476D1CE4E5B9


def digests(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit digests of all runs of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_ODD, len(hashes)), out=total[1:])
    return mix64((total[size:] - total[:-size]) * powers(pow(_ODD, -1, 1 << 64), n))


def retained(hashes: np.ndarray, begin: np.ndarray, min_words: int, gram: int) -> Iterator[tuple]:
    """For pieces of the words: n-gram of each retained suffix, its document,
    its first window (word in the document), and the windows' digests with
    the place where each suffix's begin."""
    n, span = len(hashes), min_words - gram + 1
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    step = WORDS - min_words
    for s in range(0, max(n - min_words + 1, 0), step):
        h = hashes[s: s + step + min_words - 1]
        g = digests(h, gram)
        at = np.empty(len(h) - min_words + 1, np.int64)
        for i in range(0, len(at), 1 << 16):
            view = np.lib.stride_tricks.sliding_window_view(g[i: i + (1 << 16) + span - 1], span)
            at[i: i + (1 << 16)] = view[: len(at) - i].argmin(axis=1)
        at += np.arange(len(at))
        own = doc[s: s + len(at)]
        valid = np.flatnonzero(own == doc[s + min_words - 1: s + min_words - 1 + len(at)])
        if not len(valid):
            continue
        place = at[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)
        first = np.flatnonzero(new)
        d = own[valid[first]]
        yield g[place[first]], d, valid[first] + s - begin[d], digests(h, min_words)[valid], np.append(first, len(valid))


def runs(windows: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A digest of each suffix's windows: of all words around it."""
    size = np.diff(edge)
    at = ranges(np.zeros(len(size), np.int64), size)
    total = np.add.reduceat(windows * powers(_ODD, int(size.max()))[at], edge[:-1])
    return mix64(total + size.astype(np.uint64))


def _grams(batches: Iterator[pa.RecordBatch], text: str, min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            for key, _, _, windows, edge in retained(*hashed_words(part[text]), min_words, gram):
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(runs(windows, edge).view(np.int64))], names=["gram", "around"])


def _suffixes(batches: Iterator[pa.RecordBatch], text: str, ident: str, min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            for key, doc, start, windows, edge in retained(*hashed_words(part[text]), min_words, gram):
                rows = pa.array(doc)
                yield pa.record_batch([part[ident].take(rows), part["_row"].take(rows), pa.array(start), pa.array(key.view(np.int64)),
                                       pa.array(runs(windows, edge).view(np.int64)),
                                       pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(windows.view(np.int64)))],
                                      names=["doc", "row", "start", "gram", "around", "windows"])


def _copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` that occur more than once and the ``least`` place of each."""
    place = F.struct("doc", "start", "row")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).filter("n > 1").drop("n").checkpoint()


def _told(rows: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """``first``: null for a row without copies, else whether it is the first of them."""
    first = F.when(F.col("least").isNotNull(), F.struct("doc", "start", "row") == F.col("least"))
    return rows.join(copies, keys, "left").withColumn("first", first).drop("least")


def _pieces(told: DataFrame) -> DataFrame:
    """Every row with copies is repeated; all but the first are later copies."""
    return told.filter(F.col("first").isNotNull()).select("doc", "start", (F.col("start") + F.col("size")).alias("end"), (~F.col("first")).alias("later"))


def passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(doc, start, end, later): pieces of repeated passages in words; they may
    overlap. ``later``: a copy after the first, which is a repeat as well."""
    spark = docs.sparkSession
    slim = docs.filter(F.col(ident).isNotNull()).select(ident, text)
    kind = slim.schema[ident].dataType.simpleString()
    met = (slim.mapInArrow(lambda it: _grams(it, text, min_words, gram), "gram long, around long").groupBy("gram")
           .agg(F.count(F.lit(1)).alias("n"), (F.min("around") != F.max("around")).alias("mixed")).filter("n > 1").select("gram", "mixed").checkpoint())
    numbered = slim.withColumn("_row", F.monotonically_increasing_id())  # fixed once the suffixes are written
    suffixes = numbered.mapInArrow(lambda it: _suffixes(it, text, ident, min_words, gram),
                                   f"doc {kind}, row long, start long, gram long, around long, windows array<long>")
    path = session.scratch_path(spark, "suffixes")
    suffixes.join(met, "gram").write.parquet(path)
    shared = spark.read.schema(f"doc {kind}, row long, start long, gram long, around long, windows array<long>, mixed boolean").parquet(path)
    # suffixes that agree with all that is around them: one stands for all
    keys = ["gram", "around"]
    whole = shared.select("doc", "row", "start", *keys, (F.size("windows") + (min_words - 1)).alias("size"))
    copies = _copies(whole, keys)
    # those that meet others of the same n-gram are extended left and right, window by window
    alone = _told(shared.filter("mixed"), copies, keys).filter("coalesce(first, true)")
    parts = (alone.select("doc", "row", "start", "gram", F.posexplode("windows").alias("at", "window"))
             .select("doc", "row", (F.col("start") + F.col("at")).alias("start"), "gram", "window", F.lit(min_words).alias("size")).checkpoint())
    same = _told(parts, _copies(parts, ["gram", "window"]), ["gram", "window"])
    return _pieces(_told(whole, copies, keys)).union(_pieces(same))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by document and start to disjoint passages: those of all
    copies, and those of later copies."""
    for t in complete_groups(batches, ["key"]):
        doc = t["doc"].combine_chunks()
        columns = [t[c].to_numpy(zero_copy_only=False) for c in ("key", "start", "end")]
        is_later = t["later"].to_numpy(zero_copy_only=False)
        for which in (False, True):
            rows = np.flatnonzero(is_later) if which else np.arange(t.num_rows)
            if not len(rows):
                continue
            key, start, end = (c[rows] for c in columns)
            group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
            base = group * (int(end.max()) + 1)  # one number line for all documents
            reach = np.maximum.accumulate(base + end)
            new = np.ones(len(rows), bool)
            new[1:] = (base + start)[1:] > reach[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(rows)) - 1
            yield pa.record_batch([doc.take(pa.array(rows[first])), pa.array(start[first]), pa.array((reach - base)[last]),
                                   pa.array([which] * len(first), pa.bool_())], names=["doc", "start", "end", "later"])


def spans(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Disjoint repeated passages per document: doc, start, end, later (false:
    those of any copy; true: those of copies after the first)."""
    found = passages(docs, min_words, gram, text, ident)
    kind = found.schema["doc"].dataType.simpleString()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = found.withColumn("key", F.xxhash64("doc")).repartition(n, "key").sortWithinPartitions("key", "doc", "start")
    return rows.mapInArrow(_merge, f"doc {kind}, start long, end long, later boolean")


def report(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row per document that holds a passage found more than once: words in
    such passages, words in later copies, and both lists as start:end in words."""
    one = F.concat_ws(":", "start", "end")
    listed = lambda later: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("later") == later, F.struct("start", one.alias("x"))))),
                                                    lambda s: s["x"]), ",")
    words = lambda later: F.sum(F.when(F.col("later") == later, F.col("end") - F.col("start")).otherwise(0))
    return (spans(docs, min_words, gram, text, ident).groupBy(F.col("doc").alias(ident))
            .agg(words(False).alias("n_repeated"), words(True).alias("n_removed"), listed(False).alias("repeated"), listed(True).alias("removed")))


def _cut(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            data, offsets = text_buffer(part[text])
            starts, ends = word_bounds(LOWER[data], offsets)
            begin = np.searchsorted(starts, offsets)
            out = []
            # the last column holds the passages to cut
            for i, (t, gone) in enumerate(zip(part[text].to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)):
                if gone:
                    raw, at, keep = t.encode(), 0, []
                    for g in sorted(gone, key=lambda g: g["start"]):
                        keep.append(raw[at: int(starts[begin[i] + g["start"]] - offsets[i])])
                        at = int(ends[begin[i] + g["end"] - 1] - offsets[i])
                    t = b"".join([*keep, raw[at:]]).decode()
                out.append(t)
            names = part.schema.names[:-1]
            yield pa.record_batch([pa.array(out, part.schema.field(text).type) if c == text else part.column(k) for k, c in enumerate(names)], names=names)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The documents without the later copies of repeated passages."""
    gone = (spans(docs, min_words, gram, text, ident).filter("later").groupBy(F.col("doc").alias("_doc"))
            .agg(F.collect_list(F.struct("start", "end")).alias("_gone")))
    return (docs.join(gone, docs[ident] == gone["_doc"], "left").select(*[docs[c] for c in docs.columns], gone["_gone"])
            .mapInArrow(lambda it: _cut(it, text), T.StructType(docs.schema.fields)))
