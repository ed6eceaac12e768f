"""Benchmark decontamination with suffix arrays over the training documents.

Every task cuts its documents' words into shards, builds a suffix array per
shard by prefix tripling (word codes, then runs of 3, 9 and 27 words named by
rank), and binary-searches all suffixes of the benchmark items at once. A
suffix that finds a run of ``window`` words gives the places of that run; runs
on one diagonal join to the longest verbatim matches. Nothing is shuffled: the
benchmark goes to the documents, in blocks of bounded size.

Defined results: a null or empty text has no words and is clean; an item of
fewer words than the window is one window of its own length; an item without
words, or with a null id, matches nothing; repeated item ids count once; an
empty benchmark leaves every document clean; every row of the documents gives
one row, also if its id is null or repeated and however large the benchmark is;
a very long text is read whole; an empty table of documents gives no rows;
document columns other than the id and the text are neither read nor changed, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln.llm.common import fields, hashed_words, ranges, slices

#: Words of a shard: ranks fit 21 bits, so three pack into one 63-bit key.
SHARD_WORDS = 1 << 20
CODE = np.int64((1 << 21) - 1)
#: Benchmark text held by a task at once.
BLOCK_BYTES = 16 << 20


def codes_of(hashes: np.ndarray) -> np.ndarray:
    """21-bit word codes; the largest value is kept for gaps between documents."""
    return (hashes % np.uint64(CODE)).astype(np.int64)


def packed(code: np.ndarray, step: int) -> np.ndarray:
    """Key of three consecutive runs of ``step`` words (gaps past the end)."""
    n = len(code)
    pad = np.concatenate([code, np.full(2 * step, CODE, np.int64)])
    return (pad[:n] << 42) | (pad[step: n + step] << 21) | pad[2 * step: n + 2 * step]


def suffix_array(code: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` words or more; the
    tripling ends early when all suffixes differ."""
    step, name = 1, code
    while True:
        key = packed(name, step)
        order = np.argsort(key)
        step *= 3
        if step >= depth:
            return order
        ordered = key[order]
        rank = np.zeros(len(key), np.int64)
        np.cumsum(ordered[1:] != ordered[:-1], out=rank[1:])
        if len(rank) and rank[-1] == len(rank) - 1:
            return order
        name = np.empty_like(rank)
        name[order] = rank


class Items:
    """Suffixes of benchmark items that start a window, grouped by length."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        self.window = window
        hashes, begin = hashed_words(pa.array(texts, pa.string()))
        n = np.diff(begin)
        self.ids = np.array(sorted({i for i, k in zip(ids, n, strict=True) if k}), dtype=object)
        number = {x: k for k, x in enumerate(self.ids)}
        self.by_length = []
        for length in sorted({min(int(k), window) for k in n if k}):
            rows = np.flatnonzero((n >= window) if length == window else (n == length))
            counts = n[rows] - length + 1
            start = ranges(begin[rows], counts)
            item = np.repeat(np.array([number[ids[r]] for r in rows], np.int64), counts)
            words = hashes[start[:, None] + np.arange(length)]
            self.by_length.append((length, item, start - np.repeat(begin[rows], counts), words))


def search(code: np.ndarray, key3: np.ndarray, order: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of the suffix array that starts with each row of query codes, by
    binary searches that advance together."""
    n, length = len(order), query.shape[1]
    keys = [(query[:, i] << 42) | (query[:, i + 1] << 21) | query[:, i + 2] for i in range(0, length - 2, 3)]
    rest = list(range(length - length % 3, length))

    def side(rows: np.ndarray, upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), n, np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            at, q = order[mid], rows[open_]
            less, same = np.zeros(len(q), bool), np.ones(len(q), bool)
            for i, key in enumerate(keys):
                p = at + 3 * i
                have = np.where(p < n, key3[np.minimum(p, n - 1)], np.iinfo(np.int64).max)
                less |= same & (have < key[q])
                same &= have == key[q]
            for i in rest:
                p = at + i
                have = np.where(p < n, code[np.minimum(p, n - 1)], CODE)
                less |= same & (have < query[q, i])
                same &= have == query[q, i]
            go = less | same if upper else less
            lo[open_[go]] = mid[go] + 1
            hi[open_[~go]] = mid[~go]

    low, high = side(np.arange(len(query)), False), np.zeros(len(query), np.int64)
    probe = np.flatnonzero(low < n)
    at = order[low[probe]]
    ok = at + length <= n
    probe, at = probe[ok], at[ok]
    found = probe[(code[at[:, None] + np.arange(length)] == query[probe]).all(axis=1)]
    high[found] = side(found, True)
    high[high < low] = low[high < low]
    return low, high


def find(hashes: np.ndarray, begin: np.ndarray, items: Items, cover: np.ndarray) -> list[np.ndarray]:
    """Marks window places in ``cover`` (differences, one longer than the
    words) and returns arrays (document, item, item word, document word, length)
    of single windows."""
    n = len(hashes)
    found = []
    gap = np.zeros(len(begin) - 1, np.int64)
    gap[1:] = 1
    shift = np.cumsum(gap)  # documents stand one gap apart
    n_all = n + int(shift[-1]) if len(shift) else n
    code = np.full(n_all, CODE, np.int64)
    word = np.full(n_all, -1, np.int64)
    place = np.arange(n) + np.repeat(shift, np.diff(begin))
    code[place] = codes_of(hashes)
    word[place] = np.arange(n)
    for s in range(0, max(n_all, 1), SHARD_WORDS):
        c = code[s: s + SHARD_WORDS + items.window - 1]
        w = word[s: s + SHARD_WORDS + items.window - 1]
        order = suffix_array(c, max(items.window, 1))
        key3 = packed(c, 1)
        for length, item, at, words in items.by_length:
            low, high = search(c, key3, order, codes_of(words))
            count = high - low
            hit = np.flatnonzero(count)
            if not len(hit):
                continue
            q = np.repeat(hit, count[hit])
            p = order[ranges(low[hit], count[hit])]
            keep = p < SHARD_WORDS  # later ones belong to the next shard
            q, p = q[keep], w[p[keep]]
            keep = np.ones(len(q), bool)
            for i in range(length):  # codes may collide; the full hashes decide
                keep &= hashes[np.minimum(p + i, n - 1)] == words[q, i]
            q, p = q[keep], p[keep]
            np.add.at(cover, p, 1)
            np.add.at(cover, p + length, -1)
            doc = np.searchsorted(begin, p, "right") - 1
            found.append(np.stack([doc, item[q], at[q], p - begin[doc], np.full(len(q), length)]))
    return found


def longest(found: list[np.ndarray]) -> np.ndarray:
    """Windows on one diagonal of a document and an item, joined to the longest runs."""
    if not found:
        return np.zeros((5, 0), np.int64)
    f = np.concatenate(found, axis=1)
    diagonal = f[3] - f[2]
    order = np.lexsort((f[2], diagonal, f[1], f[0]))
    f, diagonal = f[:, order], diagonal[order]
    new = np.ones(f.shape[1], bool)
    new[1:] = ((f[0][1:] != f[0][:-1]) | (f[1][1:] != f[1][:-1]) | (diagonal[1:] != diagonal[:-1])
               | (f[2][1:] > f[2][:-1] + 1))
    start = np.flatnonzero(new)
    end = np.append(start[1:], f.shape[1]) - 1
    run = f[:, start]
    run[4] = f[2][end] - f[2][start] + f[4][end]
    return run


MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], text: str, keep: list[str], bench) -> Iterator[pa.RecordBatch]:
    items = Items(*bench.value)
    for batch in batches:
        for part in slices(batch, text):
            hashes, begin = hashed_words(part[text])
            cover = np.zeros(len(hashes) + 1, np.int64)
            runs = longest(find(hashes, begin, items, cover)) if len(hashes) and len(items.ids) else longest([])
            hits = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
            starts = np.searchsorted(runs[0], np.arange(part.num_rows + 1))
            matches = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(items.ids[runs[1]].tolist(), pa.string()), *(pa.array(x) for x in runs[2:])], fields=list(MATCH)))
            yield pa.record_batch([*(part[c] for c in keep), pa.array(np.diff(begin)), pa.array(hits[begin[1:]] - hits[begin[:-1]]), matches],
                                  names=[*keep, "n_words", "n_hit", "matches"])


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[tuple[list[str], list[str]]]:
    """Items in blocks of about ``limit`` bytes of text, read one after the other."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("item_id is not null and text is not null")
    for i, t in rows.toLocalIterator():
        ids.append(i)
        texts.append(t)
        size += len(t.encode())
        if size >= limit:
            yield ids, texts
            ids, texts, size = [], [], 0
    yield ids, texts


def whole_items(blocks: Iterator[tuple[list[str], list[str]]]) -> Iterator[tuple[list[str], list[str]]]:
    """Blocks of items in the order of their ids, moved so that none ends within an id."""
    ids, texts = next(blocks)
    for more_ids, more_texts in blocks:
        cut = ids.index(ids[-1]) if more_ids and more_ids[0] == ids[-1] else len(ids)
        if cut and more_ids:
            yield ids[:cut], texts[:cut]
            ids, texts = ids[cut:], texts[cut:]
        ids, texts = ids + more_ids, texts + more_texts
    yield ids, texts


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``n_words``, ``n_hit`` and ``matches``
    (item id, word in the item, word in the document, length of the longest
    verbatim match there). A benchmark of more than ``BLOCK_BYTES`` takes
    several passes over numbered rows, whose matches are united by that number."""
    found = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
             T.StructField("matches", T.ArrayType(T.StructType([
                 T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()),
                 T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType())])))]
    blocks = [docs.sparkSession.sparkContext.broadcast((ids, texts, window))
              for ids, texts in whole_items(benchmark_blocks(benchmark.orderBy("item_id")))]
    slim, keep = docs.select(ident, text), [ident]
    if len(blocks) > 1:
        row = "_row"
        while row in (ident, text):
            row += "_"
        # the numbers are stored, so that all passes see the same ones
        slim, keep = slim.withColumn(row, F.monotonically_increasing_id()).checkpoint(), [ident, row]
    schema = T.StructType([*fields(slim, *keep), *found])
    parts = [slim.mapInArrow(lambda it, b=b: _scan(it, text, keep, b), schema) for b in blocks]
    return parts[0] if len(parts) == 1 else united(reduce(DataFrame.union, parts), ident, row)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Per document: words, words hit, matching items and the verdict."""
    found = find_matches(docs, benchmark, window, text, ident)
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        ident, "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.col("matches.n_words")), F.lit(0)).alias("longest_match"))


def united(found: DataFrame, ident: str, row: str) -> DataFrame:
    """Rows of several benchmark blocks joined to one row per document row; the
    words hit are counted over the union of the match intervals."""
    runs = F.array_sort(F.flatten(F.collect_list("matches")), lambda a, b: F.coalesce(
        F.nullif(F.signum(a["doc_word"] - b["doc_word"]), F.lit(0.0)), F.lit(0.0)).cast("int"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    hit = F.aggregate("matches", zero, lambda s, m: F.struct(
        (s["n"] + F.greatest(F.lit(0), m["doc_word"] + m["n_words"] - F.greatest(s["end"], m["doc_word"]))).alias("n"),
        F.greatest(s["end"], m["doc_word"] + m["n_words"]).alias("end")))["n"]
    return found.groupBy(row).agg(F.first(ident).alias(ident), F.max("n_words").alias("n_words"), runs.alias("matches")).select(
        ident, "n_words", hit.alias("n_hit"), "matches")


def _keep(batches: Iterator[pa.RecordBatch], text: str, bench) -> Iterator[pa.RecordBatch]:
    items = Items(*bench.value)
    for batch in batches:
        for part in slices(batch, text):
            hashes, begin = hashed_words(part[text])
            cover = np.zeros(len(hashes) + 1, np.int64)
            if len(hashes) and len(items.ids):
                find(hashes, begin, items, cover)
            hits = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
            yield part.filter(pa.array(hits[begin[1:]] == hits[begin[:-1]]))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The documents without any benchmark window, all columns as they were; a
    large benchmark filters them block after block."""
    schema = docs.schema
    for ids, texts in benchmark_blocks(benchmark):
        bench = docs.sparkSession.sparkContext.broadcast((ids, texts, window))
        docs = docs.mapInArrow(lambda it, b=bench: _keep(it, text, b), schema)
    return docs

