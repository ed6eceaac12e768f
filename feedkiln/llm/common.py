"""Helpers shared by the operators: text buffers and word hashes in numpy,
sorted-group streaming, hot-key blocks and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln import session

#: Bytes of text that numpy code works on at once; a longer text is one slice
#: of its own and is cut into pieces of this size at word boundaries.
SLICE_BYTES = 2 << 20

#: Word bytes of the contract ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z was
#: lower-cased: digits, a-z and every byte of a non-ASCII code point.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = True
WORD[0x61:0x7B] = True
WORD[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MIX = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i mod 2**64`` for i < n (kept, grown by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        seq = np.full(size, base, np.uint64)
        seq[0] = 1
        have = _powers[base] = np.multiply.accumulate(seq)
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that any of their bits can serve as a code."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows (null: empty)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1]
    if data is None or len(col) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased bytes; no word spans two rows."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[inside[cut]]
    first[cut] = True
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut[inside[cut - 1]] - 1] = True
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial over mixed bytes, by prefix
    sums modulo 2**64, taken in pieces that end between words."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + (1 << 20), "right")))
        piece = data[at: int(ends[j - 1])]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_MIX[piece] * powers(_BASE, len(piece)), out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix64((total[e] - total[s]) * powers(_BASE_INV, len(piece))[s] + (e - s).astype(np.uint64))
        i = j
    return out


def hashed_words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and where each row's begin."""
    data, offsets = text_buffer(col)
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """From batches sorted by ``keys``, tables of whole groups with at least
    ``rows`` rows (the last may be smaller). A group must fit in memory."""
    held: list[pa.Table] = []
    n = 0
    for b in batches:
        if b.num_rows:
            held.append(pa.Table.from_batches([b]))
            n += b.num_rows
        if n < rows:
            continue
        t = pa.concat_tables(held).combine_chunks()
        change = group_starts(t, keys)
        if change[-1] == 0:
            held = [t]
            continue
        yield t.slice(0, change[-1])
        held, n = [t.slice(change[-1])], t.num_rows - int(change[-1])
    if n:
        yield pa.concat_tables(held).combine_chunks()


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = t[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start, start + count)``."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    reset = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - reset, counts)


def local_roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes over links a-b."""
    label = np.arange(n) if label is None else label
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        if np.array_equal(label, before):
            break
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def hot_blocks(df: DataFrame, key: str, ident: str, limit: int, small: int = 100_000) -> DataFrame:
    """Rows dealt to groups ``(key, block_a, block_b)`` of at most about twice
    ``limit`` rows, so that every two rows with one key meet in one group.

    A key with more than ``limit`` rows is split by a hash of ``ident`` into
    blocks; a row goes to every pair of blocks that its own takes part in.
    ``in_a`` and ``in_b`` tell on which sides it stands (a cold key has the one
    pair (0, 0)). The list of hot keys is broadcast if it has ``small`` rows at
    most, and joined by a shuffle otherwise."""
    hot = (df.groupBy(key).count().filter(F.col("count") > limit)
           .select(key, F.ceil(F.col("count") / limit).cast("int").alias("_blocks")))
    hot = hot.checkpoint()
    joined = df.join(F.broadcast(hot) if hot.count() <= small else hot, key, "left")
    n = F.coalesce(F.col("_blocks"), F.lit(1))
    own = F.pmod(F.xxhash64(F.col(ident), F.lit(11)), n).cast("int")
    rows = (joined.withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1))))
    a, b = F.least("_own", "_other"), F.greatest("_own", "_other")
    return (rows.withColumn("block_a", a).withColumn("block_b", b)
            .withColumn("in_a", F.col("_own") == F.col("block_a")).withColumn("in_b", F.col("_own") == F.col("block_b"))
            .drop("_own", "_other", "_blocks"))


def dealt(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Rows of one key together and in order within their partition."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable over ``edges`` (u, v).

    Alternates the large-star and small-star steps until nothing changes. Each
    step is a minimum per node (aggregated before the shuffle) and a join back,
    whose hot keys AQE splits; lineage is cut by a reliable checkpoint."""
    e = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = large.checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                         F.col("m").alias("v")).filter("u != v").distinct()).checkpoint()
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


#: Settings of the operators: an Arrow batch holds a few MB however long the
#: texts, and what AQE may broadcast stays small beside the driver's memory.
CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxBytesPerOutputBatch": str(8 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 << 20),
}


def prepare(spark) -> None:
    """Session settings of the library and of these operators."""
    session.configure(spark)
    for k, v in CONF.items():
        spark.conf.set(k, v)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc(col: Column | str) -> Column:
    """CRC-32 of a value's text, as the folds of the queries use it."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))
