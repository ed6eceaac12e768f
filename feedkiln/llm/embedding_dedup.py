"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised; in each of ``tables`` hash tables, ``hashes`` Gaussian
projections, shifted and quantised to cells of width ``width``, name a bucket.
Vectors that meet in a bucket are compared by exact cosine in double precision.
A pair may meet in several tables; it is counted in the first of them, which
both members can tell from their bucket codes, so no list of pairs is shuffled.

A bucket of more than ``BLOCK`` vectors is cut into blocks that meet pairwise,
so no task holds a hot bucket. A task returns counts and a spanning forest of
its links, never the pairs. Equal vectors are one member with a weight.

With the default width (5 times the distance of two unit vectors at cosine 0.9)
a pair at cosine 0.9 shares one table's bucket with probability 0.84 ** hashes,
and one of 24 tables of 10 hashes with probability 0.99; closer pairs more.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component links with nothing and is kept; so is one with a null id;
vectors of different lengths don't link; an empty table gives no rows; columns
other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkiln.llm.common import complete_groups, components, dealt, group_starts, hot_blocks, local_roots, mix64

TABLES, HASHES = 24, 10
#: Vectors of a block, and rows of one strip of a block's product.
BLOCK, STRIP = 1024, 64
KEYS = ["bucket", "block_a", "block_b"]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_codes(x: np.ndarray, tables: int, hashes: int, width: float) -> np.ndarray:
    """64-bit bucket names of unit vectors, one per table."""
    r = np.random.default_rng([x.shape[1], tables, hashes])
    a, b = r.standard_normal((x.shape[1], tables * hashes)), r.uniform(0, width, tables * hashes)
    cell = np.floor((x @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(x), tables, hashes)
    odd = r.integers(1, 1 << 63, (tables, hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mix64((cell * odd).sum(axis=2, dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(x.shape[1]))


def _hash(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, width: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["vector"]
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        start = np.cumsum(size) - size
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            raw = np.ascontiguousarray(flat[start[rows][:, None] + np.arange(n)])
            code = bucket_codes(unit(raw.astype(np.float64)), tables, hashes, width)
            yield pa.record_batch([batch["node"].take(pa.array(rows)), batch["weight"].take(pa.array(rows)),
                                   pa.array([r.tobytes() for r in raw], pa.binary()),
                                   pa.array([c.tobytes() for c in code], pa.binary()),
                                   pa.array(list(code.view(np.int64)), pa.list_(pa.int64()))],
                                  names=["node", "weight", "vector", "codes", "buckets"])


def _compare(batches: Iterator[pa.RecordBatch], dtype: str, tables: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for t in complete_groups(batches, KEYS, rows=8 * BLOCK):
        node, weight, table = (t[c].to_numpy() for c in ("node", "weight", "table"))
        in_a, in_b = (t[c].to_numpy(zero_copy_only=False) for c in ("in_a", "in_b"))
        code = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint64).reshape(-1, tables)
        raw = t["vector"].to_pylist()
        count = np.zeros(t.num_rows)
        ends = np.append(group_starts(t, KEYS), t.num_rows)
        left, right = [], []
        for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            a, b = s + np.flatnonzero(in_a[s:e]), s + np.flatnonzero(in_b[s:e])
            if not len(a) or not len(b) or e - s < 2:
                continue
            x = unit(np.frombuffer(b"".join(raw[s:e]), dtype).astype(np.float64).reshape(e - s, -1))
            same = in_a[s] and in_b[s]  # one block against itself: each pair once
            y = x[b - s].T
            for i in range(0, len(a), STRIP):
                near = x[a[i: i + STRIP] - s] @ y >= threshold
                p, q = np.nonzero(near)
                p, q = a[i + p], b[q]
                if same:
                    p, q = p[p < q], q[p < q]
                if not len(p):
                    continue
                left.append(p)
                right.append(q)
                new = ~(code[p, : table[s]] == code[q, : table[s]]).any(axis=1) if table[s] else np.ones(len(p), bool)
                count += np.bincount(p[new], weight[q[new]], t.num_rows) + np.bincount(q[new], weight[p[new]], t.num_rows)
            if sum(map(len, left)) > 1 << 20:  # keep a forest of the links so far
                root = local_roots(t.num_rows, np.concatenate(left), np.concatenate(right))
                left, right = [np.flatnonzero(root != np.arange(t.num_rows))], [root[root != np.arange(t.num_rows)]]
        if left:
            root = local_roots(t.num_rows, np.concatenate(left), np.concatenate(right))
            out = np.flatnonzero((count > 0) | (root != np.arange(t.num_rows)))
            yield pa.record_batch([pa.array(node[out]), pa.array(node[root[out]]), pa.array(count[out].astype(np.int64))], names=["u", "v", "n"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, tables: int = TABLES, hashes: int = HASHES, width: float | None = None,
                    vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """``ident``, ``n_links``, ``component_id`` and ``kept`` for every vector."""
    width = width or 5 * float(np.sqrt(2 - 2 * threshold))
    dtype = "<f4" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    kind = "float" if dtype == "<f4" else "double"
    v = F.col("vector")
    fit = (F.col(ident).isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0)
           & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    all_ = vectors.select(ident, F.col(vector).cast(f"array<{kind}>").alias("vector")).withColumn("fit", F.coalesce(fit, F.lit(False)))
    classes = (all_.filter("fit").groupBy("vector").agg(F.min(ident).cast("long").alias("node"), F.count("*").alias("weight"))).checkpoint()
    hashed = classes.select("node", "weight", "vector").mapInArrow(
        lambda it: _hash(it, tables, hashes, width), "node long, weight long, vector binary, codes binary, buckets array<long>")
    rows = hashed.select("node", "weight", "vector", "codes", F.posexplode("buckets").alias("table", "bucket"))
    met = dealt(hot_blocks(rows, "bucket", "node", BLOCK), KEYS)
    found = met.mapInArrow(lambda it: _compare(it, dtype, tables, threshold), "u long, v long, n long").checkpoint()
    degree = found.groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    comp = components(found.select("u", "v"))
    per_class = (classes.join(degree, "node", "left").join(comp, "node", "left")
                 .select("vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "node").alias("component_id")))
    known = all_.filter("fit").join(per_class, "vector").select(ident, "n_links", "component_id")
    other = all_.filter("not fit").select(ident, F.lit(0).cast("long").alias("n_links"), F.col(ident).cast("long").alias("component_id"))
    return known.union(other).withColumn("kept", F.coalesce(F.col(ident) == F.col("component_id"), F.lit(True)))
