"""SimHash near-dedup over BK-trees.

Fingerprints: words of the text (A-Z lower-cased, split at ASCII white space)
form shingles; each shingle's XXH64 votes on 64 bits. Fingerprints within
``radius`` bits link; the components of the links are the groups.

Search: two fingerprints that differ in at most ``radius`` bits agree on one of
``radius + 1`` bit fields, so a shard holds the distinct fingerprints with one
value of one field. A shard's BK-tree (children keyed by their Hamming distance
to the parent) is searched by its own members along edges within the radius of
the distance just found. A shard of more than ``SHARD`` members is cut into
blocks, each with a tree, and every pair of blocks meets. The trees reach the
executors by a shuffle: broadcasting them would bring the fingerprints of all
documents to the driver.

Defined results: a null, empty or white-space text has fingerprint zero and
links like any other; equal fingerprints are one tree member, so copies cost
nothing; rows with one id are one document; a row with a null id links nothing
and stays; a very long text is read whole; an empty table gives no rows; columns other than the id and the text are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln.llm.common import complete_groups, components, dealt, fields, group_starts, hot_blocks, local_roots, ranges, slices

SEED = 42
#: Members of a tree.
SHARD = 4096
#: Shingles hashed at once.
CHUNK = 1 << 16


def simhash(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (end - size)[: len(words) - k + 1], end[k - 1:]
    votes, n = np.zeros(64, np.int64), len(starts)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts[i: i + CHUNK].tolist(), ends[i: i + CHUNK].tolist(), strict=True)],
                        np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], text: str, ident: str, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            texts = pc.fill_null(part[text], "").cast(pa.binary()).to_pylist()
            h = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.record_batch([part[ident], pa.array(h)], names=[ident, "fingerprint"])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident`` and ``fingerprint`` (64 bits as a signed long)."""
    schema = T.StructType([*fields(docs, ident), T.StructField("fingerprint", T.LongType())])
    return docs.select(ident, text).mapInArrow(lambda it: _fingerprints(it, text, ident, shingle), schema)


class Forest:
    """BK-trees of many shards, built level by level over all of them at once.

    ``shard`` is sorted; a shard's first member is the root of its tree. Of the
    members that reach a node at the same distance, the first becomes that
    node's child, and the others go on below it."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        self.fp = fp
        n = len(fp)
        first = np.ones(n, bool)
        first[1:] = shard[1:] != shard[:-1]
        self.roots = np.flatnonzero(first)
        self.root_of_shard = shard[self.roots]
        below = np.flatnonzero(~first)
        parent = self.roots[np.cumsum(first) - 1][below]
        node, key = [], []
        while len(below):
            edge = parent * 65 + np.bitwise_count(fp[below] ^ fp[parent])
            order = np.argsort(edge, kind="stable")
            edge, below = edge[order], below[order]
            lead = np.ones(len(edge), bool)
            lead[1:] = edge[1:] != edge[:-1]
            child = below[lead]
            node.append(child)
            key.append(edge[lead])
            parent = child[np.cumsum(lead) - 1][~lead]
            below = below[~lead]
        node = np.concatenate([np.zeros(0, np.int64), *node])
        key = np.concatenate([np.zeros(0, np.int64), *key])
        order = np.argsort(key)
        self.child, self.edge = node[order], key[order]  # edges sorted by (parent, distance)

    def search(self, query: np.ndarray, root: np.ndarray, radius: int, step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of query, member) within the radius, following only
        edges within the radius of the distance to their parent."""
        who, member = [], []
        todo = [(np.arange(i, min(i + step, len(query))), root[i: i + step]) for i in range(0, len(query), step)]
        while todo:
            q, at = todo.pop()
            far = np.bitwise_count(query[q] ^ self.fp[at]).astype(np.int64)
            near = far <= radius
            who.append(q[near])
            member.append(at[near])
            low = np.searchsorted(self.edge, at * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edge, at * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            q, at = np.repeat(q, count), self.child[ranges(low, count)]
            todo += [(q[i: i + step], at[i: i + step]) for i in range(0, len(q), step)]
        return np.concatenate([np.zeros(0, np.int64), *who]), np.concatenate([np.zeros(0, np.int64), *member])


KEYS = ["field", "block_a", "block_b"]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for t in complete_groups(batches, KEYS):
        fp = t["fingerprint"].to_numpy().view(np.uint64)
        node = t["node"].to_numpy()
        in_a, in_b = (t[c].to_numpy(zero_copy_only=False) for c in ("in_a", "in_b"))
        starts = group_starts(t, KEYS)
        shard = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
        a, b = np.flatnonzero(in_a), np.flatnonzero(in_b)  # trees of the a side, searched by the b side
        forest = Forest(fp[a], shard[a])
        root = forest.roots[np.minimum(np.searchsorted(forest.root_of_shard, shard[b]), len(forest.roots) - 1)] if len(a) else a
        ok = shard[a][root] == shard[b] if len(a) else np.zeros(len(b), bool)
        b = b[ok]
        who, member = forest.search(fp[b], root[ok], radius)
        label = local_roots(t.num_rows, b[who], a[member])
        moved = np.flatnonzero(label != np.arange(t.num_rows))
        yield pa.record_batch([pa.array(node[moved]), pa.array(node[label[moved]])], names=["u", "v"])


def links(members: DataFrame, radius: int = 3, bits: int = 64) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of ``members``
    (node, fingerprint) within the radius; per shard only a spanning forest."""
    k = radius + 1
    cuts = [bits * i // k for i in range(k + 1)]
    if radius < 1:  # only equal fingerprints link, and those are one member
        return members.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    keys = [F.shiftrightunsigned("fingerprint", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) * k + i
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    sharded = members.withColumn("field", F.explode(F.array(*keys)))
    pairs = dealt(hot_blocks(sharded, "field", "fingerprint", SHARD), KEYS)
    return pairs.mapInArrow(lambda it: _links(it, radius), "u long, v long")


def groups(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    id reachable over links, its own included)."""
    prints = fingerprints(docs, shingle, text, ident).checkpoint()
    members = prints.groupBy("fingerprint").agg(F.min(ident).alias("node")).filter("node is not null").checkpoint()
    found = components(links(members, radius))
    named = members.join(found, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("component_id"))
    return (prints.join(named, "fingerprint", "left")
            .select(ident, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The documents without the later members of each group; all columns stay."""
    later = groups(docs, shingle, radius, text, ident).filter(F.col(ident) != F.col("component_id")).select(ident)
    return docs.join(later, ident, "left_anti")
