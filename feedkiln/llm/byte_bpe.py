"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by the vocabulary's pattern; each piece is merged on its own. The
adjacent pairs of the pieces wait in buckets, one per merge rank; a bitmap of
three levels marks the buckets in use, and find-first-set on each level gives
the lowest rank. A bucket holds positions of a linked list; an entry whose pair
has changed since is stale and skipped. All new pieces of a slice of text share
one list and one queue, so a step merges one rank in many pieces at once; a long
piece takes as many steps as it has merges, never its square.

Defined results: a null or empty text gives no ids; every text decodes to its
own UTF-8 bytes; text that looks like a special token is ordinary text; a very long
text is encoded whole; repeated rows give equal rows; an empty table gives none; columns
other than the id and the text are neither read nor changed.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedkiln.llm.common import fields, ranges, slices

#: Pieces of up to so many characters are kept with their ids, so many at most.
KEEP_CHARS, KEEP_PIECES = 48, 150_000
#: Pieces of more bytes are merged one by one.
LONG_BYTES = 512
#: Bytes of text whose new pieces are merged together.
MERGE_BYTES = 8 << 20


class RankQueue:
    """Buckets of positions by rank; the bitmap finds the lowest rank in use."""

    def __init__(self):
        self.bucket: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}   # 64 ranks a word
        self.mid: dict[int, int] = {}   # 64 words a word
        self.top = 0

    def put_back(self, rank: int, held: list[int]) -> None:
        self.bucket[rank] = held
        w = rank >> 6
        self.low[w] = self.low.get(w, 0) | 1 << (rank & 63)
        self.mid[w >> 6] = self.mid.get(w >> 6, 0) | 1 << (w & 63)
        self.top |= 1 << (w >> 6)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        bucket = self.bucket
        for rank, position in zip(ranks.tolist(), positions.tolist(), strict=True):
            held = bucket.get(rank)
            if held is None:
                self.put_back(rank, [position])
            else:
                held.append(position)

    def push_one(self, rank: int, position: int) -> None:
        """For buckets that are heaps."""
        held = self.bucket.get(rank)
        if held is None:
            self.put_back(rank, [position])
        else:
            heappush(held, position)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank and all positions in its bucket."""
        if not self.top:
            return None
        t = (self.top & -self.top).bit_length() - 1
        m = self.mid[t]
        w = t << 6 | (m & -m).bit_length() - 1
        b = self.low[w]
        rank = w << 6 | (b & -b).bit_length() - 1
        self.low[w] = b & (b - 1)
        if not self.low[w]:
            self.mid[t] = m & (m - 1)
            if not self.mid[t]:
                self.top &= self.top - 1
        return rank, self.bucket.pop(rank)


class Vocabulary:
    """Merge ranks of a ``.tiktoken`` file and the pattern that goes with it."""

    def __init__(self, lines: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        self.token = {v: k for k, v in ranks.items()}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks}
        self.pair_dict = pairs
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        # a piece that is a token as a whole is that token
        self.whole = {t: np.array([r], "<u4").tobytes() for t, r in ranks.items()}
        tokens = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_size = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the tokens that pairs would merge to; -1: none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, merged together in one linked list in which no pair
        crosses from a piece into the next. Each round takes the lowest rank of
        all and merges it at the leftmost place of every piece that has it, so
        each piece sees its merges in its own order."""
        out = [self.whole.get(p) for p in pieces]
        for i, x in enumerate(out):
            if x is None and len(pieces[i]) > LONG_BYTES:
                out[i] = self.merge_long(pieces[i])
        rows = [i for i, x in enumerate(out) if x is None]
        size = np.array([len(pieces[i]) for i in rows], np.int64)
        n = int(size.sum())
        if not n:
            return out
        token = np.append(self.byte[np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)], -1)
        owner = np.append(np.repeat(np.arange(len(rows)), size), -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        due = np.full(n + 1, -1, np.int64)
        inner = np.flatnonzero(owner[:-2] == owner[1:-1])
        due[inner] = self.ranks_of(token[inner], token[inner + 1])
        inner = inner[due[inner] >= 0]
        queue = RankQueue()
        queue.push(due[inner], inner)
        while (entry := queue.pop()) is not None:
            rank, at = entry
            at = np.array(at, np.int64)
            at = at[due[at] == rank]  # stale entries go
            if len(at) > 1:
                at.sort()
                first = np.ones(len(at), bool)
                first[1:] = owner[at[1:]] != owner[at[:-1]]
                if not first.all():
                    rest = at[~first]
                    at = at[first]
                    rest = rest[rest != after[owner_place(at, owner, rest)]]
                    if len(rest):
                        queue.push(np.full(len(rest), rank), rest)
            elif not len(at):
                continue
            gone = after[at]
            nxt = after[gone]
            token[at], token[gone], due[gone] = rank, -1, -1
            after[at], before[nxt] = nxt, at
            left = before[at]
            left = left[(left >= 0) & (owner[left] == owner[at])]
            look = np.concatenate([at, left])
            right = after[look]
            found = np.where(owner[right] == owner[look], self.ranks_of(token[look], token[right]), -1)
            due[look] = found
            new = found >= 0
            queue.push(found[new], look[new])
        live = np.flatnonzero(token[:-1] >= 0)
        ids = token[live].astype("<u4").tobytes()
        cut = (4 * np.searchsorted(owner[live], np.arange(len(rows) + 1))).tolist()
        for k, i in enumerate(rows):
            out[i] = ids[cut[k]: cut[k + 1]]
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece: the same queue, each bucket a heap, so that
        equal ranks leave it leftmost first one at a time."""
        n, pair_rank = len(piece), self.pair_dict
        token = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.ranks_of(np.array(token[:-1]), np.array(token[1:]))
        due = [*first.tolist(), -1]
        queue = RankQueue()
        at = np.flatnonzero(first >= 0)
        queue.push(first[at], at)
        while (entry := queue.pop()) is not None:
            rank, heap = entry
            i = heappop(heap)
            if heap:
                queue.put_back(rank, heap)
            if due[i] != rank:
                continue
            gone = after[i]
            token[i], token[gone], due[gone] = rank, -1, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0:
                    due[k] = pair_rank.get(token[k] << 32 | token[after[k]], -1) if after[k] < n else -1
                    if due[k] >= 0:
                        queue.push_one(due[k], k)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.kept) >= KEEP_PIECES:
            self.kept, self.older = {}, self.kept
        out, waiting, kept, older = [], {}, self.kept, self.older
        for text in texts:
            pieces = self.split(text)
            ids = list(map(kept.get, pieces))
            if None in ids:
                for i in [i for i, x in enumerate(ids) if x is None]:
                    p = pieces[i]
                    ids[i] = older.get(p)
                    if ids[i] is None:
                        ids[i] = waiting.setdefault(p, len(waiting))
                    else:
                        kept[p] = ids[i]
            out.append(ids)
        new = self.merge([p.encode() for p in waiting])
        kept.update((p, x) for p, x in zip(waiting, new, strict=True) if len(p) <= KEEP_CHARS)
        return [b"".join([x if type(x) is bytes else new[x] for x in ids]) for ids in out]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, one after the other."""
        n = np.frombuffer(ids, "<u4")
        return self.token_bytes[ranges(self.token_start[n], self.token_size[n])].tobytes()


def owner_place(at: np.ndarray, owner: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """For every later position in a bucket, the first one of its piece."""
    return at[np.searchsorted(owner[at], owner[rest])]


_vocabularies: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One vocabulary per worker process and broadcast."""
    if shared.value[0] not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[shared.value[0]] = Vocabulary(*shared.value[1:])
    return _vocabularies[shared.value[0]]


def share(spark, rank_file: str, pattern: str):
    """Broadcast of a rank file (its size is the vocabulary's, about 1 MB)."""
    with open(rank_file, "rb") as f:
        lines = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(lines + pattern.encode()).hexdigest(), lines, pattern))


def _encode(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared) -> Iterator[pa.RecordBatch]:
    v = _vocabulary(shared)
    for batch in batches:
        for part in slices(batch, text, MERGE_BYTES):
            ids = v.encode([t or "" for t in part[text].to_pylist()])
            size = np.cumsum([0, *(len(x) // 4 for x in ids)])
            flat = pa.py_buffer(b"".join(ids))
            values = pa.Array.from_buffers(pa.uint32(), int(size[-1]), [None, flat]).cast(pa.int32())
            decoded = pa.array([hashlib.sha256(v.decode(x)).hexdigest() for x in ids], pa.string())
            yield pa.record_batch([part[ident], pa.ListArray.from_arrays(pa.array(size, pa.int32()), values), decoded],
                                  names=[ident, "ids", "decoded_sha256"])


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident``, ``ids`` (array<int>) and the digest of the bytes that they
    decode to, one row per document."""
    shared = share(docs.sparkSession, rank_file, pattern)
    schema = T.StructType([*fields(docs, ident), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("decoded_sha256", T.StringType())])
    return docs.select(ident, text).mapInArrow(lambda it: _encode(it, text, ident, shared), schema)


def _decode(batches: Iterator[pa.RecordBatch], ident: str, shared) -> Iterator[pa.RecordBatch]:
    v = _vocabulary(shared)
    for batch in batches:
        texts = [v.decode(np.array(ids or [], "<u4").tobytes()).decode(errors="replace") for ids in batch["ids"].to_pylist()]
        yield pa.record_batch([batch[ident], pa.array(texts, pa.string())], names=[ident, "text"])


def decode(encoded: DataFrame, rank_file: str, pattern: str, ident: str = "doc_id") -> DataFrame:
    """``ident`` and ``text`` from the rows of ``encode``."""
    shared = share(encoded.sparkSession, rank_file, pattern)
    schema = T.StructType([*fields(encoded, ident), T.StructField("text", T.StringType())])
    return encoded.select(ident, "ids").mapInArrow(lambda it: _decode(it, ident, shared), schema)


def _digest(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared) -> Iterator[pa.RecordBatch]:
    v = _vocabulary(shared)
    for batch in batches:
        for part in slices(batch, text, MERGE_BYTES):
            n, ids_hex, text_hex = [], [], []
            for ids in v.encode([t or "" for t in part[text].to_pylist()]):
                n.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(v.decode(ids)).hexdigest())
            yield pa.record_batch([part[ident], pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                                  names=[ident, "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes; encoding
    and decoding run in one pass, so that no ids are shipped back."""
    shared = share(docs.sparkSession, rank_file, pattern)
    schema = T.StructType([*fields(docs, ident), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return docs.select(ident, text).mapInArrow(lambda it: _digest(it, text, ident, shared), schema)
