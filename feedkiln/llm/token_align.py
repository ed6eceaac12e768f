"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level BPE of a ``tokenizers`` JSON file and reads a space and the
text; B is a ``sentencepiece`` model, which adds that space itself. Both token
sequences lie on one byte line. Per batch, ``pandas.merge_asof`` keyed by
document finds for every token start the other side's covering token; the union
of both directions holds all overlapping token pairs, and those of them that end
together are links and cut the tokens into groups. How often a token pair is
linked is counted over the whole corpus.

Texts are cut before spaces that follow a visible character. Neither A's pattern
nor a piece of B reaches over such a place, so the words between are tokenised
apart, frequent ones once, and a very long text is worked on in windows; the
digest of its groups goes on from one window to the next.

Linked tokens end together, so the shorter is a suffix of the longer. The pairs
for which that holds are few (``Vocabularies.pairs``, fixed by the two files), and
the corpus-wide counts, one number per pair, are small enough to send to all tasks.

Defined results: a null or empty text, and one whose tokens don't spell a space
and the text on either side (U+2581 in a text is a space to B), has no tokens:
zeros and an empty digest; text that looks like a special token is ordinary text;
every row is a document of its own, also with a null or repeated id; of equally
frequent partners each is a best one; an empty table gives no rows; other
columns aren't read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln import session
from feedkiln.llm.common import fields

#: Characters of text that are aligned together.
WINDOW = 1 << 20
#: Words of up to so many characters are kept with their ids, so many at most.
KEEP_CHARS, KEEP_WORDS = 32, 200_000

#: A word that one side does not spell.
BAD = (b"bad", b"bad")
#: Before a space behind a visible character, unless the text ends with it (B adds a
#: space to something only).
_CUT = re.compile(r"(?<=[!-~\w])(?= .)", re.DOTALL)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: visible
    Latin-1 characters for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the pairs that can be linked."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        self.bytes_a = [bytes(alphabet[c] for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.digits = digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.pairs = self.linkable()
        self.kept: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.any_bad = False

    def linkable(self) -> np.ndarray:
        """Sorted codes ``a * len(bytes_b) + b`` of tokens of which one ends with the other."""
        by_bytes: tuple[dict, dict] = ({}, {})
        for held, tokens in zip(by_bytes, (self.bytes_a, self.bytes_b), strict=True):
            for i, t in enumerate(tokens):
                held.setdefault(t, []).append(i)
        n = len(self.bytes_b)
        codes = {a * n + b for a, t in enumerate(self.bytes_a) for k in range(len(t)) for b in by_bytes[1].get(t[k:], ())}
        codes |= {a * n + b for b, t in enumerate(self.bytes_b) for k in range(1, len(t)) for a in by_bytes[0].get(t[k:], ())}
        return np.array(sorted(codes), np.int64)

    def words(self, words: list[str]) -> list[tuple]:
        """``(ids_a, ids_b)`` of words that begin with a space, as int32 bytes;
        ``BAD`` for a word that one side doesn't spell."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        good, held = np.ones(len(words), bool), []
        for lists, tokens, size in ((self.a_ids(words), self.bytes_a, self.size_a), (self.b.encode([w[1:] for w in words], num_threads=1), self.bytes_b, self.size_b)):
            n = np.array([len(x) for x in lists], np.int64)
            flat = list(itertools.chain.from_iterable(lists))
            ids = np.array(flat, np.int32)
            cut = np.concatenate([[0], np.cumsum(n)])
            spelled = np.diff(np.concatenate([[0], np.cumsum(size[ids])])[cut])
            if np.array_equal(spelled, [len(x) for x in raw]) and b"".join([tokens[i] for i in flat]) == b"".join(raw):
                pass
            else:
                good &= [b"".join([tokens[i] for i in x]) == w for x, w in zip(lists, raw, strict=True)]
            held.append((ids.tobytes(), (4 * cut).tolist()))
        (a, at), (b, bt) = held
        self.any_bad |= not good.all()
        return [(a[at[i]: at[i + 1]], b[bt[i]: bt[i + 1]]) if ok else BAD for i, ok in enumerate(good.tolist())]

    def a_ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(words, add_special_tokens=False)]

    def encode(self, windows: list[str]) -> list[tuple | None]:
        """The same for windows of text, from words tokenised once; ``None`` for
        a window with a bad word."""
        if len(self.kept) >= KEEP_WORDS:
            self.kept, self.older = {}, self.kept
        kept, cut = self.kept, [_CUT.split(text) for text in windows]
        missing = set().union(*cut) - kept.keys()
        again = missing & self.older.keys()
        kept.update((w, self.older[w]) for w in again)
        new = list(missing - again)
        kept.update(zip(new, self.words(new), strict=True))
        out = []
        for words in cut:
            ids = list(map(kept.__getitem__, words))
            out.append(None if self.any_bad and BAD in ids else (b"".join([x[0] for x in ids]), b"".join([x[1] for x in ids])))
        for w in new:
            if len(w) > KEEP_CHARS:
                del kept[w]
        return out


def digits(n: int) -> np.ndarray:
    """For ids below ``n`` a comma and the decimal digits, zero bytes after them."""
    width = len(str(n - 1))
    return np.array([list(b"," + str(i).encode().ljust(width, b"\0")) for i in range(n)], np.uint8)


def windows_of(text: str | None, size: int = WINDOW) -> Iterator[str]:
    """A space and the text, in pieces of about ``size`` characters."""
    if not text:
        return
    text, at = " " + text, 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at: cut.start()]
        at = cut.start()
    yield text[at:]


class Aligned:
    """The alignment of a batch of windows. ``link_a[k]`` and ``link_b[k]`` are
    the tokens that end group ``k``; ``window`` is the window of each group."""

    def __init__(self, v: Vocabularies, encoded: list[tuple]):
        pairs = [x or (b"", b"") for x in encoded]
        self.v, self.n = v, len(pairs)
        self.ids_a, self.ids_b = (np.frombuffer(b"".join(p[k] for p in pairs), np.int32).astype(np.int64) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(p[k]) // 4 for p in pairs], np.int64) for k in (0, 1))
        self.end_a, self.end_b = np.cumsum(v.size_a[self.ids_a]), np.cumsum(v.size_b[self.ids_b])
        start_a, start_b = self.end_a - v.size_a[self.ids_a], self.end_b - v.size_b[self.ids_b]
        self.of_a, self.of_b = np.repeat(np.arange(self.n), self.n_a), np.repeat(np.arange(self.n), self.n_b)
        a = pd.DataFrame({"start": start_a, "doc": self.of_a, "a": np.arange(len(start_a))})
        b = pd.DataFrame({"start": start_b, "doc": self.of_b, "b": np.arange(len(start_b))})
        # each start's covering token: the last one of the other side that begins there or before
        cover_a = pd.merge_asof(a, b, on="start", by="doc")["b"].to_numpy(np.int64)
        cover_b = pd.merge_asof(b, a, on="start", by="doc")["a"].to_numpy(np.int64)
        later = start_a[cover_b] != start_b  # pairs that begin together are found from both sides
        self.over_a = np.concatenate([a["a"].to_numpy(), cover_b[later]])
        self.over_b = np.concatenate([cover_a, b["b"].to_numpy()[later]])
        together = self.end_a[self.over_a] == self.end_b[self.over_b]
        link_a, link_b = self.over_a[together], self.over_b[together]
        order = np.argsort(link_a, kind="stable")
        self.link_a, self.link_b = link_a[order], link_b[order]
        self.window = self.of_a[self.link_a]

    def counts(self) -> dict[str, np.ndarray]:
        per = lambda x: np.bincount(x, minlength=self.n)
        return {"n_a": self.n_a, "n_b": self.n_b, "n_groups": per(self.window), "n_links": per(self.window), "n_overlaps": per(self.of_a[self.over_a])}

    def link_pairs(self) -> np.ndarray:
        """Number in ``Vocabularies.pairs`` of every link."""
        return np.searchsorted(self.v.pairs, self.ids_a[self.link_a] * len(self.v.bytes_b) + self.ids_b[self.link_b])

    def spelled(self) -> list[bytes]:
        """``;a1,a2|b1`` for all groups of each window."""
        group_a, group_b = np.zeros(len(self.ids_a), np.int64), np.zeros(len(self.ids_b), np.int64)
        for group, last in ((group_a, self.link_a), (group_b, self.link_b)):
            group[last[:-1] + 1] = 1
            np.cumsum(group, out=group)
        # a group's B tokens follow its A tokens
        place_a = np.arange(len(group_a)) + np.concatenate([[0], self.link_b + 1])[group_a]
        place_b = np.arange(len(group_b)) + (self.link_a + 1)[group_b]
        first_a, first_b = np.diff(group_a, prepend=-1) > 0, np.diff(group_b, prepend=-1) > 0
        rows = np.empty((len(group_a) + len(group_b), self.v.digits.shape[1]), np.uint8)
        rows[place_a], rows[place_b] = self.v.digits[self.ids_a], self.v.digits[self.ids_b]
        rows[place_a[first_a], 0], rows[place_b[first_b], 0] = ord(";"), ord("|")
        used = rows != 0
        flat = rows[used].tobytes()
        cut = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [flat[s:e] for s, e in zip(cut, cut[1:], strict=False)]


_loaded: dict[str, Vocabularies] = {}


def _vocabularies(shared) -> Vocabularies:
    """One pair of tokenizers per worker process and broadcast."""
    if shared.value[0] not in _loaded:
        _loaded.clear()
        _loaded[shared.value[0]] = Vocabularies(*shared.value[1:])
    return _loaded[shared.value[0]]


def share(spark, a_file: str, b_file: str):
    """Broadcast of the two files (their size is the vocabularies', about 2 MB)."""
    with open(a_file, "rb") as f, open(b_file, "rb") as g:
        a, b = f.read(), g.read()
    return spark.sparkContext.broadcast((hashlib.sha256(a + b).hexdigest(), a, b))


def _batched(batches: Iterator[pa.RecordBatch], text: str, ident: str, v: Vocabularies, size: int) -> Iterator[tuple]:
    """(ids of documents, document number and text of windows): whole rows, but
    for a long text, whose windows come one by one; ``None`` ends such a row."""
    for batch in batches:
        rows: list[int] = []
        held: list[tuple[int, str]] = []
        chars = 0
        for i, t in enumerate(batch[text].to_pylist()):
            for w in windows_of(t, size):
                held.append((i, w))
                chars += len(w)
                if chars >= size:
                    yield batch[ident], rows, held
                    rows, held, chars = [], [], 0
            rows.append(i)
        yield batch[ident], rows, held


def _documents(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared, size: int) -> Iterator[pa.RecordBatch]:
    v = _vocabularies(shared)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
    open_: dict[int, dict] = {}  # documents of which a window was aligned
    for ids, rows, held in _batched(batches, text, ident, v, size):
        encoded = v.encode([w for _, w in held])
        got = Aligned(v, encoded)
        counts = got.counts()
        spelled = got.spelled()
        links = got.link_pairs()
        pairs, times = np.unique(got.window * len(v.pairs) + links, return_counts=True)
        cut = np.searchsorted(pairs, np.arange(got.n + 1) * len(v.pairs))
        for k, (i, _) in enumerate(held):
            d = open_.setdefault(i, {"bad": False, "sha": hashlib.sha256(), "n": [0] * len(names), "pairs": [], "times": [], "any": False})
            d["bad"] |= encoded[k] is None
            d["sha"].update(spelled[k] if d["any"] else spelled[k][1:])
            d["any"] = True
            d["n"] = [x + int(counts[c][k]) for x, c in zip(d["n"], names, strict=True)]
            d["pairs"].append(pairs[cut[k]: cut[k + 1]] - k * len(v.pairs))
            d["times"].append(times[cut[k]: cut[k + 1]])
        done = [open_.pop(i, None) for i in rows]
        done = [None if d is None or d["bad"] else d for d in done]
        size_of = [sum(map(len, d["pairs"])) if d else 0 for d in done]
        off = pa.array(np.cumsum([0, *size_of]), pa.int32())
        flat = lambda key: np.concatenate([np.zeros(0, np.int64), *[x for d in done if d for x in d[key]]])  # noqa: E731, B023
        yield pa.record_batch(
            [ids.take(pa.array(rows, pa.int64())), *[pa.array([d["n"][j] if d else 0 for d in done], pa.int64()) for j in range(len(names))],
             pa.array([d["sha"].hexdigest() if d else "" for d in done], pa.string()),
             pa.ListArray.from_arrays(off, pa.array(flat("pairs"), pa.int32())), pa.ListArray.from_arrays(off, pa.array(flat("times"), pa.int32()))],
            names=[ident, *names, "groups_sha256", "pairs", "times"])


def _totals(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        pairs, times = (batch[c].flatten().to_numpy() for c in ("pairs", "times"))
        total += np.bincount(pairs, weights=times, minlength=size).astype(np.int64)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], names=["pair", "n"])


def _judged(batches: Iterator[pa.RecordBatch], counts) -> Iterator[pa.RecordBatch]:
    total, best = counts.value
    for batch in batches:
        pairs, times = (batch[c].flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
        off = batch["pairs"].offsets.to_numpy() - batch["pairs"].offsets[0].as_py()
        up_to = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
        keep = [c for c in batch.schema.names if c not in ("pairs", "times")]
        yield pa.record_batch([*[batch[c] for c in keep], pa.array(up_to(times * best[pairs])), pa.array(up_to(times * total[pairs]))],
                              names=[*keep, "n_best", "count_sum"])


def report(docs: DataFrame, a_file: str, b_file: str, text: str = "text", ident: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per document: numbers of tokens, groups, links and overlapping
    pairs, the digest of the groups, how many links are their B token's most
    frequent over all documents, and the sum of the links' counts.

    The texts are tokenised once; the documents' links wait in the shared folder
    until those of all documents are counted."""
    spark = docs.sparkSession
    shared = share(spark, a_file, b_file)
    v = _vocabularies(shared)
    numbers = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")]
    lists = [T.StructField(c, T.ArrayType(T.IntegerType(), False)) for c in ("pairs", "times")]
    schema = T.StructType([*fields(docs, ident), *numbers, T.StructField("groups_sha256", T.StringType()), *lists])
    path = session.scratch_path(spark, "token-links")
    docs.select(ident, text).mapInArrow(lambda it: _documents(it, text, ident, shared, window), schema).write.parquet(path)
    linked = spark.read.schema(schema).parquet(path)
    size = len(v.pairs)
    per_pair = (linked.select("pairs", "times").mapInArrow(lambda it: _totals(it, size), "pair int, n long")
                .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())  # ``size`` rows at most
    total = np.zeros(size, np.int64)
    total[per_pair["pair"].to_numpy(np.int64)] = per_pair["n"].to_numpy(np.int64)
    of_b = v.pairs % len(v.bytes_b)
    most = np.zeros(len(v.bytes_b), np.int64)
    np.maximum.at(most, of_b, total)
    counts = spark.sparkContext.broadcast((total, (total == most[of_b]).astype(np.int64)))
    out = T.StructType([*schema.fields[:-2], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return linked.mapInArrow(lambda it: _judged(it, counts), out)


def _groups(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared, size: int) -> Iterator[pa.RecordBatch]:
    v = _vocabularies(shared)
    for batch in batches:
        for i, t in enumerate(batch[text].to_pylist()):
            encoded = [(w, v.encode([w])[0]) for w in windows_of(t, size)]
            if any(x is None for _, x in encoded):
                continue
            base = begun = 0
            for w, x in encoded:
                got = Aligned(v, [x])
                n = len(got.link_a)
                lists, ends = [], got.end_a[got.link_a] + base
                for ids, last in ((got.ids_a, got.link_a), (got.ids_b, got.link_b)):
                    lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last + 1]), pa.int32()), pa.array(ids, pa.int32())))
                starts = np.concatenate([[base], ends[:-1]])
                yield pa.record_batch([batch[ident].take(pa.array(np.full(n, i))), pa.array(np.arange(begun, begun + n)), *lists, pa.array(starts), pa.array(ends)],
                                      names=[ident, "group", "a", "b", "start", "end"])
                base, begun = base + len(w.encode()), begun + n


def groups(docs: DataFrame, a_file: str, b_file: str, text: str = "text", ident: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The groups themselves: document, number, ids of both sides and the byte
    range in a space and the text."""
    shared = share(docs.sparkSession, a_file, b_file)
    ids = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*fields(docs, ident), T.StructField("group", T.LongType()), T.StructField("a", ids), T.StructField("b", ids),
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return docs.select(ident, text).mapInArrow(lambda it: _groups(it, text, ident, shared, window), schema)
