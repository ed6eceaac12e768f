"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

The lexicon is learned: whole words and word beginnings (3 to 8 bytes) whose
document counts separate toxic from clean training documents by a G-test.
Dense features per document: densities of strong and weak lexicon hits, hits
that show only after undoing digit and symbol substitutions, hits near a
second-person word, capitals, punctuation, word shapes. Trees are fitted in
numpy with the logistic loss, and their score is calibrated by isotonic
regression. The features of a training row use a lexicon learned without its
fold, and the calibration has a fold of its own, so no step is fitted on rows
that an earlier one has seen.

Fitting takes at most ``MAX_ROWS`` labelled rows (those with the lowest hash of
the id); scoring covers every whole text. Labels, language, source and id are
never features.

Defined results: null and empty texts have all features zero and get the score
that the trees give to that; without labels, or with one class only, every
score is the share of toxic labels (0 without any); a document labelled more
than once counts as toxic if any label says so; repeated rows and texts that tie in
all features get equal scores; a very long text is read whole; an empty table gives
no rows; columns other than the id and the text are not read by the model.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln.llm.common import LOWER, crc, fields, slices, text_buffer, word_bounds, word_hashes

#: Labelled rows used for fitting, and terms of the lexicon, at most.
MAX_ROWS, MAX_TERMS = 20_000, 4_000
#: G statistic of a strong and of a weak term.
STRONG, WEAK = 24.0, 10.0
PREFIXES = (3, 4, 5, 6, 7, 8)
TREES, DEPTH, RATE, BINS, LEAF = 80, 3, 0.15, 32, 5
#: Bytes of text that features are taken from at once.
SLICE = 1 << 20
#: Words between a lexicon hit and a second-person word.
NEAR = 5

# fixed values: second-person words of the languages at hand
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous "
                 "votre vos tú ti tus usted ustedes vosotros").split()

LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True

UNDO = LOWER.copy()
for _from, _to in zip(b"013457@$!", b"oieastasi", strict=True):
    UNDO[_from] = _to
PUNCT = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))
FEATURES = ["strong", "log_strong", "weak", "log_weak", "hidden", "log_hidden", "near_you", "you", "capitals", "shouting",
            "punctuation", "exclaim", "question", "mixed", "stretched", "log_words", "word_length", "weight", "max_weight"]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first eight bytes of the letter runs of lower-cased text."""
    starts, ends = word_bounds(data, offsets, LETTER)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[starts]
    return starts, ends, eight


class Lexicon:
    """Terms as sorted keys per prefix length, and whole words by hash (length 0)."""

    def __init__(self, terms: list[tuple[int, int, float, float]]):
        self.parts = []
        self.gate = np.zeros(1 << 24, bool)  # first three bytes of any term
        for size in (*PREFIXES, 0):
            own = sorted((key % (1 << 64), g, w, gate) for s, key, g, w, gate in terms if s == size)
            if own:
                key, g, w, gate = zip(*own, strict=True)
                self.parts.append((size, np.array(key, np.uint64), np.array(g), np.array(w)))
                self.gate[np.array(gate)] = True

    def weigh(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, eight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest G and weight of the terms that each word meets (0: none)."""
        g, w = np.zeros(len(starts)), np.zeros(len(starts))
        look = np.flatnonzero(self.gate[(eight & np.uint64(0xFFFFFF)).astype(np.int64)] & (ends - starts >= 3))
        if not len(look):
            return g, w
        size = (ends - starts)[look]
        whole = word_hashes(data, starts[look], ends[look])
        for k, keys, gs, ws in self.parts:
            value = whole if k == 0 else eight[look] & np.uint64((1 << 8 * k) - 1)
            at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
            hit = (keys[at] == value) & (size >= k)
            g[look[hit]] = np.maximum(g[look[hit]], gs[at[hit]])
            w[look[hit]] = np.maximum(w[look[hit]], ws[at[hit]])
        return g, w


def _you() -> np.ndarray:
    raw = [w.encode() for w in SECOND_PERSON]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    starts, ends = word_bounds(data, np.array([0, len(data)]), LETTER)
    return np.sort(word_hashes(data, starts, ends))


def features(col: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    raw, offsets = text_buffer(col)
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    if not len(raw):
        return out
    low = LOWER[raw]
    starts, ends, eight = _words(low, offsets)
    begin = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(n), np.diff(begin))
    words = np.maximum(np.diff(begin), 1)

    def per_doc(mask: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        edge = begin if of is None else of
        return (total[edge[1:]] - total[edge[:-1]]).astype(float)

    g, w = lexicon.weigh(low, starts, ends, eight)
    strong, weak = g >= STRONG, (g >= WEAK) & (g < STRONG)
    # substitutions undone: bytes at which the plain text already has a hit don't count again
    plain = UNDO[raw]
    s2, e2, eight2 = _words(plain, offsets)
    odd = np.concatenate([[0], np.cumsum(plain != low)])
    changed = odd[e2] > odd[s2]
    g2, _ = lexicon.weigh(plain, s2[changed], e2[changed], eight2[changed])
    hidden = np.bincount(np.searchsorted(offsets, s2[changed][g2 >= STRONG], "right") - 1, minlength=n).astype(float)
    # second-person words, looked up among the words of their lengths
    short = np.flatnonzero(ends - starts <= 8)
    you = np.zeros(len(starts), bool)
    keys = _YOU
    h = word_hashes(low, starts[short], ends[short])
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    you[short] = keys[at] == h
    where = np.flatnonzero(you)
    hits = np.flatnonzero(strong | weak)
    if len(where) and len(hits):
        right = np.minimum(np.searchsorted(where, hits), len(where) - 1)
        left = np.maximum(right - 1, 0)
        close = np.zeros(len(hits), bool)
        for side in (left, right):
            close |= (np.abs(where[side] - hits) <= NEAR) & (doc[where[side]] == doc[hits])
        near = np.bincount(doc[hits[close]], minlength=n).astype(float)
    else:
        near = np.zeros(n)
    upper = (raw >= 0x41) & (raw <= 0x5A)
    uppers = np.concatenate([[0], np.cumsum(upper)])
    shouting = (uppers[ends] - uppers[starts] == ends - starts) & (ends - starts >= 3)
    same = np.zeros(len(low), bool)
    same[2:] = (low[2:] == low[1:-1]) & (low[2:] == low[:-2]) & LETTER[low[2:]]
    inner = np.zeros(len(low), bool)  # a digit or symbol between two letters
    inner[1:-1] = LETTER[low[:-2]] & LETTER[low[2:]] & ~LETTER[low[1:-1]] & (low[1:-1] > 0x20)
    size = np.maximum(np.diff(offsets), 1)
    n_strong, n_weak = per_doc(strong), per_doc(weak)
    weight = np.bincount(doc, w, n)
    top = np.zeros(n)
    np.maximum.at(top, doc[hits], w[hits])
    out[:] = np.stack([
        n_strong / words, np.log1p(n_strong), n_weak / words, np.log1p(n_weak), hidden / words, np.log1p(hidden), near / words,
        per_doc(you) / words, per_doc(upper, offsets) / size, per_doc(shouting) / words, per_doc(PUNCT[raw], offsets) / size,
        per_doc(raw == 0x21, offsets) / size, per_doc(raw == 0x3F, offsets) / size, per_doc(inner, offsets) / size,
        per_doc(same, offsets) / size, np.log1p(words), per_doc(ends - starts) / words, weight / words, top], axis=1)
    return out


_YOU = _you()


class Trees:
    """Boosted regression trees of equal depth on binned features, and the
    isotonic map from their score to a probability."""

    def __init__(self, base: float):
        self.base = base
        self.cuts: list[np.ndarray] = []
        self.feature = np.zeros((0, (1 << DEPTH) - 1), np.int64)
        self.value = np.zeros((0, (1 << DEPTH) - 1))
        self.leaf = np.zeros((0, 1 << DEPTH))
        self.knots = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1)
        score = np.full(len(y), np.log(self.base / (1 - self.base)))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), np.int64)
            feature, value = np.zeros((1 << DEPTH) - 1, np.int64), np.full((1 << DEPTH) - 1, np.inf)
            for level in range(DEPTH):
                first, n = (1 << level) - 1, 1 << level
                best = np.full(n, 1e-9)
                for f, cuts in enumerate(self.cuts):
                    key = node * (BINS + 1) + binned[:, f]
                    g, h, c = (np.cumsum(np.bincount(key, v, n * (BINS + 1)).reshape(n, -1), axis=1) for v in (grad, hess, np.ones(len(y))))
                    gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                    gain = g ** 2 / (h + 1) + (gt - g) ** 2 / (ht - h + 1) - gt ** 2 / (ht + 1)
                    gain[(c < LEAF) | (ct - c < LEAF)] = 0
                    gain = gain[:, : len(cuts)]
                    if not gain.shape[1]:
                        continue
                    at = gain.argmax(axis=1)
                    won = gain[np.arange(n), at] > best
                    best[won] = gain[won, at[won]]
                    feature[first: first + n][won], value[first: first + n][won] = f, cuts[at[won]]
                node = 2 * node + (x[np.arange(len(y)), feature[first + node]] > value[first + node])
            step = np.bincount(node, grad, 1 << DEPTH) / (np.bincount(node, hess, 1 << DEPTH) + 1)
            self.feature, self.value = np.vstack([self.feature, feature]), np.vstack([self.value, value])
            self.leaf = np.vstack([self.leaf, RATE * step])
            score += RATE * step[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), np.log(self.base / (1 - self.base)))
        rows = np.arange(len(x))
        for feature, value, leaf in zip(self.feature, self.value, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, feature[at]] > value[at])
            score += leaf[node]
        return 1 / (1 + np.exp(-score))

    def calibrate(self, p: np.ndarray, y: np.ndarray) -> None:
        """Isotonic regression by pooling adjacent violators."""
        order = np.argsort(p, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, first and last score
        for s, t in zip(p[order].tolist(), y[order].tolist(), strict=True):
            blocks.append([t, 1.0, s, s])
            while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
                b, a = blocks.pop(), blocks.pop()
                blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
        if blocks:
            xs = [v for b in blocks for v in (b[2], b[3])]
            self.knots = (np.array([0.0, *xs, 1.0]), np.array([blocks[0][0], *(b[0] for b in blocks for _ in (0, 1)), blocks[-1][0]]))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a fiftieth of the uncalibrated one keeps the order inside a block."""
        p = self.raw(x)
        return np.clip(0.98 * np.interp(p, *self.knots) + 0.02 * p, 0, 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each fold and class per term, summed over a task's batches."""
    split = re.compile(r"[^\W\d_]+").findall
    counts: dict[tuple[int, int], Counter] = {}
    for batch in batches:
        for text, toxic, fold in zip(*(batch[c].to_pylist() for c in ("text", "toxic", "fold")), strict=True):
            words = {w.encode() for w in split((text or "").lower())}
            terms = {w[:k] for w in words if len(w) >= PREFIXES[0] for k in PREFIXES if len(w) >= k}
            terms |= {w + b"$" for w in words if len(w) >= PREFIXES[0]}
            counts.setdefault((fold, toxic), Counter()).update(terms)
    for (fold, toxic), count in counts.items():
        terms = list(count)
        for i in range(0, len(terms), 100_000):
            part = terms[i: i + 100_000]
            yield pa.record_batch([pa.array(part, pa.binary()), pa.array([fold] * len(part), pa.int32()), pa.array([toxic] * len(part), pa.int32()),
                                   pa.array([count[t] for t in part], pa.int64())], names=["term", "fold", "toxic", "n"])


def learn_lexicons(sample: DataFrame, folds: list[int]) -> dict[int | None, list[tuple[int, int, float, float, int]]]:
    """Terms (length, key, G, weight, first bytes) from (text, toxic, fold)
    rows: one lexicon without each fold, and one (None) of all."""
    size = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    per = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == c), F.col("n")).otherwise(0)).alias(f"n{f}_{c}") for f in folds for c in (0, 1)]
    counts = (sample.select("text", "toxic", "fold").mapInArrow(_counts, "term binary, fold int, toxic int, n long")
              .groupBy("term").agg(*per).filter(sum(F.col(f"n{f}_1") for f in folds) >= 3).checkpoint())

    def pick(use: list[int]) -> list:
        n0, n1 = (sum(size.get((f, c), 0) for f in use) for c in (0, 1))
        if not n0 or not n1:
            return []
        clean, toxic = (sum((F.col(f"n{f}_{c}") for f in use), F.lit(0)) for c in (0, 1))
        rate = n1 / (n0 + n1)
        part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
        g = 2 * (part(toxic, (clean + toxic) * rate) + part(clean, (clean + toxic) * (1 - rate)))
        weight = F.log((toxic + 0.5) / (n1 + 1.0)) - F.log((clean + 0.5) / (n0 + 1.0))
        return (counts.filter(toxic >= 3).select("term", g.alias("g"), weight.alias("w")).filter(f"g >= {WEAK} and w >= 2")
                .orderBy(F.desc("g"), "term").limit(MAX_TERMS).collect())

    out = {}
    for leave in (*folds, None):
        terms = []
        for r in pick([f for f in folds if f != leave]):
            term, gate = bytes(r["term"]), int.from_bytes(bytes(r["term"])[:3], "little")
            if term.endswith(b"$"):
                data = np.frombuffer(term[:-1], np.uint8)
                terms.append((0, int(word_hashes(data, np.array([0]), np.array([len(data)]))[0]), r["g"], r["w"], gate))
            else:
                terms.append((len(term), int.from_bytes(term, "little"), r["g"], r["w"], gate))
        out[leave] = terms
    return out


def _featured(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    lexicons = {f: Lexicon(terms) for f, terms in shared.value.items()}
    for batch in batches:
        fold = batch["fold"].to_numpy()
        for f in np.unique(fold):
            for part in slices(batch.filter(pa.array(fold == f)), limit=SLICE):
                x = features(part["text"], lexicons[int(f)])
                yield pa.record_batch([part["fold"], part["toxic"], pa.array(list(x), pa.list_(pa.float64()))], names=["fold", "toxic", "x"])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, text: str = "text", ident: str = "doc_id",
        max_rows: int = MAX_ROWS) -> tuple[list, Trees]:
    """Lexicon terms and calibrated trees from documents of the training folds."""
    fold = F.pmod(crc(ident), F.lit(folds)).cast("int")
    rows = (labels.filter(f"toxic is not null and `{ident}` is not null").select(ident, F.col("toxic").cast("int").alias("toxic"))
            .withColumn("fold", fold).filter(F.col("fold") != held_out).groupBy(ident, "fold").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64(ident), ident).limit(max_rows))
    # at most max_rows ids: a bounded broadcast; equal texts count once
    sample = (docs.select(F.col(ident), F.col(text).alias("text")).join(F.broadcast(rows), ident)
              .groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("fold").alias("fold")).checkpoint())
    train = [f for f in range(folds) if f != held_out]
    lexicons = learn_lexicons(sample, train)
    shared = docs.sparkSession.sparkContext.broadcast({f: lexicons[f] for f in train})
    got = sample.mapInArrow(lambda it: _featured(it, shared), "fold int, toxic int, x array<double>").collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    y, f = np.array([r["toxic"] for r in got], float), np.array([r["fold"] for r in got])
    model = Trees(min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6))
    cal = f == train[-1]
    if 0 < y[~cal].sum() < (~cal).sum():
        model.fit(x[~cal], y[~cal])
    if 0 < y[cal].sum() < cal.sum():
        model.calibrate(model.raw(x[cal]), y[cal])
    return lexicons[None], model


def _score(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared) -> Iterator[pa.RecordBatch]:
    terms, model = shared.value
    lexicon = Lexicon(terms)
    for batch in batches:
        for part in slices(batch, text, SLICE):
            yield pa.record_batch([part[ident], pa.array(model.score(features(part[text], lexicon)))], names=[ident, "score"])


def score(docs: DataFrame, model: tuple[list, Trees], text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*fields(docs, ident), T.StructField("score", T.DoubleType())])
    return docs.select(ident, text).mapInArrow(lambda it: _score(it, text, ident, shared), schema)


def _drop(batches: Iterator[pa.RecordBatch], text: str, shared, threshold: float) -> Iterator[pa.RecordBatch]:
    terms, model = shared.value
    lexicon = Lexicon(terms)
    for batch in batches:
        for part in slices(batch, text, SLICE):
            yield part.filter(pa.array(model.score(features(part[text], lexicon)) < threshold))


def remove_toxic(docs: DataFrame, model: tuple[list, Trees], threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The documents that score below the threshold, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda it: _drop(it, text, shared, threshold), docs.schema)
