"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads runs of letters byte by byte, forwards and backwards, and
labels every position with language probabilities. Its state starts anew at each
run (runs of more than ``SEGMENT`` bytes are cut), so equal runs get equal labels
and are computed once per slice of text, however often they occur. A document's
probabilities pool the log-probabilities of all its positions: the mean over a
run, added up over the runs.

It is trained in numpy by backpropagation through time (Adam) on the most
frequent runs of at most ``MAX_DOCS`` labelled documents, each run with the
languages that it was seen in; the rest of the corpus is only predicted. Both
bounds are shared out among the languages: each gets the same quota of documents
and of runs, and what a rare one leaves over goes to the others.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when nothing could be learned; every label of the training
rows that has a text with a letter is learned, and more than ``MAX_LANGS`` labels
are an error; training rows with equal id and label count once, rows with a null
id once per text; ties go to the first language in alphabetical order; columns
other than the id, the text and (for training rows) the label are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkiln.llm.common import LOWER, fields, ranges, slices, text_buffer, word_bounds, word_hashes

#: Training rows, runs and languages at most.
MAX_DOCS, MAX_RUNS, MAX_LANGS = 4_000, 24_000, 64
SEGMENT, HIDDEN, EPOCHS, BATCH, STEP = 24, 20, 14, 256, 4e-3
#: Runs whose labels a worker keeps, and bytes of text worked on at once.
KEEP, SLICE = 500_000, 4 << 20

LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True


def runs_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the letter runs, first run of each row."""
    data, offsets = text_buffer(col)
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets, LETTER)
    pieces = -(-(ends - starts) // SEGMENT)
    if len(pieces) and pieces.max() > 1:
        which = np.repeat(np.arange(len(starts)), pieces)
        starts = starts[which] + SEGMENT * ranges(np.zeros(len(pieces), np.int64), pieces)
        ends = np.minimum(starts + SEGMENT, ends[which])
    return data, starts, ends, np.searchsorted(starts, offsets)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters: per direction the gate inputs of every byte (``x``), the
    recurrent weights (``u``), their bias (``c``) and the output weights (``o``);
    the output bias ``b``. Gates stand in the order update, reset, candidate."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 5):
        r, n = np.random.default_rng(seed), len(languages)
        self.languages, self.hidden = languages, hidden
        self.p = {"b": np.zeros(n, np.float32)}
        for d in "fb":
            self.p[f"x{d}"] = (r.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
            self.p[f"u{d}"] = (r.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
            self.p[f"c{d}"] = np.zeros(3 * hidden, np.float32)
            self.p[f"o{d}"] = (r.standard_normal((hidden, n)) / np.sqrt(hidden)).astype(np.float32)

    def states(self, text: np.ndarray, d: str, keep: list | None = None) -> list[np.ndarray]:
        """States after each position of equally long runs (rows), in text order."""
        n, h = self.hidden, np.zeros((len(text), self.hidden), np.float32)
        x, u, c = self.p[f"x{d}"], self.p[f"u{d}"], self.p[f"c{d}"]
        out = [h] * text.shape[1]
        for t in range(text.shape[1]) if d == "f" else reversed(range(text.shape[1])):
            g, a = x[text[:, t]], h @ u + c
            gates = sigmoid(g[:, : 2 * n] + a[:, : 2 * n])
            z, r = gates[:, :n], gates[:, n:]
            m = np.tanh(g[:, 2 * n:] + r * a[:, 2 * n:])
            new = m + z * (h - m)
            if keep is not None:
                keep.append((t, z, r, m, a[:, 2 * n:], h))
            out[t] = h = new
        return out

    def labels(self, text: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Log-probabilities (row, position, language)."""
        steps = {d: [] if kept is not None else None for d in "fb"}
        hf, hb = (self.states(text, d, steps[d]) for d in "fb")
        logit = np.stack([f @ self.p["of"] + b @ self.p["ob"] for f, b in zip(hf, hb, strict=True)], axis=1) + self.p["b"]
        logit -= logit.max(axis=2, keepdims=True)
        if kept is not None:
            kept.update(f=(hf, steps["f"]), b=(hb, steps["b"]))
        return logit - np.log(np.exp(logit).sum(axis=2, keepdims=True))

    def gradients(self, text: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[dict, float]:
        """Of the weighted cross-entropy of all positions."""
        kept: dict = {}
        logp = self.labels(text, kept)
        share = (weight / (weight.sum() * text.shape[1])).astype(np.float32)[:, None, None]
        dl = (np.exp(logp) - target[:, None, :]) * share
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["b"] = dl.sum(axis=(0, 1))
        n = self.hidden
        for d in "fb":
            h, steps = kept[d]
            u, carry = self.p[f"u{d}"], np.zeros((len(text), n), np.float32)
            for t, z, r, m, a, before in reversed(steps):
                grads[f"o{d}"] += h[t].T @ dl[:, t]
                dh = carry + dl[:, t] @ self.p[f"o{d}"].T
                dm = dh * (1 - z) * (1 - m * m)
                dz = dh * (before - m) * z * (1 - z)
                dr = dm * a * r * (1 - r)
                da = np.concatenate([dz, dr, dm * r], axis=1)
                grads[f"u{d}"] += before.T @ da
                grads[f"c{d}"] += da.sum(axis=0)
                np.add.at(grads[f"x{d}"], text[:, t], np.concatenate([dz, dr, dm], axis=1))
                carry = dh * z + da @ u.T
        return grads, float(-(logp * target[:, None, :] * share).sum())

    def train(self, runs: list[bytes], seen: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """``seen``: how often each run occurred in each language."""
        rng = np.random.default_rng(seed)
        weight = np.sqrt(seen.sum(axis=1))
        target = (seen / seen.sum(axis=1, keepdims=True)).astype(np.float32)
        size = np.array([len(r) for r in runs])
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            batches = []
            for n in np.unique(size):
                rows = rng.permutation(np.flatnonzero(size == n))
                batches += [rows[i: i + BATCH] for i in range(0, len(rows), BATCH)]
            rate = STEP * (1 - epoch / epochs)
            for k in rng.permutation(len(batches)):
                rows = batches[k]
                text = np.frombuffer(b"".join(runs[i] for i in rows), np.uint8).reshape(len(rows), -1)
                grads, _ = self.gradients(text, target[rows], weight[rows])
                step += 1
                for name, g in grads.items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    self.p[name] -= (rate * first[name] / (1 - 0.9 ** step)
                                     / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


class Labeller:
    """The network with the labels of runs seen before, in order of their hash."""

    def __init__(self, net: Network):
        self.net, n = net, len(net.languages)
        self.key, self.value = np.zeros(0, np.uint64), np.zeros((0, 2 * n), np.float32)

    def compute(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per run: mean log-probabilities, and share of positions per best language."""
        n = len(self.net.languages)
        out = np.zeros((len(starts), 2 * n), np.float32)
        size = ends - starts
        for k in np.unique(size):
            rows = np.flatnonzero(size == k)
            for i in range(0, len(rows), 4096):
                part = rows[i: i + 4096]
                logp = self.net.labels(data[starts[part][:, None] + np.arange(k)])
                out[part, :n] = logp.mean(axis=1)
                out[part, n:] = (logp.argmax(axis=2)[:, :, None] == np.arange(n)).mean(axis=1)
        return out

    def pool(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per row: probabilities of the languages, and positions per best language."""
        n = len(self.net.languages)
        data, starts, ends, begin = runs_of(col)
        rows = len(begin) - 1
        if not len(starts):
            return np.full((rows, n), 1.0 / n), np.zeros((rows, n))
        hashes, first, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        value = np.zeros((len(hashes), 2 * n), np.float32)
        at = np.minimum(np.searchsorted(self.key, hashes), max(len(self.key) - 1, 0))
        known = self.key[at] == hashes if len(self.key) else np.zeros(len(hashes), bool)
        value[known] = self.value[at[known]]
        new = np.flatnonzero(~known)
        value[new] = self.compute(data, starts[first[new]], ends[first[new]])
        if len(self.key) + len(new) <= KEEP:
            key = np.concatenate([self.key, hashes[new]])
            order = np.argsort(key)
            self.key, self.value = key[order], np.concatenate([self.value, value[new]])[order]
        else:  # keep those of this slice
            self.key, self.value = hashes[:KEEP], value[:KEEP]
        logp, count = np.zeros((rows, n)), np.zeros((rows, n))
        size = (ends - starts).astype(np.float32)
        for c in range(n):
            for out, v in ((logp, value[:, c][inverse]), (count, value[:, n + c][inverse] * size)):
                total = np.concatenate([[0.0], np.cumsum(v, dtype=np.float64)])
                out[:, c] = total[begin[1:]] - total[begin[:-1]]
        p = np.exp(logp - logp.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), count


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for part in slices(batch):
            data, starts, ends, begin = runs_of(part["text"])
            raw = data.tobytes()
            for lang, a, b in zip(part["lang"].to_pylist(), begin[:-1], begin[1:], strict=True):
                seen.update((raw[s:e], lang) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True))
    items = list(seen.items())
    for i in range(0, len(items), 100_000):
        part = items[i: i + 100_000]
        yield pa.record_batch([pa.array([k[0] for k, _ in part], pa.binary()), pa.array([k[1] for k, _ in part], pa.string()),
                               pa.array([n for _, n in part], pa.int64())], names=["run", "lang", "n"])


def quotas(have: dict[str, int], limit: int) -> dict[str, int]:
    """Shares of ``limit`` (one at least): equal, but none more than it has."""
    out: dict[str, int] = {}
    for i, k in enumerate(sorted(have, key=lambda k: (have[k], k))):
        out[k] = max(1, min(have[k], (limit - sum(out.values())) // (len(have) - i)))
    return out


def first_rows(rows: DataFrame, quota: dict[str, int], *order: Column) -> DataFrame:
    """The first rows of each language, as many as its quota."""
    quota_of = F.create_map(*(F.lit(x) for kv in quota.items() for x in kv))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= quota_of[F.col("lang")]).drop("place")


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", ident: str = "doc_id", max_docs: int = MAX_DOCS,
        max_runs: int = MAX_RUNS) -> Network:
    """Network trained on the rows of each language with the lowest hashes of their ids."""
    key = F.when(F.col(ident).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(ident))
    rows = (labelled.filter(F.col(label).isNotNull() & F.col(text).rlike(r"[A-Za-z\x{80}-\x{10FFFF}]"))
            .select(key.alias("key"), F.col(text).alias("text"), F.col(label).cast("string").alias("lang")))
    have = {r["lang"]: max(1, r["n"]) for r in
            rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(have) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in the training rows")
    if not have:
        return Network([])
    langs, quota = sorted(have), quotas(have, max_docs)
    # about twice the quota by a bound on the hash; the lowest of these are taken
    bound = F.create_map(*(F.lit(x) for k in langs for x in (k, (2.0 * quota[k] + 64) / have[k])))
    near = rows.filter(F.col("key").cast("double") / 2.0 ** 64 + 0.5 < bound[F.col("lang")])
    taken = first_rows(near.groupBy("lang", "key").agg(F.min("text").alias("text")), quota, F.col("key")).select("text", "lang")
    counts = taken.mapInArrow(_counts, "run binary, lang string, n long").groupBy("run", "lang").agg(F.sum("n").alias("n")).checkpoint()
    quota = quotas({r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.count("*").alias("n")).collect()}, max_runs)
    top = first_rows(counts, quota, F.desc("n"), F.xxhash64("run"), F.col("run")).select("run").distinct()
    got = counts.join(F.broadcast(top), "run").collect()  # at most max_runs * MAX_LANGS counts
    runs = sorted({bytes(r["run"]) for r in got})
    place = {r: i for i, r in enumerate(runs)}
    seen = np.zeros((len(runs), max(1, len(langs))))
    for r in got:
        seen[place[bytes(r["run"])], langs.index(r["lang"])] += r["n"]
    net = Network(langs)
    if len(langs) > 1:
        net.train(runs, seen)
    return net


def _predict(batches: Iterator[pa.RecordBatch], ident: str, shared) -> Iterator[pa.RecordBatch]:
    net = shared.value
    labeller, names = Labeller(net), np.array([*net.languages, "und"], dtype=object)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            letters = part["letters"].to_numpy(zero_copy_only=False).astype(bool)
            if net.languages:
                p, count = labeller.pool(part["text"])
                best = np.where(letters, p.argmax(axis=1), len(net.languages))
                score = np.where(letters, p.max(axis=1), 0.0)
                row = np.arange(len(p))
                share = np.where(letters, count[row, p.argmax(axis=1)] / np.maximum(count.sum(axis=1), 1), 0.0)
            else:
                best, score, share = np.zeros(len(letters), np.int64), np.zeros(len(letters)), np.zeros(len(letters))
            yield pa.record_batch([part[ident], pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(share)],
                                  names=[ident, "lang_pred", "score", "share"])


def predict(docs: DataFrame, net: Network, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``ident``, ``lang_pred``, ``score`` (pooled probability) and ``share``
    (of the positions labelled with the predicted language)."""
    letters: Column = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*fields(docs, ident), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("share", T.DoubleType())])
    rows = docs.select(F.col(ident), F.col(text).alias("text"), letters.alias("letters"))
    return rows.mapInArrow(lambda it: _predict(it, ident, shared), schema)


def label_positions(net: Network, text: str) -> list[tuple[int, int, str]]:
    """Byte spans of equal labels of one text, for inspection."""
    data, starts, ends, _ = runs_of(pa.array([text]))
    out: list[tuple[int, int, str]] = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        for i, c in enumerate(net.labels(data[None, s:e])[0].argmax(axis=1)):
            lang = net.languages[c]
            if out and out[-1][1] == s + i and out[-1][2] == lang:
                out[-1] = (out[-1][0], s + i + 1, lang)
            else:
                out.append((s + i, s + i + 1, lang))
    return out
