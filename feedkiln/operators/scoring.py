"""Scoring contract and its bookkeeping (SCR-1..5, CLN-16, JOIN-3, FIL-12,
AGG-5..7, WIN-4).

A scorer is any callable ``list[str] -> list[(label, confidence)]``; it is
built once per task by a factory and called once per group of ``batch_size``
texts inside ``mapInPandas`` (Arrow batches in, Arrow batches out). The
default scorer is a small word lexicon; the same lexicon also runs as a pure
Spark job (``lexicon_scores``) with no Python in the path.
"""

from __future__ import annotations

import re
from typing import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkiln.operators.dedup import latest_per_key

# Fixed values (scoring parameters).
BATCH_SIZE = 50
CONFIDENCE_THRESHOLD = 0.6
NEGATIVE_ALERT_THRESHOLD = 0.4
REACTION_FLAG_RATIO_ABOVE = 0.20
LABELS = ("positive", "negative", "neutral")
SKIPPED = "skipped"
LEXICON_MODEL = "lexicon-v1"

# The default lexicon (our own small list, four languages).
POSITIVE_WORDS = (
    "good", "great", "excellent", "love", "happy", "thanks", "thank", "best", "nice",
    "wonderful", "amazing", "helpful", "glad", "safe", "perfect", "beautiful",
    "bon", "bien", "merci", "super", "gut", "danke", "toll", "bueno", "gracias", "feliz",
)
NEGATIVE_WORDS = (
    "bad", "terrible", "awful", "hate", "angry", "sad", "worst", "poor", "broken", "fail",
    "failed", "problem", "danger", "wrong", "ugly", "horrible",
    "mal", "mauvais", "triste", "schlecht", "nicht", "malo", "peor", "problema",
)
_TOKEN = re.compile(r"[^\w]+", re.UNICODE)


def _label(pos: int, neg: int) -> tuple[str, float]:
    hits = pos + neg
    if hits == 0:
        return "neutral", 0.5
    conf = round(0.5 + 0.5 * abs(pos - neg) / hits, 4)
    return ("positive" if pos > neg else "negative" if neg > pos else "neutral"), conf


class LexiconScorer:
    """Default scorer: counts lexicon words; the contract is the same as a model's."""

    def __init__(self):
        self.pos, self.neg = set(POSITIVE_WORDS), set(NEGATIVE_WORDS)

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            toks = [w for w in _TOKEN.split((t or "").lower()) if w]
            out.append(_label(sum(w in self.pos for w in toks), sum(w in self.neg for w in toks)))
        return out


def score_batches(df: DataFrame, id_col: str, text_col: str,
                  scorer_factory: Callable[[], Callable[[list[str]], list[tuple[str, float]]]] = LexiconScorer,
                  batch_size: int = BATCH_SIZE, model_name: str = LEXICON_MODEL, keep: list[str] | None = None) -> DataFrame:
    """SCR-1: ``(id, text) -> (id, sentiment_label, confidence_score, model_name)``,
    and the columns ``keep`` of the rows."""
    keep = keep or []
    kept = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        scorer = scorer_factory()  # once per task
        for pdf in batches:
            labels, confs = [], []
            texts = pdf[text_col].tolist()
            for i in range(0, len(texts), batch_size):
                for lab, conf in scorer(texts[i:i + batch_size]):
                    labels.append(lab)
                    confs.append(float(conf))
            yield pd.DataFrame({id_col: pdf[id_col], "sentiment_label": labels,
                                "confidence_score": confs, "model_name": model_name, **{c: pdf[c] for c in keep}})

    schema = f"{id_col} {id_type}, sentiment_label string, confidence_score double, model_name string{kept}"
    return df.select(id_col, *dict.fromkeys([text_col, *keep])).mapInPandas(run, schema)


def tokens(text: Column) -> Column:
    """Lower-cased word tokens (letters, digits, underscore)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 0)


def lexicon_scores(df: DataFrame, id_col: str, text_col: str, positive: tuple[str, ...] = POSITIVE_WORDS,
                   negative: tuple[str, ...] = NEGATIVE_WORDS, model_name: str = LEXICON_MODEL) -> DataFrame:
    """The default scorer JVM-side: tokens that are in the fixed word lists are
    counted within each row, so nothing is shuffled."""
    count = lambda words: F.size(F.filter("_tokens", lambda w: w.isin(*words)))
    hits = df.select(id_col, F.coalesce(tokens(F.col(text_col)), F.array().cast("array<string>")).alias("_tokens")).select(
        id_col, count(positive).alias("pos"), count(negative).alias("neg"))
    n = F.col("pos") + F.col("neg")
    label = (F.when(F.col("pos") > F.col("neg"), "positive").when(F.col("neg") > F.col("pos"), "negative")
             .otherwise("neutral"))
    conf = F.when(n == 0, F.lit(0.5)).otherwise(
        F.round(F.lit(0.5) + F.lit(0.5) * F.abs(F.col("pos") - F.col("neg")) / n, 4))
    return hits.select(id_col, F.col("pos").cast("bigint").alias("pos_hits"),
                       F.col("neg").cast("bigint").alias("neg_hits"),
                       label.alias("sentiment_label"), conf.alias("confidence_score"),
                       F.lit(model_name).alias("model_name"))


def reaction_flag(angry: Column, sad: Column, total: Column,
                  ratio_above: float = REACTION_FLAG_RATIO_ABOVE) -> Column:
    """CLN-16: total 0 -> false; else (angry + sad) / total > ratio, in integers."""
    inv = round(1 / ratio_above)
    exact = abs(1 / ratio_above - inv) < 1e-9
    hit = ((angry + sad) * F.lit(inv) > total) if exact else ((angry + sad) / total > F.lit(ratio_above))
    return F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(False)).otherwise(hit)


def is_accepted(conf: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return conf >= F.lit(threshold)


def unscored(candidates: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-3: candidates without a result row (left anti)."""
    return candidates.join(results.select(*keys), keys, "left_anti")


def eligible(df: DataFrame, has_text: str = "has_text", flags: str = "quality_flag") -> tuple[DataFrame, DataFrame]:
    """FIL-12: (rows to score, rows to record as skipped)."""
    ok = F.col(has_text) & F.col(flags).isNull()
    return df.filter(ok), df.filter(~ok)


def skipped_rows(df: DataFrame, id_col: str, flags: str = "quality_flag", has_text: str = "has_text",
                 keep: list[str] | None = None) -> DataFrame:
    """SCR-4: a ``skipped`` row with the reason in ``model_name`` and confidence 0.0."""
    reason = F.coalesce(F.col(flags), F.when(~F.col(has_text), F.lit("no_text")))
    return df.select(id_col, F.lit(SKIPPED).alias("sentiment_label"),
                     F.lit(0.0).alias("confidence_score"),
                     F.concat(F.lit("skipped:"), reason).alias("model_name"), *(keep or []))


def label_distribution(results: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """AGG-5: rows and share per label (the total is a one-row aggregate)."""
    per = results.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    tot = results.agg(F.count(F.lit(1)).alias("_total"))
    return per.crossJoin(F.broadcast(tot)).select(
        label, "n_rows", F.round(F.col("n_rows") / F.col("_total"), 6).alias("share"))


def negative_alert(results: DataFrame, label: str = "sentiment_label",
                   threshold: float = NEGATIVE_ALERT_THRESHOLD) -> DataFrame:
    """AGG-6: negative share of the run and whether it exceeds the threshold."""
    share = F.avg(F.when(F.col(label) == "negative", 1.0).otherwise(0.0))
    return results.agg(F.count(F.lit(1)).alias("n_rows"),
                        F.round(share, 6).alias("negative_share"),
                        (share > F.lit(threshold)).alias("alert"))


def mean_confidence(results: DataFrame, model: str = "model_name", conf: str = "confidence_score",
                    label: str = "sentiment_label") -> DataFrame:
    """AGG-7: per model, scored rows, mean confidence and accepted share."""
    scored = results.filter(F.col(label) != SKIPPED)
    return scored.groupBy(model).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(conf), 6).alias("mean_confidence"),
        F.round(F.avg(F.when(is_accepted(F.col(conf)), 1.0).otherwise(0.0)), 6).alias("accepted_share"))


def current_model(results: DataFrame, keys: list[str], analyzed_at: str = "analyzed_at",
                  model: str = "model_name") -> DataFrame:
    """WIN-4: per source, the row of the newest model run."""
    return latest_per_key(results, keys, [analyzed_at, model])


def result_rows(scored: DataFrame, source_type: str, id_col: str, text: Column | None,
                analyzed_at: str, flagged: Column | None = None,
                language: Column | None = None, origin: Column | None = None) -> DataFrame:
    """SCR-3: rows of the results table; ``sentiment_id`` is a hash of the merge key."""
    sid = F.col(id_col).cast("string")
    return scored.select(
        F.sha2(F.concat_ws("|", F.lit(source_type), sid, F.col("model_name")), 256).alias("sentiment_id"),
        F.lit(source_type).alias("source_type"), sid.alias("source_id"),
        (origin if origin is not None else F.lit(None).cast("string")).alias("origin_source_id"),
        (text if text is not None else F.lit(None).cast("string")).alias("text_analyzed"),
        F.col("sentiment_label"), F.col("confidence_score").cast("double").alias("confidence_score"),
        (flagged if flagged is not None else F.lit(None).cast("boolean")).alias("is_reaction_flagged"),
        (language if language is not None else F.lit(None).cast("string")).alias("detected_language"),
        F.col("model_name"), F.lit(analyzed_at).cast("timestamp").alias("analyzed_at"))
