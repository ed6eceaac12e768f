"""Language detection as a Spark job (SCR-2).

A profile ``(lang, gram) -> log P(gram | lang)`` over the character trigrams of
every word is built from labelled text with add-one smoothing, and every document
takes the language with the highest naive-Bayes score of its whole text. Grams the
profile never saw cost the language's smoothing floor, so unseen text does not
favour a language with a large profile. No Python in the path.

A score is a sum over the occurrences of grams, so these are never stored or
shuffled: each looks up the broadcast profile where its text was read, and only
sums per document (or counts per language and gram) leave the task. A profile too
large to broadcast is joined like any table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkiln.operators.partitioning import spread

# N-gram order and the letters kept before n-gramming.
NGRAM = 3
NON_LETTERS = r"[^\p{L}]+"


def doc_grams(df: DataFrame, keep: list[str], text_col: str, n: int = NGRAM) -> DataFrame:
    """``(*keep, gram)``: a row for each character n-gram of every space-padded word
    of the lower-cased letter stream, repeats included.

    Words are cut into overlapping grams by one zero-width look-ahead regexp;
    positional ``substring`` on a long UTF-8 text would rescan it from the start
    for every gram and turn the job quadratic.
    """
    norm = F.regexp_replace(F.lower(F.col(text_col)), NON_LETTERS, " ")
    words = df.select(*keep, F.explode(F.split(norm, " ")).alias("w")).filter(F.length("w") > 0)
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
    return words.select(*keep, F.explode(F.regexp_extract_all(padded, F.lit(f"(?=(.{{{n}}}))"), F.lit(1))).alias("gram"))


#: Languages of a profile at most: one column of sums each.
MAX_LANGUAGES = 200
#: Log-probabilities of a profile that is broadcast, at most (8 bytes each).
MAX_BROADCAST = 8_000_000


def build_profile(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, list[str], list[float]]:
    """``(gram, logp)`` with one log-probability per language, the languages in
    alphabetical order, and each language's floor for grams it never saw."""
    known = labels.filter(F.col(lang_col).isNotNull()).select(id_col, lang_col)
    texts = docs.select(id_col, text_col).join(known, id_col)
    # bounded by languages x distinct grams, and read three times below
    per = doc_grams(texts, [lang_col], text_col).groupBy(lang_col, "gram").agg(F.count("*").alias("c")).checkpoint(eager=True)
    totals = per.groupBy(lang_col).agg(F.sum("c").alias("n")).orderBy(lang_col).limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    vocabulary = per.select("gram").distinct().count()
    langs = [r[lang_col] for r in totals]
    norm = [float(r["n"] + vocabulary) for r in totals]
    logp = [F.log((F.sum(F.when(F.col(lang_col) == la, F.col("c")).otherwise(0)) + 1) / F.lit(n)) for la, n in zip(langs, norm, strict=True)]
    profile = per.groupBy("gram").agg(F.array(*logp).alias("logp")) if langs else per.select("gram", F.array().cast("array<double>").alias("logp"))
    if vocabulary * len(langs) <= MAX_BROADCAST:
        profile = F.broadcast(profile)
    return profile, langs, [math.log(1 / n) for n in norm]


def detect(grams: DataFrame, profile: DataFrame, langs: list[str], floors: list[float], id_col: str,
           out: str = "detected_language") -> DataFrame:
    """Best language per document with grams; ties go to the first language in
    alphabetical order. One join on the gram, one aggregate per document."""
    if not langs:
        return grams.select(id_col, F.lit(None).cast("string").alias(out)).distinct()
    each = grams.join(profile, "gram", "left").groupBy(id_col).agg(
        *[F.sum(F.coalesce(F.get("logp", F.lit(i)), F.lit(f))).alias(f"_s{i}") for i, f in enumerate(floors)])
    scores = [F.struct(F.round(F.col(f"_s{i}"), 6).alias("s"), F.lit(-i).alias("i"), F.lit(la).alias("l")) for i, la in enumerate(langs)]
    return each.select(id_col, F.array_max(F.array(*scores))["l"].alias(out))


def detect_languages(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
                     out: str = "detected_language") -> DataFrame:
    """SCR-2 over a table: every row of ``docs`` with its detected language, NULL
    for a text without letters. ``labelled`` holds the rows to learn from."""
    profile, langs, floors = build_profile(docs, labelled, id_col, text_col, lang_col)
    grams = doc_grams(spread(docs.select(id_col, text_col)), [id_col], text_col)
    return docs.join(detect(grams, profile, langs, floors, id_col, out), id_col, "left")
