"""Toxicity of documents: boosted trees over dense features, with isotonic calibration.

Features of a text: density, number and variety of lexicon hits, hits close to a second-person
word, hits once look-alike digits and signs are read as letters, rates of capitals, of words in
capitals, of exclamation and other punctuation, of repeated signs and of obfuscated words. The
lexicon is learned from labelled texts: whole words and word beginnings that are much more frequent
in toxic ones.

Learning uses at most about ``sample_rows`` labelled documents, chosen by a hash of doc_id; these
bounded rows are the only ones broadcast, collected or shuffled. A third gives the lexicon, a third
the trees, a third the calibration, so that no part judges its own choices. Scoring every document
is one narrow stage.

Defined results: a null or empty text has the score of a text without words; a null label or
id teaches nothing; of repeated labels the highest counts; without labels of both classes every
score is the share of label 1 (0 without labels); other columns are ignored or kept; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import boosting
from marketlake.llm.common import bucket_of

SAMPLE_ROWS = 30_000
LEXICON_TERMS = 4_000
LEAST_SHARE = 0.004
LEAST_LOG_ODDS = 2.5
THRESHOLD = 0.5
NEAR_WORDS = 6
PREFIXES = (4, 5, 6)

WORD = re.compile(r"\w+")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHOUT = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
CLAIM = re.compile(r"[!?]")
SIGN = re.compile(r"[^\w\s]")
REPEATED = re.compile(r"([^\w\s])\1+")
MIXED = re.compile(r"[^\W\d_]+[\d@$*#!+|]+[^\W\d_]+")
LOOKALIKES = str.maketrans("01345789@$!|+", "oieastbgasiit")

#: Second-person words of English, German, French, Spanish, Italian and Portuguese.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner deinen deinem euch euer eure ihr "
    "tu te toi ton ta tes vous votre vos ti contigo usted ustedes vosotros vuestro vuestra tus "
    "tuyo tuya você vocês teu tua seu sua tuo tuoi tue vi voi vostro vostra".split()
)


def terms(text: str) -> set[str]:
    """What the lexicon may hold: words, and beginnings marked with a star."""
    words = {w for w in WORD.findall(text.lower()) if not w.isdigit()}
    found = set(words)
    for n in PREFIXES:
        found |= {f"{w[:n]}*" for w in words if len(w) > n}
    return found


class Weights(dict):
    """The weight of a word in the lexicon, looked up once for each different word."""

    LIMIT = 1_000_000

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        get = self.lexicon.get
        weight = get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                weight = max(weight, get(f"{word[:n]}*", 0.0))
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = weight
        return weight


FEATURES = 18


def features(text: str | None, weights: Weights) -> list[float]:
    text = text or ""
    words = WORD.findall(text.lower())
    n, chars = max(1, len(words)), max(1, len(text))
    weight = list(map(weights.__getitem__, words))
    hits = [k for k, w in enumerate(weight) if w > 0]
    strong = [k for k in hits if weight[k] >= 5.0]
    mixed = MIXED.findall(text)
    plain = sum(weights[m.lower().translate(LOOKALIKES)] > 0 for m in mixed)
    persons = np.array([k for k, w in enumerate(words) if w in SECOND_PERSON])
    close, total = 0, 0.0
    if hits:
        total = sum(weight[k] for k in hits)
        if len(persons):
            at = np.searchsorted(persons, hits)
            after = persons[np.minimum(at, len(persons) - 1)]
            before = persons[np.maximum(at - 1, 0)]
            gap = np.minimum(np.abs(after - hits), np.abs(np.array(hits) - before))
            close = int((gap <= NEAR_WORDS).sum())
    return [
        math.log1p(len(words)),
        len(hits) / n,
        math.log1p(len(hits)),
        math.log1p(len({words[k] for k in hits})),
        math.log1p(len(strong)),
        len(strong) / n,
        total / n,
        max((weight[k] for k in hits), default=0.0),
        math.log1p(close),
        len(persons) / n,
        len(CAPITAL.findall(text)) / chars,
        len(SHOUT.findall(text)) / n,
        len(CLAIM.findall(text)) / n,
        len(SIGN.findall(text)) / chars,
        len(REPEATED.findall(text)) / n,
        len(mixed) / n,
        math.log1p(plain),
        math.log1p(len(hits)) / math.log1p(n),
    ]


def _matrix(texts: pd.Series, weights: Weights) -> np.ndarray:
    return np.array([features(t, weights) for t in texts], float).reshape(len(texts), FEATURES)


class Scorer:
    """A lexicon and a model, small enough to travel with the task."""

    def __init__(self, lexicon: dict[str, float], model: boosting.Model):
        self.lexicon, self.model = lexicon, model

    def score(self) -> Column:
        """The score of the column text."""
        lexicon, model = self.lexicon, self.model

        @F.pandas_udf(T.DoubleType())
        def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights = Weights(lexicon)
            for texts in batches:
                yield pd.Series(model.probability(_matrix(texts, weights)), dtype=float)

        return score_of(F.col("text").cast("string"))


def _part(doc_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("part")), F.lit(parts))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: int = 0,
    modulus: int = 5,
    sample_rows: int = SAMPLE_ROWS,
    lexicon_terms: int = LEXICON_TERMS,
) -> Scorer:
    """Learn from labelled documents whose crc32(doc_id) modulo ``modulus`` is not ``held_out``."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = (
        labels.select(doc_id, F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .where(bucket_of(F.col("doc_id"), modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    )
    # About sample_rows rows of 12 bytes.
    rows = (
        docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        # Copies teach once.
        .groupBy(F.xxhash64("text").alias("version"))
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("toxic").alias("toxic"),
            F.first("text").alias("text"),
        )
    )
    part = _part(F.col("doc_id"), 3)

    def count_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ones, all_rows = Counter(), Counter()
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                found = terms(text)
                found.add("")
                all_rows.update(found)
                if toxic > 0:
                    ones.update(found)
        if all_rows:
            yield pd.DataFrame(
                {
                    "term": list(all_rows),
                    "ones": [ones[t] for t in all_rows],
                    "n": list(all_rows.values()),
                }
            )

    counts = (
        rows.where(part == 0)
        .select("text", "toxic")
        .mapInPandas(count_terms, "term string, ones long, n long")
        .groupBy("term")
        .agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    )
    # The empty term stands for all documents.
    total = counts.where("term = ''").first()
    lexicon: dict[str, float] = {}
    if total and 0 < total["ones"] < total["n"]:
        ones, zeros = total["ones"], total["n"] - total["ones"]
        odds = F.log((F.col("ones") + 0.5) / (ones + 1.0)) - F.log(
            (F.col("n") - F.col("ones") + 0.5) / (zeros + 1.0)
        )
        best = (
            counts.where((F.col("term") != "") & (F.col("ones") >= max(4, LEAST_SHARE * ones)))
            .select("term", odds.alias("odds"))
            .where(F.col("odds") >= LEAST_LOG_ODDS)
            .orderBy(F.desc("odds"), "term")
            .limit(lexicon_terms)
        )
        lexicon = {r["term"]: float(r["odds"]) for r in best.collect()}

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = Weights(lexicon)
        for frame in frames:
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "x": list(_matrix(frame["text"], weights)),
                    "toxic": frame["toxic"],
                    "part": frame["part"],
                }
            )

    seen = (
        rows.select("doc_id", "text", "toxic", part.cast("int").alias("part"))
        .where("part > 0")
        .mapInPandas(measure, "doc_id long, x array<double>, toxic int, part int")
        .toPandas()
        .sort_values("doc_id")
    )
    if not len(seen):
        return Scorer(lexicon, boosting.constant(float(total["ones"] / total["n"]) if total else 0.0))
    model = boosting.fit(
        np.array(seen["x"].tolist()),
        (seen["toxic"] > 0).to_numpy(float),
        (seen["part"] == 2).to_numpy(),
    )
    return Scorer(lexicon, model)


def score_documents(
    docs: DataFrame, labels: DataFrame, *, held_out: int = 0, modulus: int = 5, **sizes: int
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scorer = learn(docs, labels, held_out=held_out, modulus=modulus, **sizes)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .select(
            "doc_id",
            (bucket_of(F.col("doc_id"), modulus) == held_out).alias("held_out"),
            scorer.score().alias("score"),
        )
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **sizes: int) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    return docs.where(learn(docs, labels, **sizes).score() < THRESHOLD)
