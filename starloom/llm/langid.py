"""Language ID (5): nearest centroid by cosine over TF-IDF letter n-grams.

A text's vector counts its byte n-grams of 1, 2 and 3 bytes inside words (lower
case, each word between blanks) in FEATURES hashed places, as 1 + log(count),
weighted by inverse document frequency and normalised.  Each language has up to
CENTROIDS centroids, found by spherical k-means on its vectors.  A text gets the
language of the nearest centroid; the score is the cosine, from 0 to 1.

Rejection is by distance: a text is rejected if it has no letter, or if its
cosine distance to the nearest centroid is beyond that centroid's radius: SLACK
times the QUANTILE of the distances that its own training texts of the same
length class had (short texts are far from any centroid), and 1 - FLOOR at the
most, the floor of a cosine that shares little but single letters with a
language.  A centroid with fewer than FEW training texts of a length class says
little about their distances: there the floor alone decides.  A quantile doesn't
grow with the corpus as a maximum does.

Document frequencies and radii are aggregates over all labelled rows.  Centroids
are found per language, from all its different texts or (by hash of the text)
about SAMPLE_ROWS of them, repeated texts weighing as often as they occur.  A
language of few rows is learnt from all of them, however large the corpus.  What
is collected and sent is LANGUAGES languages' centroids at the most; more raise
an error.

Defined cases: null text, empty text and text without a letter are ``und`` with
score 0 and rejected; without rows to learn from every text is; a null language
is no label; on equal cosines the first language in order of its name wins;
repeated rows get the same answer; an empty table gives an empty result; only
the id, the text and (to learn) the language are read, whatever other columns
are called.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import fold, give_back, text_of

#: Places of the hashed n-grams.
FEATURES = 1 << 14
#: Centroids per language.
CENTROIDS = 4
#: Different texts of a language that its centroids are found from, about.
SAMPLE_ROWS = 1_000
#: Training texts of a length class that a centroid's radius takes.
FEW = 200
#: The share of the training texts inside a radius, how far beyond it a text may be, and the steps a distance is counted in.
QUANTILE, SLACK, STEPS = 0.999, 1.25, 512
#: The least cosine of texts of 64 n-grams or more and of shorter ones.
FLOOR, FLOOR_SHORT = 0.2, 0.1
#: Languages that can be learnt.
LANGUAGES = 1_000
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - (FEATURES.bit_length() - 1))


def counts(text: str) -> np.ndarray | None:
    """Occurrences of the hashed n-grams; None without a letter."""
    words = _LETTERS.findall(text.lower())
    if not any(c.isalpha() for w in words for c in w):  # superscripts, fractions and other numerals are no letters
        return None
    data = np.frombuffer((" " + " ".join(words) + " ").encode(), np.uint8).astype(np.uint32)
    pair = data[:-1] << np.uint32(8) | data[1:]
    grams = np.concatenate([data | np.uint32(1 << 24), pair | np.uint32(2 << 24), pair[:-1] << np.uint32(8) | data[2:]])
    return np.bincount((grams * _MULTIPLIER >> _SHIFT).astype(np.int64), minlength=FEATURES)


def vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The normalised vector of counts ``n``, at the places ``at``."""
    value = (1 + np.log(n)) * idf[at]
    return (value / np.sqrt(value @ value)).astype(np.float32)


def length_class(n: np.ndarray) -> int:
    return int(np.log2(n.sum()))


def floor(size: int) -> float:
    return FLOOR if size >= 6 else FLOOR_SHORT


class Centroids:
    """Languages, their centroids as rows, and the radius of each by length class."""

    def __init__(self, names: list[str], idf: np.ndarray, centres: np.ndarray, radii: dict[tuple[int, int], float]):
        self.names, self.idf, self.centres, self.radii = names, idf, centres, radii
        self.columns = np.ascontiguousarray(centres.T)
        self.of: dict[str, range] = {}
        for i, name in enumerate(names):
            self.of[name] = range(self.of[name].start if name in self.of else i, i + 1)

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """(language, cosine, rejected)"""
        found = counts(text)
        if found is None or not self.names:
            return UNKNOWN, 0.0, True
        at = np.flatnonzero(found)
        cosine = vector(at, found[at], self.idf) @ self.columns[at]
        best = int(np.argmax(cosine))
        score = float(min(max(cosine[best], 0), 1))
        size = length_class(found)
        radius = self.radii.get((best, size))
        most = 1 - floor(size) if radius is None else min(1 - floor(size), SLACK * radius)
        return self.names[best], score, 1 - score > most

    def own_nearest(self, text: str, lang: str) -> tuple[int, int, float] | None:
        """(centroid, length class, distance) of the nearest centroid of the text's own language."""
        found, own = counts(text), self.of.get(lang)
        if found is None or own is None:
            return None
        at = np.flatnonzero(found)
        cosine = vector(at, found[at], self.idf) @ self.columns[at, own.start : own.stop]
        best = int(np.argmax(cosine))
        return own.start + best, length_class(found), 1 - float(cosine[best])


def _cluster(vectors: np.ndarray, weight: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Spherical k-means of different texts; fewer centroids than k where there are fewer."""
    vectors *= weight[:, None].astype(np.float32)
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), size=min(k, len(vectors)), replace=False)]
    centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    for _ in range(15):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) for c in range(len(centres)) if (own == c).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _frequencies(given: DataFrame) -> tuple[int, np.ndarray]:
    """Texts with a letter, and how many of them have each n-gram place."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(FEATURES + 1, dtype=np.int64)  # the last one: texts
        for batch in batches:
            for text in batch["text"]:
                if (c := counts(text)) is not None:
                    df[:-1] += c > 0
                    df[-1] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"at": at, "n": df[at]})

    out = np.zeros(FEATURES + 1)
    for r in given.select("text").mapInPandas(seen, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # FEATURES + 1 rows at the most
        out[r["at"]] = r["n"]
    return int(out[-1]), out[:-1]


def _sample(given: DataFrame) -> DataFrame:
    """lang, text, n: all different texts of a language with few, about SAMPLE_ROWS of the others, and how often each occurs."""
    of = F.xxhash64("text", F.lit(5))  # by text alone: copies are taken or left together
    sizes = given.groupBy("lang").agg(F.approx_count_distinct(of).alias("texts"))
    share = F.ceil(F.least(F.lit(1.0), F.lit(1.2) * SAMPLE_ROWS / F.col("texts")) * 1_000_000_000)
    taken = given.join(F.broadcast(sizes), "lang").where(F.pmod(of, F.lit(1_000_000_000)) < share)
    return taken.groupBy("lang", "text").agg(F.count("*").alias("n"))


def _centres(sample: DataFrame, idf: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Names and centroids, by name."""

    def clustered(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("text")
        vectors, weight = np.zeros((len(part), FEATURES), dtype=np.float32), []
        for text, n in zip(part["text"], part["n"]):
            if (c := counts(text)) is not None:
                at = np.flatnonzero(c)
                vectors[len(weight), at] = vector(at, c[at], idf)
                weight.append(n)
        vectors = vectors[: len(weight)]
        centres = _cluster(vectors, np.array(weight), CENTROIDS) if weight else vectors
        return pd.DataFrame({"lang": part["lang"].iloc[0], "n": range(len(centres)), "centre": [c.astype("<f4").tobytes() for c in centres]})

    rows = sorted(sample.groupBy("lang").applyInPandas(clustered, "lang string, n int, centre binary").collect(), key=lambda r: (r["lang"], r["n"]))
    if len({r["lang"] for r in rows}) > LANGUAGES:
        raise ValueError(f"language ID learns {LANGUAGES} languages at the most")
    centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in rows]) if rows else np.zeros((0, FEATURES), np.float32)
    return [r["lang"] for r in rows], centres


def _radii(given: DataFrame, model: Centroids) -> dict[tuple[int, int], float]:
    """The QUANTILE of the distances around each centroid by length class, over all training texts."""
    sent = given.sparkSession.sparkContext.broadcast(model)

    def distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if (found := sent.value.own_nearest(text, lang)) is not None:
                    centre, size, far = found
                    met[centre, size, min(int(max(far, 0) * STEPS), STEPS)] += 1
        yield pd.DataFrame([(*k, n) for k, n in met.items()], columns=["centre", "size", "step", "n"])

    rows = given.select("text", "lang").mapInPandas(distances, "centre int, size int, step int, n long").groupBy("centre", "size", "step").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("centre", "size")  # STEPS rows at the most
    rows = rows.withColumn("all", F.sum("n").over(of)).withColumn("below", F.sum("n").over(of.orderBy("step")))
    inside = rows.where((F.col("all") >= FEW) & (F.col("below") >= F.col("all") * QUANTILE)).groupBy("centre", "size").agg(F.min("step").alias("step"))
    return {(r["centre"], r["size"]): (r["step"] + 1) / STEPS for r in inside.collect()}  # a row per centroid and length class at the most


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> Centroids:
    """Learns from labelled rows whose fold of the id isn't 0."""
    key = F.col(id_col)
    given = docs.where(F.col(lang_col).isNotNull() & (fold(key, folds) != 0)).select(text_of(F.col(text_col)).alias("text"), F.col(lang_col).alias("lang"))
    n, df = _frequencies(given)
    idf = np.log((1 + n) / (1 + df)) + 1
    names, centres = _centres(_sample(given), idf)
    model = Centroids(names, idf, centres, {})
    return Centroids(names, idf, centres, _radii(given, model))


def answers(docs: DataFrame, model: Centroids, text_col: str = "text") -> Column:
    """lang_pred, score and rejected of a text column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def answered(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            yield pd.DataFrame([model.nearest(t) for t in batch], columns=["lang_pred", "score", "rejected"])
        give_back()

    return answered(text_of(F.col(text_col)))


def predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score, rejected per row of ``docs``."""
    model = train(docs, id_col, text_col, lang_col)
    out = docs.select(F.col(id_col), (fold(F.col(id_col), 5) == 0).alias("held_out"), answers(docs, model, text_col).alias("a"))
    return out.select(id_col, "held_out", "a.lang_pred", "a.score", "a.rejected")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, all columns kept."""
    return docs.where(~answers(docs, train(docs, id_col, text_col, lang_col), text_col)["rejected"])
