"""Toxicity (7): class-conditional Kneser-Ney models over the letters of words.

An expression is up to CONTEXT letters before a letter, in its word, with the
word's start and end as letters of their own.  One interpolated Kneser-Ney
model over the counts of both classes, backing off through shared continuation
counts, says how often each class would show an expression if the class made no
difference.  A class's own model keeps of its count only what exceeds that
expectation by more than a discount, so that rare expressions, and those whose
frequency merely follows the mix of languages, rest on the shared backoff and
weigh nothing:

    log p(letter | context, class) - log p_shared = log((E + excess + 1) / (E + 1)),
    excess = max(0, count - E - (1 + 2 sqrt(E) + E / 2))

A text's measure is the toxic minus the ordinary log-likelihood of its different
words, divided by the square root of their number.  The score is a logistic
function of it, fitted on labelled rows that the models haven't seen; the score
of a text without words is that of a measure of 0.

Counts are of documents per word (repeats within a text count once).  Models
learn from a sample of labelled rows: of each class all, or as many (by hash of
the id) as hold its SAMPLE_BYTES of text; ordinary rows count more where they
are sampled more thinly, so that both classes keep their shares.  This bounds
what is collected: expressions with their counts, and a histogram for the
logistic function.

Defined cases: null text counts as empty text; labels are joined by id, the
largest label of an id counts, null labels and ids don't; without a toxic or
without an ordinary row to learn from every score is 0; repeated rows get the
same score; an empty table gives an empty result; only the id and the text are
read, whatever other columns are called.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fold, give_back, stored, text_of

#: Letters of context, the word's start included.
CONTEXT = 7
#: Kneser-Ney discount of the shared model.
DISCOUNT = 0.75
#: Bytes of ordinary and of toxic labelled text that the models learn from at the most.
SAMPLE_BYTES = 6_000_000, 4_000_000
#: Words remembered per Python worker; the table starts anew beyond it.
WORDS_KEPT = 100_000
_WORD = re.compile(r"[^\W\d_]+")
_STEP = 0.01


def word_set(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def expressions(word: str) -> list[str]:
    """Context and letter for each letter of the word and its end."""
    s = f"^{word}$"
    return [s[max(0, i - CONTEXT) : i + 1] for i in range(1, len(s))]


def _counts(rows: DataFrame) -> DataFrame:
    """rows: toxic, text.  Documents of either class per expression, summed over words."""

    def per_word(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for toxic, text in zip(batch["toxic"], batch["text"]):
                seen.update((w, toxic) for w in word_set(text))
        yield pd.DataFrame([(w, n * (1 - t), n * t) for (w, t), n in seen.items()], columns=["word", "ordinary", "toxic"])

    def per_expression(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ordinary: Counter = Counter()
        toxic: Counter = Counter()
        for batch in batches:
            for w, o, t in zip(batch["word"], batch["ordinary"], batch["toxic"]):
                for e in expressions(w):
                    ordinary[e] += o
                    if t:
                        toxic[e] += t
        yield pd.DataFrame([(e, n, toxic[e]) for e, n in ordinary.items()], columns=["e", "ordinary", "toxic"])

    words = rows.mapInPandas(per_word, "word string, ordinary long, toxic long").groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    return words.mapInPandas(per_expression, "e string, ordinary long, toxic long").groupBy("e").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def shared_probabilities(counts: DataFrame) -> DataFrame:
    """e, ordinary, toxic and p of each expression: interpolated Kneser-Ney over the counts of both classes.

    Whole expressions count as often as they were met; shorter ones, which only
    longer ones lead to, by the number of different letters before them.  One
    aggregate per length from the longest down, then one join per length up,
    each kept as a table.
    """
    levels, level = {}, None
    for size in range(CONTEXT + 1, 0, -1):
        whole = F.lit(True) if size == CONTEXT + 1 else F.col("e").startswith("^")
        rows = counts.where(F.length("e") == size).select("e", F.when(whole, F.col("ordinary") + F.col("toxic")).otherwise(0.0).alias("n"))
        if level is not None:
            rows = rows.unionByName(level.select(F.expr("substring(e, 2)").alias("e"), F.lit(1.0).alias("n")))
        level = levels[size] = stored(rows.groupBy("e").agg(F.sum("n").alias("n")), "toxicity-level")
    letters = max(1, levels[1].count())
    shorter, found = None, []
    for size in range(1, CONTEXT + 2):
        context = F.left("e", F.length("e") - 1)
        sums = levels[size].groupBy(context.alias("c")).agg(F.sum("n").alias("total"), F.sum(F.least("n", F.lit(DISCOUNT))).alias("freed"))
        rows = levels[size].withColumn("c", context).join(sums, "c")
        if shorter is None:
            rows = rows.withColumn("below", F.lit(1 / letters))
        else:
            rows = rows.join(shorter.select(F.col("e").alias("s"), F.col("p").alias("below")), F.expr("substring(e, 2)") == F.col("s"))
        p = F.when(F.col("total") > 0, (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + F.col("freed") * F.col("below")) / F.col("total")).otherwise(F.col("below"))
        shorter = stored(rows.select("e", p.alias("p")), "toxicity-share")
        found.append(shorter)
    return counts.join(reduce(DataFrame.unionByName, found), "e")


def _gain(count: Column, expected: Column) -> Column:
    excess = F.greatest(F.lit(0.0), count - expected - (1 + 2 * F.sqrt(expected) + expected / 2))
    return F.log((expected + excess + 1) / (expected + 1))


def weights(counts: DataFrame) -> dict[str, float]:
    """Toxic minus ordinary log-likelihood of each expression, where it isn't 0: no more than the sample's expressions."""
    context = F.left("e", F.length("e") - 1)
    seen = counts.groupBy(context.alias("c")).agg(F.sum("ordinary").alias("o"), F.sum("toxic").alias("t")).where("t > 1")  # else neither class can exceed its share
    rows = shared_probabilities(counts).withColumn("c", context).join(seen, "c")
    weight = _gain(F.col("toxic"), F.col("p") * F.col("t")) - _gain(F.col("ordinary"), F.col("p") * F.col("o"))
    found = rows.select("e", weight.alias("w")).where("w != 0").toPandas()
    return dict(zip(found["e"], found["w"]))


def measure(df: DataFrame, table: dict[str, float], text_col: str) -> Column:
    """The measure of a text column."""
    sent = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("double")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        get = sent.value.get

        class Known(dict):
            def __missing__(self, word: str) -> float:
                if len(self) >= WORDS_KEPT:
                    self.clear()
                value = self[word] = sum([get(e, 0.0) for e in expressions(word)])
                return value

        known = Known()
        for batch in batches:
            out = []
            for text in batch:
                words = word_set(text)
                out.append(math.fsum(map(known.__getitem__, words)) / math.sqrt(len(words)) if words else 0.0)
            yield pd.Series(out, dtype="float64")
        known.clear()
        give_back()

    return measured(text_of(F.col(text_col)))


def logistic(x: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, float]:
    """(intercept, slope) of the likeliest logistic function for counts at x, with a weak pull to 0."""
    b = np.zeros(2)
    data = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(data @ b, -30, 30)))
        grad = data.T @ (toxic - (toxic + ordinary) * p) - 1e-3 * b
        step = np.linalg.solve((data * ((toxic + ordinary) * p * (1 - p))[:, None]).T @ data + 1e-3 * np.eye(2), grad)
        b = b + step * min(1, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(b[1], 0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_bytes: tuple[int, int] = SAMPLE_BYTES, folds: int = 5) -> Callable[[DataFrame], Column]:
    """Learns from rows whose fold of the id isn't 0; returns what makes a score column for a frame."""
    key = F.col(id_col)
    known = labels.where(F.col(label_col).isNotNull() & key.isNotNull()).groupBy(key.alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")).where("toxic in (0, 1)")
    given = docs.select(key.alias("id"), text_of(F.col(text_col)).alias("text")).where(key.isNotNull() & (fold(key, folds) != 0))
    size = {r["toxic"]: r["n"] for r in given.select("id", F.octet_length("text").alias("n")).join(known, "id").groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    share = [int(1e6 * min(1.0, most / max(size.get(c, 0), 1))) for c, most in enumerate(sample_bytes)]
    place = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000))
    rows = given.where(place < max(share)).join(known, "id").where(place < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    rows = stored(rows.select("toxic", "text", (fold(F.col("id"), folds) == folds - 1).alias("fit")), "toxicity-sample")
    weight = share[1] / max(share[0], 1)
    counts = _counts(rows.where("not fit")).select("e", (F.col("ordinary") * F.lit(float(weight))).alias("ordinary"), F.col("toxic").cast("double").alias("toxic"))
    table = weights(stored(counts, "toxicity-counts"))
    seen = rows.where("fit").select("toxic", F.round(measure(rows, table, "text") / _STEP).alias("x")).groupBy("x", "toxic").count().toPandas()
    seen = seen.pivot_table(index="x", columns="toxic", values="count", fill_value=0) if len(seen) else seen
    if not len(seen) or 0 not in seen or 1 not in seen:
        return lambda df: F.lit(0.0)
    intercept, slope = logistic(seen.index.to_numpy(float) * _STEP, seen[1].to_numpy(float), seen[0].to_numpy(float) * weight)
    return lambda df: 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * measure(df, table, text_col))))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted per row of ``docs``."""
    score = train(docs, labels, id_col, text_col)(docs)
    out = docs.select(F.col(id_col), (fold(F.col(id_col), 5) == 0).alias("held_out"), score.cast("double").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below one half, all columns kept."""
    return docs.where(train(docs, labels, id_col, text_col)(docs) < 0.5)
