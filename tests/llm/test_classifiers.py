import base64
import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import langid, toxicity

WORDS = {"en": ["the", "house", "with", "quick", "thing"], "fr": ["le", "maison", "avec", "rapide", "chose"], "de": ["das", "schön", "mit", "schnell", "ding"]}


@pytest.fixture()
def corpus(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) for _ in range(rng.randrange(8, 40))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        rows.append((i, " ".join(words), lang))
        labels.append((i, toxic))
    rows += [(1000, None, None), (1001, "", "en"), (1002, "123 !!", None), (None, "the house", "en"), (1003, "the thing " * 20_000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels + [(1, None), (None, 1), (5000, 1)], "doc_id long, toxic int")


def test_languages(corpus, no_texts):
    docs, _ = corpus
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out and truth[i]]
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[1003].lang_pred == "en"
    assert langid.predictions(no_texts).count() == 0
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({1000, 1001, 1002})
    far = docs.sparkSession.createDataFrame([(1, "qxzjv wqxk " * 50, "xx")], docs.schema)
    assert langid.keep_known(docs.unionByName(far.withColumn("lang", langid.F.lit(None).cast("string")))).where("doc_id = 1 and text like 'qx%'").count() == 0


def test_small_language_in_a_large_corpus(spark, monkeypatch):
    """A language far below the sample's share is learnt whole and kept."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 60)
    rng = random.Random(7)
    words = WORDS | {"es": ["el", "perro", "casa", "rápido", "niño"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for i in range(3000) for lang in ["es" if i % 150 == 0 else rng.choice(list(WORDS))]]
    rows += [(9000 + i, "hola amigo mío qué tal", "one text") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    small = [got[i] for i, _, lang in rows if lang == "es"]
    assert len(small) == 20 and all(r.lang_pred == "es" and not r.rejected for r in small)
    assert not any(got[9000 + i].rejected for i in range(3))
    assert sum(r.rejected for r in got.values()) == 0


OTHERS = {
    "greek": "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει στο δάσος κάθε μέρα " * 3,
    "chinese": "敏捷的棕色狐狸跳过了懒狗然后跑进森林里 每天都是这样 " * 5,
    "hex": " ".join(f"{random.Random(i).getrandbits(128):032x}" for i in range(20)),
    "base64": base64.b64encode(random.Random(1).randbytes(900)).decode(),
    "code": "for (int i = 0; i < n; ++i) { if (arr[i] > max) { max = arr[i]; } } return max; " * 4,
}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test data not present")
def test_rejection_at_two_sizes(spark, folder):
    """Other scripts, encoded bytes and program code are rejected whatever the corpus' size; labelled rows aren't."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.train(docs)
    assert {name for name, text in OTHERS.items() if not model.nearest(text)[2]} == set()
    answer = docs.select("lang", langid.answers(docs, model).alias("a")).where("lang is not null")
    n, rejected, right = answer.agg(F.count("*"), F.count_if(F.col("a.rejected")), F.count_if(F.expr("a.lang_pred = lang"))).first()
    assert rejected <= 0.01 * n and right >= 0.99 * n


def test_nearest_centroid_by_brute_force(corpus):
    docs, _ = corpus
    model = langid.train(docs)
    assert len(model.names) == len(model.centres) > 3
    for text in ["the house with", "le maison chose avec", "das ding", "thing maison", "x", "Schön " * 50]:
        found = langid.counts(text)
        vector = np.where(found > 0, (1 + np.log(np.maximum(found, 1))) * model.idf, 0)
        cosine = [float(vector @ c / np.linalg.norm(vector)) for c in model.centres.astype(float)]
        lang, score, _ = model.nearest(text)
        assert lang == model.names[int(np.argmax(cosine))] and score == pytest.approx(max(cosine), abs=1e-5)


def test_numerals_are_no_letters(corpus):
    docs, _ = corpus
    model = langid.train(docs)
    assert {model.nearest(t) for t in ("²", "① ② ½", "3⁴ ⅷ", "", "12_")} == {("und", 0.0, True)}
    assert model.nearest("m² the house")[0] == "en"


def test_repeated_rows_and_clashing_columns(corpus):
    docs, _ = corpus
    more = docs.unionByName(docs.where("doc_id < 20")).withColumn("a", F.lit(1)).withColumn("score", F.lit("x")).withColumn("rejected", F.lit(0))
    got = langid.predictions(more).where("doc_id < 20").collect()
    assert len(got) == 40 and len(set(map(tuple, got))) == 20


def test_learning_nothing(spark):
    docs = spark.createDataFrame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert langid.predictions(docs).first().lang_pred == "und"


def test_toxicity(corpus, no_texts):
    docs, labels = corpus
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id in got and r.doc_id is not None}
    held = [i for i in truth if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[1000].score == got[1001].score
    assert toxicity.scores(no_texts, labels).count() == 0
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.where("text like '%idiot%'").count() < 5


def test_one_class_only(corpus):
    docs, labels = corpus
    assert {r.score for r in toxicity.scores(docs, labels.where("toxic = 0")).collect()} == {0.0}


class SharedModel:
    """Interpolated Kneser-Ney by recursion, as a model of what the tables hold."""

    def __init__(self, counts):
        self.levels, longer = {}, set()
        for size in range(toxicity.CONTEXT + 1, 0, -1):
            level = Counter(e[1:] for e in longer)
            for e in (e for e in counts if len(e) == size):
                level[e] += counts[e] if size == toxicity.CONTEXT + 1 or e[0] == "^" else 0
            self.levels[size], longer = level, set(level)
        self.total, self.freed = Counter(), Counter()
        for level in self.levels.values():
            for e, n in level.items():
                self.total[e[:-1], len(e)] += n
                self.freed[e[:-1], len(e)] += min(n, toxicity.DISCOUNT)
        self.letters = max(1, len(self.levels[1]))

    def p(self, e):
        if not e:
            return 1 / self.letters
        total = self.total.get((e[:-1], len(e)))
        if not total:
            return self.p(e[1:])
        return max(self.levels[len(e)].get(e, 0) - toxicity.DISCOUNT, 0) / total + self.freed[e[:-1], len(e)] / total * self.p(e[1:])


def expression_counts(words):
    counts = {}
    for w, o, t in words:
        for e in toxicity.expressions(w):
            a, b = counts.get(e, (0, 0))
            counts[e] = a + o, b + t
    return counts


WORD_COUNTS = [("haus", 3, 1), ("hand", 1, 0), ("maus", 2, 9), ("straßenbahnhaltestelle", 2, 2), ("idiot", 0, 12), ("a", 40, 2), ("ab", 7, 0), ("中文", 1, 1)]


def test_shared_probabilities(spark):
    counts = expression_counts(WORD_COUNTS)
    model = SharedModel({e: o + t for e, (o, t) in counts.items()})
    frame = spark.createDataFrame([(e, float(o), float(t)) for e, (o, t) in counts.items()], "e string, ordinary double, toxic double")
    got = {r.e: r.p for r in toxicity.shared_probabilities(frame).collect()}
    assert got.keys() == counts.keys() and all(abs(got[e] - model.p(e)) < 1e-12 for e in counts)
    letters = {e[-1] for e in counts}
    for context in ("^", "^ha", "^m", "u", ""):
        assert abs(sum(model.p(context + x) for x in letters) - 1) < 1e-9


def test_weights(spark):
    """Against the same rule by hand."""
    counts = expression_counts(WORD_COUNTS)
    model = SharedModel({e: o + t for e, (o, t) in counts.items()})

    def gain(count, expected):
        return math.log((expected + max(0.0, count - expected - (1 + 2 * math.sqrt(expected) + expected / 2)) + 1) / (expected + 1))

    seen = Counter(), Counter()
    for e, pair in counts.items():
        for c in (0, 1):
            seen[c][e[:-1]] += pair[c]
    want = {e: gain(t, model.p(e) * seen[1][e[:-1]]) - gain(o, model.p(e) * seen[0][e[:-1]]) for e, (o, t) in counts.items() if seen[1][e[:-1]] > 1}
    frame = spark.createDataFrame([(e, float(o), float(t)) for e, (o, t) in counts.items()], "e string, ordinary double, toxic double")
    got = toxicity.weights(frame)
    assert got.keys() == {e for e, w in want.items() if w} and all(abs(got[e] - want[e]) < 1e-12 for e in got) and max(got.values()) > 0


def test_toxicity_of_repeated_rows_and_a_long_text(corpus):
    docs, labels = corpus
    rows = [(7000, "the idiot scum moron " * 15_000, "x"), (7001, "you scum", "x"), (7001, "you scum", "x")]
    more = docs.unionByName(docs.sparkSession.createDataFrame(rows, docs.schema)).withColumn("e", F.lit("clash")).withColumn("toxic", F.lit(9))
    got = toxicity.scores(more, labels).where("doc_id >= 7000").collect()
    assert len(got) == 3 and {r.predicted for r in got if r.doc_id == 7000} == {1} and len({r.score for r in got if r.doc_id == 7001}) == 1
