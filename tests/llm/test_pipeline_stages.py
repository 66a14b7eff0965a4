import hashlib
import math
import os
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_bpe import THEIRS
from test_classifiers import SharedModel
from test_decontamination import brute as leaked
from test_ngram_join import brute as components
from test_ngram_join import tables

from starloom.llm import langid, queries, toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_run_is_their_chain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    start, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == start.columns, name
        assert docs.count() <= before
        before = docs.count()
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_only_the_last_stage_stays_stored(spark):
    """And of the near duplicates' steps no table."""
    before = tables(spark)
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    kept = [x.rsplit("-", 1)[0] for x in tables(spark) - before if x.startswith(("pipeline-", "ngram-"))]
    assert sorted(kept) == ["ngram-gone", "pipeline-encoding"]


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


# -- the five decisions by hand ------------------------------------------------------------------


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def clean_of_toxic(rows, labels):
    known = {}
    for i, toxic in labels:
        if i is not None and toxic is not None:
            known[i] = max(known.get(i, 0), toxic)
    learn = [(toxicity.word_set(t or ""), known[i], fold(i) == 4) for i, t, _ in rows if i in known and fold(i)]
    counts = {}
    for words, toxic, fit in learn:
        for w in words if not fit else ():
            for e in toxicity.expressions(w):
                o, t = counts.get(e, (0, 0))
                counts[e] = o + 1 - toxic, t + toxic
    model, seen = SharedModel({e: o + t for e, (o, t) in counts.items()}), (Counter(), Counter())
    for e, pair in counts.items():
        for c in (0, 1):
            seen[c][e[:-1]] += pair[c]

    def gain(count, expected):
        return math.log((expected + max(0.0, count - expected - (1 + 2 * math.sqrt(expected) + expected / 2)) + 1) / (expected + 1))

    weight = {e: gain(t, model.p(e) * seen[1][e[:-1]]) - gain(o, model.p(e) * seen[0][e[:-1]]) for e, (o, t) in counts.items() if seen[1][e[:-1]] > 1}

    def measure(words):
        return math.fsum(sum(weight.get(e, 0.0) for e in toxicity.expressions(w)) for w in words) / math.sqrt(len(words)) if words else 0.0

    at = Counter((math.floor(abs(m) / 0.01 + 0.5) * (1 if m >= 0 else -1), toxic) for words, toxic, fit in learn if fit for m in [measure(words)])
    places = sorted({x for x, _ in at})
    a, b = toxicity.logistic(np.array(places) * 0.01, np.array([at[x, 1] for x in places], float), np.array([at[x, 0] for x in places], float))
    return [r for r in rows if 1 / (1 + math.exp(-(a + b * measure(toxicity.word_set(r[1] or ""))))) < 0.5]


def of_known_language(spark, rows):
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    out = []
    for row in rows:
        found = langid.counts(row[1] or "")
        if found is None:
            continue
        vector = np.where(found > 0, (1 + np.log(np.maximum(found, 1))) * model.idf, 0)
        cosine = model.centres.astype(float) @ vector / np.linalg.norm(vector)
        best, size = int(np.argmax(cosine)), int(math.log2(found.sum()))
        radius = model.radii.get((best, size))
        most = 1 - (0.2 if size >= 6 else 0.1)
        if 1 - cosine[best] <= (most if radius is None else min(most, langid.SLACK * radius)):
            out.append(row)
    return out


def corpus():
    rng = random.Random(12)
    syllables = {"en": ["th", "er", "ou", "ing", "wh", "at"], "fr": ["eau", "que", "oi", "ent", "lle", "é"], "de": ["sch", "ei", "ung", "ch", "ver", "ü"]}
    words = {lang: ["".join(rng.choice(s) for _ in range(rng.randrange(1, 4))) for _ in range(300)] for lang, s in syllables.items()}
    items = [(i, " ".join(rng.choice(words["en"]) for _ in range(40))) for i in range(3)] + [(7, None)]
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(list(words))
        text = [rng.choice(words[lang]) for _ in range(rng.randrange(20, 90))]
        toxic = int(rng.random() < 0.3)
        for _ in range(5 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["idiot", "scum", "moron"]))
        rows.append((i, " ".join(text), lang if i % 9 else None))
        if i % 4:
            labels.append((i, toxic))
    good = [r for r in rows if "scum" not in r[1] and "idiot" not in r[1] and "moron" not in r[1]]
    for k, (i, text, lang) in enumerate(good[:30]):  # copies, near copies, benchmark passages
        part = text.split()
        if k % 3 == 1:
            part[len(part) // 2] = "changed"
        if k % 3 == 2:
            part = [*part, *items[k % 2][1].split()]
        rows.append((1000 + k, " ".join(part), lang))
    rows += [(2000, None, None), (2001, "", "en"), (2002, "² ½", "en"), (2003, "Η γρήγορη αλεπού πηδάει πάνω από το σκυλί " * 6, None), (None, "the other thing " * 9, "en")]
    rows += [(3000, " ".join(rng.choice(words["de"]) for _ in range(30_000)), "de"), (3001, "scum idiot moron " * 4000, "en")]
    rows += [rows[3], rows[3]]  # repeated rows
    return rows, labels + [(1, None), (None, 1), (5, 0), (9999, 1)], items


def write(spark, folder, rows, labels, items):
    more = [(i, t, lang, "src", len(t or ""), 1, "e") for i, t, lang in rows]  # with names that operators use themselves
    spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long, row int, e string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_by_hand(spark, tmp_dir):
    rows, labels, items = corpus()
    folder = os.path.join(tmp_dir, "in")
    write(spark, folder, rows, labels, items)
    kept = clean_of_toxic(rows, labels)
    assert 0.05 < 1 - len(kept) / len(rows) < 0.4 and 3001 not in {r[0] for r in kept}
    kept = of_known_language(spark, kept)
    assert {2000, 2001, 2002, 2003}.isdisjoint({r[0] for r in kept})
    group = {i: root for i, _, root, _ in components([(i, t) for i, t, _ in kept])}
    kept = [r for r in kept if group[r[0]] == r[0]]  # rows that repeat an id stay or go together
    assert {1000, 1001}.isdisjoint({r[0] for r in kept})
    bad = {i for i, _ in leaked([(i, t) for i, t, _ in kept], items)}
    kept = [r for r in kept if r[0] not in bad]
    want = []
    for i, text, _ in kept:
        ids = THEIRS.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(THEIRS.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 150


def test_empty_tables(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "none")
    write(spark, folder, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:4]])
def test_stages_take_other_columns(spark, tmp_dir, name):
    """Columns that clash with an operator's own come back as they were."""
    rows, labels, items = corpus()
    folder = os.path.join(tmp_dir, "in")
    write(spark, folder, rows[:80], labels, items)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
