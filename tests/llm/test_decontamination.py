import random
from collections import Counter

from starloom.llm import decontamination as D


def shingles(words):
    k = min(5, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []


def brute(docs, items):
    out = {}
    for doc, text in docs:
        w = (text or "").lower().split()
        for item, t in items:
            x = (t or "").lower().split()
            for start in range(max(1, len(w) - len(x) + 1)) if w and x else ():
                width = min(5, len(x))
                part = w[start : start + len(x)]
                a, b = Counter(shingles(x)), Counter(tuple(part[i : i + width]) for i in range(len(part) - width + 1))
                common, united = sum((a & b).values()), sum((a | b).values())
                if 100 * common >= 75 * united and common / united > out.get((doc, item), 0):
                    out[doc, item] = common / united
    return out


def test_brute_force(spark, texts, no_texts):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 5, 12, 40])))) for i in range(12)] + [(20, None), (21, ""), (22, "  "), (23, "Solo")]
    docs = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        item = rng.choice(items)[1] or ""
        part = item.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            if part:
                part[rng.randrange(len(part))] = rng.choice(words)
        at = rng.randrange(len(text) + 1)
        docs.append((i, " ".join(text[:at] + part + text[at:]).upper() if i % 3 else " \n".join(text[:at] + part + text[at:])))
    docs += [(500, items[3][1]), (501, None), (502, ""), (503, "solo"), (503, "solo"), (504, items[4][1] + " " + items[4][1])]
    frame = spark.createDataFrame([(i, t, 1, "h") for i, t in docs], "doc_id long, text string, start int, h string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.leaks(frame, bench).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = D.clean(frame, bench)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert D.leaks(no_texts, bench).count() == 0
    assert D.leaks(texts, bench.where("false")).count() == 0
    assert D.clean(texts, bench.where("false")).count() == texts.count()


def test_inserted_deleted_and_moved_words(spark):
    """Windows at the threshold hold the shingles, but not in the item's places."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, [rng.choice(words) for _ in range(rng.choice([40, 60, 120]))]) for i in range(8)]
    docs = []
    for i in range(40):
        part = list(items[i % 8][1])
        for _ in range(rng.choice([1, 1, 2])):
            at = rng.randrange(len(part))
            if rng.random() < 0.5:
                part[at:at] = [rng.choice(words) for _ in range(rng.randrange(1, 4))]
            else:
                del part[at : at + rng.randrange(1, 4)]
        if i % 4 == 0:  # halves change places: every shingle but the middle ones is there
            part = items[i % 8][1]
            part = part[len(part) // 2 :] + part[: len(part) // 2]
        docs.append((i, " ".join(rng.choices(words, k=rng.randrange(20)) + part + rng.choices(words, k=rng.randrange(20)))))
    texts = [(i, " ".join(x)) for i, x in items]
    got = {(r.doc_id, r.item_id): r.similarity for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string")).collect()}
    want = brute(docs, texts)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (None, "other words here"), (1, "a b c d e f g")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "A b c d e f g")], "item_id long, text string")
    assert sorted((r.doc_id for r in D.leaks(docs, bench).collect()), key=str) == [1, None]
    assert [tuple(r) for r in D.clean(docs, bench).collect()] == [(None, "other words here")]


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), D.RADIUS):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(rows, "a long, b long")
    agree = frame.where(D.F.arrays_overlap(D.blocks(D.F.col("a")), D.blocks(D.F.col("b"))))
    assert agree.count() == 300
