import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import ppm


def escape_model(training, order):
    counts = {}
    for text in training:
        data = b"\n" * order + text
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault((k, data[i - k : i]), Counter())[data[i]] += 1
    return counts


def brute(counts, text, order):
    data, total = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        out, p = set(), 1.0
        for k in range(order, -2, -1):
            if k < 0:
                p /= 256 - len(out)
                break
            seen = {s: n for s, n in counts.get((k, data[i - k : i]), {}).items() if s not in out}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                p *= seen[data[i]] / whole
                break
            p *= len(seen) / whole
            out |= set(seen)
        total += math.log10(p)
    return total


@pytest.fixture()
def rows():
    rng = random.Random(5)
    words = ["the", "of", "haus", "été", "x", "nnn"]
    return [(i, " ".join(rng.choice(words) + rng.choice(["", "e", "."]) for _ in range(rng.randrange(0, 25)))) for i in range(60)] + [(100, None), (101, ""), (102, "Unseen ZZZ"), (None, "the of")] + [(103, "the the")] * 2


@pytest.mark.parametrize("block", [ppm.BLOCK_BYTES, 300])
def test_brute_force(spark, rows, monkeypatch, block):
    if block == 300:
        for name, value in {"GATHERED": 5, "GATHERED_NODES": 40, "STREAM_BYTES": 60}.items():
            monkeypatch.setattr(ppm, name, value)
    docs = spark.createDataFrame([(i, t, "a", 1.0) for i, t in rows], "doc_id long, text string, block string, score double").repartition(3)
    scored = ppm.lm_scores(docs, (ppm.fold(ppm.F.col("doc_id"), 7) != 2), block_bytes=block).collect()
    lists = [(i, (t or "").encode().lower().split()) for i, t in rows]
    train = [w for i, w in lists if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    counts = Counter(x for w in train for x in [*w, b""])
    model = escape_model([b" ".join(w) + b"\n" for w in train], ppm.ORDER)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, len(w) + 1, sum(counts[x] > 0 for x in [*w, b""]), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, b""]), brute(model, b" ".join(w) + b"\n", ppm.ORDER)) for i, w in lists), key=str)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored), key=str)
    assert [x[:4] for x in got] == [x[:4] for x in want]
    assert np.allclose([x[4:] for x in got], [x[4:] for x in want])


def trie(texts, blocks):
    """All nodes of a small training set, sorted by code."""
    nodes = ppm.trie_blocks(ppm.learnt(texts, blocks))
    code, n = ppm._gathered(nodes.where("level > 1").collect())
    low = ppm.lowest_nodes(nodes)
    return np.concatenate([low[0], code]), np.concatenate([low[1], n])


def test_probabilities_sum_to_one(spark, rows):
    nodes = trie(spark.createDataFrame([(t,) for _, t in rows if t], "text string"), 2)
    model = ppm.Model(*nodes)
    for context in (b"\n\n\n\n\n", b" the ", b"zzzzz", b"aus h"):
        data = np.frombuffer(b"".join(context + bytes([b]) for b in range(256)), np.uint8)
        at = np.arange(256) * 6 + 5
        assert abs((10 ** model.score(ppm._codes(data, at))).sum() - 1) < 1e-6


def test_fewer_nodes_and_empty(spark, texts, no_texts):
    assert ppm.held_out_scores(no_texts).count() == 0
    some = ppm.lm_scores(texts, ppm.F.lit(True), nodes=50).collect()
    assert len(some) == 15 and all(r.score <= 0 for r in some)
    none = ppm.lm_scores(texts, ppm.F.lit(False)).where("doc_id = 4").first()
    assert none.train_tokens == 0 and none.n_known == 0 and none.score == pytest.approx(-8 * math.log10(256))


def test_whole_trie_however_large(spark, rows, monkeypatch):
    """Small asks, many blocks and copies of the trie; nothing of the trie is bounded."""
    monkeypatch.setattr(ppm, "ASKING", 3, raising=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.score) for r in ppm.lm_scores(docs, ppm.F.lit(True), nodes=7, block_bytes=300).collect()), key=str)
    lists = [(i, (t or "").encode().lower().split()) for i, t in rows]
    model = escape_model([b" ".join(w) + b"\n" for _, w in lists], ppm.ORDER)
    want = sorted(((i, brute(model, b" ".join(w) + b"\n", ppm.ORDER)) for i, w in lists), key=str)
    assert [x[0] for x in got] == [x[0] for x in want] and np.allclose([x[1] for x in got], [x[1] for x in want])
