import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from starloom.llm import source_audit as A

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def low(term):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in term)


def brute(rows, least, shown):
    """rows: (text, lang, source); every group against every kept term."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        found = Counter(low(t) for t in TERM.findall(text))
        docs[lang].update(found.keys())
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        of = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            above = [(q[t] - of[s][t], t.encode()) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(above)[:shown])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def corpus(seed, n=240):
    rng = np.random.default_rng(seed)
    words = [*"the of and Ünder THE naïve 中文 x1y a_b don't État zebra".split(), *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    rows = []
    for _ in range(n):
        k = int(rng.integers(0, 30))
        text = " ".join(words[min(int(rng.zipf(1.4)), len(words)) - 1] for _ in range(k))
        rows.append((text if rng.random() > 0.03 else None, rng.choice(["en", "fr", ""]) if rng.random() > 0.03 else None, f"s{min(int(rng.zipf(1.6)), 7)}" if rng.random() > 0.05 else None))
    rows += [("the same text of Many copies", "en", f"s{i % 3}") for i in range(90)]  # copies over sources
    rows += [("Wort " * 20_000, "de", "long"), ("123 !!", "de", "other"), ("nothing else", "lone", "only")]
    return rows


def test_audit(spark, monkeypatch):
    rows = corpus(3)
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "text string, lang string, source string, term string, n double").repartition(4)
    got = [tuple(r) for r in A.audit(frame, min_docs=4, terms_shown=6).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 4, 6)


def test_small_blocks_and_squares(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 40)
    rows = corpus(4)
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(r) for r in A.audit(frame, min_docs=3).collect()} == brute(rows, 3, 50)


def test_a_square_is_the_dense_sum():
    """Two blocks of sources, as a task gets them."""
    rng = np.random.default_rng(5)
    n, t = 7, 40
    z = rng.integers(1, 50, n) * 1000
    p = np.where(rng.random((n, t)) < 0.4, z[:, None] + rng.integers(1, 10**8, (n, t)), z[:, None])
    sid = np.array([0, 1, 511, 512, 513, 700, 1023])
    cells = [(int(sid[a]), f"t{k}", int(p[a, k])) for a in range(n) for k in range(t) if p[a, k] > z[a]]
    rows = pd.DataFrame([*cells, *((int(s), None, int(x)) for s, x in zip(sid, z, strict=True))], columns=["sid", "term", "p"])
    for i, j in ((0, 0), (0, 1), (1, 1)):
        mine = rows[rows["sid"].floordiv(A.SQUARE).isin([i, j])].assign(lang="en", i=i, j=j, block=0)
        got = {(r.a, r.b): (r.total, r.held) for r in A._square(mine).itertuples()}
        want = {}
        for a in range(n):
            for b in range(n):
                if sid[a] // 512 == i and sid[b] // 512 == j and sid[a] < sid[b]:
                    either = (p[a] > z[a]) | (p[b] > z[b])
                    want[sid[a], sid[b]] = (np.abs(p[a] - p[b])[either].sum(), either.sum())
        assert got == want


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, all_n, kept = 5 * 10**12, 9 * 10**13, 10**7
    got = spark.range(1).select(A.share(F.lit(n), F.lit(all_n), F.lit(kept))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (all_n + 5 * kept)


def test_no_kept_terms_and_no_rows(spark):
    few = spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y")], "text string, lang string, source string")
    assert {tuple(r) for r in A.audit(few).collect()} == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
    assert A.audit(few.where("false")).count() == 0
