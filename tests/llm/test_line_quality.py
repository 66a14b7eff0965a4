import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import line_quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)})


def plain(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else "0" if "1" <= c <= "9" else c for c in line)
    return " ".join(WORD.findall(line))


def brute(rows, min_docs, permille):
    """rows: (id, text, host) -> the result's rows as a list."""
    docs, hosts = defaultdict(set), defaultdict(set)
    for i, text, host in rows:
        hosts[host or ""].add(i)
        for line in (text or "").split("\n"):
            if WORD.search(line):
                docs[host or "", plain(line)].add(i)
    out = []
    for i, text, host in rows:
        text, host = text or "", host or ""
        words, lines = WORD.findall(text), text.split("\n")
        real = [line for line in lines if WORD.search(line)]
        gone = [k for k, line in enumerate(lines) if WORD.search(line) and (n := len(docs[host, plain(line)])) > min_docs and n * 1000 > permille * len(hosts[host])]
        left = len(words) - sum(len(WORD.findall(lines[k])) for k in gone)
        twice = repeated(words)
        failed = len(words) < 10 or 100 * twice > 20 * len(words)
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(real) - len(set(real)), twice, failed, not failed and left >= 10 and 2 * left >= len(words), left, gone))
    return sorted(out, key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words(words):
    assert Q.repeated_words([w.encode() for w in words]) == repeated(words)


def test_repeated_words_with_many_words():
    words = [f"w{i * 7919 % 9001}" for i in range(30_000)] + ["a"] * 9
    assert Q.repeated_words([w.encode() for w in words]) == repeated(words)


MENU = "Home | About us | Contact 12\nHome | about  us | CONTACT 97\n"


def corpus():
    body = [f"This is sentence number {chr(97 + i % 26)}{chr(97 + i // 26)} of a page that nobody else has,\nwith a second line of {chr(97 + i // 26)}{chr(97 + i % 26)} its own words.\n" for i in range(60)]
    rows = [(i, MENU + body[i] + ("same $ footer & more\r\n" if i % 2 else ""), "a" if i < 40 else "b") for i in range(60)]
    rows += [(100 + i, MENU * 8 + "tiny", "a") for i in range(4)]  # depleted
    rows += [(200, None, "a"), (201, "", "b"), (202, "\n \n", None), (203, "one two", None), (204, "x y z w v " * 9, "a"), (205, "the end of it all now " * 30_000 + "\n" + body[3], "b")]
    rows += [(None, MENU + body[7], "a"), (None, body[8], "a"), rows[5], rows[5], rows[6]]  # null ids, repeated rows
    return rows


@pytest.mark.parametrize(("min_docs", "permille"), [(10, 1), (2, 1), (2, 900), (0, 0)])
@pytest.mark.parametrize("heavy", [Q.HEAVY, 3, 1])
def test_verdicts(spark, monkeypatch, min_docs, permille, heavy):
    """Few or all frequent lines take the way of the sent ones."""
    monkeypatch.setattr(Q, "HEAVY", heavy)
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, row int, key string").repartition(4)
    got = sorted((tuple(r) for r in Q.verdicts(frame, min_docs=min_docs, permille=permille).collect()), key=repr)
    assert got == brute(rows, min_docs, permille)


def test_text_without_its_lines(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("a\nb\n\nc", [0, 2]), ("", []), ("a.*", [0])], "t string, gone array<int>").select(Q.without_lines(F.col("t"), F.col("gone"))).collect()
    assert [r[0] for r in got] == ["b\nc", "", ""]


def test_empty_table(spark):
    assert Q.verdicts(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
