"""LM scoring (4): prediction by partial matching over bytes.

A text is coded as its words (ASCII lower case, cut at ASCII white space), byte
by byte with spaces between, and one end mark.  A byte's context is up to ORDER
bytes before it, across words; before a text stand blanks.  The trie holds how
often each byte followed each context in the training texts.
A byte not seen in the longest context known escapes to the next shorter one;
the escape estimate is the number of different bytes seen there (method C), and
bytes already ruled out by longer contexts are excluded from the counts and the
escape estimate of shorter ones.  Below order 0 all bytes not excluded are
equally likely.  The model is pretrained: counts of all training texts, then a
code length for every text.

* Every task counts the words and the deepest nodes of its share; word counts
  meet by word bucket, nodes by the last two bytes of their context, where the
  nodes of shorter contexts are summed from them.
* The trie stays a table, a row per block and order; only the nodes of contexts
  of one byte and none, 65,792 at the most, are sent to all tasks.
* Documents are dealt into blocks.  A block asks each word bucket once for the
  training counts of its different words, and each block of the trie for the log
  probabilities of its different deepest nodes: a node's shorter contexts of two
  bytes and more are all in the same block of the trie.  Words, nodes and answers
  travel as packed arrays.  Of more than ASKING blocks of documents, every ASKING
  get a copy of the trie's blocks, so that no task's share grows with their number.

Defined cases: null text counts as empty text, whose only token is the end; a
null id has fold 0; without training texts N and V are 0 and all bytes equally
likely; repeated rows are scored each by itself, rows equal in id and text in
the same block; an empty table gives an empty result; only the id and the text
are read, whatever other columns are called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import blocks_for, fold, stored, text_of
from starloom.llm.shingles import words

#: Longest context in bytes, the word's start included.
ORDER = 5
#: Nodes in a row of what a block of documents asks; more are asked in several rows.
ASK_NODES = 1 << 16
#: Blocks of documents that ask the same copy of the trie's blocks.
ASKING = 256
#: Text bytes of a block of documents, and of those behind a word bucket.
BLOCK_BYTES = 8_000_000
#: Different words a task gathers before it deals out their counts.
GATHERED = 400_000
#: Deepest nodes a task gathers before it deals them out, and text bytes coded at a time.
GATHERED_NODES, STREAM_BYTES = 2_000_000, 1_000_000
END = b""
_WORDS, _NODES = 0, 1
_SYMBOLS = 256


# -- words and their counts -------------------------------------------------------------


def _bucketed(found: list[bytes], buckets: int) -> dict[int, list[bytes]]:
    """Sorted different words by bucket."""
    out: dict[int, list[bytes]] = {}
    for w in found:
        out.setdefault(xxhash.xxh64_intdigest(w) % buckets, []).append(w)
    for some in out.values():
        some.sort()
    return out


# -- the trie ---------------------------------------------------------------------------
# A node is a context of k bytes and the byte after it, as one number: k in the top
# byte, then the context, then the byte.


def _stream(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places of the bytes coded, text of each): words closed by spaces, a text by its end mark, each after a blank context."""
    texts = [b" ".join(x) + b"\n" for x in lists]
    blank = b"\n" * ORDER
    data = np.frombuffer(blank + blank.join(texts), np.uint8)
    size = np.array([len(x) for x in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    return data, np.arange(len(text)) + ORDER * (text + 1), text


def _codes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The deepest node of each place."""
    wide, n = data.astype(np.uint64), len(data)
    out = np.full(max(0, n - ORDER), np.uint64(ORDER) << np.uint64(56), dtype=np.uint64)  # of all places, in slices
    for k in range(ORDER + 1):
        out |= wide[ORDER - k : n - k] << np.uint64(8 * k)
    return out[at - ORDER]


def _shorter(code: np.ndarray, order: int) -> np.ndarray:
    """The nodes of ``order`` that end like these."""
    return (np.uint64(order) << np.uint64(56)) | (code & np.uint64((1 << (8 * (order + 1))) - 1))


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(code):
        return code, n
    if not (code[1:] >= code[:-1]).all():
        by = np.argsort(code, kind="stable")  # runs that are sorted already are merged
        code, n = code[by], n[by]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[first], np.add.reduceat(n, first)


def _block_of(codes: np.ndarray, blocks: int) -> np.ndarray:
    """The block of the trie, by the last two bytes of the context."""
    return (((codes >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % blocks


def _by_block(block: np.ndarray) -> np.ndarray:
    """Places in order of their block; small numbers are sorted by their digits."""
    small = len(block) and block.max() < 1 << 16
    return np.argsort(block.astype(np.uint16) if small else block, kind="stable")


def _distinct(sorted_codes: np.ndarray) -> np.ndarray:
    return sorted_codes[np.r_[True, sorted_codes[1:] != sorted_codes[:-1]]] if len(sorted_codes) else sorted_codes


def learnt(texts: DataFrame, buckets: int) -> DataFrame:
    """kind, part, level, keys, counts, tokens, types of the training texts, stored.  texts: text.

    Kind _WORDS: a row per bucket with its words joined by spaces; each text ends
    in one END.  Kind _NODES: the nodes by block of the trie and order, sorted by
    code; those of order 1 still in parts.  One pass over the texts gathers both.
    """

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def packed_words() -> pd.DataFrame:
            by = _bucketed(list(counts), buckets)
            return pd.DataFrame({"kind": _WORDS, "part": list(by), "keys": [b" ".join(x) for x in by.values()], "counts": [np.array([counts[w] for w in x], dtype="<i8").tobytes() for x in by.values()]})

        def merged() -> None:
            nonlocal held
            codes, n = _summed(np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found]))
            found[:], held = [(codes, n)], len(codes)

        def packed_nodes() -> pd.DataFrame:
            codes, n = found[0]
            block = _block_of(codes, buckets)
            by = _by_block(block)
            first = np.flatnonzero(np.r_[True, np.diff(block[by]) != 0])
            return pd.DataFrame({"kind": _NODES, "part": block[by][first], "keys": [x.astype("<u8").tobytes() for x in np.split(codes[by], first[1:])], "counts": [x.astype("<i8").tobytes() for x in np.split(n[by], first[1:])]})

        for lists in _lists(batches):
            for some in lists:
                counts.update(some)
            counts[END] += len(lists)
            if len(counts) >= GATHERED:
                yield packed_words()
                counts.clear()
            data, at, _ = _stream(lists)
            code = np.sort(_codes(data, at))
            found.append(_summed(code, np.ones(len(code), np.int64)))
            held += len(found[-1][0])
            if held >= GATHERED_NODES:
                merged()
                if held >= GATHERED_NODES // 2:
                    yield packed_nodes()
                    found, held = [], 0
        if counts:
            yield packed_words()
        if found:
            merged()
            yield packed_nodes()

    def met(part: pd.DataFrame) -> pd.DataFrame:
        of = int(part["part"].iloc[0])
        if part["kind"].iloc[0] == _WORDS:
            counts: Counter = Counter()
            for found, n in zip(part["keys"], part["counts"]):
                for w, x in zip(found.split(b" "), np.frombuffer(n, "<i8").tolist()):
                    counts[w] += x
            found = sorted(counts)
            n = np.array([counts[w] for w in found], dtype="<i8")
            out = [(0, b" ".join(found), n.tobytes(), int(n.sum()), len(found))]
        else:  # all nodes whose contexts end in the same two bytes are in one block, down to contexts of two bytes
            code, n = _summed(np.concatenate([np.frombuffer(x, "<u8") for x in part["keys"]]), np.concatenate([np.frombuffer(x, "<i8") for x in part["counts"]]))
            out = []
            for order in range(ORDER, 0, -1):
                if order < ORDER:
                    code, n = _summed(_shorter(code, order), n)
                out.append((order, code.astype("<u8").tobytes(), n.astype("<i8").tobytes(), 0, 0))
        made = pd.DataFrame(out, columns=["level", "keys", "counts", "tokens", "types"])
        made.insert(0, "part", of)
        made.insert(0, "kind", int(part["kind"].iloc[0]))
        return made

    rows = texts.mapInPandas(dealt, "kind int, part long, keys binary, counts binary").groupBy("kind", "part")
    return stored(rows.applyInPandas(met, "kind int, part long, level int, keys binary, counts binary, tokens long, types long"), "ppm-model")


def trie_blocks(model: DataFrame) -> DataFrame:
    """block, level, codes, counts of what is ``learnt``."""
    return model.where(F.col("kind") == _NODES).select(F.col("part").alias("block"), "level", F.col("keys").alias("codes"), "counts")


def lowest_nodes(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the nodes of contexts of one byte and none, of ``trie_blocks``."""

    def lowest(part: pd.DataFrame) -> pd.DataFrame:
        """The nodes of contexts of one byte and none: 65,792 at the most."""
        one = _summed(np.concatenate([np.frombuffer(x, "<u8") for x in part["codes"]]), np.concatenate([np.frombuffer(x, "<i8") for x in part["counts"]]))
        none = _summed(_shorter(one[0], 0), one[1])
        return pd.DataFrame({"codes": [x[0].astype("<u8").tobytes() for x in (one, none)], "counts": [x[1].astype("<i8").tobytes() for x in (one, none)]})

    return _gathered(nodes.where("level = 1").groupBy("level").applyInPandas(lowest, "codes binary, counts binary").collect())  # 65,792 nodes at the most


def _gathered(rows: list) -> tuple[np.ndarray, np.ndarray]:
    code = np.concatenate([np.frombuffer(r["codes"], "<u8") for r in rows] or [np.zeros(0, "<u8")])
    n = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in rows] or [np.zeros(0, "<i8")])
    order = np.argsort(code)
    return code[order], n[order]


class Scores:
    """Scores by node, in a hash table."""

    def __init__(self, codes: np.ndarray, scores: np.ndarray):
        size = 1 << max(4, int(1.5 * len(codes)).bit_length())
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.keys, self.scores = np.zeros(size, np.uint64), np.zeros(size, np.float32)
        left, score, slot = codes, scores, self._slot(codes)
        self.probes = 0
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = left[free]
            mine = self.keys[slot] == left
            self.scores[slot[mine]] = score[mine]
            left, score, slot = left[~mine], score[~mine], (slot[~mine] + 1) & (size - 1)
            self.probes += 1

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, places of the codes that the table doesn't hold, where no score is set)"""
        out = np.empty(len(codes))
        left, slot = np.arange(len(codes)), self._slot(codes)
        missing = []
        for _ in range(self.probes):
            key = self.keys[slot]
            hit = key == codes[left]
            out[left[hit]] = self.scores[slot[hit]]
            missing.append(left[key == 0])
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
            if not len(left):
                break
        return out, np.concatenate([*missing, left])


class Model:
    """Log10 probabilities from the nodes of a trie."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts.astype(np.float64)
        context = codes >> np.uint64(8)  # nodes of one context stand together
        self.contexts, first = np.unique(context, return_index=True)
        self.total = np.add.reduceat(self.counts, first) if len(codes) else np.zeros(0)
        self.kinds = np.diff(np.r_[first, len(codes)]).astype(np.float64)
        # after an escape from a context: the counts and kinds that the next shorter one loses
        self.out_total, self.out_kinds = np.zeros(len(self.contexts)), np.zeros(len(self.contexts))
        for order in range(1, ORDER + 1):
            some = slice(*np.searchsorted(codes, [np.uint64(order) << np.uint64(56), np.uint64(order + 1) << np.uint64(56)]))
            at, seen = _find(codes, _shorter(codes[some], order - 1))
            here = np.searchsorted(self.contexts, context[some])[seen]
            self.out_total += np.bincount(here, weights=self.counts[at[seen]], minlength=len(self.contexts))
            self.out_kinds += np.bincount(here, minlength=len(self.contexts))
        # nodes of the longest contexts in a hash table: most bytes end there
        deep = slice(np.searchsorted(codes, np.uint64(ORDER) << np.uint64(56)), len(codes))
        place = np.searchsorted(self.contexts, context[deep])
        self.deep = Scores(codes[deep], np.log10(self.counts[deep]) - np.log10(self.total[place] + self.kinds[place]))

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log10 probability of the byte at each deepest node."""
        out, missing = self.deep.get(codes)
        if len(missing):
            code, place = np.unique(codes[missing], return_inverse=True)
            out[missing] = self._escaped(code)[place]
        return out

    def _escaped(self, codes: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(codes)), np.arange(len(codes))
        cut_total, cut_kinds = np.zeros(len(codes)), np.zeros(len(codes))  # excluded from the next context
        for order in range(ORDER, -1, -1):
            code = _shorter(codes[left], order)
            place, known = _find(self.contexts, code >> np.uint64(8))
            now, code, place = left[known], code[known], place[known]
            kinds = np.maximum(self.kinds[place] - cut_kinds[now], 0)
            total = np.maximum(self.total[place] - cut_total[now], 0)
            node, hit = _find(self.codes, code)
            some = kinds > 0  # else no byte is new here, and the escape is certain
            seen = np.where(hit, self.counts[node], kinds)[some]
            out[now[some]] += np.log10(seen) - np.log10((total + kinds)[some])
            away = ~hit
            cut_total[now[away]], cut_kinds[now[away]] = self.out_total[place[away]], self.out_kinds[place[away]]
            if order == 0:
                cut_kinds[now[away]] = self.kinds[place[away]]
            ended = np.zeros(len(codes), bool)
            ended[now[hit]] = True
            left = left[~ended[left]]
        out[left] -= np.log10(np.maximum(_SYMBOLS - cut_kinds[left], 1))
        return out


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _lists(batches: Iterator[pd.DataFrame]) -> Iterator[list[list[bytes]]]:
    """The words of some texts at a time, STREAM_BYTES or one text."""
    some, size = [], 0
    for batch in batches:
        for text in batch["text"]:
            some.append(words(text))
            size += len(text)
            if size >= STREAM_BYTES:
                yield some
                some, size = [], 0
    if some:
        yield some


class _Numbers(dict):
    """A number for each different word, in the order met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Pieces:
    """A block's texts cut into words once, and the deepest nodes of their bytes, STREAM_BYTES at a time."""

    def __init__(self, texts: pd.Series, places: bool):
        #: The different words, and each text's as their numbers (with ``places``), END not among these.
        self.words = _Numbers({END: 0})
        self.numbers: list[np.ndarray] = []
        self.pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        found, met = [], set()
        for some in _lists(iter([pd.DataFrame({"text": texts})])):
            for x in some:
                if places:
                    self.numbers.append(np.fromiter(map(self.words.__getitem__, x), np.int32, len(x)))
                else:
                    met.update(x)
            data, at, text = _stream(some)
            code = _codes(data, at)
            if not places:
                found.append(_distinct(np.sort(code)))
                continue
            by = np.argsort(code)
            ordered = code[by]
            new = np.ones(len(code), bool)
            np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
            found.append(ordered[new])
            place = np.empty(len(code), np.int32)
            place[by] = np.cumsum(new) - 1
            self.pieces.append((found[-1], place, text.astype(np.int32), len(some)))
        for x in met:
            self.words[x]
        #: The sorted distinct deepest nodes.
        self.codes = _distinct(np.sort(np.concatenate(found), kind="stable")) if found else np.zeros(0, np.uint64)

    def per_text(self, value: np.ndarray) -> np.ndarray:
        """The sum over each text's words, its end included, of a value by word number."""
        text = np.repeat(np.arange(len(self.numbers)), [len(x) for x in self.numbers])
        return np.bincount(text, weights=value[np.concatenate(self.numbers)], minlength=len(self.numbers)) + value[self.words[END]]

    def sums(self, score: np.ndarray) -> np.ndarray:
        """The sum of the nodes' scores in each text."""
        out = [np.bincount(text, weights=score[np.searchsorted(self.codes, code)][place], minlength=n) for code, place, text, n in self.pieces]
        return np.concatenate(out) if out else np.zeros(0)


def _asks(codes: np.ndarray, blocks: int, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block of the trie, places among the codes), ``most`` at a time."""
    block = _block_of(codes, blocks)
    by = _by_block(block)
    for some in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
        for i in range(0, len(some), most):
            yield int(block[some[0]]), some[i : i + most]


def _planes(codes: np.ndarray) -> bytes:
    """The ORDER + 1 bytes of deepest nodes, first bytes first: sorted nodes compress well so."""
    return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, ORDER::-1].T.tobytes()


def _from_planes(planes: bytes) -> np.ndarray:
    rows = np.frombuffer(planes, np.uint8).reshape(ORDER + 1, -1)
    out = np.full(rows.shape[1], np.uint64(ORDER) << np.uint64(56), dtype=np.uint64)
    for k, row in enumerate(rows):
        out |= row.astype(np.uint64) << np.uint64(8 * (ORDER - k))
    return out


# -- documents --------------------------------------------------------------------------


def lm_scores(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text", nodes: int = ASK_NODES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, train_types, base_score, score per row of ``docs``.

    ``trained`` tells which rows the model learns from.
    """
    text = text_of(F.col(text_col))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = blocks_for(size, block_bytes)
    model = learnt(docs.where(trained).select(text.alias("text")), buckets)
    tokens, types = (x or 0 for x in model.agg(F.sum("tokens"), F.sum("types")).first())
    spark = docs.sparkSession
    low = spark.sparkContext.broadcast(lowest_nodes(trie_blocks(model)))
    copies = blocks_for(buckets, ASKING)
    given = docs.select(F.pmod(F.xxhash64(F.col(id_col), text), F.lit(buckets)).alias("block"), text.alias("text"), F.col(id_col).alias("key"))

    def asked(part: pd.DataFrame) -> pd.DataFrame:
        pieces = _Pieces(part["text"], places=False)
        block = int(part["block"].iloc[0])
        out = [(_WORDS, bucket, 0, block, 0, b" ".join(x)) for bucket, x in _bucketed(list(pieces.words), buckets).items()]
        out += [(_NODES, of, block % copies, block, n, _planes(pieces.codes[at])) for n, (of, at) in enumerate(_asks(pieces.codes, buckets, nodes))]
        return pd.DataFrame(out, columns=["kind", "part", "copy", "block", "n", "ask"])

    def answered(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(ask):
            return pd.DataFrame({"block": [], "kind": [], "part": [], "n": [], "answer": []})
        if ask["kind"].iloc[0] == _WORDS:
            lists = [x.split(b" ") for x in ask["ask"]]
            count = dict.fromkeys((w for x in lists for w in x), 0)
            for some, n in zip(have["keys"], have["counts"]):
                for w, c in zip(some.split(b" "), np.frombuffer(n, "<i8").tolist()):
                    if w in count:
                        count[w] = c
            answer = [np.fromiter(map(count.__getitem__, x), dtype="<i8", count=len(x)).tobytes() for x in lists]
        else:
            asked_nodes = [_from_planes(x) for x in ask["ask"]]
            model = _block_model(have, asked_nodes, *low.value)
            answer = [model.score(x).astype("<f4").tobytes() for x in asked_nodes]
        return pd.DataFrame({"block": ask["block"], "kind": ask["kind"], "part": ask["part"], "n": ask["n"], "answer": answer})

    def added(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        pieces = _Pieces(part["text"], places=True)
        by = _bucketed(list(pieces.words), buckets)
        n = np.zeros(len(pieces.words), np.int64)
        of_words = answers[answers["kind"] == _WORDS]
        for bucket, answer in zip(of_words["part"], of_words["answer"]):
            n[np.fromiter(map(pieces.words.__getitem__, by[bucket]), np.int64, len(by[bucket]))] = np.frombuffer(answer, "<i8")
        base, known = np.log10((n + 1) / (tokens + types + 1)), (n > 0).astype(np.float64)
        made = pd.DataFrame({"n_tokens": [len(x) + 1 for x in pieces.numbers], "n_known": pieces.per_text(known).astype(np.int64), "base_score": pieces.per_text(base)})
        del by
        asks = [at for _, at in _asks(pieces.codes, buckets, nodes)]
        score = np.full(len(pieces.codes), np.nan, dtype=np.float32)
        of_nodes = answers[answers["kind"] == _NODES]
        for n, x in zip(of_nodes["n"], of_nodes["answer"]):
            score[asks[n]] = np.frombuffer(x, "<f4")
        made["score"] = pieces.sums(score)
        made.insert(0, "id", part["key"].to_numpy())
        return made

    asks = given.groupBy("block").applyInPandas(asked, "kind int, part long, copy long, block long, n int, ask binary")
    copy = F.when(F.col("kind") == _NODES, F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    have = model.where((F.col("kind") == _WORDS) | (F.col("level") > 1)).select("kind", "part", F.explode(copy).alias("copy"), "keys", "counts")
    key = ["kind", "part", "copy"]
    answers = asks.groupBy(*key).cogroup(have.groupBy(*key)).applyInPandas(answered, "block long, kind int, part long, n int, answer binary")
    kind = dict(docs.dtypes)[id_col]
    made = given.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(added, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return made.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), F.lit(types).cast("long").alias("train_types"), "base_score", "score")


def _block_model(have: pd.DataFrame, asked: list[np.ndarray], low_codes: np.ndarray, low_counts: np.ndarray) -> Model:
    """The model of the contexts in a block of the trie, with the contexts of one byte that the asked nodes end in."""
    ends = np.zeros(256, bool)
    for x in asked:
        ends[((x >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)] = True
    keep = (low_codes < np.uint64(1 << 56)) | ends[((low_codes >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)]
    codes = np.concatenate([low_codes[keep], *(np.frombuffer(x, "<u8") for x in have["keys"])])
    counts = np.concatenate([low_counts[keep], *(np.frombuffer(x, "<i8") for x in have["counts"])])
    order = np.argsort(codes)
    return Model(codes[order], counts[order])


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, out: int = 2) -> DataFrame:
    """``lm_scores`` learning from all folds of the id but one."""
    scored = lm_scores(docs, fold(F.col(id_col), folds) != out, id_col, text_col)
    return scored.withColumn("held_out", fold(F.col(id_col), folds) == out)
