"""BPE encoding and decoding (9): backtracking over longest token matches.

A word is encoded without running the merge list.  An Aho-Corasick automaton
over all tokens gives, in one pass, the longest token that starts at each
position.  The encoder takes that token if it is compatible with the token
before it, meaning that merging their two spellings side by side would have
ended in just these two tokens; otherwise it tries the next shorter token that
is a prefix, and where none is left it gives up the token before.  A bit per
position remembers dead ends, so that the work is linear in the word.  The
compatible pair is decided by unrolling the two tokens' merges along their
common border, and kept in a table.  Decoding copies token spellings out of
one buffer by an offset table.

Text handling is that of the vocabulary file: special tokens found in the raw
text stand for themselves, the rest is composed to NFC, lower-cased, cut into
pieces by the file's pattern and spelled in bytes, the last byte of a piece
carrying the word end.  No piece holds white space, so ids are kept per
white-space-delimited chunk in a bounded table.

Defined cases: null text counts as empty text and has no ids; empty text
decodes to empty text; each row is encoded by itself, so repeated rows and
ties change nothing; an empty table gives an empty result; other columns are
never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import give_back, text_of

#: Chunks kept per Python worker in each of two generations.
CHUNKS_KEPT = 150_000
#: Longer chunks (runs without white space) are encoded each time.
CHUNK_CHARS_KEPT = 64
ROUND_TRIP = "n_tokens long, ids binary, decoded string"


def _byte_letters() -> dict[int, str]:
    """The printable letter that spells each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(printable))
    return letters


class Vocabulary:
    """One vocabulary file, prepared for encoding and decoding.

    Pieces are spelled in code points below 256 for inner bytes and 256 above
    for a last byte, so the word end needs no rule of its own.
    """

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        byte_of = {letter: b for b, letter in _byte_letters().items()}
        ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]

        def spelled(token: str) -> str:
            end = token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = [byte_of[c] for c in (token[: -len(self.suffix)] if end else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + 256 * end)

        self.spelling = {i: spelled(t) for t, i in ids.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for n, (left, right) in enumerate(merges):
            whole = left + right
            if whole in ids:
                self.merged[ids[left], ids[right]] = ids[whole]
                self.rank.setdefault(ids[whole], n)
                self.parts.setdefault(ids[whole], (ids[left], ids[right]))
        reachable = {i: s for i, s in self.spelling.items() if len(s) == 1 or i in self.parts}
        by_spelling = {s: i for i, s in reachable.items()}
        self.automaton = ahocorasick.Automaton()
        for i, s in reachable.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        #: the longest token that is a proper prefix
        self.shorter = {i: next((by_spelling[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_spelling), None) for i, s in reachable.items()}
        self.length = {i: len(s) for i, s in reachable.items()}
        self.last = [chr(256 + b) for b in range(256)]
        self.packed = {i: int(i).to_bytes(4, "little") for i in ids.values()}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        # letters beyond Latin change with the Unicode version: for them the library that defines the format says what they are
        library = Tokenizer.from_str(file.decode())
        self.normalised, self.cut, self.byte_of = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str, byte_of
        self.beyond = regex.compile("[^\x00-\u024f]")
        self.white = regex.compile(r"\p{White_Space}+")
        self.kept: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}
        texts = dict(ids.items()) | self.special
        size = max(texts.values()) + 1
        spelled_out = [b""] * size
        for t, i in texts.items():
            spelled_out[i] = t.encode() + b" "  # the decoder sets a space between tokens
        self.buffer = np.frombuffer(b"".join(spelled_out), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in spelled_out])]).astype(np.int64)

    # -- the pair-compatibility table -------------------------------------------------

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined spellings ends in exactly these two tokens."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._unrolled(left, right)
        return known

    def _unrolled(self, left: int, right: int) -> bool:
        """Undo the merges at the border, latest first.

        A merge across the border that comes before the one just undone would
        have won against it, so the pair can't stand.  On equal footing the
        left one of two overlapping merges wins.
        """
        a, b, before = left, right, None
        while True:
            across = self.merged.get((a, b))
            if across is not None and (before is None or (self.rank[across], 1) < before):
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # a's last merge comes after b's
                before, a = (ra, 1), self.parts[a][1]
            else:  # the border's merge starts left of b's, and so wins a tie
                before, b = (rb, 2), self.parts[b][0]

    # -- encoding ----------------------------------------------------------------------

    def piece(self, text: str) -> bytes:
        if text.isascii():
            word = text[:-1] + self.last[ord(text[-1])]
        else:
            raw = text.encode()
            word = raw[:-1].decode("latin-1") + self.last[raw[-1]]
        size = len(word)
        longest = [0] * size
        for end, (length, token) in self.automaton.iter(word):  # the longest match at an end comes first
            start = end - length + 1
            longest[start] = token  # a later end, so a longer token
        lengths, shorter, compatible = self.length, self.shorter, self.compatible
        alive = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            while token is not None:
                if alive[at + lengths[token]]:
                    fits = True if last < 0 else compatible.get((last, token))
                    if fits or fits is None and self.fits(last, token):
                        break
                token = shorter[token]
            if token is None:  # nothing fits here: the token before was wrong
                alive[at] = 0
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
                continue
            out.append(token)
            at += lengths[token]
            if at == size:
                return b"".join([self.packed[i] for i in out])
            last, token = token, longest[at]

    def chunk(self, text: str) -> bytes:
        if text.isascii() and text.isalpha():  # one piece
            return self.piece(text)
        if self.beyond.search(text):
            pieces = [bytes(self.byte_of[c] for c in p).decode() for p, _ in self.cut(text)]
        else:
            pieces = self.pieces.findall(text)
        return b"".join([self.known(p, self.piece) for p in pieces])

    def known(self, text: str, encoder) -> bytes:
        """From the table, or encoded now; of a full table the entries in use move to a new one."""
        ids = self.kept.get(text)
        if ids is None:
            ids = self.former.get(text)
            if ids is None:
                ids = encoder(text)
            if len(text) <= CHUNK_CHARS_KEPT:
                if len(self.kept) >= CHUNKS_KEPT:
                    self.former, self.kept = self.kept, {}
                self.kept[text] = ids
        return ids

    def plain(self, text: str) -> bytes:
        if not text.isascii() and self.beyond.search(text):
            text = self.normalised(text)
        else:
            text = unicodedata.normalize("NFC", text).lower()
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # split() takes them for white space, the pattern doesn't
        chunks = self.white.split(text) if odd else text.split()
        found = list(map(self.kept.get, chunks))
        if None in found:
            found = [self.known(c, self.chunk) if ids is None else ids for c, ids in zip(chunks, found)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.special_pattern is None or "<|" not in text:
            return self.plain(text)
        return b"".join(np.array([self.special[x]], dtype="<u4").tobytes() if x in self.special else self.plain(x) for x in self.special_pattern.split(text))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4")
        if not len(ids):
            return ""
        start = self.offsets[ids]
        length = self.offsets[ids + np.uint32(1)] - start
        ends = np.cumsum(length)
        take = np.repeat(start - (ends - length), length) + np.arange(ends[-1])
        return self.buffer[take].tobytes()[:-1].decode()


_LOADED: dict[str, Vocabulary] = {}


def _opened(spark: SparkSession, path: str):
    """A function that gives executors the vocabulary: the file, a few MB by nature, is broadcast."""
    with open(path, "rb") as f:
        file = f.read()
    key, sent = hashlib.sha256(file).hexdigest(), spark.sparkContext.broadcast(file)

    def vocabulary() -> Vocabulary:
        if key not in _LOADED:
            _LOADED.clear()
            give_back()  # what the worker kept of other work
            _LOADED[key] = Vocabulary(sent.value)
        return _LOADED[key]

    return vocabulary


def encode(df: DataFrame, vocab: str, text_col: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with its packed ids (binary, little-endian unsigned 32-bit) as column ``to``."""
    vocabulary = _opened(df.sparkSession, vocab)

    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary()
        for batch in batches:
            yield batch.map(v.encode)

    return df.withColumn(to, encoded(text_of(F.col(text_col))))


def decode(df: DataFrame, vocab: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed ids, special tokens included, as column ``to``; null ids give empty text."""
    vocabulary = _opened(df.sparkSession, vocab)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary()
        for batch in batches:
            yield batch.map(lambda x: v.decode(bytes(x)))

    return df.withColumn(to, decoded(F.coalesce(F.col(ids_col), F.lit(b""))))


def round_trip(df: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (packed) and the text decoded from these ids, in one pass."""
    vocabulary = _opened(df.sparkSession, vocab)

    @F.pandas_udf(ROUND_TRIP)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v = vocabulary()
        for batch in batches:
            ids = [v.encode(t) for t in batch]
            yield pd.DataFrame({"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [v.decode(x) for x in ids]})

    out = df.select(F.col(id_col), both(text_of(F.col(text_col))).alias("made"))
    return out.select(id_col, "made.n_tokens", "made.ids", "made.decoded")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The lengths and SHA-256 digests of what ``round_trip`` returns."""
    return encoded.select(id_col, "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
