import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
OURS = bpe.Vocabulary(open(PATH, "rb").read())
THEIRS = Tokenizer.from_file(PATH)


def same(text):
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    packed = OURS.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert OURS.decode(packed) == THEIRS.decode(ids, skip_special_tokens=False)


def test_hard_texts():
    for text in ("", " ", "Hello<|endoftext|> World's it'S", "ΑΣ ΣΑΣ.", "İstanbul ﬁ", "a\x1cb \x85 c", "x" * 3000, "thethe" * 2000, "é" * 300 + "中文字" * 40, "<|startoftext|>x<|endo", "é ́a", "1234 !!!''s"):
        same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abehinorst'", max_size=40))
def test_words(text):
    same(text)


def test_frame(spark, texts, no_texts):
    rows = bpe.digests(bpe.round_trip(texts, PATH)).collect()
    want = []
    for r in texts.collect():
        ids = THEIRS.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(THEIRS.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.round_trip(no_texts, PATH).count() == 0
    both = bpe.decode(bpe.encode(texts, PATH), PATH)
    assert both.where("doc_id = 1").first().decoded == bpe.round_trip(texts, PATH).where("doc_id = 1").first().decoded
