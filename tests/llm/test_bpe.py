from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import bpe
from millrace.llm.queries import table


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


PARTS = "the and tion ing er re on at en nd ha ciónmente eau é ü ß 's 've 12 !! @ $ aaa ab İ ſ <|endoftext|> ー 汉字 👩‍👩‍👧 é".split()


@pytest.mark.parametrize("leaf", [2, 5, 64])
def test_tree_concatenation_gives_the_library_s_tokens(library, leaf):
    codec = bpe.Codec(bpe.default_vocabulary(), leaf)
    rng = random.Random(leaf)
    for _ in range(600):
        alphabet = rng.choice([PARTS, "ab", "abcdefghijklmnopqrstuvwxyz", "aeinrst'é", "a"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 150)))
        assert codec.segment(text) == library.encode(text, add_special_tokens=False).ids, text


def test_long_unsplit_texts(library):
    codec = bpe.Codec(bpe.default_vocabulary())
    rng = random.Random(9)
    for alphabet in ("a", "abc", "etaoinshrdlu", "the ing tion and".split()):
        text = "".join(rng.choice(alphabet) for _ in range(20_000))
        assert codec.segment(text) == library.encode(text, add_special_tokens=False).ids


def test_joins_happen_in_the_texts_of_a_table(spark, library, monkeypatch):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    joins, join = [], bpe.join
    monkeypatch.setattr(bpe, "join", lambda a, b, *rest: joins.append(1) or join(a, b, *rest))
    codec = bpe.Codec(bpe.default_vocabulary())
    for text, (ids, decoded) in zip(texts, codec.rows(texts), strict=True):
        tokens = library.encode(text, add_special_tokens=False).ids
        assert ids == np.asarray(tokens, "<u4").tobytes()
        assert decoded == library.decode(tokens, skip_special_tokens=False)
    assert len(joins) > 1000


def test_added_tokens_in_long_segments(library):
    codec = bpe.Codec(bpe.default_vocabulary())
    for text in ("etaoin" * 9 + "<|endoftext|>" + "shrdlu" * 9, "<|endoftext|>" * 40, "x" * 30 + "<|startoftext|><|end" + "y" * 30, "É" * 20 + "<|endoftext|>'s"):
        assert codec.segment(text) == library.encode(text, add_special_tokens=False).ids, text


def test_white_space_of_all_kinds(spark, library):
    texts = [None, "", "  ", " a\x1cb\x85c d e f　g ", "́a e ́x <|endoftext|> <|startoftext|>x", "A\r\n\tB\x0bC\x0c", "x" * 300 + " " + "y" * 300, "don't DON'T 'll", "word " * 30_000]
    docs = spark.createDataFrame([(i if i else None, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest(docs).collect()}
    assert got == {(i or None): want(library, t) for i, t in enumerate(texts)}
    assert bpe.digest(docs.limit(0)).collect() == []


def test_ids_come_out_too(spark, library):
    docs = spark.createDataFrame([(1, "Some text here"), (1, "Some text here"), (2, "")], "doc_id long, text string")
    got = [(r.doc_id, r.token_ids) for r in bpe.encode(docs, ["doc_id"]).orderBy("doc_id").collect()]
    ids = library.encode("Some text here", add_special_tokens=False).ids
    assert got == [(1, ids), (1, ids), (2, [])]


def test_whole_table(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest(docs).collect()}
    assert got == {r.doc_id: want(library, r.text) for r in docs.collect()}
