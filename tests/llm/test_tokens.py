import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from cardwatch.llm import bpe, common, registry, token_counts

PATH = P.path(bpe.VOCABULARY)
HARD = ["", "a" * 3000, " " * 4000, "aaaab" * 500, "é" * 700, "don't 'LL 're'S", "x<|endoftext|><|endoftext|>y", "\n\n \t x  \r\n\x1c\x85 z",
        "1" * 1500, "٣٤ ²³¼ⅷ 一二", "a​b﻿　c", "ǅ ɐ ʰ ß ﬁ"]


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.read_ranks(common.file_bytes(PATH)), P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_hard_texts_as_the_library(coder, library):
    for text in HARD:
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()


def test_all_latin_and_some_other_code_points(coder, library):
    for start in [*range(0, 0x3000, 256), 0x4E00, 0xAC00, 0xFF00, 0x1F300, 0x1D400]:
        text = "\n".join(f"a{chr(c)}b 1{chr(c)}2" for c in range(start, start + 256))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_backtracking_equals_plain_merges(coder):
    rng = np.random.default_rng(2)
    for _ in range(400):
        piece = bytes(rng.choice(list(b"etaoinshr "), rng.integers(1, 30)).tolist())
        assert [coder.tokens[t] for t in coder.backtrack(piece)] == coder.merge(piece)


def test_encode_and_decode_odd_rows(spark, odd, library):
    out = bpe.encode(odd, PATH, P.PATTERN)
    back = bpe.decode(out, PATH, P.PATTERN).collect()
    assert len(back) == odd.count() and "score" in out.columns
    for r in back:
        text = r["text"] or ""
        assert r["ids"] == library.encode_ordinary(text) and bytes(r["decoded"]).decode() == text
        assert r["n_tokens"] == len(r["ids"]) and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op2_as_the_library(spark, library):
    got = {r["doc_id"]: r for r in registry.QUERIES["op2_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"])
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]]["n_tokens"] == len(ids)


def test_counts_as_the_library(spark, odd):
    tokenizer = Tokenizer.from_file(P.path(token_counts.VOCABULARY))
    table = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + k, t) for k, t in enumerate(HARD)], "doc_id long, text string"))
    for r in token_counts.count(table, P.path(token_counts.VOCABULARY), P.PATTERN).collect():
        text = r["text"] or ""
        assert r["n_tokens"] == len(tokenizer.encode(text, add_special_tokens=False).ids), text[:40]
        assert r["n_bytes"] == len(text.encode())


def test_op7_as_the_library(spark):
    tokenizer = Tokenizer.from_file(P.path(token_counts.VOCABULARY))
    got = {r["doc_id"]: r for r in registry.QUERIES["op7_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids)
        assert got[r["doc_id"]]["n_tokens"] == n and got[r["doc_id"]]["over_limit"] == (n > 1024)


def test_proven_strings_are_single_tokens():
    model = token_counts.prove(common.file_bytes(P.path(token_counts.VOCABULARY)))
    ranks = {base64.b64decode(a) for a, _ in (x.split() for x in common.file_bytes(PATH).splitlines())}
    assert model.proven <= ranks and len(model.proven) > 50_000
    assert token_counts.merged_size(b"a" * 200, model.merges) == token_counts.merged_size(b"a" * 200, model.merges | {})


def test_empty_tables(spark, none):
    assert bpe.encode(none, PATH, P.PATTERN).count() == 0
    assert token_counts.count(none, P.path(token_counts.VOCABULARY), P.PATTERN).count() == 0


def test_long_pieces_take_time_in_proportion():
    import time

    model = token_counts.prove(common.file_bytes(P.path(token_counts.VOCABULARY)))
    library = Tokenizer.from_file(P.path(token_counts.VOCABULARY))
    rng = np.random.default_rng(6)
    piece = lambda n: "".join(rng.choice(list("etaoinshrdlu"), n))
    for text in [piece(65), piece(300), piece(5_000), "ab" * 400, "a" * 1_001, "the" * 300]:
        assert token_counts.merged_size(text.encode(), model.merges) == len(library.encode(text, add_special_tokens=False).ids)
    seconds = []
    for n in (100_000, 1_000_000):
        data, begin = piece(n).encode(), time.process_time()
        token_counts.merged_size(data, model.merges)
        seconds.append((time.process_time() - begin) / n)
    assert seconds[1] < 2.5 * seconds[0], seconds
