import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from leafscore.llm import bpe, pretoken, token_files
from leafscore.llm.tokenizers import library_encoder, rank_encoder, rank_pieces, read_ranks

LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def by_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(LIBRARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def by_ranks():
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}).encode_ordinary


def each(encoder, texts):
    ids, offsets = encoder(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


ODD = ["'s", "'", "'re", "s", "t", "L", " ", "  ", "\n", "\t", "1", "²", "!", "...", "é", "中", " ", "　", "''", "don't", "\x1c", "​", "́", "<|endoftext|>", "\x85", "x" * 300]


def test_both_libraries_agree_with_their_own_encoding(by_library, by_ranks):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 20))) for _ in range(3000)]
    assert each(library_encoder(LIBRARY), texts) == [by_library(t) for t in texts]
    assert each(rank_encoder(RANKS), texts) == [by_ranks(t) for t in texts]


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    own = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    assert each(rank_encoder(RANKS), texts) == [own.encode_ordinary(t) for t in texts]


def test_a_full_memory_of_pretokens_is_emptied(monkeypatch, by_ranks):
    monkeypatch.setattr(pretoken, "KEPT", 5)
    encoder = rank_encoder.__wrapped__(RANKS)
    for text in ("one two three four", "five six seven eight nine ten", "one five"):
        assert each(encoder, [text]) == [by_ranks(text)]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=100))
@settings(deadline=None)
def test_numbers_round_trip(values):
    control, data = token_files.pack(np.array(values, np.uint32))
    assert token_files.unpack(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_token_files_equal_the_library(spark, odd_docs, odd_rows, no_docs, by_library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc, text in rows:
        ids = by_library(text or "") + [2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_files.token_report(odd_docs, LIBRARY).collect()), key=lambda r: r[1])
    assert got == want
    assert token_files.token_report(no_docs, LIBRARY).collect() == []


def digests(rows, encode):
    out = []
    for doc, text in rows:
        ids = encode(text or "")
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("chunk,overlap", [(16384, 1024), (200, 30), (64, 20)])
def test_chunks_are_stitched_to_the_whole(odd_docs, odd_rows, by_ranks, chunk, overlap):
    got = bpe.encoded(odd_docs, RANKS, chunk, overlap).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, r)) == digests(odd_rows, by_ranks)


def test_no_texts(no_docs):
    assert bpe.encoded(no_docs, RANKS).collect() == []


def test_stitching_by_hand(by_ranks):
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 60)))
        parts = bpe.chunked(text, 24, 12)
        found = bpe.places([(len(p), *bpe.overlaps(p, 24, 12)) for p in parts], 24)
        pieces = {}
        for part, (piece, begin, end, alone) in zip(parts, found):
            assert alone == (sum(f[0] == piece for f in found) == 1) or not alone
            pieces[piece] = pieces.get(piece, "") + part[begin:end]
        assert "".join(pieces.values()) == text
        assert sum((by_ranks(p) for p in pieces.values()), []) == by_ranks(text)


def test_decoding_gives_the_bytes_back(by_ranks):
    text = "á 🎉 don't \x00 日本"
    assert bpe.decode(np.array(by_ranks(text)), rank_pieces(RANKS)) == text.encode()
