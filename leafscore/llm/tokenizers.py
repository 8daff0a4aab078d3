"""The public tokenizers, loaded once per worker from the files at a given path."""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

from leafscore.llm.pretoken import Encoder


@cache
def library_encoder(path: str) -> Encoder:
    """Encodes by a `tokenizers` file of byte-level pieces; special tokens in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    # A byte is one character in the file's pieces.
    sizes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())])
    return Encoder(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], sizes)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


@cache
def rank_pieces(path: str) -> list[bytes]:
    """The bytes of each id."""
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


@cache
def rank_encoder(path: str) -> Encoder:
    """Encodes by a file of ranks, each match of the pattern separately, without special tokens."""
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    sizes = np.array([len(p) for p in rank_pieces(path)])
    return Encoder(lambda texts: [encoding.encode_ordinary(t) for t in texts], sizes)
