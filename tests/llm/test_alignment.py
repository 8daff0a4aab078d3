import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from leafscore.llm import alignment
from tests.llm.conftest import DOCS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    """text -> [(id, bytes)] of each tokenizer, by the libraries alone."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    ends = {}

    def by_a(text):
        # The byte of a character of byte-level entries, learned from one-byte texts and offsets of the library.
        out = []
        for i in tokenizer.encode(" " + text, add_special_tokens=False).ids:
            out.append((i, b"".join(ends[c] for c in tokenizer.id_to_token(i))))
        return out

    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = 256
    for byte in range(256):
        if byte in own:
            ends[chr(byte)] = bytes([byte])
        else:
            ends[chr(spare)] = bytes([byte])
            spare += 1

    def by_b(text):
        out = []
        for i in model.encode(text):
            p = model.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()))
        return out

    return by_a, by_b


def brute(rows, libraries):
    docs, counts = [], Counter()
    for doc, text in rows:
        a, b = (f(text or "") for f in libraries)
        if not text or b"".join(x for _, x in a) != (" " + text).encode() or b"".join(x for _, x in b) != (" " + text).encode():
            docs.append((doc, [], [], [], []))
            continue

        def spans(tokens):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            return out

        a, b = spans(a), spans(b)
        links, first = [], 0
        for x, s, e in a:
            while b[first][2] <= s:
                first += 1
            j = first
            while j < len(b) and b[j][1] < e:
                links.append((x, b[j][0]))
                j += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        by_end = {}
        for cut in cuts:
            by_end[cut] = ([x for x, s, e in a if begin <= s and e <= cut], [x for x, s, e in b if begin <= s and e <= cut])
            begin = cut
        groups = list(by_end.values())
        counts.update(links)
        docs.append((doc, a, b, groups, links))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(counts[link] == most[link[1]] for link in links)
        out.append((doc, len(a), len(b), len(groups), len(links), digest, best, sum(counts[link] for link in links)))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def ordered(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


ODD = ["a", " ", "  ", "\n", "é", "▁", "日本", "<0x41>", "<s>", "<|endoftext|>", "\x00", "🎉", "ing", " the", "’", "½", "\t", "x" * 300]


def test_pieces_word_by_word_equal_the_library():
    rng = random.Random(1)
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = ["".join(rng.choices(ODD, k=rng.randint(1, 20))) for _ in range(2000)]
    encoder, _ = alignment.piece_level(B)
    ids, offsets = encoder([" " + t for t in texts])
    # The library reads the mark of a space as a space; such texts have no tokens in the end.
    plain = [(t, ids[x:y].tolist()) for t, x, y in zip(texts, offsets, offsets[1:]) if "▁" not in t]
    assert [found for _, found in plain] == [model.encode(t) for t, _ in plain]


@pytest.mark.parametrize("section,ahead", [(256, 64), (4, 2), (1, 1)])
def test_lockstep_by_hand(section, ahead, monkeypatch):
    monkeypatch.setattr(alignment, "SECTION", section)
    monkeypatch.setattr(alignment, "AHEAD", ahead)
    rng = np.random.default_rng(5)
    for _ in range(60):
        bounds = np.cumsum(rng.integers(1, 40, rng.integers(1, 6)))
        ends, offs = [], []
        for _ in range(2):
            e = np.unique(np.append(bounds, rng.integers(1, bounds[-1] + 1, rng.integers(0, 2 * bounds[-1]))))
            ends.append(e)
            offs.append(np.append(0, np.searchsorted(e, bounds) + 1))
        link_a, link_b, cut_a, cut_b = alignment.lockstep(*ends, *alignment.sections(*ends, *offs))
        starts = [np.append(0, e[:-1]) for e in ends]
        want = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])}
        assert len(link_a) == len(want) and set(zip(link_a.tolist(), link_b.tolist())) == want
        assert sorted(ends[0][cut_a].tolist()) == sorted(ends[1][cut_b].tolist()) == sorted(set(ends[0].tolist()) & set(ends[1].tolist()))


@pytest.mark.parametrize("sent", [alignment.SENT, 0])
def test_odd_rows(spark, odd_docs, odd_rows, no_docs, libraries, sent):
    got = ordered(alignment.alignment_report(odd_docs, A, B, sent))
    assert got == brute(odd_rows, libraries)
    assert alignment.alignment_report(no_docs, A, B, sent).collect() == []


def test_controls_marks_and_a_long_text(spark, libraries):
    rng = random.Random(2)
    texts = ["".join(rng.choices(ODD, k=rng.randint(1, 30))) for _ in range(200)]
    texts.append(" ".join(rng.choices(["word", "other", "größer", "日本語"], k=250_000)))  # more than a piece
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).repartition(3)
    got = {r[0]: r for r in ordered(alignment.alignment_report(docs, A, B))}
    small = [r for r in rows if r[0] < 200]
    assert got[200][1] > 250_000 and got[200][4] >= max(got[200][1:3])
    want = {r[0]: r for r in brute(small, libraries)}
    assert [got[d][:6] for d, _ in small] == [want[d][:6] for d, _ in small]


def test_groups_are_given_as_text(spark):
    docs = spark.createDataFrame([(1, "hi there", None, None, None)], DOCS)
    row = alignment.aligned(docs, A, B).first()
    assert len(row["groups"].split(";")) == row["n_groups"] and row["groups"].count("|") == row["n_groups"]
