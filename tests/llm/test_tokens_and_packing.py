import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadmill.llm import packing, tokens

ODD = [
    None, "", " ", "  a", "a  ", "it's 're<|endoftext|> y", "<|endoftext|>", "a\n b \n\n c\t d", "x" * 9000, "² 12½ a_b",
    "\x1c a \x1d b", "日本語。テスト ですよ", "'s 's DON'T", "🙂 🙂🙂", "word " * 9000, "one", "one",
]
PATH = public_tokenizers.path(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_library(library):
    encoder = tokens.PieceEncoder(PATH)
    for text in ODD:
        assert encoder.ids(text).tolist() == library(text)


@pytest.mark.parametrize("whole", [0, 8, 10_000])
def test_whole_texts_and_pieces_give_the_same_ids(library, whole):
    encoder = tokens.PieceEncoder(PATH, whole)
    assert encoder.ids("a b a").tolist() == library("a b a") and len(encoder) == 2 * (whole == 0)
    for text in ODD:
        known = len(encoder)
        assert encoder.ids(text).tolist() == library(text)
        assert len(text or "") > whole or len(encoder) == known


@pytest.mark.parametrize("chunk, overlap", [(40, 30), (200, 64), (3000, 100)])
def test_resynchronised_counts(library, chunk, overlap):
    for text in [*ODD[1:], "<|endoftext|>".join(["ab 'sd're, 12. " * 40, "z" * 700, "q r\n\n s"])]:
        assert tokens.count_long(PATH, text, chunk, overlap) == len(library(text))


def test_counts_by_row(docs_of, library):
    rows = list(enumerate(ODD))
    got = {r.doc_id: r for r in tokens.count_tokens(docs_of(rows)).collect()}
    for i, text in rows:
        assert got[i].n_tokens == len(library(text))
        assert got[i].n_bytes == len((text or "").encode())
        assert got[i].over_limit == (got[i].n_tokens > 1024)


def test_packing_is_a_round_trip(docs_of, library):
    rows = list(enumerate(ODD))
    pieces = packing.pack(docs_of(rows).coalesce(1), length=256).toPandas()
    for i, text in rows:
        own = pieces[pieces.doc_id == i].sort_values("start")
        ids = np.frombuffer(b"".join(own.ids), "<u4").tolist()
        assert ids == [*library(text), 1]
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]]
        assert set(own.doc_tokens) == {len(ids)}
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.length.sum() <= 256
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]]
    lengths = pieces.groupby("sequence_id").length.sum()
    padded = [n if n & (n - 1) == 0 else 256 for n in lengths]
    assert lengths.sum() > 0.95 * sum(padded)


def test_cuts_are_the_best_ones():
    rng = np.random.default_rng(1)
    costs = packing.Costs(window=3)
    for _ in range(50):
        ends = np.unique(rng.integers(1, 60, 25))
        ends = np.unique(np.concatenate([ends, np.arange(6, 60, 6), [60]]))
        penalty = rng.integers(0, 9, len(ends))
        cost = {0: 0}
        for e, p in zip(ends, penalty):
            options = []
            for s, c in cost.items():
                n = e - s
                if 0 < n <= 16:
                    options.append(c + (0 if n in (8, 16) else 16 - n) + p + 3)
            cost[e] = min(options)
        want = min(c + 60 - e for e, c in cost.items() if e >= 60 - 16 and e > 0)
        cuts = packing.cut(ends, penalty, 16, costs)
        at, got = 0, 0
        for c in cuts:
            got += (0 if c - at in (8, 16) else 16 - (c - at)) + penalty[list(ends).index(c)] + 3
            at = c
        assert got + 60 - at == want


def test_digests_and_empty_table(docs_of):
    one = packing.piece_digests(packing.pack(docs_of([(7, None)]))).collect()
    assert [(r.doc_id, r.length, r.ids_crc32) for r in one] == [(7, 1, zlib.crc32(b"\x01\0\0\0"))]
    assert packing.pack(docs_of([])).count() == 0
    assert tokens.count_tokens(docs_of([])).count() == 0
