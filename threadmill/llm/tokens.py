"""Token ids and token counts of whole texts with a public byte-level vocabulary.

The ids are those of the vocabulary's own library; its rank form is read by a faster encoder
that gives the same ids (held against each other in the tests). Two ways around the cost of
long and repetitive texts:

* ``PieceEncoder`` cuts a huge document at single blanks between non-blanks, where the splitting pattern
  of the vocabulary always ends a word, and keeps the ids of pieces it has seen;
* ``count_long`` counts a huge document in overlapping chunks, by resynchronisation.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
CHUNK, OVERLAP = 16_384, 256

#: Places where a word of the splitting pattern ends whatever stands around them.
_STABLE = regex.compile(
    r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'\x1c-\x1f])(?=[\s\p{L}\p{N}])"
)
_MARGIN = 2 * max(map(len, SPECIAL))
_TWO_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PIECES, _PIECE_CHARS = 1_000_000, 32_000_000
_WHOLE = 1 << 17


@cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


@cache
def token_bytes(path: str) -> np.ndarray:
    """Length in bytes of every token."""
    e = encoding(path)
    return np.array([len(e.decode_single_token_bytes(i)) for i in range(e.n_vocab)], np.int64)


def encode(path: str, text: str) -> np.ndarray:
    return np.asarray(encoding(path).encode_to_numpy(text, allowed_special="all"), np.uint32)


class PieceEncoder(dict):
    """Ids of whole texts through a bounded table of pieces already encoded.

    Maps a piece to its row of a table of ids. The table is emptied between documents when it
    has become large, so memory does not follow the input. Texts of up to ``whole`` characters are
    encoded as they are, as looking up their pieces costs more than that.
    """

    def __init__(self, path: str, whole: int = _WHOLE):
        super().__init__()
        self.path, self.whole, self.ordinary = path, whole, encoding(path).encode_ordinary
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.chars = 0
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(1 << 14, np.uint32), 0

    def __missing__(self, piece: str) -> int:
        row = len(self)
        ids = encode(self.path, " " + piece) if "<|" in piece else self.ordinary(" " + piece)
        if row == len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * row), np.resize(self.lengths, 2 * row)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[row], self.lengths[row] = self.used, len(ids)
        self.used += len(ids)
        self.chars += len(piece)
        self[piece] = row
        return row

    def ids(self, text: str | None) -> np.ndarray:
        """Token ids of a text; none for null and the empty text."""
        if not text:
            return np.zeros(0, np.uint32)
        if len(text) <= self.whole:
            return encode(self.path, text)
        if len(self) > _PIECES or self.chars > _PIECE_CHARS:
            self._empty()
        plain = text[0] != " " and text[-1] != " " and not _TWO_BLANKS.search(text)
        first, *pieces = text.split(" ") if plain else _CUT.split(text)
        head = encode(self.path, first)
        if not pieces:
            return head
        rows = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[rows] - (ends - lengths), lengths) + np.arange(ends[-1])
        return np.concatenate([head, self.flat[at]])


def _boundaries(path: str, text: str) -> np.ndarray:
    """Byte offsets in ``text`` at which one of its tokens ends."""
    return np.cumsum(token_bytes(path)[encode(path, text)])


def _byte_offset(text: str, at: int) -> int:
    return len(text[:at].encode())


def _cuts_special(text: str, at: int) -> bool:
    """Whether ``at`` lies inside a special string of the vocabulary."""
    return any(text.find(s, max(0, at - len(s) + 1), at + len(s) - 1) != -1 for s in SPECIAL)


def count_long(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a huge text, counted in chunks that overlap.

    The next chunk starts ``overlap`` characters before the end of the last. Both encodings have
    tokens in the overlap; they are spliced at a place where a token of both ends and which is
    proven stable: before it stands a letter, number or sign, after it another kind of character,
    so that the splitting pattern ends a word there whatever comes before, and no special string
    contains it. Places near the two ends of the overlap are left out, as a cut there may have
    changed the words. Where there is no such place, as in one huge word, the overlap is doubled,
    and a chunk that has nothing left to overlap is counted together with the next.
    """
    total, start, size = 0, 0, chunk
    while len(text) - start > size:
        part = text[start : start + size]
        ends = _boundaries(path, part)
        width = min(overlap, size - 1)
        while True:
            nxt = size - width
            following = _boundaries(path, part[nxt:] + text[start + size : start + size + _MARGIN])
            splice = _splice(part, nxt, ends, following)
            if splice or width == size - 1:
                break
            width = min(2 * width, size - 1)
        if splice:
            at, byte = splice
            total += int(np.searchsorted(ends, byte, "right"))
            start, size = start + at, chunk
        else:
            size *= 2
    return total + len(_boundaries(path, text[start:]))


def _splice(part: str, nxt: int, ends: np.ndarray, following: np.ndarray) -> tuple[int, int] | None:
    """Last stable place of the overlap at which both encodings end a token: characters, bytes."""
    base = _byte_offset(part, nxt)
    both = np.intersect1d(ends, following + base)
    places = [m.start() for m in _STABLE.finditer(part, nxt + _MARGIN, len(part) - _MARGIN)] if len(both) else []
    for at in reversed(places):
        byte = _byte_offset(part, at)
        i = np.searchsorted(both, byte)
        if i < len(both) and both[i] == byte and not _cuts_special(part, at):
            return at, byte
    return None


def token_count(text: str | Column, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Number of tokens of a text column; 0 for null and the empty text."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoding(path)
        for texts in batches:
            yield pd.Series(
                [
                    0 if not t
                    else count_long(path, t, chunk, overlap) if len(t) > chunk
                    else len(e.encode_to_numpy(t, allowed_special="all"))
                    for t in texts
                ],
                dtype="int64",
            )

    return count(F.col(text) if isinstance(text, str) else text)


def count_tokens(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``).

    Map-only: nothing is shuffled and a lost task is simply read again. Null texts count as
    empty. Repeated rows and null ids each give a row of their own; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select("doc_id", text.alias("text"))
        .withColumn("n_tokens", token_count("text", path))
        .select(
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            "n_tokens",
            (F.col("n_tokens") > limit).alias("over_limit"),
        )
    )
