"""Packing of documents into sequences of bounded length.

Order-preserving dynamic programming: the documents of a task form one stream of tokens, cut
into windows of at most ``length`` tokens. Windows may end at document ends, sentence ends and
the points of a fine grid; the programme chooses the ends that minimise padding plus penalties
for cut documents. The best start of a window is the minimum over a sliding range, which a
monotone queue gives in constant time. A window whose length is a power of two needs no padding, so one
of half the length is tried as well.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from threadmill.llm.tokens import VOCABULARY, PieceEncoder, encoding


@dataclass(frozen=True)
class Costs:
    """In tokens of padding. A window costs ``window`` itself, so that short ones are not free."""

    sentence: int = 4
    free: int = 16
    window: int = 8
    grid: int = 16


LENGTH, END_ID, BLOCK = 2048, 1, 1 << 20
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


@cache
def _ends_sentence(path: str) -> np.ndarray:
    """For every token whether it ends with a sentence mark or holds a line break."""
    e = encoding(path)
    tokens = (e.decode_single_token_bytes(i) for i in range(e.n_vocab))
    return np.array([t.endswith((b".", b"!", b"?")) or b"\n" in t for t in tokens])


def cut(ends: np.ndarray, penalty: np.ndarray, length: int, costs: Costs) -> list[int]:
    """Best window ends of a stream.

    ``ends`` are the possible ends in ascending order, the last of them the end of the stream;
    gaps are at most ``length``. Returns the chosen ends, up to the cheapest one within
    ``length`` of the end; what lies behind it is for the next block.
    """
    position = [0, *ends.tolist()]
    extra = [0, *(penalty + costs.window).tolist()]
    n, stop = len(position), position[-1]
    lookup = np.full(stop + 1, -1, np.int64)
    lookup[position] = np.arange(n)
    half = 1 << (length - 1).bit_length() - 1
    at = np.asarray(position) - half
    exact = np.where(at >= 0, lookup[np.maximum(at, 0)], -1).tolist()
    best, came = [0], [-1]
    # Candidates with ascending best + position: the least of the sliding range comes first.
    keys, items, places = deque([0]), deque([0]), deque([0])
    for j in range(1, n):
        p = position[j]
        while places[0] < p - length:
            places.popleft(), keys.popleft(), items.popleft()
        value, i = keys[0] + length - p, items[0]
        if (k := exact[j]) >= 0 and best[k] < value:
            value, i = best[k], k
        value += extra[j]
        best.append(value)
        came.append(i)
        value += p
        while keys and keys[-1] >= value:
            keys.pop(), items.pop(), places.pop()
        keys.append(value), items.append(j), places.append(p)
    first = next(j for j in range(1, n) if position[j] >= stop - length)
    j = min(range(first, n), key=lambda k: best[k] + stop - position[k])
    out = []
    while j > 0:
        out.append(position[j])
        j = came[j]
    return out[::-1]


class _Stream:
    """The tokens of the documents of one task that are not packed yet."""

    def __init__(self, path: str, length: int, costs: Costs, task: int):
        self.path, self.length, self.costs = path, length, costs
        self.next_id = task << 33
        self.docs: list[tuple[object, int, int, np.ndarray]] = []  # id, first token, all tokens, ids
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids), ids))
        self.tokens += len(ids)

    def pack(self, last: bool) -> pd.DataFrame:
        ids = np.concatenate([d[3] for d in self.docs])
        doc_ends = np.cumsum([len(d[3]) for d in self.docs])
        ends, penalty = self._candidates(ids, doc_ends)
        cuts = cut(ends, penalty, self.length, self.costs)
        if last and cuts[-1] != len(ids):
            cuts.append(len(ids))
        return self._rows(ids, doc_ends, np.array(cuts))

    def _candidates(self, ids: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every document end, and per cell of the grid its last sentence end, or else its end."""
        cell, n = self.costs.grid, len(ids)
        last = np.minimum(np.arange(cell, n + cell, cell), n)
        penalty = np.full(len(last), self.costs.free)
        sentences = np.flatnonzero(_ends_sentence(self.path)[ids]) + 1
        cells = (sentences - 1) // cell
        final = np.flatnonzero(np.append(cells[1:] != cells[:-1], True)) if len(cells) else cells
        last[cells[final]], penalty[cells[final]] = sentences[final], self.costs.sentence
        kept = ~np.isin(last, doc_ends)
        ends = np.concatenate([last[kept], doc_ends])
        order = np.argsort(ends, kind="stable")
        return ends[order], np.concatenate([penalty[kept], np.zeros(len(doc_ends), np.int64)])[order]

    def _rows(self, ids: np.ndarray, doc_ends: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
        done = int(cuts[-1])
        doc_starts = np.concatenate([[0], doc_ends[:-1]])
        starts = np.unique(np.concatenate([doc_starts[doc_starts < done], [0], cuts[:-1]]))
        ends = np.concatenate([starts[1:], [done]])
        doc = np.searchsorted(doc_ends, starts, "right")
        window = np.searchsorted(cuts, starts, "right")
        window_starts = np.concatenate([[0], cuts[:-1]])
        data = ids.astype("<u4")
        first = np.array([d[1] for d in self.docs], np.int64)
        rows = pd.DataFrame(
            {
                "doc_id": pd.array([self.docs[i][0] for i in doc], dtype="Int64"),
                "start": starts - doc_starts[doc] + first[doc],
                "length": ends - starts,
                "ids": [data[a:b].tobytes() for a, b in zip(starts, ends)],
                "doc_tokens": np.array([d[2] for d in self.docs], np.int64)[doc],
                "sequence_id": self.next_id + window,
                "offset": starts - window_starts[window],
            }
        )
        self.next_id += len(cuts)
        keep = int(np.searchsorted(doc_ends, done, "right"))
        rest = self.docs[keep:]
        if rest and (used := done - int(doc_starts[keep])) > 0:
            doc_id, begun, total, own = rest[0]
            rest[0] = (doc_id, begun + used, total, own[used:])
        self.docs, self.tokens = rest, self.tokens - done
        return rows


def pack(
    docs: DataFrame, length: int = LENGTH, costs: Costs = Costs(), end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``length`` tokens.

    Each row of ``docs`` gives the ids of its text (null: none) and ``end_id``; a piece is a run
    of them: doc_id, start, length, ids (little-endian 32-bit numbers), doc_tokens, sequence_id,
    offset. The order of the table is kept inside a task. Nothing is shuffled: every task packs
    its own part of the table in blocks of about a million tokens, so its memory is bounded, and
    only its last sequence can be short. A task that is run again gives the same ids, as its
    part and its number stay the same. Repeated rows are packed each; other columns are ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PieceEncoder(path)
        stream = _Stream(path, length, costs, TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                stream.add(None if pd.isna(doc_id) else int(doc_id), np.concatenate([encoder.ids(text), end]))
                if stream.tokens >= BLOCK:
                    yield stream.pack(last=False)
        if stream.tokens:
            yield stream.pack(last=True)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
