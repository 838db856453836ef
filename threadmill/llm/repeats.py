"""Removal of long byte strings that an earlier document already has.

Longest previous factors: in suffix order, the nearest entries before and after a position that belong to
smaller documents give its longest earlier match; a byte is removed if such a match of at least
``length`` bytes covers it. Pieces that are equal as a whole are settled first, by their bytes. The suffixes that can have one are found first: every string of
``length`` bytes picks its smallest hashed gram as an anchor, equal strings pick equal anchors, and
only anchors that occur in two documents are followed up. Each task then orders the strings around
its share of anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadmill.llm.textarrays import mixed
from threadmill.sources.tables import stage

LENGTH, GRAM = 50, 25
BUCKET_BYTES = 48_000_000  # of text per share of anchors
HOT = 4096  # documents of an anchor from which its strings are dealt out one by one
_WINDOWS = 100_000
_KEY = 6  # bytes of a hash that are kept
_BASE = 0x9E3779B97F4A7C15
_BLOCK, _STEP = 1 << 20, 60_000

_DUP_SCHEMA = "doc_id long, twice binary, hot binary"
_SEGMENTS = "bucket int, doc_id long, keys binary, starts binary, sizes binary, data binary"
_SPANS = "doc_id long, starts binary, stops binary"


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """48-bit hash of every run of ``gram`` bytes: a polynomial, put together from runs of powers of two."""
    n = len(data) - gram + 1
    run, size, done, total = data.astype(np.uint64), 1, 0, None
    while True:
        power = np.uint64(pow(_BASE, size, 1 << 64))
        if gram & size:
            part = run[done : done + n]
            total, done = part if total is None else total * power + part, done + size
        if 2 * size > gram:
            return mixed(total) >> np.uint64(16)
        run, size = run[:-size] * power + run[size:], 2 * size


def _leftmost_least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of every ``width`` neighbouring 48-bit hashes."""
    parts = []
    for b in range(0, len(hashes) - width + 1, _STEP):
        # The place in the lower 16 bits lets the minimum of both tell of the leftmost.
        own = hashes[b : b + _STEP + width - 1]
        least, size = (own << np.uint64(16)) | np.arange(len(own), dtype=np.uint64), 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: len(own) - width + 1], least[width - size :])
        parts.append((least & np.uint64(0xFFFF)).astype(np.int64) + b)
    return np.concatenate(parts)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last start of the strings of every anchor of a document.

    Every string of ``length`` bytes belongs to exactly one anchor, the leftmost of its grams with
    the smallest hash, and the strings of an anchor start side by side.
    """
    if len(data) < length:
        return (np.zeros(0, np.uint64),) + 2 * (np.zeros(0, np.int64),)
    x = np.frombuffer(data, np.uint8)
    hashes = np.concatenate([gram_hashes(x[b : b + _BLOCK + gram - 1], gram) for b in range(0, len(x) - gram + 1, _BLOCK)])
    at = _leftmost_least(hashes, length - gram + 1)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return hashes[at[first]], first, np.append(first[1:], len(at)) - 1


def _packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, _KEY)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :_KEY] = rows
    return out.view("<u8").ravel()


def _per_bucket(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on all rows of one bucket at a time; a bucket holds a bounded share of the text."""
    return rows.groupBy("bucket").applyInPandas(work, schema)


def anchor_rows(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """``(bucket, doc_ids, counts, hashes)``: the distinct anchors of a batch of documents by share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = np.unique(anchors(text.encode(), length, gram)[0])
                if len(found):
                    ids.append(doc_id)
                    keys.append(found)
            if not ids:
                continue
            ids, owner = np.array(ids), np.repeat(np.arange(len(ids)), [len(k) for k in keys])
            flat = np.concatenate(keys)
            # One sort deals out the batch, however many shares there are.
            share = (flat % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(share, kind="stable")
            flat, owner, share = flat[order], owner[order], share[order]
            edges = np.flatnonzero(np.append(True, share[1:] != share[:-1]))
            out = []
            for a, z in zip(edges.tolist(), np.append(edges[1:], len(share)).tolist()):
                new = np.flatnonzero(np.append(True, owner[a + 1 : z] != owner[a : z - 1]))
                counts = np.diff(np.append(new, z - a))
                seen = ids[owner[a:z][new]]
                out.append((int(share[a]), seen.astype("<i8").tobytes(), counts.astype("<i4").tobytes(), _packed(flat[a:z])))
            yield pd.DataFrame(out, columns=["bucket", "doc_ids", "counts", "hashes"])

    return docs.mapInPandas(run, "bucket int, doc_ids binary, counts binary, hashes binary")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """Per document the anchors that another document has too, and those of very many documents."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.repeat(np.frombuffer(d, "<i8"), np.frombuffer(c, "<i4")) for d, c in zip(batch["doc_ids"], batch["counts"])])
        hashes = np.concatenate([_unpacked(h) for h in batch["hashes"]])
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.diff(np.append(starts, len(ordered)))
        many = np.empty(len(ordered), np.int64)
        many[order] = np.repeat(counts, counts)
        out = []
        kept = np.flatnonzero(many > 1)
        kept = kept[np.argsort(ids[kept], kind="stable")]
        edges = np.flatnonzero(np.append(True, ids[kept][1:] != ids[kept][:-1])) if len(kept) else []
        for part in np.split(kept, edges[1:]) if len(kept) else []:
            hot = many[part] > HOT
            out.append((ids[part[0]], _packed(hashes[part]), _packed(hashes[part[hot]])))
        return pd.DataFrame(out, columns=["doc_id", "twice", "hot"])

    return _per_bucket(rows, work, _DUP_SCHEMA)


class _Spans:
    """Removed runs by document; single ones and whole arrays of them."""

    def __init__(self) -> None:
        self._one: list[tuple[int, int, int]] = []
        self._many: list[np.ndarray] = []

    def add(self, doc_id: int, start: int, stop: int) -> None:
        self._one.append((doc_id, start, stop))

    def add_all(self, doc_ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        self._many.append(np.stack([doc_ids, starts, stops], axis=1))

    def rows(self) -> list[tuple[int, bytes, bytes]]:
        """The runs of every document, merged; all documents are laid one behind the other for that."""
        all_runs = np.concatenate([np.array(self._one, np.int64).reshape(-1, 3), *self._many])
        if not len(all_runs):
            return []
        ids, rank = np.unique(all_runs[:, 0], return_inverse=True)
        room = int(all_runs[:, 2].max()) + 2
        starts, stops = merged(all_runs[:, 1:] + (rank * room)[:, None])
        rank = starts // room
        edges = np.searchsorted(rank, np.arange(len(ids) + 1))
        starts, stops = (starts - rank * room).astype("<i8"), (stops - rank * room).astype("<i8")
        return [(i, starts[a:z].tobytes(), stops[a:z].tobytes()) for i, a, z in zip(ids.tolist(), edges[:-1].tolist(), edges[1:].tolist())]


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of (start, stop) as maximal runs; runs that touch become one."""
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]


def segment_rows(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """The strings around repeated anchors, by share; ``docs`` carry ``twice`` and ``hot``.

    Equal strings of a batch leave it once, with the smallest document; for the others of the
    batch the match is proven, and they come out as finished spans in bucket -1. So a line that a
    third of all documents have costs one row a batch. Anchors of very many documents are cut into
    single strings and dealt out by content, as their surroundings may differ in each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[bytes, int] = {}
            spans = _Spans()
            shares: dict[int, list] = {}
            for doc_id, text, twice, hot in sorted(
                zip(batch["doc_id"], batch["text"], batch["twice"], batch["hot"]), key=lambda r: r[0]
            ):
                data = text.encode()
                hashes, first, last = anchors(data, length, gram)
                pick = np.flatnonzero(np.isin(hashes, _unpacked(twice)))
                alone = np.isin(hashes[pick], _unpacked(hot))
                for h, a, b, single in zip(hashes[pick].tolist(), first[pick].tolist(), last[pick].tolist(), alone.tolist()):
                    for start, stop in ((s, s + length) for s in range(a, b + 1)) if single else ((a, b + length),):
                        piece = data[start:stop]
                        owner = known.setdefault(piece, doc_id)
                        if owner < doc_id:
                            spans.add(doc_id, start, stop)
                            continue
                        share = (hash_bytes(piece) if single else h) % buckets
                        shares.setdefault(share, []).append((doc_id, h, start, piece))
            out = [(-1, d, None, s, e, None) for d, s, e in spans.rows()]
            for share, rows in shares.items():
                ids, keys, starts, pieces = zip(*rows)
                sizes = np.array([len(p) for p in pieces], "<i4")
                data = np.array(ids, "<i8").tobytes() + b"".join(pieces)
                out.append((share, len(ids), np.array(keys, "<u8").tobytes(), np.array(starts, "<i8").tobytes(), sizes.tobytes(), data))
            yield pd.DataFrame(out, columns=["bucket", "doc_id", "keys", "starts", "sizes", "data"])

    return docs.mapInPandas(run, _SEGMENTS)


def hash_bytes(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=6).digest(), "little")


def smaller_neighbours(owners: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in suffix order: the nearest one before with a smaller owner, and the common prefix with it.

    ``common[i]`` is the common prefix of entries ``i - 1`` and ``i``. Every entry jumps from one candidate to the
    candidate of that one; all it leaps over has owners that are no smaller, so the jumps double. Without
    a smaller one before the result is -1 and 0.
    """
    at, prefix = np.arange(len(owners)) - 1, common.copy()
    active = np.flatnonzero(at >= 0)
    while len(active):
        active = active[owners[at[active]] >= owners[active]]
        via = at[active]
        jumped, least = at[via], np.minimum(prefix[active], prefix[via])
        at[active], prefix[active] = jumped, least
        active = active[jumped >= 0]
    prefix[at < 0] = 0
    return at, prefix


def longest_previous(ordered: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Longest previous factor of every entry in suffix order, up to the width of ``ordered`` (entries x bytes):
    the common prefix with the nearest entries before and after that belong to a smaller owner."""
    n, width = ordered.shape
    differ = ordered[1:] != ordered[:-1]
    common = np.zeros(n, np.int64)
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    _, before = smaller_neighbours(owners, common)
    # The same from the other end: entry i then stands behind entry i + 1.
    _, after = smaller_neighbours(owners[::-1], np.append(0, common[1:][::-1]))
    return np.maximum(before, after[::-1])


def earlier_matches(pieces: list[bytes], owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and place of every string of ``length`` bytes that a smaller owner's piece has, too.

    All string starts are put in suffix order by their first ``length`` bytes, which is as far as a match has
    to go, and their longest previous factors are taken from their smaller neighbours in that order.
    """
    sizes = np.array([len(p) for p in pieces])
    counts = sizes - length + 1
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    piece = np.repeat(np.arange(len(pieces)), counts)
    ends = np.cumsum(counts)
    place = np.arange(ends[-1]) - (ends - counts)[piece]
    start = base[piece] + place
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, length)[start])
    order = np.argsort(strings.view(f"V{length}").ravel(), kind="stable")
    found = order[longest_previous(strings[order], owners[piece][order]) >= length]
    return piece[found], place[found]


def _strings(batch: pd.DataFrame) -> Iterator[tuple[int, int, int, bytes]]:
    """Document, anchor, start and bytes of every string of a share, one at a time."""
    for n, keys, starts, sizes, data in zip(batch["doc_id"], batch["keys"], batch["starts"], batch["sizes"], batch["data"]):
        at = 8 * n
        numbers = zip(
            np.frombuffer(data[:at], "<i8").tolist(), np.frombuffer(keys, "<u8").tolist(),
            np.frombuffer(starts, "<i8").tolist(), np.frombuffer(sizes, "<i4").tolist(),
        )
        for doc_id, key, start, size in numbers:
            yield doc_id, key, start, data[at : at + size]
            at += size


def share_spans(batch: pd.DataFrame, length: int) -> pd.DataFrame:
    """Removed runs from all strings of one share of anchors."""
    spans = _Spans()
    known: dict[bytes, int] = {}
    for d, _, _, piece in _strings(batch):
        known[piece] = min(d, known.get(piece, d))
    distinct: list[tuple[int, int, int, bytes]] = []
    for d, k, s, piece in _strings(batch):
        if known[piece] < d:
            spans.add(d, s, s + len(piece))
        else:
            distinct.append((k, d, s, piece))
    known.clear()
    distinct.sort(key=lambda r: r[0])
    begin = 0
    while begin < len(distinct):
        end, windows = begin, 0
        # Whole anchors only, as equal strings have equal anchors.
        while end < len(distinct) and (windows < _WINDOWS or distinct[end][0] == distinct[end - 1][0]):
            windows += len(distinct[end][3]) - length + 1
            end += 1
        part = distinct[begin:end]
        owners, starts = np.array([r[1] for r in part], np.int64), np.array([r[2] for r in part], np.int64)
        piece, place = earlier_matches([r[3] for r in part], owners, length)
        spans.add_all(owners[piece], starts[piece] + place, starts[piece] + place + length)
        begin = end
    return pd.DataFrame(spans.rows(), columns=["doc_id", "starts", "stops"])


def kept_bytes(data: bytes, spans: list[tuple[bytes, bytes]]) -> tuple[bytes, int]:
    """What is left of a document, and the number of maximal removed runs."""
    pairs = [np.stack([np.frombuffer(s, "<i8"), np.frombuffer(e, "<i8")], axis=1) for s, e in spans]
    starts, stops = merged(np.concatenate(pairs)) if pairs else merged(np.zeros((0, 2), np.int64))
    edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), len(starts)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Texts are taken as UTF-8, null as empty. A byte goes if a string of ``length`` bytes that
    covers it also starts in a document with a smaller doc_id. Matches stay inside documents, and
    strings are judged on the input. Rows that repeat a doc_id do not count as earlier for each
    other, and are one document: what is found in one of their texts at a place goes from all that
    reach it. Rows without a doc_id neither lose bytes nor make others lose any.

    Equal texts are found by their checksum first: a later copy of ``length`` bytes or more goes as
    a whole and takes no further part.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where(F.col("doc_id").isNotNull())
    # Both sides of the join are written, so that it can be split at a text with very many copies.
    sums = stage(known.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")), "sums")
    first = stage(sums.groupBy("sha").agg(F.min("doc_id").alias("least")), "least")
    narrow = sums.join(first, "sha").groupBy("doc_id").agg(F.max("least").alias("least"))
    narrow = stage(narrow, "firsts")
    spans = repeat_spans(known, narrow, length, gram)
    flags = narrow.join(spans, "doc_id", "left").select("doc_id", "least", "spans")
    joined = rows.join(flags, "doc_id", "left").select("doc_id", "text", "least", "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, least, found in zip(batch["doc_id"], batch["text"], batch["least"], batch["spans"]):
                data = text.encode()
                if not pd.isna(least) and least < doc_id and len(data) >= length:
                    kept, n = b"", 1
                elif found is None:
                    kept, n = data, 0
                else:
                    kept, n = kept_bytes(data, [(s["starts"], s["stops"]) for s in found])
                out.append((None if pd.isna(doc_id) else int(doc_id), len(data), len(data) - len(kept), n, kept))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
            yield frame.astype({"doc_id": "Int64"})

    return joined.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_spans(known: DataFrame, narrow: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of the documents that are the first with their text."""
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, -(-total // BUCKET_BYTES))
    twice = repeated_anchors(anchor_rows(known, buckets, length, gram))
    per_doc = twice.groupBy("doc_id").agg(F.collect_list("twice").alias("twice"), F.collect_list("hot").alias("hot"))
    joint = lambda c: F.aggregate(c, F.lit(b""), lambda a, x: F.concat(a, x)).alias(c)
    firsts = narrow.where("least = doc_id").select("doc_id").join(per_doc, "doc_id").select("doc_id", joint("twice"), joint("hot"))
    # Strings take more memory than anchors, so their shares are smaller.
    segments = stage(segment_rows(known.join(firsts, "doc_id"), 6 * buckets, length, gram), "segments")
    found = _per_bucket(segments.where("bucket >= 0"), lambda b: share_spans(b, length), _SPANS)
    done = segments.where("bucket < 0").select("doc_id", "starts", F.col("sizes").alias("stops"))
    return found.union(done).groupBy("doc_id").agg(F.collect_list(F.struct("starts", "stops")).alias("spans"))


def repeat_digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
