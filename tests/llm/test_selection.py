"""Hard negatives, source mixes and whitening against plain computations."""

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadmill.llm import feast, mixing, negatives, whitening

VECTORS = "vec_id long, label int, embedding array<float>, score string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, l, e, "x") for i, l, e in rows], VECTORS)


def _mined_plainly(rows, anchor, k=5, n=5):
    good = [
        (i, l, [math.floor(256 * x) for x in e]) for i, l, e in rows
        if i is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = set()
    for i, l, e in good:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(e, f)), j, m) for j, m, f in good if j != i and len(f) == len(e)]
        for s, p, _ in sorted(x for x in scored if x[2] == l)[:k]:
            fits = sorted(x for x in scored if x[2] != l and 80 * -s <= 100 * -x[0] <= 100 * -s)
            out |= {(i, p, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(fits[:n])}
    return out


@pytest.mark.parametrize("slice_rows,group_rows", [(4096, 2048), (50, 7)])
def test_hard_negatives_against_all_pairs(shipped, slice_rows, group_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 12))
    rows = []
    for i in range(600):
        # Lengths differ by a factor of 40, a third of the rows has one label, and scores tie often.
        x = np.round((centres[i % 9] + 0.4 * rng.normal(size=12)) * rng.choice([0.05, 0.5, 1, 2]), 1)
        rows.append((i, 0 if i % 3 == 0 else int(rng.integers(1, 5)), [float(v) for v in x.astype(np.float32)]))
    rows += [(900, 1, [0.0] * 12), (1000, 1, rows[5][2]), (1001, 2, rows[5][2]), (1002, 0, [1.0, 2.0])]
    got = negatives.hard_negatives(
        _vectors(shipped, rows), F.col("vec_id") % 10 == 0, slice_rows=slice_rows, group_rows=group_rows
    )
    want = _mined_plainly(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_hard_negatives_of_odd_rows(shipped):
    anchor = F.col("vec_id") % 2 == 0
    assert negatives.hard_negatives(_vectors(shipped, []), anchor).count() == 0
    nan, inf = float("nan"), float("inf")
    rows = [
        (2, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]), (3, 1, [1.0, 0.0]), (3, 1, [1.0, 0.0]), (5, 2, [0.9, 0.0]),
        (None, 2, [0.9, 0.0]), (7, None, [0.9, 0.0]), (9, 2, None), (11, 2, [0.9, None]), (13, 2, [0.9, nan]),
        (15, 2, [0.9, inf]), (17, 2, []), (19, 2, [1.0]), (21, 2, [0.0, 0.0]), (23, 2, [1e30, 0.0]),
    ]
    got = [tuple(r) for r in negatives.hard_negatives(_vectors(shipped, rows), anchor).collect()]
    assert got == [(2, 3, 1, 5, 65536, 256 * 230)]


def test_pruned_buckets_lose_no_row():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(400, 16)) * rng.uniform(0.1, 2, (400, 1)))
    pruned = 0
    for bucket in negatives.buckets(np.arange(400), np.arange(400), x, 64):
        for q in x[:40]:
            length = float(np.linalg.norm(q))
            for least in (-3e5, 0.0, 1e5, 5e5, 1.5e6):
                rows = bucket.candidates(q, length, least)
                rows = set() if rows is None else set(rows.tolist())
                assert set(np.flatnonzero(bucket.x @ q >= least).tolist()) <= rows
                pruned += len(bucket.ids) - len(rows)
    assert pruned > 15000


def _sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, _, t in rows]


def _level_plainly(sizes, weights, epochs):
    """Targets by clamping and sharing again, in fractions."""
    target, free, left = {}, set(sizes), Fraction(sum(sizes.values()))
    while free:
        weight = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / weight > epochs * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / weight for s in free}
        target |= {s: Fraction(epochs * sizes[s]) for s in over}
        free -= over
        left -= sum(target[s] for s in over)
    return target


def _docs(spark, rows):
    return spark.createDataFrame(
        [(i, s, t, 0.5, "x") for i, s, t in rows], "doc_id long, source string, text string, target double, place string"
    )


def _mix_rows(n=3000):
    rng = np.random.default_rng(6)
    rows = [(i, "big" if i % 3 == 0 else f"s{rng.integers(0, 7)}", "w " * int(rng.integers(0, 60))) for i in range(n)]
    rows += [(n, "giant", "word " * 30000), (n + 1, "tiny", "one"), (n + 2, None, "a b c\n\n d\x1fe"), (n + 3, None, None)]
    rows += [(n + 4, "", "\t \n"), (None, "tiny", "two words"), (5, "big", "again  and"), (5, "big", "again  and")]
    return rows


def test_mix_takes_its_targets(spark):
    rows = _mix_rows()
    got = [r.asDict() for r in mixing.mix(_docs(spark, rows)).collect()]
    names = sorted({s for _, s, _ in rows if s is not None}) + [None]
    sizes = dict.fromkeys(names, 0)
    for (_, s, _), n in zip(rows, _sizes(rows)):
        sizes[s] += n
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want = _level_plainly(sizes, weights, 3)
    assert any(want[s] == 3 * sizes[s] > 0 for s in names) and any(0 < want[s] < sizes[s] for s in names)
    assert len(got) == len(rows)
    taken = dict.fromkeys(names, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["whole"] * r["size"] + r["part"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == math.floor(want[s] + Fraction(1, 2)) for s in names)
    # At most one document of a source is taken in part; the others follow the seeded order.
    for s in names:
        part = [r for r in got if r["source"] == s and 0 < r["part"] < r["size"]]
        assert len(part) <= 1
        place = lambda r: hashlib.md5(f"mix:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:15]
        more = [place(r) for r in got if r["source"] == s and r["size"] and r["part"] == r["size"]]
        less = [place(r) for r in got if r["source"] == s and r["size"] and not r["part"]]
        assert not more or not less or max(more) <= min(less)
    again = mixing.mix(_docs(spark, rows[::-1]).repartition(5))
    key = lambda r: tuple(str(v) for v in r.values())
    assert sorted(map(key, got)) == sorted(key(r.asDict()) for r in again.collect())
    other = {r.doc_id: r.taken for r in mixing.mix(_docs(spark, rows), seed="2").collect()}
    assert other != {r["doc_id"]: r["taken"] for r in got}


def test_mix_with_named_weights_and_budget(spark):
    rows = [(i, s, "w " * 10) for i, s in enumerate("aaabbbccc")] + [(20, None, "x " * 10)]
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0), (None, 0.0), ("none", 9.0)], "source string, weight double")
    got = {(r.source, r.doc_id): r for r in mixing.mix(_docs(spark, rows), weights, epochs=2, budget=1000).collect()}
    assert {s: r.target for (s, _), r in got.items()} == {"a": 60.0, "b": 60.0, "c": 0.0, None: 0.0}
    assert all(r.taken == (20 if s in ("a", "b") else 0) for (s, _), r in got.items())
    got = mixing.mix(_docs(spark, rows), weights, budget=40).collect()
    assert {r.source: r.target for r in got} == {"a": 30.0, "b": 10.0, "c": 0.0, None: 0.0}
    assert mixing.mix(_docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(_docs(spark, [(1, "a", ""), (2, None, None)])).collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixing.mix(_docs(spark, rows), epochs=1.5)


def test_words_are_counted_in_linear_time(spark):
    texts = [" " * 2_000_000, "a" * 2_000_000, "a " * 1_000_000, " x\x1c y", "😀"[0:0] + "\U0001f600 b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(mixing.word_count(F.col("t"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]


def test_feast_against_dense_solver():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    spectra = [
        rng.uniform(0, 1, 40), np.ones(40), np.r_[np.ones(6), np.full(34, 0.5)], 10.0 ** -np.arange(40.0),
        1 + 1e-9 * np.arange(40), np.r_[5.0, 4, 3, np.zeros(37)], np.r_[np.full(30, 2.0), np.full(10, 1.0)],
    ]
    for spectrum in spectra:
        a = q @ np.diag(spectrum) @ q.T
        values, vectors = feast.largest(a, 8)
        want = np.sort(spectrum)[::-1][:8]
        want = want[want > 1e-12 * np.abs(a).sum(axis=1).max()]
        assert len(values) == len(want)
        assert np.abs(values - want).max() < 1e-13 * want[0]
        assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        for shift in rng.uniform(-0.1, 1.1, 5) * want[0]:
            assert feast.count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert len(feast.largest(np.zeros((3, 3)), 8)[0]) == 0
    assert feast.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_whitening_against_dense_solver(shipped):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(700, 12)) * np.linspace(0.02, 0.4, 12)).astype(np.float32)
    rows = [(i, 0, [float(v) for v in e]) for i, e in enumerate(x)]
    nan = float("nan")
    bad = [(-1, 0, None), (-2, 0, []), (-3, 0, [nan] * 12), (-4, 0, [None] * 12), (-5, 0, [float("inf")] * 12), (-6, 0, [1.0])]
    got = whitening.whitened_components(_vectors(shipped, rows + bad).repartition(3)).collect()
    ints = [[math.floor(1024 * float(v)) + 100000 for v in e] for e in x]
    sums = [sum(c) for c in zip(*ints)]
    y = np.array([[n * len(ints) - s for n, s in zip(e, sums)] for e in ints], float) / len(ints)
    e, u = np.linalg.eigh(y.T @ y / len(y))
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    z = y @ u / np.sqrt(e)
    assert len(got) == 8 * len(x) and {r.component for r in got} == set(range(1, 9))
    found = np.zeros_like(z)
    for r in got:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(x)
        assert r.deviation == sum((len(x) * a - s) ** 2 for a, s in zip(ints[r.vec_id], sums))
        assert r.explained == pytest.approx(e[r.component - 1] / (y * y).sum() * len(y), rel=1e-9)
        assert r.identity_error < 1e-9
    found *= np.sign((found * z).sum(axis=0))
    assert np.abs(found - z).max() < 1e-9


def test_whitening_of_odd_tables(shipped):
    empty = whitening.whitened_components(_vectors(shipped, []))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]
    assert whitening.whitened_components(_vectors(shipped, [(1, 0, [1.0, 2.0])])).count() == 0
    assert whitening.whitened_components(_vectors(shipped, [(i, 0, [1.0, 2.0]) for i in range(5)])).count() == 0
    # Two distinct vectors span one component; ids may be null or repeat.
    rows = [(None, 0, [1.0, 0.0]), (3, 0, [0.0, 0.0]), (3, 0, [0.0, 0.0]), (4, 0, [1.0, 0.0])]
    got = whitening.whitened_components(_vectors(shipped, rows)).collect()
    assert sorted(str(r.vec_id) for r in got) == ["3", "3", "4", "None"]
    assert {round(abs(r.whitened), 9) for r in got} == {1.0} and {r.explained for r in got} == {1.0}
    # Large components: products beyond a long stay exact, a deviation beyond it is null.
    rows = [(1, 0, [1e9, 1.0]), (2, 0, [-1e9, 1.0]), (3, 0, [1e9, 1.0]), (4, 0, [-1e9, 1.0])]
    got = whitening.whitened_components(_vectors(shipped, rows)).collect()
    assert {r.deviation for r in got} == {None} and {round(abs(r.whitened), 9) for r in got} == {1.0}


def test_products_are_exact():
    y = np.array([[3 << 40, -5], [1 << 41, 7]], np.int64)
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(2)] for i in range(2)]
    assert whitening.exact_products(y).tolist() == want
    z = np.random.default_rng(3).integers(-(1 << 24), 1 << 24, (500, 3))
    assert whitening.exact_products(z).tolist() == (z.astype(object).T @ z.astype(object)).tolist()
