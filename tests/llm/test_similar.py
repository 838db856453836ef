import time
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from threadmill.llm import leaks, nearjoin, repeats, vectors
from threadmill.llm.groups import block_pairs, components, narrowed
from threadmill.llm.textarrays import text_shingles


def _closure(links):
    root = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            least = min([root[i], *(root[j] for j in others)])
            if least < root[i]:
                root[i], changed = least, True
    return root


def _texts():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(words, 60)) for _ in range(12)]
    rows = []
    for i in range(220):
        text = list(base[i % 12])
        for at in rng.integers(0, 60, rng.integers(0, 3)):
            text[at] = str(rng.choice(words))
        rows.append((1000 - i, " ".join(text)))
    return rows + [(1, None), (2, ""), (3, "!!"), (4, "only three words"), (5, "Only, three words."), (6, "w1 " * 5000), (7, "w1 " * 5000)]


def test_jaccard_join_against_all_pairs(docs_of):
    rows = _texts()
    got = {r.doc_id: r for r in nearjoin.near_documents(docs_of(rows), block=16).collect()}
    sets = {i: set(text_shingles(t, 5).tolist()) for i, t in rows}
    links = {i: [j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in sets}
    root = _closure(links)
    assert {i: got[i].n_links for i in sets} == {i: len(v) for i, v in links.items()}
    assert {i: got[i].component_id for i in sets} == root
    assert {i for i in sets if got[i].kept} == {i for i in sets if root[i] == i}
    kept = nearjoin.keep_one_of_each(docs_of(rows))
    assert {r.doc_id for r in kept.collect()} == {i for i in sets if root[i] == i}


def test_jaccard_join_of_odd_tables(docs_of):
    assert nearjoin.near_documents(docs_of([])).count() == 0
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (1, "quite another text than that")]
    got = nearjoin.near_documents(docs_of(rows)).collect()
    assert len(got) == 4 and all(r.kept for r in got)


def test_jaccard_join_in_a_crowded_forest(docs_of):
    rows = _texts()
    plain = {tuple(r) for r in nearjoin.near_documents(docs_of(rows)).collect()}
    assert {tuple(r) for r in nearjoin.near_documents(docs_of(rows), block=8, wide=8, crowd=3).collect()} == plain


def _paths(shipped, paths):
    """Classes from 24 paths of eight labels each."""
    rows = [(i, np.array(p, "<u2").tobytes()) for i, p in enumerate(paths)]
    return shipped.createDataFrame(rows, "rep long, labels binary")


def test_crowded_nodes_are_left_and_prefixes_shortened_to_the_recall(shipped):
    rng = np.random.default_rng(3)
    paths = rng.integers(0, 60000, (60, 24, 8))
    paths[:40, :5, :4] = 7              # five crowded tries: the others give the recall
    paths[40:, :, :4] = 9               # crowded in all tries: prefixes of five labels are needed
    paths[40:, :, 4] = rng.integers(0, 2, (20, 24))
    paths[1, :5] = paths[0, :5]
    got = {}
    for r in nearjoin.forest_groups(_paths(shipped, paths), 0.8, 24, 4, 8, 0.9999, 6).collect():
        got.setdefault(r.node, set()).add(r.rep)
    sets = [frozenset(v) for v in got.values()]
    assert len(sets) == len(set(sets))
    assert {s for s in sets if min(s) < 40} == {frozenset({0, 1})}
    halves = {frozenset(40 + np.flatnonzero(paths[40:, t, 4] == side)) for t in range(24) for side in (0, 1)}
    assert {s for s in sets if min(s) >= 40} == {h for h in halves if len(h) > 1}
    assert sum(nearjoin.evidence(0.8, 5) for _ in range(24)) >= -np.log(1e-4) > sum(nearjoin.evidence(0.8, 6) for _ in range(24))


def test_nodes_have_their_sizes_and_equal_paths_are_looked_up_once(shipped):
    rng = np.random.default_rng(4)
    paths = rng.integers(0, 60000, (50, 24, 8))
    paths[:40, :3] = 7                  # forty near copies share three whole paths
    paths[40:, :, :4] = 9
    reps = _paths(shipped, paths)
    groups = nearjoin.forest_groups(reps, 0.8, 24, 4, 8, 0.9999, 6)
    rows = [tuple(r) for r in groups.collect()]
    sizes = Counter(r[0] for r in rows)
    assert rows and all(n == sizes[node] for node, _, n in rows)
    dealt = [{tuple(r) for r in block_pairs(g, "node", "rep", 4, *n).select("node", "rep", "lo", "hi", "block").collect()}
             for g, n in ((groups.drop("n"), ()), (groups, ("n",)))]
    assert dealt[0] == dealt[1]
    crowded = shipped.createDataFrame([(i, t, paths[i, t].astype("<u2").tobytes()) for i in range(40) for t in range(3)],
                                      "rep long, trie int, path binary")
    assert {tuple(r)[::2] for r in nearjoin._reached(crowded, 4, 8, 6).collect()} == {(t, 8) for t in range(3)}


def test_rows_without_a_wanted_key_are_not_moved(shipped):
    rows = shipped.range(-10_000, 10_000).selectExpr("CAST(id AS INT) AS k", "id AS v").union(
        shipped.createDataFrame([(7, -1), (None, -2)], "k int, v long"))
    wanted = shipped.createDataFrame([(i,) for i in (7, -9999, 400, 7)], "other long")
    kept = narrowed(rows, "k", wanted, "other")
    assert kept.columns == ["k", "v"]
    got = Counter(r.k for r in kept.collect())
    assert got[7] == 2 and got[-9999] == got[400] == 1 and sum(got.values()) < 14
    full = shipped.range(100_000).select("id")
    assert narrowed(rows, "k", full, "id", words=1).where("k IS NOT NULL").count() == 20_001
    assert narrowed(rows, "k", wanted.limit(0), "other").count() == 0


def test_least_number_of_equal_labels():
    rng = np.random.default_rng(5)
    equal = rng.binomial(192, 0.8, 200_000)
    least = nearjoin.least_equal(0.8, 192, 0.999)
    assert (equal < least).mean() <= 0.0012 and (equal <= least).mean() > 0.0008
    assert nearjoin.least_equal(1.0, 10, 0.9999) == 10


def test_unlike_texts_of_one_template_stay_apart(docs_of):
    rng = np.random.default_rng(7)
    template = [f"t{i}" for i in range(160)]
    rows = []
    for i in range(300):                # two texts have a similarity of about 0.55
        text = list(template)
        for at in rng.choice(31, 5, replace=False):
            text[5 * at + 2] = f"own{i}x{at}"
        rows.append((i, " ".join(text)))
    rows.append((1000, rows[0][1] + " end"))
    docs = docs_of(rows)
    known = nearjoin.sketches(docs.select("doc_id", "text"), 5, 24, 8).selectExpr("doc_id AS rep", "labels")
    pairs = nearjoin.forest_stars(known, 0.8, 24, 4, 8, 0.9999, 64, 32).collect()
    assert (1000, 0) in {(r.a, r.b) for r in pairs}
    met = components(docs.sparkSession.createDataFrame(pairs), "a", "b").groupBy("component").count()
    assert met.agg(F.max("count")).first()[0] <= 60


def test_vectors_against_all_pairs(shipped):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    for i in range(100, 300):
        x[i] = x[i % 20] + rng.normal(size=16) * 0.03 * (i % 5)
    x = x.astype(np.float32)
    x[299] = x[298]
    rows = [(1000 - i, x[i].tolist(), i % 3) for i in range(300)]
    odd = [(1, None, 0), (2, [0.0] * 16, 0), (3, [None, *[1.0] * 15], 0), (4, [float("nan"), *[1.0] * 15], 0), (5, x[0].tolist(), None), (6, [1.0, 2.0], 0)]
    table = shipped.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(table, block=16).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    links = {1000 - i: [1000 - j for j in range(300) if j != i and i % 3 == j % 3 and near[i, j]] for i in range(300)}
    want = sum(map(len, links.values()))
    assert all(got[i].n_links <= len(v) for i, v in links.items())
    assert sum(got[i].n_links for i in links) >= 0.9 * want
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(1, 7))
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_candidates_share_pivots_and_meet_once():
    rng = np.random.default_rng(4)
    near = np.stack([rng.permutation(14)[:8] for _ in range(60)])
    lists = {}
    for i, row in enumerate(near):
        for p, q in combinations(sorted(row[:6].tolist()), 2):
            lists.setdefault((p, q), []).append(i)
    met = []
    for (p, q), rows in lists.items():
        unit = pd.DataFrame({"near": [near[i].astype("<u2").tobytes() for i in rows], "q": q, "lo": 0, "hi": 0, "block": 0})
        a, b = np.nonzero(np.triu(vectors.candidates(unit, 6, 5)))
        met += [(rows[i], rows[j]) for i, j in zip(a, b)]
    together = lambda i, j, n: len(set(near[i, :n]) & set(near[j, :n]))
    assert sorted(met) == [(i, j) for i, j in combinations(range(60), 2) if together(i, j, 6) >= 2 and together(i, j, 8) >= 5]


def test_vectors_of_one_id(shipped):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1)]
    table = shipped.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vectors.near_vectors(table).collect()
    assert len(got) == 5 and {r.component_id for r in got} == {1} and {r.vec_id for r in got if r.kept} == {1}


def test_pivots_come_from_the_lowest_hashes(shipped):
    rng = np.random.default_rng(6)
    table = shipped.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(4000, 8)))], "rep long, embedding array<double>")
    few = table.orderBy(F.xxhash64("rep", F.lit(3))).limit(50).collect()
    unit = np.array([r.embedding for r in few])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    got = vectors.choose_pivots(table, sample=50, pivots=50, apart=2.0)
    assert np.allclose(got, unit)


def test_components_of_a_path_and_a_star(shipped):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.id: r.component for r in components(shipped.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}


def _removed(rows, length):
    out, seen = {}, {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        covered = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            owner = seen.setdefault(data[at : at + length], i)
            if owner < i:
                covered[at : at + length] = True
        out[i] = bytes(np.frombuffer(data, np.uint8)[~covered])
    return out


def test_repeats_against_all_strings(docs_of, monkeypatch):
    rng = np.random.default_rng(6)
    parts = ["".join(rng.choice(list("abcdé "), 70)) for _ in range(6)]
    rows = [(i, "".join(str(rng.choice(parts)) if rng.random() < 0.5 else "".join(rng.choice(list("xyzü"), 30)) for _ in range(6))) for i in range(60)]
    rows += [(61, None), (62, ""), (63, "short"), (64, "short"), (65, "a" * 3000), (66, "a" * 200), (67, rows[5][1]), (68, rows[5][1])]
    want = _removed(rows, 50)
    for hot in (4096, 5):
        monkeypatch.setattr(repeats, "HOT", hot)
        got = {r.doc_id: r for r in repeats.remove_repeats(docs_of(rows)).collect()}
        assert {i: bytes(r.kept) for i, r in got.items()} == want
        assert all(r.n_removed == r.n_bytes - len(want[i]) for i, r in got.items())
    assert repeats.remove_repeats(docs_of([])).count() == 0


def test_leaks_tolerate_replaced_words(docs_of, shipped):
    rng = np.random.default_rng(9)
    words = [f"v{i}" for i in range(3000)]
    items = [" ".join(rng.choice(words, 30)) for _ in range(8)]
    bench = shipped.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, "too short")], "item_id long, text string")
    changed = items[2].split()
    for at in (4, 13, 22):
        changed[at] = "zz"
    rows = [(1, f"before that {items[0].upper()} after it"), (2, " ".join(changed)), (3, " ".join(rng.choice(words, 200))), (4, None), (5, ""), (6, "too short"), (1, items[0])]
    docs = docs_of(rows)
    for small in (leaks.SMALL, 0):
        got = leaks.leaked_passages(docs, bench, small=small).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 0), (2, 2)]
    assert sorted(r.doc_id for r in leaks.drop_leaked(docs, bench).collect()) == [3, 4, 5, 6]
    assert leaks.leaked_passages(docs, bench.limit(0)).count() == 0


def _best_plainly(doc, item, least=leaks.LEAST):
    """(matched, compared) of the best stretch over all alignments, by trying all."""
    best = None
    if len(item) < leaks.SHORTEST:
        return None
    for shift in range(-len(item) + 1, len(doc)):
        same = [doc[shift + j] == item[j] for j in range(max(0, -shift), min(len(item), len(doc) - shift))]
        if len(item) < least:
            if len(same) == len(item) and all(same):
                best = max(best or (0, 0), (len(item), len(item)))
            continue
        for a in range(len(same)):
            for b in range(a + least, len(same) + 1):
                score = 5 * sum(same[a:b]) - 4 * (b - a)
                if score >= 0:
                    best = max(best or (-1, 0), (score, b - a))
    return best and ((best[0] + 4 * best[1]) // 5 if len(item) >= least else best[0], best[1])


def test_every_good_stretch_has_a_seed():
    """All places of replaced words in stretches of 12 to 23 words; a longer good one holds one of these."""
    for n in range(leaks.LEAST, 2 * leaks.LEAST):
        for replaced in combinations(range(n), n - -(-n * 4 // 5)):
            assert any(
                all(bit == "0" or at + o not in replaced for o, bit in enumerate(mask))
                for mask in leaks.MASKS for at in range(n - len(mask) + 1)
            ), (n, replaced)


def test_leaks_of_short_items_and_inner_runs(docs_of, shipped):
    rng = np.random.default_rng(19)
    words = [f"v{i}" for i in range(2000)]
    pick = lambda n: list(rng.choice(words, n, replace=False))
    items = {i: pick(n) for i, n in enumerate((5, 6, 10, 11, 12, 15, 30, 60))}
    rows = [(100 + i, pick(20) + w + pick(20)) for i, w in items.items()]
    # Runs of 12 to 15 words from the middle of an item, in the middle of a document; 9 of 12 are too few.
    rows += [(200 + n, pick(30) + items[7][20 : 20 + n] + pick(30)) for n in (9, 12, 13, 15)]
    # A short item with one word replaced, or cut off, is not there as a whole.
    rows += [(300, pick(5) + items[2][:4] + ["x"] + items[2][5:]), (301, items[2][:9]), (302, items[1]), (303, items[0])]
    rows += [(400, pick(9) + [w if k % 5 else "x" for k, w in enumerate(items[6])] + pick(9)), (401, items[6][::2])]
    docs = docs_of([(i, " ".join(w)) for i, w in rows])
    bench = shipped.createDataFrame([(i, " ".join(w), "z") for i, w in items.items()], "item_id long, text string, doc_id string")
    want = {(d, i): _best_plainly(w, x) for d, w in rows for i, x in items.items()}
    want = {k: v for k, v in want.items() if v}
    assert (302, 1) in want and (212, 7) in want and (400, 6) in want and not {(303, 0), (300, 2), (301, 2), (209, 7)} & set(want)
    for small in (leaks.SMALL, 0):
        got = leaks.leaked_passages(docs, bench, small=small).collect()
        assert {(r.doc_id, r.item_id): (r.matched, r.compared) for r in got} == want


def test_leaks_of_repetitive_texts(docs_of, shipped):
    rows = [(1, "spam " * 100_000), (2, "spam egg " * 500), (3, " ".join(f"w{i}" for i in range(50)))]
    bench = shipped.createDataFrame([(1, "spam " * 60), (2, "egg spam " * 10)], "item_id long, text string")
    began = time.time()
    got = {(r.doc_id, r.item_id): (r.matched, r.compared) for r in leaks.leaked_passages(docs_of(rows), bench).collect()}
    assert got == {(1, 1): (60, 60), (2, 2): (20, 20)}
    assert time.time() - began < 40


def test_leaks_of_empty_tables_and_clashing_columns(docs_of, shipped):
    bench = shipped.createDataFrame([(1, "a b c d e f g", 0)], "item_id long, text string, words int")
    assert leaks.leaked_passages(docs_of([]), bench).count() == 0
    docs = docs_of([(1, "x a b c d e f g"), (None, "A-B-C-D-E-F-G"), (1, "other")])
    clash = docs.selectExpr("*", "1 as item_id", "2 as at", "'m' as mask", "3 as hash", "4 as words")
    got = sorted(map(tuple, leaks.leaked_passages(clash, bench).collect()), key=str)
    assert got == [(1, 1, 7, 7), (None, 1, 7, 7)]
    assert [r.doc_id for r in leaks.drop_leaked(clash, bench).collect()] == [None]


def test_longest_previous_factors_against_plain_search():
    rng = np.random.default_rng(21)
    for n, alphabet, owners_up_to in ((1, 2, 3), (40, 2, 5), (300, 3, 40), (300, 1, 300), (200, 2, 1)):
        strings = rng.integers(0, alphabet, (n, 9)).astype(np.uint8)
        strings = strings[np.lexsort(strings.T[::-1])]
        owners = rng.integers(0, owners_up_to, n)
        prefix = lambda a, b: next((k for k in range(9) if a[k] != b[k]), 9)
        want = [max([prefix(strings[i], strings[j]) for j in range(n) if owners[j] < owners[i]], default=0) for i in range(n)]
        assert repeats.longest_previous(strings, owners).tolist() == want
    # A chain of falling owners is leapt over in few rounds.
    owners = np.arange(200_000)[::-1].copy()
    at, common = repeats.smaller_neighbours(owners, np.full(len(owners), 5))
    assert (at == -1).all() and (common == 0).all()


def test_anchors_against_plain_search():
    rng = np.random.default_rng(22)
    power = 0x9E3779B97F4A7C15
    for text in (b"", b"x" * 49, b"ab" * 25, bytes(rng.integers(0, 256, 700).astype(np.uint8)), b"a" * 500, bytes(rng.integers(0, 2, 900).astype(np.uint8))):
        hashes, first, last = repeats.anchors(text)
        own = []
        for i in range(len(text) - 24):
            h = 0
            for byte in text[i : i + 25]:
                h = (h * power + byte) % (1 << 64)
            own.append(int(repeats.mixed(np.array([h], np.uint64))[0]) >> 16)
        want = [min(range(s, s + 26), key=lambda i: (own[i], i)) for s in range(max(0, len(text) - 49))]
        got = np.repeat(hashes, last - first + 1).tolist() if len(hashes) else []
        assert got == [own[i] for i in want]


def test_repeats_do_not_depend_on_the_number_of_shares(docs_of, monkeypatch):
    rng = np.random.default_rng(23)
    passages = ["".join(rng.choice(list("abcdefgh "), 80)) for _ in range(30)]
    rows = [(i, " ".join(rng.choice(passages, 5)) + "".join(rng.choice(list("abcdefgh "), 400))) for i in range(300)]
    seconds, found = {}, {}
    for size in (repeats.BUCKET_BYTES, 400):
        monkeypatch.setattr(repeats, "BUCKET_BYTES", size)
        total = sum(len(t) for _, t in rows)
        assert size > total or -(-total // size) >= 500
        began = time.time()
        # The shares of a batch are dealt out in one sort; the work of a task is the same for 12 and for 600.
        deal = repeats.anchor_rows(docs_of(rows).coalesce(1), max(12, -(-total // size)), 50, 25).select("hashes").collect()
        seconds[size] = time.time() - began
        assert sum(len(r.hashes) for r in deal) > 0
        found[size] = sorted(map(str, repeats.remove_repeats(docs_of(rows)).collect()))
    assert found[400] == found[max(found)] and seconds[400] < 3 * seconds[max(seconds)] + 2
