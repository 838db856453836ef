"""Join of documents by the Jaccard similarity of their word n-grams.

MinHash LSH forest: the minima of a document's shingles are labels of paths in several prefix tries.
Nodes are groups of equal prefixes. A crowded node is replaced by its children; where a document's
prefixes are then too long for the target recall, they are shortened again. What meets in a node is compared by
whole signatures, and what these leave is verified exactly on whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from threadmill.llm.groups import block_pairs, components, linked_once, narrowed, per_unit, star_rows
from threadmill.llm.textarrays import fingerprint, minima, text_shingles
from threadmill.sources.tables import stage

WORDS, SIMILARITY, TRIES, LEAST, DEPTH, RECALL, BLOCK, WIDE, CROWD = 5, 0.8, 24, 4, 8, 0.9999, 128, 2048, 512
_COLUMNS = 1 << 14
_SKETCH = "doc_id long, f1 long, f2 long, words_seen boolean, labels binary"


def evidence(similarity: float, depth: int) -> float:
    """What one trie adds to the recall at that depth: minus the logarithm of the chance not to meet there."""
    return -math.log1p(-min(similarity**depth, 1 - 1e-15))


def least_equal(similarity: float, labels: int, recall: float) -> int:
    """Equal labels that a pair at the threshold has at least, with the probability ``recall``."""
    below, k = 0.0, 0
    while k < labels:
        log = math.lgamma(labels + 1) - math.lgamma(k + 1) - math.lgamma(labels - k + 1)
        log += k * math.log(similarity) + (labels - k) * math.log1p(-min(similarity, 1 - 1e-15))
        below += math.exp(log)
        if below > 1 - recall:
            break
        k += 1
    return k


def sketches(docs: DataFrame, words: int, tries: int, depth: int) -> DataFrame:
    """Fingerprint of the shingle set and the labels, 16 bits each, of every document, map-only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = text_shingles(text, words)
                labels = minima(found, tries * depth).astype("<u2").tobytes() if len(found) else None
                out.append((doc_id, *fingerprint(found), bool(len(found)), labels))
            yield pd.DataFrame(out, columns=["doc_id", "f1", "f2", "words_seen", "labels"])

    return docs.mapInPandas(run, _SKETCH)


def _nodes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("node", F.expr("xxhash64(trie, depth, substring(path, 1, 2 * depth))"))


def _sizes(nodes: DataFrame) -> DataFrame:
    """Nodes of two or more, with a checksum of their members."""
    members = F.bit_xor(F.xxhash64("rep", F.lit(5))).alias("members")
    return nodes.groupBy("node").agg(F.count("*").alias("n"), members).where("n > 1")


def _each_set_once(sizes: DataFrame) -> DataFrame:
    """Of nodes with the same members only one, as near copies meet in most tries."""
    return sizes.groupBy("n", "members").agg(F.min("node").alias("node")).select("node", "n")


def _reached(crowded: DataFrame, least: int, depth: int, crowd: int) -> DataFrame:
    """``(trie, path, reached)``: for paths in crowded nodes the depth of the first node that is not, at most ``depth``.

    A path stands for all classes that have it, so near copies are looked up once and not one by one.
    """
    paths = stage(crowded.groupBy("trie", "path").agg(F.count("*").alias("classes")), "paths")
    deeper = _nodes(paths.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(depth)))))
    full = deeper.groupBy("node").agg(F.sum("classes").alias("n")).where(F.col("n") > crowd).select("node")
    return deeper.join(stage(full, "full"), "node").groupBy("trie", "path").agg(
        F.least(F.max("depth") + 1, F.lit(depth)).alias("reached")
    )


def forest_groups(
    reps: DataFrame, similarity: float, tries: int, least: int, depth: int, recall: float, crowd: int
) -> DataFrame:
    """``(node, rep, n)``: the classes of every trie node in which they are to be compared, and their number.

    Nodes start at the depth ``least``. One of more than ``crowd`` classes is left for its children,
    down to ``depth``. Each class adds up what its tries give at the depth reached; below the target recall it is
    also listed in the longest shorter prefixes that reach it, however crowded these are.
    Two classes at the threshold so meet with the target recall of the one that reaches it by longer prefixes.
    """
    path = F.expr(
        f"transform(sequence(0, {tries - 1}), t -> struct(t AS trie, substring(labels, t * {2 * depth} + 1, {2 * depth}) AS path))"
    )
    rows = reps.select("rep", F.inline(path))
    shallow = _nodes(rows.withColumn("depth", F.lit(least)))
    sizes = stage(_sizes(shallow), "nodes")
    once = stage(_each_set_once(sizes.where(F.col("n") <= crowd)), "once")
    # Most nodes hold one class only; these rows are not moved.
    groups = narrowed(shallow.select("node", "rep"), "node", once, "node").join(once, "node").select("node", "rep", "n")
    full = sizes.where(F.col("n") > crowd).select("node")
    crowded = narrowed(shallow.select("node", "rep", "trie", "path"), "node", full, "node").join(full, "node")
    crowded = stage(crowded.select("rep", "trie", "path"), "crowded")
    if crowded.isEmpty():
        return groups
    by_path = stage(_reached(crowded, least, depth, crowd), "reached-paths")
    reached = stage(crowded.join(by_path, ["trie", "path"]), "reached")
    needed = -math.log1p(-recall)

    def total(cap: int):
        given = F.lit(0.0)
        for d in range(least, depth + 1):
            given = F.when(F.least("reached", F.lit(cap)) == d, evidence(similarity, d)).otherwise(given)
        return F.sum(given) + (F.lit(tries) - F.count("*")) * evidence(similarity, least)

    caps = reached.groupBy("rep").agg(
        F.greatest(F.lit(least), *(F.when(total(cap) >= needed, cap) for cap in range(least, depth + 1))).alias("cap")
    )
    listed = (
        reached.join(stage(caps, "caps"), "rep")
        .withColumn("depth", F.explode(F.sequence(F.least("reached", "cap"), F.col("reached"))))
        .withColumn("last", F.col("depth") == F.least("reached", "cap"))
    )
    listed = stage(_nodes(listed).select("node", "rep", "last"), "listed")
    # a node in which no class ends lies within a shorter prefix that lists all its classes
    ending = listed.where("last").select("node").distinct()
    once = _each_set_once(_sizes(listed).join(ending, "node", "left_semi"))
    return groups.union(listed.join(once, "node").select("node", "rep", "n"))


def _plausible(unit: pd.DataFrame, equal: int) -> pd.DataFrame | None:
    labels = np.stack([np.frombuffer(b, "<u2") for b in unit["labels"]])
    same = np.zeros((len(labels), len(labels)), np.int32)
    for one in labels.T:
        same += one[:, None] == one[None, :]
    near = linked_once(same >= equal, unit["block"].to_numpy(), int(unit["lo"].iloc[0]), int(unit["hi"].iloc[0]))
    return star_rows(near, unit["rep"].to_numpy(), np.ones(len(unit), np.int64))


def forest_stars(
    reps: DataFrame, similarity: float, tries: int, least: int, depth: int, recall: float, crowd: int, block: int
) -> DataFrame:
    """``(a, b)``: stars over the classes that meet in a node and have enough equal labels."""
    groups = stage(forest_groups(reps, similarity, tries, least, depth, recall, crowd), "groups")
    labels = narrowed(reps.select("rep", "labels"), "rep", groups, "rep")
    units = block_pairs(groups, "node", "rep", block, "n").join(labels, "rep")
    equal = least_equal(similarity, tries * depth, recall)
    stars = per_unit(units, "node", lambda u: _plausible(u, equal), "id long, links long, root long")
    return stars.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()


def jaccard_matrix(sets: list[np.ndarray]) -> np.ndarray:
    """Exact similarity of every two sets, by products of bounded slices of their incidence matrix."""
    sizes = np.array([len(s) for s in sets], np.float64)
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    values = values[counts > 1]
    common = np.zeros((len(sets), len(sets)))
    for begin in range(0, len(values), _COLUMNS):
        part = values[begin : begin + _COLUMNS]
        incidence = np.zeros((len(sets), len(part)), np.float32)
        for i, s in enumerate(sets):
            s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
            at = np.searchsorted(part, s)
            incidence[i, at[part[at] == s]] = 1
        common += incidence @ incidence.T
    return common / np.maximum(sizes[:, None] + sizes[None, :] - common, 1)


def _links(unit: pd.DataFrame, similarity: float) -> pd.DataFrame | None:
    sets = [np.frombuffer(b, "<u8") for b in unit["shingles"]]
    near = jaccard_matrix(sets) >= similarity
    near = linked_once(near, unit["block"].to_numpy(), int(unit["lo"].iloc[0]), int(unit["hi"].iloc[0]))
    return star_rows(near, unit["rep"].to_numpy(), unit["size"].to_numpy())


def class_shingles(base: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(rep, f1, f2, shingles)`` of every wanted class, from the text of its smallest document.

    Texts are fetched by doc_id, and only those that may be wanted are moved; where a doc_id is repeated
    with other texts, those are dropped by their fingerprints.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for rep, text in zip(batch["rep"], batch["text"]):
                found = text_shingles(text, words)
                out.append((rep, *fingerprint(found), found.astype("<u8").tobytes()))
            yield pd.DataFrame(out, columns=["rep", "f1", "f2", "shingles"])

    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    texts = narrowed(base, "doc_id", wanted, "rep").join(ids, "doc_id").select(F.col("doc_id").alias("rep"), "text")
    return texts.mapInPandas(run, "rep long, f1 long, f2 long, shingles binary").dropDuplicates(["rep", "f1", "f2"])


def near_documents(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    tries: int = TRIES,
    least: int = LEAST,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
    wide: int = WIDE,
    crowd: int = CROWD,
) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, class_size, n_links, component_id, kept.

    A class holds the documents with equal shingle sets and is named by its smallest doc_id.
    ``n_links`` counts the other documents at ``similarity`` or more, copies included;
    ``component_id`` is the smallest doc_id reachable by links, and that document is kept.

    Words are runs of letters, numbers and underscores in lower case; a text of fewer than
    ``words`` words is one shingle. Null texts, texts without words and rows without a doc_id link
    with nothing and are kept. Rows that repeat a doc_id with equal words count as copies; with other
    words they are one document whose texts may each have links.

    Copies are collapsed by pre-aggregated fingerprints. Classes that meet in the forest with enough
    equal labels form candidate groups, joined by stars; texts are fetched once, for these classes only. A large
    group is cut into pairs of blocks (``wide`` rows of labels, ``block`` rows of shingles), which are compared whole and give counts and spanning stars
    instead of pairs, so every link between different texts of a group counts.
    """
    base = docs.select("doc_id", "text")
    known = stage(sketches(base, words, tries, depth), "sketches")
    judged = known.where(F.col("words_seen") & F.col("doc_id").isNotNull())
    classes = judged.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("size"), F.first("labels").alias("labels")
    )
    classes = stage(classes, "classes")
    met = forest_stars(classes, similarity, tries, least, depth, recall, crowd, wide)
    groups = stage(components(met, "a", "b"), "families")
    wanted = groups.join(classes.select("rep", "size", "f1", "f2"), groups.id == classes.rep).select(
        "rep", "f1", "f2", "size", "component"
    )
    # Members are counted before they get their shingles, so that texts are read for one join and not for two.
    members = wanted.groupBy("component").agg(F.count("*").alias("n"))
    wanted = stage(wanted.join(members, "component"), "wanted")
    sets = class_shingles(base, wanted, words).join(wanted, ["rep", "f1", "f2"])
    units = block_pairs(sets, "component", "rep", block, "n")
    stars = stage(per_unit(units, "component", lambda u: _links(u, similarity), "id long, links long, root long"), "stars")
    roots = components(stars, "id", "root")
    links = stars.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = (
        classes.select("f1", "f2", "rep", "size")
        .join(links, F.col("rep") == links.id, "left").drop("id")
        .join(roots, F.col("rep") == roots.id, "left")
        .select(
            "f1", "f2", F.col("rep").alias("class_id"), F.col("size").alias("class_size"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    alone = known.where(~(F.col("words_seen") & F.col("doc_id").isNotNull()))
    return (
        judged.select("doc_id", "f1", "f2").join(per_class, ["f1", "f2"]).drop("f1", "f2")
        .union(alone.select("doc_id", "doc_id", F.lit(1).cast("long"), F.lit(0).cast("long"), "doc_id"))
        .select(
            "doc_id", "class_id", "class_size", F.col("n_links").cast("long").alias("n_links"), "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component of near copies, the one with the smallest id.

    Only ids move: the texts are joined once with the ids to be dropped. Rows without a doc_id
    stay, as do rows that repeat a kept doc_id.
    """
    dropped = near_documents(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
