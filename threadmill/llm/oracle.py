"""DuckDB SQL for the queries that SQL can express.

The comparison takes the plain way: all pairs, all positions, recursive reachability. The other
queries depend on trained models or on a tokenizer and have none.
"""

from __future__ import annotations

from threadmill.llm import leaks, mixing, nearjoin, negatives, repeats, vectors

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+'), lambda w: w <> '')"

# Only labels below the own id are passed on: the smallest of a component is below all of them.
_REACHED = """reached AS (
    SELECT a AS id, a AS root FROM links
    UNION
    SELECT l.b, r.root FROM reached r JOIN links l ON r.id = l.a WHERE r.root < l.b
), roots AS (SELECT id, min(root) AS root FROM reached GROUP BY id)"""

_VECTORS = f"""
WITH RECURSIVE good AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b
    FROM good x JOIN good y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.e, y.e) >= {vectors.SIMILARITY}
), {_REACHED}, counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id)::BIGINT AS component_id,
       coalesce(vec_id = coalesce(root, vec_id), true) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN roots ON vec_id = id
"""

_JACCARD = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS} AS w FROM documents), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < {nearjoin.WORDS} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {nearjoin.WORDS} + 2), lambda i: array_to_string(w[i:i + {nearjoin.WORDS} - 1], ' ')) END)) AS s
    FROM texts WHERE len(w) > 0 AND doc_id IS NOT NULL
), classes AS (
    SELECT s, min(doc_id) AS rep, count(*) AS size, len(any_value(s)) AS n FROM sets GROUP BY s
), entries AS (SELECT rep, n, size, unnest(s) AS shingle FROM classes
), pairs AS (
    SELECT x.rep AS a, y.rep AS b, any_value(x.n) AS na, any_value(y.n) AS nb, any_value(y.size) AS size, count(*) AS c
    FROM entries x JOIN entries y ON x.shingle = y.shingle AND x.rep <> y.rep GROUP BY x.rep, y.rep
), links AS (SELECT a, b, size FROM pairs WHERE c::DOUBLE / (na + nb - c) >= {nearjoin.SIMILARITY}::DOUBLE
), {_REACHED}, counts AS (SELECT a, sum(size) AS n FROM links GROUP BY a)
SELECT d.doc_id, coalesce(rep, d.doc_id)::BIGINT AS class_id, coalesce(size, 1)::BIGINT AS class_size,
       (coalesce(counts.n, 0) + coalesce(size, 1) - 1)::BIGINT AS n_links,
       coalesce(root, rep, d.doc_id)::BIGINT AS component_id,
       coalesce(d.doc_id = coalesce(root, rep, d.doc_id), true) AS kept
FROM documents d LEFT JOIN sets ON d.doc_id = sets.doc_id LEFT JOIN classes ON sets.s = classes.s
LEFT JOIN counts ON rep = a LEFT JOIN roots ON rep = id
"""

# Bytes are two hex digits each. Texts are cut twice, as a substring is looked up from the start.
_REPEATS = f"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
    SELECT rid, doc_id, base, substring(h, 2 * base + 1, 2 * (512 + {repeats.LENGTH} - 1)) AS c
    FROM texts, unnest(range(0, greatest(length(h) // 2 - {repeats.LENGTH} + 1, 0), 512)) AS u(base)
), strings AS (
    SELECT rid, doc_id, base + o AS start, md5_number(substring(c, 2 * o + 1, 2 * {repeats.LENGTH})) AS s
    FROM chunks, unnest(range(0, least(512, length(c) // 2 - {repeats.LENGTH} + 1))) AS v(o)
), firsts AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s
), covered AS (
    SELECT rid, start, lag(start) OVER (PARTITION BY rid ORDER BY start) AS before
    FROM strings JOIN firsts USING (s) WHERE least < doc_id
), numbered AS (
    SELECT rid, start,
           sum((before IS NULL OR start > before + {repeats.LENGTH})::INT) OVER (PARTITION BY rid ORDER BY start) AS run
    FROM covered
), spans AS (SELECT rid, min(start) AS a, max(start) + {repeats.LENGTH} AS b FROM numbered GROUP BY rid, run
), gaps AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS came FROM spans
), cut AS (
    SELECT rid, any_value(doc_id) AS doc_id, any_value(length(h)) // 2 AS n, coalesce(sum(b - a), 0) AS removed, count(a) AS n_spans,
           coalesce(string_agg(substring(h, 2 * came + 1, 2 * (a - came)), '' ORDER BY a), '')
               || substring(any_value(h), 2 * coalesce(max(b), 0) + 1) AS kept
    FROM texts LEFT JOIN gaps USING (rid) GROUP BY rid
)
SELECT doc_id, n::BIGINT AS n_bytes, removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM cut
"""


# Any good stretch has three equal words in a row, so the plain way starts from those, at every alignment.
_LEAKS = f"""
WITH texts AS (
    SELECT 0 AS side, row_number() OVER () AS rid, doc_id AS id, {_WORDS} AS ws FROM documents
    UNION ALL
    SELECT 1, row_number() OVER (), item_id, ws
    FROM (SELECT DISTINCT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) >= {leaks.SHORTEST}
), words AS (SELECT side, rid, ws, unnest(range(len(ws))) AS pos FROM texts
), runs AS (SELECT side, rid, pos, array_to_string(ws[pos + 1:pos + 3], ' ') AS run FROM words WHERE pos + 3 <= len(ws)
), aligned AS (
    SELECT DISTINCT x.rid AS doc, y.rid AS item, x.pos - y.pos AS shift
    FROM runs x JOIN runs y ON x.side = 0 AND y.side = 1 AND x.run = y.run
), placed AS (
    SELECT d.id AS doc_id, i.id AS item_id, doc, item, shift, d.ws AS dw, i.ws AS iw,
           unnest(range(greatest(0, -shift), least(len(i.ws), len(d.ws) - shift))) AS j
    FROM aligned JOIN texts d ON d.side = 0 AND d.rid = doc JOIN texts i ON i.side = 1 AND i.rid = item
), judged AS (
    SELECT doc_id, item_id, doc, item, shift, j, len(iw) AS n, dw[shift + j + 1] = iw[j + 1] AS same FROM placed
), summed AS (
    SELECT *, row_number() OVER w AS r, sum(CASE WHEN same THEN 1 ELSE -4 END) OVER w AS total
    FROM judged WINDOW w AS (PARTITION BY doc, item, shift ORDER BY j ROWS UNBOUNDED PRECEDING)
), lows AS (
    SELECT *, least(0, min(total * 1000000 + r) OVER (PARTITION BY doc, item, shift ORDER BY j
        ROWS BETWEEN UNBOUNDED PRECEDING AND {leaks.LEAST} PRECEDING)) AS low FROM summed
), ends AS (
    SELECT doc_id, item_id, r - (low % 1000000 + 1000000) % 1000000 AS compared,
           total - (low - (low % 1000000 + 1000000) % 1000000) / 1000000 AS score
    FROM lows WHERE r >= {leaks.LEAST} AND n >= {leaks.LEAST}
    UNION ALL
    SELECT any_value(doc_id), any_value(item_id), any_value(n), any_value(n)
    FROM summed WHERE n < {leaks.LEAST} GROUP BY doc, item, shift HAVING count(*) = any_value(n) AND bool_and(same)
)
SELECT doc_id, item_id, ((score + 4 * compared) / 5)::INT AS matched, compared::INT AS compared
FROM ends WHERE score >= 0
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, compared DESC) = 1
"""

_NEGATIVES = f"""
WITH good AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           list_inner_product(a.e, b.e)::BIGINT AS score
    FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {negatives.POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND {negatives.BAND[0]} * positive_score <= {negatives.BAND[1]} * score
  AND {negatives.BAND[1]} * score <= {negatives.BAND[1]} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= {negatives.NEGATIVES}
"""

# The final clamps are the first sources by clamp over weight, as far as the rest's level is above them.
_MIX = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, {mixing._HASH_DIGITS}))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [{", ".join(f"{w}.0::DOUBLE" for w in mixing.PATTERN)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.PATTERN)} + 1] AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, {float(mixing.EPOCHS)}::DOUBLE * source_size AS cap,
           row_number() OVER (ORDER BY source_size / weight, source) AS k FROM sources
), levels AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
           sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM ordered
), first_free AS (
    SELECT words, rest, k AS free FROM levels WHERE cap * rest > words * weight ORDER BY k LIMIT 1
), plan AS (
    SELECT source, source_size, CASE WHEN k < coalesce(free, 1e9) THEN cap ELSE weight * words::DOUBLE / rest END AS target
    FROM ordered LEFT JOIN first_free ON true
), wanted AS (
    SELECT *, floor(target + 0.5)::BIGINT AS want FROM plan
), drawn AS (
    SELECT s.*, p.source_size, p.target, p.want,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
    FROM sized s JOIN wanted p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE want // source_size * size
        + greatest(0, least(size, want % source_size - gone)) END)::BIGINT AS taken
FROM drawn
"""

ORACLES: dict[str, str] = {
    "op5_near_vectors": _VECTORS,
    "op6_jaccard_join": _JACCARD,
    "op8_repeats": _REPEATS,
    "op9_benchmark_leaks": _LEAKS,
    "op11_hard_negatives": _NEGATIVES,
    "op12_source_mix": _MIX,
}
