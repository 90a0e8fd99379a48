"""The queries that SQL can express, as DuckDB SQL written independently."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS shingle
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * k >= 80 * (p.n + q.n - k)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other
)
SELECT reached.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = reached.doc_id
GROUP BY reached.doc_id
"""


def _apportioned(name: str, rows: str, votes: str, house: str, order: str, group: str) -> str:
    """Named subqueries that end in ``name``: ``rows`` with seats by highest quotients."""
    over = f"PARTITION BY {group}" if group else ""
    return f"""
{name}_sums AS (
    SELECT *, sum({votes}) OVER ({over}) AS all_votes, count(*) OVER ({over}) AS all_rows FROM {rows}
), {name}_bounds AS (
    SELECT *,
        CASE WHEN all_votes > 0 THEN CAST(floor(
            CAST({votes} AS DOUBLE) * greatest({house} - all_rows, 0) / all_votes + 0.5) AS BIGINT)
            ELSE 0 END AS least_seats,
        CASE WHEN all_votes > 0 THEN CAST(floor(
            CAST({votes} AS DOUBLE) * ({house} + all_rows) / all_votes + 0.5) AS BIGINT)
            ELSE 0 END AS most_seats
    FROM {name}_sums
), {name}_open AS (
    SELECT *, {house} - sum(least_seats) OVER ({over}) AS open_seats FROM {name}_bounds
), {name}_won AS (
    SELECT row_key, count(*) AS won FROM (
        SELECT row_key, open_seats, row_number() OVER ({over}
            ORDER BY CAST({votes} AS DOUBLE) / (2 * seat + 1) DESC, {order}, seat) AS place
        FROM (SELECT *, unnest(range(least_seats, most_seats)) AS seat FROM {name}_open))
    WHERE place <= open_seats GROUP BY row_key
), {name} AS (
    SELECT {name}_open.* EXCLUDE (all_votes, all_rows, least_seats, most_seats, open_seats),
        least_seats + coalesce(won, 0) AS seats
    FROM {name}_open LEFT JOIN {name}_won ON {name}_open.row_key = {name}_won.row_key
)"""


def _seeded(parts: str) -> str:
    return f"CAST('0x' || substr(md5('0|' || {parts}), 1, 15) AS BIGINT)"


_EARLIER = "OVER (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

MIXING = f"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM totals
), weighted AS (
    SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS weight, rank AS row_key FROM ranked
), levels AS (
    SELECT *,
        (CAST(sum(source_size) OVER () AS DOUBLE)
            - coalesce(CAST(sum(3 * source_size) {_EARLIER} AS DOUBLE), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) {_EARLIER}, 0)) AS level
    FROM weighted
), aims AS (
    SELECT * EXCLUDE (level),
        least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target,
        greatest(CAST(ceil(source_size / 1048576.0) AS BIGINT), 1) AS shards
    FROM levels
), housed AS (
    SELECT *, CAST(round(sum(target) OVER () / 32) AS BIGINT) AS house FROM aims
), {_apportioned('by_source', 'housed', 'target', 'house', 'rank', '')}, placed AS (
    SELECT doc_id, size, source_size, target, rank, seats AS blocks, shards,
        {_seeded("coalesce(CAST(doc_id AS VARCHAR), '')")} AS place
    FROM sizes JOIN by_source ON sizes.source IS NOT DISTINCT FROM by_source.source
), dealt AS (
    SELECT *, place % shards AS shard FROM placed
), shard_sizes AS (
    SELECT rank, shard, blocks, rank || ':' || shard AS row_key,
        CAST(sum(size) AS BIGINT) AS shard_size FROM dealt GROUP BY rank, shard, blocks
), {_apportioned('quotas', 'shard_sizes', 'shard_size', 'blocks', 'shard', 'rank')}, stream AS (
    SELECT dealt.*, shard_size, greatest(CAST(ceil(shard_size / 32.0) AS BIGINT), 1) AS n_blocks, seats,
        CAST(sum(size) OVER (PARTITION BY dealt.rank, dealt.shard ORDER BY place, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS last,
        {_seeded("dealt.rank || '|' || dealt.shard")} AS shift
    FROM dealt JOIN quotas ON dealt.rank = quotas.rank AND dealt.shard = quotas.shard
), cut AS (
    SELECT *, last - size AS first, least(seats, 3 * n_blocks) AS quota, 2147483647 % n_blocks AS step
    FROM stream
)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN size > 0 THEN size * (quota // n_blocks) + coalesce(list_sum(list_transform(
        range(first // 32, (last - 1) // 32 + 1), lambda b:
        CASE WHEN (step * b + shift % n_blocks) % n_blocks < quota % n_blocks
            THEN least(last, (b + 1) * 32) - greatest(first, b * 32) ELSE 0 END)), 0)
        ELSE 0 END AS BIGINT) AS taken,
    CAST(CASE WHEN size > 0 THEN quota // n_blocks + CAST(
        (step * (first // 32) + shift % n_blocks) % n_blocks < quota % n_blocks AS INT)
        ELSE 0 END AS INT) AS copies
FROM cut
"""

_LADDERS = {
    "symbols": ("n_symbols", "n_words", (2000, 1000, 500, 300, 200, 100)),
    "repeats": ("n_repeat_words", "n_words", (500, 450, 400, 350, 300, 250, 200)),
    "lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400)),
    "length": ("word_chars", "n_words", (14000, 12000, 11000, 10000, 9000, 8000)),
}
_TESTS = " UNION ALL ".join(
    f"""SELECT lang, '{rule}' AS rule, {rung} AS rung, {cutoff} AS cutoff, count(*) AS n,
        count(*) FILTER (WHERE {lower} > 0 AND 1000 * {upper} >= {cutoff} * {lower}) AS k
        FROM good GROUP BY lang"""
    for rule, (upper, lower, ladder) in _LADDERS.items()
    for rung, cutoff in enumerate(ladder)
)
_REJECTED = " OR ".join(
    f"""coalesce({lower} > 0 AND 1000 * {upper} >= {lower} * (SELECT cutoff FROM cutoffs
        WHERE cutoffs.lang IS NOT DISTINCT FROM judged.lang AND rule = '{rule}'), false)"""
    for rule, (upper, lower, _) in _LADDERS.items()
)
# crc32 as SQL: bit by bit over the digits of the id.
_CRC32 = """list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(t) + 1), lambda i: ascii(t[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))"""

QUALITY = rf"""
WITH words AS (
    SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)),
        lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS l FROM words
), windows AS (
    SELECT doc_id, i, w[i:i + 2] AS three
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM repeated, (VALUES (0), (1), (2)) steps(j) GROUP BY doc_id
), measured AS (
    SELECT words.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM words JOIN lines ON words.doc_id = lines.doc_id
    LEFT JOIN covered ON words.doc_id = covered.doc_id
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), good_ids AS (
    SELECT doc_id FROM (SELECT doc_id, min(quality) AS quality, CAST(doc_id AS VARCHAR) AS t
        FROM labels GROUP BY doc_id)
    WHERE quality = 1 AND xor({_CRC32}, 4294967295::BIGINT) % 4 <> 2
), good AS (
    SELECT judged.* FROM judged JOIN good_ids ON judged.doc_id = good_ids.doc_id WHERE NOT base_failed
), tests AS (
    SELECT *, count(DISTINCT coalesce(lang, '')) OVER () AS strata FROM ({_TESTS})
), tails AS (
    SELECT *, CASE WHEN k < n * 0.005 THEN least(1.0, list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995)))))
        ELSE 1.0 END AS tail FROM tests
), held AS (
    SELECT *, min(CAST(tail <= 0.05 / (strata * 4) AS INT)) OVER (
        PARTITION BY lang, rule ORDER BY rung ROWS UNBOUNDED PRECEDING) AS passed FROM tails
), cutoffs AS (
    SELECT lang, rule, min(cutoff) AS cutoff FROM held WHERE passed = 1 GROUP BY lang, rule
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ({_REJECTED}) AS kept
FROM judged
"""


INFILL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n,
        CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one,
        CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
            WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT *, array_to_string(u[1:least(one, two)], '') AS p,
        array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
        array_to_string(u[greatest(one, two) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

CHATS = r"""
WITH rows AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), filled AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256
FROM filled GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_jaccard": JACCARD,
        "op7_mixing": MIXING,
        "op10_quality_rules": QUALITY,
        "op11_infill": INFILL,
        "op12_hard_negatives": NEGATIVES,
    }
