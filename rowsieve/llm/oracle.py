"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from rowsieve.llm import secrets

_NORMAL = r"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _NORMAL + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format(text="coalesce(text, '')")} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS win
    FROM items, unnest(generate_series(1, greatest(1, len(w) - 9))) AS g(i) WHERE len(w) > 0
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format(text="coalesce(text, '')")} AS w FROM documents
), places AS (
    SELECT r, i, m, list_slice(w, i, i + m - 1) AS win
    FROM docs, (SELECT DISTINCT m FROM windows), unnest(generate_series(1, len(w) - m + 1)) AS g(i)
    WHERE len(w) >= m
), hits AS (SELECT r, i, m, item FROM places JOIN windows USING (m, win)),
words AS (
    SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, i, m FROM hits), unnest(generate_series(i, i + m - 1)) AS g(j) GROUP BY r
), found AS (SELECT r, list_sort(list(DISTINCT item)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
    sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    CASE WHEN len(w) > 0 THEN CAST(coalesce(n_hit, 0) AS DOUBLE) / len(w) ELSE 0.0 END AS coverage
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

OP2 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT r, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS win
    FROM docs, unnest(generate_series(1, len(w) - 34)) AS g(i) WHERE len(w) >= 35
), again AS (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM windows),
gone AS (SELECT DISTINCT r, j FROM (SELECT r, i FROM again WHERE n > 1), unnest(generate_series(i, i + 34)) AS g(j)),
kept AS (
    SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS words
    FROM (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM docs) ANTI JOIN gone USING (r, j) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

OP6 = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_NORMAL.format(text="coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, list_slice(w, i, i + 4) AS s FROM docs, unnest(generate_series(1, greatest(1, len(w) - 4))) AS g(i)
    WHERE len(w) > 0
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reach AS (
    SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN component USING (r) LEFT JOIN sizes USING (r)
"""

_REST = r"(?:\|im_start\|>|\|im_end\|>|/?s>|<SYS>>|</SYS>>|/?INST\])"
OP7 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), blocks AS (
    SELECT *, '<|im_start|>' || role || chr(10)
        || regexp_replace(text, '([<\[])(\\*{_REST})', '\1\\\2', 'g') || '<|im_end|>' || chr(10) AS block FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(block)) AS BIGINT) AS formatted_chars
FROM blocks GROUP BY conv_id
"""

OP10 = """
WITH bits AS (
    SELECT vec_id, list_reduce(list_transform(embedding[1:64], lambda x: CAST(x > 0 AS INTEGER)::VARCHAR), lambda a, b: a || b)::BIT AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
    SELECT q.vec_id AS query_id, d.vec_id AS id, CAST(bit_count(xor(q.code, d.code)) AS INTEGER) AS distance
    FROM bits q, bits d WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10
"""

#: The reflected CRC-32, bit by bit from the lowest, as DuckDB has no function for it.
_CRC = """(xor(list_reduce(list_prepend(4294967295, list_transform(range(8 * length({text})),
    lambda i: (ascii({text}[i // 8 + 1]) >> (i % 8)) & 1)),
    lambda c, bit: CASE WHEN (xor(c, bit) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295))"""
OP11 = rf"""
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, [coalesce(role, ''), coalesce(text, '')] AS t,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT c, list(t ORDER BY pos) AS ts FROM turns GROUP BY c),
heads AS (SELECT c, ts, {_CRC.format(text='CAST(c AS VARCHAR)')} % 4 AS h FROM own),
rebuilt AS (
    SELECT a.c, list_concat(coalesce(b.ts, [])[1:a.h], a.ts[a.h + 1:]) AS ts FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20
), prefixes AS (
    SELECT c, d, ts[1:d] AS p, d = len(ts) AS ends FROM rebuilt, unnest(generate_series(0, len(ts))) AS g(d)
), nodes AS (
    SELECT p, d, min(c) AS conv_id, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS members,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d][2], '[^\x20\x09-\x0D]+')) END AS saved
    FROM prefixes GROUP BY p, d
), children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
facts AS (
    SELECT nodes.*, coalesce(children.n, 0) AS kids FROM nodes LEFT JOIN children USING (p, d)
), above AS (
    SELECT f.p[1:k] AS p, k AS d, CAST(sum(saved) AS BIGINT) AS saved, count(*) FILTER (kids = 0) AS n_leaves
    FROM facts f, unnest(generate_series(0, f.d)) AS g(k) GROUP BY 1, 2
)
SELECT f.conv_id, f.d AS depth, parent.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, above.n_leaves,
    above.saved AS saved_tokens, sha256(coalesce(f.members, '')) AS ends_sha256
FROM facts f JOIN above USING (p, d) LEFT JOIN nodes parent ON f.d > 0 AND parent.d = f.d - 1 AND parent.p = f.p[1:f.d - 1]
"""

OP12 = """
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id AS id,
        CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r AS ar, a.id AS anchor_id, b.r, b.id, a.label = b.label AS same,
        CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])), 0) AS BIGINT) AS score
    FROM vectors a, vectors b WHERE a.id % 100 = 0 AND a.r <> b.r
), positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, r) <= 5
), ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.id, n.r) AS INTEGER) AS rank
    FROM positives p JOIN scored n ON n.ar = p.ar AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT * FROM ranked WHERE rank <= 5
"""


def _places(kind: str, pattern: str, keep: str = "true") -> str:
    """Matches of a pattern with their places, from what stands between them."""
    pattern = pattern.replace("'", "''")
    return rf"""
    SELECT r, '{kind}' AS kind, 1 + i AS nth, m[i + 1] AS found,
        list_sum(list_transform(b[1:i + 1], lambda x: length(x)) || list_transform(m[1:i], lambda x: length(x))) AS start
    FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS b FROM docs),
        unnest(range(len(m))) AS g(i) WHERE {keep.format(pattern=pattern)}"""


def _op13() -> str:
    base = [
        _places(p.kind, p.pattern, f"length(regexp_extract(m[i + 1], '{{pattern}}', {p.group})) >= {p.least}")
        for p in secrets.PATTERNS
    ]
    runs = [_places(c.kind, f"[{c.chars}]{{{c.window},}}") for c in secrets.CLASSES]
    windows = " ".join(f"WHEN '{c.kind}' THEN {c.window}" for c in secrets.CLASSES)
    limits = " ".join(f"WHEN '{c.kind}' THEN {c.limit}" for c in secrets.CLASSES)
    rank = " ".join(f"WHEN '{kind}' THEN {i}" for i, kind in enumerate(secrets.KINDS))
    back = secrets.BACK

    def allowed(where: str) -> str:
        return "|".join(f"(?:{a.pattern})" for a in secrets.ALLOWED if a.where == where)

    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, CASE kind {rank} END){only}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in secrets.BASE_KINDS)
    is_base = "kind IN (" + ", ".join(f"'{kind}'" for kind in secrets.BASE_KINDS) + ")"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({" UNION ALL ".join(base)}),
runs AS ({" UNION ALL ".join(runs)}),
sized AS (SELECT *, CASE kind {windows} END AS w FROM runs),
chars AS (
    SELECT r, kind, nth, j, found[j + x] AS c, count(*) AS n
    FROM sized, unnest(range(length(found) - w + 1)) AS g(j), unnest(range(1, w + 1)) AS h(x) GROUP BY ALL
), sums AS (
    SELECT r, kind, nth, j, sum(CAST(round(n * log2(n) * 4294967296) AS BIGINT)) AS f FROM chars GROUP BY ALL
), hot AS (
    SELECT r, kind, nth, j, w, start, j > lag(j + w) OVER (PARTITION BY r, kind, nth ORDER BY j) AS apart
    FROM sums JOIN sized USING (r, kind, nth) WHERE f <= CASE kind {limits} END
), joined AS (
    SELECT *, count(*) FILTER (apart) OVER (PARTITION BY r, kind, nth ORDER BY j) AS part FROM hot
), spans AS (
    SELECT r, kind, min(start + j) AS start, max(start + j + w) AS stop FROM joined GROUP BY r, kind, nth, part
), kept AS (
    SELECT spans.* FROM spans JOIN docs USING (r)
    WHERE NOT regexp_full_match(text[start + 1:stop], '{allowed("whole")}') AND NOT regexp_matches(text[start + 1:stop], '{allowed("within")}')
        AND NOT regexp_matches(text[greatest(1, start + 1 - {back}):start], '(?:{allowed("before")})$')
), found AS (
    SELECT r, kind, start, start + length(found) AS stop FROM base UNION ALL SELECT * FROM kept
), reports AS (
    SELECT r, {counts}, {joined.format(rank=rank, only=f" FILTER ({is_base})")} AS base_spans,
        {joined.format(rank=rank, only="")} AS spans, count(*) FILTER (NOT {is_base}) AS n_entropy FROM found GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE_KINDS)}, sha256(coalesce(base_spans, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM docs LEFT JOIN reports USING (r)
"""


OP13 = _op13()

ORACLE: dict[str, str] = {
    "op1_decontaminate": OP1,
    "op2_substring_dedup": OP2,
    "op6_near_dedup": OP6,
    "op7_chat_format": OP7,
    "op10_hamming_search": OP10,
    "op11_prefix_trie": OP11,
    "op12_hard_negatives": OP12,
    "op13_secret_scan": OP13,
}
