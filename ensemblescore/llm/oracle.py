"""The SQL each query must agree with, where SQL can say it."""

from ensemblescore.llm import licenses

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
    SELECT *, row_number() OVER w AS rn, lag(role) OVER w IS DISTINCT FROM role AS opens,
        lead(role) OVER w IS DISTINCT FROM role AS closes,
        length(text) + len(regexp_extract_all(text, '<\\*/?s>'))
            + len(regexp_extract_all(text, '\[\\*(?:/?INST|/?ROLE|TURN)\]')) AS text_chars,
        length(role) + len(regexp_extract_all(role, '<\\*/?s>'))
            + len(regexp_extract_all(role, '\[\\*(?:/?INST|/?ROLE|TURN)\]')) AS role_chars
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_chars
        + CASE WHEN NOT opens THEN 6 WHEN role = 'user' THEN 6 WHEN role = 'assistant' THEN 3
               ELSE 13 + role_chars END
        + CASE WHEN NOT closes THEN 0 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 4
               ELSE 0 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS (
    SELECT *, regexp_extract_all(t, '{_WORD}') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d),
g AS (SELECT r, i, ws[i:i+4] AS win FROM (
    SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM s WHERE len(ws) >= 5)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
m AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls) AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echo_words,
        len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
    FROM s LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
        OR 10 * n_echo_words > 3 * n_words
        OR (10 * n_capitals > 3 * word_chars AND n_words >= 10)) AS kept
FROM b
"""

OP6 = rf"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')) AS digest FROM documents),
ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS top FROM ranked),
levelled AS (
    SELECT *, top / weight AS ratio, (sum(source_size) OVER () * 1.5::DOUBLE
        - coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW o AS (ORDER BY top / weight, rank)),
common AS (SELECT arg_min(level, (ratio, rank)) AS common FROM levelled WHERE ratio > level),
sources AS (
    SELECT rank, source, source_size, least(top::DOUBLE, weight * coalesce(common, 'inf'::DOUBLE)) AS target
    FROM levelled, common),
placed AS (
    SELECT d.*, s.rank, source_size, target, floor(target + 0.5)::BIGINT AS words, sum(size) OVER (
        PARTITION BY s.rank ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
    FROM d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
    (least(greatest(words - start, 0), size) + least(greatest(words - source_size - start, 0), size))::BIGINT
        AS taken
FROM placed
"""

#: The template texts as words, and how far apart blocks begin: fixed values of the query.
_TEMPLATES = ",\n    ".join(f"('{label}', '{' '.join(licenses.template_words(text))}')" for label, text in licenses.TEMPLATES)
_STRIDE = licenses.stride(licenses.TEMPLATES)

OP9 = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
phrases AS (SELECT string_split(p, ' ') AS pw, label FROM (VALUES
    ('under the mit license', 'mit'), ('apache license version 2', 'apache-2'),
    ('cc by nc', 'cc-by-nc')) AS v(p, label)),
starts AS (
    SELECT r, label, i FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), phrases
    WHERE ws[i] = pw[1] AND ws[i:i + len(pw) - 1] = pw),
base AS (
    SELECT r, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word,
        list(DISTINCT label) AS labels FROM starts GROUP BY r),
templates AS (SELECT label, list_distinct(string_split(t, ' ')) AS tw FROM (VALUES
    {_TEMPLATES}) AS v(label, t)),
blocks AS (SELECT r, list_distinct(ws[b + 1:b + {2 * _STRIDE}]) AS bw FROM (
    SELECT r, ws, unnest(range(0, len(ws), {_STRIDE})) AS b FROM d)),
held AS (SELECT r, label, len(list_intersect(bw, tw)) / len(tw)::DOUBLE AS share FROM blocks, templates),
method AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS best FROM held WHERE share >= 0.8 - 1e-9 GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ',')
        AS labels,
    CASE WHEN n_base > 0 THEN 1 ELSE coalesce(best, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""

def _op11(rounds: int = 3) -> str:
    """Assign and replace, round by round; component by component, so that all sums are whole numbers."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
    SELECT r, min(d) AS distance, min_by(c, (d, c)) AS cluster FROM (
        SELECT k.r, m.c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i])))::BIGINT AS d
        FROM k, c{i} m) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (
    SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{i} JOIN k USING (r)) GROUP BY cluster, i),
c{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(w, v) AS v FROM c{i} LEFT JOIN (
        SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM s{i} GROUP BY cluster) ON c = cluster)""")
    return f"""
WITH k AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM k
    QUALIFY c < 16),{','.join(steps)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN k USING (r) JOIN c{rounds} m ON m.c = cluster
"""


OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(ws) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
    SELECT lang, source, coalesce(sum(n), 0) + 2 * coalesce(any_value(v), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS MATERIALIZED (
    SELECT lang, source, term, coalesce(n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // total AS p
    FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
    FROM c GROUP BY lang, term),
f AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
    (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM x QUALIFY part = 'pair' OR rank <= 10
"""


SQL = {
    "op1_chat_format": OP1,
    "op5_quality": OP5,
    "op6_mixing": OP6,
    "op9_licenses": OP9,
    "op11_clustering": _op11(),
    "op12_divergence": OP12,
}
