"""DuckDB SQL for the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from ledgerline.llm import mixing as MX

OP1 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
    FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT size FROM sized),
grams AS (
    SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT r, g.size, i, item_id FROM grams g JOIN windows n ON g.size = n.size AND g.gram = n.gram),
hits AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP5 = """
WITH calls AS (
    SELECT conv_id, turn, 't' || turn AS call_id, text AS prompt, row_number() OVER (
               PARTITION BY conv_id ORDER BY turn) - 1 AS position,
           't' || (turn - 2) AS dep
    FROM conversations WHERE role = 'user'),
results AS (
    SELECT conv_id, turn, 't' || (turn - 1) AS call_id, text AS content
    FROM conversations WHERE role = 'assistant'),
joined AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
           coalesce(c.turn, r.turn) AS turn, c.prompt, c.dep, c.position, r.content,
           CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered'
                ELSE 'linked' END AS status
    FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id)
SELECT conv_id, turn, call_id, CASE WHEN status <> 'orphan' THEN 'reply' END AS name, position, status,
       status = 'linked' AND prompt IS NOT NULL AS valid,
       CASE WHEN status <> 'orphan' AND prompt IS NULL THEN 'type:prompt' ELSE '' END AS errors,
       '{"arguments":' || CASE WHEN status = 'orphan' THEN 'null' ELSE
           '{"prompt":' || coalesce(CAST(to_json(prompt) AS VARCHAR), 'null') || ',"turn":' || turn || '}' END
       || ',"call_id":"' || call_id || '","conv_id":' || conv_id || ',"depends_on":'
       || CASE WHEN status = 'orphan' THEN 'null' ELSE '["' || dep || '"]' END
       || ',"name":' || CASE WHEN status = 'orphan' THEN 'null' ELSE '"reply"' END
       || ',"position":' || coalesce(CAST(position AS VARCHAR), 'null')
       || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
       || ',"status":"' || status || '"}' AS json
FROM joined
"""


def _weight(level: str, weights: dict[str, int]) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _level(source: str, parents: list[str], child: str, weights: dict[str, int], name: str) -> str:
    """One level of the tree: children of ``source`` share its budget."""
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    own = ", ".join([*(f"n.{p}" for p in parents), f"n.{child}"])
    join = " AND ".join(f"n.{p} IS NOT DISTINCT FROM s.{p}" for p in parents) or "TRUE"
    order = f"{family} ORDER BY ratio ASC NULLS LAST, {child} ASC NULLS FIRST ROWS"
    return f"""
{name}_a AS (
    SELECT {own}, n.capacity, s.budget, {_weight(child, weights)} AS weight,
           CASE WHEN {_weight(child, weights)} > 0
                THEN n.capacity::DOUBLE / {_weight(child, weights)} END AS ratio
    FROM (SELECT {', '.join([*parents, child])}, sum(tokens) * {MX.EPOCHS} AS capacity FROM leaves
          GROUP BY ALL) n JOIN {source} s ON {join}),
{name}_b AS (
    SELECT *, weight > 0 AND capacity::HUGEINT * sum(weight) OVER (
                  {order} BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              <= greatest(budget - coalesce(sum(capacity) OVER (
                  {order} BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) * weight AS is_full
    FROM {name}_a),
{name}_c AS (
    SELECT *, greatest(budget - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({family}), 0), 0) AS pot,
           sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open_weight,
           sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (
               {order} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM {name}_b),
{name} AS (
    SELECT {', '.join([*parents, child])},
           CASE WHEN is_full THEN capacity WHEN weight = 0 THEN 0
                ELSE pot * upto // greatest(open_weight, 1) - pot * (upto - weight) // greatest(open_weight, 1)
           END AS budget
    FROM {name}_c)"""


def _domains() -> str:
    """CRC-32 isn't in the SQL dialect: the sources' domains are spelled out."""
    import zlib
    return "CASE source " + " ".join(
        f"WHEN 'src{i}' THEN 'd{zlib.crc32(f'src{i}'.encode()) % 4}'" for i in range(100)) + " END"


OP7 = rf"""
WITH rows_ AS (
    SELECT doc_id, lang, source, {_domains()} AS domain,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
    FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM rows_ GROUP BY ALL),
root AS (SELECT sum(tokens) * {MX.SHARE[0]} // {MX.SHARE[1]} AS budget FROM leaves),
{_level('root', [], 'domain', MX.DOMAIN_WEIGHTS, 'l1')},
{_level('l1', ['domain'], 'lang', MX.LANG_WEIGHTS, 'l2')},
{_level('l2', ['domain', 'lang'], 'source', MX.SOURCE_WEIGHTS, 'l3')},
plan AS (
    SELECT l.*, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
           CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
    FROM leaves l JOIN l3 ON l.domain IS NOT DISTINCT FROM l3.domain
        AND l.lang IS NOT DISTINCT FROM l3.lang AND l.source IS NOT DISTINCT FROM l3.source),
placed AS (
    SELECT r.*, whole, rest, md5('{MX.SEED}:' || CAST(whole AS BIGINT) || ':'
                                 || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM rows_ r JOIN plan p ON r.domain IS NOT DISTINCT FROM p.domain
        AND r.lang IS NOT DISTINCT FROM p.lang AND r.source IS NOT DISTINCT FROM p.source),
summed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS total FROM placed)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
       CAST(whole + CASE WHEN rest > 0 AND total <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM summed
WHERE whole + CASE WHEN rest > 0 AND total <= rest THEN 1 ELSE 0 END > 0
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hexed: str) -> str:
    """Five hex digits are four base32 digits."""
    parts = []
    for i in range(8):
        n = f"CAST('0x' || substr({hexed}, {5 * i + 1}, 5) AS BIGINT)"
        parts += [f"substr('{_BASE32}', CAST((({n} >> {s}) & 31) + 1 AS BIGINT), 1)" for s in (15, 10, 5, 0)]
    return " || ".join(parts)


OP9 = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p GROUP BY html HAVING count(*) > 1)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, {_base32('d')} AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END
           AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN g ON p.html = g.html
"""

ORACLE_SQL = {"op1_decontamination": OP1, "op5_chat_format": OP5, "op7_mixing": OP7, "op9_warc": OP9}

OP12 = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
judged AS (
    SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
           100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic
    FROM w JOIN firsts USING (t)),
masks AS (
    SELECT part, good, toxic, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n
    FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
steps AS (
    SELECT p.x || q.x || r.x || s.x || u.x AS filter_order, k AS step,
           [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
    FROM letters p, letters q, letters r, letters s, letters u, range(1, 6) t(k)
    WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND
          len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
counted AS (
    SELECT part, filter_order, step, bits[step] AS bit,
           sum(CASE WHEN mask & before = 0 AND mask & bits[step] = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bits[step] > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before > 0 AND mask & bits[step] > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bits[step] THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN good AND mask & before = 0 AND mask & bits[step] > 0 THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN toxic AND mask & before = 0 AND mask & bits[step] > 0 THEN n ELSE 0 END) AS toxic_lost
    FROM masks, (SELECT *, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before FROM steps)
    GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


def _op13(k: int = 8, rounds: int = 10) -> str:
    """The rounds written one after the other; one row per centroid and component in each."""
    chain = [f"""kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id,
               list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)
                                                      AND abs(CAST(x AS DOUBLE) * 1024) < 16777216)) = 64)""",
             f"""c0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INT) AS cluster, v
        FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept) ORDER BY h NULLS LAST, v LIMIT {k})"""]
    for i in range(rounds + 1):
        chain.append(f"""a{i} AS MATERIALIZED (
        SELECT r, vec_id, v, b.cluster, b.distance FROM (
            SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'distance': d, 'cluster': cluster}}) AS b
            FROM (SELECT r, vec_id, k.v, c.cluster, CAST(list_sum(list_transform(range(1, 65),
                         lambda j: (k.v[j] - c.v[j]) * (k.v[j] - c.v[j]))) AS BIGINT) AS d
                  FROM kept k, c{i} c) GROUP BY r))""")
        if i < rounds:
            chain.append(f"""c{i + 1} AS MATERIALIZED (
        SELECT cluster, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
            SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v
            FROM (SELECT cluster, j, sum(x) AS s, count(*) AS n
                  FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY cluster, j)
            GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(chain) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster)
"""


ORACLE_SQL |= {"op12_filter_audit": OP12, "op13_centroids": _op13()}
