"""SQL counterparts of the text operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Both rankings straight from their definition: every kept term with every group, nothing merged.
DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text
    FROM documents
), tokens AS (
    SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT i) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), found AS (
    SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL
), sources AS (
    SELECT g.lang, g.source, coalesce(sum(f.n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN found f USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (s.total + l.v)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v)::HUGEINT AS whole
    FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN found f USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT p.lang, p.source, q.source AS item, sum((p.p - q.p) * (p.p - q.p) // q.p) AS value
        FROM shares p JOIN shares q ON p.lang = q.lang AND p.term = q.term AND p.source <> q.source GROUP BY ALL
    ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
    SELECT lang, source, term AS item, (p - whole) * (p - whole) // whole AS value FROM shares WHERE n > 0 AND p > whole
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def _vector_codes(rounds: int = 4) -> str:
    """Plain nearest entries by all distances, round after round."""
    steps = """
    kept AS (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS i, vec_id, label, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), comps AS MATERIALIZED (
        SELECT i, (j - 1) // (d // 4) AS part, (j - 1) % (d // 4) AS j, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
        FROM (SELECT i, len(embedding) AS d, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS j FROM kept)
    ), book0 AS MATERIALIZED (SELECT part, i - 1 AS entry, j, x FROM comps WHERE i <= 256),"""
    for r in range(rounds + 1):
        steps += f"""
    near{r} AS MATERIALIZED (
        SELECT i, part, min_by(entry, (d, entry)) AS entry, min(d) AS d
        FROM (
            SELECT c.i, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d
            FROM comps c JOIN book{r} b ON c.part = b.part AND c.j = b.j GROUP BY ALL
        ) GROUP BY i, part
    ),"""
        if r < rounds:
            steps += f"""
    book{r + 1} AS MATERIALIZED (
        SELECT b.part, b.entry, b.j, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
            SELECT n.part, n.entry, c.j, CAST((sum(c.x) - ((sum(c.x) % count(*) + count(*)) % count(*))) // count(*) AS BIGINT) AS x
            FROM near{r} n JOIN comps c ON n.i = c.i AND n.part = c.part GROUP BY ALL
        ) m ON b.part = m.part AND b.entry = m.entry AND b.j = m.j
    ),"""
    return f"""
    WITH {steps}
    coded AS (
        SELECT i, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near{rounds} GROUP BY i
    ), digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, j)) AS h FROM book{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM coded JOIN kept USING (i), digest
    """


ORACLES: dict[str, str] = {
    "op11_divergence": DIVERGENCE,
    "op12_vector_codes": _vector_codes(),
}
