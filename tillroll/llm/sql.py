"""DuckDB SQL for the queries that it can express."""

SQL: dict[str, str] = {}

_WORDS = r"""
words AS (
    SELECT doc_id, i, {word} AS w
    FROM (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (
            SELECT doc_id,
                list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents
        )
    )
)"""
_LOWER = "translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_lm_scoring"] = f"""
WITH {_WORDS.format(word=_LOWER)},
placed AS (
    SELECT doc_id, w,
        lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS w1,
        lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS w2
    FROM words
),
one AS (SELECT w, count(*) AS n FROM placed GROUP BY ALL),
two AS (SELECT w1, w, count(*) AS n FROM placed WHERE w1 IS NOT NULL GROUP BY ALL),
three AS (SELECT w2, w1, w, count(*) AS n FROM placed WHERE w2 IS NOT NULL GROUP BY ALL),
total AS (SELECT count(*) AS n FROM placed),
counted AS (
    SELECT p.doc_id, p.w1, p.w2, c1.n AS c1, c1p.n AS p1, c2.n AS c2, c2p.n AS p2, c3.n AS c3
    FROM placed p
    JOIN one c1 ON c1.w = p.w
    LEFT JOIN one c1p ON c1p.w = p.w1
    LEFT JOIN two c2 ON c2.w1 = p.w1 AND c2.w = p.w
    LEFT JOIN two c2p ON c2p.w1 = p.w2 AND c2p.w = p.w1
    LEFT JOIN three c3 ON c3.w2 = p.w2 AND c3.w1 = p.w1 AND c3.w = p.w
),
scored AS (
    SELECT doc_id,
        CASE WHEN c3 >= 2 THEN 3 WHEN c2 >= 2 THEN 2 ELSE 1 END AS used,
        CASE
            WHEN c3 >= 2 THEN ln(c3 / p2)
            WHEN c2 >= 2 THEN ln(c2 / p1) + CASE WHEN w2 IS NOT NULL THEN ln(0.4) ELSE 0 END
            ELSE ln(c1 / (SELECT n FROM total))
                + CASE WHEN w2 IS NOT NULL THEN ln(0.4) ELSE 0 END
                + CASE WHEN w1 IS NOT NULL THEN ln(0.4) ELSE 0 END
        END AS s
    FROM counted
),
sums AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (used = 1) AS n_unigram,
        count(*) FILTER (used = 2) AS n_bigram, count(*) FILTER (used = 3) AS n_trigram, sum(s) AS s
    FROM scored GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
    coalesce(n_unigram, 0)::BIGINT AS n_unigram, coalesce(n_bigram, 0)::BIGINT AS n_bigram,
    coalesce(n_trigram, 0)::BIGINT AS n_trigram,
    round(coalesce(s, 0), 5) + 0.0 AS log_score, round(s / n_words, 5) AS mean_log_score
FROM documents d LEFT JOIN sums USING (doc_id)
"""

SQL["op4_warc_archives"] = """
WITH digests AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest
    FROM pages
),
bits AS (
    SELECT digest, array_to_string(list_transform(string_split(digest, ''),
        lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111',
                    4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS b
    FROM (SELECT DISTINCT digest FROM digests)
),
coded AS (
    SELECT digest, array_to_string(list_transform(range(32),
        lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT
              + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT
              + substr(b, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest
    FROM bits
),
first AS (SELECT digest, max(page_id) AS page FROM digests GROUP BY digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> page THEN page END AS refers_to
FROM digests JOIN coded USING (digest) JOIN first USING (digest)
"""

SQL["op7_minhash_near_dedup"] = f"""
WITH RECURSIVE {_WORDS.format(word=_LOWER)},
by_text AS (SELECT doc_id, list(w ORDER BY i) AS ws FROM words GROUP BY doc_id),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
    FROM by_text
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

SQL["op10_poisson_mixing"] = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, pow(n, 0.5) * (SELECT sum(n) FROM counts)
        / ((SELECT sum(pow(n, 0.5)) FROM counts) * n) AS rate
    FROM counts
),
parted AS (
    SELECT source, greatest(ceil(rate / 8), 1)::BIGINT AS parts, rate / greatest(ceil(rate / 8), 1) AS mean
    FROM rates
),
cdf AS (
    SELECT source, 0 AS k, exp(-mean) AS p, exp(-mean) AS upto, mean FROM parted
    UNION ALL
    SELECT source, k + 1, p * mean / (k + 1), upto + p * mean / (k + 1), mean FROM cdf WHERE k < 48
),
draws AS (
    SELECT d.*, part,
        (('0x' || substr(md5('20010:' || doc_id || ':' || part), 1, 13))::BIGINT + 0.5) / 4503599627370496 AS u
    FROM documents d JOIN parted USING (source), unnest(range(parts)) AS t(part)
),
drawn AS (
    SELECT doc_id, part, count(c.k) AS copies
    FROM draws d LEFT JOIN cdf c ON c.source = d.source AND c.upto < d.u GROUP BY ALL
),
copied AS (
    SELECT doc_id, part * 49 + t.n AS copy FROM drawn, unnest(range(copies)) AS t(n)
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, copy::BIGINT AS copy,
    ('0x' || substr(md5('20011:' || doc_id || ':' || copy), 1, 13))::BIGINT AS shuffle_key
FROM copied JOIN documents d USING (doc_id)
"""


def _manifest_sql(row_levels: int = 8, group_levels: int = 4) -> str:
    """The trees level by level; up to 8 ** ``row_levels`` rows to a language."""
    fields = " || ".join(
        f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
        for x in ("doc_id", "source", "lang", "n_chars", "{text}")
    )
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, n: int) -> str:
        """``name0`` (grp, pos, h) is given; the others, and each node's siblings."""
        out = []
        for j in range(n):
            side = "string_agg(h, '') OVER (PARTITION BY grp, pos // 8 ORDER BY pos ROWS BETWEEN {})"
            left = side.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
            right = side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
            out.append(f"""
{name}s{j} AS (
    SELECT grp, pos, count(*) OVER (PARTITION BY grp) > 1 AS up, h,
        coalesce({left}, '') AS l, coalesce({right}, '') AS r
    FROM {name}{j}
),
{name}{j + 1} AS (
    SELECT grp, pos // 8 AS pos, CASE WHEN up THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
    FROM {name}s{j} GROUP BY grp, pos // 8, up
)""")
        return ",".join(out)

    steps, joins, at, proof = "", "", "changed", []
    for name, n, key, pos in (("n", row_levels, "p.grp", "p.pos"), ("t", group_levels, "0", "p.grp")):
        for j in range(n):
            s = f"{name}s{j}"
            joins += f"\n    JOIN {s} ON {s}.grp = {key} AND {s}.pos = {pos} // {8**j}"
            steps += f", CASE WHEN {s}.up THEN sha256({s}.l || {at} || {s}.r) ELSE {at} END AS {name}f{j}"
            proof.append(f"CASE WHEN {s}.up THEN {s}.l || {s}.r ELSE '' END")
            at = f"{name}f{j}"
    return f"""
WITH langs AS (
    SELECT lang AS of_lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp
    FROM (SELECT DISTINCT lang FROM documents)
),
hashed AS (
    SELECT doc_id, grp, sha256({fields.replace("{text}", "text")}) AS leaf,
        CASE WHEN xor(list_reduce(list_prepend(4294967295, range(9 * strlen(doc_id::VARCHAR))), lambda c, k:
            CASE WHEN k % 9 = 0 THEN xor(c, ord(substr(doc_id::VARCHAR, (k // 9 + 1)::BIGINT, 1))::BIGINT)
                WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 3 = 0
            THEN sha256({fields.replace("{text}", lower)}) END AS tampered
    FROM documents JOIN langs ON of_lang IS NOT DISTINCT FROM lang
),
placed AS (
    SELECT *, coalesce(tampered, leaf) AS changed,
        row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM hashed
),
n0 AS (SELECT grp, pos, leaf AS h FROM placed),{levels("n", row_levels)},
t0 AS (SELECT 0 AS grp, grp AS pos, h FROM n{row_levels}),{levels("t", group_levels)}
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM (
    SELECT p.doc_id, p.leaf, top.h AS subroot, (SELECT h FROM t{group_levels}) AS root,
        sha256({" || ".join(proof)}) AS proof_sha256{steps}, {at} AS folded_root
    FROM placed p JOIN t0 AS top ON top.pos = p.grp{joins}
)
"""


SQL["op11_merkle_manifest"] = _manifest_sql()

SQL["op13_exact_top_k"] = """
WITH scaled AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.row AS own, q.vec_id AS query_id, c.vec_id,
        coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS score
    FROM scaled q JOIN scaled c ON c.row <> q.row
    WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 10
"""
