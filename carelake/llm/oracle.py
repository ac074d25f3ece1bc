"""The same results in SQL, for the operators that SQL can state."""

from __future__ import annotations


def _lloyd(k: int, rounds: int, dimensions: int, salt: str) -> str:
    """Lloyd's rounds, unrolled."""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"

    def near(n: int) -> str:
        return f"""near{n} AS MATERIALIZED (
            SELECT vec_id, best.cluster AS cluster, best.d AS distance, x FROM (
                SELECT any_value(v.vec_id) AS vec_id, any_value(v.x) AS x, min({{'d': {distance}, 'cluster': c.cluster}}) AS best
                FROM v, c{n} c GROUP BY v.row_no))"""

    def moved(n: int) -> str:
        return f"""c{n + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
                SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM (
                    SELECT cluster, place, sum(value)::BIGINT AS s, count(*) AS n FROM (
                        SELECT cluster, unnest(x) AS value, generate_subscripts(x, 1) AS place FROM near{n})
                    GROUP BY cluster, place)
                GROUP BY cluster) m USING (cluster))"""

    steps = []
    for n in range(rounds):
        steps += [near(n), moved(n)]
    steps.append(near(rounds))
    return f"""WITH v AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * 1024)::BIGINT) AS x, row_number() OVER () AS row_no
        FROM embeddings WHERE len(embedding) = {dimensions}
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e) AND abs(e::DOUBLE * 1024) < 67108864)) = {dimensions}),
        c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS cluster, x FROM (
                SELECT sha256('{salt}:' || vec_id::VARCHAR) AS h, x FROM v ORDER BY h, x LIMIT {k})),
        {", ".join(steps)},
        sums AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM near{rounds} GROUP BY cluster)
    SELECT n.vec_id, n.cluster, n.distance, s.cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia,
        sha256(array_to_string(c.x, ',')) AS centroid_sha256
    FROM near{rounds} n JOIN sums s USING (cluster) JOIN c{rounds} c USING (cluster)"""


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    t AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
        substr('{_BASE32}', (((('0x' || substr(hex, (5 * i + 1)::INTEGER, 5))::BIGINT >> s) & 31) + 1)::INTEGER, 1)),
        'string_agg', '')), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM t"""

# The CRC of the bytes of a word, through the table of the 256 byte values that the polynomial gives.
_CRC_TABLE = """SELECT list(r ORDER BY b) AS crc_of FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
    FROM (SELECT unnest(range(256)) AS b))"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen(word)),
    lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INTEGER, 2))::BIGINT)),
    lambda r, b: xor(r >> 8, crc_of[(xor(r, b) & 255) + 1])))"""


def _resampling(buckets: int, percent: int, least_words: int, seed: str) -> str:
    def words(table: str, key: str) -> str:
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        return f"""SELECT {key}, row_number() OVER () AS row_no, regexp_extract_all(
            translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM {table}"""

    def counts(name: str) -> str:
        return f"SELECT bucket, count(*) AS n FROM (SELECT unnest(words) AS word FROM {name}) JOIN hashed USING (word) GROUP BY bucket"

    return f"""WITH d AS MATERIALIZED ({words("documents", "doc_id")}), b AS MATERIALIZED ({words("benchmark", "item_id")}),
    crcs AS MATERIALIZED ({_CRC_TABLE}),
    vocabulary AS MATERIALIZED (SELECT DISTINCT unnest(words) AS word FROM (SELECT words FROM d UNION ALL SELECT words FROM b)),
    hashed AS MATERIALIZED (SELECT word, ({_CRC}) % {buckets} AS bucket FROM vocabulary, crcs),
    s AS ({counts("d")}), t AS ({counts("b")}),
    sizes AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
    gains AS MATERIALIZED (
        SELECT g.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {buckets})::DOUBLE
            / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + {buckets})::DOUBLE)))::BIGINT AS gain
        FROM (SELECT unnest(range({buckets})) AS bucket) g LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sizes),
    weights AS (
        SELECT row_no, sum(gain)::BIGINT AS weight FROM (SELECT row_no, unnest(words) AS word FROM d)
        JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row_no),
    scored AS (
        SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM d LEFT JOIN weights USING (row_no)),
    able AS (
        SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
            count(*) OVER (PARTITION BY n_features >= {least_words}) AS n FROM scored)
    SELECT doc_id, n_features, weight, score,
        CASE WHEN n_features >= {least_words} AND place <= {percent} * n // 100 THEN place END AS rank FROM able"""


ORACLE: dict[str, str] = {
    "op11_lloyd_clusters": _lloyd(8, 10, 64, "3"),
    "op12_seekable_warc": WARC,
    "op13_importance_resampling": _resampling(10_000, 10, 20, "2024"),
}
