"""DuckDB SQL of the queries that SQL can express.

The language model, toxicity, quality, decontamination, SentencePiece,
token-count, fingerprint and whitening queries have none: hashing, learning,
merging and eigenvectors are not SQL; the tests hold them against brute force or
the library."""

from __future__ import annotations

from .op05_urls import RULES, SECOND_LEVEL

SPLIT = r"list_filter(string_split_regex(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, text, {SPLIT.format(LOWER)} w FROM documents),
t AS (SELECT text, any_value(w) w, min(doc_id) k FROM d WHERE len(w) > 0 GROUP BY text),
s AS (SELECT DISTINCT k, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+2], ' ') END s
      FROM t, unnest(range(1, greatest(len(w) - 1, 2))) u(i)),
n AS (SELECT k, count(*) n FROM s GROUP BY k),
links AS (SELECT a.k a, b.k b FROM s a JOIN s b ON a.s = b.s AND a.k < b.k
          JOIN n na ON na.k = a.k JOIN n nb ON nb.k = b.k
          GROUP BY a.k, b.k, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT k, k m FROM t UNION SELECT r.k, e.b FROM r JOIN e ON r.m = e.a),
c AS (SELECT k, min(m) m FROM r GROUP BY k),
g AS (SELECT a, count(*) g FROM e GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, coalesce(c.m, d.doc_id) component_id,
       coalesce(g.g, 0)::BIGINT n_links
FROM d LEFT JOIN t ON d.text = t.text LEFT JOIN n ON n.k = t.k LEFT JOIN c ON c.k = t.k LEFT JOIN g ON g.a = t.k
"""

OP4 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT n, sha1(coalesce(html, '')) h FROM pages),
l AS (SELECT n, h, max(page_id) last FROM p GROUP BY n, h)
SELECT page_id, n payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           (((('0x' || substr(h, (10 * (i // 8) + 1)::BIGINT, 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT) & 31)::BIGINT), 1)), '')
           payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END record_type,
       CASE WHEN page_id <> last THEN last END refers_to, true digest_ok
FROM p JOIN l USING (n, h)
"""


def _op5(z: float = 1.645, least: float = 1.0, most: float = 1000.0, threshold: float = 0.5) -> str:
    fits = {r: f"(host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}')" for r in RULES}
    longest = sorted(RULES, key=lambda r: (len(r.name), r.name), reverse=True)
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.name}'" for r in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in longest) + " END"
    double = ", ".join(f"'{s}'" for s in SECOND_LEVEL)

    def strength(table: str, prior: str) -> str:
        return (f"(SELECT least(greatest(coalesce(1 / nullif(CASE WHEN p > 0 THEN greatest(x / p, 0.0) ELSE 0.0 END, 0.0) - 1, "
                f"{most}), {least}), {most}) FROM (SELECT sum(CASE WHEN n > 0 THEN pow(bad - n * {prior}, 2) - n * {prior} * "
                f"(1 - {prior}) END) x, sum(CASE WHEN n > 0 THEN n * (n - 1) * {prior} * (1 - {prior}) END) p FROM {table}))")

    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') u FROM pages),
v AS (SELECT page_id, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END r FROM u),
h0 AS (SELECT page_id, regexp_extract(r, '^([^/?#]*)', 1) h, r FROM v),
h AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
             regexp_extract(substr(r, length(h) + 1), '^([^?#]*)', 1) path FROM h0),
o AS (SELECT doc_id page_id, max(greatest(1 - quality, toxic)) bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
g AS (SELECT host, count(bad)::DOUBLE n, coalesce(sum(bad), 0)::DOUBLE bad FROM h LEFT JOIN o USING (page_id) GROUP BY host),
parts AS (SELECT *, string_split(host, '.') l FROM g),
two AS (SELECT *, array_to_string(list_slice(l, greatest(len(l) - 1, 1), len(l)), '.') t2,
        array_to_string(list_slice(l, greatest(len(l) - 2, 1), len(l)), '.') t3 FROM parts),
hosts AS (SELECT host, n, bad, CASE WHEN t2 IN ({double}) THEN t2 ELSE l[len(l)] END sfx,
          CASE WHEN t2 IN ({double}) THEN t3 ELSE t2 END dom FROM two),
corpus AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) rate FROM hosts),
s0 AS (SELECT sfx, sum(n) n, sum(bad) bad, (SELECT rate FROM corpus) prior FROM hosts GROUP BY sfx),
sk AS (SELECT {strength('s0', 'prior')} k),
s1 AS (SELECT sfx, (bad + k * prior) / (n + k) rate FROM s0, sk),
d0 AS (SELECT dom, sfx, sum(n) n, sum(bad) bad, any_value(s1.rate) prior FROM hosts JOIN s1 USING (sfx) GROUP BY dom, sfx),
dk AS (SELECT {strength('d0', 'prior')} k),
d1 AS (SELECT dom, sfx, (bad + k * prior) / (n + k) rate FROM d0, dk),
x0 AS (SELECT host, n, bad, d1.rate prior FROM hosts JOIN d1 USING (dom, sfx)),
xk AS (SELECT {strength('x0', 'prior')} k),
x1 AS (SELECT host, bad + k * prior a, n + k w FROM x0, xk),
known AS (SELECT host, greatest(0.0, a / w - {z} * sqrt(a * (w - a) / (w * w * (w + 1)))) bound FROM x1)
SELECT page_id, host, path, {rule} rule, coalesce({verdict}, CASE WHEN bound >= {threshold} THEN 'block' ELSE 'allow' END) verdict
FROM h JOIN known USING (host)
"""


OP8 = f"""
WITH d AS (SELECT doc_id, {SPLIT.format('text')} w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(w[p:p+49], ' ')) c FROM d, unnest(range(1, len(w) - 48)) t(p)),
f AS (SELECT c, min(doc_id) m FROM win GROUP BY c),
gone AS (SELECT DISTINCT doc_id, p + k q FROM win JOIN f USING (c), range(50) r(k) WHERE m < doc_id),
x AS (SELECT doc_id, u.q, w[u.q] word FROM d, unnest(range(1, len(w) + 1)) u(q)),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.q) t FROM x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.q = gone.q
         GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT n_words, (SELECT count(*) FROM gone WHERE gone.doc_id = d.doc_id)::BIGINT n_removed,
       sha256(coalesce(t, '')) kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
             list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT
           AS "rank", s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY "rank" <= 3
"""

SQL: dict[str, str] = {"op2_ngram_join": OP2, "op4_warc": OP4, "op5_urls": _op5(), "op8_substrings": OP8, "op12_negatives": OP12}
