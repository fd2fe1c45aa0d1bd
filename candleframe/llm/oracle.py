"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from candleframe.llm import quality as q
from candleframe.llm import url_filter as u

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUALITY_FEATURES = f"""
src AS (SELECT row_number() OVER () AS rid, * REPLACE (coalesce(text, '') AS text) FROM {{docs}}),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM src),
pos AS (SELECT rid, unnest(range(1, len(ws) - {q.WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {q.WINDOW}),
win AS (SELECT rid, i, list_slice(ws, i, i + {q.WINDOW - 1}) AS g FROM pos),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least({q.WINDOW}, coalesce(nxt - i, {q.WINDOW}))) AS n FROM
  (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: trim(x, {_WS}) <> '') AS ls FROM src),
feats AS (SELECT src.*, len(ws)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(translate(text, '{q.SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM src JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
base AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM feats),
hosts AS (SELECT coalesce(source, '') AS host, count(*) AS n, sum(base_failed::INT) AS f FROM base GROUP BY 1),
mom AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v, avg(1 / n) AS inv FROM hosts),
prior AS (SELECT m, CASE WHEN v - m * (1 - m) * inv > 0
  THEN greatest({q.PRIOR_MIN}, least({q.PRIOR_MAX}, m * (1 - m) / (v - m * (1 - m) * inv) - 1)) ELSE {q.PRIOR_MAX} END AS k FROM mom),
judged AS (SELECT base.*, NOT base_failed AND (m * k + f) / (k + n) <= {q.MAX_HOST_RATE} AS kept
  FROM base JOIN hosts ON coalesce(source, '') = host, prior)
"""

QUALITY = "WITH" + QUALITY_FEATURES.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


def line_dedup_ctes(docs: str) -> str:
    return f"""
lsrc AS (SELECT row_number() OVER () AS lid, * REPLACE (coalesce(text, '') AS text) FROM {docs}),
ln AS (SELECT lid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nr FROM lsrc),
ky AS (SELECT *, translate(trim(line, {_WS}), '{_UPPER}', '{_LOWER}') AS key FROM ln),
bad AS (SELECT key, max(doc_id) AS holder FROM ky WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
mark AS (SELECT ky.*, holder IS NOT NULL AND doc_id <> holder AS gone FROM ky LEFT JOIN bad USING (key)),
cut AS (SELECT lid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT gone), '') AS kept FROM mark GROUP BY lid)"""


LINE_DEDUP = f"""WITH {line_dedup_ctes('documents')}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM lsrc JOIN cut USING (lid)"""


def _rule_case(column: str) -> str:
    order = sorted(u.RULES, key=lambda r: -len(r[1]))
    arms = []
    for verdict, rule in order:
        host, slash, rest = rule.partition("/")
        arms.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}') "
                    f"THEN '{verdict if column == 'verdict' else rule}'")
    return "CASE " + " ".join(arms) + " END"


def _strength(t: str) -> str:
    spread = "m * (1 - m)"
    return (f"(SELECT CASE WHEN v - {spread} * inv > 0 THEN greatest({u.PRIOR_MIN}, least({u.PRIOR_MAX}, "
            f"{spread} / (v - {spread} * inv) - 1)) ELSE {u.PRIOR_MAX} END FROM "
            f"(SELECT avg(bad / n) AS m, var_pop(bad / n) AS v, avg(1 / n) AS inv FROM {t}))")


URL_FILTER = f"""
WITH parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
marked AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
seen AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM parts
  JOIN marked ON try_cast(regexp_extract(path, '/([0-9]+)(?:[.][A-Za-z]+)?/?$', 1) AS BIGINT) = doc_id WHERE bad IS NOT NULL GROUP BY 1),
lv AS (SELECT *, string_split(host, '.') AS p FROM seen),
sx AS (SELECT p[-1] AS suffix, sum(n) AS n, sum(bad) AS bad FROM lv GROUP BY 1),
dm AS (SELECT array_to_string(p[-2:], '.') AS domain, sum(n) AS n, sum(bad) AS bad FROM lv GROUP BY 1),
k AS (SELECT {_strength('sx')} AS ks, {_strength('dm')} AS kd, {_strength('seen')} AS kh,
  coalesce((SELECT sum(bad) / sum(n) FROM seen), 0.0) AS r0),
h AS (SELECT DISTINCT host, string_split(host, '.') AS p FROM parts),
a AS (SELECT h.host, p, ks, kd, kh, (ks * r0 + coalesce(sx.bad, 0)) / (ks + coalesce(sx.n, 0)) AS rs FROM h JOIN k ON true LEFT JOIN sx ON sx.suffix = p[-1]),
b AS (SELECT a.*, (kd * rs + coalesce(dm.bad, 0)) / (kd + coalesce(dm.n, 0)) AS rd FROM a LEFT JOIN dm ON dm.domain = array_to_string(p[-2:], '.')),
c AS (SELECT b.host, (kh * rd + coalesce(seen.bad, 0)) / (kh + coalesce(seen.n, 0)) AS r, kh + coalesce(seen.n, 0) AS wt FROM b LEFT JOIN seen USING (host)),
d AS (SELECT host, greatest(r - {u.Z} * sqrt(r * (1 - r) / (wt + 1)), 0.0) AS bound FROM c)
SELECT page_id, host, path, {_rule_case('rule')} AS rule,
  coalesce({_rule_case('verdict')}, CASE WHEN bound > {u.MAX_BAD_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts JOIN d USING (host)"""

def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


#: crc32 of a decimal number, bit by bit: each byte, then eight shifts (marked by -1).
_CRC = ("xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''), "
        "lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) ELSE xor(r >> 1, 3988292384 * (r & 1)) END))")


def _tree(name: str, source: str) -> str:
    """All levels of the trees of ``source`` (g, nodes): one row (g, lev, nodes) each."""
    return f"""
{name} AS (SELECT g, 0 AS lev, nodes FROM {source} UNION ALL
  SELECT g, lev + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM {name} WHERE len(nodes) > 1)"""


def _siblings(name: str, rows: str, tree: str) -> str:
    """Left and right siblings of ``rows`` (k, g, p) in each level of ``tree`` but the last."""
    q = "(p // (3 ** lev)::BIGINT)"
    return f"""
{name} AS (SELECT k, lev, array_to_string(nodes[{q} // 3 * 3 + 1:{q}], '') AS l, array_to_string(nodes[{q} + 2:{q} // 3 * 3 + 3], '') AS r
  FROM {rows} JOIN {tree} ON {rows}.g IS NOT DISTINCT FROM {tree}.g WHERE len(nodes) > 1)"""


_OTHER = ", ".join(map(_field, ["doc_id", "source", "lang", "n_chars"]))
MERKLE = f"""
WITH RECURSIVE leaves AS (SELECT row_number() OVER () AS k, doc_id, source AS g,
  sha256(concat({_OTHER}, {_field('text')})) AS leaf,
  CASE WHEN {_CRC.format('doc_id')} % 2 = 0 THEN sha256(concat({_OTHER}, {_field("replace(text, chr(10), '')")})) END AS bad FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
groups AS (SELECT g, list(leaf ORDER BY p) AS nodes FROM placed GROUP BY g),{_tree('low', 'groups')},
subs AS (SELECT g AS k, 0 AS g, nodes[1] AS sub, row_number() OVER (ORDER BY low.g NULLS FIRST) - 1 AS p FROM low WHERE len(nodes) = 1),
roots AS (SELECT 0 AS g, list(sub ORDER BY p) AS nodes FROM subs),{_tree('high', 'roots')},
{_siblings('s1', 'placed', 'low').strip()},
{_siblings('s2', 'subs', 'high').strip()},
path AS (SELECT k, lev, l, r FROM s1 UNION ALL
  SELECT placed.k, 1000 + s2.lev, s2.l, s2.r FROM placed JOIN s2 ON placed.g IS NOT DISTINCT FROM s2.k),
proofs AS (SELECT k, list(l ORDER BY lev) AS ls, list(r ORDER BY lev) AS rs, string_agg(l || r, '' ORDER BY lev) AS joined FROM path GROUP BY k),
folds AS (SELECT placed.k, 0 AS i, coalesce(bad, leaf) AS cur, ls, rs FROM placed LEFT JOIN proofs USING (k) UNION ALL
  SELECT k, i + 1, sha256(ls[i + 1] || cur || rs[i + 1]), ls, rs FROM folds WHERE i < len(ls)),
folded AS (SELECT k, max_by(cur, i) AS cur FROM folds GROUP BY k),
top AS (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1)
SELECT doc_id, leaf, sub AS subroot, root, sha256(coalesce(joined, '')) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM placed JOIN folded USING (k) LEFT JOIN proofs USING (k) JOIN subs ON placed.g IS NOT DISTINCT FROM subs.k, top"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
QUALIFY rank <= 20"""

#: Base32 of a SHA-1: eight times five hexadecimal digits, each as four letters.
_BASE32 = ("array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b: "
           "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr({0}, 5 * g + 1, 5))::BIGINT >> b) & 31)::INT + 1, 1)), '')), '')")
WARC = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT *, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h,
  row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, rid DESC) AS place,
  first(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, rid DESC) AS largest FROM p)
SELECT page_id, payload_bytes, {_BASE32.format('h')} AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN largest END AS refers_to FROM k"""

ORACLE = {
    "op3_top_k": TOP_K,
    "op4_quality_rules": QUALITY,
    "op6_url_filter": URL_FILTER,
    "op7_line_dedup": LINE_DEDUP,
    "op11_warc": WARC,
    "op12_merkle_manifest": MERKLE,
}
