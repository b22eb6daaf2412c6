"""DuckDB SQL of the operators that SQL can express in full.

The others have parts that are not SQL here (a trained model, XXH64, a
tokenizer, seeded choices, method labels); tests/llm holds them against plain
Python instead.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_LEAF = r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,4}[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
pats AS (SELECT DISTINCT item_id, array_to_string(w[a:a + 9], ' ') AS p, least(10, len(w)) AS n
         FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(a) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM pats),
occ AS (SELECT rid, a AS pos, n, array_to_string(w[a:a + n - 1], ' ') AS p
        FROM (SELECT * FROM docs, lens) d, unnest(range(1, len(w) - n + 2)) t(a)),
hit AS (SELECT o.rid, o.pos, o.n, pats.item_id FROM occ o JOIN pats ON o.p = pats.p AND o.n = pats.n),
cov AS (SELECT rid, count(DISTINCT k) AS n_hit
        FROM (SELECT DISTINCT rid, pos, n FROM hit) h, unnest(range(pos, pos + n)) u(k) GROUP BY rid),
its AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM hit
        WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)"""

FINGERPRINTS = f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS t,
                  coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                           first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS nx
           FROM documents),
e AS (SELECT doc_id, t, nx, length(t) AS n, length(t) // 2 AS h FROM o),
x AS (SELECT doc_id, n, t, nx, substring(t, 1, n - h) || substring(nx, 1, h) AS ed FROM e),
each AS (SELECT doc_id, kind, txt, string_split(txt, chr(10) || chr(10)) AS secs
         FROM (SELECT doc_id, 'a' AS kind, t AS txt FROM x UNION ALL SELECT doc_id, 'b', ed FROM x
               UNION ALL SELECT doc_id, 'c', nx FROM x) k),
f AS (SELECT doc_id, kind, secs,
             sha256(array_to_string(list_transform(secs, lambda s: sha256(array_to_string(
                 list_transform(string_split(s, chr(10)), lambda p: sha256(p)), ''))), '')) AS root,
             list_distinct(flatten(list_transform(string_split(txt, chr(10)),
                 lambda p: regexp_extract_all(p, '{_LEAF}')))) AS leaves
      FROM each),
j AS (SELECT x.doc_id, x.n, x.ed, a.root AS ra, a.leaves AS la, a.secs AS sa, b.root AS rb,
             b.leaves AS lb, b.secs AS sb, c.root AS rc, c.leaves AS lc
      FROM x JOIN f a ON a.doc_id = x.doc_id AND a.kind = 'a'
             JOIN f b ON b.doc_id = x.doc_id AND b.kind = 'b'
             JOIN f c ON c.doc_id = x.doc_id AND c.kind = 'c'),
s AS (SELECT *, list_position(list_transform(range(1, greatest(len(sa), len(sb)) + 1),
                 lambda i: (sa[i] IS NOT DISTINCT FROM sb[i])), false) AS sec FROM j),
q AS (SELECT *, CASE WHEN sec > 0 AND sec <= len(sa) THEN string_split(sa[sec], chr(10)) ELSE [] END AS pa,
             CASE WHEN sec > 0 AND sec <= len(sb) THEN string_split(sb[sec], chr(10)) ELSE [] END AS pb FROM s)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256, ra AS fingerprint,
       rb AS edited_fingerprint,
       CASE WHEN ra = rb THEN 1.0::DOUBLE WHEN len(la) + len(lb) = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * len(list_intersect(la, lb)) / (len(la) + len(lb)) END AS near_edited,
       CASE WHEN ra = rc THEN 1.0::DOUBLE WHEN len(la) + len(lc) = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * len(list_intersect(la, lc)) / (len(la) + len(lc)) END AS near_next,
       CASE WHEN sec > 0 THEN CAST(sec - 1 AS VARCHAR) || ':' || CAST(list_position(list_transform(
            range(1, greatest(len(pa), len(pb), 1) + 1),
            lambda i: (pa[i] IS NOT DISTINCT FROM pb[i])), false) - 1 AS VARCHAR) END AS first_edit
FROM q"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, strlen(h) AS n, min(page_id) OVER (PARTITION BY h) AS first FROM p),
r AS (SELECT *, n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM r"""

# CRC-32 of a decimal number, bit by bit.
_CRC_BIT = "CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END"
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv AS VARCHAR), ''), "
        "lambda ch: CAST(ord(ch) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), "
        f"[CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda y, z: {_CRC_BIT})), 4294967295)")

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id AS conv, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST,
                          sha256(CAST(strlen(r) AS VARCHAR) || ':' || r || x)) AS s FROM t GROUP BY conv),
h AS (SELECT conv, s, {_CRC} % 6 AS h FROM own),
seq AS (SELECT h.conv, list_concat(coalesce(b.s[1:h.h], []), h.s[h.h + 1:len(h.s)]) AS s
        FROM h LEFT JOIN own b ON b.conv = h.conv - h.conv % 100),
pre AS (SELECT conv, len(s) AS l, d, s[1:d] AS k FROM seq, unnest(range(0, len(s) + 1)) u(d)),
node AS (SELECT k, d, count(*) AS n, min(conv) AS first,
                list_sort(list(conv) FILTER (WHERE l = d)) AS ends FROM pre GROUP BY k, d),
kid AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT node.*, coalesce(kids, 0) AS kids,
                 CASE WHEN node.d = 0 THEN 0 ELSE (n - 1) * length(node.k[node.d].x) END AS saved
          FROM node LEFT JOIN kid ON kid.k = node.k AND kid.d = node.d),
up AS (SELECT w.k[1:a] AS k, a AS d, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
       FROM whole w, unnest(range(0, w.d + 1)) u(a) GROUP BY 1, 2)
SELECT w.first AS conv_id, CAST(w.d AS BIGINT) AS depth, p.first AS parent_conv_id,
       CAST(w.n AS BIGINT) AS n_convs, CAST(w.kids AS BIGINT) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves,
       CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(array_to_string(w.ends, ','), '')) AS ends_sha256
FROM whole w JOIN up ON up.k = w.k AND up.d = w.d
LEFT JOIN node p ON w.d > 0 AND p.d = w.d - 1 AND p.k = w.k[1:w.d - 1]"""

HARD_NEGATIVES = """
WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, r.id, a.label = r.label AS same,
             CAST(coalesce(list_sum(list_transform(range(1, least(len(a.z), len(r.z)) + 1),
                  lambda i: a.z[i] * r.z[i])), 0) AS BIGINT) AS score
      FROM r a JOIN r ON r.id <> a.id WHERE a.id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS k
                     FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id AS negative, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS k
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
           AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(k AS INTEGER) AS rank, negative AS negative_id,
       positive_score, negative_score
FROM n WHERE k <= 3"""

ORACLE: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op3_fingerprints": FINGERPRINTS,
    "op11_warc": WARC,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_hard_negatives": HARD_NEGATIVES,
}
