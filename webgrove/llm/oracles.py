"""SQL for the training-data queries that SQL can express (DuckDB's dialect)."""

from __future__ import annotations

from webgrove.llm.quality import BUCKETS, HELD_OUT_SHARE, MARGIN, MAX_REPEAT_PERCENT, MIN_WORDS, SMOOTHING, THRESHOLD
from webgrove.llm.sharding import MIX_A, MIX_B, round_keys

_LOW_31 = (1 << 31) - 1
#: The checksum's table for one byte each, and the checksum of a text as a fold over its bytes.
_CRC_TABLE = "crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"


def _crc32(text: str) -> str:
    hexed = f"hex(encode({text}))"
    byte = f"('0x' || substr({hexed}, (2 * i + 1)::BIGINT, 2))::BIGINT"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({text}))::BIGINT), lambda i: {byte})), "
            "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])))")


def _mixed(right: str, key: str) -> str:
    y = f"(xor({right}, {key}) * {MIX_A})"
    y = f"((xor({y}, {y} >> 15) & {_LOW_31}) * {MIX_B})"
    return f"(xor({y}, {y} >> 13) & n.mask)"


def _feistel(x: str) -> str:
    """One pass over all rounds, from the first to the last."""
    keys = ", ".join(map(str, round_keys(20_240_601)))
    right = "(s & n.mask)"
    return f"list_reduce(list_prepend(({x})::BIGINT, [{keys}]), lambda s, k: ({right} << n.half) | xor(s >> n.half, {_mixed(right, 'k')}))"


def _leaf(n_chars: str) -> str:
    """A document's digest with the given number of characters."""
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR END" for f in fields) + ")"


#: The words of a text in lower case.
_LETTERS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept FROM pages),
r AS (SELECT *, strlen(h) >= 1000 AND page_id <> kept AS again FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to FROM r
""",
    # a recursive step a walk: rows outside the range go through the network again
    "op10_sharding": rf"""
WITH RECURSIVE {_CRC_TABLE},
raw AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
light AS (SELECT doc_id, octet_length(encode(text))::BIGINT + 1 AS size, {_crc32('text')} AS text_crc32 FROM raw, crc),
n AS (SELECT total, half, (1::BIGINT << half) - 1 AS mask FROM (
    SELECT total, greatest(1, (length(bin(greatest(1, total - 1))) + 1) // 2)::BIGINT AS half FROM (SELECT count(*)::BIGINT AS total FROM documents))),
walk AS (
    SELECT row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS x, doc_id, size, text_crc32, false AS done FROM light
    UNION ALL
    SELECT y, doc_id, size, text_crc32, y < n.total FROM (SELECT {_feistel('x')} AS y, doc_id, size, text_crc32, done FROM walk, n) w, n WHERE NOT done)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 16)::INTEGER AS shard, x // 16 AS slot, NULL::INTEGER AS grown_shard FROM walk WHERE done
""",
    "op11_importance_resampling": rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS id, doc_id, {_LETTERS} AS w FROM documents),
dw AS (SELECT id, unnest(w) AS g FROM d),
bw AS (SELECT unnest({_LETTERS}) AS g FROM benchmark),
bucket AS (SELECT g, {_crc32('g')} % 10000 AS b FROM (SELECT g FROM dw UNION SELECT g FROM bw), crc),
s AS (SELECT b, count(*) AS s FROM dw JOIN bucket USING (g) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN bucket USING (g) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS v FROM s LEFT JOIN t USING (b)),
mean AS (SELECT id, floor(sum(v)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN bucket USING (g) JOIN gain ON gain.b = bucket.b GROUP BY id),
scored AS (SELECT id, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM d LEFT JOIN mean USING (id)),
fit AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN fit USING (id)
""",
    # both trees level by level, then every leaf's walk up its own and the last one
    "op12_merkle_manifest": rf"""
WITH RECURSIVE {_CRC_TABLE},
rows AS (SELECT row_number() OVER () AS id, * FROM documents),
seals AS (SELECT id, doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('n_chars + 1')} ELSE {_leaf('n_chars')} END AS claimed FROM rows, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM seals),
lower_tree AS (SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM leaves
    UNION ALL SELECT lang, lvl + 1, idx // 2, (n + 1) // 2, sha256(h || coalesce(after, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY idx) AS after FROM lower_tree WHERE n > 1) WHERE idx % 2 = 0),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lower_tree WHERE n = 1),
upper_tree AS (SELECT 0 AS lvl, idx, n, h FROM subroots
    UNION ALL SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(h || coalesce(after, ''))
    FROM (SELECT *, lead(h) OVER (ORDER BY idx) AS after FROM upper_tree WHERE n > 1) WHERE idx % 2 = 0),
climb AS (SELECT id, lang, 0 AS lvl, idx, n, claimed AS f, '' AS p FROM leaves
    UNION ALL SELECT c.id, c.lang, c.lvl + 1, c.idx // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.idx % 2 = 0 THEN c.f || coalesce(s.h, '') ELSE coalesce(s.h, '') || c.f END), c.p || coalesce(s.h, '')
    FROM climb c LEFT JOIN lower_tree s ON s.lang IS NOT DISTINCT FROM c.lang AND s.lvl = c.lvl AND s.idx = xor(c.idx, 1) WHERE c.n > 1),
crown AS (SELECT c.id, 0 AS lvl, s.idx, s.n, c.f, c.p FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
    UNION ALL SELECT c.id, c.lvl + 1, c.idx // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.idx % 2 = 0 THEN c.f || coalesce(s.h, '') ELSE coalesce(s.h, '') || c.f END), c.p || coalesce(s.h, '')
    FROM crown c LEFT JOIN upper_tree s ON s.lvl = c.lvl AND s.idx = xor(c.idx, 1) WHERE c.n > 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(c.p) AS proof_sha256, c.f AS folded_root, c.f = r.h AS verified
FROM crown c JOIN leaves l USING (id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, (SELECT h FROM upper_tree WHERE n = 1) r WHERE c.n = 1
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END)) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""",
    "op4_quality_rules": rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM d),
bucket AS (SELECT g, {_crc32('g')} & {BUCKETS - 1} AS b FROM (SELECT DISTINCT g FROM grams), crc),
f AS (SELECT doc_id, b, count(*) AS c FROM grams JOIN bucket USING (g) GROUP BY doc_id, b),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 0),
raw AS (SELECT b, sum(c) AS r FROM f GROUP BY b),
target AS (SELECT b, sum(c) AS t FROM f SEMI JOIN trusted USING (doc_id) GROUP BY b),
ratio AS (SELECT raw.b, ln((coalesce(t, 0) + {SMOOTHING}) / (r * (SELECT sum(t) FROM target) / (SELECT sum(r) FROM raw) + {SMOOTHING})) AS v
    FROM raw LEFT JOIN target ON raw.b = target.b),
score AS (SELECT doc_id, sum(c * v) / sum(c) AS score FROM f JOIN ratio ON f.b = ratio.b GROUP BY doc_id),
held AS (SELECT doc_id, sum(c * ln((t - c + {SMOOTHING}) / (r * (SELECT sum(t) FROM target) / (SELECT sum(r) FROM raw) + {SMOOTHING}))) / sum(c) AS score
    FROM f SEMI JOIN trusted USING (doc_id) JOIN raw USING (b) JOIN target USING (b) GROUP BY doc_id),
bars AS (SELECT lang, least({THRESHOLD}, quantile_cont(score, {HELD_OUT_SHARE}) - {MARGIN}) AS bar FROM held JOIN documents USING (doc_id) GROUP BY lang),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS g FROM d WHERE len(w) >= 3),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) o(k) GROUP BY doc_id),
s AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s)
SELECT j.*, NOT base_failed AND coalesce(score, 0) >= coalesce(bar, (SELECT min(bar) FROM bars), {THRESHOLD}) AS kept
FROM j LEFT JOIN score USING (doc_id) JOIN documents USING (doc_id) LEFT JOIN bars ON bars.lang IS NOT DISTINCT FROM documents.lang
""",
    "op6_decontamination": r"""
WITH lowered AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT id AS item_id, w, least(13, len(w)) AS k FROM lowered WHERE kind = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM items),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT id AS doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
    FROM lowered, sizes WHERE kind = 'd' AND len(w) >= k),
hits AS (SELECT doc_id, i, places.k, item_id FROM places JOIN windows USING (g, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM lowered d LEFT JOIN hit ON hit.doc_id = d.id LEFT JOIN own ON own.doc_id = d.id WHERE d.kind = 'd'
""",
}
