"""DuckDB SQL for the operators that SQL can express, over the same tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS c FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least.c AS component_id, d.doc_id = least.c AS kept
FROM documents d JOIN least ON least.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.line, k.pos, c.key IS NOT NULL AND k.doc_id <> c.largest AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), m AS (
  SELECT html, max(page_id) AS largest FROM p GROUP BY html
)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN p.n >= 1000 AND p.page_id <> m.largest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.n >= 1000 AND p.page_id <> m.largest THEN m.largest END AS refers_to
FROM p JOIN m ON p.html = m.html
"""

# crc32 of a blob's hex text, byte by byte with the table of its polynomial.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(n)))"""


def _crc(text: str) -> str:
    codes = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295::BIGINT)"


RESAMPLING = f"""
WITH {_CRC_TABLE}, words AS (
  SELECT 0 AS side, doc_id AS id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), runs AS (
  SELECT side, id, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM words
), features AS (
  SELECT side, id, f, count(*) AS n FROM runs GROUP BY side, id, f
), buckets AS (
  SELECT f, {_crc("f")} % 10000 AS b FROM (SELECT DISTINCT f FROM features), crc_table
), counts AS (
  SELECT b, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM features JOIN buckets USING (f) GROUP BY b
), totals AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM counts
), gains AS (
  SELECT b, floor(1000 * ln(((t::DOUBLE + 1) * (big_s + 10000)) / ((s::DOUBLE + 1) * (big_t + 10000))))::BIGINT AS gain FROM counts, totals
), weights AS (
  SELECT id, sum(n) AS n, sum(n * gain) AS weight FROM features JOIN buckets USING (f) JOIN gains USING (b) WHERE side = 0 GROUP BY id
), scored AS (
  SELECT words.id, len(w) AS words, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || words.id::VARCHAR), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights ON words.id = weights.id WHERE side = 0
), drawn AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, id) AS k, count(*) OVER () AS able FROM scored WHERE words >= 20
)
SELECT scored.id AS doc_id, n::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN k <= (5 * able) // 100 THEN k END AS rank
FROM scored LEFT JOIN drawn ON scored.id = drawn.id
"""


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"


def _tree(name: str, base: str) -> str:
    """Recursion over the levels of all groups' trees, then each node's siblings."""
    run = "PARTITION BY g, level, pos // 16 ORDER BY pos"
    return f"""{name}(g, level, pos, n, digest) AS (
  {base}
  UNION ALL SELECT g, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY g, level, pos // 16, n
), {name}_siblings AS (
  SELECT g, level, pos, coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND 15 FOLLOWING), '') AS r FROM {name} WHERE n > 1
)"""


_FOLD = """{to}(doc_id, level, g, pos, digest, proof) AS (
  {base}
  UNION ALL SELECT f.doc_id, f.level + 1, f.g, f.pos // 16, sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
  FROM {to} f JOIN {tree}_siblings s ON s.g = f.g AND s.level = f.level AND s.pos = f.pos
), {to}_top AS (
  SELECT doc_id, g, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM {to} GROUP BY doc_id, g
)"""

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE}, leaves AS (
  SELECT doc_id, coalesce('=' || source, '-') AS g, {_LEAF.format(_field("text"))} AS leaf,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 5 = 0 THEN {_LEAF.format(_field(_LOWER.format("text")))} ELSE {_LEAF.format(_field("text"))} END AS found
  FROM documents, crc_table
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), {_tree("lower_tree", "SELECT g, 0, pos, n, leaf FROM placed")}, subroots AS (
  SELECT g, digest, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM lower_tree WHERE n = 1
), {_tree("upper_tree", "SELECT '', 0, pos, n, digest FROM subroots")},
{_FOLD.format(to="fold", tree="lower_tree", base="SELECT doc_id, 0, g, pos, found, '' FROM placed")},
{_FOLD.format(to="fold_up", tree="upper_tree", base="SELECT doc_id, 0, '', subroots.pos, fold_top.digest, fold_top.proof FROM fold_top JOIN subroots ON fold_top.g = subroots.g")}
SELECT placed.doc_id, placed.leaf, subroots.digest AS subroot, whole.digest AS root, sha256(fold_up_top.proof) AS proof_sha256,
  fold_up_top.digest AS folded_root, fold_up_top.digest = whole.digest AS verified
FROM placed JOIN subroots ON placed.g = subroots.g JOIN fold_up_top ON fold_up_top.doc_id = placed.doc_id, (SELECT digest FROM upper_tree WHERE n = 1) whole
"""

REPEATS = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), chunks AS (
  SELECT doc_id, 500 * c AS a, substr(h, 1000 * c + 1, 1398) AS h, least(500, n - 199 - 500 * c) AS many
  FROM (SELECT *, unnest(range(0, (n + 300) // 500)) AS c FROM texts)
), strings AS (
  SELECT doc_id, a + j AS i, md5_number(substr(h, 2 * j + 1, 400)) AS k FROM (SELECT doc_id, a, h, unnest(range(0, many)) AS j FROM chunks)
), found AS (
  SELECT doc_id, i FROM strings WHERE k IN (SELECT k FROM strings GROUP BY k HAVING count(*) > 1)
), islands AS (
  SELECT doc_id, i, sum(starts) OVER (PARTITION BY doc_id ORDER BY i) AS island
  FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS starts FROM found)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM islands GROUP BY doc_id, island
), pieces AS (
  SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), n) AS b FROM spans JOIN texts USING (doc_id)
  UNION ALL SELECT texts.doc_id, 0, coalesce(min(a), n) FROM texts LEFT JOIN spans ON texts.doc_id = spans.doc_id GROUP BY texts.doc_id, n
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT texts.doc_id, n::BIGINT AS n_bytes, coalesce((SELECT sum(b - a) FROM spans WHERE spans.doc_id = texts.doc_id), 0)::BIGINT AS n_removed,
  (SELECT count(*) FROM spans WHERE spans.doc_id = texts.doc_id) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM texts JOIN kept ON texts.doc_id = kept.doc_id
"""

ORACLE = {
    "op5_line_dedup": LINES,
    "op7_content_addressed_warc": WARC,
    "op10_superminhash_near_dedup": NEAR,
    "op11_batch_resampling": RESAMPLING,
    "op12_lag_lead_merkle": MERKLE,
    "op13_prefix_free_repeats": REPEATS,
}
