"""DuckDB SQL for the registered queries that SQL can express.

The others are tested against plain Python versions: language identification, language model,
HTML extraction, license scan and packing.
"""

from __future__ import annotations

_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_SIGN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEXT = "coalesce(text, '')"
_LOWER = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_CONTAMINATION = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SIGN_WORD}') AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '{_SIGN_WORD}') AS w FROM benchmark),
shapes AS (SELECT item_id, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM shapes, unnest(range(1, len(w) - n + 2)) AS t(i)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM doc, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (SELECT doc_id, i, places.n, item_id FROM places JOIN windows ON places.words = windows.words AND places.n = windows.n),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(pos) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

_NEAR = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) > 1 THEN w[i] || ' ' || w[i + 1] ELSE w[1] END AS s
  FROM doc, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reached.doc_id, steps.b FROM reached JOIN steps ON steps.a = reached.other
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""

_QUALITY = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, {_TEXT} AS text, md5({_TEXT}) AS th, regexp_extract_all({_TEXT}, '{_SPACE_WORD}') AS w,
    list_filter(string_split({_TEXT}, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines
  FROM documents
),
threes AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
  FROM doc, unnest(range(1, len(w) - 1)) AS t(i)
),
repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM threes, unnest(range(i, i + 3)) AS t(pos) WHERE times > 1 GROUP BY doc_id
),
lines AS (
  SELECT doc_id, host, th, i, trim(string_split(lower(regexp_replace(text, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))[i], ' ') AS line
  FROM doc, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)
),
keyed AS (
  SELECT doc_id, host, th, i, ('0x' || substr(md5(line), 1, 15))::BIGINT AS key,
    len(line) - len(replace(line, ' ', '')) + 1 AS n FROM lines WHERE line <> ''
),
own AS (SELECT doc_id, host, list_sort(list_distinct(list(key))) AS keys FROM keyed GROUP BY doc_id, host),
seen AS (
  SELECT host, key, CASE WHEN key = keys[1] THEN keys[2] ELSE keys[1] END AS other
  FROM (SELECT host, keys, unnest(keys) AS key FROM own)
),
contexts AS (SELECT host, key, other, count(*) AS n FROM seen GROUP BY ALL),
counts AS (SELECT host, key, sum(n) AS n_docs, count(*) AS n_contexts FROM contexts GROUP BY host, key),
hosts AS (SELECT host, count(*) AS host_docs FROM doc GROUP BY host),
above AS (
  SELECT host, key FROM keyed GROUP BY host, key HAVING count(DISTINCT th) > 30
  UNION
  SELECT host, key FROM counts JOIN hosts USING (host)
  WHERE n_contexts > 10 AND n_contexts * 2 >= n_docs AND n_contexts > host_docs * 0.01
),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n FROM keyed JOIN above USING (host, key) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM doc LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND NOT (n_words - n_removed_words < 50 AND 2 * n_removed_words >= n_words) AS kept FROM judged"""

_SUBSTRINGS = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_TEXT}, '{_SPACE_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS key FROM doc, unnest(range(1, len(w) - 33)) AS t(i)),
twice AS (SELECT key FROM windows GROUP BY key HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, pos FROM windows SEMI JOIN twice USING (key), unnest(range(i, i + 35)) AS t(pos)),
words AS (SELECT doc_id, i AS pos, w[i] AS word FROM doc, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""

_LINES = rf"""
WITH lines AS (
  SELECT doc_id, i, string_split({_TEXT}, chr(10))[i] AS line
  FROM documents, unnest(range(1, len(string_split({_TEXT}, chr(10))) + 1)) AS t(i)
),
keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
),
counts AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (SELECT keyed.*, last IS NOT NULL AND doc_id < last AS dropped FROM keyed LEFT JOIN counts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

_SHARDS = rf"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
),
doc AS (SELECT doc_id, regexp_extract_all(hex(encode({_TEXT})), '..') AS bytes FROM documents),
sized AS (
  SELECT doc_id, (len(bytes) + 1)::BIGINT AS size, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(bytes, lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1])))::BIGINT AS text_crc32
  FROM doc, steps
),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM sized
),
cut AS (SELECT *, (8 * (2 * upto - size) // (2 * total))::INT AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM cut"""


def _rounds(count: int) -> str:
    """``count`` rounds of assignment and means, as steps on ``part`` (rows, part, ints) and a codebook."""
    steps = []
    for k in range(count):
        steps.append(rf"""
near_{k} AS ({_nearest(k)}),
sums_{k} AS (
  SELECT part, entry, j, sum(ints[j])::HUGEINT AS total, count(*) AS n FROM near_{k}, unnest(range(1, len(ints) + 1)) AS t(j) GROUP BY ALL
),
means_{k} AS (
  SELECT part, entry, list(CASE WHEN total < 0 THEN -((-total + n - 1) // n) ELSE total // n END ORDER BY j) AS c FROM sums_{k} GROUP BY ALL
),
book_{k + 1} AS (SELECT part, entry, coalesce(means_{k}.c, book_{k}.c) AS c FROM book_{k} LEFT JOIN means_{k} USING (part, entry)),""")
    return "".join(steps)


def _nearest(k: int) -> str:
    distance = "list_sum(list_transform(list_zip(ints, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""SELECT r, part, any_value(ints) AS ints, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT r, part, ints, entry, {distance}::BIGINT AS d FROM part JOIN book_{k} USING (part)) GROUP BY r, part"""


_CODES = rf"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
part AS (
  SELECT r, p AS part, ints[p * len(ints) // 8 + 1:(p + 1) * len(ints) // 8] AS ints FROM kept, unnest(range(8)) AS t(p)
),
book_0 AS (SELECT part, r - 1 AS entry, ints AS c FROM part WHERE r <= 16),{_rounds(6)}
last AS ({_nearest(6)}),
codes AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book_6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest"""

_MIDDLE = rf"""
WITH doc AS (SELECT doc_id, {_TEXT} AS t, length({_TEXT})::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, n, {", ".join(f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))} FROM doc
),
formed AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
    ELSE '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM formed"""

EXPECTED: dict[str, str] = {
    "op1_decontamination": _CONTAMINATION,
    "op3_minhash_near_dedup": _NEAR,
    "op5_quality_rules": _QUALITY,
    "op7_substring_dedup": _SUBSTRINGS,
    "op8_line_dedup": _LINES,
    "op11_sharding": _SHARDS,
    "op12_vector_codes": _CODES,
    "op13_fill_in_middle": _MIDDLE,
}
