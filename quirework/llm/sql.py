"""DuckDB SQL that gives the rows of the corpus queries, where SQL can say it."""

#: Water-filling by the level at which the targets fill up; see `mixing.water_fill`.
OP10 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents),
weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS ratio,
         (sum(source_size) OVER ()
          - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3.0::DOUBLE / weight,
              source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         least(cap, (SELECT max(level) FROM levels WHERE level <= ratio) * weight) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, targets.source_size, target, round(target)::BIGINT AS words,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY hash, doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END AS rest
  FROM placed),
cuts AS (
  SELECT *, least(greatest(rest - before, 0), size) AS extra FROM parts)
SELECT doc_id, size, source_size, target,
       (whole * size + extra)::BIGINT AS taken,
       (whole + CASE WHEN extra = size AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS copies
FROM cuts
"""

#: CRC-32 of a list of byte values `b`, by a table that its rule builds.
CRC_TABLE = """
bits(b, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS crc FROM bits WHERE k = 8)"""
CRC_OF = """xor(list_reduce(list_transform(range(len(hexed) // 2),
    lambda i: ('0x' || substr(hexed, 2 * i + 1, 2))::BIGINT),
    lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1]), 4294967295), 4294967295)"""

#: Both schedules as recursions: over the groups of all parts at once, then over the bins.
OP11 = f"""
WITH RECURSIVE {CRC_TABLE},
sized AS (
  SELECT doc_id, text, md5(coalesce(text, '')) AS digest, (coalesce(strlen(text), 0) + 8)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'none') || ':' || md5(coalesce(text, ''))) AS tag,
         hex(encode(coalesce(text, ''))) AS hexed
  FROM documents),
groups AS (
  SELECT digest, sum(size)::BIGINT AS bytes, substr(digest, 1, 3) AS part,
         row_number() OVER (PARTITION BY substr(digest, 1, 3) ORDER BY sum(size) DESC, digest) AS pos
  FROM sized GROUP BY digest),
binned(part, pos, digest, bytes, bin, loads) AS (
  SELECT part, pos, digest, bytes, 1::BIGINT, list_transform(range(24), lambda i: CASE WHEN i = 0 THEN bytes ELSE 0 END)
  FROM groups WHERE pos = 1
  UNION ALL
  SELECT g.part, g.pos, g.digest, g.bytes, list_position(loads, list_min(loads))::BIGINT,
         list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + g.bytes ELSE x END)
  FROM binned b JOIN groups g ON g.part = b.part AND g.pos = b.pos + 1),
bins AS (
  SELECT part, bin, sum(bytes)::BIGINT AS load, row_number() OVER (ORDER BY sum(bytes) DESC, part, bin) AS pos
  FROM binned GROUP BY part, bin),
dealt(pos, part, bin, shard, loads) AS (
  SELECT pos, part, bin, 1::BIGINT, list_transform(range(24), lambda i: CASE WHEN i = 0 THEN load ELSE 0 END)
  FROM bins WHERE pos = 1
  UNION ALL
  SELECT n.pos, n.part, n.bin, list_position(loads, list_min(loads))::BIGINT,
         list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + n.load ELSE x END)
  FROM dealt d JOIN bins n ON n.pos = d.pos + 1),
placed AS (
  SELECT sized.*, (dealt.shard - 1)::INTEGER AS shard
  FROM sized JOIN binned USING (digest) JOIN dealt ON dealt.part = binned.part AND dealt.bin = binned.bin)
SELECT doc_id, size, coalesce({CRC_OF}, 0)::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY tag) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed, crc
"""


def _round(entries: str, assigned: str, after: str) -> str:
    """One assignment of all parts, and the entries after it."""
    return f"""
{assigned} AS (
  SELECT vec_id, label, p, x, arg_min(e, d * 64 + e) AS e, min(d) AS d
  FROM (SELECT parts.*, e, list_sum(list_transform(range(1, len(x) + 1),
               lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
        FROM parts JOIN {entries} USING (p))
  GROUP BY vec_id, label, p, x),
{after} AS (
  SELECT p, e, coalesce(m, c) AS c FROM {entries} LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS m FROM (
      SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n
      FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM {assigned}) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e))"""


#: All distances are compared; each round is a table of its own.
OP12 = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x
  FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
c0 AS (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_round("c0", "a1", "c1")},
{_round("c1", "a2", "c2")},
{_round("c2", "a3", "unused")},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a3 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, i))
        FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM c2)) AS codebooks_sha256
FROM coded
"""

#: The CRC of each different word once.
OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
  UNION ALL
  SELECT 'b', NULL, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (
  SELECT kind, id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM lowered),
known AS (
  SELECT word, {CRC_OF} % 10000 AS bucket
  FROM (SELECT DISTINCT word, hex(encode(word)) AS hexed FROM words), crc),
met AS (SELECT kind, id, bucket FROM words JOIN known USING (word)),
counts AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM met GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
         / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts),
sums AS (
  SELECT id AS doc_id, count(*) AS n, sum(gain)::BIGINT AS total
  FROM met JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
weighed AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN sums USING (doc_id)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

#: SHA-1 in base 32: each five hex digits are four signs.
OP2 = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hexed,
         min(page_id) OVER (PARTITION BY body) AS first
  FROM bodies)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hexed, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests
"""

#: All pairs are compared; components are what links reach.
OP4 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
"""

#: Every window as text, and the words that lie in one that a smaller document has.
OP9 = """
WITH listed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
words AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM listed),
windows AS (
  SELECT *, CASE WHEN pos <= n - 49 THEN md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS hash
  FROM words),
judged AS (
  SELECT *, hash IS NOT NULL AND min(doc_id) OVER (PARTITION BY hash) < doc_id AS repeated FROM windows),
covered AS (
  SELECT doc_id, word, pos, max(repeated::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS text
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
