"""DuckDB counterparts of the queries that SQL can express, each by a plainer way.

Without one: toxicity, language ID (trained models), SimHash (XXH64), secret and personal-data
spans (trained models beside the patterns) and decontamination (edit distance to a substring).
"""

from __future__ import annotations

from tallystick.llm import mixing, quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest
  FROM payloads
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS latest FROM coded
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM ranked
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.r, b.r AS s FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93
), reached AS (
  SELECT r, r AS s FROM v UNION SELECT reached.r, linked.s FROM reached JOIN linked ON reached.s = linked.r
), classes AS (
  SELECT reached.r, min(v.vec_id) AS component_id FROM reached JOIN v ON v.r = reached.s GROUP BY reached.r
), counted AS (
  SELECT r, count(*) AS n FROM linked GROUP BY r
)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN classes USING (r) LEFT JOIN counted USING (r)
"""

SUBSTRINGS = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM texts
), windows AS (
  SELECT r, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS path FROM places
), counted AS (
  SELECT r, i, word, CASE WHEN path IS NOT NULL AND count(*) OVER (PARTITION BY path) > 1 THEN 1 ELSE 0 END AS repeated FROM windows
), covered AS (
  SELECT r, i, word, max(repeated) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted
), kept AS (
  SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM covered GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


def _mixing() -> str:
    """Every quotient is listed and ranked; a document's pieces are cut block by block."""
    b, seed = mixing.BLOCK_WORDS, mixing.SEED
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), levelled AS (
  SELECT *, ({mixing.SHARE} * sum(source_size) OVER ()
    - coalesce(sum({mixing.CAP} * source_size) OVER (ORDER BY {mixing.CAP} * source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY {mixing.CAP} * source_size / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, no, source_size, least({mixing.CAP} * source_size, coalesce(
    max(CASE WHEN {mixing.CAP} * source_size > level * weight THEN level END) OVER () * weight, {mixing.CAP} * source_size)) AS target,
    round({mixing.SHARE} * sum(source_size) OVER () / {b}) AS seats, greatest(ceil(source_size / {mixing.SHARD_WORDS}), 1)::BIGINT AS shards
  FROM levelled
), source_seats AS (
  SELECT no, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, no) AS place, seats
  FROM (SELECT *, unnest(range(0, CAST({mixing.CAP} * source_size / {b} AS BIGINT) + 3)) AS k FROM targets) WHERE target > 0
), source_quotas AS (
  SELECT no, count(*) AS source_quota FROM source_seats WHERE place <= seats GROUP BY no
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.no, t.source_size, t.target, coalesce(q.source_quota, 0) AS source_quota,
    md5(concat_ws('|', '{seed}', coalesce(s.doc_id::VARCHAR, '-'), s.size::VARCHAR)) AS o, t.shards
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN source_quotas q USING (no)
), dealt AS (
  SELECT *, CAST('0x' || substr(o, 1, 8) AS BIGINT) % shards AS shard FROM placed
), shard_sizes AS (
  SELECT no, shard, sum(size)::BIGINT AS shard_size, any_value(source_quota) AS source_quota FROM dealt GROUP BY ALL
), shard_seats AS (
  SELECT no, shard, source_quota, row_number() OVER (PARTITION BY no ORDER BY shard_size / (2 * k + 1)::DOUBLE DESC, shard) AS place
  FROM (SELECT *, unnest(range(0, CAST({mixing.CAP} * shard_size / {b} AS BIGINT) + 3)) AS k FROM shard_sizes) WHERE shard_size > 0
), shard_quotas AS (
  SELECT no, shard, count(*) AS quota FROM shard_seats WHERE place <= source_quota GROUP BY ALL
), quotas AS (
  SELECT no, shard, greatest(ceil(shard_size / {b}), 1)::BIGINT AS blocks,
    least(coalesce(quota, 0), {mixing.CAP} * greatest(ceil(shard_size / {b}), 1))::BIGINT AS quota
  FROM shard_sizes LEFT JOIN shard_quotas USING (no, shard)
), laid AS (
  SELECT *, row_number() OVER w AS place, coalesce(sum(size) OVER w, 0)::BIGINT AS stop, coalesce(sum(size) OVER w, 0)::BIGINT - size AS start
  FROM dealt WINDOW w AS (PARTITION BY no, shard ORDER BY o, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), draws AS (
  SELECT no, shard, block, row_number() OVER (PARTITION BY no, shard ORDER BY md5(concat_ws('|', '{seed}', no::VARCHAR, shard::VARCHAR, block::VARCHAR)), block) AS draw, blocks, quota
  FROM (SELECT *, unnest(range(0, blocks)) AS block FROM quotas)
), takes AS (
  SELECT l.no, l.shard, l.place, sum(greatest(least(l.stop, (d.block + 1) * {b}) - greatest(l.start, d.block * {b}), 0)
    * (d.quota // d.blocks + CASE WHEN d.draw <= d.quota % d.blocks THEN 1 ELSE 0 END)) AS taken
  FROM laid l JOIN draws d ON l.no = d.no AND l.shard = d.shard AND l.size > 0 AND d.block BETWEEN l.start // {b} AND (l.stop - 1) // {b}
  GROUP BY ALL
)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM laid LEFT JOIN takes USING (no, shard, place)
"""


def _quality() -> str:
    forms = ", ".join(f"'{w}'" for w in quality_rules._spelled(quality_rules.STOP_WORDS))

    def broken(rule: quality_rules.Rule) -> str:
        value, unit = (rule.measure, "1") if rule.per is None else (f"1000 * {rule.measure}", rule.per)
        bounds = [f"{value} < {rule.least} * {unit}"] * (rule.least is not None) + [f"{value} > {rule.most} * {unit}"] * (rule.most is not None)
        return f"({' OR '.join(bounds)})"

    failed = "concat_ws(', ', " + ", ".join(f"CASE WHEN {broken(r)} THEN '{r.name}' END" for r in quality_rules.RULES) + ")"
    return rf"""
WITH cut AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), places AS (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut),
windows AS (SELECT k, i, count(*) OVER (PARTITION BY k, ws[i:i + 2]) AS times FROM places),
repeats AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE times > 1) GROUP BY k),
measured AS (
  SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(ws, lambda w: rtrim(w, '.,;:!?') IN ({forms}))) AS n_stop_words,
    len(list_filter(ws, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_lettered_words,
    len(list_filter(ws, lambda w: regexp_matches(w, '\p{{Lu}}') AND NOT regexp_matches(w, '\p{{Ll}}'))) AS n_capital_words,
    len(ls) AS n_lines, len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines
  FROM cut LEFT JOIN repeats USING (k)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {failed} = '' AS kept, {failed} AS failed FROM measured
"""


TRIE = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
names AS (SELECT DISTINCT conv_id FROM turns),
crc AS (
  SELECT conv_id, xor(list_reduce(list_transform(str_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)), lambda c, b:
           list_reduce(list_concat([xor(c, b)], range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END), CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM names),
made AS (
  SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM crc c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text FROM crc c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
whole AS (
  SELECT n.conv_id, list({'r': m.role, 't': m.text} ORDER BY m.own, m.place) FILTER (WHERE m.role IS NOT NULL) AS seq
  FROM names n LEFT JOIN made m USING (conv_id) GROUP BY n.conv_id),
sized AS (SELECT conv_id, coalesce(seq, []) AS seq, coalesce(len(seq), 0) AS size FROM whole),
prefixes AS (SELECT conv_id, size, unnest(range(size + 1)) AS depth, seq FROM sized),
nodes AS (
  SELECT depth, seq[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth)), sha256('')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE strlen(any_value(seq[depth].t)) END AS bytes
  FROM prefixes GROUP BY depth, seq[1:depth]),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1] AND n.depth > 0)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, a.parent_conv_id, a.n_convs, a.n_children,
       CAST(count(*) FILTER (WHERE d.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((d.n_convs - 1) * d.bytes) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM linked a JOIN linked d ON d.depth >= a.depth AND d.prefix[1:a.depth] = a.prefix
GROUP BY a.prefix, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256
"""

SEARCH = r"""
WITH terms AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT count(*) AS n_docs, sum(len(ts)) AS n_terms FROM terms WHERE len(ts) > 0),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
cut AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM terms),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM cut WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT n_docs FROM sizes) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * (SELECT n_docs FROM sizes)) // (SELECT CAST(n_terms AS BIGINT) FROM sizes))))) AS BIGINT) AS score
  FROM held JOIN weighed USING (term) JOIN asked USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


def statements() -> dict[str, str]:
    return {
        "op1_warc_normalise": WARC,
        "op3_embedding_near_dedup": EMBEDDINGS,
        "op6_mix_sources": _mixing(),
        "op8_substring_dedup": SUBSTRINGS,
        "op11_quality_rules": _quality(),
        "op12_conversation_trie": TRIE,
        "op13_lexical_search": SEARCH,
    }
