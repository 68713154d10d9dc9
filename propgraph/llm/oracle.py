"""DuckDB SQL for the queries SQL can express, written from their contracts.

None for sharding (no CRC-32 or XXH64), SimHash (no XXH64), the secret scan and
toxicity (trained models) and SentencePiece: those are tested by brute force.
"""

from __future__ import annotations

from propgraph.llm import licenses
from propgraph.llm.common import UPPER

_LOWER = f"translate({{0}}, '{UPPER}', '{UPPER.lower()}')"
_BLANK_CHARS = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER ranked AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER ranked = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
WINDOW ranked AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
k AS (
  SELECT *, {_LOWER.format(f"trim(line, {_BLANK_CHARS})")} AS key FROM l),
o AS (
  SELECT *, min(doc_id) OVER (PARTITION BY key) AS owner FROM k)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE length(key) >= 10 AND doc_id <> owner) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (WHERE NOT (length(key) >= 10 AND doc_id <> owner)), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""


def _license_sql() -> str:
    known = ", ".join(f"('{s}', '<{i}>')" for s, i in licenses.known_sentences().items())
    reads = " UNION ALL ".join(f"""
      SELECT doc_id, {k} AS side, string_split(replace(regexp_replace(
               lower(regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]+', ' ', 'g')),
               '{licenses.BREAK}', chr(1), 'g'), chr(10), {end}), chr(1)) AS parts FROM documents"""
                               for k, end in ((0, "' '"), (1, "chr(1)")))
    # the rules, one after the other on what the earlier ones left
    steps, last = [], "runs"
    for k, (name, run) in enumerate(licenses.rule_runs()):
        steps.append(f"r{k} AS (SELECT doc_id, side, ids, replace(state, '{run}', '.') AS state, "
                     f"CASE WHEN contains(state, '{run}') AND NOT list_contains(hits, '{name}') "
                     f"THEN list_append(hits, '{name}') ELSE hits END AS hits FROM {last})")
        last = f"r{k}"
    count = "(length({0}) - length(replace({0}, '<', '')))"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
reads AS ({reads}),
parts AS (SELECT doc_id, side, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM reads),
clean AS (SELECT doc_id, side, pos, regexp_replace(regexp_replace(part, '{licenses.JUNK}', ' ', 'g'),
                                                   '{licenses.EDGE}', '', 'g') AS sentence FROM parts),
found AS (SELECT doc_id, side, string_agg(id, '' ORDER BY pos) AS ids
          FROM clean JOIN known USING (sentence) GROUP BY doc_id, side),
runs AS (SELECT doc_id, side, ids, ids AS state, CAST([] AS VARCHAR[]) AS hits FROM found),
{", ".join(steps)},
a AS (SELECT * FROM {last} WHERE side = 0),
b AS (SELECT * FROM {last} WHERE side = 1),
both_sides AS (
  SELECT d.doc_id, coalesce(a.ids, '') AS a_ids, coalesce(b.ids, '') AS b_ids,
         coalesce(a.state, '') AS a_state, coalesce(b.state, '') AS b_state,
         coalesce(a.hits, []) AS a_hits, coalesce(b.hits, []) AS b_hits
  FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id))
SELECT doc_id,
       array_to_string(list_concat(a_hits, list_filter(b_hits, lambda x: NOT list_contains(a_hits, x))), ',') AS licenses,
       CASE WHEN {count.format('b_ids')} > {count.format('a_ids')} THEN b_ids ELSE a_ids END AS sentence_ids,
       CAST(CASE WHEN {count.format('b_ids')} > {count.format('a_ids')}
                 THEN {count.format('b_state')} ELSE {count.format('a_state')} END AS BIGINT) AS n_left_over
FROM both_sides
"""


# base32 of a 20-byte digest: 10 hex digits are 40 bits, 8 letters
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST((CAST('0x' || substr(h, {10 * g + 1}, 10) AS BIGINT) >> {35 - 5 * j}) & 31 AS BIGINT) + 1, 1)"
    for g in range(4) for j in range(8))

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

_WORDS = (r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
          + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_size AS (SELECT item_id, w, least(13, len(w)) AS size FROM item WHERE len(w) > 0),
item_at AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM item_size),
item_window AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
                FROM item_at),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
doc_at AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
           FROM doc, (SELECT DISTINCT size FROM item_size) WHERE len(w) >= size),
hit AS (SELECT doc_id, size, s, item_id
        FROM (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win FROM doc_at)
        JOIN item_window USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

_TERMS = (r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
          + r", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')")

DIVERGENCE = f"""
WITH doc AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                    {_TERMS} AS w FROM documents),
said AS (SELECT id, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
n_kept AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT g.lang, g.source, coalesce(sum(h.n), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN held h USING (lang, source) GROUP BY g.lang, g.source),
grp_p AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         CAST(1 + (1000000000 * (coalesce(h.n, 0) + 1)) // (g.total + v) AS BIGINT) AS p
  FROM grp g JOIN kept k USING (lang) JOIN n_kept USING (lang) LEFT JOIN held h USING (lang, source, term)),
lang_p AS (
  SELECT lang, term, CAST(1 + (1000000000 * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + max(v)) AS BIGINT) AS q
  FROM held JOIN n_kept USING (lang) GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, CAST(sum((x.p - y.p) * (x.p - y.p) // y.p) AS BIGINT) AS value
             FROM grp_p x JOIN grp_p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY x.lang, x.source, y.source) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM grp_p JOIN lang_p USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT part, lang, source, item, value,
         CAST(row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": EXACT_DEDUP, "op4_line_dedup": LINE_DEDUP,
            "op5_license_scan": _license_sql(), "op7_warc": WARC,
            "op10_decontamination": DECONTAMINATION, "op12_divergence": DIVERGENCE}
