"""DuckDB answers to the named queries that SQL can express."""

from __future__ import annotations

from stockflow.llm import licenses, mixing, queries, vector_codes

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# op6: windows of both sides as text; a short item is one window of its own length
BENCHMARK_HITS = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                     lambda x: x <> '') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         list_filter(string_split_regex({LOWER.format("text")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_window AS (
  SELECT DISTINCT item, least(len(w), 10) AS width,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS words
  FROM item WHERE len(w) > 0),
width AS (SELECT DISTINCT width FROM item_window),
doc_window AS (
  SELECT r, width, unnest(range(1, len(w) - width + 2)) AS first, w FROM doc, width WHERE len(w) >= width),
hit AS (
  SELECT d.r, d.first, d.width, i.item
  FROM (SELECT r, first, width, array_to_string(w[first:first + width - 1], ' ') AS words FROM doc_window) d
  JOIN item_window i USING (width, words)),
hit_word AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(first, first + width)) AS p FROM hit) GROUP BY r),
hit_item AS (SELECT r, list(DISTINCT item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(list_sort(items), ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_word USING (r) LEFT JOIN hit_item USING (r)
"""

# op10: all pairs that share a shingle, then reachability over the links
NEAR_DUPLICATES = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
                                                lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM doc WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT a AS doc_id, a AS other FROM (SELECT DISTINCT a FROM link)
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

# op3: the queue as cumulative sums per source, cut at each source's target
MIX = rf"""
WITH doc AS (
  SELECT doc_id, source, md5('{mixing.SEED}:' || doc_id) AS place,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
source_total AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM doc GROUP BY source),
weighted AS (
  SELECT *, CAST(CASE rank % 3 {" ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(mixing.WEIGHTS))} END AS DOUBLE) AS weight,
         CAST(source_size * {mixing.COPIES} AS DOUBLE) AS cap, sum(source_size) OVER () * CAST({mixing.SHARE} AS DOUBLE) AS budget
  FROM source_total),
timed AS (
  SELECT *, cap / weight AS done,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reached
  FROM weighted),
target AS (
  SELECT source, source_size,
         CASE WHEN done > reached
              THEN (SELECT arg_min(reached, (done, rank)) FROM timed WHERE done > reached) * weight ELSE cap END AS target
  FROM timed),
sent AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before FROM doc)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - before))
            + greatest(0, least(size, floor(target) - source_size - before)) AS BIGINT) AS taken
FROM sent JOIN target ON sent.source IS NOT DISTINCT FROM target.source
"""

# op2: sentences as rows, identifiers as one text per document, rules as one pattern
_TRIGGER = licenses.TRIGGER.removeprefix("(?i)")
_KNOWN = ", ".join(f"('{form}', '{name}')" for form, name in licenses.known_sentences().items())
_RULES = ", ".join(f"('{' '.join(names)} ', '{name}')" for names, name in licenses.RULES)
LICENSES = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         CASE WHEN regexp_matches(text, '{_TRIGGER}', 'i') THEN text ELSE '' END AS t
  FROM documents),
cut AS (
  SELECT r, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
           '[.!?;]+[\x20\x09-\x0D]+', chr(1), 'g'), '\n[\x20\x09]*\n', chr(1), 'g'),
           '\n+([A-Z0-9\x22*#/])', chr(1) || '\1', 'g'), '\n+$', chr(1)), chr(1)) AS s
  FROM doc WHERE t <> ''),
sentence AS (SELECT r, unnest(s) AS s, generate_subscripts(s, 1) AS place FROM cut),
formed AS (
  SELECT r, place, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS form
  FROM sentence WHERE regexp_matches(s, '{_TRIGGER}', 'i')),
known(form, name) AS (VALUES {_KNOWN}),
found AS (
  SELECT r, place, coalesce(w.name, l.name) AS name
  FROM (SELECT *, array_to_string(string_split(form, ' ')[1:{licenses.LEAD}], ' ') || ' *' AS lead FROM formed) f
  LEFT JOIN known w ON w.form = f.form LEFT JOIN known l ON l.form = f.lead
  WHERE coalesce(w.name, l.name) IS NOT NULL),
spaced AS (
  SELECT r, place, CASE WHEN place - lag(place) OVER (PARTITION BY r ORDER BY place) > {licenses.GAP} + 1 THEN '| ' ELSE '' END
                || name || ' ' AS part FROM found),
seq AS (SELECT r, count(*) AS n, string_agg(part, '' ORDER BY place) AS names FROM spaced GROUP BY r),
rule(names, licence) AS (SELECT names, first(licence) FROM (VALUES {_RULES}) AS v(names, licence) GROUP BY names),
matched AS (
  SELECT r, unnest(m) AS names, generate_subscripts(m, 1) AS k
  FROM (SELECT r, regexp_extract_all(names, '{licenses.rule_pattern()}') AS m FROM seq)),
licensed AS (
  SELECT r, count(*) AS n, string_agg(licence, ',' ORDER BY k) AS licenses FROM matched JOIN rule USING (names) GROUP BY r)
SELECT doc_id, CAST(coalesce(seq.n, 0) AS BIGINT) AS n_sentences, CAST(coalesce(licensed.n, 0) AS BIGINT) AS n_licenses,
       coalesce(licenses, '') AS licenses
FROM doc LEFT JOIN seq USING (r) LEFT JOIN licensed USING (r)
"""

# op11: every part measured against every entry; each round is one pair of tables
_PARTS, _ENTRIES = vector_codes.PARTS, vector_codes.ENTRIES


def _assignment(name: str, book: str) -> str:
    return f"""
{name} AS (
  SELECT vec_id, p, any_value(c) AS c, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT vec_id, part.p, part.c, e,
               list_sum(list_transform(range(1, len(part.c) + 1), lambda i: (part.c[i] - b.c[i]) * (part.c[i] - b.c[i]))) AS d
        FROM part JOIN {book} b ON b.p = part.p)
  GROUP BY vec_id, p)"""


def _averages(name: str, book: str, assigned: str) -> str:
    return f"""
{name} AS (
  SELECT b.p, b.e, coalesce(mean.c, b.c) AS c
  FROM {book} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c
    FROM (SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
          FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM {assigned}) GROUP BY p, e, i)
    GROUP BY p, e) mean ON mean.p = b.p AND mean.e = b.e)"""


VECTOR_CODES = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
  SELECT vec_id, p, w[p * (len(w) // {_PARTS}) + 1:(p + 1) * (len(w) // {_PARTS})] AS c
  FROM v, (SELECT unnest(range({_PARTS})) AS p)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, c
  FROM part WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {_ENTRIES})),
{_assignment("assigned0", "book0")},
{_averages("book1", "book0", "assigned0")},
{_assignment("assigned1", "book1")},
{_averages("book2", "book1", "assigned1")},
{_assignment("assigned2", "book2")},
code AS (
  SELECT vec_id, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM assigned2 GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM code JOIN v USING (vec_id), digest
"""

# op12: every rule held against every URL
URL_VERDICTS = f"""
WITH page AS (
  SELECT row_number() OVER () AS r, page_id,
         {LOWER.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rule(rule_host, rule_path, said) AS (VALUES {", ".join(str(tuple(rule)) for rule in queries.URL_RULES)}),
hit AS (
  SELECT r, arg_max((rule_host || rule_path, said), length(rule_host || rule_path)) AS best
  FROM page JOIN rule ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r)
SELECT page_id, host, path, best[1] AS rule, coalesce(best[2], 'allow') AS verdict
FROM page LEFT JOIN hit USING (r)
"""

# op13: one step per row over the best (cost, audit, rows) of each end state


def _best(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(state: str, cost: str, edits: str, lines: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {edits}, 't': {state}.t || {lines}}}"


def _step(end: str, rows: dict[str, str]) -> str:
    """The best way to a state: deletion, or one of `rows`, (state before -> inserted role)."""
    name = {"u": "'user'", "a": "'assistant'"}[end]
    keeps = f"initial = '{end}'"
    line = f"chr(10) || CASE WHEN {keeps} THEN role ELSE {name} END || ':' || text"
    ways = [_way({"u": "su", "a": "sa"}[end], "2", "'D'", "''")]
    for state, inserted in rows.items():
        cost = f"(stays + CASE WHEN {keeps} THEN 0 ELSE 1 END + {5 if inserted else 0})"
        edits = f"'{'I' if inserted else ''}' || CASE WHEN {keeps} THEN 'K' ELSE 'R' END"
        ways.append(_way(state, cost, edits, (f"chr(10) || '{inserted}:' || " if inserted else "") + line))
    return _best(*ways)


_NEVER = 1_000_000_000
CONVERSATIONS = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
kind AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
               list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                              lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS k
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kind),
placed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed),
row_ AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN {_NEVER} WHEN fault = 'truncated' THEN 5 ELSE 0 END AS stays
  FROM faulty),
path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
         {{'c': CAST({_NEVER} AS BIGINT), 'a': '', 't': ''}} AS ss, {{'c': CAST({_NEVER} AS BIGINT), 'a': '', 't': ''}} AS su,
         {{'c': CAST({_NEVER} AS BIGINT), 'a': '', 't': ''}} AS sa
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT path.conv_id, row_.n, {_way("s0", "2", "'D'", "''")},
         {_best(_way("ss", "2", "'D'", "''"), _way("s0", f"(stays + CASE WHEN initial = 's' THEN 0 ELSE {_NEVER} END)", "'K'", "chr(10) || role || ':' || text"))},
         {_step("u", {"s0": "", "ss": "", "sa": "", "su": "assistant"})},
         {_step("a", {"su": "", "s0": "user", "ss": "user", "sa": "user"})}
  FROM path JOIN row_ ON path.conv_id IS NOT DISTINCT FROM row_.conv_id AND row_.n = path.n + 1),
count_ AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM row_ GROUP BY conv_id),
done AS (
  SELECT path.conv_id, gaps, blank, duplicate, truncated, illegal,
         {_best("s0", "sa", _way("su", "5", "'I'", "chr(10) || 'assistant:'"))} AS best
  FROM path LEFT JOIN count_ ON path.conv_id IS NOT DISTINCT FROM count_.conv_id
  WHERE path.n = coalesce(count_.n, 0))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM done
"""

ORACLE_SQL = {
    "op2_license_scans": LICENSES,
    "op3_mixing_sources": MIX,
    "op6_benchmark_decontamination": BENCHMARK_HITS,
    "op10_ngram_jaccard_join": NEAR_DUPLICATES,
    "op11_vector_code_compression": VECTOR_CODES,
    "op12_url_filters": URL_VERDICTS,
    "op13_conversation_repair": CONVERSATIONS,
}
