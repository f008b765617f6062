"""SQL for DuckDB with the answers of the queries that SQL can express over whole tables.

None is given for the model scores of urls, for byte-pair merges, signatures, topological orders
and forests; tests hold those against plain versions.
"""

from __future__ import annotations

from marquee.llm import curriculum

SPACES = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(table: str, key: str, pattern: str, text: str = "text") -> str:
    """``{key}, i, w``: the words of each text, numbered from 1."""
    return f"""SELECT {key}, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w
  FROM (SELECT {key}, regexp_extract_all(coalesce({text}, ''), '{pattern}') AS ws FROM {table})"""


def run_of(n: int, key: str) -> str:
    """The n words from a word on, or NULL where fewer are left."""
    following = f"OVER (PARTITION BY {key} ORDER BY i)"
    parts = ", ".join(f"lead(w, {k}) {following}" for k in range(n))
    return f"CASE WHEN lead(w, {n - 1}) {following} IS NOT NULL THEN concat_ws(' ', {parts}) END"


def _covered(flag: str, n: int) -> str:
    return f"max({flag}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS largest FROM p
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND largest <> page_id THEN largest END AS refers_to
FROM g
"""

OP5 = f"""
WITH wd AS ({words("documents", "doc_id", SPACES)}),
win AS (SELECT doc_id, i, w, {run_of(20, "doc_id")} AS g FROM wd),
dup AS (
  SELECT doc_id, i, w, CASE WHEN g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 THEN 1 ELSE 0 END AS again
  FROM win
), cut AS (SELECT doc_id, i, w, {_covered("again", 20)} AS gone FROM dup),
kept AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS text
  FROM cut GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_SIZES = range(1, 11)
_DOC_RUNS = ", ".join(f"{run_of(n, 'doc_id')} AS g{n}" for n in _SIZES)
_MATCHES = "\n  UNION ALL ".join(
    f"SELECT r.doc_id, r.i, {n} AS n, p.item_id FROM runs r JOIN strings p ON p.n = {n} AND p.g = r.g{n}" for n in _SIZES
)
_HITS = " OR ".join(
    f"coalesce(max(m{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0) = 1" for n in _SIZES
)
OP6 = f"""
WITH dw AS ({words("documents", "doc_id", LETTERS, lower("text"))}),
bw AS ({words("benchmark", "item_id", LETTERS, lower("text"))}),
sized AS (SELECT *, least(10, count(*) OVER (PARTITION BY item_id)) AS n FROM bw),
strings AS (
  SELECT DISTINCT item_id, n, g FROM (
    SELECT item_id, n, CASE n {" ".join(f"WHEN {n} THEN {run_of(n, 'item_id')}" for n in _SIZES)} END AS g FROM sized
  ) WHERE g IS NOT NULL
),
runs AS (SELECT doc_id, i, {_DOC_RUNS} FROM dw),
found AS ({_MATCHES}),
marks AS (
  SELECT doc_id, i, {", ".join(f"max(CASE WHEN n = {n} THEN 1 END) AS m{n}" for n in _SIZES)} FROM found GROUP BY doc_id, i
),
hits AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (hit) AS n_hit
  FROM (SELECT dw.doc_id, ({_HITS}) AS hit FROM dw LEFT JOIN marks USING (doc_id, i)) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _bin(value: str) -> str:
    drop = f"greatest(length(bin(CAST({value} AS BIGINT))) - 5, 0)"
    return f"((CAST({value} AS BIGINT) >> {drop}) << {drop})"


def _quartiles(name: str, keys: str) -> str:
    by = f"{keys}, " if keys else ""
    over = f"PARTITION BY {by}measure"
    return f"""{name} AS (
  SELECT {by}measure, any_value(docs) AS docs, min(bin) FILTER (4 * seen >= docs) AS lower, min(bin) FILTER (2 * seen >= docs) AS median
  FROM (
    SELECT DISTINCT {by}measure, bin, count(*) OVER ({over} ORDER BY bin) AS seen, count(*) OVER ({over}) AS docs FROM bins
  ) GROUP BY {by}measure
)"""


def _fence(name: str, times: int, least: int, side: str) -> str:
    reach = f"{times} * greatest(median - lower, {least})"
    return f"max(CASE WHEN measure = '{name}' THEN median {side} {reach} END)"


def _blend(name: str) -> str:
    def mix(own: str, wider: str) -> str:
        return f"((least({own}.docs, 100) * {own}.{name} + (100 - least({own}.docs, 100)) * {wider}) // 100)"

    return f"CAST({mix('g', mix('l', f'o.{name}'))} AS BIGINT)"


OP7 = f"""
WITH wd AS ({words("documents", "doc_id", SPACES)}),
win AS (SELECT doc_id, i, w, {run_of(3, "doc_id")} AS g FROM wd),
rep AS (SELECT doc_id, i, w, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 THEN 1 ELSE 0 END AS again FROM win),
per_word AS (SELECT doc_id, w, {_covered("again", 3)} AS repeated FROM rep),
by_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(repeated) AS n_repeat_words FROM per_word GROUP BY doc_id
),
by_line AS (
  SELECT doc_id, len(ls) - len(list_distinct(ls)) AS n_dup_lines
  FROM (SELECT doc_id, [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{SPACES}')] AS ls FROM documents)
),
base AS (
  SELECT d.doc_id, coalesce(d.lang, '') AS lang, coalesce(d.source, '') AS source,
         CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_words, 0) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * coalesce(n_words, 0) AS base_failed
  FROM documents d LEFT JOIN by_word USING (doc_id) LEFT JOIN by_line USING (doc_id)
),
measured AS (
  SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_words, 1) AS dup_lines,
         1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS word_length
  FROM base
),
bins AS (
  SELECT lang, source, measure, {_bin("value")} AS bin
  FROM (SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS measure,
               unnest([symbols, dup_lines, repeats, word_length]) AS value FROM measured WHERE NOT base_failed)
),
{_quartiles("by_group", "lang, source")},
{_quartiles("by_lang", "lang")},
{_quartiles("overall", "")},
picked AS (
  SELECT g.lang, g.source, measure, {_blend("lower")} AS lower, {_blend("median")} AS median
  FROM by_group g JOIN by_lang l USING (lang, measure) JOIN overall o USING (measure)
),
limits AS (
  SELECT lang, source, {_fence("symbols", 6, 10, "+")} AS symbols_most, {_fence("dup_lines", 6, 10, "+")} AS dup_lines_most,
         {_fence("repeats", 6, 75, "+")} AS repeats_most, {_fence("word_length", 5, 60, "+")} AS word_length_most,
         {_fence("word_length", 5, 60, "-")} AS word_length_least
  FROM picked GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND symbols <= symbols_most AND dup_lines <= dup_lines_most AND repeats <= repeats_most
                AND word_length <= word_length_most AND word_length >= word_length_least, false) AS kept
FROM measured LEFT JOIN limits USING (lang, source)
"""

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP9 = f"""
WITH l AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (SELECT *, {lower(f"trim(line, {_STRIP})")} AS key FROM l),
f AS (SELECT *, CASE WHEN length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) THEN 1 ELSE 0 END AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

OP11 = """
WITH RECURSIVE step(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
), tab AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8),
crc(conv_id, i, c) AS (
  SELECT DISTINCT conv_id, 0, 4294967295 FROM conversations
  UNION ALL
  SELECT conv_id, i + 1, xor(c >> 8, t[(xor(c, ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1))) & 255) + 1])
  FROM crc, tab WHERE i < length(CAST(conv_id AS VARCHAR))
), fam AS (
  SELECT conv_id, conv_id - conv_id % 20 AS head, xor(c, 4294967295) % 4 AS h
  FROM crc WHERE i = length(CAST(conv_id AS VARCHAR))
), turns AS (
  SELECT conv_id, coalesce(text, '') AS text, md5(coalesce(role, '') || '|' || coalesce(text, '')) AS id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || '|' || coalesce(text, ''))) AS i
  FROM conversations
), rebuilt AS (
  SELECT f.conv_id, t.i, 0 AS own, t.id, t.text FROM fam f JOIN turns t ON t.conv_id = f.head AND t.i <= f.h
  UNION ALL
  SELECT f.conv_id, t.i, 1, t.id, t.text FROM fam f JOIN turns t ON t.conv_id = f.conv_id AND t.i > f.h
), paths AS (
  SELECT conv_id, row_number() OVER w AS d, string_agg(id, '') OVER w AS path,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
  UNION ALL SELECT conv_id, 0, '', 0 FROM fam
), sizes AS (SELECT conv_id, max(d) AS last FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, max(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = last), '')) AS ends
  FROM paths JOIN sizes USING (conv_id) GROUP BY path
), family AS (
  SELECT n.path, n.depth, n.conv_id, n.n, n.words, n.ends, left(n.path, length(n.path) - 32) AS up,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.path, length(n.path)) = n.path) AS children
  FROM nodes n
), below AS (
  SELECT a.path, sum(CASE WHEN b.children = 0 THEN 1 ELSE 0 END) AS leaves, sum((b.n - 1) * b.words) AS saved
  FROM family a JOIN (SELECT *, unnest(range(0, depth + 1)) AS k FROM family) b ON a.path = left(b.path, CAST(32 * b.k AS INTEGER))
  GROUP BY a.path
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.children AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM family f JOIN below b USING (path) LEFT JOIN nodes p ON f.depth > 0 AND p.path = f.up
"""


def _time_of(demand: str, schedule: curriculum.Schedule) -> str:
    """The inverse of a schedule's integral, stretch by stretch."""
    *parts, end = curriculum.segments(schedule)
    cases = []
    for start, length, weight, slope, before in parts:
        area = f"greatest({demand} * {end[4]}::DOUBLE - {before}::DOUBLE, 0.0::DOUBLE)"
        root = f"sqrt(greatest({weight * weight}::DOUBLE + {area} * {2 * slope}::DOUBLE, 0.0::DOUBLE))"
        x = f"coalesce({area} * 2.0::DOUBLE / nullif({weight}::DOUBLE + {root}, 0.0::DOUBLE), 0.0::DOUBLE)"
        after = before + (weight + slope * length / 2) * length
        cases.append(f"WHEN {demand} * {end[4]}::DOUBLE <= {after}::DOUBLE THEN {start}::DOUBLE + least({x}, {length}::DOUBLE)")
    return f"CASE {' '.join(cases)} ELSE {end[0]}::DOUBLE END"


OP12 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACES}')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'no id ' || coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") AS place FROM d GROUP BY source
), w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(place - 1) % 3 + 1] AS weight, 2 * source_size AS most FROM s),
-- sources stop in the order of how soon the level reaches their most; the level is the one at which the next does not stop
r AS (
  SELECT *, 1.5 * sum(source_size) OVER () AS wanted, coalesce(sum(most) OVER up, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS free,
         row_number() OVER (ORDER BY most / weight, place) AS k
  FROM w WINDOW up AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lv AS (
  SELECT min_by((wanted - held)::DOUBLE / free, k) AS level FROM r WHERE weight * ((wanted - held)::DOUBLE / free) < most
), t AS (
  SELECT w.*, CASE WHEN level IS NULL OR weight * level >= most THEN CAST(most AS DOUBLE) ELSE weight * level END AS target FROM w, lv
), b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, CAST(round(t.target) AS BIGINT) AS stop,
         CAST(sum(d.size) OVER (PARTITION BY t.place ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (SELECT *, start / target AS demand FROM b)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(least(size, stop - start), 0) + greatest(least(size, stop - start - source_size), 0) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND start < stop THEN CASE (place - 1) % 3
         {" ".join(f"WHEN {i} THEN {_time_of('demand', schedule)}" for i, schedule in enumerate(curriculum.SCHEDULES))} END END AS position
FROM p
"""

OP13 = f"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{SPACES}') AS ws FROM documents
), f AS (
  SELECT t.doc_id, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
          coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM t LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
  ) l ON l.doc_id = t.doc_id
), c AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS ix
  FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), st AS (
  SELECT filter_order, step, ix[step] AS i, ix[1:step - 1] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), j AS (
  SELECT part, filter_order, step, i, n, good, toxic, fails[i] AS failed, len(list_filter(fails, lambda z: z)) AS n_fails,
         len(list_filter(before, lambda k: fails[k])) > 0 AS gone
  FROM c, st
), g AS (
  SELECT part, filter_order, step, i,
         coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND failed), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND failed), 0) AS redundant, coalesce(sum(n) FILTER (failed AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND failed AND good), 0) AS good_lost, coalesce(sum(n) FILTER (NOT gone AND failed AND toxic), 0) AS toxic_lost
  FROM j GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr('ABCDE', i, 1) AS filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM g
"""

ORACLES: dict[str, str] = {
    "op3_warc_revisits": OP3,
    "op5_substring_dedup": OP5,
    "op6_decontamination": OP6,
    "op7_quality_rules": OP7,
    "op9_line_dedup": OP9,
    "op11_prefix_trie": OP11,
    "op12_curriculum_mix": OP12,
    "op13_filter_audit": OP13,
}
