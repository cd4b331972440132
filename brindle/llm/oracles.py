"""DuckDB SQL that states what queries of this subpackage return, written from their definitions."""

from __future__ import annotations

from brindle.llm.license_scan import CONTAINMENT, SHINGLE, TEMPLATES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: On the layout of the given pages: one article, whose blocks begin with <h1> or <p>.
HTML_EXTRACTION = r"""
WITH blocks AS (
  SELECT page_id, url, unnest(b) AS block, generate_subscripts(b, 1) AS pos
  FROM (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<h1>|<p>') AS b FROM pages)
), clean AS (
  SELECT page_id, url, pos, trim(regexp_replace(
    regexp_replace(replace(replace(replace(replace(regexp_replace(block, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
    '\s+', ' ', 'g')) AS block
  FROM blocks
), texts AS (
  SELECT page_id, any_value(url) AS url, coalesce(string_agg(block, chr(10) ORDER BY pos) FILTER (WHERE block <> ''), '') AS text
  FROM clean GROUP BY page_id
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""


def url_filter(rules: list[tuple[str, str, str]], blocked: tuple[str, ...], domains: tuple[str, ...], mirrors: int) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    names, of = (", ".join(f"('{x}')" for x in xs) for xs in (blocked, domains))
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, h, p) AS (VALUES {values}), listed AS (
  SELECT name || CASE WHEN n > 0 THEN CAST(n AS VARCHAR) ELSE '' END || '.' || d AS b FROM (VALUES {names}) a(name), (VALUES {of}) b(d), range({mirrors}) r(n)
), fits AS (
  SELECT page_id, h || p AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC, verdict DESC) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), blocked AS (SELECT DISTINCT page_id FROM parts JOIN listed ON host = b OR ends_with(host, '.' || b))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN blocked.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (page_id) LEFT JOIN blocked USING (page_id)
"""


#: Every unit that is not blank counts, however short; passages are runs of sentences that other documents have.
LINE_DEDUP = rf"""
WITH units AS (
  SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS u FROM documents)
), placed AS (
  SELECT *, coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    trim(regexp_replace(translate(unit, '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM units
), ranked AS (
  SELECT *, norm <> '' AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, pos) > 1 AS gone FROM placed
), runs AS (
  SELECT *, sum(CASE WHEN gone THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS cut FROM ranked
), kept AS (
  SELECT doc_id, string_agg(CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(z AS BIGINT) AS VARCHAR), ',' ORDER BY a) AS kept_spans
  FROM (SELECT doc_id, cut, min(start) AS a, max(start + length(unit)) AS z FROM runs WHERE NOT gone GROUP BY doc_id, cut) GROUP BY doc_id
), sentences AS (
  SELECT doc_id, pos, trim(regexp_replace(translate(x, '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, unnest(x) AS x, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?]*') AS x FROM documents))
), met AS (
  SELECT doc_id, pos, 1 + length(norm) - length(replace(norm, ' ', '')) AS n, min(doc_id) OVER (PARTITION BY norm) <> max(doc_id) OVER (PARTITION BY norm) AS shared
  FROM sentences WHERE norm <> ''
), numbered AS (SELECT *, sum(CASE WHEN shared THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM met
), longest AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_shared_words, CAST(max(n) AS BIGINT) AS passage_words
  FROM (SELECT doc_id, run, sum(n) AS n FROM numbered WHERE shared GROUP BY ALL) GROUP BY doc_id
)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (WHERE gone) AS n_removed,
  coalesce(any_value(n_shared_words), 0) AS n_shared_words, coalesce(any_value(passage_words), 0) AS passage_words, coalesce(any_value(passage_words), 0) > 40 AS has_passage,
  coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(unit) AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE gone), '') AS removed_spans,
  coalesce(any_value(kept_spans), '') AS kept_spans,
  coalesce(string_agg(unit, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM ranked LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id) GROUP BY doc_id
"""

DECONTAMINATION = rf"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}'), []) AS w FROM documents
), dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), met AS (SELECT doc_id, k, i, item FROM dw JOIN bw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM met)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


#: Sets of five-word shingles, links of 0.8 or more, and their closure.
JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y, c = p.n AND c = q.n AS same FROM met JOIN size p ON x = p.doc_id JOIN size q ON y = q.doc_id WHERE c >= 0.8 * (p.n + q.n - c) - 1e-9),
walk AS (SELECT x, y FROM link UNION SELECT walk.x, link.y FROM walk JOIN link ON walk.y = link.x),
copies AS (SELECT x, min(y) AS copy FROM link WHERE same GROUP BY x), least_of AS (SELECT x, min(y) AS class FROM walk GROUP BY x), links AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, CASE WHEN len(w) > 0 THEN least(doc_id, coalesce(copy, doc_id)) END AS copy_id, least(doc_id, coalesce(class, doc_id)) AS class_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN copies ON doc_id = copies.x LEFT JOIN least_of ON doc_id = least_of.x LEFT JOIN links ON doc_id = links.x
"""


def license_scan() -> str:
    values = ", ".join(f"('{k}', '{t}')" for k, t in TEMPLATES.items())
    words = rf"list_filter(string_split_regex(lower({{}}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    shingles = f"SELECT {{0}}, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s, i - 1 AS pos FROM (SELECT {{0}}, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM {{1}})"
    return f"""
WITH t(license, t) AS (VALUES {values}), tw AS (SELECT license, {words.format('t')} AS w FROM t),
ts AS (SELECT DISTINCT license, s FROM ({shingles.format('license', 'tw')})), size AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
d AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents), ds AS ({shingles.format('doc_id', 'd')}),
met AS (SELECT doc_id, license, n, s, unnest([pos // n, pos // n - 1]) AS k FROM ds JOIN ts USING (s) JOIN size USING (license)),
found AS (SELECT doc_id, license FROM met WHERE k >= 0 GROUP BY doc_id, license, n, k HAVING count(DISTINCT s) >= {CONTAINMENT} * n - 1e-9),
listed AS (SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS l FROM (SELECT DISTINCT * FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(l, '') AS licenses FROM documents LEFT JOIN listed USING (doc_id)
"""


def license_bank_scan(bank: dict[str, str]) -> str:
    """Templates of ``bank`` by containment of 0.8 in windows; better matches in overlapping windows displace those they explain.

    Shingles have five words, of a template of fewer three, or as many as it has.
    """
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in bank.items())
    words = r"list_filter(string_split_regex(lower({}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    shingles = "SELECT {0}, array_to_string(w[i:i + x - 1], ' ') AS s, i - 1 AS pos FROM (SELECT {0}, w, x, unnest(range(1, len(w) - x + 2)) AS i FROM {1})"
    return f"""
WITH t(name, t) AS (VALUES {values}), tw AS (SELECT name, {words.format('t')} AS w FROM t),
ts AS (SELECT DISTINCT name, s FROM ({shingles.format('name', '(SELECT *, CASE WHEN len(w) >= 5 THEN 5 ELSE least(3, len(w)) END AS x FROM tw)')})), size AS (SELECT name, count(*) AS n FROM ts GROUP BY name),
d AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents), ds AS ({shingles.format('doc_id', '(SELECT *, unnest([1, 2, 3, 5]) AS x FROM d) WHERE len(w) >= x')}),
met AS (
  SELECT doc_id, name, n, s, k, min(pos) AS p FROM (SELECT doc_id, name, n, s, pos, unnest([pos // n, pos // n - 1]) AS k FROM ds JOIN ts USING (s) JOIN size USING (name)) GROUP BY ALL),
found AS (
  SELECT doc_id, name, n, k, k * n AS a, k * n + 2 * n AS z, count(*) AS c, min(p) AS first, max(p) + any_value(1 + length(s) - length(replace(s, ' ', ''))) AS last
  FROM met WHERE k >= 0 GROUP BY doc_id, name, n, k HAVING count(*) >= 0.8 * n - 1e-9),
own AS (SELECT found.*, s FROM found JOIN met USING (doc_id, name, n, k)),
worse AS (
  SELECT x.doc_id, x.name, x.k FROM own x JOIN own y ON x.doc_id = y.doc_id AND x.s = y.s AND y.a < x.z AND x.a < y.z AND (y.c > x.c OR (y.c = x.c AND y.n < x.n))
  GROUP BY x.doc_id, x.name, x.k, x.c, y.name, y.k HAVING 2 * count(*) > x.c
  UNION ALL SELECT x.doc_id, x.name, x.k FROM found x JOIN found y ON x.doc_id = y.doc_id WHERE x.last - x.first < 5 AND y.first <= x.first AND x.last <= y.last AND y.c > x.c),
best AS (SELECT DISTINCT doc_id, string_split(name, '#')[1] AS license FROM found ANTI JOIN worse USING (doc_id, name, k)),
listed AS (SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS l FROM best GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(l, '') AS licenses FROM documents LEFT JOIN listed USING (doc_id)
"""


#: Failures of each text by letter, then every order of the five filters over counts by set of failures.
FILTER_AUDIT = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN known USING (doc_id)
), counts AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failed GROUP BY part, fails
), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders(o) AS (
  SELECT f FROM letters UNION ALL SELECT o || f FROM orders, letters WHERE instr(o, f) = 0
), steps AS (
  SELECT o, i AS step, o[i:i] AS f, o[1:i - 1] AS before FROM (SELECT o, unnest(range(1, 6)) AS i FROM orders WHERE length(o) = 5)
), audit AS (
  SELECT part, o AS filter_order, step, f,
    sum(n) FILTER (WHERE translate(fails, before || f, '') = fails) AS kept,
    sum(n) FILTER (WHERE instr(fails, f) > 0 AND translate(fails, before, '') = fails) AS removed,
    sum(n) FILTER (WHERE instr(fails, f) > 0 AND translate(fails, before, '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = f) AS unique_fails,
    sum(good) FILTER (WHERE instr(fails, f) > 0 AND translate(fails, before, '') = fails) AS good_lost,
    sum(toxic) FILTER (WHERE instr(fails, f) > 0 AND translate(fails, before, '') = fails) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM audit
"""


def code_compression(rounds: int = 4) -> str:
    """Lloyd's rounds written out, over all distances; sums of squares are whole and far under 2^53."""
    assigned = """a{k} AS MATERIALIZED (
  SELECT vec_id, part, v, vv, min(CAST(vv - 2 * list_dot_product(v, c) + cc AS BIGINT) * 256 + e) AS best FROM parts JOIN c{k} USING (part) GROUP BY ALL)"""
    moved = """c{n} AS MATERIALIZED (
  SELECT part, e, c, list_dot_product(c, c) AS cc FROM (
    SELECT c{k}.part, c{k}.e, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
      SELECT part, e, list(q ORDER BY i) AS m FROM (
        SELECT part, e, i, floor(CAST(sum(CAST(x AS BIGINT)) AS DOUBLE) / count(*)) AS q
        FROM (SELECT part, best % 256 AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY part, e, i) GROUP BY part, e) USING (part, e)))"""
    steps = ",\n".join(assigned.format(k=k) + ",\n" + moved.format(k=k, n=k + 1) for k in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT *, list_dot_product(v, v) AS vv FROM (
    SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS v FROM kept, (SELECT unnest(range(4)) AS part))
), c0 AS MATERIALIZED (
  SELECT part, e, v AS c, vv AS cc FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id)
), {steps},
{assigned.format(k=rounds)},
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, i)) AS h
  FROM (SELECT part, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM c{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


#: Every window of 100 bytes, written as 200 hexadecimal digits, against all others.
SUFFIX_DEDUP = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, s, md5(h[2 * s + 1:2 * s + 200]) AS m FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, s) > 1),
fresh AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS f FROM later),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS z FROM (SELECT doc_id, s, sum(f) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM fresh) GROUP BY doc_id, g),
cut AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM spans),
gone AS (
  SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(h[2 * before + 1:2 * a] || CASE WHEN last THEN h[2 * z + 1:] ELSE '' END, '' ORDER BY a) AS kept
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
