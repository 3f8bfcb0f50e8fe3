"""DuckDB SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from quire.functions.text import BULLETS, FANCY, PLAIN
from quire.operators.checks import REQUIRED
from quire.plans.adapters import with_clause

_W = r"[\p{L}\p{N}_]"
_ENTRIES = "entries AS (SELECT o.book, idx, page, regexp_extract(trim(title), '^([0-9]+): *', 1)::INT AS number, trim(regexp_replace(trim(title), '^([0-9]+): *', '')) AS title FROM outline o WHERE level = 2 AND regexp_matches(trim(title), '^([0-9]+): *'))"
_NEXT = "following AS (SELECT book, idx, level, title, page, first_value(CASE WHEN level <= 2 THEN page - 1 END IGNORE NULLS) OVER (PARTITION BY book ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM outline)"
_FOUND = """found AS (
  SELECT e.book, e.number, e.title, e.page - 1 AS first, coalesce(f.next, p.page_count) - 1 AS last, e.idx AS toc_index, p.page_count, count(*) OVER (PARTITION BY e.book, e.number) AS same
  FROM entries e JOIN following f ON e.book = f.book AND e.idx = f.idx JOIN book_pages p ON p.book = e.book)"""
_RANGES = """ranges AS (
  SELECT book, number, 'ch' || CASE WHEN number < 10 THEN '0' ELSE '' END || number AS slug, title, first, last, toc_index,
    CASE WHEN same > 1 THEN same || ' entries for chapter ' || number WHEN first < 0 OR first > last OR last >= page_count THEN 'range ' || first || '..' || last || ' outside the book' END AS error FROM found)"""
_RULED = """ruled AS (
  SELECT r.* FROM ranges r ANTI JOIN overrides o ON r.book = o.book AND r.number = o.number
  UNION ALL SELECT o.book, o.number, 'ch' || CASE WHEN o.number < 10 THEN '0' ELSE '' END || o.number, coalesce(f.title, 'Chapter ' || o.number), o.first, o.last, f.toc_index, NULL
  FROM overrides o LEFT JOIN found f ON f.book = o.book AND f.number = o.number AND f.same = 1)"""
_RANGE_STEPS = f"{_ENTRIES}, {_NEXT}, {_FOUND}, {_RANGES}"
_SUBTREE = """tree AS (
  SELECT h.book, r.number, h.idx, h.level, h.title, h.page - 1 AS page0 FROM (
    SELECT *, last_value(CASE WHEN level <= 2 THEN idx END IGNORE NULLS) OVER (PARTITION BY book ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS head FROM outline) h
  JOIN ruled r ON r.book = h.book AND r.toc_index = h.head WHERE h.level > 2)"""
_PRINTED = "CASE WHEN {p} % 3 = 0 THEN {p} + 100 ELSE {p} + 1 - 7 END"
_SECTIONS = f"""sections AS (
  SELECT book, number, idx, nullif(regexp_extract(title, '^\\s*([0-9]+[-.][0-9]+)\\s*:?\\s*', 1), '') AS section, trim(regexp_replace(title, '^\\s*([0-9]+[-.][0-9]+)\\s*:?\\s*', '')) AS title,
    page0 AS pdf_page, {_PRINTED.format(p="page0")} AS printed_page, level FROM tree WHERE level = 3)"""


#: Runs of three to seven spaced capitals; the pattern language looks neither ahead nor behind.
_CAPS = r"(^|\s)([A-Z]{1,2})[ \t]+([A-Z]{1,2})[ \t]+([A-Z]{1,2})" + r"(?:[ \t]+([A-Z]{1,2}))?" * 4 + r"(\s|$)"


def _normalized(text: str, marked: bool = True) -> str:
    """The whole chain; of the compatibility characters those that the texts are given (their own text has none)."""
    out = f"regexp_replace({text}, '</?su[bp]>', '', 'g')" if marked else text
    out = f"nfc_normalize(replace(replace(replace({out}, 'ﬁ', 'fi'), '½', '1⁄2'), 'Å', 'Å'))"
    quoted = PLAIN.replace("'", "''")
    out = f"translate({out}, '{FANCY}', '{quoted}')"
    out = f"replace(regexp_replace({out}, chr(173) || '\\n\\s*', '', 'g'), chr(173), '')"
    out = f"regexp_replace({out}, '({_W})-\\n\\s*({_W})', '\\1\\2', 'g')"
    for _ in range(2):  # without lookaround, a second pass reaches hyphens that share a letter
        out = f"regexp_replace({out}, '({_W})-({_W})', '\\1\\2', 'g')"
    out = f"regexp_replace(translate({out}, '{BULLETS}', '{' ' * len(BULLETS)}'), '(?m)^[ \\t]*[-*][ \\t]+', '', 'g')"
    out = f"regexp_replace({out}, '{_CAPS}', '\\1\\2\\3\\4\\5\\6\\7\\8\\9', 'g')"
    return f"replace({out}, chr(8203), '')"


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\s\\p{{Z}}]+'), lambda t: t <> '')"


def _w(names: str, *steps: str) -> str:
    return "WITH " + ",\n".join([with_clause(*names.split()), *steps]) + "\n"


_TYPED = "numbers AS (SELECT t.*, 'p000-b' || lpad(n::VARCHAR, 3, '0') AS id FROM typed t)"
_MASKS = "masks AS (SELECT book, page_idx, b0 * 612.0::DOUBLE / 1000 - 2 AS x0, b1 * 792.0::DOUBLE / 1000 - 2 AS y0, b2 * 612.0::DOUBLE / 1000 + 2 AS x1, b3 * 792.0::DOUBLE / 1000 + 2 AS y1 FROM regions WHERE type IN ('table', 'chart'))"
_FOLDED = "replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss')"

# the detached numbers, step by step
_DETACHED = r"""
rows_ AS (SELECT *, CASE WHEN level = 1 THEN nullif(regexp_extract(title, '(\d+)', 1), '')::INT END AS own,
  max(CASE WHEN level = 1 THEN idx END) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS host FROM detached),
parts AS (SELECT idx, page, title, CASE WHEN level > 1 THEN host END AS host, trim(regexp_replace(regexp_replace(title, '(\d+)\.(\d+)', ' ', 'g'), '\s+', ' ', 'g')) AS txt, regexp_extract_all(title, '\d+\.\d+') AS ids FROM rows_ WHERE level = 2),
toks AS (SELECT idx, page, title, host, 0 AS sub, 'text' AS kind, txt AS value FROM parts WHERE txt <> ''
  UNION ALL SELECT idx, page, title, host, (CASE WHEN txt <> '' THEN 1 ELSE 0 END) + i, 'id', v FROM (SELECT *, unnest(ids) AS v, unnest(range(len(ids))) AS i FROM parts)),
marked AS (SELECT *, CASE WHEN kind = 'text' AND lag(kind) OVER (ORDER BY idx, sub) = 'id' THEN 1 ELSE 0 END AS fresh FROM toks),
grouped AS (SELECT *, sum(fresh) OVER (ORDER BY idx, sub) AS grp FROM marked),
ranked AS (SELECT *, row_number() OVER (PARTITION BY grp, kind ORDER BY idx, sub) AS r, count(*) FILTER (kind = 'text') OVER (PARTITION BY grp) AS nt, count(*) FILTER (kind = 'id') OVER (PARTITION BY grp) AS ni FROM grouped),
paired AS (SELECT *, CASE WHEN kind = 'text' THEN r - (nt - least(nt, ni)) ELSE r END AS pair, least(nt, ni) AS pairs FROM ranked),
sids AS (SELECT grp, pair, value AS sid, idx AS sid_idx FROM paired WHERE kind = 'id' AND pair <= pairs),
parents AS (SELECT own AS chapter, max(idx) AS target FROM rows_ WHERE level = 1 AND own IS NOT NULL GROUP BY own),
texts AS (SELECT p.idx, p.sub, p.page, p.title, p.value, p.host, h.own AS host_own, s.sid, s.sid_idx, q.target, split_part(s.sid, '.', 1)::INT AS chapter
  FROM paired p LEFT JOIN sids s ON p.grp = s.grp AND p.pair = s.pair LEFT JOIN rows_ h ON h.idx = p.host LEFT JOIN parents q ON q.chapter = split_part(s.sid, '.', 1)::INT WHERE p.kind = 'text'),
judged AS (SELECT *, sid IS NOT NULL AND target IS NOT NULL AND target IS DISTINCT FROM host AS moved, sid IS NULL AND host_own IS NOT NULL AS demoted,
  CASE WHEN sid IS NULL THEN value ELSE sid || ' ' || value END AS new FROM texts),
loose AS (SELECT * FROM paired WHERE kind = 'id' AND pair > pairs),
made AS (
  SELECT idx, sub, CASE WHEN demoted THEN 3 ELSE 2 END AS level, new AS title, page, CASE WHEN moved THEN target END AS target FROM judged
  UNION ALL SELECT idx, sub, 2, value, page, NULL FROM loose UNION ALL SELECT idx, 0, level, title, page, NULL FROM rows_ WHERE level <> 2),
led AS (SELECT *, max(CASE WHEN level <= 2 THEN idx * 1000 + sub END) OVER (ORDER BY idx, sub) AS lead_key FROM made),
placed AS (SELECT l.*, m.target AS away FROM led l LEFT JOIN made m ON m.idx * 1000 + m.sub = l.lead_key AND m.level <= 2),
rebuilt AS (SELECT 'world' AS book, (row_number() OVER (ORDER BY coalesce(away, idx), CASE WHEN away IS NULL THEN 0 ELSE 1 END, CASE WHEN away IS NULL THEN sub ELSE idx END, sub) - 1)::INT AS idx, level, title, page FROM placed),
changes AS (
  SELECT 2 AS level, page, CASE WHEN sid IS NULL THEN value WHEN sid_idx = idx THEN trim(title) ELSE value || ' | ' || sid END AS old, new,
    CASE WHEN moved THEN 'merged, moved to chapter ' || chapter WHEN sid IS NOT NULL AND NOT (sid_idx = idx AND trim(title) = new) THEN 'merged' WHEN demoted THEN 'demoted to level 3' END AS note FROM judged
  UNION ALL SELECT 2, page, value, value, 'unpaired id' FROM loose)"""

_CLEAN = "regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->', ' ', 'g')"
_LAYER = f"regexp_replace({_CLEAN}, '<[^>]*>', chr(10), 'g')"
_BLOCK_TEXTS = f"regexp_extract_all(regexp_replace({_CLEAN}, '</?(a|b|br|i|em|span|strong)( [^>]*)?>', ' ', 'g'), '<(p|h1|li|footer)>([^<]+)', 2)"
_BOOK = "'web' || (page_id // 100)"
_SIDES = f"""sides AS (SELECT page_id::INT AS page_idx, {_BOOK} AS book, {_tokens(_normalized(_LAYER, False))} AS hay, {_BLOCK_TEXTS} AS b FROM pages),
parts AS (SELECT page_idx, unnest(b) AS t, unnest(range(len(b))) AS i FROM sides)"""
_ARTIFACTS = ", ".join(f"('{n.format(stem='c')}')" for n in REQUIRED)

#: The greedy alignment, block by block, on strings: what is placed is struck out of the page.
_ALIGN = rf"""
WITH RECURSIVE {_SIDES},
toks AS (SELECT page_idx, i, {_tokens(_normalized("t || CASE WHEN i % 4 = 3 THEN ' odd' ELSE '' END"))} AS toks FROM parts),
listed AS (SELECT page_idx, list(array_to_string(toks, ' ') ORDER BY i) AS bl, list(len(toks) ORDER BY i) AS ns FROM toks GROUP BY page_idx),
start AS (SELECT s.page_idx, s.book, len(hay) AS n_hay, ' ' || array_to_string(hay, ' ') || ' ' AS orig, coalesce(bl, []) AS bl, coalesce(ns, []) AS ns FROM sides s LEFT JOIN listed l ON l.page_idx = s.page_idx),
walk AS (
  SELECT page_idx, 0 AS k, orig AS h, 1::BIGINT AS cur, 0::BIGINT AS pos FROM start
  UNION ALL
  SELECT page_idx, k + 1, CASE WHEN p > 0 THEN substr(h, 1, p) || repeat(chr(1), length(b)) || substr(h, p + 1 + length(b)) ELSE h END, CASE WHEN p > 0 THEN p + length(b) + 1 ELSE cur END, p
  FROM (SELECT w.page_idx, k, h, cur, bl[k + 1] AS b,
      CASE WHEN bl[k + 1] = '' THEN 0 WHEN strpos(substr(h, cur), ' ' || bl[k + 1] || ' ') > 0 THEN cur - 1 + strpos(substr(h, cur), ' ' || bl[k + 1] || ' ') ELSE strpos(h, ' ' || bl[k + 1] || ' ') END AS p
    FROM walk w JOIN start s ON s.page_idx = w.page_idx WHERE k < len(bl))
),
placed AS (
  SELECT w.page_idx, k - 1 AS k, ns[k] AS n, CASE WHEN pos > 0 THEN length(substr(orig, 1, pos)) - length(replace(substr(orig, 1, pos), ' ', '')) - 1 END AS s
  FROM walk w JOIN start s ON s.page_idx = w.page_idx WHERE k > 0)
"""

#: What alignment leaves, matched like the differ does: the longest common run (the first of equals), then left and right of it.
_HUNKS = _ALIGN.rstrip() + """,
cov AS (SELECT page_idx, k, s, s + n AS e FROM placed WHERE s IS NOT NULL),
spread AS (SELECT page_idx, unnest(hay) AS t, unnest(range(len(hay))) AS pos FROM sides),
p AS (SELECT h.page_idx, t, pos, row_number() OVER (PARTITION BY h.page_idx ORDER BY pos) - 1 AS i FROM spread h WHERE NOT EXISTS (SELECT 1 FROM cov c WHERE c.page_idx = h.page_idx AND pos >= c.s AND pos < c.e)),
mt AS (SELECT q.page_idx, q.k, unnest(toks) AS t, unnest(range(len(toks))) AS o FROM toks JOIN placed q ON q.page_idx = toks.page_idx AND q.k = toks.i WHERE q.s IS NULL),
m AS (SELECT *, row_number() OVER (PARTITION BY page_idx ORDER BY k, o) - 1 AS j FROM mt),
sizes AS (SELECT s.page_idx, coalesce(np, 0) AS np, coalesce(nm, 0) AS nm, coalesce(ps, []) AS ps, coalesce(ms, []) AS ms FROM sides s
  LEFT JOIN (SELECT page_idx, count(*) AS np, list(t ORDER BY i) AS ps FROM p GROUP BY page_idx) a ON a.page_idx = s.page_idx LEFT JOIN (SELECT page_idx, count(*) AS nm, list(t ORDER BY j) AS ms FROM m GROUP BY page_idx) b ON b.page_idx = s.page_idx),
same AS (SELECT p.page_idx, i, j, i - row_number() OVER (PARTITION BY p.page_idx, i - j ORDER BY i) AS g FROM p JOIN m ON p.page_idx = m.page_idx AND p.t = m.t),
eq AS (SELECT page_idx, i, j, max(i) OVER (PARTITION BY page_idx, i - j, g) - i + 1 AS n FROM same),
todo AS (
  SELECT page_idx, 0::BIGINT AS alo, np::BIGINT AS ahi, 0::BIGINT AS blo, nm::BIGINT AS bhi FROM sizes
  UNION ALL
  SELECT page_idx, CASE WHEN z = 0 THEN alo ELSE i + n END, CASE WHEN z = 0 THEN i ELSE ahi END, CASE WHEN z = 0 THEN blo ELSE j + n END, CASE WHEN z = 0 THEN j ELSE bhi END
  FROM (SELECT page_idx, alo, ahi, blo, bhi, (key + 9999999999) // 10000000000 AS n, ((key + 9999999999) // 10000000000 * 10000000000 - key) // 100000 AS i, ((key + 9999999999) // 10000000000 * 10000000000 - key) % 100000 AS j FROM (
      SELECT w.page_idx, alo, ahi, blo, bhi, max(least(e.n, ahi - e.i, bhi - e.j) * 10000000000 - e.i * 100000 - e.j) AS key
      FROM todo w JOIN eq e ON e.page_idx = w.page_idx AND e.i >= alo AND e.i < ahi AND e.j >= blo AND e.j < bhi GROUP BY w.page_idx, alo, ahi, blo, bhi)), (VALUES (0), (1)) halves(z)
  WHERE CASE WHEN z = 0 THEN alo < i AND blo < j ELSE i + n < ahi AND j + n < bhi END),
best AS (SELECT w.page_idx, max(least(e.n, ahi - e.i, bhi - e.j) * 10000000000 - e.i * 100000 - e.j) AS key FROM todo w JOIN eq e ON e.page_idx = w.page_idx AND e.i >= alo AND e.i < ahi AND e.j >= blo AND e.j < bhi GROUP BY w.page_idx, alo, ahi, blo, bhi),
matched AS (SELECT page_idx, (key + 9999999999) // 10000000000 AS n, ((key + 9999999999) // 10000000000 * 10000000000 - key) // 100000 AS i, ((key + 9999999999) // 10000000000 * 10000000000 - key) % 100000 AS j FROM best
  UNION ALL SELECT page_idx, 0, np, nm FROM sizes),
ops AS (SELECT page_idx, coalesce(lag(i + n) OVER w, 0) AS i1, i AS i2, coalesce(lag(j + n) OVER w, 0) AS j1, j AS j2 FROM matched WINDOW w AS (PARTITION BY page_idx ORDER BY i, n DESC)),
isles AS (SELECT *, sum(fresh) OVER (PARTITION BY page_idx ORDER BY i1, j1) AS g FROM (
  SELECT *, CASE WHEN i1 <= lag(i2) OVER (PARTITION BY page_idx ORDER BY i1, j1) + 2 THEN 0 ELSE 1 END AS fresh FROM ops WHERE i1 < i2 OR j1 < j2)),
merged AS (SELECT page_idx, min(i1) AS i1, max(i2) AS i2, min(j1) AS j1, max(j2) AS j2 FROM isles GROUP BY page_idx, g),
anchored AS (SELECT d.*, z.ps, z.ms, CASE
    WHEN j1 < j2 THEN (SELECT k FROM m WHERE m.page_idx = d.page_idx AND m.j = d.j1)
    ELSE coalesce((SELECT arg_max(c.k, c.e) FROM cov c JOIN p ON p.page_idx = c.page_idx AND p.i = d.i1 WHERE c.page_idx = d.page_idx AND c.e <= p.pos),
      (SELECT k FROM m WHERE m.page_idx = d.page_idx AND m.j = d.j1 - 1), (SELECT min(i) FROM toks WHERE toks.page_idx = d.page_idx AND len(toks) > 0)) END AS k
  FROM merged d JOIN sizes z ON z.page_idx = d.page_idx),
hunks AS (SELECT s.book, a.page_idx, (row_number() OVER (PARTITION BY a.page_idx ORDER BY i1, j1) - 1)::INT AS seq,
    CASE WHEN k IS NULL THEN format('p{:03d}-none', a.page_idx) ELSE format('p{:03d}-b{:03d}', a.page_idx, k) END AS anchor,
    coalesce(array_to_string(ps[greatest(0, i1 - 3) + 1 : i2 + 3], ' '), '') AS pdf_text, coalesce(array_to_string(ms[greatest(0, j1 - 3) + 1 : j2 + 3], ' '), '') AS md_text, coalesce(k % 5 = 3, false) AS math,
    coalesce(array_to_string(ps[i1 + 1 : i2], ' '), '') AS pdf_part, coalesce(array_to_string(ms[j1 + 1 : j2], ' '), '') AS md_part
  FROM anchored a JOIN sides s ON s.page_idx = a.page_idx)
"""
_COUNTED = """
counted AS (SELECT s.book, s.page_idx, n_hay AS pdf_tokens, coalesce(list_sum(ns), 0)::INT AS md_tokens, count(*) FILTER (p.s IS NOT NULL) AS matched_blocks, count(*) FILTER (p.s IS NULL AND p.n > 0) AS unmatched_blocks
  FROM start s LEFT JOIN placed p ON p.page_idx = s.page_idx GROUP BY s.book, s.page_idx, n_hay, ns)"""
_KINDS = r"""
ones AS (SELECT *, CASE WHEN md_part = '' THEN pdf_part WHEN pdf_part = '' THEN md_part END AS alone FROM hunks),
gone AS (SELECT book, pdf_part AS t, min(page_idx) AS a, max(page_idx) AS b FROM hunks WHERE pdf_part <> '' AND md_part = '' GROUP BY ALL),
came AS (SELECT book, md_part AS t, min(page_idx) AS c, max(page_idx) AS d FROM hunks WHERE md_part <> '' AND pdf_part = '' GROUP BY ALL),
moved AS (SELECT g.book, g.t, a = b AND a = c AND a = d AS one_page FROM gone g JOIN came c ON g.book = c.book AND g.t = c.t),
words AS (SELECT o.*, v.one_page, regexp_replace(pdf_part, '[\s\p{Z}\p{P}]', '', 'g') AS pl, regexp_replace(md_part, '[\s\p{Z}\p{P}]', '', 'g') AS ml, regexp_replace(pdf_part, '[^\p{L}\p{N}_]', '', 'g') AS pw, regexp_replace(md_part, '[^\p{L}\p{N}_]', '', 'g') AS mw,
    len(list_filter(string_split(md_part, ' '), lambda x: x <> '')) - len(list_filter(string_split(pdf_part, ' '), lambda x: x <> '')) AS more
  FROM ones o LEFT JOIN moved v ON v.book = o.book AND v.t = o.alone),
kinds AS (SELECT book, CASE WHEN math THEN 'inline-math' WHEN one_page IS NOT NULL THEN CASE WHEN one_page THEN 'move' ELSE 'move across pages' END
    WHEN pl = ml THEN CASE WHEN more > 0 THEN 'split' WHEN more < 0 THEN 'joined' ELSE 'punctuation' END WHEN pw = mw THEN 'symbol'
    WHEN pdf_part <> '' AND md_part <> '' THEN 'replace' WHEN md_part = '' THEN 'deletion' ELSE 'insertion' END AS kind FROM words)"""

ORACLES: dict[str, str] = {
    "align_blocks": _ALIGN + "SELECT page_idx, format('p{:03d}-b{:03d}', page_idx, k) AS id, coalesce(s, -1) AS s, coalesce(s + n, -1) AS e FROM placed",
    "guardrail_counts": _ALIGN.rstrip() + "," + _COUNTED + " SELECT * FROM counted",
    "diff_hunks": _HUNKS + "SELECT * FROM hunks",
    "hunks_per_page": _HUNKS + "SELECT book, page_idx, count(*) AS hunks FROM hunks GROUP BY ALL",
    "hunks_with_math": _HUNKS + "SELECT page_idx, count(*) AS hunks, count(*) FILTER (math) AS hunks_inline_math FROM hunks GROUP BY ALL",
    "hunk_classes": _HUNKS.rstrip() + "," + _KINDS + " SELECT book, kind, count(*) AS hunks FROM kinds GROUP BY ALL",
    "guardrail_result": _HUNKS.rstrip() + "," + _COUNTED + """,
told AS (SELECT book, count(*)::INT AS hunks, count(*) FILTER (math)::INT AS hunks_inline_math, md5(string_agg((101 + page_idx) || '|' || anchor || '|' || pdf_text || '|' || md_text, chr(10) ORDER BY page_idx, seq)) AS digest FROM hunks GROUP BY book)
SELECT c.book, count(*) AS pages, sum(pdf_tokens)::BIGINT AS pdf_tokens, sum(md_tokens)::BIGINT AS md_tokens, sum(matched_blocks)::BIGINT AS matched_blocks, sum(unmatched_blocks)::BIGINT AS unmatched_blocks,
  coalesce(any_value(l.hunks), 0) AS hunks, coalesce(any_value(hunks_inline_math), 0) AS hunks_inline_math, coalesce(any_value(digest), md5('')) AS digest
FROM counted c LEFT JOIN told l ON l.book = c.book GROUP BY c.book""",
    "chapter_reports": _HUNKS.rstrip() + r""",
kinds AS (SELECT page_idx, i, toks, ['paragraph', 'title', 'table', 'page_header', 'image'][(i % 5) + 1] AS type, format('p{:03d}-b{:03d}', page_idx, i) AS id, lower(array_to_string(toks, ' ')) AS f FROM toks),
marked AS (SELECT *, CASE WHEN type = 'table' THEN id || ':table:crops/' || id || '.png:vlm_generated'
    WHEN type = 'page_header' AND f <> '' AND NOT regexp_matches(f, '^(page\s+)?[0-9]+$|^[ivxlc]+$') AND NOT regexp_matches(f, '^(chapter|part)([^\p{L}\p{N}_]|$)') THEN id || ':text:crops/' || id || '.png:running_matter_suspect' END AS flag FROM kinds),
per AS (SELECT page_idx, count(*) AS blocks, count(*) FILTER (type = 'table') AS tables, count(*) FILTER (type = 'image') AS figures, coalesce(string_agg(flag, '|' ORDER BY id), '') AS flagged, count(*) FILTER (type IN ('paragraph', 'title')) AS body FROM marked GROUP BY page_idx),
found AS (SELECT page_idx, count(*) AS n FROM hunks GROUP BY page_idx)
SELECT s.book, s.page_idx::VARCHAR AS chapter, coalesce(blocks, 0) AS blocks, coalesce(tables, 0) AS tables, 0::BIGINT AS formulas, coalesce(figures, 0) AS figures, coalesce(n, 0) AS diff_hunks, coalesce(flagged, '') AS flagged,
  least(coalesce(body, 0), greatest(3, round_even(coalesce(body, 0) * 0.05, 0)))::INT AS spots, strftime(make_timestamp(s.page_idx::BIGINT * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS "timestamp", NULL::VARCHAR AS violation
FROM sides s LEFT JOIN per USING (page_idx) LEFT JOIN found USING (page_idx)""".replace("\\\\", "\\"),
    "outline_chapter_entries": _w("outline", _ENTRIES) + "SELECT book, idx, number, title FROM entries",
    "outline_children": _w("world") + "SELECT c.book, p.idx AS parent, c.idx AS child FROM world c JOIN world p ON p.idx < c.idx AND c.level = p.level + 1 WHERE NOT EXISTS (SELECT 1 FROM world k WHERE k.idx > p.idx AND k.idx < c.idx AND k.level <= p.level)",
    "outline_level_stats": _w("outline") + r"SELECT book, level, count(*) AS entries, count(*) FILTER (regexp_matches(title, '^\s*((?i:chapter)\s+)?\d+\b')) AS numbered FROM outline GROUP BY ALL",
    "outline_offset_candidates": _w("page_text", r"""
lines AS (SELECT book, page_idx, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM page_text),
cand AS (SELECT book, page_idx, list_concat(list_filter(l, lambda x: regexp_full_match(x, '\d{1,4}')), list_transform(list_concat(l[:2], l[-2:]), lambda x: regexp_extract(x, '^(\d{1,4})\b', 1)), list_transform(list_concat(l[:2], l[-2:]), lambda x: regexp_extract(x, '\b(\d{1,4})$', 1))) AS n FROM lines),
nums AS (SELECT DISTINCT book, page_idx, v::INT AS v FROM (SELECT book, page_idx, unnest(n) AS v FROM cand) WHERE v <> '')""") + "SELECT book, page_idx + 1 - v AS \"offset\", count(*) AS pages FROM nums GROUP BY ALL",
    "chapter_ranges": _w("outline book_pages", _RANGE_STEPS) + "SELECT * FROM ranges",
    "chapter_ranges_with_override": _w("outline book_pages overrides", _RANGE_STEPS, _RULED) + "SELECT * REPLACE (coalesce(toc_index, -1) AS toc_index) FROM ruled",
    "chapter_slug_numbers": "SELECT p_partkey, p_partkey::INT AS number, CASE WHEN p_partkey < 10 THEN 'ch0' ELSE 'ch' END || p_partkey AS slug FROM part",
    "printed_pages": _w("page_labels") + "SELECT book, page_idx, CASE WHEN regexp_full_match(label, '[0-9]+') THEN label::INT ELSE page_idx + 1 - page_offset END AS printed FROM page_labels",
    "chapter_subtree": _w("outline book_pages overrides", _RANGE_STEPS, _RULED, _SUBTREE) + "SELECT * FROM tree",
    "chapter_sections": _w("outline book_pages overrides", _RANGE_STEPS, _RULED, _SUBTREE, _SECTIONS) + "SELECT * FROM sections",
    "chapter_meta": _w("outline book_pages overrides", _RANGE_STEPS, _RULED, _SUBTREE, _SECTIONS, """
ss AS (SELECT book, number, count(*)::INT AS n_sections, md5(string_agg(concat_ws('|', section, title, pdf_page, printed_page, level), chr(10) ORDER BY idx)) AS sections FROM sections GROUP BY ALL),
ts AS (SELECT book, number, count(*)::INT AS n_subtree, md5(string_agg(concat_ws('|', level, title, page0), chr(10) ORDER BY idx)) AS subtree FROM tree GROUP BY ALL)""") + f"""
SELECT r.book, slug AS chapter, r.number, r.title, first AS first_page, last AS last_page, CASE WHEN first <= p.page_count THEN {_PRINTED.format(p="first")} ELSE -1 END AS first_printed,
  CASE WHEN last <= p.page_count THEN {_PRINTED.format(p="last")} ELSE -1 END AS last_printed, coalesce(n_sections, 0) AS n_sections, coalesce(sections, md5('')) AS sections, coalesce(n_subtree, 0) AS n_subtree, coalesce(subtree, md5('')) AS subtree
FROM ruled r JOIN book_pages p ON p.book = r.book LEFT JOIN ss ON ss.book = r.book AND ss.number = r.number LEFT JOIN ts ON ts.book = r.book AND ts.number = r.number WHERE error IS NULL""",
    "chapter_scope": _w("outline overrides readings", _ENTRIES) + "SELECT DISTINCT book, number FROM readings UNION SELECT book, number FROM (SELECT book, number FROM entries UNION SELECT book, number FROM overrides) WHERE book NOT IN (SELECT book FROM readings)",
    "patch_number_from_children": _w("unnumbered") + r"""
SELECT book, idx, level, CASE WHEN level = 1 AND n IS NOT NULL AND NOT regexp_matches(title, '^\s*((?i:chapter)\s+)?\d+\b') THEN n || ': ' || trim(title) ELSE title END AS title, page FROM (
  SELECT u.*, (SELECT arg_min(regexp_extract(c.title, '^\s*(\d+)[-.]\d+\b', 1)::INT, c.idx) FROM unnumbered c WHERE c.level = 2 AND regexp_matches(c.title, '^\s*(\d+)[-.]\d+\b') AND c.idx > u.idx
    AND c.idx < coalesce((SELECT min(k.idx) FROM unnumbered k WHERE k.idx > u.idx AND k.level = 1), 1000000000)) AS n FROM unnumbered u)""",
    "patch_rename": _w("world") + r"SELECT book, idx, level, CASE WHEN level = 2 THEN regexp_replace(title, '^([0-9]+) (.)', 'Nation \1: \2') ELSE title END AS title, page FROM world",
    "patch_insert": _w("world") + "SELECT book, (row_number() OVER (ORDER BY k) - 1)::INT AS idx, level, title, page FROM (SELECT book, idx::DOUBLE AS k, level, title, page FROM world UNION ALL SELECT book, idx + 0.5, 2, '99 NOWHERE', 42 FROM world WHERE level = 1 AND title = 'ASIA')",
    "patch_rebuild_sections": _w("detached", _DETACHED) + "SELECT * FROM rebuilt",
    "patch_changes": _w("detached", _DETACHED) + "SELECT * FROM changes WHERE note IS NOT NULL",
    "patch_changes_by_note": _w("detached", _DETACHED) + "SELECT 'world' AS book, note, count(*) AS n FROM (SELECT note FROM changes WHERE note IS NOT NULL UNION ALL SELECT '' FROM rebuilt WHERE level = 1 AND starts_with(title, 'Chapter ')) GROUP BY note",
    "blocks_from_pages": _w("typed", _TYPED) + """
SELECT doc_id, 0 AS page_idx, id, type, round_even(n % 50 + 0.5, 0)::INT AS x0, round_even(n % 40 + 1.5, 0)::INT AS y0, round_even(n + 2.4, 0)::INT AS x1, round_even(n + 100.5, 0)::INT AS y1,
  CASE WHEN type = 'title' THEN n % 3 + 1 ELSE -1 END AS level, CASE WHEN type = 'equation_interline' THEN line ELSE '' END AS math, CASE WHEN type = 'table' THEN '<t>' || line ELSE '' END AS html,
  CASE WHEN type = 'chart' OR (type = 'image' AND doc_id % 2 = 0) THEN line ELSE '' END AS content, CASE WHEN type IN ('table', 'equation_interline', 'image', 'chart') AND n % 4 <> 0 THEN 'images/' || n || '.jpg' ELSE '' END AS crop,
  CASE type WHEN 'image' THEN 'photo' WHEN 'title' THEN 'head' WHEN 'list' THEN 'bulleted' WHEN 'table' THEN 'grid' END AS sub_type FROM numbers
UNION ALL SELECT doc_id, 1, NULL, NULL, -1, -1, -1, -1, -1, '', '', '', '', NULL FROM documents WHERE doc_id % 7 = 0""",
    "block_text_math": _w("typed", _TYPED) + """
SELECT doc_id, id, CASE type WHEN 'paragraph' THEN line || ' end' WHEN 'list' THEN CASE WHEN line = '' THEN 'x' ELSE line || chr(10) || 'x' END WHEN 'table' THEN '' WHEN 'chart' THEN '' WHEN 'image' THEN '' WHEN 'equation_interline' THEN '' ELSE line END AS text,
  CASE type WHEN 'table' THEN CASE WHEN line = '' THEN 'note' ELSE line || chr(10) || 'note' END WHEN 'image' THEN line WHEN 'chart' THEN line ELSE '' END AS caption_text,
  CASE WHEN type = 'paragraph' THEN 'x _ {' || n || '}' ELSE '' END AS inline_math,
  CASE type WHEN 'paragraph' THEN CASE WHEN line = '' THEN '' ELSE line || ' ' END || 'x' || n || '  end' WHEN 'list' THEN CASE WHEN line = '' THEN 'x' ELSE line || ' ' || chr(10) || ' x' END
    WHEN 'table' THEN CASE WHEN line = '' THEN 'note' ELSE line || ' ' || chr(10) || ' note' END WHEN 'equation_interline' THEN '' ELSE line END AS block_text,
  type IN ('table', 'equation_interline', 'chart') OR (type = 'image' AND doc_id % 2 = 0 AND trim(line) <> '') AS model_made FROM numbers""",
    "vlm_flags": _w("typed", _TYPED) + """
SELECT book, doc_id::VARCHAR AS chapter, id, CASE type WHEN 'equation_interline' THEN 'formula' WHEN 'image' THEN 'figure' ELSE type END AS type,
  CASE WHEN n % 4 <> 0 THEN 'images/' || n || '.jpg' ELSE 'crops/' || id || '.png' END AS crop, 'vlm_generated' AS reason
FROM numbers WHERE type IN ('table', 'equation_interline', 'chart') OR (type = 'image' AND doc_id % 2 = 0 AND trim(line) <> '')""",
    "report_counts": _w("typed") + "SELECT book, doc_id::VARCHAR AS chapter, count(*) AS blocks, count(*) FILTER (type = 'table') AS tables, count(*) FILTER (type = 'equation_interline') AS formulas, count(*) FILTER (type IN ('image', 'chart')) AS figures FROM typed GROUP BY book, doc_id",
    "normalize_pdf_tokens": _w("glyphs", f"t AS (SELECT doc_id, {_tokens(_normalized('text'))} AS t FROM glyphs)") + "SELECT doc_id, len(t) AS tokens, md5(array_to_string(t, ' ')) AS digest FROM t",
    # the texts themselves have no compatibility characters; what is put before them has
    "normalize_nfkc": "SELECT doc_id, md5('fin 1⁄2 Å ' || nfc_normalize(text)) AS digest FROM documents",
    "spaced_caps": "SELECT doc_id, 'PARTIII of ' || lang || ' the US GDP AB' || upper(substr(lang, 1, 1)) || ' x' AS joined FROM documents",
    "flatten_latex": "SELECT c_custkey, '$' || c_custkey || 'C' || c_nationkey || '1+r2' AS flat FROM customer",
    "page_masks": _w("regions", _MASKS) + "SELECT * FROM masks",
    "masked_page_text": _w("boxed regions", _MASKS, """
seen AS (SELECT w.* FROM boxed w WHERE NOT EXISTS (SELECT 1 FROM masks m WHERE m.book = w.book AND m.page_idx = w.page_idx AND (w.x0 + w.x1) / 2 >= m.x0 AND (w.x0 + w.x1) / 2 < m.x1 AND (w.y0 + w.y1) / 2 >= m.y0 AND (w.y0 + w.y1) / 2 < m.y1)),
by_line AS (SELECT book, page_idx, line_no, string_agg(word, ' ' ORDER BY ord) AS l FROM seen GROUP BY ALL),
by_page AS (SELECT book, page_idx, string_agg(l, chr(10) ORDER BY line_no) AS t FROM by_line GROUP BY ALL)""") + "SELECT book, page_idx, md5(t) AS digest, length(t)::BIGINT AS n FROM by_page",
    "passage_first_match": f"""
WITH d AS (SELECT doc_id, ' ' || array_to_string({_tokens('text')}, ' ') || ' ' AS h FROM documents), b AS (SELECT item_id, ' ' || array_to_string({_tokens('text')}, ' ') || ' ' AS p FROM benchmark WHERE len({_tokens('text')}) > 0)
SELECT item_id, doc_id, length(left(h, strpos(h, p) - 1)) - length(replace(left(h, strpos(h, p) - 1), ' ', '')) AS pos FROM d JOIN b ON contains(h, p)""",
    "page_token_counts": f"""
WITH {_SIDES},
md AS (SELECT page_idx, sum(len({_tokens(_normalized("t || CASE WHEN i % 4 = 3 THEN ' odd' ELSE '' END"))}))::BIGINT AS md_tokens, count(*) AS blocks FROM parts GROUP BY page_idx)
SELECT page_idx, len(hay)::BIGINT AS pdf_tokens, md_tokens, coalesce(blocks, 0) AS blocks FROM sides LEFT JOIN md USING (page_idx)""",
    "running_matter_suspects": _w("heads", f"matter AS (SELECT *, {_FOLDED} AS f FROM heads WHERE type <> 'paragraph')", "counted AS (SELECT f, book, count(DISTINCT page_idx) AS pages FROM matter GROUP BY ALL)") + r"""
SELECT m.book, m.id FROM matter m JOIN counted c ON m.book = c.book AND m.f = c.f
WHERE m.f <> '' AND NOT regexp_matches(m.f, '^(page\s+)?[0-9]+$|^[ivxlc]+$') AND NOT regexp_matches(m.f, '^(chapter|part)\b') AND pages < 2 AND NOT contains(m.f, 'the and')""",
    "spot_sample": _w("heads", "ranked AS (SELECT book, id, row_number() OVER (PARTITION BY book, chapter ORDER BY sha256(book || chapter || id), id) AS k, count(*) OVER (PARTITION BY book, chapter) AS n FROM heads WHERE type = 'paragraph')") + "SELECT book, id FROM ranked WHERE k <= least(n, greatest(3, round_even(n * 0.05, 0)))",
    "report_violations": "SELECT c_custkey, ['$', 'pages', 'pages', 'extraction', 'counts.diff_hunks', 'diff_hunks[1].page', 'flagged_blocks[0].type', 'spot_check[0]', 'status', 'counts.tables', '$', '$'][c_custkey % 13] AS path FROM customer WHERE c_custkey % 13 <> 0",
    "artifact_contract": f"""
WITH docs AS (SELECT doc_id, doc_id::VARCHAR AS chapter, n_chars % 40 + 1 AS pages FROM documents), names(name) AS (VALUES {_ARTIFACTS}),
missing AS (SELECT doc_id, 'missing ' || string_agg(name, ', ' ORDER BY name) AS m FROM docs CROSS JOIN names WHERE (doc_id % 5 = 0 AND name = 'images') OR (doc_id % 10 = 0 AND name = 'c.md') GROUP BY doc_id),
f AS (SELECT d.*, m.m, CASE WHEN doc_id % 9 = 0 THEN 0 WHEN doc_id % 7 = 0 THEN pages - 1 ELSE pages END AS found, CASE WHEN doc_id % 8 = 0 THEN pages + 1 ELSE pages - 2 END AS last FROM docs d LEFT JOIN missing m USING (doc_id))
SELECT 'src' AS book, chapter, CASE WHEN m IS NOT NULL THEN m WHEN found <> pages THEN found || ' pages extracted, ' || pages || ' expected' ELSE 'page ' || last || ' beyond ' || found || ' pages' END AS fault
FROM f WHERE m IS NOT NULL OR found <> pages OR last >= found""",
    "intake_check": _w("page_text outline", """
spans AS (SELECT book, count(*) AS pages, max(page_idx) + 1 AS stop FROM page_text GROUP BY book),
sample AS (SELECT p.book, count(*) AS sampled, count(*) FILTER (trim(text) <> '') AS with_text FROM page_text p JOIN spans s ON p.book = s.book WHERE page_idx >= 1 AND (page_idx - 1) % greatest(1, (stop - 1) // 20) = 0 GROUP BY p.book),
tops AS (SELECT book, count(*) AS outline_entries, count(*) FILTER (level = 1) AS outline_top_level, array_to_string((list(title ORDER BY idx) FILTER (level = 1))[:5], '|') AS titles FROM outline WHERE book <> 'src4' GROUP BY book)""") + """
SELECT s.book, s.pages, with_text || '/' || sampled AS text_layer_sample, coalesce(outline_entries, 0) AS outline_entries, coalesce(outline_top_level, 0) AS outline_top_level, coalesce(titles, '') AS first_titles,
  array_to_string(list_filter([CASE WHEN with_text < sampled THEN (sampled - with_text) || ' of ' || sampled || ' sampled pages have no text' END, CASE WHEN outline_entries IS NULL THEN 'no outline and no chapter ranges' END], lambda x: x IS NOT NULL), '|') AS faults
FROM spans s JOIN sample USING (book) LEFT JOIN tops USING (book)""",
    # the fifth source has no offset, so only its numeric labels count
    "probe_check": _w("outline book_pages overrides readings", _RANGE_STEPS, _RULED, _SUBTREE, """
listed AS (SELECT book, number FROM readings UNION SELECT DISTINCT book, 77777 FROM readings),
scope AS (SELECT book, number FROM listed UNION SELECT book, number FROM (SELECT book, number FROM entries UNION SELECT book, number FROM overrides) WHERE book NOT IN (SELECT book FROM readings)),
needed AS (SELECT book, number, unnest([first, last]) AS page FROM ruled WHERE error IS NULL UNION SELECT book, number, page0 FROM tree WHERE level = 3),
bare AS (SELECT n.book, n.number, min(page) AS page FROM needed n JOIN book_pages p ON p.book = n.book WHERE page < 0 OR page > page_count OR (n.book = 'src5' AND page % 3 <> 0) GROUP BY ALL)""") + """
SELECT s.book, s.number, CASE WHEN r.book IS NULL THEN 'not in the outline' WHEN r.error IS NOT NULL THEN r.error WHEN b.page IS NOT NULL THEN 'page ' || b.page || ' has no numeric label or offset' END AS fault
FROM scope s LEFT JOIN ruled r ON s.book = r.book AND s.number = r.number LEFT JOIN bare b ON s.book = b.book AND s.number = b.number""",
}
ORACLES["probe_evidence"] = (
    ORACLES["outline_offset_candidates"].replace('SELECT book, page_idx + 1 - v AS "offset", count(*) AS pages FROM nums GROUP BY ALL', "")
    + ', counted AS (SELECT book, page_idx + 1 - v AS "offset", count(*) AS pages FROM nums GROUP BY ALL) SELECT book, "offset", pages, row_number() OVER (PARTITION BY book ORDER BY pages DESC, "offset") AS k FROM counted QUALIFY k <= 3'
)
