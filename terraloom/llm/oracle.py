"""SQL counterparts of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from itertools import permutations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SIZE = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+'))"

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, n, array_slice(ws, k, k + n - 1) AS win
        FROM (SELECT item_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS k FROM b)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, k, array_slice(ws, k, k + n - 1) AS win
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT doc_id, item_id, k, dw.n FROM dw JOIN win ON dw.n = win.n AND dw.win = win.win),
n_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_REACH = """
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS {0}, least(a, min(b)) AS {1} FROM reach GROUP BY a),
deg AS (SELECT a AS {0}, count(*) AS n_links FROM link GROUP BY a)
"""

OP5 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
pair AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e)) / sqrt(list_dot_product(y.e, y.e)) >= 0.98),
{_REACH.format("vec_id", "component_id")}
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN comp USING (vec_id) LEFT JOIN deg USING (vec_id)
"""

OP6 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, ws, least(5, len(ws)) AS n FROM (SELECT doc_id, {_WORDS} AS ws FROM documents)),
s AS (SELECT DISTINCT doc_id, array_to_string(array_slice(ws, k, k + n - 1), ' ') AS g
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM w WHERE n > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
pair AS (SELECT a, b FROM shared JOIN size p ON a = p.doc_id JOIN size q ON b = q.doc_id WHERE 5 * shared.n >= 4 * (p.n + q.n - shared.n)),
{_REACH.format("doc_id", "class_id")},
copies AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sum) AS copy_of FROM (SELECT doc_id, string_agg(g, '|' ORDER BY g) AS sum FROM s GROUP BY 1))
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(copy_of, d.doc_id) AS copy_of,
       coalesce(class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN comp ON comp.doc_id = d.doc_id LEFT JOIN deg ON deg.doc_id = d.doc_id LEFT JOIN copies ON copies.doc_id = d.doc_id
"""

OP8 = rf"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, [trim(regexp_replace(x, '\r$', ''), ' ') FOR x IN string_split(text, chr(10))] AS cs FROM documents),
line AS (SELECT doc_id, p, cs, {_SIZE.format("ls[p]")} AS w FROM (SELECT doc_id, ls, cs, unnest(range(1, len(ls) + 1)) AS p FROM doc)),
cum AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM line),
onward AS (SELECT x.doc_id, x.p AS first, min(y.p) AS last FROM cum x JOIN cum y ON x.doc_id = y.doc_id AND y.p >= x.p AND y.upto - x.upto + x.w >= 50 GROUP BY 1, 2),
upto AS (SELECT y.doc_id, max(x.p) AS first, y.p AS last FROM cum x JOIN cum y ON x.doc_id = y.doc_id AND y.p >= x.p AND y.upto - x.upto + x.w >= 50 GROUP BY 1, 3),
run AS (SELECT doc_id, first, last, array_slice(cs, first, last) AS body
        FROM (SELECT * FROM onward UNION SELECT * FROM upto) JOIN doc USING (doc_id)),
seen AS (SELECT doc_id, first, last, min((doc_id, first)) OVER (PARTITION BY body) < (doc_id, first) AS later FROM run),
gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(first, last + 1)) AS p FROM seen WHERE later) GROUP BY 1)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string([ls[k] FOR k IN range(1, len(ls) + 1) IF NOT list_contains(gone, k)], chr(10)) END AS text
FROM doc LEFT JOIN gone USING (doc_id)
"""

_ESCAPED = r"regexp_replace({0}, '(\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[/TURN\])', '\\\1', 'g')"

OP9 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(CASE role WHEN 'human' THEN 'user' WHEN 'prompter' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant'
         WHEN 'model' THEN 'assistant' ELSE role END, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (SELECT *, length({_ESCAPED.format("text")}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
        ELSE 6 + 7 + 7 + length({_ESCAPED.format("role")}) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, text, source, CAST({_SIZE.format("text")} AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM s),
c AS (SELECT *, CAST([5.0, 2.0, 1.0][rank % 3 + 1] AS DOUBLE) AS w, CAST(source_size * 3 AS DOUBLE) AS cap FROM r),
l AS (SELECT *, cap / w AS ratio, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
o AS (SELECT arg_min(level, (ratio, rank)) AS level FROM l WHERE ratio > level),
t AS (SELECT source, source_size, CASE WHEN o.level IS NULL OR ratio <= o.level THEN cap ELSE w * o.level END AS target FROM l LEFT JOIN o ON true),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST('0x' || substr(md5('mix' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM x
"""

OP11 = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab),
fate AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f FROM conversations, crc),
r AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM fate WHERE f <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text)) AS p, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM r),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS seen FROM o),
g AS (SELECT *, ending = '' AS blank, ending <> '' AND seen > 1 AS dup, seen = 1 AND ending NOT IN ('', '.', '!', '?') AS cut, left(role, 1) AS s,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM q),
ids AS (SELECT DISTINCT conv_id FROM conversations),
hop AS (SELECT * FROM (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')) AS v(a, b, ins)),
nxt AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) AS v(b, sym, c)),
edit AS (SELECT a, b AS c, ins || 'D' AS e, 2 * length(ins) + 3 AS w, NULL AS need, NULL AS sym FROM hop
  UNION ALL SELECT a, c, ins || 'K', 2 * length(ins), true, sym FROM hop JOIN nxt USING (b)
  UNION ALL SELECT a, c, ins || 'R', 2 * length(ins) + 2, false, sym FROM hop JOIN nxt USING (b) WHERE sym <> 's'),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS p, 0 AS st, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS best FROM ids
  UNION ALL
  SELECT dp.conv_id, dp.p + 1, c, min({{'cost': best.cost + w + CASE WHEN need IS NOT NULL AND cut THEN 1 ELSE 0 END, 'audit': best.audit || e}})
  FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.p = dp.p + 1
    JOIN edit ON a = st AND (need IS NULL OR (NOT blank AND NOT dup AND (NOT need OR s = sym)))
  GROUP BY dp.conv_id, dp.p, c),
n AS (SELECT ids.conv_id, count(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (before || s NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ids LEFT JOIN g ON ids.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY 1),
fin AS (SELECT n.conv_id, min({{'cost': best.cost + 2 * length(ins), 'audit': best.audit || ins}}) AS best
  FROM n JOIN dp ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.p = n.n JOIN hop ON a = st AND b IN (0, 3) GROUP BY 1),
steps AS (SELECT conv_id, k, substr(best.audit, k, 1) AS e, length(replace(substr(best.audit, 1, k), 'I', '')) AS p
  FROM (SELECT *, unnest(range(1, length(best.audit) + 1)) AS k FROM fin)),
outs AS (SELECT steps.conv_id, k, e, row_number() OVER (PARTITION BY steps.conv_id ORDER BY k) AS place, role, text,
    first_value(e = 'K' AND s = 's') OVER (PARTITION BY steps.conv_id ORDER BY k) AS sys
  FROM steps LEFT JOIN g ON e <> 'I' AND g.conv_id IS NOT DISTINCT FROM steps.conv_id AND g.p = steps.p WHERE e <> 'D'),
said AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role || ':' || text ELSE CASE WHEN (place % 2 = 1) <> sys THEN 'user:' ELSE 'assistant:' END
      || CASE WHEN e = 'I' THEN '' ELSE text END END, chr(10) ORDER BY k) AS body FROM outs GROUP BY 1)
SELECT n.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM n JOIN fin ON n.conv_id IS NOT DISTINCT FROM fin.conv_id LEFT JOIN said ON n.conv_id IS NOT DISTINCT FROM said.conv_id
"""

_STEPS = ", ".join(f"'{''.join(p)}'" for p in permutations("ABCDE"))

OP13 = rf"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT part, CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' ELSE '' END AS fails,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w LEFT JOIN said USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM d GROUP BY 1, 2),
o AS (SELECT unnest([{_STEPS}]) AS filter_order),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
x AS (SELECT part, filter_order, step, f, fails, n, g, t, contains(fails, f) AS failing,
        len(list_filter(string_split(fails, ''), lambda k: k <> '' AND contains(earlier, k))) > 0 AS gone FROM c, s),
r AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN NOT gone AND failing THEN g ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND failing THEN t ELSE 0 END) AS toxic_lost FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

ORACLE = {
    "op4_decontaminate": OP4, "op5_vector_dedup": OP5, "op6_ngram_join": OP6, "op8_line_dedup": OP8, "op9_chat": OP9, "op10_mixing": OP10,
    "op11_conversation_repair": OP11, "op13_filter_audit": OP13,
}
