"""DuckDB SQL for the results of the operators that SQL can express, written from the contracts, over whole tables."""

from __future__ import annotations

from lakeops.llm.chat import CONTROL, END, START, TEXT
from lakeops.llm.urls import DAMPING, TOLERANCE

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS s
        FROM i, UNNEST(range(1, len(w) - least(10, len(w)) + 2)) AS t(k) WHERE len(w) > 0),
dw AS (SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS s
       FROM d, (SELECT DISTINCT n FROM win) AS l, UNNEST(range(1, len(w) - n + 2)) AS t(k) WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, n, k, item_id FROM dw JOIN win USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, n, k FROM hit), UNNEST(range(k, k + n)) AS t(p) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

REPEATS = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 49)) AS i,
             unnest(list_transform(range(0, length(h) // 2 - 49), lambda i: substr(h, 2 * i + 1, 100))) AS s FROM b WHERE length(h) >= 100),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
gone AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE first < doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM gone),
run AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM run GROUP BY ALL),
pieces AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
cut AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
               string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM pieces JOIN b USING (doc_id) GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + least(4, len(w)) - 1), ' ') AS g
      FROM d, UNNEST(range(1, len(w) - least(4, len(w)) + 2)) AS t(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s AS x JOIN s AS y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT b, c FROM r JOIN links ON a = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

INFILL = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT doc_id, text, w, len(w) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM u),
c AS (SELECT doc_id, text, w, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, array_to_string(list_slice(w, 1, a), '') AS prefix, array_to_string(list_slice(w, a + 1, b), '') AS middle,
             array_to_string(list_slice(w, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for c in CONTROL:
        out = f"replace({out}, {_text(c)}, {_text(c[0] + chr(92) + c[1:])})"
    return out


CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum({len(START + TEXT + END)} + length({_escaped("role")}) + length({_escaped("text")})) AS formatted_chars
      FROM c GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars FROM g
"""


def url_filter(rules, rounds: int = 48, damping: float = DAMPING) -> str:
    """``rounds`` leave less than the tolerance unspread, and reach every host that is at most as many links away."""
    assert damping ** rounds <= TOLERANCE
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    table = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)}, {_text(h + p)})" for h, p, v in rules)
    return rf"""
WITH RECURSIVE rules(rhost, rpath, rverdict, rule) AS (VALUES {table}),
u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS verdict
        FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1),
j AS (SELECT p.page_id, p.host, p.path, fit.rule, fit.verdict FROM p LEFT JOIN fit USING (page_id)),
chain AS (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.') AS src
          FROM (SELECT DISTINCT host FROM p WHERE host <> ''), UNNEST(range(1, len(string_split(host, '.')) + 1)) AS t(i)),
up AS (SELECT src, regexp_replace(src, '^[^.]*\.', '') AS dst FROM chain),
links AS (SELECT host AS src, {lower.format("x")} AS dst
          FROM p, UNNEST(regexp_extract_all(html, '(?i)href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''>\s]+)', 1)) AS t(x) WHERE host <> ''),
edges AS (SELECT src, dst, count(*) AS weight FROM (
            SELECT src, dst FROM links WHERE src <> dst
            UNION ALL SELECT src, dst FROM up WHERE src <> dst AND len(string_split(dst, '.')) >= 2
            UNION ALL SELECT dst, src FROM up WHERE src <> dst AND len(string_split(dst, '.')) >= 2) GROUP BY ALL),
kinds AS (SELECT 1 AS kind, src, dst, weight FROM edges UNION ALL SELECT -1, dst, src, weight FROM edges),
steps AS MATERIALIZED (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS share FROM kinds),
seeds AS (SELECT host, count(*) FILTER (WHERE verdict = 'allow') AS a, count(*) FILTER (WHERE verdict = 'block') AS b FROM j GROUP BY 1),
total AS (SELECT greatest(1, sum(a) + sum(b)) AS n FROM seeds),
r0 AS MATERIALIZED (SELECT 1 AS kind, host, a / n AS rank FROM seeds, total WHERE a > 0 UNION ALL SELECT -1, host, b / n FROM seeds, total WHERE b > 0),
walk AS (SELECT 0 AS i, kind, host, rank FROM r0 UNION ALL
         SELECT w.i + 1, s.kind, s.dst, sum(w.rank * s.share * {damping}) FROM walk AS w JOIN steps AS s ON w.kind = s.kind AND w.host = s.src
         WHERE w.i < {rounds} GROUP BY ALL),
ranks AS (SELECT kind, host, sum(rank * CASE WHEN i < {rounds} THEN 1 - {damping} ELSE 1 END) AS rank FROM walk GROUP BY ALL),
scores AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 1), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = -1), 0) AS distrust
           FROM ranks GROUP BY 1)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.verdict, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN scores USING (host)
"""
