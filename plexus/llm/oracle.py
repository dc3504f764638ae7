"""DuckDB SQL of the training-data queries that SQL can state whole."""

from __future__ import annotations

from plexus.llm import quality_rules as quality
from plexus.llm import url_filter as urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_sql(rules: list[urls.Rule]) -> str:
    k = urls.ORDER
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN" for r in ranked]
    rule = "CASE " + " ".join(f"{f} '{r.text}'" for f, r in zip(fits, ranked, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"{f} '{r.verdict}'" for f, r in zip(fits, ranked, strict=True)) + " END"
    orders = []
    for o in range(k + 1):
        low = f"1.0 / {urls.ALPHABET}"
        q = {c: f"l.q_{c}" if o else low for c in ("acc", "rej")}
        below = f"JOIN q{o - 1} l ON l.x = substr(c.x, 2, {o})" if o else ""
        p = ", ".join(f"CASE WHEN n.n_{c} > 0 THEN (c.{c} + n.t_{c} * {q[c]}) / (n.n_{c} + n.t_{c}) ELSE {q[c]} END AS q_{c}"
                      for c in ("acc", "rej"))
        orders.append(f"""
c{o} AS (SELECT substr(g, {k + 1 - o}, {o + 1}) AS x, sum(acc) AS acc, sum(rej) AS rej FROM grams GROUP BY 1),
n{o} AS (SELECT substr(x, 1, {o}) AS ctx, sum(acc) AS n_acc, sum(rej) AS n_rej,
  CAST(count(*) FILTER (WHERE acc > 0) AS DOUBLE) AS t_acc, CAST(count(*) FILTER (WHERE rej > 0) AS DOUBLE) AS t_rej
  FROM c{o} GROUP BY 1),
q{o} AS (SELECT c.x, {p} FROM c{o} c JOIN n{o} n ON n.ctx = substr(c.x, 1, {o}) {below})""")
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(instr(url, '://'), 0) > 0 AS ok, substr(url, instr(url, '://') + 3) AS rest FROM pages),
base AS (
  SELECT page_id, ok,
    CASE WHEN ok THEN translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM parts),
urls AS (
  SELECT row_number() OVER () AS r, page_id, host, path, ok,
    CASE WHEN ok THEN {rule} END AS rule, CASE WHEN ok THEN {verdict} END AS ruled,
    CASE WHEN ok THEN '{"^" * k}' || regexp_replace(regexp_replace(translate(host || path, '{_UPPER}', '{_LOWER}'),
      '[0-9]', '0', 'g'), '[^a-z0./\\-_]', '~', 'g') || '$' END AS s,
    CAST('0x' || substr(md5(host), 1, 8) AS BIGINT) % {urls.FOLDS} = 0 AS calibrates
  FROM base),
spots AS (SELECT r, substr(s, i, {k + 1}) AS g, ruled, calibrates
       FROM (SELECT *, unnest(range(1, length(s) - {k} + 1)) AS i FROM urls WHERE ok)),
grams AS (
  SELECT g, CAST(count(*) FILTER (WHERE NOT calibrates AND ruled = 'allow') AS DOUBLE) AS acc,
    CAST(count(*) FILTER (WHERE NOT calibrates AND ruled = 'block') AS DOUBLE) AS rej FROM spots GROUP BY g),
{",".join(orders)},
scores AS (SELECT r, sum(ln(q_acc) - ln(q_rej)) / count(*) AS score FROM spots JOIN q{k} ON x = g GROUP BY r),
bins AS (
  SELECT floor(least(greatest(score, -20.0), 20.0) * {urls.BINS}) AS b,
    count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS j
  FROM urls JOIN scores USING (r) WHERE ruled IS NOT NULL AND calibrates GROUP BY 1),
total AS (SELECT coalesce(sum(a), 0) AS n_a, coalesce(sum(j), 0) AS n_j FROM bins),
curve AS (
  SELECT b, (n_a - sum(a) OVER w) / CAST(n_a AS DOUBLE) + sum(j) OVER w / CAST(n_j AS DOUBLE) AS quality
  FROM bins, total WHERE n_a > 0 AND n_j > 0 WINDOW w AS (ORDER BY b)),
cut AS (
  SELECT CASE WHEN n_a = 0 OR n_j = 0 THEN 0.0 ELSE coalesce(
    (SELECT (b + 1) / {urls.BINS} FROM curve WHERE quality > 1.0 ORDER BY quality DESC, b LIMIT 1), -20.0) END AS cut FROM total)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN score >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM urls LEFT JOIN scores USING (r)"""


def quality_sql() -> str:
    n_rules, space, word = len(quality.RULES), r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
    level = f"{quality.DELTA} / ((SELECT count(DISTINCT stratum) FROM docs) * {n_rules} * {len(quality.CUTOFFS)})"
    p = quality.ALPHA / n_rules
    tests = " UNION ALL ".join(
        f"""SELECT stratum, '{r}' AS rule, {c} AS cutoff, count(*) FILTER (WHERE good) AS n,
  count(*) FILTER (WHERE good AND {r} > {c}) AS k, count(*) FILTER (WHERE NOT good AND {r} > {c}) AS caught
FROM held GROUP BY stratum""" for r in quality.RULES for c in quality.CUTOFFS)
    passed = " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM best b WHERE b.stratum = x.stratum AND b.rule = '{r}' AND x.{r} > b.cutoff)" for r in quality.RULES)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(lang, 'und') AS stratum FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '{space}'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM docs),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM words WHERE len(ws) >= 8)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cover AS (SELECT r, CAST(sum(least(8, i - prev)) AS BIGINT) AS n
          FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS prev FROM dup) GROUP BY r),
counts AS (
  SELECT doc_id, stratum, t, len(ws) AS n_words, length(regexp_replace(t, '{space}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(t) - length(replace(t, '!', '')) AS n_shouts, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_caps
  FROM words LEFT JOIN cover USING (r)),
x AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS failed,
    n_symbols / CAST(greatest(word_chars, 1) AS DOUBLE) AS symbol_rate,
    n_dup_lines / CAST(greatest(n_lines, 1) AS DOUBLE) AS dup_line_rate,
    n_repeat_words / CAST(greatest(n_words, 1) AS DOUBLE) AS repeat_rate,
    n_shouts / CAST(greatest(word_chars, 1) AS DOUBLE) AS shout_rate,
    n_caps / CAST(greatest(word_chars, 1) AS DOUBLE) AS caps_rate
  FROM counts),
held AS (
  SELECT stratum, t, bool_and(l.label = 1) AS good, {", ".join(f"any_value({r}) AS {r}" for r in quality.RULES)} FROM x JOIN (
    SELECT doc_id, min(quality) AS label FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id) l
  USING (doc_id) WHERE NOT failed GROUP BY stratum, t),
tests AS ({tests}),
certified AS (
  SELECT * FROM tests WHERE caught > {quality.GOOD_WEIGHT} * k AND n > 0 AND k < n * {p} AND list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) <= {level}),
best AS (
  SELECT stratum, rule, cutoff FROM (SELECT *, row_number() OVER (
    PARTITION BY stratum, rule ORDER BY caught - {quality.GOOD_WEIGHT} * k DESC, cutoff DESC) AS o FROM certified) WHERE o = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
  NOT failed AND {passed} AS kept FROM x"""


def collocations_sql(least: int, top: int, order: int) -> str:
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\n\\v\\f\\r]')) AS p FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
spots AS (SELECT lang, w, unnest(range(1, {order + 1})) AS k FROM words),
runs AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM spots),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, CAST(count(*) AS HUGEINT) AS a
  FROM runs GROUP BY 1, 2, 3 HAVING count(*) >= {least}),
cand AS (SELECT lang, k, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1),
inner_ AS (SELECT c.lang, c.a, c.w, s.size, i.spot FROM cand c, range(2, {order}) s(size), range(1, {order}) i(spot)
  WHERE s.size < c.k AND i.spot + s.size - 1 <= c.k),
longer AS (SELECT lang, array_to_string(w[spot:spot + size - 1], ' ') AS g, max(a) AS longer FROM inner_ GROUP BY 1, 2),
left_ AS (SELECT c.* FROM cand c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
  WHERE o.longer IS NULL OR o.longer * 100 < c.a * 100),
cuts AS (SELECT c.lang, c.g, c.a, x.cut, array_to_string(w[1:x.cut], ' ') AS u, array_to_string(w[x.cut + 1:], ' ') AS v
  FROM left_ c, range(1, {order}) x(cut) WHERE x.cut < c.k),
scored AS (SELECT c.lang, c.g, c.cut, c.a, u.a AS l, v.a AS r, t.n, (1000 * c.a * t.n) // (u.a * v.a) AS score
  FROM cuts c JOIN f u ON u.lang = c.lang AND u.g = c.u JOIN f v ON v.lang = c.lang AND v.g = c.v
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""


def ranked_search_sql(k: int) -> str:
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS t FROM documents),
total AS (SELECT count(*) AS nd, sum(len(t)) AS nt FROM d WHERE len(t) > 0),
tf AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(t) AS t FROM d) GROUP BY 1, 2),
q AS (SELECT DISTINCT item_id, text FROM benchmark),
qt AS (SELECT DISTINCT item_id, text, unnest({terms}) AS t FROM q),
df AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * (SELECT nd FROM total) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf GROUP BY t),
m AS (SELECT row, doc_id, 100 - 90 + (90 * len(t) * nd) // nt AS m FROM d, total WHERE len(t) > 0),
scores AS (SELECT qt.item_id, qt.text, m.doc_id, m.row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM qt JOIN tf USING (t) JOIN df USING (t) JOIN m USING (row) GROUP BY 1, 2, 3, 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
