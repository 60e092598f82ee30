"""SQL twins of the queries that SQL can express over whole tables."""

from .decontaminate import WINDOW_WORDS
from .lexical import TOP
from .url_filter import LEAST_STRENGTH, MAX_BAD, MOST_STRENGTH, TWO_LABEL_SUFFIXES, Z

_WORD = r"[^\x20\x09-\x0D]+"

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
rows_ AS (SELECT *, length(bin(size))::BIGINT AS merit FROM sized),
groups_ AS (SELECT source, merit, sum(size)::BIGINT AS words FROM rows_ GROUP BY ALL),
sources AS (
  SELECT source, sum(words)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM groups_ GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][(place - 1) % 3 + 1]::BIGINT AS weight, 2 * source_size AS cap FROM sources),
levels AS (
  SELECT *, row_number() OVER room AS ord,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS lvl
  FROM weighted WINDOW room AS (ORDER BY cap::DOUBLE / weight::DOUBLE, place)),
lev AS (SELECT min_by(l.lvl, l.ord) AS water FROM levels l WHERE l.lvl * l.weight <= l.cap),
targets AS (
  SELECT source, source_size,
    coalesce(least(cap::DOUBLE, lev.water * weight), cap::DOUBLE) AS target
  FROM levels LEFT JOIN lev ON true),
scales AS (
  SELECT g.source, g.merit, g.words, t.source_size, t.target,
    (t.target - (coalesce(sum(words) OVER (d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)::DOUBLE)
    / nullif(sum(words * merit) OVER (d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS scale
  FROM groups_ g JOIN targets t ON g.source IS NOT DISTINCT FROM t.source
  WINDOW d AS (PARTITION BY g.source ORDER BY g.merit DESC)),
fit AS (SELECT s.source, max_by(s.scale, s.merit) AS best FROM scales s WHERE s.scale * s.merit <= 2 GROUP BY s.source),
classes AS (
  SELECT s.source, s.merit, s.words, s.source_size, s.target,
    coalesce(least(2::DOUBLE, f.best * s.merit), 2::DOUBLE) AS copies
  FROM scales s LEFT JOIN fit f ON s.source IS NOT DISTINCT FROM f.source),
parts AS (
  SELECT *, floor(copies)::BIGINT AS certain, copies - floor(copies) AS chance,
    target - (sum(floor(copies)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS need
  FROM classes),
ranked AS (
  SELECT r.*, p.source_size, p.target, p.certain, p.need,
    CASE WHEN p.chance > 0 THEN ((u / (1 - u)) / (p.chance / (1 - p.chance)))
      / (1 + (u / (1 - u)) / (p.chance / (1 - p.chance))) END AS rnk
  FROM rows_ r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source AND r.merit = p.merit),
running AS (
  SELECT *, CASE WHEN rnk IS NOT NULL THEN sum(size) OVER (PARTITION BY source, rnk IS NULL ORDER BY rnk, size) END AS upto
  FROM ranked),
cut AS (
  SELECT source, max(need) - coalesce(max(CASE WHEN upto <= need THEN upto END), 0)::DOUBLE AS gap
  FROM running WHERE rnk IS NOT NULL GROUP BY source),
together AS (
  SELECT r.source, r.rnk, r.size, c.gap, (count(*) * r.size)::DOUBLE AS words
  FROM running r JOIN cut c ON r.source IS NOT DISTINCT FROM c.source
  WHERE r.upto > r.need AND r.size > 0 AND r.size < 2 * c.gap GROUP BY r.source, r.rnk, r.size, c.gap),
extra AS (
  SELECT source, rnk, size FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(gap - words), rnk, size) AS n
    FROM together WHERE abs(gap - words) < gap) WHERE n = 1)
SELECT r.doc_id, r.size, r.source_size, r.target,
  ((r.certain + CASE WHEN coalesce(r.upto <= r.need, false) OR e.rnk IS NOT NULL THEN 1 ELSE 0 END) * r.size)::BIGINT AS taken
FROM running r LEFT JOIN extra e
  ON r.source IS NOT DISTINCT FROM e.source AND r.rnk = e.rnk AND r.size = e.size
"""

_SUFFIXES = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _strength(groups: str) -> str:
    """Moment estimate of a level's strength from rows of ``bad, n, prior``."""
    return f"""
  SELECT CASE WHEN g = 0 THEN {LEAST_STRENGTH}::DOUBLE WHEN rho > 0 THEN least({MOST_STRENGTH}::DOUBLE, greatest({LEAST_STRENGTH}::DOUBLE, 1 / rho - 1))
    ELSE {MOST_STRENGTH}::DOUBLE END AS m
  FROM (SELECT CASE WHEN sum(n) > count(*) THEN
      (sum(pow(bad / n - prior, 2) * n / (prior * (1 - prior))) - count(*)) / (sum(n) - count(*))::DOUBLE
      ELSE 0 END AS rho, count(*) AS g FROM {groups})"""


_URLS = rf"""
WITH parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
named AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:\d*)?$', '') AS name FROM (SELECT DISTINCT host FROM parsed)),
two AS (SELECT *, array_to_string(string_split(name, '.')[-2:], '.') AS two FROM named),
levels AS (
  SELECT host,
    CASE WHEN two IN ({_SUFFIXES}) THEN array_to_string(string_split(name, '.')[-3:], '.') ELSE two END AS domain,
    CASE WHEN len(string_split(name, '.')) < 2 THEN name WHEN two IN ({_SUFFIXES}) THEN two
      ELSE string_split(name, '.')[-1] END AS suffix
  FROM two),
hosts AS (
  SELECT p.host, l.domain, l.suffix, count(*)::DOUBLE AS n, sum((b.quality = 0 OR b.toxic = 1)::INT)::DOUBLE AS bad
  FROM parsed p JOIN labels b ON p.page_id = b.doc_id JOIN levels l ON p.host = l.host
  WHERE (b.quality = 0 OR b.toxic = 1) IS NOT NULL GROUP BY ALL),
root AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS rate FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(root.rate) AS prior FROM hosts, root GROUP BY suffix),
ms AS ({_strength("s0")}),
s1 AS (SELECT suffix, (prior * m + bad) / (m + n) AS rate FROM s0, ms),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(s1.rate) AS prior FROM hosts JOIN s1 USING (suffix) GROUP BY ALL),
md AS ({_strength("d0")}),
d1 AS (SELECT domain, (prior * m + bad) / (m + n) AS rate FROM d0, md),
h0 AS (SELECT host, n, bad, d1.rate AS prior FROM hosts JOIN d1 USING (domain)),
mh AS ({_strength("h0")}),
h1 AS (SELECT host, (prior * m + bad) / (m + n) AS rate, n + m AS weight FROM h0, mh),
rated AS (
  SELECT l.host, coalesce(h1.rate, d1.rate, s1.rate, root.rate) AS rate, coalesce(h1.weight, mh.m) AS weight
  FROM levels l CROSS JOIN root CROSS JOIN mh LEFT JOIN h1 USING (host)
  LEFT JOIN d1 ON l.domain = d1.domain LEFT JOIN s1 ON l.suffix = s1.suffix),
ruled AS (
  SELECT p.*, r.rate - {Z} * sqrt(r.rate * (1 - r.rate) / (r.weight + 1)) AS bound,
    CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM parsed p JOIN rated r USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_LEAKS = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
i AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[b : b + {WINDOW_WORDS - 1}] AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS - 1}, 1) + 1)) AS b FROM i WHERE len(w) > 0)),
places AS (
  SELECT r, n, b, w[b : b + n - 1] AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS b FROM d CROSS JOIN (SELECT DISTINCT len(t) AS n FROM windows))),
hits AS (SELECT DISTINCT r, n, b, item_id FROM places JOIN windows USING (t)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(b, b + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_SEARCH = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, w, len(w)::BIGINT AS n
  FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
facts AS (SELECT count(*)::BIGINT AS docs, coalesce(sum(n), 0)::BIGINT AS terms FROM d),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
counts AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM counts CROSS JOIN facts GROUP BY term),
points AS (
  SELECT r, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS p
  FROM counts JOIN weights USING (term) JOIN d USING (r) CROSS JOIN facts),
scores AS (SELECT item_id, r, sum(p)::BIGINT AS score FROM points JOIN wanted USING (term) GROUP BY item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scores JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

#: Fingerprints, deduplication by bytes, packing, tokenizers and the learned operators have no twin:
#: they are tested against brute force, a round trip or held-out rows.
ORACLE: dict[str, str] = {
    "op1_mixing": _MIX, "op2_url_filter": _URLS, "op12_decontamination": _LEAKS, "op13_search": _SEARCH,
}
