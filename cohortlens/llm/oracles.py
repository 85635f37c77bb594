"""DuckDB twins of the queries that SQL expresses exactly."""

from __future__ import annotations

from cohortlens.llm import fim, lexical, mixing, pivots, quality, superminhash, urls

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = f"translate({{}}, '{urls.UPPER}', '{urls.LOWER}')"


def quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {quality.BIT[name]} ELSE 0 END" for name, rule in quality.RULES.items())
    masked = lambda policy: f"(fail_bits & {quality.mask(quality.POLICIES[policy])}) "
    return f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
l AS (SELECT doc_id, t, {WORDS.format('t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {quality.WINDOW - 1}), ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i FROM l WHERE len(ws) >= {quality.WINDOW}) x),
twice AS (SELECT doc_id, i FROM win QUALIFY COUNT(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM twice, range(0, {quality.WINDOW}) r(k) GROUP BY doc_id),
m AS (SELECT l.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(COALESCE(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, COALESCE(c.n, 0) AS n_repeat_words,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_bang
      FROM l LEFT JOIN covered c ON l.doc_id = c.doc_id),
b AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {masked('base')} <> 0 AS base_failed, {masked('v2')} = 0 AS kept, fail_bits FROM b"""


def ablations_sql(policy: str = "v2") -> str:
    mask = quality.mask(quality.POLICIES[policy])
    rules = " UNION ALL ".join(f"SELECT '{r}' AS rule, COUNT(*) FILTER ((fail_bits & {quality.BIT[r]}) <> 0) AS n_failed, "
                               f"COUNT(*) FILTER ((fail_bits & {mask}) = {quality.BIT[r]}) AS n_only FROM q" for r in quality.POLICIES[policy])
    return f"WITH q AS ({quality_sql()}) {rules}"


def dedup_sql() -> str:
    k = superminhash.SHINGLE
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER.format("COALESCE(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + {k - 1}), ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, GREATEST(len(ws) - {k - 2}, 2))) AS i FROM d WHERE len(ws) > 0) x),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= {superminhash.PERCENT} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x AS doc_id, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN comp c ON d.doc_id = c.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""


def urls_sql() -> str:
    def fits(rule: str) -> str:
        own, start = rule[:rule.index("/")], rule[rule.index("/"):]
        return f"(host = '{own}' OR host LIKE '%.{own}') AND starts_with(path, '{start}')"
    order = sorted(urls.RULES, key=lambda x: (-len(x[0]), x[0]))
    case = lambda i: "CASE " + " ".join(f"WHEN {fits(r[0])} THEN '{r[i]}'" for r in order) + " END"
    two = ", ".join(f"'{x}'" for x in urls.TWO_LABELS)

    def shrunk(level: str, parent: str, rate: str, name: str) -> str:
        """CTEs for the strength of a level and its shrunk rates."""
        return f"""{name}_k AS (SELECT SUM(CASE WHEN n > 0 THEN n * pow(bad / n - {parent}, 2) END) AS spread, SUM(CASE WHEN n > 0 THEN {parent} * (1 - {parent}) END) AS noise,
   SUM(CASE WHEN n > 0 THEN n * {parent} * (1 - {parent}) END) AS even FROM {level}),
{name}_s AS (SELECT LEAST(GREATEST(COALESCE(CASE WHEN (spread - noise) / NULLIF(even - noise, 0) > 0 THEN (even - noise) / (spread - noise) - 1 END, {urls.MOST_STRENGTH}),
   {urls.LEAST_STRENGTH}), {urls.MOST_STRENGTH}) AS strength FROM {name}_k),
{name} AS (SELECT l.*, strength, (bad + strength * {parent}) / (n + strength) AS {rate} FROM {level} l, {name}_s)"""
    return f"""
WITH u AS (SELECT page_id, regexp_extract(COALESCE(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
p AS (SELECT page_id, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id AS page_id, MAX(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, CAST(COUNT(bad) AS DOUBLE) AS n, CAST(COALESCE(SUM(bad), 0) AS DOUBLE) AS bad FROM p LEFT JOIN o ON p.page_id = o.page_id WHERE host <> '' GROUP BY host),
g AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM h),
x AS (SELECT *, regexp_matches(bare, '^[0-9]+(\\.[0-9]+){{3}}$') OR starts_with(bare, '[') AS address, array_to_string(string_split(bare, '.')[-2:], '.') AS last2 FROM g),
y AS (SELECT host, n, bad, CASE WHEN address THEN bare WHEN last2 IN ({two}) THEN array_to_string(string_split(bare, '.')[-3:], '.') ELSE last2 END AS domain,
        CASE WHEN address THEN bare WHEN last2 IN ({two}) THEN last2 ELSE string_split(bare, '.')[-1] END AS suffix FROM x),
top AS (SELECT SUM(bad) / NULLIF(SUM(n), 0) AS all_rate FROM y),
s0 AS (SELECT suffix, SUM(n) AS n, SUM(bad) AS bad, MAX(all_rate) AS all_rate FROM y, top GROUP BY suffix),
{shrunk('s0', 'all_rate', 'suffix_rate', 's1')},
d0 AS (SELECT y.domain, y.suffix, SUM(y.n) AS n, SUM(y.bad) AS bad, MAX(suffix_rate) AS suffix_rate FROM y JOIN s1 ON y.suffix = s1.suffix GROUP BY y.domain, y.suffix),
{shrunk('d0', 'suffix_rate', 'domain_rate', 'd1')},
h0 AS (SELECT y.host, y.n, y.bad, domain_rate FROM y JOIN d1 ON y.domain = d1.domain),
{shrunk('h0', 'domain_rate', 'bad_rate', 'h1')},
r AS (SELECT host, bad_rate - {urls.Z} * sqrt(bad_rate * (1 - bad_rate) / (n + strength + 1)) AS bound FROM h1)
SELECT page_id, p.host, path, {case(0).replace('host ', 'p.host ')} AS rule,
  COALESCE({case(1).replace('host ', 'p.host ')}, CASE WHEN bound > {urls.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN r ON p.host = r.host"""


def warc_sql() -> str:
    digit = lambda shift: f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> {shift}) & 31 AS INTEGER) + 1, 1)"
    chars = " || ".join(digit(x) for x in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS INTEGER)),
        lambda v: {chars}), '') AS payload_digest FROM x),
f AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to FROM f"""


def mixing_sql() -> str:
    weights = ", ".join(str(w) for w in mixing.WEIGHTS)
    epochs = " + ".join(f"CASE WHEN size > 0 AND place + size / 2.0 + source_size * {e} < target THEN size ELSE 0 END" for e in range(mixing.MAX_EPOCHS))
    return f"""
WITH z AS (SELECT doc_id, source, CAST(len({WORDS.format("COALESCE(text, '')")}) AS BIGINT) AS size, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM z GROUP BY source),
w AS (SELECT *, [{weights}][rank % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight, source_size * {float(mixing.MAX_EPOCHS)}::DOUBLE AS cap FROM s),
v AS (SELECT *, (SUM(source_size::DOUBLE) OVER () * {mixing.BUDGET}::DOUBLE - (SUM(cap) OVER (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING) - cap))
        / SUM(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap
        ELSE LEAST(cap, weight * (SELECT level FROM v WHERE level * weight < cap ORDER BY cap / weight, rank LIMIT 1)) END AS target FROM v),
p AS (SELECT z.*, source_size, target, SUM(size) OVER (PARTITION BY z.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS place
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST({epochs} AS BIGINT) AS taken FROM p"""


def lexical_sql() -> str:
    terms = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(LOWER.format("COALESCE(text, '')"))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS ws FROM documents),
t AS (SELECT r, doc_id, unnest(ws) AS term, CAST(len(ws) AS BIGINT) AS n FROM d),
c AS (SELECT r, doc_id, term, n, CAST(COUNT(*) AS BIGINT) AS tf FROM t GROUP BY ALL),
all_d AS (SELECT CAST(COUNT(*) AS BIGINT) AS nn, CAST(SUM(len(ws)) AS BIGINT) AS ll FROM d WHERE len(ws) > 0),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * MAX(nn) + 2 AS DOUBLE) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM c, all_d GROUP BY term),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) x),
s AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN c USING (term), all_d GROUP BY item_id, r, doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {lexical.K}"""


def topk_sql() -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({pivots.SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score FROM v q JOIN v x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= {pivots.K}"""


def fim_sql() -> str:
    p, s, m = fim.PREFIX, fim.SUFFIX, fim.MIDDLE
    part = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('{fim.SEED}:' || doc_id) AS h FROM documents),
x AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {part(0)} AS h1, {part(1)} AS h2, {part(2)} AS h3, {part(3)} AS h4 FROM d),
y AS (SELECT *, LEAST(h1 % (n + 1), h2 % (n + 1)) AS a, GREATEST(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR h3 % 100 >= {fim.PLAIN_FROM} THEN 'plain'
             WHEN h4 % 100 < {fim.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM x),
z AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM y)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM z"""


ORACLES = {"op6_mixing": mixing_sql(), "op5_url_filter": urls_sql(), "op7_near_dedup": dedup_sql(), "op8_warc": warc_sql(), "op10_quality_rules": quality_sql(),
           "quality_ablations": ablations_sql(),
           "op11_lexical": lexical_sql(), "op12_exact_topk": topk_sql(), "op13_fill_in_middle": fim_sql()}
