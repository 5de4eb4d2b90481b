"""DuckDB SQL for the queries that SQL can express; the others are tested against plain Python."""

from __future__ import annotations

from ferryline.llm import hosts
from ferryline.llm.quality import COMMON_WORDS, SHARES, STEPS, QualityRules

BLANK = r"\x20\x09-\x0D"


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def quality_sql(rules: QualityRules = QualityRules()) -> str:
    lists = "MAP {" + ", ".join(f"'{lang}': {_listed(words)}" for lang, words in COMMON_WORDS.items()) + "}"
    classes = ["[^A-Z]", "[^0-9]", r"[^.,;:!?''\"()\-]", "[^#*$%&|<>]"]
    limit = lambda x: f"least({x[1]}, greatest({x[0]}, m + {x[2]} * s))"
    counted = ", ".join(f"length(regexp_replace(t, '{c}', '', 'g'))" for c in classes)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, CASE WHEN lang IN {tuple(COMMON_WORDS)} THEN lang END AS lang,
    coalesce(text, '') AS t FROM documents),
 w AS (SELECT *, regexp_extract_all(t, '[^{BLANK}]+') AS ws, list_filter(string_split(t, chr(10)),
    lambda x: regexp_matches(x, '[^{BLANK}]')) AS ls, [{counted}] AS cs FROM d),
 win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
 dup AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
 covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM (SELECT rid, i, unnest(range(8)) AS j FROM dup) GROUP BY rid),
 base AS (SELECT w.rid, doc_id, source, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, cs[4] AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    list_concat(cs, [length(t) - list_sum(cs)::BIGINT, strlen(t) - length(t)]) AS classes,
    list_transform(({lists})[lang], lambda x: len(list_filter(ws, lambda y: y = x))) AS found
  FROM w LEFT JOIN covered ON w.rid = covered.rid),
 bins AS (SELECT rid, lang, 'c' AS kind, unnest(range(6)) AS bin, unnest(classes) AS c FROM base WHERE lang IS NOT NULL
  UNION ALL SELECT rid, lang, 'w', unnest(range(9)), unnest(list_concat(found, [n_words - list_sum(found)::BIGINT]))
  FROM base WHERE lang IS NOT NULL),
 long AS (SELECT bins.*, source, sum(c) OVER (PARTITION BY rid, kind) AS n FROM bins JOIN (SELECT rid, source, n_words FROM base) USING (rid) WHERE n_words >= {rules.min_words}),
 sized AS (SELECT lang FROM base WHERE n_words >= {rules.min_words} GROUP BY lang HAVING count(*) >= {rules.min_reference}),
 shares AS (SELECT lang, kind, bin, quantile_disc(r, 0.5) AS r FROM (SELECT lang, source, kind, bin,
  quantile_disc(c * {SHARES} // n, 0.5) AS r FROM long JOIN sized USING (lang) GROUP BY ALL) GROUP BY lang, kind, bin),
 refs AS (SELECT *, sum(r) OVER (PARTITION BY lang, kind)::DOUBLE AS m FROM shares),
 parts AS (SELECT rid, lang, kind, c / n::DOUBLE AS p, r / m AS q FROM long JOIN refs USING (lang, kind, bin) WHERE n > 0 AND m > 0),
 far AS (SELECT rid, lang, kind, sqrt(greatest(0.0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance FROM parts GROUP BY rid, lang, kind),
 centre AS (SELECT lang, kind, quantile_disc(floor(distance * {STEPS})::BIGINT, 0.5) AS m FROM far GROUP BY lang, kind),
 spread AS (SELECT lang, kind, any_value(m) AS m, quantile_disc(abs(floor(distance * {STEPS})::BIGINT - m), 0.5) AS s
  FROM far JOIN centre USING (lang, kind) GROUP BY lang, kind),
 limits AS (SELECT lang, kind, CASE WHEN kind = 'c' THEN {limit(rules.class_limit)} ELSE {limit(rules.word_limit)} END AS most FROM spread),
 over AS (SELECT rid, kind, distance, distance * {STEPS} > most AS beyond FROM far JOIN limits USING (lang, kind)),
 told AS (SELECT base.*, c.distance AS dc, x.distance AS dw, coalesce(c.beyond, false) OR coalesce(x.beyond, false) AS beyond,
  n_words < {rules.base_min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed
  FROM base LEFT JOIN over c ON c.rid = base.rid AND c.kind = 'c' LEFT JOIN over x ON x.rid = base.rid AND x.kind = 'w')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(dc, 6) AS class_distance,
  round(dw, 6) AS word_distance, base_failed, NOT base_failed AND NOT beyond AS kept FROM told"""


def _strength(level: str, limits: hosts.Reputation) -> str:
    """Name and one-row query of a level's prior strength, from its groups ``n, bad``."""
    return f"""s_{level} AS (SELECT CASE WHEN n IS NULL OR g < 2 OR n <= g OR between_ <= within_ THEN {limits.most_strength}
  ELSE least({limits.most_strength}, greatest({limits.least_strength}, (n - squares / n) / (g - 1) * within_ / (between_ - within_))) END AS s
 FROM (SELECT *, greatest(0.0, second - n * (bad / n) * (bad / n)) / (g - 1) AS between_, within_sum / (n - g) AS within_ FROM (
  SELECT count(*) AS g, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(n * n)::DOUBLE AS squares,
   sum(n * (bad / n) * (1 - bad / n)) AS within_sum, sum(n * (bad / n) * (bad / n)) AS second FROM by_{level})))"""


def hosts_sql(limits: hosts.Reputation = hosts.Reputation()) -> str:
    """The suffixes of the given pages are single labels, so this SQL takes the last label as the suffix."""
    rules = sorted(hosts.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    name = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules))
    verdict = " ".join(f"WHEN {f} THEN '{k}'" for f, (k, _, _) in zip(fits, rules))
    return f"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{hosts.UPPER}', '{hosts.LOWER}') AS host,
   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
 h AS (SELECT *, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS domain, CASE WHEN contains(host, '.') THEN regexp_extract(host, '[^.]*$')
   ELSE '' END AS suffix FROM p),
 told AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
 l AS (SELECT h.*, bad FROM h JOIN told USING (page_id)),
 by_host AS (SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM l GROUP BY host),
 by_domain AS (SELECT domain, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM l GROUP BY domain),
 by_suffix AS (SELECT suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM l GROUP BY suffix),
 {", ".join(_strength(level, limits) for level in ("host", "domain", "suffix"))},
 known AS (SELECT DISTINCT host, domain, suffix FROM h),
 levels AS (SELECT k.host, sh.s + coalesce(bh.n, 0) AS weight, (coalesce(bh.bad, 0) + sh.s * ((coalesce(bd.bad, 0) + sd.s
   * ((coalesce(bs.bad, 0) + ss.s * (SELECT coalesce(sum(bad) / count(*), 0) FROM l)) / (coalesce(bs.n, 0) + ss.s)))
   / (coalesce(bd.n, 0) + sd.s))) / (coalesce(bh.n, 0) + sh.s) AS mean
  FROM known k LEFT JOIN by_host bh USING (host) LEFT JOIN by_domain bd ON bd.domain = k.domain LEFT JOIN by_suffix bs ON bs.suffix = k.suffix,
   s_host sh, s_domain sd, s_suffix ss)
SELECT page_id, host, path, CASE {name} END AS rule, CASE {verdict}
  WHEN mean - {limits.z} * sqrt(mean * (1 - mean) / (weight + 1)) > {limits.most_bad} THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 4) AS bad_rate FROM p JOIN levels USING (host)"""


PHRASES_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
 p AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM
    (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS x FROM d)),
 sized AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM p),
 grams AS (SELECT lang, m, w[i:i + m - 1] AS ws FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM sized WHERE len(w) >= m)),
 f AS (SELECT lang, m, ws, count(*) AS a FROM grams GROUP BY lang, m, ws HAVING count(*) >= 30),
 n AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
 c AS (SELECT * FROM f WHERE m > 1),
 cuts AS (SELECT c.lang, c.ws, c.m, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
   FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f l ON l.lang = c.lang AND l.ws = c.ws[1:k]
   JOIN f r ON r.lang = c.lang AND r.ws = c.ws[k + 1:c.m]),
 best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
 parts AS (SELECT lang, ws[i:i + s - 1] AS ws, max(a) AS f FROM
   (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c)) GROUP BY ALL),
 kept AS (SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM best b LEFT JOIN parts p ON p.lang = b.lang AND p.ws = b.ws
   WHERE p.f IS NULL OR 100::HUGEINT * p.f < 80::HUGEINT * b.a),
 placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM kept)
SELECT lang, place AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed JOIN n USING (lang) WHERE place <= 2000"""


def linked_sql(size: int, percent: int, more: str = "") -> str:
    """Components of documents whose sets of ``size``-word shingles link; equal sets are one node."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^{BLANK}]+') AS w FROM documents),
 s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) END)) AS s FROM d),
 named AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(s, chr(10))) END AS node, s FROM s),
 nodes AS (SELECT node, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS first FROM named WHERE node IS NOT NULL GROUP BY node),
 tokens AS (SELECT node, n, unnest(s) AS g FROM nodes),
 pairs AS (SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM tokens a JOIN tokens b
    ON a.g = b.g AND a.node <> b.node AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY ALL),
 links AS (SELECT a, b FROM pairs WHERE 100 * c >= {percent} * (na + nb - c)),
 reach AS (SELECT node, node AS other FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
 least AS (SELECT r.node, min(o.first) AS component FROM reach r JOIN nodes o ON o.node = r.other GROUP BY r.node)
SELECT doc_id, n AS n_shingles, coalesce(component, doc_id) AS component_id{more}
FROM named LEFT JOIN least ON least.node = named.node"""


ORACLES = {
    "op1_quality_rules": quality_sql(), "op8_ngram_jaccard_join": linked_sql(4, 85), "op10_url_filters": hosts_sql(),
    "op11_odd_sketches": linked_sql(5, 85, ", doc_id = coalesce(component, doc_id) AS kept"),
    "op12_phrase_collocations": PHRASES_SQL,
}
