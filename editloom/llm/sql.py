"""DuckDB SQL for the same rows, of the operators that SQL can express: counts and verdicts in plain relational terms.

Words of a text are the same everywhere: runs of what is no ASCII white space. Nothing here follows the operators' own way
to their results: repeats are counted from all strings of 200 bytes, containment from all shingles.
"""

from __future__ import annotations

import math

from . import decontam, rules, suffix, urls

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
DOCS = "(SELECT *, row_number() OVER () AS rid FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(CAST(lang AS VARCHAR), '') AS lang, coalesce(CAST(source AS VARCHAR), '') AS source FROM documents))"


def suffix_repeats(size: int = suffix.MIN_BYTES) -> str:
    """Every string of `size` bytes by its md5; bytes as pairs of hexadecimal digits."""
    return f"""WITH d AS MATERIALIZED (SELECT rid, doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM {DOCS}),
 part AS MATERIALIZED (SELECT rid, n, s, substr(h, 2 * s + 1, 2 * {1000 + size}) AS h FROM (SELECT rid, n, h, unnest(range(0, n - {size - 1}, 1000)) AS s FROM d WHERE n >= {size})),
 w AS MATERIALIZED (SELECT rid, s + p AS p, md5(substr(h, 2 * p - 1, {2 * size})) AS m FROM (SELECT rid, s, h, unnest(range(1, least(1000, n - {size - 1} - s) + 1)) AS p FROM part)),
 r AS (SELECT rid, p FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
 g AS (SELECT rid, p, p - row_number() OVER (PARTITION BY rid ORDER BY p) AS run FROM r),
 o AS (SELECT rid, min(p) AS a, max(p) + {size} AS b FROM g GROUP BY rid, run),
 t AS (SELECT rid, a, b, coalesce(max(b) OVER (PARTITION BY rid ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o),
 u AS (SELECT rid, a, b, sum((a > before)::INT) OVER (PARTITION BY rid ORDER BY a ROWS UNBOUNDED PRECEDING) AS span FROM t),
 s AS (SELECT rid, min(a) AS a, max(b) AS b FROM u GROUP BY rid, span),
 e AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 1) AS after_last FROM s),
 k AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * after_last - 1, 2 * (a - after_last)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) - 1) AS kept FROM e JOIN d USING (rid) GROUP BY rid)
 SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (rid)"""


def adaptive_rules() -> str:
    """Counts from words, lines and windows; sketches as buckets in a table, their quantiles by running sums."""
    left = lambda keep: f"length(regexp_replace(text, '[^{keep}]', '', 'g'))"
    lines = r"list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))"
    share = lambda a, b: f"{a} / greatest({b}, 1)::DOUBLE"
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {share(a, b)} AS x FROM c" for m, (a, b) in rules.MEASURES.items())
    at = lambda q: f"min(value) FILTER (upto >= ceil(total * {q!r}::DOUBLE))"
    value = f"CASE WHEN bucket = -2147483648 THEN 0 ELSE 2 * pow({rules.GAMMA!r}::DOUBLE, bucket) / {rules.GAMMA + 1!r}::DOUBLE END"

    def quantiles(*by: str) -> str:
        keys = ", ".join((*by, "measure"))
        return f"""SELECT {keys}, max(total) AS n, {at(1 - rules.OUTER)} AS low, {at(0.5)} AS mid, {at(rules.OUTER)} AS high FROM (
 SELECT *, {value} AS value, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total FROM (SELECT {keys}, bucket, sum(n) AS n FROM sketch GROUP BY {keys}, bucket)) GROUP BY {keys}"""

    drawn = lambda q: f"(a.n * a.{q} + {rules.PRIOR}::DOUBLE * ((b.n * b.{q} + {rules.PRIOR}::DOUBLE * g.{q}) / (b.n + {rules.PRIOR}::DOUBLE))) / (a.n + {rules.PRIOR}::DOUBLE) AS {q}"
    fence = {"low": f"mid - {rules.REACH}::DOUBLE * (mid - low)", "mid": "mid", "high": f"mid + {rules.REACH}::DOUBLE * (high - mid)"}
    wide = ", ".join(f"max({x}) FILTER (measure = '{m}') AS {m}_{q}" for m in rules.MEASURES for q, x in fence.items())

    def leaves(m: str) -> str:
        count, size = rules.MEASURES[m]
        if m == "word_length":
            noise = f"{rules.NOISE}::DOUBLE * {m}_mid / sqrt(greatest({size}, 1))"
            return f"({share(count, size)} > {m}_high + {noise} OR {share(count, size)} < {m}_low - {noise})"
        return f"{count} > {m}_high * {size} + {rules.NOISE}::DOUBLE * sqrt({m}_high * {size} + 1)"

    reason = f"CASE WHEN base_failed THEN 'base' {' '.join(f"WHEN {leaves(m)} THEN '{m}'" for m in rules.MEASURES)} END"
    return f"""WITH d AS MATERIALIZED (SELECT rid, doc_id, lang, source, text, {WORDS.format('text')} AS w, {lines} AS l FROM {DOCS}),
 words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
 three AS (SELECT rid, i, word || ' ' || lead(word) OVER (PARTITION BY rid ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY rid ORDER BY i) AS s FROM words),
 twice AS (SELECT rid, i, (s IS NOT NULL AND count(*) OVER (PARTITION BY rid, s) > 1)::INT AS t FROM three),
 again AS (SELECT rid, sum(c)::BIGINT AS n FROM (SELECT rid, max(t) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM twice) GROUP BY rid),
 c AS MATERIALIZED (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars, {left('#*$%&|<>')}::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines, {left('A-Z')} AS n_capitals, {left('!?')} AS n_exclamations FROM d LEFT JOIN again USING (rid)),
 sketch AS MATERIALIZED (SELECT lang, source, measure, CASE WHEN x <= {rules.TINY} THEN -2147483648 ELSE ceil(ln(x) / {math.log(rules.GAMMA)!r}::DOUBLE)::INT END AS bucket, count(*) AS n FROM ({long}) GROUP BY ALL),
 limits AS (SELECT lang, source, {wide} FROM (SELECT a.lang, a.source, a.measure, {', '.join(map(drawn, ('low', 'mid', 'high')))}
  FROM ({quantiles('lang', 'source')}) a JOIN ({quantiles('lang')}) b ON a.lang = b.lang AND a.measure = b.measure JOIN ({quantiles()}) g ON a.measure = g.measure) GROUP BY lang, source)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {reason} IS NULL AS kept, {reason} AS reason
 FROM (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {int(100 * rules.MAX_REPEAT)} * n_words AS base_failed FROM c) JOIN limits USING (lang, source)"""


def containment(threshold: float = 0.8, shingle: int = 5) -> str:
    """All shingles of all documents against all shingles of all items."""
    run = lambda k: f"unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i : i + {k} - 1], ' ')))"
    each = " UNION ".join(f"SELECT rid, doc_id, {k} AS k, {run(k)} AS s FROM d WHERE {k} IN (SELECT k FROM item)" for k in range(1, shingle + 1))
    words = WORDS.format(LOWER.format("text"))
    return f"""WITH item AS MATERIALIZED (SELECT row_number() OVER () AS iid, item_id, {words} AS w, least({shingle}, len({words})) AS k FROM benchmark WHERE text IS NOT NULL AND len({words}) > 0),
 part AS MATERIALIZED (SELECT DISTINCT iid, item_id, k, s FROM (SELECT iid, item_id, k, {run('k')} AS s FROM item)), size AS (SELECT iid, count(*) AS n FROM part GROUP BY iid),
 d AS MATERIALIZED (SELECT rid, doc_id, {words} AS w FROM {DOCS}), of_doc AS ({each})
 SELECT doc_id, item_id, n::BIGINT AS n_shingles, n_shared::BIGINT AS n_shared, n_shared::DOUBLE / n AS containment FROM (
 SELECT of_doc.rid, of_doc.doc_id, iid, item_id, count(*) AS n_shared FROM of_doc JOIN part USING (k, s) GROUP BY ALL) JOIN size USING (iid) WHERE n_shared >= {threshold} * n - 1e-9"""


def url_templates(levels: int = 8) -> str:
    """The tree level by level. Exact for paths of up to `levels` segments; a deeper one stops the query."""
    shape = r"""CASE WHEN regexp_matches(s, '^[0-9]+(\.[A-Za-z0-9]{1,5})?\z') THEN regexp_replace(s, '^[0-9]+', '<num>') WHEN regexp_matches(s, '^[0-9a-fA-F-]{8,}\z') THEN '<hex>'
 WHEN regexp_matches(s, '[0-9]') AND length(s) >= 12 THEN '<id>' ELSE s END"""
    fits = ", ".join(
        f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'size': {len(h + p)}, 'rule': '{h}{p}', 'verdict': '{v}'}} END" for h, p, v in urls.RULES
    )
    walk, last = "", "l0"
    for k in range(1, levels + 1):
        own, total = "sum(n) OVER (PARTITION BY host, t, parts[{k}])".format(k=k), "sum(n) OVER (PARTITION BY host, t)"
        rare = f"own < greatest({float(urls.MIN_ROWS)}, total * {urls.MIN_SHARE}::DOUBLE) AND NOT starts_with(parts[{k}], '<') AND parts[{k}] <> ''"
        walk += f""" l{k} AS MATERIALIZED (SELECT host, g, parts, n, labelled, bad, t || '/' || CASE WHEN {rare} THEN '*' ELSE parts[{k}] END AS t FROM (SELECT *, {own} AS own, {total} AS total FROM {last} WHERE len(parts) >= {k})),"""
        last = f"l{k}"
    ends = " UNION ALL ".join(f"SELECT host, g, n, labelled, bad, t FROM l{k} WHERE len(parts) = {k}" for k in range(1, levels + 1))
    return f"""WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
 b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
 c AS (SELECT page_id, {LOWER.format('raw')} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
 r AS (SELECT *, list_max(list_filter([{fits}], lambda x: x IS NOT NULL)) AS hit FROM c),
 p AS MATERIALIZED (SELECT page_id, host, path, hit.rule AS rule, hit.verdict AS ruled, array_to_string(list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda s: {shape}), '/') AS g FROM r),
 l0 AS MATERIALIZED (SELECT host, g, string_split(g, '/') AS parts, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS bad, '' AS t FROM p GROUP BY host, g),{walk}
 tree AS MATERIALIZED ({ends}), leaf AS (SELECT host, t, string_split(t[2:], '/') AS parts, sum(labelled)::BIGINT AS labelled, sum(bad)::BIGINT AS bad FROM tree GROUP BY host, t),
 deep AS MATERIALIZED (SELECT *, CASE WHEN depth > 0 THEN '/' || array_to_string(parts[1 : depth], '/') ELSE '' END AS branch, CASE WHEN depth > 1 THEN '/' || array_to_string(parts[1 : depth - 1], '/') WHEN depth = 1 THEN '' END AS above
  FROM (SELECT *, unnest(range(0, len(parts) + 1)) AS depth FROM leaf)),
 node AS (SELECT host, depth, branch, above, sum(labelled)::BIGINT AS labelled, sum(bad)::BIGINT AS bad FROM deep WHERE labelled > 0 GROUP BY ALL),
 apart AS (SELECT x.host, x.depth, x.branch FROM (SELECT *, bad / labelled::DOUBLE AS own FROM node) x JOIN (SELECT host, depth + 1 AS depth, branch AS above, bad / labelled::DOUBLE AS rate FROM node) y USING (host, depth, above)
  WHERE abs(own - rate) > {urls.Z}::DOUBLE * sqrt(rate * (1 - rate) / labelled)),
 own AS (SELECT leaf.host, leaf.t, labelled, bad, coalesce(depth, 0) AS depth, coalesce(branch, '') AS branch FROM leaf LEFT JOIN (SELECT host, t, max(depth) AS depth, arg_max(branch, depth) AS branch FROM deep SEMI JOIN apart USING (host, depth, branch) GROUP BY host, t) USING (host, t)),
 prior AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(bad) / sum(labelled)::DOUBLE ELSE 0.5::DOUBLE END AS rate FROM l0),
 judged AS (SELECT host, t, (bad_ + {urls.PRIOR_WEIGHT}::DOUBLE * rate) / (labelled_ + {urls.PRIOR_WEIGHT}::DOUBLE) AS purity, labelled_ >= {urls.MIN_LABELS} AS sure FROM (SELECT host, t, sum(bad) OVER x AS bad_, sum(labelled) OVER x AS labelled_ FROM own WINDOW x AS (PARTITION BY host, depth, branch)), prior)
 SELECT page_id, p.host, path, rule, coalesce(ruled, CASE WHEN sure AND purity >= {urls.PURITY}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, p.host || t AS template, purity
 FROM p JOIN tree ON p.host = tree.host AND p.g = tree.g JOIN judged USING (t) WHERE judged.host = p.host AND CASE WHEN (SELECT max(len(parts)) FROM l0) > {levels} THEN error('paths are deeper than this SQL') ELSE true END"""


SQL = {
    "op3_suffix_repeats": suffix_repeats(),
    "op4_adaptive_rules": adaptive_rules(),
    "op5_benchmark_containment": containment(decontam.THRESHOLD, decontam.SHINGLE),
    "op8_url_templates": url_templates(),
}
