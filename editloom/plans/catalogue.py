"""The registered queries, and for those that SQL can express the DuckDB SQL of the same rows.

The tables hold no code, so queries make their inputs from documents by expressions that both engines read alike (the
strings in INPUTS). Random order is that of md5 hashes, which both have.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import diff, templates, text, tokens
from ..operators import counters, evalmetrics, extract, generate, mix, prompts, sampling, stats, topics
from ..sources import io, scratch
from ..streaming import resume

QUERIES: dict = {}
SQL: dict[str, str] = {}
SEED = 42


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str, **made: str) -> DataFrame:
    """documents with text never null, and inputs made by SQL expressions."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")
    return d.withColumns({k: F.expr(v) for k, v in made.items()}) if made else d


D = "SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents"


def made(**columns: str) -> str:
    """SQL for docs(**columns)."""
    return f"(SELECT *, {', '.join(f'{v} AS {k}' for k, v in columns.items())} FROM ({D}))"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NL = "chr(10)"
WS = q(text.SPACES)
MARK = "CASE doc_id % 6 WHEN 1 THEN '[{0}]' WHEN 2 THEN '### {0}' ELSE '### [{0}]' END"
HALF = "CAST(floor(length(text) / 2) AS INT)"
FRONT, BACK = f"substr(text, 1, {HALF})", f"substr(text, {HALF} + 1)"
_before = f"{MARK.format('Program Before Edit')} || {NL} || '```python' || {NL} || {FRONT} || {NL} || '```' || {NL}"
_desc = f"CASE WHEN doc_id % 6 = 3 THEN 'none' ELSE {MARK.format('Descriptive')} END || {NL} || '** ' || {BACK} || ' -' || {NL}"
_lazy = f"{MARK.format('Lazy')} || {NL} || CASE WHEN doc_id % 6 = 5 AND doc_id % 4 = 1 THEN '' ELSE '# ' || {BACK} END || {NL}"
RESPONSES = {
    "response_1": f"CASE WHEN doc_id % 6 = 4 THEN {_lazy} || {_before} || {_desc} ELSE {_before} || {_desc} || {_lazy} END || CASE doc_id % 5 WHEN 0 THEN '---' || {NL} || 'x' WHEN 1 THEN '### more' WHEN 2 THEN '```' ELSE '' END",
    "response_2": f"CASE WHEN doc_id % 11 = 10 THEN '<UNREASONABLE>' ELSE {MARK.format('Program After Edit')} END || {NL} || '```' || CASE doc_id % 3 WHEN 0 THEN 'py' WHEN 1 THEN '' ELSE 'markdown' END || {NL} || text || {NL} || 'tail' || {NL} || '```' || {NL}",
}
FENCED = {
    "x": f"CASE doc_id % 7 WHEN 0 THEN text WHEN 1 THEN '```' || {NL} || text || {NL} || '```' WHEN 2 THEN '```py' || {NL} || text || {NL} || '``` b ```' || {NL} || 'x' || {NL} || '```' WHEN 3 THEN '```markdown' || {NL} || 'm' || {NL} || '``` ```js' || {NL} || text || '```' "
    f"WHEN 4 THEN '```Markdown' || {NL} || text || '```' WHEN 5 THEN '```' || {NL} || 'python' || {NL} || text || '```' ELSE '```py' || {NL} || {NL} || '```' END"
}


def sql_strip(x: str) -> str:
    return f"trim({x}, {WS})"


def sql_behind(x: str, marks) -> str:
    return "greatest(" + ", ".join(f"nullif(instr({x}, {q(m)}), 0) + {len(m)}" for m in marks) + ", NULL)"


def sql_first(x: str, marks) -> str:
    return "least(" + ", ".join(f"nullif(instr({x}, {q(m)}), 0)" for m in marks) + ", NULL)"


def sql_has(x: str, marks) -> str:
    return "(" + " OR ".join(f"instr({x}, {q(m)}) > 0" for m in marks) + ")"


def sql_code(x: str) -> str:
    pattern = r"```([^\s`]*)\s*\n([\s\S]*?)```"
    tags, codes = f"regexp_extract_all({x}, {q(pattern)}, 1)", f"regexp_extract_all({x}, {q(pattern)}, 2)"
    at = f"coalesce(list_position(list_transform({tags}, lambda t: lower(t) <> 'markdown'), true), 0)"
    code = f"nullif({sql_strip(f'{codes}[CASE WHEN {at} > 0 THEN {at} ELSE 1 END]')}, '')"
    return f"CASE WHEN starts_with({code}, 'python') THEN CASE WHEN instr({code}, {NL}) > 0 THEN substr({code}, instr({code}, {NL}) + 1) ELSE '' END ELSE {code} END"


def sql_purify(x: str) -> str:
    return f"trim({x}, {q(text.DECORATION)})"


def sql_single(x: str) -> str:
    return f"(instr({x}, {NL}) = 0 OR instr({x}, '─') > 0 OR starts_with({sql_strip(x)}, '$'))"


def sql_draw(seed, *keys: str) -> str:
    return f"('0x' || substr(md5(concat_ws('#', {q(str(seed))}, {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})), 1, 7))::BIGINT"


def sql_key(seed, *keys: str) -> str:
    return f"md5(concat_ws('#', {q(str(seed))}, {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def sql_lines(x: str) -> str:
    parts = f"string_split({x}, {NL})"
    return f"(CASE WHEN {parts}[-1] = '' THEN {parts}[1:-2] ELSE {parts} END)"


# extraction

_b, _d, _l, _a = text.SECTIONS.values()
_cut = f"""SELECT doc_id,
  {sql_strip(f"substr(response_1, {sql_behind('response_1', _b)}, greatest({sql_first('response_1', _d)} - {sql_behind('response_1', _b)}, 0))")} AS code_before,
  {sql_strip(f"substr(response_2, {sql_behind('response_2', _a)})")} AS code_after,
  {sql_strip(f"substr(response_1, {sql_behind('response_1', _d)}, greatest({sql_first('response_1', _l)} - {sql_behind('response_1', _d)}, 0))")} AS instruct_descriptive,
  {sql_strip(f"coalesce(substr(rest, 1, {sql_first('rest', text.LAZY_ENDS)} - 1), rest)")} AS instruct_lazy
 FROM (SELECT *, substr(response_1, {sql_behind('response_1', _l)}) AS rest FROM {made(**RESPONSES)})
 WHERE {sql_has('response_1', _b)} AND {sql_has('response_1', _d)} AND {sql_has('response_1', _l)} AND {sql_has('response_2', _a)}"""
_sections = f"SELECT * FROM ({_cut}) WHERE code_after <> '' AND instruct_descriptive <> '' AND instruct_lazy <> ''"


@query
def extract_sections(spark, sf_dir):
    return extract.sections(docs(spark, sf_dir, **RESPONSES)).select("doc_id", *extract.CODE, *extract.WORDS)


SQL["extract_sections"] = _sections


@query
def filter_singleline(spark, sf_dir):
    rows = docs(spark, sf_dir, x="CASE doc_id % 5 WHEN 0 THEN '  $ ' || text WHEN 1 THEN text || '─' ELSE text END")
    return extract.drop_single_line(rows, ("x",)).select("doc_id", "x")


SQL["filter_singleline"] = f"SELECT doc_id, x FROM {made(x="CASE doc_id % 5 WHEN 0 THEN '  $ ' || text WHEN 1 THEN text || '─' ELSE text END")} WHERE NOT {sql_single('x')}"


@query
def purify_code(spark, sf_dir):
    return extract.purify_code(docs(spark, sf_dir, **FENCED), ("x",)).select("doc_id", "x_purify")


SQL["purify_code"] = f"SELECT doc_id, {sql_code('x')} AS x_purify FROM {made(**FENCED)}"
_words = "CASE doc_id % 3 WHEN 0 THEN '**' || text || '** -' WHEN 1 THEN '### ' || text || chr(10) || '```' ELSE text END"


@query
def purify_instruction(spark, sf_dir):
    return extract.purify_instructions(docs(spark, sf_dir, x=_words), ("x",)).select("doc_id", "x_purify")


SQL["purify_instruction"] = f"SELECT doc_id, {sql_purify('x')} AS x_purify FROM {made(x=_words)}"


@query
def extract_triplets(spark, sf_dir):
    return extract.triplets(docs(spark, sf_dir, **RESPONSES)).select("doc_id", *(f"{c}_purify" for c in (*extract.CODE, *extract.WORDS)))


SQL["extract_triplets"] = f"""SELECT doc_id, {', '.join(f'{sql_code(c)} AS {c}_purify' for c in extract.CODE)}, {', '.join(f'{sql_purify(c)} AS {c}_purify' for c in extract.WORDS)}
 FROM ({_sections}) WHERE NOT {sql_single('code_before')} AND NOT {sql_single('code_after')}"""
_commit = "CASE doc_id % 3 WHEN 0 THEN '[\"a' || doc_id || '\",\"b\"]' WHEN 1 THEN 'c' || doc_id ELSE NULL END"


@query
def normalize_commit(spark, sf_dir):
    return docs(spark, sf_dir, x=_commit).select("doc_id", text.joined_commit(F.col("x")).alias("commit"))


SQL["normalize_commit"] = f"SELECT doc_id, coalesce(CASE WHEN starts_with(x, '[') THEN array_to_string(CAST(x AS JSON)::VARCHAR[], ',') ELSE x END, '') AS commit FROM {made(x=_commit)}"

# prompts

COMMITS = {
    "commit": "CASE WHEN doc_id % 13 = 12 THEN '' ELSE 'c' || doc_id END",
    "old_contents": "CASE WHEN doc_id % 17 = 16 THEN NULL ELSE text END",
    "new_contents": "text || chr(10) || 'x'",
    "message": "CASE WHEN doc_id % 7 = 6 THEN '' ELSE 'change ' || lang || ' ' || doc_id END",
}


@query
def valid_commits(spark, sf_dir):
    return prompts.valid_commits(docs(spark, sf_dir, **COMMITS), rewrite=True).select("doc_id", "message")


_ok = "coalesce(length({}), 0) > 0"
SQL["valid_commits"] = f"SELECT doc_id, message FROM {made(**COMMITS)} WHERE {' AND '.join(_ok.format(c) for c in ('old_contents', 'new_contents', 'message'))}"
_valid = " AND ".join(_ok.format(c) for c in ("old_contents", "new_contents", "commit"))


@query
def eligible_snippets(spark, sf_dir):
    return prompts.eligible(docs(spark, sf_dir, **COMMITS)).select("doc_id", F.size(text.split_lines(F.col("old_contents"))).cast("long").alias("n_lines"))


SQL["eligible_snippets"] = f"SELECT doc_id, len({sql_lines('old_contents')})::BIGINT AS n_lines FROM {made(**COMMITS)} WHERE {_valid} AND len({sql_lines('old_contents')}) >= 5"


@query
def sample_snippets(spark, sf_dir):
    return sampling.with_snippet(docs(spark, sf_dir), "text", SEED, F.col("doc_id")).select("doc_id", "snippet")


SQL["sample_snippets"] = f"""SELECT doc_id, array_to_string(lines[start + 1 : start + size], {NL}) AS snippet FROM (SELECT *, {sql_draw('42s', 'doc_id')} % (len(lines) - size + 1) AS start FROM (
 SELECT *, 5 + {sql_draw('42l', 'doc_id')} % (least(15, len(lines)) - 5 + 1) AS size FROM (SELECT doc_id, {sql_lines('text')} AS lines FROM ({D})) WHERE len(lines) >= 5))"""


def _pool(spark, sf_dir) -> DataFrame:
    return prompts.numbered(prompts.eligible(docs(spark, sf_dir, **COMMITS)), "commit", SEED)


_pool_sql = f"SELECT *, row_number() OVER (ORDER BY {sql_key(SEED, 'commit')}, commit) - 1 AS place FROM {made(**COMMITS)} WHERE {_valid} AND len({sql_lines('old_contents')}) >= 5"
_pairs_sql = f"SELECT i, a, (a + 1 + {sql_draw('42b', 'i')} % (n - 1)) % n AS b FROM (SELECT i, n, {sql_draw('42a', 'i')} % n AS a FROM (SELECT n, unnest(range(n)) AS i FROM (SELECT count(*) AS n FROM pool)))"


@query
def pair_commits(spark, sf_dir):
    pool = _pool(spark, sf_dir).select("place", "commit")
    many = pool.count()
    rows = prompts.pairs(many, many, SEED, spark)
    a, b = (pool.select(F.col("place").alias(f"p{s}"), F.col("commit").alias(f"commit_{s}")) for s in "ab")
    return rows.join(a, F.col("a") == F.col("pa")).join(b, F.col("b") == F.col("pb")).select("i", "commit_a", "commit_b")


SQL["pair_commits"] = f"WITH pool AS ({_pool_sql}) SELECT i, x.commit AS commit_a, y.commit AS commit_b FROM ({_pairs_sql}) p JOIN pool x ON p.a = x.place JOIN pool y ON p.b = y.place"
SHOTS = {"code_before": "'shot ' || doc_id", "instruct_descriptive": "'do ' || lang", "instruct_lazy": "'just ' || source"}


@query
def fill_prompts(spark, sf_dir):
    rows = prompts.synthesis_prompts(docs(spark, sf_dir, **COMMITS), docs(spark, sf_dir, **SHOTS), None, SEED)
    return rows.select("i", F.array_join("commit", ",").alias("commit"), F.element_at("user", 1).alias("user_1"), F.element_at("user", 2).alias("user_2"), F.array_join("code_snippet", "|").alias("snippets"), F.array_join("commit_message", "|").alias("messages"))


def _sql_snippet(x: str, key: str) -> str:
    lines, size = sql_lines(x), f"(5 + {sql_draw('42l', key)} % (least(15, len({sql_lines(x)})) - 5 + 1))"
    start = f"({sql_draw('42s', key)} % (len({lines}) - {size} + 1))"
    return f"array_to_string({lines}[{start} + 1 : {start} + {size}], {NL})"


def sql_fill(template: str, **slots: str) -> str:
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(f"coalesce({slots[x]}, '')" if k % 2 else q(x) for k, x in enumerate(parts))


_slots = {"code_snippet_1": "s1", "code_snippet_2": "s2", "code_before_shot": "code_before", "desc_instr_shot": "instruct_descriptive", "lazy_instr_shot": "instruct_lazy"}
SQL["fill_prompts"] = f"""WITH pool AS ({_pool_sql}), shots AS (SELECT *, row_number() OVER (ORDER BY {sql_key(SEED, 'code_before')}, code_before) - 1 AS shot FROM {made(**SHOTS)}),
 p AS (SELECT *, {sql_draw('42o', 'i')} % (SELECT count(*) FROM shots) AS shot FROM ({_pairs_sql})),
 j AS (SELECT p.i, x.commit || ',' || y.commit AS commit, {_sql_snippet('x.old_contents', "p.i || '#a'")} AS s1, {_sql_snippet('y.old_contents', "p.i || '#b'")} AS s2, x.message || '|' || y.message AS messages, code_before, instruct_descriptive, instruct_lazy
  FROM p JOIN pool x ON p.a = x.place JOIN pool y ON p.b = y.place JOIN shots USING (shot))
 SELECT i, commit, {sql_fill(templates.PROMPTS['v5.1'][1][0], **_slots)} AS user_1, {q(templates.PROMPTS['v5.1'][1][1])} AS user_2, s1 || '|' || s2 AS snippets, messages FROM j"""


@query
def rewrite_prompts(spark, sf_dir):
    return prompts.rewrite_prompts(docs(spark, sf_dir, **COMMITS), docs(spark, sf_dir, **SHOTS), SEED)


# sampling and mixing


@query
def sample_exact(spark, sf_dir):
    return sampling.sample_exact(docs(spark, sf_dir), 150, "doc_id", SEED).select("doc_id", "lang")


SQL["sample_exact"] = f"SELECT doc_id, lang FROM ({D}) ORDER BY {sql_key(SEED, 'doc_id')}, doc_id LIMIT 150"


@query
def shuffle_ranked(spark, sf_dir):
    return prompts.numbered(docs(spark, sf_dir), "doc_id", SEED).select("doc_id", "place")


SQL["shuffle_ranked"] = f"SELECT doc_id, row_number() OVER (ORDER BY {sql_key(SEED, 'doc_id')}, doc_id) - 1 AS place FROM ({D})"


@query
def largest_remainder(spark, sf_dir):
    """Shares of sources in 997 rows; the quota is arithmetic on a row per source."""
    counts = docs(spark, sf_dir).groupBy("source").count().orderBy("source").collect()
    total = sum(r["count"] for r in counts)
    quotas = sampling.largest_remainder([Fraction(r["count"], total) for r in counts], 997)
    return spark.createDataFrame([(r["source"], n) for r, n in zip(counts, quotas, strict=True)], "source string, quota long")


SQL["largest_remainder"] = f"""SELECT source, n * 997 // t + (row_number() OVER (ORDER BY n * 997 % t DESC, source) <= 997 - sum(n * 997 // t) OVER ())::BIGINT AS quota
 FROM (SELECT source, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS t FROM ({D}) GROUP BY source)"""
TRIPLETS = {
    "row_id": "doc_id",
    "commit": "'c' || doc_id",
    "code_before_purify": f"CASE WHEN doc_id % 9 = 0 THEN NULL ELSE {FRONT} END",
    "code_after_purify": "text",
    "instruct_descriptive_purify": BACK,
    "instruct_lazy_purify": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang END",
}


@query
def mix_sources(spark, sf_dir):
    rows = docs(spark, sf_dir, **TRIPLETS).withColumn("code_snippet", F.array("lang"))
    out = mix.mix([mix.Source(rows, 0.5, "descriptive", "m1"), mix.Source(rows, 0.5, "lazy")], 150, SEED, in_order=False)
    return out.select("row_id", "commit", "code_before_purify", "code_after_purify", "instruct_purify", "instr_type")


SQL["mix_sources"] = " UNION ALL ".join(
    f"SELECT row_id, commit, coalesce(code_before_purify, '') AS code_before_purify, code_after_purify, {c} AS instruct_purify, '{label}' AS instr_type FROM (SELECT * FROM {made(**TRIPLETS)} ORDER BY {sql_key(f'42/{i}', 'row_id')}, row_id LIMIT 75) WHERE length({c}) > 0"
    for i, (c, label) in enumerate((("instruct_descriptive_purify", "m1_descriptive"), ("instruct_lazy_purify", "unknown_lazy")))
)

# diffs

ADDED = {"k": "doc_id % 5 + 1", "new": "text || CASE WHEN text = '' OR substr(text, length(text), 1) = chr(10) THEN '' ELSE chr(10) END || repeat('added line ' || doc_id || chr(10), CAST(doc_id % 5 + 1 AS INT))"}
GAP = {"new": "'first ' || doc_id || chr(10) || text || CASE WHEN text = '' OR substr(text, length(text), 1) = chr(10) THEN '' ELSE chr(10) END || 'last ' || doc_id"}


def _stats(rows: DataFrame) -> DataFrame:
    return stats.with_diff(rows, "text", "new").select("doc_id", *(F.col(f"diff.{c}").cast("long").alias(c) for c in ("added", "removed", "modified", "hunk_num", "diff_hunk_num")))


@query
def diff_stats_append(spark, sf_dir):
    return _stats(docs(spark, sf_dir, **ADDED))


SQL["diff_stats_append"] = f"SELECT doc_id, k AS added, 0::BIGINT AS removed, 0::BIGINT AS modified, 1::BIGINT AS hunk_num, 1::BIGINT AS diff_hunk_num FROM {made(**ADDED)}"


@query
def diff_hunk_gap(spark, sf_dir):
    return _stats(docs(spark, sf_dir, **GAP)).select("doc_id", "added", "removed", "modified", "hunk_num")


SQL["diff_hunk_gap"] = f"SELECT doc_id, 2::BIGINT AS added, 0::BIGINT AS removed, 0::BIGINT AS modified, CASE WHEN len({sql_lines('text')}) <= 6 THEN 1 ELSE 2 END::BIGINT AS hunk_num FROM {made(**GAP)}"


def _neighbours(spark, sf_dir) -> DataFrame:
    """Each document against one drawn from all: the row with the next hash, by numbered places."""
    rows = prompts.numbered(docs(spark, sf_dir), "doc_id", SEED)
    return rows.join(rows.select((F.col("place") + 1).alias("place"), F.col("text").alias("new")), "place").select("doc_id", "text", "new")


@query
def diff_stats_pairs(spark, sf_dir):
    return _stats(_neighbours(spark, sf_dir))


@query
def diff_filter(spark, sf_dir):
    return stats.filter_by_diff(_neighbours(spark, sf_dir), "text", "new").select("doc_id")


MANY = {"k": "doc_id % 90 + 1", "new": ADDED["new"].replace("doc_id % 5 + 1", "doc_id % 90 + 1")}


@query
def diff_filter_append(spark, sf_dir):
    """Of texts with 1 to 90 lines more those of at most 70."""
    return stats.filter_by_diff(docs(spark, sf_dir, **MANY), "text", "new").select("doc_id", F.col("k").cast("long").alias("k"))


SQL["diff_filter_append"] = f"SELECT doc_id, k::BIGINT AS k FROM {made(**MANY)} WHERE k <= 70"
CHANGES = {"modified_lines": "doc_id % 83 + 1", "hunks": "doc_id % 9 + 1"}


@query
def diff_summary(spark, sf_dir):
    return stats.summary(docs(spark, sf_dir, **CHANGES))


SQL["diff_summary"] = "SELECT count(*) AS n, " + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max, CAST(median({c}) AS DOUBLE) AS {c}_median, count(*) FILTER ({c} > {n}) AS {c}_over, avg(CASE WHEN {c} > {n} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {c}_over_ratio" for c, n in (("modified_lines", 70), ("hunks", 7))) + f" FROM {made(**CHANGES)}"


@query
def diff_histogram(spark, sf_dir):
    rows = docs(spark, sf_dir, **CHANGES)
    return stats.histogram(rows, "modified_lines", 5).withColumn("measure", F.lit("lines")).unionByName(stats.histogram(rows, "hunks", 1).withColumn("measure", F.lit("hunks")))


SQL["diff_histogram"] = " UNION ALL ".join(
    f"SELECT (least(x // {w}, greatest(ceil(top / {w}.0) - 1, 0)) * {w})::BIGINT AS bin, count(*) AS n, '{m}' AS measure FROM (SELECT {c} AS x, max({c}) OVER () AS top FROM {made(**CHANGES)}) GROUP BY 1" for c, w, m in (("modified_lines", 5, "lines"), ("hunks", 1, "hunks"))
)


@query
def excess_lines(spark, sf_dir):
    return docs(spark, sf_dir, **ADDED).select("doc_id", diff.differ_lines("text", "new").alias("lines"), F.size(text.split_lines(F.col("text"))).cast("long").alias("old_lines"))


# common lines and added ones; none is alike enough for a hint
SQL["excess_lines"] = f"SELECT doc_id, (len({sql_lines('text')}) + k)::BIGINT AS lines, len({sql_lines('text')})::BIGINT AS old_lines FROM {made(**ADDED)}"


# topics


@query
def dominant_topic(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", topics.dominant(F.col("embedding")).cast("long").alias("topic"))


SQL["dominant_topic"] = "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS topic FROM embeddings"


@query
def topic_counts(spark, sf_dir):
    return topics.top_topics(table(spark, sf_dir, "embeddings"), "label")


SQL["topic_counts"] = "SELECT label AS topic, count(*) AS n FROM embeddings GROUP BY label ORDER BY n DESC, topic LIMIT 20"
# topics of very different sizes: the first letters of hashes, some joined
TOPIC = {"topic": "CASE WHEN doc_id % 10 < 5 THEN 'big' WHEN doc_id % 10 < 7 THEN 'mid ' || lang ELSE source END"}


def sql_water(most: int, cap: int | None = None) -> str:
    """(topic, size, quota) from a relation `sizes`."""
    quota = f"CASE WHEN locked THEN size ELSE room // many + (place <= room - room // many * many)::BIGINT END"
    return f"""SELECT topic, size, {f'least({quota}, {cap})' if cap else quota} AS quota FROM (
 SELECT *, {most} - coalesce(sum(CASE WHEN locked THEN size END) OVER (), 0)::BIGINT AS room, nullif(sum(CASE WHEN locked THEN 0 ELSE 1 END) OVER (), 0)::BIGINT AS many, row_number() OVER (PARTITION BY locked ORDER BY first_row, topic) AS place FROM (
 SELECT *, coalesce(max((NOT fits)::INT) OVER (ORDER BY size, first_row, topic ROWS UNBOUNDED PRECEDING), 0) = 0 AS locked FROM (
 SELECT *, size * (topics - r + 1) <= {most} - before AS fits FROM (
 SELECT *, row_number() OVER (ORDER BY size, first_row, topic) AS r, count(*) OVER () AS topics, coalesce(sum(size) OVER (ORDER BY size, first_row, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM sizes))))"""


_sizes = f"sizes AS (SELECT topic, count(*) AS size, min(doc_id) AS first_row FROM {made(**TOPIC)} GROUP BY topic)"


@query
def topic_waterfill(spark, sf_dir):
    sizes = docs(spark, sf_dir, **TOPIC).groupBy("topic").agg(F.count("*").alias("size"), F.min("doc_id").alias("first_row"))
    return sampling.water_fill(sizes, 333)


SQL["topic_waterfill"] = f"WITH {_sizes} {sql_water(333)}"


@query
def topic_cap(spark, sf_dir):
    sizes = docs(spark, sf_dir, **TOPIC).groupBy("topic").agg(F.count("*").alias("size"), F.min("doc_id").alias("first_row"))
    return sampling.water_fill(sizes, 100_000_000, 30)


SQL["topic_cap"] = f"WITH {_sizes} {sql_water(100_000_000, 30)}"


@query
def topic_balanced_sample(spark, sf_dir):
    return sampling.balanced_sample(docs(spark, sf_dir, **TOPIC), "topic", "doc_id", SEED, 333).select("doc_id", "topic")


SQL["topic_balanced_sample"] = f"""WITH {_sizes}, quotas AS ({sql_water(333)}) SELECT doc_id, topic FROM (
 SELECT doc_id, topic, quota, row_number() OVER (PARTITION BY topic ORDER BY {sql_key(SEED, 'doc_id')}, doc_id) AS place FROM {made(**TOPIC)} JOIN quotas USING (topic)) WHERE place <= quota"""


@query
def topic_pipeline(spark, sf_dir):
    rows = docs(spark, sf_dir, code_before_purify="text", code_after_purify=ADDED["new"])
    return topics.diversity_filter(rows, F.col("text"), "doc_id", SEED, max_total=200, k=5, carry=("doc_id", "lang"))


# tokens


@query
def tokenize_code(spark, sf_dir):
    part = tokens.spread(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    code = F.concat(F.lit("class MyType:\n    def getName_of(self, aB):\n        return aB + "), F.regexp_replace("p_name", "[^A-Za-z]+", "_"), F.lit("\n"))
    return part.select("p_partkey", F.array_join(tokens.identifiers(tokens.code_tokens(code)), " ").alias("tokens"))


SQL["tokenize_code"] = "SELECT p_partkey, 'mytype get name of a b a b ' || lower(array_to_string(string_split(regexp_replace(p_name, '[^A-Za-z]+', '_', 'g'), '_'), ' ')) AS tokens FROM part"


@query
def tokenize_words(spark, sf_dir):
    ascii_only = F.regexp_replace("text", r"[^\x00-\x7f]", "e")
    prompt = templates.edit_prompt(ascii_only, ascii_only, tag_before="python")
    return docs(spark, sf_dir).select("doc_id", F.array_join(text.instruction_words(text.edit_parts(prompt)[1]), " ").alias("words"))


SQL["tokenize_words"] = f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split_regex({sql_strip('t')}, '\\s+'), lambda w: lower(regexp_replace(w, '[^\\w]', '', 'g'))), lambda w: w <> ''), ' ') AS words
 FROM (SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7f]', 'e', 'g') AS t FROM ({D}))"""


@query
def split_identifier(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.split_identifier(F.concat("p_name", F.lit("_fooBar"), "p_type")), " ").alias("words"))


SQL["split_identifier"] = r"SELECT p_partkey, array_to_string(list_filter(string_split_regex(regexp_replace(p_name || '_fooBar' || p_type, '([[:lower:]])([[:upper:]])', '\1 \2', 'g'), '[\s_]+'), lambda x: x <> ''), ' ') AS words FROM part"

# training rows and chats


def _chats(spark, sf_dir, system: str | None = None) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    m = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return turns.select("conv_id", (m if system is None else F.concat(templates.messages(("system", system)), m)).alias("m"))


@query
def sharegpt_user_text(spark, sf_dir):
    return _chats(spark, sf_dir).select("conv_id", mix.user_text(F.col("m")).alias("user_text")).filter("user_text is not null")


SQL["sharegpt_user_text"] = f"SELECT conv_id, string_agg(text, {NL} ORDER BY turn) AS user_text FROM conversations WHERE role = 'user' GROUP BY conv_id"
ROWS = {**TRIPLETS, "instruct_purify": BACK, "instr_type": "CASE WHEN doc_id % 2 = 0 THEN 'm_lazy' ELSE NULL END"}
_old = "coalesce(code_before_purify, '')"
_prompt = f"'## Code Before:' || {NL} || CASE WHEN {sql_draw('42f', 'row_id')} % 2 = 0 THEN '```python' || {NL} || {_old} || {NL} || '```' ELSE {_old} END || {NL} || '## Instruction:' || {NL} || instruct_purify || {NL} || '## Code After:' || {NL}"
_answer = f"'```python' || {NL} || code_after_purify || {NL} || '```'"
_label = f"commit, coalesce(instr_type, 'unknown') AS instr_type, {_old} AS old_code, code_after_purify AS new_code"


@query
def alpaca_rows(spark, sf_dir):
    return mix.finetune_rows(docs(spark, sf_dir, **ROWS), "alpaca", SEED)


SQL["alpaca_rows"] = f"SELECT row_id, {_prompt} AS instruction, {q(mix.SYSTEM)} AS system, {_answer} AS output, {_label} FROM {made(**ROWS)}"


@query
def sharegpt_rows(spark, sf_dir):
    rows = mix.finetune_rows(docs(spark, sf_dir, **ROWS), "share_gpt", SEED, no_think=True)
    return rows.withColumn("messages", F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|"))


SQL["sharegpt_rows"] = f"SELECT row_id, 'system=' || {q(mix.SYSTEM)} || '|user=' || {_prompt} || ' /no_think|assistant=' || {_answer} AS messages, {_label} FROM {made(**ROWS)}"
BRIEF = "Be brief."


def _chat_query(name: str, make, sql: str) -> None:
    def run(spark, sf_dir):
        return _chats(spark, sf_dir, BRIEF).select("conv_id", make(F.col("m")).alias("prompt"))

    run.__name__ = name
    query(run)
    SQL[name] = sql


def _agg(user: str, other: str, sep: str = "''", end: str = "''") -> str:
    return f"SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN {user} ELSE {other} END, {sep} ORDER BY turn) || {end} AS prompt FROM conversations GROUP BY conv_id"


_2 = f"{NL} || {NL}"
_chat_query("chat_format_question_answer", templates.question_answer, _agg(f"'Question: {BRIEF}' || {NL} || text", "'Answer: ' || text", _2, f"CASE WHEN arg_max(role, turn) = 'user' THEN {_2} || 'Answer:' ELSE '' END"))
for _name, _think in (("chat_format_im", ""), ("chat_format_im_think", "/no_think")):
    _tag = f" {_think}" if _think else ""
    _chat_query(_name, lambda m, t=_think: templates.im_blocks(m, t), _agg(f"'<|im_start|>system' || {NL} || '{BRIEF}<|im_end|>' || {_2} || '<|im_start|>user' || {NL} || text || '{_tag}<|im_end|>' || {_2} || '<|im_start|>assistant'", "text || '<|im_end|>'"))
_chat_query("chat_format_user_assistant", templates.user_assistant, _agg(f"'{BRIEF}' || {_2} || 'User: ' || text || {_2} || 'Assistant:'", f"text || {_2}"))
_chat_query("chat_fold_system", lambda m: F.array_join(F.transform(templates.fold_system(m), lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|"), _agg(f"'user={BRIEF}' || {NL} || text", "role || '=' || text", "'|'"))


@query
def edit_prompts(spark, sf_dir):
    old, words = F.col("text"), F.col("source")
    flat = lambda m: F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|")
    made_ = {"commit": templates.commit_prompt(old, words), "direct": templates.edit_prompt(old, words, words, "py", "py"), "shot": templates.one_shot_prompt(old, words), "issue": templates.issue_prompt(old, words), "chat": flat(templates.chat_prompt(old, words)), "diff": flat(templates.chat_prompt_diff(old, words)), "chat_shot": flat(templates.chat_prompt_one_shot(old, words)), "with_system": templates.system_edit_prompt(old, words)}
    return docs(spark, sf_dir).select("doc_id", *(c.alias(f"p_{k}") for k, c in made_.items()))


_o = "text"
_direct = lambda o, n="''": f"'## Code Before:' || {NL} || {o} || {NL} || '## Instruction:' || {NL} || source || {NL} || '## Code After:' || {NL} || {n}"
_fence = lambda c, t: f"'```{t}' || {NL} || {c} || {NL} || '```'"
_shot = q(f"## Code Before:\n{templates.SHOT_OLD}\n## Instruction:\n{templates.SHOT_INSTRUCTION}\n## Code After:\n{templates.SHOT_NEW}\n")
_ask = "Here is my program:\n```py\n{old}\n```\n\nPlease change it: {instruction}"
_done = "<issue_comment>username_1: The full changed code:\n```py"
_thread = f"<issue_start>username_0: {_ask.format(old=templates.SHOT_OLD, instruction=templates.SHOT_INSTRUCTION)}{_done}\n{templates.SHOT_NEW}\n```\nUpvotes: 200<issue_comment>username_0: Thanks! Another one. {_ask}\nUpvotes: 100{_done}"
_shown = q(f"|user=## Code Before:\n```python\n{templates.SHOT_OLD}\n```\n## Instruction:\n{templates.SHOT_INSTRUCTION}\n## Code After:\n|assistant=```python\n{templates.SHOT_NEW}\n```|user=")
SQL["edit_prompts"] = f"""SELECT doc_id, '<commit_before>' || {_o} || '<commit_msg>' || source || '<commit_after>' AS p_commit, {_direct(_fence(_o, 'py'), _fence('source', 'py'))} AS p_direct, {_shot} || {_direct(_o)} AS p_shot,
 {sql_fill(_thread, old=_o, instruction='source')} AS p_issue, {q('system=' + templates.CODE_EDITOR + '|user=')} || {_direct(_fence(_o, 'python'))} AS p_chat,
 'system=You edit Python programs. Answer with a unified diff and nothing else.|user=Answer with a unified diff under ## Code Diff.' || {_2} || '## Code Before:' || {NL} || {_fence(_o, 'py')} || {NL} || '## Instruction:' || {NL} || source || {NL} || '## Code Diff' AS p_diff,
 {q('system=' + templates.CODE_EDITOR)} || {_shown} || {_direct(_fence(_o, 'python'))} AS p_chat_shot, {q(templates.CODE_EDITOR)} || {NL} || {_direct(_o)} AS p_with_system FROM ({D})"""
BLOCKS = {"x": f"CASE doc_id % 4 WHEN 0 THEN 'hi' || {NL} || '```py' || {NL} || text || {NL} || '```' || {NL} || 'no' WHEN 1 THEN '```' || {NL} || text WHEN 2 THEN 'a ``` b' || {NL} || text ELSE '```' || {NL} || '```' || {NL} || text END"}


@query
def codeblock_extract(spark, sf_dir):
    return docs(spark, sf_dir, **BLOCKS).select("doc_id", text.first_block(F.col("x")).alias("code"))


_first = "list_position(list_transform({0}, lambda s: starts_with(s, '```')), true)"
SQL["codeblock_extract"] = f"""SELECT doc_id, CASE WHEN k > 0 AND len(kept) > 0 THEN array_to_string(kept, {NL}) || {NL} ELSE '' END AS code FROM (
 SELECT doc_id, k, CASE WHEN {_first.format('rest')} > 0 THEN rest[1 : {_first.format('rest')} - 1] ELSE rest END AS kept FROM (
 SELECT doc_id, {_first.format('l')} AS k, l[{_first.format('l')} + 1 :] AS rest FROM (SELECT doc_id, string_split(x, {NL}) AS l FROM {made(**BLOCKS)})))"""
STOPS = ("the", "\n", ". ")


@query
def stop_truncate(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", text.cut_at(F.col("text"), STOPS).alias("cut"))


_c = "text"
for _s in STOPS:
    _c = f"split_part({_c}, {q(_s)}, 1)"
SQL["stop_truncate"] = f"SELECT doc_id, {_c} AS cut FROM ({D})"

# verbs and objects


def _verbs(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("verb"), F.concat("o_orderstatus", (F.col("o_custkey") % 7).cast("string")).alias("object"))
    return stats.top_pairs(stats.pair_counts(rows), 3, 5)


_pairs = "SELECT o_orderpriority AS verb, o_orderstatus || (o_custkey % 7) AS object, count(*) AS n FROM orders GROUP BY 1, 2"
_top = f"""SELECT verb, CASE WHEN r <= 5 THEN object ELSE '<other>' END AS object, sum(n)::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY verb ORDER BY n DESC, object) AS r FROM ({_pairs})
 WHERE verb IN (SELECT verb FROM ({_pairs}) GROUP BY verb ORDER BY sum(n) DESC, verb LIMIT 3)) GROUP BY 1, 2"""


@query
def verb_object_topk(spark, sf_dir):
    return _verbs(spark, sf_dir)


SQL["verb_object_topk"] = _top


@query
def verb_object_rollup(spark, sf_dir):
    return stats.pair_tree(_verbs(spark, sf_dir))


SQL["verb_object_rollup"] = f"SELECT verb, object, sum(n)::BIGINT AS n FROM ({_top}) GROUP BY ROLLUP (verb, object)"

# evaluation


def _problems(spark, sf_dir) -> DataFrame:
    """Orders as problems, their lines as completions."""
    line = F.struct(F.when(F.col("l_linestatus") == "O", "OK").otherwise("Exception").alias("status"), F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("exit_code"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("results"), F.max("l_discount").alias("x"), F.max("l_tax").alias("y"))
    return rows.select(
        F.col("l_orderkey").alias("id"), F.size("results").alias("n"), F.size(F.filter("results", evalmetrics.passed)).alias("c"),
        (F.col("l_orderkey") % 7).cast("string").alias("directory"), (F.col("l_orderkey") % 3).cast("string").alias("name"),
        F.when((F.col("l_orderkey") % 7 == 3) & (F.col("l_orderkey") % 2 == 0), 0.8).otherwise(0.2).alias("temperature"),
        F.when(F.col("x") > 0.02, F.col("x")).alias("mean_excess"), F.when(F.col("x") > 0.02, F.col("y") * 100).alias("median_coverage"),
    )


_problems_sql = """(SELECT l_orderkey AS id, count(*) AS n, count(*) FILTER (l_linestatus = 'O' AND l_returnflag = 'N') AS c, CAST(l_orderkey % 7 AS VARCHAR) AS directory, CAST(l_orderkey % 3 AS VARCHAR) AS name,
 CASE WHEN l_orderkey % 7 = 3 AND l_orderkey % 2 = 0 THEN 0.8 ELSE 0.2 END AS temperature, CASE WHEN max(l_discount) > 0.02 THEN max(l_discount) END AS mean_excess, CASE WHEN max(l_discount) > 0.02 THEN max(l_tax) * 100 END AS median_coverage FROM lineitem GROUP BY l_orderkey)"""


def sql_pass(k: int) -> str:
    return f"(CASE WHEN n - c < {k} THEN 1.0::DOUBLE WHEN c = 0 THEN 0.0::DOUBLE ELSE 1 - list_reduce(list_concat([1.0::DOUBLE], list_transform(range(n - c + 1, n + 1), lambda i: 1 - {k}.0::DOUBLE / i)), lambda a, b: a * b) END)"


@query
def pass_at_k(spark, sf_dir):
    rows = _problems(spark, sf_dir)
    return rows.select("id", F.col("n").cast("long").alias("n"), F.col("c").cast("long").alias("c"), *(F.bround(evalmetrics.pass_at_k(F.col("n"), F.col("c"), k), 6).alias(f"pass_{k}") for k in (1, 2, 10)))


SQL["pass_at_k"] = f"SELECT id, n, c, {', '.join(f'round_even({sql_pass(k)}, 6) AS pass_{k}' for k in (1, 2, 10))} FROM {_problems_sql}"


def _by_dir(rows: DataFrame) -> DataFrame:
    out = evalmetrics.by_directory(rows, (1, 3))
    return out.withColumns({c: F.col(c).cast("long") for c in ("num_problems", "min_completions", "max_completions", "k")})


def _by_dir_sql(where: str = "true") -> str:
    one = lambda k: f"""SELECT directory, name, count(*) AS num_problems, min(n) AS min_completions, max(n) AS max_completions, round_even(avg(mean_excess) * 100, 6) AS excess_code, round_even(stddev_pop(mean_excess) / sqrt(count(mean_excess)) * 100, 6) AS excess_code_se,
 round_even(avg(median_coverage), 6) AS mean_median_coverage, {k}::BIGINT AS k, round_even(avg({sql_pass(k)}) * 100, 6) AS estimate FROM {_problems_sql} WHERE {where} GROUP BY directory, name HAVING count(DISTINCT temperature) = 1"""  # noqa: E731
    return f"{one(1)} UNION ALL {one(3)}"


@query
def pass_at_k_by_dir(spark, sf_dir):
    return _by_dir(_problems(spark, sf_dir))


SQL["pass_at_k_by_dir"] = _by_dir_sql()


@query
def eval_v1_only(spark, sf_dir):
    return _by_dir(evalmetrics.v1_only(_problems(spark, sf_dir)))


SQL["eval_v1_only"] = _by_dir_sql(f"id IN ({', '.join(map(str, evalmetrics.V1_IDS))})")


@query
def excess_code(spark, sf_dir):
    """Nested results made from documents, through the whole metric."""
    rows = docs(spark, sf_dir, **ADDED)
    result = F.struct(F.lit("OK").alias("status"), (F.col("doc_id") % 4 == 3).cast("int").alias("exit_code"), F.col("new").alias("program_no_test"), F.when(F.col("doc_id") % 5 > 0, F.lit(90.0)).alias("coverage"), F.array(F.lit(1), F.lit(2)).alias("coverage_missing"))
    rows = rows.select(F.col("doc_id").alias("row_id"), F.col("text").alias("before"), F.lit(None).cast("double").alias("temperature"), F.array(result).alias("results"))
    return evalmetrics.per_problem(rows).select("row_id", F.col("n").cast("long").alias("n"), F.col("c").cast("long").alias("c"), F.round("mean_excess", 9).alias("mean_excess"), "median_coverage", "temperature")


_covered = "doc_id % 4 <> 3 AND doc_id % 5 > 0"
SQL["excess_code"] = f"""SELECT doc_id AS row_id, 1::BIGINT AS n, (doc_id % 4 <> 3)::BIGINT AS c, CASE WHEN {_covered} THEN round(2 / (len({sql_lines('text')}) + k)::DOUBLE, 9) END AS mean_excess,
 CASE WHEN {_covered} THEN 10.0::DOUBLE END AS median_coverage, 0.2::DOUBLE AS temperature FROM {made(**ADDED)}"""


# generation

PROBLEMS = {"full_name": "'p' || item_id", "before": "text", "instruction_descriptive": "'describe ' || item_id", "instruction_lazy": "'do ' || item_id"}


@query
def batch_completions(spark, sf_dir):
    problems = table(spark, sf_dir, "benchmark").select(*(F.expr(v).alias(k) for k, v in PROBLEMS.items()))
    done = problems.filter("full_name like '%7'").select("full_name", F.lit("lazy").alias("instr_kind"))
    rows = generate.complete(generate.benchmark_tasks(problems, done=done), "direct", completions=3)
    return rows.select("full_name", "instr_kind", "prompt", F.array_join("completions", "|").alias("completions"), F.size("completions").cast("long").alias("n"))


_task = "SELECT *, '## Code Before:' || chr(10) || before || chr(10) || '## Instruction:' || chr(10) || instruction || chr(10) || '## Code After:' || chr(10) AS prompt FROM (" + " UNION ALL ".join(f"SELECT full_name, before, '{k}' AS instr_kind, instruction_{k} AS instruction FROM problems" for k in ("descriptive", "lazy")) + ") WHERE NOT (instr_kind = 'lazy' AND full_name LIKE '%7')"
SQL["batch_completions"] = f"WITH problems AS (SELECT {', '.join(f'{v} AS {k}' for k, v in PROBLEMS.items())} FROM benchmark) SELECT full_name, instr_kind, prompt, {' || \'|\' || '.join(f"'echo ' || md5(prompt || '#1#{i}')" for i in (1, 2, 3))} AS completions, 3::BIGINT AS n FROM ({_task})"


@query
def generate_stub(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.lit("sys").alias("system"), F.array(F.when(F.col("doc_id") % 10 == 0, " ").otherwise(F.col("text")), F.lit("again")).alias("user"))
    return generate.dialogue(rows, completions=2).select("row_id", F.col("sample_index").cast("long").alias("sample_index"), "response_1", "response_2")


SQL["generate_stub"] = f"SELECT doc_id AS row_id, i AS sample_index, 'echo ' || md5(u || '#2#' || i) AS response_1, 'echo ' || md5('again#4#' || i) AS response_2 FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN ' ' ELSE text END AS u FROM ({D})), (SELECT unnest([1, 2])::BIGINT AS i) WHERE {sql_strip('u')} <> ''"


@query
def resume_antijoin(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    return resume.remaining(rows, rows.filter("doc_id % 3 = 0"), ["doc_id"])


SQL["resume_antijoin"] = f"SELECT doc_id, lang FROM ({D}) WHERE doc_id % 3 <> 0"

# files: written from the documents, read back

DOC = "doc_id long, text string, lang string"
COMMIT = {"commit": "CASE doc_id % 3 WHEN 0 THEN '[\"a' || doc_id || '\",\"b\"]' WHEN 1 THEN 'c' || doc_id ELSE NULL END"}


def _lines(spark, sf_dir) -> str:
    """A folder of JSON lines with blank ones and ones that are no JSON."""
    path = scratch.folder(spark, "lines")
    line = F.when(F.col("doc_id") % 7 == 3, "{broken").when(F.col("doc_id") % 11 == 5, "  ").otherwise(F.to_json(F.struct("doc_id", "text", "lang")))
    docs(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


_good = f"SELECT doc_id, text, lang FROM ({D}) WHERE doc_id % 7 <> 3 AND doc_id % 11 <> 5"


@query
def jsonl_read(spark, sf_dir):
    return io.read_jsonl(spark, _lines(spark, sf_dir), DOC)


SQL["jsonl_read"] = _good


@query
def jsonl_strict(spark, sf_dir):
    path = scratch.folder(spark, "strict")
    io.write_jsonl(docs(spark, sf_dir).select("doc_id", "text", "lang"), path)
    return io.read_jsonl(spark, path, DOC, strict=True)


SQL["jsonl_strict"] = f"SELECT doc_id, text, lang FROM ({D})"


@query
def jsonl_ascii(spark, sf_dir):
    """Written without a character beyond ASCII, read as lines and decoded: the same texts."""
    path = scratch.folder(spark, "ascii")
    io.write_jsonl(docs(spark, sf_dir).select("doc_id", "text", "lang"), path, ascii_only=True)
    lines = io.read_lines(spark, path)
    return lines.select("value", F.from_json("value", DOC).alias("r")).select("r.*", F.col("value").rlike(r"[^\x00-\x7f]").alias("beyond"))


SQL["jsonl_ascii"] = f"SELECT doc_id, text, lang, false AS beyond FROM ({D})"


@query
def lines_sampled(spark, sf_dir):
    """Lines are drawn before they are decoded."""
    lines = io.read_lines(spark, _lines(spark, sf_dir)).filter(F.col("value").startswith('{"'))
    return io.decode(sampling.sample_exact(lines.withColumn("k", F.get_json_object("value", "$.doc_id")), 150, "k", SEED), DOC)


SQL["lines_sampled"] = f"SELECT * FROM ({_good}) ORDER BY {sql_key(SEED, 'doc_id')}, CAST(doc_id AS VARCHAR) LIMIT 150"


@query
def commit_forms(spark, sf_dir):
    """Commits that a file has as text or as an array in text come out alike."""
    path = scratch.folder(spark, "commits")
    io.write_jsonl(docs(spark, sf_dir, **COMMIT).select("doc_id", "commit"), path)
    return io.normalise(io.read_jsonl(spark, path, "doc_id long, commit string")).select("doc_id", "commit")


SQL["commit_forms"] = SQL["normalize_commit"]


@query
def fields_projected(spark, sf_dir):
    """The wanted fields that are there, and how many are not."""
    rows, missing = io.project(docs(spark, sf_dir), ["lang", "doc_id", "absent", "other"])
    return rows.withColumn("missing", F.lit(",".join(missing)))


SQL["fields_projected"] = f"SELECT lang, doc_id, 'absent,other' AS missing FROM ({D})"


@query
def rejects_split(spark, sf_dir):
    """Valid rows beside those in quarantine."""
    path = scratch.folder(spark, "rejects")
    rows = docs(spark, sf_dir).select("doc_id", "text")
    kept = io.split_rejects(rows, F.length("text") > 200, path).withColumn("valid", F.lit(True))
    return kept.unionByName(spark.read.schema("doc_id long, text string").json(path).withColumn("valid", F.lit(False)))


SQL["rejects_split"] = f"SELECT doc_id, text, length(text) > 200 AS valid FROM ({D})"


@query
def rows_counted(spark, sf_dir):
    """What a step keeps, skips and misses, observed while it runs."""
    rows = docs(spark, sf_dir, **COMMITS)
    kept, seen = counters.kept_and_skipped(rows, F.length("message") > 0, "valid", no_old=F.col("old_contents").isNull(), no_commit=F.col("commit") == "")
    kept.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[c] for c in ("read", "kept", "skipped", "no_old", "no_commit"))], "n_read long, n_kept long, n_skipped long, no_old long, no_commit long")


SQL["rows_counted"] = f"SELECT count(*) AS n_read, count(*) FILTER (length(message) > 0) AS n_kept, count(*) FILTER (coalesce(length(message), 0) = 0) AS n_skipped, count(*) FILTER (old_contents IS NULL) AS no_old, count(*) FILTER (commit = '') AS no_commit FROM {made(**COMMITS)}"


def _completions(spark, sf_dir):
    """A gzipped document a benchmark item, with a list of completions."""
    path = scratch.folder(spark, "completions")
    rows = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("p"), "item_id").alias("full_name"), F.lit("lazy").alias("instr_kind"), F.col("text").alias("before"), F.array(F.lit("a"), F.col("text")).alias("completions"))
    return path, io.write_completions(rows, path)


@query
def completions_gz(spark, sf_dir):
    path, files = _completions(spark, sf_dir)
    rows = spark.read.schema("full_name string, instr_kind string, before string, completions array<string>").json(path)
    named = files.select("full_name", F.element_at(F.split("file", "/"), -1).alias("file"))
    return rows.join(named, "full_name").select("full_name", "instr_kind", "file", "before", F.array_join("completions", "|").alias("completions"))


SQL["completions_gz"] = "SELECT 'p' || item_id AS full_name, 'lazy' AS instr_kind, 'p' || item_id || '_lazy.json.gz' AS file, text AS before, 'a|' || text AS completions FROM benchmark"
RESULT = "id long, temperature double, results array<struct<status:string,exit_code:int>>"


def _results(spark, sf_dir) -> str:
    """A result document an order of the first 400, plain or gzipped, in nested folders, beside files that cannot be read."""
    path = scratch.folder(spark, "results")
    rows = table(spark, sf_dir, "lineitem").filter("l_orderkey <= 400").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.struct(F.when(F.col("l_linestatus") == "O", "OK").otherwise("Exception").alias("status"), F.lit(0).alias("exit_code"))).alias("results"))
    line = F.when(F.col("id") % 10 == 7, "{no json").otherwise(F.to_json(F.struct("id", F.lit(0.2).alias("temperature"), "results")))
    rows = rows.select((F.col("id") % 3).cast("string").alias("top"), (F.col("id") % 2).cast("string").alias("run"), F.col("id").cast("string").alias("name"), line.alias("line"), (F.col("id") % 4 == 1).alias("packed"))

    def run(frames):
        import gzip

        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(path)
        for f in frames:
            for top, run_, name, line_, packed in f.itertuples(index=False):
                folder = f"{base}/t{top}" + (f"/r{run_}" if top != "0" else "")
                fs.create_dir(folder, recursive=True)
                with fs.open_output_stream(f"{folder}/{name}.results.json" + ".gz" * packed, compression=None) as out:
                    out.write(gzip.compress(line_.encode()) if packed else line_.encode())
            yield f[["name"]]

    rows.mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()
    return path


_orders = "(SELECT l_orderkey AS id, count(*) AS n, count(*) FILTER (l_linestatus = 'O') AS c FROM lineitem WHERE l_orderkey <= 400 AND l_orderkey % 10 <> 7 GROUP BY l_orderkey)"


@query
def results_read(spark, sf_dir):
    rows = io.read_results(spark, _results(spark, sf_dir), RESULT)
    return rows.select("id", "temperature", "name", F.size("results").cast("long").alias("n"), F.size(F.filter("results", evalmetrics.passed)).cast("long").alias("c"))


SQL["results_read"] = f"SELECT id, 0.2::DOUBLE AS temperature, CASE WHEN id % 3 = 0 THEN 't0' ELSE 'r' || (id % 2) END AS name, n, c FROM {_orders}"


@query
def results_leaves(spark, sf_dir):
    """Results of folders without sub-folders, with the last two parts of the folder's path."""
    path = _results(spark, sf_dir)
    rows = io.leaf_folders(io.read_results(spark, path, RESULT))
    directory, name = io.last_parts(F.concat("folder", F.lit("/")))
    return rows.select("id", F.when(directory.startswith("t"), directory).otherwise("").alias("directory"), name.alias("name"))


SQL["results_leaves"] = f"SELECT id, CASE WHEN id % 3 = 0 THEN '' ELSE 't' || (id % 3) END AS directory, CASE WHEN id % 3 = 0 THEN 't0' ELSE 'r' || (id % 2) END AS name FROM {_orders}"


@query
def sheet_appended(spark, sf_dir):
    path = scratch.folder(spark, "sheet")
    for k in (0, 1):
        io.append_sheet(docs(spark, sf_dir).filter(F.col("doc_id") % 2 == k).select("doc_id", "lang"), path)
    return spark.read.parquet(path)


SQL["sheet_appended"] = f"SELECT doc_id, lang FROM ({D})"


@query
def sheet_text(spark, sf_dir):
    """Counts by language as CSV text, cut into its lines."""
    lines = io.to_csv(docs(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang")).rstrip("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "place long, line string")


SQL["sheet_text"] = f"SELECT 0::BIGINT AS place, 'lang,n' AS line UNION ALL SELECT row_number() OVER (ORDER BY lang), lang || ',' || n FROM (SELECT lang, count(*) AS n FROM ({D}) GROUP BY lang)"


@query
def stream_resumed(spark, sf_dir):
    """Files that come in two lots, each taken up once by a stream that stops in between."""
    source, sink, state = (scratch.folder(spark, x) for x in ("arriving", "sink", "state"))
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    for k in (0, 1):
        rows.filter(F.col("doc_id") % 2 == k).repartition(4).write.mode("append").json(source)
        resume.run_available(spark, source, "doc_id long, lang string", lambda b: b.filter("lang <> 'es'"), sink, state, files_per_batch=3).awaitTermination()
    return resume.read_sink(spark, sink)


SQL["stream_resumed"] = f"SELECT doc_id, lang FROM ({D}) WHERE lang <> 'es'"


@query
def append_once(spark, sf_dir):
    """What is in the sink already, by its key, is not appended again."""
    sink = scratch.folder(spark, "once")
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    resume.append_new(rows.filter("doc_id % 3 = 0"), sink, ["doc_id"])
    resume.append_new(rows, sink, ["doc_id"])
    return spark.read.parquet(sink)


SQL["append_once"] = f"SELECT DISTINCT doc_id, lang FROM ({D})"


@query
def finetune_set(spark, sf_dir):
    """Two inputs as one set of training rows."""
    rows = docs(spark, sf_dir, **ROWS)
    return mix.finetune_set([rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1").drop("instr_type")], "alpaca", SEED)


SQL["finetune_set"] = SQL["alpaca_rows"]
