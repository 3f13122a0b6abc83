import difflib
import gzip
import json
import math
import random
import threading
import time
import tracemalloc
import urllib.error
from concurrent.futures import ThreadPoolExecutor
from fractions import Fraction
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from editloom import schemas
from editloom.functions import diff, tokens
from editloom.operators import evalmetrics, generate, mix, prompts, sampling, stats, topics
from editloom.sources import io
from editloom.streaming import resume


def test_diff_stats():
    same = "\n".join("abcdefghijkl")
    assert diff.stats("a\nb", "a\nc\nd") == (0, 0, 2, 1, 1)
    assert diff.stats(same, same) == (0, 0, 0, 0, 0)
    assert diff.stats("a\nb", "a\nb")[3:] == (1, 0)
    six, seven = "\n".join("bcdefg"), "\n".join("bcdefgh")
    assert diff.stats(f"x\n{six}\ny", f"1\n{six}\n2")[3] == 1 and diff.stats(f"x\n{seven}\ny", f"1\n{seven}\n2")[3] == 2
    assert diff.stats("", "a\nb") == (2, 0, 0, 1, 1) and diff.stats("a\nb", "")[1] == 2


def test_diffs_hold_one_pair_of_texts(spark):
    texts = [f"{i}\n" + "x" * 10_000 for i in range(1000)] + [None]
    old, new = pa.array(texts), pa.array(texts[1:] + texts[:1])
    tracemalloc.start()
    got = diff.diff_stats.func(old, new).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [tuple(r.values()) for r in got] == [diff.stats(a or "", b or "") for a, b in zip(old.to_pylist(), new.to_pylist(), strict=True)]
    assert peak < 2_000_000 < old.nbytes / 4
    df = spark.createDataFrame([("a\nb", "a\nc\nd"), (None, "x"), ("x", None)], "a string, b string")
    row = df.select(diff.diff_stats("a", "b").alias("s"), diff.differ_lines("a", "b").alias("n"), diff.unified_diff("a", "b").alias("u")).collect()
    assert [(tuple(r["s"]), r["n"]) for r in row] == [((0, 0, 2, 1, 1), 4), ((1, 0, 0, 1, 1), 1), ((0, 1, 0, 1, 1), 1)] and row[1]["u"].endswith("+x")


def test_filter_by_diff_equals_the_plain_filter(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        old = [rng.choice("abcd") for _ in range(rng.randrange(0, 120))]
        new = [x if rng.random() > 0.1 else rng.choice("abcdxyz") for x in old] + ["q"] * rng.choice([0, 0, 1, 69, 70, 71])
        rows.append((i, "\n".join(old), "\n".join(new) if i % 5 else None))
    df = spark.createDataFrame(rows, "i int, code_before_purify string, code_after_purify string")
    want = []
    for i, a, b in rows:
        s = diff.stats(a or "", b or "")
        if 0 < sum(s[:3]) <= 70 and s[3] <= 7:
            want.append(i)
    assert sorted(r["i"] for r in stats.filter_by_diff(df).collect()) == want and 0 < len(want) < 300
    text = df.select(diff.unified_diff("code_before_purify", "code_after_purify").alias("d")).first()["d"]
    assert text == "\n".join(difflib.unified_diff(rows[0][1].splitlines(), (rows[0][2] or "").splitlines(), lineterm=""))


def test_code_is_lexed_on_all_cores_and_once_a_batch(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"a{i % 3}_bC = 1") for i in range(300)], "i int, x string").coalesce(1)
    there = tokens.spread(rows).select("i", tokens.code_tokens("x").alias("t"), F.spark_partition_id().alias("p")).collect()
    assert sorted((r["i"], r["t"]) for r in there) == [(i, tokens.words_of(f"a{i % 3}_bC = 1")) for i in range(300)]
    assert len({r["p"] for r in there}) >= spark.sparkContext.defaultParallelism
    seen = []
    monkeypatch.setattr(tokens, "words_of", lambda x: seen.append(x) or [x])
    assert tokens.code_tokens.func(pd.Series(["a", None, "a", "", "b"])).tolist() == [["a"], [""], ["a"], [""], ["b"]] and sorted(seen) == ["", "a", "b"]


def rounds(sizes, most):
    """Quotas by locking topics round by round; sizes in order of appearance."""
    quota, open_, left = {}, dict(sizes), most
    while open_:
        share = left / len(open_)
        fit = [t for t, s in open_.items() if s <= share]
        if not fit:
            break
        for t in fit:
            quota[t] = open_.pop(t)
        left = most - sum(quota.values())
    if open_:
        each, extra = divmod(left, len(open_))
        for k, t in enumerate(open_):
            quota[t] = each + (k < extra)
    return quota


def test_water_fill_equals_rounds(spark):
    rng = random.Random(9)
    for _ in range(12):
        sizes = {f"t{i}": rng.choice([1, 2, 3, 10, 50, 51]) for i in range(rng.randrange(1, 9))}
        most = rng.choice([1, 3, 17, 60, 120, 10_000])
        df = spark.createDataFrame([(t, s, i) for i, (t, s) in enumerate(sizes.items())], "topic string, size long, first_row long")
        got = {r["topic"]: r["quota"] for r in sampling.water_fill(df, most).collect()}
        assert got == rounds(sizes, most) and sum(got.values()) == min(most, sum(sizes.values()))


def test_largest_remainder():
    assert sampling.largest_remainder([0.3333, 0.3333, 0.3334], 10) == [3, 3, 4]
    assert sampling.largest_remainder([0.5, 0.5], 3) == [2, 1]
    assert sampling.largest_remainder([Fraction(1, 3)] * 3, 10) == [4, 3, 3]
    with pytest.raises(ValueError):
        sampling.largest_remainder([0.5, 0.4], 3)


def test_samples_are_exact_and_independent_of_partitions(spark):
    df = spark.range(60_000).withColumnRenamed("id", "k")
    a = {r["k"] for r in sampling.sample_exact(df.repartition(7), 25_000, "k", 1).collect()}
    b = {r["k"] for r in sampling.sample_exact(df.coalesce(1), 25_000, "k", 1).collect()}
    assert len(a) == 25_000 and a == b
    with pytest.raises(ValueError):
        sampling.sample_exact(df, 70_000, "k", 1, strict=True)
    rows = df.withColumn("t", (F.col("k") % 3 == 0).cast("int"))
    assert {r["t"]: r["count"] for r in sampling.balanced_sample(rows, "t", "k", 4, most=1001).groupBy("t").count().collect()} == {0: 500, 1: 501}
    assert {r["count"] for r in sampling.balanced_sample(rows, "t", "k", 4, cap=9).groupBy("t").count().collect()} == {9}
    assert sampling.balanced_sample(rows, "t", "k", 4, most=10**9).count() == 60_000
    places = sorted(r["place"] for r in prompts.numbered(rows, "k", 3).select("place").collect())
    assert places == list(range(60_000))


def test_pairs_are_of_different_lines(spark):
    rows = prompts.pairs(3, 500, 1, spark).collect()
    assert len(rows) == 500 and all(r["a"] != r["b"] and 0 <= r["a"] < 3 and 0 <= r["b"] < 3 for r in rows)


def test_snippets(spark):
    df = spark.createDataFrame([(i, "\n".join(map(str, range(i))) + "\n" * (i % 2)) for i in range(40)] + [(99, None)], "i int, x string")
    found = {r["i"]: r["s"] for r in sampling.with_snippet(df, "x", 1, F.col("i"), "s").collect()}
    assert sorted(found) == list(range(5, 40))
    for i, s in found.items():
        lines = list(map(int, s.split("\n")))
        assert 5 <= len(lines) <= min(15, i) and lines == list(range(lines[0], lines[0] + len(lines))) and lines[-1] < i


def test_texts_are_split_once(spark):
    df = spark.createDataFrame([(1, "x")], "i int, x string")
    plan = sampling.with_snippet(df, "x", 1, F.col("i"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_large_topics_get_small_quotas(spark):
    """Topics of over 10,000 rows are cut by hash first; none may come out short of a quota of one."""
    rows = spark.range(1_300_000).selectExpr("id AS k", "id % 100 AS t")
    for most in (1, 3):
        got = sampling.balanced_sample(rows, "t", "k", 7, cap=most).groupBy("t").count().collect()
        assert len(got) == 100 and {r["count"] for r in got} == {most}
    # and the cut that is made leaves enough in the worst of cases
    for quota in (1, 2, 10, 1000, 10**6):
        mean = quota + 10 * math.sqrt(quota) + 60
        assert math.exp(-((mean - quota) ** 2) / (2 * mean)) < 1e-14


class Service(BaseHTTPRequestHandler):
    """Answers the number of messages; busy at first, and refusing a certain text."""

    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Service.seen.append((self.headers["Authorization"], body))
        text = body["messages"][-1]["content"]
        status = {1: 429, 2: 503}.get(len(Service.seen), 400 if text == "bad" else 200)
        self.send_response(status)
        if status == 429:
            self.send_header("Retry-After", "0")
        self.end_headers()
        if status == 200:
            self.wfile.write(json.dumps({"choices": [{"message": {"content": f"{len(body['messages'])}:{text}"}, "finish_reason": "length" if text == "long" else "stop"}]}).encode())

    def log_message(self, *args):
        pass


def test_http_client(monkeypatch, spark):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        monkeypatch.setenv("SOME_KEY", "k1")
        generate.register("local-model", f"http://127.0.0.1:{server.server_port}/v1", "SOME_KEY", seed=5)
        client = generate.HttpClient.of("local-model")
        s = generate.Sampling(wait=0, retries=3)
        assert generate.call(client, [{"role": "user", "content": "hi"}], s, 1) == generate.Reply("1:hi")
        assert len(Service.seen) == 3 and Service.seen[-1][0] == "Bearer k1"
        assert Service.seen[-1][1] == {"model": "local-model", "messages": [{"role": "user", "content": "hi"}], "temperature": 0.8, "top_p": 0.95, "max_tokens": 2048, "seed": 5}
        assert generate.call(client, [{"role": "user", "content": "long"}], s, 1).finish_reason == "length"
        with pytest.raises(urllib.error.HTTPError):
            generate.call(client, [{"role": "user", "content": "bad"}], s, 1)
        prompts_ = spark.createDataFrame([(i, None, ["a", "b"]) for i in range(6)], "row_id long, system string, user array<string>")
        rows = generate.dialogue(prompts_, client, sampling=s, max_samples=4).collect()
        assert len(rows) == 4 and {(r["response_1"], r["response_2"]) for r in rows} == {("1:a", "3:b")}
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(ConnectionError):
        generate.call(generate.HttpClient("m", f"http://127.0.0.1:{server.server_port}/v1", "k", timeout=1), [{"role": "user", "content": "x"}], generate.Sampling(wait=0, retries=1), 1)
    with pytest.raises(ValueError):
        generate.provider("nobody")


class Engine:
    """Answers many prompts at once and tells how many."""

    def complete_batch(self, chats, samples, **options):
        return [generate.Reply(f"{c[-1]['content'][:1]}/{k}/{len(chats)}") for c, k in zip(chats, samples, strict=True)]


def test_engines_get_batches_with_a_ragged_tail(spark):
    with ThreadPoolExecutor(2) as pool:
        chats = [[{"role": "user", "content": str(i)}] for i in range(10)]
        got = generate.call_many(Engine(), chats, list(range(10)), generate.Sampling(batch=4), pool)
    assert [r.text for r in got] == [f"{i}/{i}/{4 if i < 8 else 2}" for i in range(10)]
    tasks = spark.createDataFrame([("p", "lazy", "old", "do")], "full_name string, instr_kind string, before string, instruction string").coalesce(1)
    rows = generate.complete(tasks, "direct", Engine(), 5, generate.Sampling(batch=2)).collect()
    assert [c.rsplit("/", 2)[1] for c in rows[0]["completions"]] == list("12345")


def test_sheet_file_has_one_header(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "n long, x string")
    for _ in range(2):
        io.append_sheet(rows, f"{tmp_path}/s.csv", "file")
    assert (tmp_path / "s.csv").read_text() == "n,x\n1,a\n1,a\n"


def test_mix_has_exact_quotas(spark):
    rows = spark.range(50).selectExpr("id AS row_id", "'c' AS commit", "array('s') AS code_snippet", "'b' AS code_before_purify", "CAST(NULL AS STRING) AS code_after_purify", "'d' AS instruct_descriptive_purify", "'l' AS instruct_lazy_purify")
    out = mix.mix([mix.Source(rows, 0.25, "lazy", "m"), mix.Source(rows, 0.75, "descriptive")], 21).collect()
    assert sorted((r["instr_type"] for r in out)) == ["m_lazy"] * 5 + ["unknown_descriptive"] * 16
    assert all(r["code_after_purify"] == "" for r in out)
    with pytest.raises(ValueError):
        mix.mix_rows(rows, "other")
    both = mix.finetune_set([mix.mix_rows(rows, "lazy")], "share_gpt", 1).collect()
    assert len({r["messages"][1]["content"].count("```") for r in both}) == 2
    with pytest.raises(ValueError):
        mix.finetune_rows(rows, "x")


def test_pass_at_k(spark):
    rows = [(20, 5, 1), (20, 7, 5), (5, 0, 1), (5, 5, 2), (3, 1, 10), (0, 0, 1), (4, 3, 2)]
    df = spark.createDataFrame(rows, "n int, c int, k int")

    def plain(n, c, k):
        if n - c < k:
            return 1.0
        p = 1.0
        for i in range(n - c + 1, n + 1):
            p *= 1 - k / i
        return 1 - p

    got = [r[0] for r in df.select(evalmetrics.pass_at_k(F.col("n"), F.col("c"), F.col("k"))).collect()]
    assert got == pytest.approx([plain(*r) for r in rows], abs=1e-12)


def test_results_from_files(spark, tmp_path):
    one = {"id": 1, "before": "a\nb", "instr_kind": "lazy", "temperature": 0.2, "taxonomy": {"change_kind": "x"}, "results": [{"status": "OK", "exit_code": 0, "program_no_test": "a\nc", "coverage": 80.0, "coverage_missing": [1]}, {"status": "OK", "exit_code": 1, "program_no_test": "", "coverage": None, "coverage_missing": []}]}
    for d, temps in (("m/run", [0.2, None]), ("m/mixed", [0.2, 0.7])):
        (tmp_path / d).mkdir(parents=True)
        for i, t in enumerate(temps):
            r = {**one, "id": i + 1}
            r.pop("temperature") if t is None else r.update(temperature=t)
            if i:
                (tmp_path / d / f"{i}.results.json").write_text(json.dumps(r, indent=1))
            else:
                with gzip.open(tmp_path / d / f"{i}.results.json.gz", "wt") as f:
                    json.dump(r, f)
    (tmp_path / "m/run/bad.results.json.gz").write_bytes(b"no gzip")
    (tmp_path / "m/run/bad.results.json").write_text("{no json")
    rows = io.leaf_folders(io.read_results(spark, str(tmp_path), schemas.RESULT)).withColumn("row_id", F.xxhash64("name", "id"))
    out = evalmetrics.as_sheet(evalmetrics.by_directory(evalmetrics.per_problem(rows))).collect()
    assert [tuple(r) for r in out] == [("m", "run", 1, 50.0, 2, 2, 2, 33.333333, 0.0, 20.0)]


def test_jsonl_round_trips(spark, tmp_path):
    p = str(tmp_path / "a")
    rows = spark.createDataFrame([("é😀", None), ("b", "x")], "commit string, message string")
    io.write_jsonl(rows, p, ascii_only=True)
    text = "".join(f.read_text() for f in (tmp_path / "a").glob("part*"))
    assert text.isascii() and "\\ud83d\\ude00" in text
    with open(tmp_path / "a" / "extra.json", "w") as f:
        f.write('\n{"commit": "c"}\n{bad\n')
    assert sorted(r["commit"] for r in io.read_jsonl(spark, p, schemas.COMMIT).collect()) == ["b", "c", "é😀"]
    assert io.decode(io.read_lines(spark, p), schemas.COMMIT).filter("commit is not null").count() == 3
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        io.read_jsonl(spark, p, schemas.COMMIT, strict=True).collect()
    kept, missing = io.project(rows, ["message", "none", "commit"])
    assert kept.columns == ["message", "commit"] and missing == ["none"]
    assert io.split_rejects(rows, F.col("message").isNotNull(), str(tmp_path / "r")).count() == 1 and spark.read.json(str(tmp_path / "r")).count() == 1


def test_escaping_grows_as_the_text(spark):
    texts = ["", "a", "é", "a\x7f\x80", "é😀ÿz", "\U0010ffff😀\uffff", "$1 \\u é\\", "aé日😀" * 100_000]
    began = time.time()
    got = [r["e"] for r in spark.createDataFrame([(x,) for x in texts], "x string").select(io.escape(F.col("x")).alias("e")).collect()]
    assert got == ["".join(c if c.isascii() else json.dumps(c)[1:-1] for c in x) for x in texts]
    assert time.time() - began < 30  # character by character from the start of the line it is minutes


def test_sheets_and_completions(spark, tmp_path):
    df = spark.createDataFrame([("p1", "lazy", 1)], "full_name string, instr_kind string, v int")
    for v in (1, 2):
        io.write_completions(df.withColumn("v", F.lit(v)), str(tmp_path / "c"))
    assert [r["v"] for r in spark.read.json(str(tmp_path / "c")).collect()] == [2]
    io.append_sheet(df, str(tmp_path / "s"))
    io.append_sheet(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    assert io.to_csv(spark.sql("SELECT 1 AS a, CAST(NULL AS DOUBLE) AS b")) == "a,b\n1,NA\n"
    (tmp_path / "c.yaml").write_text("a: 1\n")
    assert io.read_config(str(tmp_path / "c.yaml"), ("a",)) == {"a": 1}
    with pytest.raises(ValueError):
        io.read_config(str(tmp_path / "c.yaml"), ("b",))


class Flaky:
    def __init__(self):
        self.calls = 0

    def complete(self, messages, **options):
        self.calls += 1
        if self.calls % 2:
            raise generate.BusyError
        return generate.Reply("".join(m["content"] for m in messages))


def test_dialogue_keeps_context_and_retries(spark):
    df = spark.createDataFrame([(1, "S", ["a", "b"]), (2, "S", ["a", " "]), (3, None, ["c"])], "row_id long, system string, user array<string>")
    rows = sorted(generate.dialogue(df, Flaky(), sampling=generate.Sampling(wait=0, threads=1)).collect())
    assert [(r["row_id"], r["response_1"], r["response_2"]) for r in rows] == [(1, "Sa", "SaSab"), (3, "c", None)]


def test_models_ask_and_read(spark):
    problems = spark.createDataFrame([("p", "x = 1", "D", "L")], "full_name string, before string, instruction_descriptive string, instruction_lazy string")
    tasks = generate.benchmark_tasks(problems)
    assert tasks.count() == 2
    for name in generate.MODELS:
        rows = generate.complete(tasks, name, completions=2).collect()
        assert len(rows) == 2 and all(len(r["completions"]) == 2 for r in rows)
    for bad in (generate.edit_model, generate.provider):
        with pytest.raises(ValueError):
            bad("nothing")


def test_resume_is_idempotent(spark, tmp_path):
    src, sink, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(5).write.json(src)
    for _ in range(2):
        resume.run_available(spark, src, "id long", lambda d: d.withColumn("y", F.col("id") * 2), sink, check).awaitTermination()
    spark.range(5, 8).write.mode("append").json(src)
    resume.run_available(spark, src, "id long", lambda d: d.withColumn("y", F.col("id") * 2), sink, check).awaitTermination()
    assert sorted(r["y"] for r in resume.read_sink(spark, sink).collect()) == [2 * i for i in range(8)]
    rows = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "k int, s int")
    for _ in range(2):
        resume.append_new(rows, str(tmp_path / "t"), ["k", "s"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_topics(spark, tmp_path):
    df = spark.createDataFrame([(i, "apple pear fruit tree" if i % 2 else "engine wheel motor road", "a", "a\nb") for i in range(40)] + [(40, "", "a", "a\nb")], "row_id long, t string, code_before_purify string, code_after_purify string")
    words = df.withColumn("w", topics.topic_words(F.col("t")))
    model = topics.fit(words, "w", k=4, cache=str(tmp_path))
    again = topics.fit(words, "w", k=4, cache=str(tmp_path))
    rows = {r["row_id"]: r["topic"] for r in topics.assign(words, model).collect()}
    assert rows[40] == -1 and rows == {r["row_id"]: r["topic"] for r in topics.assign(words, again).collect()}
    assert topics.diversity_filter(df, F.col("t"), "row_id", max_total=10, k=4).count() == 10
    v = spark.createDataFrame([([1.0, 3.0, 3.0],), ([0.0, 0.0],), ([],), (None,)], "v array<double>")
    assert [r[0] for r in v.select(topics.dominant(F.col("v"))).collect()] == [1, -1, -1, -1]


def test_topics_compute_words_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([(i, "apple pear fruit tree" if i % 2 else "engine wheel motor road", "a", "a\nb") for i in range(40)], "row_id long, t string, code_before_purify string, code_after_purify string")
    out = topics.diversity_filter(df, counted("t"), "row_id", max_total=10, k=2)
    assert out.columns == df.columns and out.count() == 10 and seen.value == 40
    assert topics.diversity_filter(df, F.col("t"), "row_id", max_total=10, k=2, carry=("t",)).columns == ["t"]


def test_statistics(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (4, 8), (90, 1)], "modified_lines int, hunks int")
    s = stats.summary(df).first()
    assert (s["modified_lines_median"], s["modified_lines_over"], s["hunks_over_ratio"]) == (3.0, 1, 0.25)
    assert stats.summary(df.limit(0)).first()["modified_lines_over"] == 0
    assert {r["bin"]: r["n"] for r in stats.histogram(df, "modified_lines", 5).collect()} == {0: 3, 85: 1}
    pairs = spark.createDataFrame([("add", "f")] * 3 + [("add", "g")] * 2 + [("add", "h"), ("fix", "x")], "verb string, object string")
    top = stats.top_pairs(stats.pair_counts(pairs), 1, 1)
    assert sorted(tuple(r) for r in top.collect()) == [("add", "<other>", 3), ("add", "f", 3)]
    with pytest.raises(ValueError):
        stats.explode_pairs(pairs, "verb", None)
