"""Model calls. A client is anything with ``complete(messages, **options) -> Reply``; without one a deterministic stub answers."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import templates, text
from ..sources.io import api_key
from .sampling import sample_exact


@dataclass(frozen=True)
class Reply:
    text: str
    finish_reason: str = "stop"


class Client(Protocol):
    def complete(self, messages: list[dict[str, str]], **options: Any) -> Reply: ...


class BusyError(RuntimeError):
    """The service asks to wait, for as long as it says or else as the sampling says."""

    def __init__(self, message: str = "", wait: float | None = None):
        super().__init__(message)
        self.wait = wait


class StubClient:
    """A pure function of the last turn, the number of turns and the sample: the md5 of the three."""

    def complete(self, messages: list[dict[str, str]], sample: int = 1, **options: Any) -> Reply:
        return Reply("echo " + hashlib.md5(f"{messages[-1]['content']}#{len(messages)}#{sample}".encode()).hexdigest())


@dataclass(frozen=True)
class Provider:
    """Where a model is served; the key is the name of an environment variable."""

    endpoint: str
    key: str
    extra: dict[str, Any] = field(default_factory=dict)


PROVIDERS: dict[str, Provider] = {
    "gpt-4o-mini": Provider("https://api.openai.com/v1/chat/completions", "OPENAI_API_KEY"),
    "deepseek-chat": Provider("https://api.deepseek.com/chat/completions", "DEEPSEEK_API_KEY"),
}


def register(model: str, endpoint: str, key: str, **extra: Any) -> None:
    """Where a further model is served, with options that every request to it has."""
    PROVIDERS[model] = Provider(endpoint, key, extra)


def provider(model: str) -> Provider:
    if model not in PROVIDERS:
        raise ValueError(f"no provider is registered for {model!r}")
    return PROVIDERS[model]


@dataclass(frozen=True)
class HttpClient:
    """Chat completions over HTTP, as most services offer them: POST of model, messages and options, the key as a bearer
    token. Too many requests and a server's errors ask to wait; other refusals stop the job."""

    model: str
    endpoint: str
    key: str
    extra: dict[str, Any] = field(default_factory=dict)
    timeout: float = 120.0
    busy_wait: float = 120.0

    @classmethod
    def of(cls, model: str, **options: Any) -> HttpClient:
        p = provider(model)
        return cls(model, p.endpoint, api_key(p.key), p.extra, **options)

    def complete(self, messages: list[dict[str, str]], sample: int = 1, **options: Any) -> Reply:
        body = json.dumps({"model": self.model, "messages": messages, **options, **self.extra}).encode()
        ask = urllib.request.Request(self.endpoint, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        try:
            with urllib.request.urlopen(ask, timeout=self.timeout) as f:
                choice = json.load(f)["choices"][0]
        except urllib.error.HTTPError as e:
            if e.code == 429:
                after = e.headers.get("Retry-After", "")
                raise BusyError("too many requests", float(after) if after.isdigit() else self.busy_wait) from e
            if e.code >= 500:
                raise BusyError(f"the service answers {e.code}") from e
            raise
        except urllib.error.URLError as e:
            raise ConnectionError(str(e.reason)) from e
        return Reply(choice["message"]["content"] or "", choice.get("finish_reason") or "stop")


class BatchClient(Protocol):
    """An engine that answers many prompts at once. Its replies are in the order of the prompts."""

    def complete_batch(self, chats: list[list[dict[str, str]]], samples: list[int], **options: Any) -> list[Reply]: ...


@dataclass(frozen=True)
class Sampling:
    temperature: float = 0.8
    top_p: float = 0.95
    max_tokens: int = 2048
    retries: int = 5
    wait: float = 10.0
    threads: int = 8
    batch: int = 32


def patient(ask: Callable[[], Any], s: Sampling) -> Any:
    """What `ask` returns, after waiting and asking again where the service wants that."""
    for attempt in range(s.retries):
        try:
            return ask()
        except (BusyError, ConnectionError, TimeoutError) as e:
            if attempt == s.retries - 1:
                raise
            time.sleep(s.wait if getattr(e, "wait", None) is None else e.wait)
    raise AssertionError


def options(s: Sampling) -> dict[str, Any]:
    return {"temperature": s.temperature, "top_p": s.top_p, "max_tokens": s.max_tokens}


def call(client: Client, messages: list[dict[str, str]], s: Sampling, sample: int) -> Reply:
    return patient(lambda: client.complete(messages, sample=sample, **options(s)), s)


def call_many(client: Client | BatchClient, chats: list[list[dict[str, str]]], samples: list[int], s: Sampling, pool: ThreadPoolExecutor) -> list[Reply]:
    """Replies in order. An engine gets batches of s.batch, the last one as short as it comes; another client gets a call a
    prompt, several at once."""
    if not hasattr(client, "complete_batch"):
        return list(pool.map(lambda x: call(client, x[0], s, x[1]), zip(chats, samples, strict=True)))
    out: list[Reply] = []
    for k in range(0, len(chats), s.batch):
        part = slice(k, k + s.batch)
        got = patient(lambda part=part: client.complete_batch(chats[part], samples[part], **options(s)), s)
        if len(got) != len(chats[part]):
            raise ValueError("an engine must give one reply a prompt")
        out += got
    return out


def dialogue(prompts: DataFrame, client: Client | None = None, completions: int = 1, sampling: Sampling = Sampling(), key: str = "row_id", max_samples: int | None = None, seed: int = 42) -> DataFrame:
    """prompts (key, system, user array) -> rows with sample_index 1.. and `response`, one text a turn. Of more than
    max_samples prompts as many are drawn.

    Every user turn is put behind the replies so far. Prompts with a blank turn are left out. A task that runs again asks
    again: (key, sample_index) names a reply, and sinks keep one of each.
    """
    client = client or StubClient()
    if max_samples is not None:
        prompts = sample_exact(prompts, max_samples, key, seed)
    rows = prompts.filter(F.forall("user", lambda u: F.length(text.strip(u)) > 0) & (F.size("user") > 0))
    rows = rows.withColumn("sample_index", F.explode(F.sequence(F.lit(1), F.lit(completions))))

    def one(system: str | None, turns: list[str], sample: int) -> list[str]:
        chat = [{"role": "system", "content": system}] if system else []
        out = []
        for t in turns:
            chat.append({"role": "user", "content": t})
            out.append(call(client, chat, sampling, sample).text)
            chat.append({"role": "assistant", "content": out[-1]})
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(sampling.threads) as pool:
            for f in frames:
                f = f.copy()
                f["response"] = list(pool.map(one, f["system"], map(list, f["user"]), f["sample_index"]))
                yield f

    schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema) + ", response array<string>"
    made = rows.mapInPandas(run, schema)
    return made.withColumns({"response_1": F.get("response", F.lit(0)), "response_2": F.get("response", F.lit(1))})


# benchmark completions


@dataclass(frozen=True)
class EditModel:
    """How a kind of model is asked and read: prompt(old, instruction) -> Column of text or of messages, formatter of messages,
    post-processing of the reply, and stop strings."""

    prompt: Callable[[Column, Column], Column]
    chat: bool = False
    formatter: Callable[[Column], Column] | None = None
    post: Callable[[Column], Column] = lambda c: c
    stops: tuple[str, ...] = ()
    drop_truncated: bool = False


END = ("<|endoftext|>",)
MARKS = ("## Code After", "## Instruction", "## Code Before")
MODELS: dict[str, EditModel] = {
    "starcoder": EditModel(templates.commit_prompt, stops=(*END, "<commit_before>", "<commit_msg>", "<commit_after>")),
    "direct": EditModel(templates.edit_prompt, stops=(*END, *MARKS)),
    "direct-system": EditModel(templates.system_edit_prompt, stops=(*END, *MARKS)),
    "direct-1shot": EditModel(templates.one_shot_prompt, stops=(*END, *MARKS)),
    "starcoder2": EditModel(templates.issue_prompt, post=lambda c: text.cut_at(c, ("```",)), stops=("```", "<issue_comment>", *END)),
    "octocoder": EditModel(templates.chat_prompt_one_shot, True, templates.question_answer, text.first_block, ("\nQuestion:", "\nAnswer:", *END)),
    "qwencoder": EditModel(templates.chat_prompt, True, templates.im_blocks, text.first_block, ("<|im_end|>", *END)),
    "qwen3": EditModel(templates.chat_prompt, True, lambda m: templates.im_blocks(m, "/no_think"), text.first_block, ("<|im_end|>", *END)),
    "qwen3-think": EditModel(templates.chat_prompt, True, lambda m: templates.im_blocks(m, "/think"), text.first_block, ("<|im_end|>", *END)),
    "deepseek": EditModel(templates.chat_prompt, True, templates.user_assistant, text.first_block, ("\nUser:", "<|EOT|>", *END)),
    "chat": EditModel(templates.chat_prompt_one_shot, True, None, text.first_block, (), True),
    "chat-no-system": EditModel(lambda o, i: templates.fold_system(templates.chat_prompt(o, i)), True, None, text.first_block, (), True),
    "unified-diff": EditModel(templates.chat_prompt_diff, True, None, text.first_block, (), True),
}


def edit_model(name: str) -> EditModel:
    if name not in MODELS:
        raise ValueError(f"no model of type {name!r}; there are {', '.join(MODELS)}")
    return MODELS[name]


def benchmark_tasks(problems: DataFrame, kinds=("descriptive", "lazy"), done: DataFrame | None = None) -> DataFrame:
    """A row per problem and kind of instruction (full_name, before, instr_kind, instruction) that is not done yet. A table
    with one instruction column has one kind."""
    if "instruction" in problems.columns and "instruction_descriptive" not in problems.columns:
        rows = problems.withColumn("instr_kind", F.lit("instruct"))
    else:
        rows = problems.withColumn("t_", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"instruction_{k}").alias("i")) for k in kinds)))).withColumns({"instr_kind": F.col("t_.k"), "instruction": F.col("t_.i")}).drop("t_")
    return rows if done is None else rows.join(done.select("full_name", "instr_kind").distinct(), ["full_name", "instr_kind"], "left_anti")


def complete(tasks: DataFrame, model: str, client: Client | None = None, completions: int = 20, sampling: Sampling = Sampling(temperature=0.2)) -> DataFrame:
    """Adds prompt and the array `completions` in the order of their numbers."""
    m, client = edit_model(model), client or StubClient()
    asked = m.prompt(F.col("before"), F.col("instruction"))
    if m.chat and m.formatter is not None:
        asked = m.formatter(asked)
    plain = not m.chat or m.formatter is not None
    rows = tasks.withColumn("asked", asked).withColumn("prompt", F.col("asked") if plain else F.to_json("asked"))
    rows = rows.withColumn("sample_index", F.explode(F.sequence(F.lit(1), F.lit(completions))))
    stops = tuple(dict.fromkeys(m.stops))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(sampling.threads) as pool:
            for f in frames:
                chats = [[{"role": "user", "content": a}] if plain else [dict(x) if isinstance(x, dict) else x.asDict() for x in a] for a in f["asked"]]
                replies = call_many(client, chats, f["sample_index"].tolist(), sampling, pool)
                yield pd.DataFrame({"full_name": f["full_name"], "instr_kind": f["instr_kind"], "sample_index": f["sample_index"], "reply": [r.text for r in replies], "cut": [r.finish_reason == "length" for r in replies]})

    made = rows.select("full_name", "instr_kind", "asked", "sample_index").mapInPandas(run, "full_name string, instr_kind string, sample_index int, reply string, cut boolean")
    if m.drop_truncated:
        made = made.filter(~F.col("cut"))
    made = made.withColumn("text", m.post(text.cut_at(F.col("reply"), stops)))
    lists = made.groupBy("full_name", "instr_kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("sample_index", "text"))), lambda x: x["text"]).alias("completions"))
    first = rows.filter("sample_index = 1").drop("sample_index", "asked")
    extra = {"language": F.lit("py"), "temperature": F.lit(sampling.temperature), "top_p": F.lit(sampling.top_p), "max_tokens": F.lit(sampling.max_tokens), "stop_tokens": F.array(*map(F.lit, stops)) if stops else F.array().cast("array<string>")}
    return first.join(lists, ["full_name", "instr_kind"], "left").withColumns({"completions": F.coalesce("completions", F.array().cast("array<string>")), **extra})
