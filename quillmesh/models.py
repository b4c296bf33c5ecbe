"""Calls to language models: cached, retried, paced. The transport, the clock and sleep are given, so tests need no network."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Transport = Callable[[dict], tuple[int, dict, str]]  # request to status, headers, body


class ModelError(RuntimeError):
    pass


def cache_key(model: str, version: str, temperature: float, messages: list[dict]) -> str:
    return hashlib.sha256(json.dumps([model, version, temperature, messages], ensure_ascii=False).encode()).hexdigest()


def parse_object(reply: str) -> dict:
    """The JSON object of a reply: fenced, bare, or from the first brace to the last."""
    inner = re.sub(r"^```(?:json)?\s*|\s*```$", "", reply.strip())
    for text in (inner, (re.search(r"(?s)\{.*\}", inner) or [""])[0]):
        try:
            found = json.loads(text)
        except json.JSONDecodeError:
            continue
        if isinstance(found, dict):
            return found
        break
    raise ModelError(f"no JSON object: {reply[:200]!r}")


def duration(value: str | None) -> float | None:
    """Seconds of 7.66s, 1m2.5s, 120ms or 3."""
    value = (value or "").strip()
    if re.fullmatch(r"\d*\.?\d+", value):
        return float(value)
    parts = re.findall(r"([\d.]+)(ms|h|m|s)", value)
    return sum(float(n) * {"ms": 0.001, "s": 1, "m": 60, "h": 3600}[u] for n, u in parts) if parts else None


@dataclass
class Client:
    """One model account. Denied providers are refused; 400, 401, 403 and 404 are final; 429 waits as told (at most twelve times,
    beside the retries); other failures wait 2, 4, 8 ... seconds, two minutes at most."""

    transport: Transport
    version: str = "v1"
    retries: int = 3
    interval: float = 2.5
    denied: str = ""
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    cache: dict[str, dict] = field(default_factory=dict)
    calls: int = 0
    hits: int = 0
    plain: set[str] = field(default_factory=set)  # models without a JSON mode
    _next: float = 0.0

    def chat(self, model: str, messages: list[dict], temperature: float = 0.2, max_tokens: int = 1200) -> dict:
        if self.denied and re.search(self.denied, model):
            raise ModelError(f"{model} is denied")
        key = cache_key(model, self.version, temperature, messages)
        if key in self.cache:
            self.hits += 1
            return self.cache[key]
        request = {"model": model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens}
        if re.search(r"(?i)gpt-oss|qwen3|deepseek-r1|reason", model):
            request |= {"reasoning_effort": "low", "max_tokens": max_tokens * 2}
        if model not in self.plain:
            request["response_format"] = {"type": "json_object"}
        try:
            reply = self._send(request)
        except ModelError as e:
            if "response_format" not in request or "json" not in str(e).lower():
                raise
            self.plain.add(model)
            reply = self._send({k: v for k, v in request.items() if k != "response_format"})
        self.cache[key] = found = parse_object(reply)
        return found

    def _send(self, request: dict) -> str:
        failed = waited = 0
        while True:
            if (pause := self._next - self.clock()) > 0:
                self.sleep(pause)
            self._next = self.clock() + self.interval
            self.calls += 1
            try:
                status, headers, body = self.transport(request)
            except OSError as e:
                status, headers, body = 599, {}, str(e)
            if 200 <= status < 300:
                if int(headers.get("x-ratelimit-remaining-tokens", "3000") or 0) < 3000:
                    self._next = max(self._next, self.clock() + (duration(headers.get("x-ratelimit-reset-tokens")) or 0))
                return json.loads(body)["choices"][0]["message"]["content"]
            if status in (400, 401, 403, 404):
                raise ModelError(f"{status}: {body[:300]}")
            told = duration(headers.get("retry-after")) or duration((re.search(r"try again in ([\dhms.]+)", body) or [None, ""])[1])
            if status == 429 and told is not None and waited < 12:
                waited += 1
                self.sleep(told + 0.5)
                continue
            failed += 1
            if failed > self.retries:
                raise ModelError(f"{status}: {body[:300]}")
            self.sleep(min(120.0, 2.0 * 2 ** (failed - 1)))


def replies(prompts: DataFrame, make: Callable[[], Client], model: str, cache: DataFrame | None = None, stop: str = "401|403|404") -> DataFrame:
    """prompts (item_id, key, system, user) with reply (JSON text) and error. Known keys are joined from the cache, each other key
    is asked once, by one client a task; a task ends asking where the account or model fails for good."""
    asked = prompts.select("key", "system", "user").dropDuplicates(["key"])
    known = cache.select("key", "reply") if cache is not None else None
    todo = asked.join(known.select("key"), "key", "left_anti") if known is not None else asked

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, ended = make(), ""
        for b in batches:
            out = []
            for r in b.itertuples():
                reply, error = None, ended
                if not ended:
                    try:
                        reply, error = json.dumps(client.chat(model, [{"role": "system", "content": r.system}, {"role": "user", "content": r.user}]), ensure_ascii=False), None
                    except ModelError as e:
                        error = str(e)
                        ended = error if re.match(stop, error) else ""
                out.append((r.key, reply, error))
            yield pd.DataFrame(out, columns=["key", "reply", "error"])

    fresh = todo.mapInPandas(run, "key string, reply string, error string")
    if known is not None:
        fresh = fresh.unionByName(known.withColumn("error", F.lit(None).cast("string")))
    return prompts.join(fresh, "key", "left")


def better(first: dict, first_problems: list[str], again: Callable[[list[str]], tuple[dict, list[str]]]) -> tuple[dict, list[str], bool]:
    """An issue, or its second try if that has no more problems; the third value says whether there was one."""
    if not first_problems:
        return first, first_problems, False
    second, problems = again(first_problems)
    return (second, problems, True) if len(problems) <= len(first_problems) else (first, first_problems, True)


EXTRACT = "Read one newsletter item. Reply with a JSON object: summary, category, importance (1 to 5), entities, claims, stats, quotes, topics. State only what the item says, numbers and quotes as it writes them."
COMPOSE = "Write a short issue about the ranked stories. Every sentence cites its notes as [iN]. Use no number, name or wording of eleven words that the cited notes lack otherwise than as a fact. Reply with a JSON object: subject, hook, top_story, talking_about, quick_hits, safe_to_skip, close."
POINTS = "Compare the notes on one story. Reply with a JSON object: consensus and divergence, each at most three points with text and items (ids of the notes)."
