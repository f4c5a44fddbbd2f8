"""Model backends: batches of prompts in, texts out. A backend is built once for each worker process."""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class RateLimited(Exception):
    """The service asks for a pause; it does not count as an attempt."""


class Backend(Protocol):
    def generate(self, prompts: list[str], images: list[str | None]) -> list[str]: ...


@dataclass(frozen=True)
class EchoBackend:
    """Deterministic answers in the key / value format, for tests and dry runs; prompts with a marker fail."""

    fail_on: str = "[fail]"

    def generate(self, prompts: list[str], images: list[str | None]) -> list[str]:
        out = []
        for p in prompts:
            if self.fail_on in p:
                raise RuntimeError("echo backend was told to fail")
            n = len(p)
            out.append(f"# aesthetic_score\n0.{n % 10}\n# nsfw_score\n0.0\n# quality_score\n0.5\n# title\n{p[:20].strip() or 'none'}\n# brief\n{n} characters\n# description\n{p}")
        return out


@dataclass(frozen=True)
class Retry:
    """Attempts and pauses; every call ends at the deadline, rate limits included. Rate limits use up no attempt, but pause
    longer each time and count as retries; `place` tells calls apart, so that no two workers pause alike."""

    attempts: int = 3
    delay: float = 1.0
    factor: float = 2.0
    longest: float = 30.0
    deadline: float = 600.0
    seed: int = 0
    sleep: Callable[[float], None] = field(default=time.sleep, compare=False)

    def call(self, run: Callable[[], list[str]], place: str = "") -> tuple[list[str] | None, str | None, int]:
        """(answers, error, retries)."""
        rng, ends = random.Random(f"{self.seed} {place}"), time.monotonic() + self.deadline
        delay, used, limited = self.delay, 0, 0
        while True:
            try:
                return run(), None, used + limited
            except RateLimited as e:
                error, wait = str(e) or "rate limited", min(delay * rng.uniform(0.5, 1.5), self.longest)
                limited += 1
            except Exception as e:  # the backend's failures are the row's error
                error, wait = str(e) or type(e).__name__, min(delay, self.longest)
                used += 1
                if used > self.attempts:
                    return None, error, used - 1 + limited
            if time.monotonic() + wait > ends:
                return None, f"{error} (deadline)", used + limited
            delay = min(delay * self.factor, self.longest)
            self.sleep(wait)


GENERATED = [T.StructField("raw", T.StringType()), T.StructField("success", T.BooleanType()), T.StructField("error", T.StringType()), T.StructField("retries", T.IntegerType()), T.StructField("latency_ms", T.DoubleType())]
_BUILT: dict[object, Backend] = {}


def _built(make: Callable[[], Backend], key: object) -> Backend:
    if key not in _BUILT:
        _BUILT[key] = make()
    return _BUILT[key]


def generate(df: DataFrame, make: Callable[[], Backend], key: str, prompt: str = "prompt", image: str | None = None, batch: int = 8, retry: Retry = Retry()) -> DataFrame:  # noqa: B008
    """Adds raw, success, error, retries and latency_ms; rows never fail the job.

    mapInPandas keeps the call where it is written: filters and joins that save calls belong before it. A batch that
    fails as a whole is tried row by row, so that one bad row costs itself alone. make() runs once for each worker under `key`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend, part, at = _built(make, key), TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, len(whole), batch):
                rows = whole.iloc[lo : lo + batch]
                prompts = rows[prompt].fillna("").tolist()
                images = rows[image].tolist() if image else [None] * len(rows)
                began = time.monotonic()
                at += len(rows)
                answers, _, used = retry.call(lambda p=prompts, i=images: backend.generate(p, i), f"{part} {at}") if len(rows) > 1 else (None, None, 0)
                took = (time.monotonic() - began) * 1000 / len(rows)
                if answers is not None:
                    made = [(a, True, None, used, took) for a in answers]
                else:
                    made = []
                    for n, (p, i) in enumerate(zip(prompts, images, strict=True)):
                        began = time.monotonic()
                        one, error, used = retry.call(lambda p=p, i=i: backend.generate([p], [i]), f"{part} {at} {n}")
                        made.append((one[0] if one else None, one is not None, error, used, (time.monotonic() - began) * 1000))
                raw, ok, errors, retries, latency = zip(*made, strict=True)
                yield rows.assign(raw=list(raw), success=list(ok), error=list(errors), retries=list(retries), latency_ms=list(latency))

    kept = df.drop(*[f.name for f in GENERATED])
    return kept.mapInPandas(run, T.StructType(kept.schema.fields + GENERATED))


# The variables that hold each provider's key, and where its service is.
KEY_VARIABLES = {"openai": "OPENAI_API_KEY", "openrouter": "OPENROUTER_API_KEY"}
BASE_URLS = {"openai": "https://api.openai.com/v1", "openrouter": "https://openrouter.ai/api/v1"}


@dataclass(frozen=True)
class ChatBackend:
    """A chat-completions service; the key is read on the worker, from the environment, unless it is given. A batch's requests
    run side by side, `concurrency` at a time, and its answers come in the order of its rows. `options` go into the body as
    they are (temperature, top_k, provider, transforms ...); `schema` is JSON text that the answer must follow."""

    provider: str
    model: str
    key: str | None = None
    base_url: str | None = None
    timeout: float = 60.0
    concurrency: int = 5
    options: tuple[tuple[str, object], ...] = ()
    system: str | None = None
    schema: str | None = None
    strict: bool = True
    site_url: str | None = None
    site_name: str | None = None

    def settings(self) -> dict:
        if self.provider not in KEY_VARIABLES:
            raise ValueError(f"unknown provider: {self.provider}")
        key = self.key or os.environ.get(KEY_VARIABLES[self.provider])
        if not key:
            raise ValueError(f"no API key: give one or set {KEY_VARIABLES[self.provider]}")
        named = {"HTTP-Referer": self.site_url, "X-Title": self.site_name} if self.provider == "openrouter" else {}
        headers = {"Authorization": f"Bearer {key}", "Content-Type": "application/json", **{k: v for k, v in named.items() if v}}
        return {"url": f"{self.base_url or BASE_URLS[self.provider]}/chat/completions", "headers": headers}

    def body(self, prompt: str, image: str | None) -> dict:
        content: list[dict] = [{"type": "text", "text": prompt}]
        if image:
            content.append({"type": "image_url", "image_url": {"url": image, "detail": "auto"}})
        messages: list[dict] = [{"role": "system", "content": self.system}] if self.system else []
        body = {"model": self.model, "messages": [*messages, {"role": "user", "content": content}], **dict(self.options)}
        if self.schema:
            body["response_format"] = {"type": "json_schema", "json_schema": {"name": "caption_response", "strict": self.strict, "schema": json.loads(self.schema)}}
        return body

    def ask(self, prompt: str, image: str | None) -> str:
        import urllib.error
        import urllib.request

        own = self.settings()
        request = urllib.request.Request(own["url"], json.dumps(self.body(prompt, image)).encode(), own["headers"])
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                content = json.load(answer)["choices"][0]["message"]["content"]
        except urllib.error.HTTPError as e:
            if e.code == 429:
                raise RateLimited(str(e)) from e
            raise
        if content is None:
            raise RuntimeError("the answer has no content")
        return content

    def generate(self, prompts: list[str], images: list[str | None]) -> list[str]:
        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(self.ask, prompts, images))
