import time

import pytest
from pyspark.sql import functions as F

from captionloom.plans.backends import ChatBackend, EchoBackend, RateLimited, Retry, generate
from captionloom.plans.captioning import caption


class Moody:
    """Answers in the right format from the second time that it sees a prompt."""

    def __init__(self, folder):
        self.folder = folder

    def generate(self, prompts, images):
        out = []
        for p in prompts:
            seen = self.folder / p
            out.append(EchoBackend().generate([p], [None])[0] if seen.exists() or p != "odd" else "no format")
            seen.write_text("x")
        return out


def quiet(_):
    pass


def test_retry_counts_and_deadline():
    calls = []

    def limited():
        calls.append(1)
        if len(calls) < 4:
            raise RateLimited("slow down")
        return ["ok"]

    assert Retry(attempts=1, sleep=quiet).call(limited) == (["ok"], None, 3)

    def broken():
        raise RuntimeError("no")

    assert Retry(attempts=3, sleep=quiet).call(broken) == (None, "no", 3)
    assert Retry(attempts=0, sleep=quiet).call(broken) == (None, "no", 0)
    began = time.monotonic()

    def always():
        raise RateLimited("wait")

    answer, error, _ = Retry(delay=5.0, deadline=0.1).call(always)
    assert answer is None and error == "wait (deadline)" and time.monotonic() - began < 2


def test_a_failing_row_costs_itself_alone(spark):
    df = spark.createDataFrame([(k, "x [fail]" if k == 3 else f"p{k}") for k in range(10)], "image_id int, prompt string").coalesce(1)
    rows = {r.image_id: r for r in generate(df, EchoBackend, "echo-test", batch=4, retry=Retry(attempts=1, sleep=quiet)).collect()}
    assert [k for k, r in rows.items() if not r.success] == [3] and "told to fail" in rows[3].error and rows[3].raw is None


def test_validation_passes_and_skips(spark, tmp_path):
    df = spark.createDataFrame([(1, "good"), (2, "odd"), (3, "done")], "image_id int, prompt string")
    out = caption(df, lambda: Moody(tmp_path), f"moody-{tmp_path}", done=spark.createDataFrame([(3,)], "image_id int"), retry=Retry(sleep=quiet))
    got = {r.image_id: (r.success, r.passes) for r in out.collect()}
    assert got == {1: (True, 1), 2: (True, 2)}
    never = caption(df.where("image_id = 2"), lambda: type("X", (), {"generate": lambda self, p, i: ["nothing"] * len(p)})(), "never", validation_retries=1, retry=Retry(sleep=quiet)).collect()
    assert [(r.success, r.passes, r.error) for r in never] == [(False, 2, "No valid # key / value pairs found")]


def test_chat_backend_settings(monkeypatch):
    monkeypatch.delenv("OPENAI_API_KEY", raising=False)
    with pytest.raises(ValueError):
        ChatBackend("openai", "m").settings()
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    assert ChatBackend("openai", "m").settings()["headers"]["Authorization"] == "Bearer k"
    with pytest.raises(ValueError):
        ChatBackend("nobody", "m").settings()
    body = ChatBackend("openrouter", "m", key="k", options=(("top_k", 3),)).body("p", "http://i")
    assert body["top_k"] == 3 and body["messages"][0]["content"][1]["image_url"]["url"] == "http://i"


def test_filters_come_before_the_model(spark):
    """The anti join runs below the model call in the plan."""
    items = spark.createDataFrame([(1, "a")], "image_id int, prompt string")
    done = spark.createDataFrame([(2,)], "image_id int")
    plan = generate(items.join(done, "image_id", "left_anti"), EchoBackend, "plan").filter(F.col("success"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("LeftAnti")


def test_a_validator_asks_again(spark):
    from captionloom.functions import validating

    df = spark.createDataFrame([(1, "short"), (2, "a longer prompt")], "image_id int, prompt string")
    out = caption(df, EchoBackend, "echo-valid", validator=validating.regex("1[0-9] characters", 0, "too short"), validation_retries=1, retry=Retry(attempts=0, sleep=quiet))
    got = {r.image_id: (r.success, r.error, r.passes) for r in out.collect()}
    assert got == {1: (False, "too short", 2), 2: (True, None, 1)}


def test_chat_requests_run_side_by_side_in_order(monkeypatch):
    monkeypatch.setattr(ChatBackend, "ask", lambda self, p, i: (time.sleep(0.2), p.upper())[1])
    began = time.monotonic()
    assert ChatBackend("openai", "m", key="k").generate(list("abcde"), [None] * 5) == list("ABCDE")
    assert time.monotonic() - began < 0.8


def test_rate_limits_pause_longer_each_time_and_not_alike():
    def pauses(place):
        made = []

        def limited():
            if len(made) < 4:
                raise RateLimited("slow")
            return ["ok"]

        assert Retry(sleep=made.append).call(limited, place) == (["ok"], None, 4)
        return made

    a, b = pauses("0 1"), pauses("1 1")
    assert a != b and all(0.5 * 2**k <= x <= 1.5 * 2**k for k, x in enumerate(a))


def test_chat_body():
    schema = '{"type": "object"}'
    chat = ChatBackend("openrouter", "m", key="k", options=(("temperature", 0.2), ("provider", {"order": ["x"]})), system="be brief", schema=schema, site_url="http://s", site_name="n")
    body = chat.body("hello", "data:image/png;base64,AA==")
    assert [m["role"] for m in body["messages"]] == ["system", "user"] and body["temperature"] == 0.2 and body["provider"] == {"order": ["x"]}
    assert body["response_format"]["json_schema"] == {"name": "caption_response", "strict": True, "schema": {"type": "object"}}
    headers = chat.settings()["headers"]
    assert headers["HTTP-Referer"] == "http://s" and headers["X-Title"] == "n" and headers["Authorization"] == "Bearer k"
    plain = ChatBackend("openai", "m", key="k", site_url="http://s")
    assert "HTTP-Referer" not in plain.settings()["headers"] and "response_format" not in plain.body("a", None)
