import json

import pandas as pd

from qbank.operators.backends import ChatHttpBackend, chat_payload


def test_chat_payload_and_reply_parsing():
    row = {"model": "m", "system": "sys", "prompt": "p", "temperature": 0.0, "json_mode": True,
           "max_tokens": 1000}
    body = chat_payload(row)
    assert body["messages"] == [{"role": "system", "content": "sys"}, {"role": "user", "content": "p"}]
    assert body["response_format"] == {"type": "json_object"} and body["max_tokens"] == 1000


def test_backend_retries_then_marks_errors():
    calls = []

    def fake(url, headers, body, timeout):
        req = json.loads(body)
        calls.append(req["messages"][-1]["content"])
        if req["messages"][-1]["content"] == "flaky" and calls.count("flaky") == 1:
            return 503, "busy"
        if req["messages"][-1]["content"] == "bad":
            return 400, "bad request"
        return 200, json.dumps({"choices": [{"message": {"content": "reply:" + req["model"]}}]})

    be = ChatHttpBackend("http://unused/v1", api_key="k", backoff=0.0, transport=fake)
    batch = pd.DataFrame({"task": ["t"] * 4, "model": ["m"] * 4, "system": [None] * 4,
                          "prompt": ["ok", "flaky", "bad", None], "temperature": [0.0] * 4,
                          "json_mode": [False] * 4, "max_tokens": [None] * 4})
    out = be.complete(batch)
    assert list(out["status"]) == ["ok", "ok", "error", "error"]
    assert out["response"][0] == "reply:m" and out["response"][1] == "reply:m"
    assert calls.count("bad") == 1  # a 4xx is not retried


def test_http_backend_runs_inside_infer(spark):
    from qbank.operators.infer import build_requests, infer

    def fake(url, headers, body, timeout):  # shipped to the workers by value
        req = json.loads(body)
        return 200, json.dumps({"choices": [{"message": {
            "content": req["messages"][-1]["content"].upper()}}]})

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], ["id", "p"])
    be = ChatHttpBackend("http://unused/v1", transport=fake, backoff=0.0, concurrency=4)
    out = {r.request_id: (r.response, r.status) for r in
           infer(build_requests(df, request_id="id", prompt="p", task="t", json_mode=False),
                 be).collect()}
    assert out == {"1": ("A", "ok"), "2": ("B", "ok"), "3": ("A", "ok")}
