"""Remote model backend for ``infer`` (M0): an HTTP chat-completions client.

One client per task (created lazily inside the Python worker), one request per
prompt, bounded retries with backoff; any failure becomes ``status='error'``
for that row instead of failing the task. The wire format is the widely used
chat-completions JSON shape; ``transport`` can be swapped (tests use a fake
one, so nothing here opens a connection during the test suite).
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable

import pandas as pd

from qbank.operators.infer import Backend

Transport = Callable[[str, dict, bytes, float], tuple[int, str]]


def urllib_transport(url: str, headers: dict, body: bytes, timeout: float) -> tuple[int, str]:
    req = urllib.request.Request(url, data=body, headers=headers, method="POST")
    try:
        with urllib.request.urlopen(req, timeout=timeout) as resp:  # noqa: S310
            return resp.status, resp.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def chat_payload(row: dict) -> dict:
    """Request body for one request-table row."""
    messages = []
    if row.get("system"):
        messages.append({"role": "system", "content": row["system"]})
    messages.append({"role": "user", "content": row["prompt"]})
    body = {"model": row["model"], "messages": messages,
            "temperature": float(row.get("temperature") or 0.0)}
    if row.get("json_mode"):
        body["response_format"] = {"type": "json_object"}
    if row.get("max_tokens") is not None and not pd.isna(row.get("max_tokens")):
        body["max_tokens"] = int(row["max_tokens"])
    return body


def reply_text(payload: str) -> str:
    """The first choice's message content of a chat-completions reply."""
    return json.loads(payload)["choices"][0]["message"]["content"]


class ChatHttpBackend(Backend):
    """``base_url`` like ``https://host/v1``; the key is passed directly or
    read from the environment variable named by ``api_key_env`` on the worker."""

    def __init__(self, base_url: str, api_key: str | None = None,
                 api_key_env: str | None = None, timeout: float = 120.0, retries: int = 3,
                 backoff: float = 2.0, transport: Transport | None = None,
                 concurrency: int = 1):
        self.url = base_url.rstrip("/") + "/chat/completions"
        self.concurrency = max(1, int(concurrency))
        self.api_key, self.api_key_env = api_key, api_key_env
        self.timeout, self.retries, self.backoff = timeout, retries, backoff
        self.transport = transport

    def _headers(self) -> dict:
        key = self.api_key or (os.environ.get(self.api_key_env) if self.api_key_env else None)
        h = {"Content-Type": "application/json"}
        if key:
            h["Authorization"] = f"Bearer {key}"
        return h

    def _one(self, row: dict, headers: dict, send: Transport):
        if row.get("prompt") is None:
            return (None, "error", "empty prompt")
        body = json.dumps(chat_payload(row)).encode("utf-8")
        err = None
        for attempt in range(self.retries + 1):
            try:
                code, text = send(self.url, headers, body, self.timeout)
                if code == 200:
                    return (reply_text(text), "ok", None)
                err = f"http {code}: {text[:200]}"
                if code not in (408, 409, 429) and code < 500:
                    break  # not retryable
            except Exception as e:  # network error, bad payload
                err = repr(e)[:300]
            if attempt < self.retries:
                time.sleep(self.backoff * (2 ** attempt))
        return (None, "error", err)

    def complete(self, batch: pd.DataFrame) -> pd.DataFrame:
        send = self.transport or urllib_transport
        headers = self._headers()
        rows = batch.to_dict("records")
        if self.concurrency > 1 and len(rows) > 1:
            # calls are I/O-bound: a small pool per task; total in-flight
            # requests = tasks x concurrency, set by the caller's partitioning
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=self.concurrency) as pool:
                out = list(pool.map(lambda r: self._one(r, headers, send), rows))
        else:
            out = [self._one(r, headers, send) for r in rows]
        return pd.DataFrame(out, columns=["response", "status", "error"])
