"""Calls to a service, one for each row, with retries, re-prompts and failures as rows."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from quernstone.functions import text as T


class TransientError(Exception):
    """What a client raises where the same call may work later: a full queue, a lost connection, a server's fault.

    Any exception with a true `transient` counts: a worker may hold a class twice, so it isn't asked for by identity.
    """

    transient = True


@dataclass(frozen=True)
class Policy:
    """Calls are tried `tries` times, after a transient failure `wait_s` later, then twice that, and so on; an answer without JSON is asked for again `prompts` times in all."""

    tries: int = 5
    wait_s: float = 3.0
    prompts: int = 3
    again: str = "\n\nAnswer with one JSON object and nothing else."


def json_in(text: str) -> object | None:
    """The JSON of a text without a code fence around it, else its first object that is JSON."""
    bare = re.sub(r"```$", "", re.sub(r"^```(?:json)?", "", text.strip()).strip()).strip()
    for part in (bare, T.first_object(bare)):
        try:
            return json.loads(part) if part else None
        except ValueError:
            continue
    return None


def tried(call: Callable[[], dict], policy: Policy, sleep: Callable[[float], None] = time.sleep) -> tuple[dict, int]:
    """(answer, calls made); the last failure is raised."""
    for k in range(policy.tries):
        try:
            return call(), k + 1
        except Exception as e:
            e.calls = k + 1
            if k + 1 == policy.tries or not getattr(e, "transient", False):
                raise
            sleep(policy.wait_s * 2**k)
    raise ValueError("tries must be positive")


def asked(client: Callable[[str], dict], prompt: str, policy: Policy, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, int, str | None]:
    """(JSON of the answer, calls made, failure): an answer's content is read, and where that has no JSON its reasoning."""
    calls, failure = 0, None
    for k in range(policy.prompts):
        said = prompt if not k else prompt + policy.again
        try:
            answer, n = tried(lambda said=said: client(said), policy, sleep)
            calls += n
        except Exception as e:  # noqa: BLE001 - one row's failure is that row's result
            return None, calls + getattr(e, "calls", 1), f"{type(e).__name__}: {e}"
        for part in ("content", "reasoning"):
            found = json_in(str(answer.get(part) or ""))
            if found is not None:
                return json.dumps(found, ensure_ascii=False, sort_keys=True), calls, None
        failure = "no JSON in the answer"
    return None, calls, failure


def call(rows: DataFrame, key: str, prompt: str, client: Callable[[], Callable[[str], dict]], policy: Policy = Policy(), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(key, answer, calls, failure) of every row: one of answer and failure is null.

    client makes what answers a prompt; it is called once in each task, so a connection needn't travel. A null prompt is a
    failure without a call. Rows come out as their batches are done; how many tasks call at once is how rows is partitioned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = None
        for b in batches:
            ask = ask or client()
            out = [asked(ask, p, policy, sleep) if p is not None else (None, 0, "no prompt") for p in b.column(prompt).to_pylist()]
            answers, calls, failures = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(answers, pa.string()), pa.array(calls, pa.int32()), pa.array(failures, pa.string())], [key, "answer", "calls", "failure"])

    return rows.select(key, prompt).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, answer string, calls int, failure string")
