"""Remote recognition as a schedule of states.

Where a request stands is data: a `Call` says which step is next, from when on,
and what has come of it. `react` is the only place that knows what a reply
means; it turns one state into the next and waits for nothing. `converse` works
through the calls of a task by due time, so one that is waiting, for an operation to finish or
for a Retry-After to pass, holds up no other.

Rates are kept by reservation: a `Pace` hands out points in time, spaced by
the rate, of which `burst` may lie in the present.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from email.utils import mktime_tz, parsedate_tz
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.shipping import ship

# HTTP classes of the remote service. Fixed values.
FATAL = (401, 403)
RETRY = (429, 500, 502, 503, 504)
PENDING = 404


def response_class(code: Column, polling: bool = False) -> Column:
    """ok, fatal, retry, pending (while polling) or permanent."""
    out = F.when(code == 200, "ok").when(code.isin(*FATAL) & F.lit(not polling), "fatal").when(code.isin(*RETRY), "retry")
    return (out.when(code == PENDING, "pending") if polling else out).otherwise("permanent")


class Reply(NamedTuple):
    """What a transport returns: HTTP status (0 if there was no answer at all), body, and the Retry-After header."""

    status: int
    body: str = ""
    retry_after: str | None = None


@dataclass(frozen=True)
class CallPolicy:
    """Limits of a job. in_flight: calls that one task has open at a time."""

    max_retries: int = 12
    base_delay: float = 1.0
    delay_cap: float = 60.0
    poll_interval: float = 3.0
    poll_cap: float = 30.0
    max_wait: float = 600.0
    submit_rate: float = 8.0
    poll_rate: float = 40.0
    in_flight: int = 1


class Call(NamedTuple):
    """State of a request. setbacks: failures of this step in a row, pending answers aside."""

    step: str = "submit"
    due: float = 0.0
    setbacks: int = 0
    operation: str = ""
    expires: float = math.inf
    submits: int = 0
    polls: int = 0
    body: str | None = None
    error_kind: str | None = None
    error: str | None = None

    def lost(self) -> Call:
        return self._replace(step="done", error_kind="lost")


_SECONDS = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)")


def requested_wait(header: str | None, wall: float) -> float | None:
    """Seconds that a Retry-After header asks for, as a number or as a date; at least 0, None for anything else."""
    value = (header or "").strip()
    if _SECONDS.fullmatch(value):
        return max(0.0, float(value))
    date = parsedate_tz(value) if value else None
    return None if date is None else max(0.0, mktime_tz(date) - wall)


def growing_wait(setbacks: int, base: float, cap: float, jitter: Callable[[], float]) -> float:
    """Doubles with every setback up to the cap; jitter comes on top."""
    return min(cap, math.ldexp(base, min(setbacks, 64) - 1)) + jitter()


def react(call: Call, reply: Reply, now: float, policy: CallPolicy, wall: float = 0.0, jitter: Callable[[], float] = random.random) -> Call:
    """The state after a reply to the step that was due."""
    asked = requested_wait(reply.retry_after, wall)
    worse = call.setbacks + 1
    if call.step == "submit":
        call = call._replace(submits=call.submits + 1)
        if reply.status == 200 and reply.body:
            return call._replace(step="poll", due=now, setbacks=0, operation=reply.body, expires=now + policy.max_wait)
        if reply.status in FATAL:
            return call._replace(step="done", error_kind="auth", error=f"{reply.status}: {reply.body[:200]}")
        if reply.status not in (0, *RETRY) or worse >= policy.max_retries:
            return call.lost()
        wait = growing_wait(worse, policy.base_delay, policy.delay_cap, jitter) if asked is None else asked
        return call._replace(due=now + wait, setbacks=worse)
    call = call._replace(polls=call.polls + 1)
    if reply.status == 200 and reply.body.strip():
        return call._replace(step="done", body=reply.body)
    if reply.status in RETRY:
        wait = growing_wait(worse, policy.poll_interval, policy.poll_cap, jitter) if asked is None else asked
        return call._replace(due=now + wait, setbacks=worse)
    # Not ready yet, or an answer that says nothing: only a clear "not ready" forgets earlier pressure.
    return call._replace(due=now + policy.poll_interval, setbacks=0 if reply.status == PENDING else call.setbacks)


class Pace:
    """Reserves points in time, 1 / rate apart; up to `burst` of them may be due at once after a pause."""

    def __init__(self, rate: float, burst: float | None = None) -> None:
        rate = max(0.1, rate)
        self.gap = 1 / rate
        self.slack = (max(1.0, rate if burst is None else burst) - 1) * self.gap
        self.next = -math.inf

    def reserve(self, now: float) -> float:
        self.next = max(self.next, now)
        at = max(now, self.next - self.slack)
        self.next += self.gap
        return at


def _ask(transport, call: Call, key: str, payload: bytes) -> Reply:
    """A step carried out. No connection is an answer of its own; any other exception is the caller's."""
    try:
        return transport.submit(key, payload) if call.step == "submit" else transport.poll(call.operation)
    except OSError as e:  # time-outs included
        return Reply(0, str(e))


def converse(
    transport,
    requests: list[tuple[str, bytes]],
    policy: CallPolicy,
    paces: dict[str, Pace],
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
    jitter: Callable[[], float] = random.random,
) -> list[Call]:
    """The final states of requests (key, payload), at most policy.in_flight of them open at a time."""
    calls = [Call() for _ in requests]
    waiting = iter(range(len(requests)))
    agenda: list[tuple[float, bool, int]] = []  # due, whether a point in time is reserved, which call

    def open_next() -> None:
        if (i := next(waiting, None)) is not None:
            heapq.heappush(agenda, (clock(), False, i))

    for _ in range(max(1, policy.in_flight)):
        open_next()
    while agenda:
        due, reserved, i = heapq.heappop(agenda)
        call = calls[i]
        if due > clock():
            sleep(due - clock())
        if call.step == "poll" and clock() >= call.expires:
            calls[i] = call.lost()
        elif not reserved and (at := paces[call.step].reserve(clock())) > clock():
            heapq.heappush(agenda, (at, True, i))
            continue
        else:
            try:
                calls[i] = react(call, _ask(transport, call, *requests[i]), clock(), policy, time.time(), jitter)
            except Exception as e:  # noqa: BLE001  one request's failure is a row, not the job's end
                calls[i] = call._replace(step="done", error_kind="other", error=f"{type(e).__name__}: {e}")
        if calls[i].step == "done":
            open_next()
        else:
            heapq.heappush(agenda, (calls[i].due, False, i))
    return calls


#: Makes a transport on the executor: an object with submit(key, payload) and poll(operation), both returning a Reply.
Transport = Callable[[], object]
CALL_SCHEMA = "ok boolean, error_kind string, error string, body string, submits int, polls int"


def recognise(batches: DataFrame, make_transport: Transport, keys: list[str], policy: CallPolicy | None = None, tasks: int = 5) -> DataFrame:
    """(keys, ok, error_kind, error, body, submits, polls) of batches(keys, request, payload).

    One transport and two paces per task, at the job's rates divided by the
    number of tasks. `request` is an idempotency key made from the content, as a task that is
    run again submits again. error_kind: auth (the service refused the key), lost
    (refused for good, retries used up, or not ready in time) or other (an exception of the
    transport). The result should be written before it is used twice: a call must not be repeated by a
    re-evaluated plan.
    """
    ship()
    policy = policy or CallPolicy()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transport = make_transport()
        clock, sleep = getattr(transport, "clock", time.monotonic), getattr(transport, "sleep", time.sleep)
        paces = {"submit": Pace(policy.submit_rate / tasks), "poll": Pace(policy.poll_rate / tasks)}
        for part in parts:
            requests = [(k, bytes(p)) for k, p in zip(part["request"], part["payload"], strict=True)]
            out = [(c.body is not None, c.error_kind, c.error, c.body, c.submits, c.polls) for c in converse(transport, requests, policy, paces, clock, sleep)]
            names = [f.split()[0] for f in CALL_SCHEMA.split(", ")]
            yield pd.concat([part[keys].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    fields = ", ".join(f"{k} {dict(batches.dtypes)[k]}" for k in keys)
    return batches.select(*keys, "request", "payload").repartition(tasks).mapInPandas(run, f"{fields}, {CALL_SCHEMA}")


# Transports ---------------------------------------------------------------------

#: Body of a submission beside its content. Fixed values.
REQUEST = {"mimeType": "application/pdf", "languageCodes": ["*"], "model": "page"}


class HttpTransport:
    """The service over HTTP. poll_url holds {operation_id}; headers carry the key."""

    def __init__(self, submit_url: str, poll_url: str, headers: dict[str, str] | None = None, timeout: float = 60.0) -> None:
        self.submit_url, self.poll_url, self.headers, self.timeout = submit_url, poll_url, headers or {}, timeout

    def _send(self, request: urllib.request.Request) -> Reply:
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return Reply(answer.status, answer.read().decode("utf-8", "replace"), answer.headers.get("Retry-After"))
        except urllib.error.HTTPError as e:
            with e:
                return Reply(e.code, e.read().decode("utf-8", "replace"), e.headers.get("Retry-After"))

    def submit(self, key: str, payload: bytes) -> Reply:
        body = json.dumps(REQUEST | {"content": base64.b64encode(payload).decode()}).encode()
        reply = self._send(urllib.request.Request(self.submit_url, body, {**self.headers, "Content-Type": "application/json", "Idempotency-Key": key}))
        if reply.status != 200:
            return reply
        return reply._replace(body=str(json.loads(reply.body).get("id") or ""))

    def poll(self, operation: str) -> Reply:
        return self._send(urllib.request.Request(self.poll_url.format(operation_id=operation), headers=self.headers))


class EchoTransport:
    """A deterministic stand-in with a clock of its own: answers texts, separated by form feeds, with one page each."""

    def __init__(self) -> None:
        self.now = 0.0
        self.held: dict[str, bytes] = {}

    def clock(self) -> float:
        return self.now

    def sleep(self, seconds: float) -> None:
        self.now += seconds

    def submit(self, key: str, payload: bytes) -> Reply:
        self.held[f"op-{key}"] = payload
        return Reply(200, f"op-{key}")

    def poll(self, operation: str) -> Reply:
        def page(text: str) -> dict:
            lines = [{"text": x, "boundingBox": {"vertices": [{"x": 0, "y": 10 * i}, {"x": len(x), "y": 10 * i + 9}]}} for i, x in enumerate(text.split("\n"))]
            return {"textAnnotation": {"width": 100, "height": 200, "blocks": [{"lines": lines}]}}

        return Reply(200, "\n".join(json.dumps({"result": page(t)}) for t in self.held.pop(operation).decode().split("\f")))


class FaultyTransport(EchoTransport):
    """The stand-in with faults. What befalls a request hangs on the sum of the numbers in its key, modulo 10:

    0 refused key, 1 bad request, 2 three answers 503, then well, 3 busy for ever, 4 two polls too early and an empty
    one, 5 never ready, 6 one broken connection, 7 two polls told to wait; else nothing.
    """

    def __init__(self) -> None:
        super().__init__()
        self.seen: dict[str, int] = {}

    def _fate(self, key: str) -> tuple[int, int]:
        self.seen[key] = self.seen.get(key, 0) + 1
        return sum(map(int, re.findall(r"\d+", key))) % 10, self.seen[key]

    def submit(self, key: str, payload: bytes) -> Reply:
        fate, nth = self._fate(key)
        if fate == 6 and nth == 1:
            raise ConnectionResetError("broken")
        refused = {0: Reply(403, "no such key"), 1: Reply(400), 3: Reply(429, retry_after="2")}.get(fate)
        if fate == 2 and nth <= 3:
            refused = Reply(503)
        return refused or super().submit(key, payload)

    def poll(self, operation: str) -> Reply:
        fate, nth = self._fate(operation)
        if fate == 5 or fate == 4 and nth <= 2:
            return Reply(PENDING)
        if fate == 4 and nth == 3:
            return Reply(200, " \n")
        if fate == 7 and nth <= 2:
            return Reply(429, retry_after="1")
        return super().poll(operation)
