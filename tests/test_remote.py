import http.server
import json
import threading

import pytest

from folioscope.operators import remote as rm
from folioscope.operators.remote import Call, Pace, Reply


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def test_paces_are_spaced_by_their_rate():
    pace = Pace(2.0)
    assert [pace.reserve(0.0) for _ in range(6)] == [0.0, 0.0, 0.5, 1.0, 1.5, 2.0]
    assert [pace.reserve(10.0) for _ in range(3)] == [10.0, 10.0, 10.5]  # a pause saves up no more than the burst
    assert Pace(0.0).gap == 10.0


@pytest.mark.parametrize(
    ("header", "seconds"),
    [("7", 7.0), (" 2.5 ", 2.5), ("-3", 0.0), ("Thu, 01 Jan 1970 00:01:00 GMT", 60.0), ("Thu, 01 Jan 1970 00:00:00 GMT", 0.0), ("soon", None), ("", None), (None, None)],
)
def test_requested_wait(header, seconds):
    assert rm.requested_wait(header, 0.0) == seconds


def test_waits_double_up_to_the_cap():
    assert [rm.growing_wait(n, 1.0, 60.0, lambda: 0.0) for n in (1, 2, 3, 7, 1000)] == [1.0, 2.0, 4.0, 60.0, 60.0]


def after(call, status, body="", retry_after=None, **policy):
    return rm.react(call, Reply(status, body, retry_after), 100.0, rm.CallPolicy(**policy), jitter=lambda: 0.0)


@pytest.mark.parametrize("status", [0, *rm.RETRY])
def test_a_submission_is_repeated(status):
    one = after(Call(), status)
    assert (one.step, one.due, one.setbacks, one.submits) == ("submit", 101.0, 1, 1)
    assert after(one, status).due == 102.0
    assert after(one, status, retry_after="30").due == 130.0
    last = after(one, status, max_retries=2)
    assert (last.step, last.error_kind) == ("done", "lost")


@pytest.mark.parametrize(("status", "kind"), [(401, "auth"), (403, "auth"), (400, "lost"), (404, "lost"), (418, "lost")])
def test_a_submission_is_refused(status, kind):
    got = after(Call(), status, "why")
    assert (got.step, got.error_kind, got.error) == ("done", kind, f"{status}: why" if kind == "auth" else None)


def test_a_submission_is_taken():
    got = after(Call(setbacks=3), 200, "op")
    assert (got.step, got.operation, got.due, got.expires, got.setbacks) == ("poll", "op", 100.0, 700.0, 0)
    assert after(Call(), 200, "").error_kind == "lost"


def test_polls():
    waiting = Call("poll", operation="op", setbacks=2, expires=700.0)
    assert after(waiting, 404)[:3] == ("poll", 103.0, 0)
    assert after(waiting, 200, " \n")[:3] == ("poll", 103.0, 2)
    assert after(waiting, 401)[:3] == ("poll", 103.0, 2)
    assert after(waiting, 0)[:3] == ("poll", 103.0, 2)
    assert after(waiting, 429)[:3] == ("poll", 112.0, 3)
    assert after(waiting, 503, retry_after="1")[:3] == ("poll", 101.0, 3)
    assert after(waiting._replace(setbacks=30), 500).due == 130.0
    done = after(waiting, 200, "body")
    assert (done.step, done.body) == ("done", "body")


class Scripted:
    """Replies by key, in order; the last one stays."""

    def __init__(self, submits, polls):
        self.submits, self.polls, self.said = submits, polls, []

    def _next(self, table, key):
        self.said.append(key)
        left = table[key]
        reply = left.pop(0) if len(left) > 1 else left[0]
        if isinstance(reply, Exception):
            raise reply
        return reply

    def submit(self, key, payload):
        return self._next(self.submits, key)

    def poll(self, operation):
        return self._next(self.polls, operation)


def run(transport, keys, **policy):
    clock = Clock()
    paces = {"submit": Pace(100), "poll": Pace(100)}
    return rm.converse(transport, [(k, b"") for k in keys], rm.CallPolicy(**policy), paces, clock, clock.sleep, lambda: 0.0), clock


def test_calls_in_turn_and_at_once():
    def script():
        submits = {"a": [Reply(200, "A")], "b": [Reply(200, "B")], "c": [TimeoutError("late"), Reply(403, "no")], "d": [ValueError("odd")]}
        return Scripted(submits, {"A": [Reply(404), Reply(200, "a!")], "B": [ConnectionError(), Reply(200, "b!")]})

    want = [("a!", None), ("b!", None), (None, "auth"), (None, "other")]
    one, clock = run(script(), "abcd")
    assert [(c.body, c.error_kind) for c in one] == want and clock.now == pytest.approx(7.0)
    four, clock = run(script(), "abcd", in_flight=4)
    assert [(c.body, c.error_kind) for c in four] == want and clock.now == pytest.approx(3.0)
    assert run(script(), "")[0] == []


def test_polling_ends_at_its_deadline():
    calls, clock = run(Scripted({"a": [Reply(200, "A")]}, {"A": [Reply(404)]}), "a", max_wait=10)
    assert calls[0].error_kind == "lost" and calls[0].polls == 4 and clock.now == 12.0


def test_rates_hold_over_many_calls():
    n = 50
    transport = Scripted({str(i): [Reply(200, "o")] for i in range(n)}, {"o": [Reply(200, "x")]})
    clock = Clock()
    rm.converse(transport, [(str(i), b"") for i in range(n)], rm.CallPolicy(in_flight=9), {"submit": Pace(5), "poll": Pace(100)}, clock, clock.sleep)
    assert clock.now == pytest.approx((n - 5) / 5)


def test_failures_stay_in_their_rows(spark):
    class Picky(rm.EchoTransport):
        def submit(self, key, payload):
            if key == "auth":
                return Reply(403, "no")
            if key == "bad":
                return Reply(400)
            if key == "odd":
                raise KeyError("odd")
            return super().submit(key, payload)

    df = spark.createDataFrame([(1, "auth", b"x"), (2, "bad", b"x"), (3, "fine", b"a\fb"), (4, "odd", b"x")], "id int, request string, payload binary")
    got = {r.id: (r.ok, r.error_kind) for r in rm.recognise(df, Picky, ["id"], tasks=2).collect()}
    assert got == {1: (False, "auth"), 2: (False, "lost"), 3: (True, None), 4: (False, "other")}


@pytest.fixture
def service():
    """A service on this machine: busy at first, then an operation that is ready at the second poll."""
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self, status, body, **headers):
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k.replace("_", "-"), v)
            self.end_headers()
            self.wfile.write(body.encode())

        def do_POST(self):  # noqa: N802
            seen.append((self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            self.answer(429, "busy", Retry_After="0") if len(seen) == 1 else self.answer(200, '{"id": "op1"}')

        def do_GET(self):  # noqa: N802
            seen.append(self.path)
            self.answer(404, "wait") if seen.count(self.path) == 1 else self.answer(200, '{"result": {}}')

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen
    server.shutdown()


def test_http(service):
    url, seen = service
    transport = rm.HttpTransport(f"{url}/submit", f"{url}/ops/{{operation_id}}", {"Authorization": "key"})
    paces = {"submit": Pace(100), "poll": Pace(100)}
    (call,) = rm.converse(transport, [("k", b"pdf")], rm.CallPolicy(poll_interval=0.01), paces)
    assert call.body == '{"result": {}}' and (call.submits, call.polls) == (2, 2)
    assert seen[0] == ("key", {"mimeType": "application/pdf", "languageCodes": ["*"], "model": "page", "content": "cGRm"})
    assert seen[2:] == ["/ops/op1", "/ops/op1"]
