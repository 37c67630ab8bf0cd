"""Retries, pacing, bounds and checkpoints on a clock of their own."""

import pytest

from weirlake.plans.control import Budget, BudgetExceeded, Cooldown
from weirlake.plans.transport import Answer, Transport, TransportError, resumable


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(round(seconds, 3))
        self.now += seconds


def made(answers, clock, budget=None, **more):
    asked = []

    def fetch(url, headers, timeout):
        asked.append((url, timeout))
        got = answers[min(len(asked) - 1, len(answers) - 1)] if isinstance(answers, list) else answers[url]
        if isinstance(got, Exception):
            raise got
        return got

    return Transport(fetch, budget or Budget(clock=clock), clock=clock, sleep=clock.sleep, **more), asked


def test_pauses_double_and_follow_the_answer():
    clock = Clock()
    t, asked = made([Answer(503), TimeoutError("slow"), Answer(429, {"Retry-After": "7"}), Answer(500), Answer(200)], clock)
    assert t.get("https://x/a")[1].status == 200 and clock.slept == [0.5, 1.0, 7.0, 4.0] and t.budget.used["failures"] == 4
    clock = Clock()
    t, asked = made([Answer(502)], clock, backoff=20.0)
    with pytest.raises(TransportError) as e:
        t.get("https://x/a")
    assert e.value.status == 502 and clock.slept == [20.0, 30.0, 30.0, 30.0] and len(asked) == 5
    t, asked = made([Answer(403)], Clock())
    with pytest.raises(TransportError):
        t.get("https://x/a")
    assert len(asked) == 1
    assert made([Answer(429, {"retry-after": "9000"})], Clock())[0].pause(0, Answer(429, {"retry-after": "9000"}), 0) == 300.0


def test_pace_by_host_redirects_and_guard():
    clock = Clock()
    t, asked = made({"https://x/a": Answer(302, {"Location": "/b"}), "https://x/b": Answer(200), "https://y/c": Answer(200)}, clock, pace=2.0)
    assert t.get("https://x/a")[0] == "https://x/b" and clock.slept == [2.0]
    t.get("https://y/c")
    assert clock.slept == [2.0]
    t, _ = made({"https://x/a": Answer(301, {"location": "https://x/a"})}, Clock())
    with pytest.raises(TransportError, match="redirects"):
        t.get("https://x/a")
    t, asked = made({"https://x/a": Answer(301, {"location": "http://10.0.0.1/"})}, Clock(), allowed=lambda u: "10." not in u)
    with pytest.raises(TransportError, match="public"):
        t.get("https://x/a")
    assert len(asked) == 1


def test_bounds_of_size_and_time():
    clock = Clock()
    t, asked = made([Answer(200, {}, [b"x" * 10] * 10)], clock, Budget(seconds=60, clock=clock))
    assert len(b"".join(t.read(t.get("https://x/a")[1], 100))) == 100
    with pytest.raises(TransportError, match="bytes"):
        list(t.read(t.get("https://x/a")[1], 99))
    with pytest.raises(TransportError, match="bytes"):
        list(t.read(Answer(200, {"Content-Length": "101"}), 100))
    clock.now = 30.0
    t.get("https://x/a")
    assert asked[-1][1] == 20.0
    t, _ = made([Answer(503, {"Retry-After": "55"})], Clock(), Budget(seconds=60, clock=Clock()))
    with pytest.raises(BudgetExceeded):
        t.get("https://x/a")


def test_rate_limits_are_shared(tmp_path):
    clock = Clock()
    cool = Cooldown(str(tmp_path / "c.json"), clock)
    t, _ = made([Answer(403, {"x-ratelimit-remaining": "0", "x-ratelimit-reset": "12"}), Answer(200)], clock, cooldown=cool)
    assert t.get("https://x/a", now=2.0)[1].status == 200 and clock.slept == [10.0]


def test_runs_go_on_where_they_ended(tmp_path):
    stored, clock = {}, Clock()
    answers = {f"https://x/{i}": Answer(200, {}, [b"x"]) for i in range(5)} | {"https://x/1": Answer(404), "https://x/2": Answer(400)}
    for most in (2, 10):
        t, asked = made(answers, clock, Budget(requests=most, clock=clock))
        state = resumable(t, sorted(answers), str(tmp_path / "p.json"), stored.__setitem__, 10)
    assert state == {"https://x/0": "done", "https://x/1": "missing", "https://x/2": "error: status 400", "https://x/3": "done", "https://x/4": "done"}
    assert sorted(stored) == ["https://x/0", "https://x/3", "https://x/4"] and [u for u, _ in asked] == ["https://x/2", "https://x/3", "https://x/4"]
