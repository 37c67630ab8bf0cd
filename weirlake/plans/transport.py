"""What may be asked of the network, when, and how often: retries, pacing, bounds and checkpoints around any way to fetch.

``fetch`` does one request and returns an ``Answer``; nothing here opens a connection, so all of it can be tested.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit

from weirlake.operators.sinks import atomic_json, load_json
from weirlake.plans.control import Budget, BudgetExceeded, Cooldown, is_rate_limited, retry_after

#: Status codes worth another try (fixed values).
RETRIED = frozenset({408, 425, 429, 500, 502, 503, 504})


@dataclass
class Answer:
    status: int
    headers: dict[str, str] = field(default_factory=dict)
    body: Iterable[bytes] = ()


class TransportError(RuntimeError):
    """A request that failed for good; ``status`` is the last answer's, 0 if there was none."""

    def __init__(self, message: str, status: int = 0):
        super().__init__(message)
        self.status = status


class Transport:
    """Requests under a run's budget: paced by host, retried with doubling pauses, bounded in size, time and redirects."""

    def __init__(
        self, fetch: Callable[[str, dict[str, str], float], Answer], budget: Budget | None = None, cooldown: Cooldown | None = None, *, retries: int = 4, backoff: float = 0.5,
        longest_backoff: float = 30.0, longest_retry_after: float = 300.0, pace: float = 0.0, read_timeout: float = 30.0, reserve: float = 10.0, most_redirects: int = 5,
        allowed: Callable[[str], bool] = lambda url: True, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
    ):
        self.fetch, self.budget, self.cooldown = fetch, budget or Budget(clock=clock), cooldown
        self.retries, self.backoff, self.longest_backoff, self.longest_retry_after = retries, backoff, longest_backoff, longest_retry_after
        self.pace, self.read_timeout, self.reserve, self.most_redirects = pace, read_timeout, reserve, most_redirects
        self.allowed, self.clock, self.sleep = allowed, clock, sleep
        self.last: dict[str, float] = {}

    def _left(self) -> float:
        """Seconds of the run, less those kept to end it in order."""
        return self.budget.seconds - (self.clock() - self.budget.began) - self.reserve

    def _wait(self, seconds: float) -> None:
        if seconds > max(0.0, self._left()):
            raise BudgetExceeded("seconds")
        if seconds > 0:
            self.sleep(seconds)

    def _turn(self, url: str) -> None:
        """Wait for the shared cool-down and for the host's turn."""
        if self.cooldown is not None:
            self._wait(self.cooldown.left())
        host = urlsplit(url).netloc.lower()
        if self.pace and host in self.last:
            self._wait(self.last[host] + self.pace - self.clock())
        self.last[host] = self.clock()

    def pause(self, attempt: int, answer: Answer | None, now: float) -> float:
        """Seconds before try ``attempt`` + 1: what the answer asks for, else twice as long each time; both bounded."""
        asked = retry_after(answer.headers, now) if answer is not None else None
        return min(asked, self.longest_retry_after) if asked is not None else min(self.backoff * 2**attempt, self.longest_backoff)

    def get(self, url: str, headers: dict[str, str] | None = None, now: float | None = None) -> tuple[str, Answer]:
        """(final url, answer) of a request that was answered; answers from 400 on, but for 404 and 410, are errors."""
        redirects = attempt = 0
        while True:
            if not self.allowed(url):
                raise TransportError(f"not a public address: {url}")
            self._turn(url)
            self.budget.spend(requests=1)
            answer, failure = None, None
            try:
                answer = self.fetch(url, headers or {}, max(0.1, min(self.read_timeout, self._left())))
            except (OSError, TimeoutError) as error:
                failure = error
            if answer is not None and answer.status in (301, 302, 303, 307, 308) and "location" in {k.lower() for k in answer.headers}:
                redirects += 1
                if redirects > self.most_redirects:
                    raise TransportError("too many redirects", answer.status)
                url = urljoin(url, next(v for k, v in answer.headers.items() if k.lower() == "location"))
                continue
            if answer is not None and (answer.status < 400 or answer.status in (404, 410)):
                return url, answer
            self.budget.spend(failures=1)
            limited = answer is not None and is_rate_limited(answer.status, answer.headers)
            if not (failure or limited or answer.status in RETRIED) or attempt >= self.retries:
                raise TransportError(str(failure) if failure else f"status {answer.status}", answer.status if answer else 0) from failure
            wait = self.pause(attempt, answer, time.time() if now is None else now)
            if limited and self.cooldown is not None:
                self.cooldown.set(wait)
            else:
                self._wait(wait)
            attempt += 1

    def read(self, answer: Answer, most: int) -> Iterator[bytes]:
        """The body in pieces; too many bytes, by the header or by count, are an error before they are handed on."""
        told = {k.lower(): v for k, v in answer.headers.items()}.get("content-length", "")
        if told.isdigit() and int(told) > most:
            raise TransportError(f"more than {most} bytes", answer.status)
        size = 0
        for piece in answer.body:
            size += len(piece)
            if size > most:
                raise TransportError(f"more than {most} bytes", answer.status)
            self.budget.spend(size=len(piece))
            yield piece


def resumable(transport: Transport, urls: Iterable[str], checkpoint: str, store: Callable[[str, bytes], None], most: int) -> dict[str, str]:
    """{url: done, missing or error} of a list of documents; ``checkpoint`` remembers what was stored, so a run that ends early goes on there.

    A budget that runs out ends the run in order: what is left has no entry.
    """
    state: dict[str, str] = load_json(checkpoint, {}) or {}
    for url in urls:
        if state.get(url) in ("done", "missing"):
            continue
        try:
            _, answer = transport.get(url)
            if answer.status in (404, 410):
                state[url] = "missing"
            else:
                store(url, b"".join(transport.read(answer, most)))
                state[url] = "done"
        except BudgetExceeded:
            break
        except TransportError as error:
            state[url] = f"error: {error}"
        atomic_json(checkpoint, state)
    return state
