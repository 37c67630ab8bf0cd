"""Host-side control: leases, budgets, pacing, deadlines, fair stages, cycles and the orchestrated run.

These run on the driver and hold a few rows of state; what they start are DataFrame jobs.
"""

from __future__ import annotations

import contextlib
import ipaddress
import os
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from weirlake.operators.sinks import atomic_json, load_json


@contextlib.contextmanager
def file_lock(path: str, timeout: float = 30.0, poll: float = 0.05, stale: float = 7200.0) -> Iterator[None]:
    """A lock between processes by exclusive creation; one left behind for ``stale`` seconds is taken over."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    until = time.monotonic() + timeout
    while True:
        try:
            os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            break
        except FileExistsError:
            with contextlib.suppress(FileNotFoundError):
                if time.time() - os.stat(path).st_mtime > stale:
                    os.unlink(path)
                    continue
            if time.monotonic() >= until:
                raise TimeoutError(path) from None
            time.sleep(poll)
    try:
        yield
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(path)


class Lease:
    """One runner at a time: taken atomically, kept alive by heartbeats, free again when it expires."""

    def __init__(self, path: str, seconds: float = 7200.0, clock: Callable[[], float] = time.time):
        self.path, self.seconds, self.clock = path, seconds, clock

    def acquire(self, run_id: str) -> bool:
        with file_lock(self.path + ".lock"):
            held = load_json(self.path, {}) or {}
            if held.get("run_id") not in (None, run_id) and held.get("expires", 0) > self.clock():
                return False
            atomic_json(self.path, {"run_id": run_id, "expires": self.clock() + self.seconds})
            return True

    def heartbeat(self, run_id: str) -> None:
        with file_lock(self.path + ".lock"):
            if (load_json(self.path, {}) or {}).get("run_id") != run_id:
                raise RuntimeError("the lease has gone to another run")
            atomic_json(self.path, {"run_id": run_id, "expires": self.clock() + self.seconds})

    def release(self, run_id: str) -> None:
        with file_lock(self.path + ".lock"):
            if (load_json(self.path, {}) or {}).get("run_id") == run_id:
                atomic_json(self.path, {})


@dataclass
class Budget:
    """Requests, bytes, seconds and failures that a run may use (defaults are fixed values)."""

    requests: int = 10_000
    bytes: int = 5_000_000_000
    seconds: float = 21_600.0
    failures: int = 50
    clock: Callable[[], float] = time.monotonic
    used: dict = field(default_factory=lambda: {"requests": 0, "bytes": 0, "failures": 0})

    def __post_init__(self) -> None:
        self.began = self.clock()

    def spend(self, requests: int = 0, size: int = 0, failures: int = 0) -> None:
        for k, v in (("requests", requests), ("bytes", size), ("failures", failures)):
            self.used[k] += v
            if self.used[k] > getattr(self, k):
                raise BudgetExceeded(k)
        if self.clock() - self.began > self.seconds:
            raise BudgetExceeded("seconds")


class BudgetExceeded(RuntimeError):
    """Names what ran out."""


class Cooldown:
    """A pause after a rate limit that all processes share."""

    def __init__(self, path: str, clock: Callable[[], float] = time.time):
        self.path, self.clock = path, clock

    def set(self, seconds: float) -> None:
        atomic_json(self.path, {"until": self.clock() + max(0.0, seconds)})

    def left(self) -> float:
        return max(0.0, (load_json(self.path, {}) or {}).get("until", 0.0) - self.clock())


def is_rate_limited(status: int, headers: dict[str, str]) -> bool:
    low = {k.lower(): v for k, v in headers.items()}
    return status == 429 or (status == 403 and (low.get("x-ratelimit-remaining") == "0" or "retry-after" in low))


def retry_after(headers: dict[str, str], now: float) -> float | None:
    """Seconds to wait, from a delay or a time of reset."""
    low = {k.lower(): v for k, v in headers.items()}
    if low.get("retry-after", "").strip().isdigit():
        return float(low["retry-after"])
    if low.get("x-ratelimit-reset", "").strip().isdigit():
        return max(0.0, float(low["x-ratelimit-reset"]) - now)
    return None


def is_public_address(value: str) -> bool:
    """Whether an IP address is reachable from anywhere and not private, local, multicast or reserved."""
    try:
        ip = ipaddress.ip_address(value)
    except ValueError:
        return False
    return not (ip.is_private or ip.is_loopback or ip.is_link_local or ip.is_multicast or ip.is_reserved or ip.is_unspecified)


def robots_denied(text: str, agent: str = "*") -> list[str]:
    """Path prefixes that a robots file denies to an agent; none if the file says nothing of it."""
    groups: dict[str, list[str]] = {}
    current: list[str] = []
    open_ = False
    for raw in (text or "").splitlines():
        name, _, value = raw.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "user-agent":
            current = current + [value.lower()] if open_ else [value.lower()]
            open_ = True
            for a in current:
                groups.setdefault(a, [])
        elif name == "disallow":
            open_ = False
            for a in current:
                groups[a] += [value] if value else []
        elif name:
            open_ = False
    own = next((k for k in groups if k != "*" and k in agent.lower()), "*")
    return groups.get(own, [])


class DeadlineExceeded(RuntimeError):
    pass


@contextlib.contextmanager
def hard_deadline(spark, seconds: float, label: str) -> Iterator[None]:
    """Cancel the jobs that the block started when it takes longer than ``seconds``."""
    sc = spark.sparkContext
    group, late = f"deadline-{label}-{time.monotonic_ns()}", threading.Event()
    sc.setJobGroup(group, label, interruptOnCancel=True)

    def cancel() -> None:
        late.set()
        sc.cancelJobGroup(group)

    timer = threading.Timer(seconds, cancel)
    timer.daemon = True
    timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise DeadlineExceeded(f"{label} took more than {seconds} s") from error
        raise
    finally:
        timer.cancel()
        sc.setLocalProperty("spark.jobGroup.id", None)
    if late.is_set():
        raise DeadlineExceeded(f"{label} took more than {seconds} s")


def run_fair_stage(order: list[str], budget: int, quantum: int, runner: Callable[[str, int], int], max_errors: int = 3) -> dict:
    """Give every registry in turn up to ``quantum`` items until the budget or the work is used up.

    ``runner(registry, limit)`` returns how many items it processed; fewer than asked for means that
    the registry has no more. A registry that fails is left for the next run; ``max_errors`` failures end the stage.
    """
    left, processed, calls, errors = max(0, budget), {}, 0, 0
    exhausted: set[str] = set()
    reason = "BUDGET_ZERO" if left == 0 else "NO_REGISTRIES" if not order else None
    while left > 0 and len(exhausted) < len(order) and errors < max_errors:
        for registry in order:
            if left <= 0 or errors >= max_errors:
                break
            if registry in exhausted:
                continue
            ask = min(quantum, left)
            calls += 1
            try:
                done = runner(registry, ask)
            except Exception:
                errors += 1
                exhausted.add(registry)
                continue
            processed[registry] = processed.get(registry, 0) + done
            left -= done
            if done < ask:
                exhausted.add(registry)
    reason = reason or ("TOO_MANY_ERRORS" if errors >= max_errors else "BUDGET_EXHAUSTED" if left <= 0 else "ALL_EXHAUSTED")
    return {"processed": sum(processed.values()), "by_registry": processed, "calls": calls, "errors": errors, "stopped_reason": reason}


def rotated(order: list[str], last: str | None) -> list[str]:
    """The order that begins after the registry served last."""
    at = (order.index(last) + 1) % len(order) if last in order else 0
    return order[at:] + order[:at]


#: Items of each stage in a cycle, and how many a registry gets at a time (fixed values).
STAGE_BUDGETS = {"qualify": 90, "authority": 36, "targets": 180, "discovery": 18, "fetch": 9}
STAGE_QUANTA = {"qualify": 10, "authority": 4, "targets": 20, "discovery": 2, "fetch": 1}


class Orchestrator:
    """Runs the stages in order under a lease and keeps a journal and each stage's rotation below ``path``."""

    def __init__(self, path: str, runners: dict[str, Callable[[str, int], int]], registries: list[str], cooldown: Cooldown | None = None):
        self.path, self.runners, self.registries = path, runners, registries
        self.lease, self.cooldown = Lease(os.path.join(path, "lease.json")), cooldown

    def run(self, run_id: str, budgets: dict[str, int] | None = None, quanta: dict[str, int] | None = None) -> dict:
        if not self.lease.acquire(run_id):
            return {"run_id": run_id, "status": "LEASE_HELD", "stages": {}}
        state_path = os.path.join(self.path, "rotation.json")
        state, stages = load_json(state_path, {}) or {}, {}
        try:
            for stage, runner in self.runners.items():
                if self.cooldown and self.cooldown.left() > 0 and stage in ("authority", "discovery", "fetch"):
                    stages[stage] = {"processed": 0, "stopped_reason": "COOLDOWN"}
                    continue
                stages[stage] = run_fair_stage(rotated(self.registries, state.get(stage)), (budgets or STAGE_BUDGETS).get(stage, 0), (quanta or STAGE_QUANTA).get(stage, 1), runner)
                if stages[stage].get("by_registry"):
                    state[stage] = list(stages[stage]["by_registry"])[-1]
                    atomic_json(state_path, state)
                self.lease.heartbeat(run_id)
        finally:
            self.lease.release(run_id)
        result = {"run_id": run_id, "status": "DONE", "stages": stages}
        atomic_json(os.path.join(self.path, "journal", f"{run_id}.json"), result)
        return result


class Controls:
    """Update settings: defaults, and overrides of the whole or of one source, kept in one file."""

    DEFAULTS = {"automatic_enabled": True, "interval_seconds": 3600}

    def __init__(self, path: str):
        self.path = path

    def settings(self, source_id: str | None = None) -> dict:
        saved = load_json(self.path, {}) or {}
        out = self.DEFAULTS | saved.get("all", {}) | (saved.get("sources", {}).get(source_id, {}) if source_id else {})
        out["interval_seconds"] = max(300, int(out["interval_seconds"]))
        return out

    def update(self, values: dict, source_id: str | None = None) -> dict:
        with file_lock(self.path + ".lock"):
            saved = load_json(self.path, {}) or {}
            if source_id is None:
                saved["all"] = saved.get("all", {}) | values
            else:
                saved.setdefault("sources", {})[source_id] = saved.get("sources", {}).get(source_id, {}) | values
            atomic_json(self.path, saved)
        return self.settings(source_id)


def run_cycle(due: list[str], sync: Callable[[str], str], retries: Callable[[set[str]], list[str]]) -> list[tuple[str, str]]:
    """(source_id, status) of one automatic cycle: what is due, then partial sources that may retry, each once."""
    out = []
    for batch in (lambda: due, lambda: retries({s for s, _ in out})):
        for source in batch():
            try:
                out.append((source, sync(source)))
            except Exception as error:
                out.append((source, f"error: {error}"))
    return out


def run_forever(cycle: Callable[[], None], controls: Controls, stop: threading.Event) -> None:
    """Cycles at the configured interval until ``stop`` is set; a cycle that is switched off is left out."""
    while not stop.is_set():
        s = controls.settings()
        if s["automatic_enabled"]:
            cycle()
        stop.wait(s["interval_seconds"])
