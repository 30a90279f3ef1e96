"""Rate limits of paged sources: token buckets per endpoint, back-off, and a sliding window."""

from __future__ import annotations

import functools
import random
import threading
import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

# Requests per window of 900 seconds by tier and endpoint.
TIERS = {
    "basic": {"search_recent": 180, "users_lookup": 900, "tweets_lookup": 900, "user_tweets": 900},
    "pro": {"search_recent": 450, "users_lookup": 900, "tweets_lookup": 900, "user_tweets": 900},
    "academic": {"search_recent": 450, "search_all": 300, "users_lookup": 900, "tweets_lookup": 900, "user_tweets": 900},
}
WINDOW = 900


class RateLimitExceeded(Exception):
    def __init__(self, endpoint: str, retry_after: float) -> None:
        super().__init__(f"{endpoint}: retry after {retry_after:.1f} s")
        self.endpoint, self.retry_after = endpoint, retry_after


class Refused(Exception):
    """A source refused a request (too many, or busy); ``retry_after`` seconds if it says how long."""

    def __init__(self, message: str = "refused", retry_after: float | None = None) -> None:
        super().__init__(message)
        self.retry_after = retry_after


@dataclass
class Bucket:
    """``capacity`` tokens, refilled steadily over ``window`` seconds."""

    capacity: float
    window: float
    clock: Callable[[], float] = time.monotonic
    tokens: float = field(init=False)
    at: float = field(init=False)

    def __post_init__(self) -> None:
        self.tokens, self.at = self.capacity, self.clock()

    @property
    def rate(self) -> float:
        return self.capacity / self.window

    def available(self) -> float:
        now = self.clock()
        self.tokens, self.at = min(self.capacity, self.tokens + (now - self.at) * self.rate), now
        return self.tokens

    def consume(self, n: float = 1) -> bool:
        if self.available() < n:
            return False
        self.tokens -= n
        return True

    def wait_time(self, n: float = 1) -> float:
        return max(0.0, n - self.available()) / self.rate


class RateLimiter:
    """Buckets by endpoint; unknown endpoints are not limited.

    A limit holds per process. A source that must keep a global limit runs in one partition, or
    divides the rate by its number of partitions (``share``).
    """

    def __init__(self, base_delay: float = 2.0, max_delay: float = 300.0, jitter: float = 0.1, share: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.base_delay, self.max_delay, self.jitter, self.share, self.clock, self.sleep = base_delay, max_delay, jitter, share, clock, sleep
        self.buckets: dict[str, Bucket] = {}
        self.failures: dict[str, int] = {}
        self.lock = threading.Lock()

    def register(self, endpoint: str, requests: float, window: float = WINDOW) -> None:
        self.buckets[endpoint] = Bucket(requests * self.share, window, self.clock)

    def acquire(self, endpoint: str, tokens: float = 1, blocking: bool = True, timeout: float | None = None) -> bool:
        bucket, began = self.buckets.get(endpoint), self.clock()
        while bucket is not None:
            with self.lock:
                if bucket.consume(tokens):
                    break
                wait = bucket.wait_time(tokens)
            if not blocking:
                return False
            if timeout is not None and self.clock() - began + wait > timeout:
                raise RateLimitExceeded(endpoint, wait)
            self.sleep(wait)
        return True

    def backoff(self, endpoint: str) -> float:
        """The next delay: doubling from the base, at most the maximum, plus up to ``jitter`` of it."""
        n = self.failures.get(endpoint, 0)
        self.failures[endpoint] = n + 1
        return min(self.base_delay * 2**n, self.max_delay) * (1 + random.random() * self.jitter)

    def reset(self, endpoint: str) -> None:
        self.failures.pop(endpoint, None)

    def status(self) -> dict[str, dict[str, float]]:
        return {e: {"available": b.available(), "capacity": b.capacity, "wait": b.wait_time(), "failures": self.failures.get(e, 0)} for e, b in self.buckets.items()}


def limited(limiter: RateLimiter, endpoint: str, tokens: float = 1) -> Callable:
    """Decorator: every call first takes ``tokens`` of the endpoint."""

    def wrap(f: Callable) -> Callable:
        @functools.wraps(f)
        def call(*a: object, **kw: object) -> object:
            limiter.acquire(endpoint, tokens)
            return f(*a, **kw)

        return call

    return wrap


def for_tier(tier: str = "basic", **kw: object) -> RateLimiter:
    limiter = RateLimiter(**kw)
    for endpoint, n in TIERS.get(tier, TIERS["basic"]).items():
        limiter.register(endpoint, n)
    return limiter


class SlidingWindow:
    """At most ``requests`` in any ``window`` seconds."""

    def __init__(self, requests: int = 1000, window: float = 3600, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.requests, self.window, self.clock, self.sleep = requests, window, clock, sleep
        self.times: deque[float] = deque()

    def wait(self) -> None:
        while self.times and self.clock() - self.times[0] >= self.window:
            self.times.popleft()
        if len(self.times) >= self.requests:
            self.sleep(self.times[0] + self.window - self.clock() + 1)
            self.times.popleft()
        self.times.append(self.clock())


def retrying(f: Callable, attempts: int = 5, base: float = 2.0, most: float = 60.0, errors: tuple = (OSError,), sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``f`` tried again after an error of ``errors``, with doubling delays, or the delay that the error names (``retry_after``)."""

    @functools.wraps(f)
    def call(*a: object, **kw: object) -> object:
        for n in range(attempts):
            try:
                return f(*a, **kw)
            except errors as e:
                if n == attempts - 1:
                    raise
                named = getattr(e, "retry_after", None)
                sleep(min(base * 2**n, most) if named is None else named)
        raise AssertionError

    return call
