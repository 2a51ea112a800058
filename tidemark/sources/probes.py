"""Fetching as a table operation, with an injected transport.

There is one rule about live pages: few requests at a time.  fetch() runs in at
most WORKERS partitions; a worker keeps its own pauses, retries and breaker.
Without a transport, probe results are simply an input table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..config import MAX_HOPS, REDIRECT_STATUSES
from ..functions.scalars import backoff_ms, retry_after_ms
from ..operators.quality import Streak

WORKERS, PAUSE_S, RETRIES, HOPS = 3, 0.5, 4, 8
RESULT = "path string, status int, firstStatus int, finalUrl string, title string, offsite boolean, error string"
#: transport(url) -> (status, headers, body); raises OSError.
Transport = Callable[[str], tuple[int, dict, str]]


def describe_error(error: BaseException) -> str:
    """An error in one line, with its cause where it has one."""
    cause = error.__cause__ or error.__context__
    text = str(error) or type(error).__name__
    return f"{text} ({cause})" if cause and str(cause) and str(cause) not in text else text


class RetryLog:
    """Passes on the first messages and then every so many, so that a storm of retries stays readable."""

    def __init__(self, warn: Callable[[str], None], label: str, first: int = 5, every: int = 100) -> None:
        self.warn, self.label, self.first, self.every, self.n = warn, label, first, every, 0

    def __call__(self, message: str) -> None:
        self.n += 1
        if self.n <= self.first or self.n % self.every == 0:
            self.warn(f"{self.label}: {message}" + ("" if self.n < self.first else f" (retry {self.n})"))


def probe_page(url: str, host: str, transport: Transport, retries: int = RETRIES, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Follow a page by hand: status of the first and of the last answer, final URL, title."""
    from urllib.parse import urljoin, urlsplit

    first, at = None, url
    for _ in range(HOPS + 1):
        answer = None
        for attempt in range(retries + 1):
            try:
                answer = transport(at)
            except OSError as e:
                problem = describe_error(e)
            else:
                if answer[0] != 429 and answer[0] < 500:
                    break
                problem = f"HTTP {answer[0]}"
            if attempt < retries:
                wait = retry_after_ms((answer or (0, {}, ""))[1].get("retry-after"), int(time.time() * 1000)) if answer else None
                sleep(backoff_ms(attempt, retry_after=wait) / 1000)
        else:
            return {"status": answer and answer[0], "firstStatus": first, "finalUrl": at, "title": None, "offsite": False, "error": problem}
        status, headers, body = answer
        first = status if first is None else first
        if status not in REDIRECT_STATUSES:
            import re

            title = re.search(r"(?is)<title[^>]*>(.*?)</title>", body or "")
            return {"status": status, "firstStatus": first, "finalUrl": at, "title": title and re.sub(r"\s+", " ", title[1]).strip(), "offsite": False, "error": None}
        at = urljoin(at, headers.get("location", ""))
        if urlsplit(at).hostname != host:
            return {"status": status, "firstStatus": first, "finalUrl": at, "title": None, "offsite": True, "error": None}
    return {"status": None, "firstStatus": first, "finalUrl": at, "title": None, "offsite": False, "error": f"more than {HOPS} redirects"}


def fetch(queue: DataFrame, host: str, transport: Transport, pause: float = PAUSE_S, streak: int = 40, deadline: float | None = None) -> DataFrame:
    """Probe results of a queue (path); after `streak` bad answers in a row, or past the deadline, a worker leaves its rest out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        breaker, open_ = Streak(streak), True
        for frame in frames:
            rows = []
            for path in frame["path"]:
                if not open_ or (deadline and time.time() > deadline):
                    break
                r = probe_page(f"https://{host}{path}", host, transport)
                rows.append({"path": path, **r})
                open_ = not breaker.add(bool(r["error"]))
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return queue.select("path").coalesce(WORKERS).mapInPandas(run, RESULT)


__all__ = ["HOPS", "MAX_HOPS", "RESULT", "WORKERS", "RetryLog", "describe_error", "fetch", "probe_page"]
