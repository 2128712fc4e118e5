"""The three boards as sources of a run: landed as files first, then read by Spark; one that fails is a status row."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..judge import retried
from ..operators import normalize
from ..runstate import write_text
from ..vocab import ERROR_CHARS
from . import landed, live

# The boards' addresses.
BOARD = "https://remoteok.com/api"
FEEDS = ("https://weworkremotely.com/categories/remote-programming-jobs.rss", "https://weworkremotely.com/categories/remote-product-jobs.rss")
SEARCH = "https://hn.algolia.com/api/v1/search_by_date?tags=story,author_whoishiring&query=Who%20is%20hiring"
THREAD = "https://hn.algolia.com/api/v1/items/%s"

#: A source: reads its items; what they become is in LISTINGS.
Source = Callable[[], DataFrame]

LISTINGS = {"remoteok": normalize.board_listings, "weworkremotely": normalize.feed_listings, "hn_whoishiring": normalize.thread_listings}

#: Spark's conditions for a file that is missing or isn't what it should be.
TOLERATED = ("PATH_NOT_FOUND", "MALFORMED_RECORD_IN_PARSING", "FAILED_READ_FILE", "ParseError", "FileNotFound")


class NoAnswer(RuntimeError):
    """A source that gave nothing to read; tolerated, unlike an error of our own."""


def tolerated(e: Exception) -> bool:
    """C4: whether an error is the source's, not ours."""
    return isinstance(e, (*live.FETCH_ERRORS, NoAnswer)) or isinstance(e, PySparkException) and any(t in str(e) for t in TOLERATED)


def put(spark: SparkSession, folder: str, place: str, read: Callable[[str], bytes] = live.get) -> str:
    """Where Spark finds a place: a web address is read and landed below folder, other paths stand as they are."""
    if not place.startswith(("http://", "https://")):
        return place
    path = f"{folder.rstrip('/')}/{hashlib.sha256(place.encode()).hexdigest()[:16]}"
    write_text(spark, path, read(place).decode("utf-8", "replace"))
    return path


def sources(spark: SparkSession, folder: str, *, board: str = BOARD, feeds: Sequence[str] = FEEDS, search: str = SEARCH, thread: str = THREAD, read: Callable[[str], bytes] = live.get) -> dict[str, Source]:
    """The boards by name, at web addresses or in files; thread holds %s for the thread's number."""

    def hiring() -> DataFrame:
        hits = put(spark, folder, search, read)
        found = landed.first_hit(spark, hits).first()  # one row
        return landed.thread_items(spark, hits, put(spark, folder, thread % found.thread, read)) if found.thread is not None else landed.no_items(spark)

    return {
        "remoteok": lambda: landed.board_items(spark, put(spark, folder, board, read)),
        "weworkremotely": lambda: landed.feed_items(spark, [put(spark, folder, f, read) for f in feeds]),
        "hn_whoishiring": hiring,
    }


def fetched(given: Mapping[str, Source], keep: Callable[[str, DataFrame], DataFrame], *, attempts: int = 3, base_s: float = 1.0, sleep: Callable[[float], None] = time.sleep, on_retry: Callable[[str, int, Exception], None] | None = None) -> tuple[dict[str, DataFrame], list[tuple]]:
    """The items of every source that could be read, kept by keep(name, items), and a row of schemas.STATUS for each source."""
    found, rows = {}, []
    for name, source in given.items():
        used = [0]

        def call(name=name, source=source, used=used) -> DataFrame:
            used[0] += 1
            return keep(name, source())

        try:
            found[name], _ = retried(call, attempts, base_s, sleep=sleep, on_retry=lambda k, e, name=name: on_retry and on_retry(name, k, e))
            rows.append((name, "success", used[0], found[name].count(), None))
        except Exception as e:
            if not tolerated(e):
                raise
            rows.append((name, "failed", used[0], 0, str(e)[:ERROR_CHARS] or type(e).__name__))
    return found, rows


def listings(items: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Each source's items as listings."""
    return {name: LISTINGS[name](df) for name, df in items.items() if name in LISTINGS}


