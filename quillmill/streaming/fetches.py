"""The outcome of every URL over the life of a stream: first success, or attempts used up.

The state of a URL is small (done, failed attempts, when to try again) and is kept by Spark's arbitrary stateful processing, in
RocksDB on the executors. Bodies pass through once, of the one accepted attempt of a batch.

Every key costs four messages between Python and the JVM and an Arrow batch of its own, which is far more than the work on a URL. So
without timers a key is a page: all URLs with one of ``PAGES`` hashes, whose state is read and written as a whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillmill.operators import ingest

ACCEPTED, RETRY, REJECTED, DUE = "accepted", "retry", "rejected", "due"

#: What an outcome says beside the columns of the attempt that brought it about.
OUTCOME = "outcome string, attempts int, next_at timestamp"
_OUTCOME_NAMES = [column.split()[0] for column in OUTCOME.split(", ")]

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A position after all numbered ones, for attempts without a number.
_LAST = 1 << 62

#: Pages of URLs. With more, less of the state is read and written for a URL; with fewer, a batch has fewer keys. A stream keeps its number.
PAGES = 1 << 15


class _Attempts:
    """A batch's attempts at one URL, in the order of ``ord``: its first success, and of its failures the ``left`` first ones."""

    __slots__ = ("left", "success", "failures", "latest", "n")

    def __init__(self, left: int):
        self.left, self.success, self.failures, self.latest, self.n = left, None, [], None, 0

    def add(self, row: Row, status: int | None, order: int | None, at: datetime | None) -> None:
        place = _LAST if order is None else order
        if status == 200:
            if self.success is None or place < self.success[0]:
                self.success = (place, row)
        else:
            # the heap keeps the least: places are negated, the greatest kept one stands first
            entry = (-place, self.n, row)
            heapq.heappush(self.failures, entry) if len(self.failures) < self.left else heapq.heappushpop(self.failures, entry)
        self.n += 1
        if at is not None:
            self.latest = at if self.latest is None else max(self.latest, at)

    def judged(self) -> tuple[str, Row, int, datetime | None]:
        """The outcome, the attempt that brought it about, failures in all, and when to try again."""
        before, success = ingest.MAX_ATTEMPTS - self.left, self.success
        earlier = [f for f in sorted(self.failures, reverse=True) if success is None or -f[0] < success[0]]
        if success is not None and len(earlier) < self.left:
            return ACCEPTED, success[1], before + len(earlier), None
        if len(earlier) >= self.left:
            return REJECTED, earlier[self.left - 1][2], ingest.MAX_ATTEMPTS, None
        attempts = before + len(earlier)
        wait = min(ingest.RETRY_MAX_SECONDS, max(ingest.RETRY_MIN_SECONDS, 2 ** (attempts - 1)))
        return RETRY, earlier[-1][2], attempts, None if self.latest is None else self.latest + timedelta(seconds=wait)


class UrlProgress(StatefulProcessor):
    """Attempts at one URL, in the order of ``ord`` within a batch.

    The first attempt with status 200 is accepted, unless ``MAX_ATTEMPTS`` failures come before it: the last of these rejects the URL.
    What comes after either is passed over. While the URL is open, a batch with failures gives a ``retry`` with the time to try again;
    with event time a timer gives a ``due`` then, if nothing came in the meantime, and after ``forget`` a done URL is forgotten.

    A batch's rows of one URL are read once and never held: only the least failures and the least success are. Rows come as
    tuples and not as data frames, since most URLs have one or two of them and a data frame costs more than the work on them.
    """

    def __init__(self, columns: list[str], timed: bool, forget_seconds: float):
        self.columns, self.timed, self.forget = columns, timed, forget_seconds
        self.status, self.ord = columns.index("status"), columns.index("ord")
        self.at = columns.index("at") if "at" in columns else None
        self.told = Row(*columns, *_OUTCOME_NAMES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "done boolean, attempts int, next_at bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        done, before, until = self.progress.get() or (False, 0, None)
        # a batch's rows come before the timers that its watermark sets off
        if done and self.timed and timerValues.getCurrentWatermarkInMs() >= until:
            done, before = False, 0
        if done:
            for _ in rows:  # a stream's iterator is read to its end
                pass
            return
        attempts = _Attempts(ingest.MAX_ATTEMPTS - before)
        for row in rows:
            attempts.add(row, row[self.status], row[self.ord], None if self.at is None else row[self.at])
        outcome, row, failed, next_at = attempts.judged()
        if outcome == RETRY:
            self.progress.update((False, failed, _millis(next_at)))
            if self.timed and next_at is not None:
                self._only_timer(_millis(next_at))
            yield self.told(*row, RETRY, failed, next_at)
        else:
            yield self._ends(outcome, row, failed, attempts.latest, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        done, attempts, next_at = self.progress.get()
        if done:
            self.progress.clear()
        else:
            empty = [key[0] if c == "pdf_url" else None for c in self.columns]
            yield self.told(*empty, DUE, attempts, datetime.fromtimestamp(next_at / 1000, timezone.utc))

    def _ends(self, outcome: str, row: Row, attempts: int, latest, timers) -> Row:
        until = None
        if self.timed:
            last = 0 if latest is None else _millis(latest)
            until = max(last, timers.getCurrentWatermarkInMs()) + int(self.forget * 1000)
            self._only_timer(until)
        self.progress.update((True, attempts, until))
        return self.told(*row, outcome, attempts, None)

    def _only_timer(self, at: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


class PageProgress(StatefulProcessor):
    """Attempts at all URLs of a page, each judged as by ``UrlProgress`` without timers.

    What is held of a batch are the least failures and the least success of every URL of one page. The state is a JSON list of
    ``[url, done, failed attempts, when to try again]``.
    """

    def __init__(self, columns: list[str]):
        self.url, self.status, self.ord = (columns.index(c) for c in ("pdf_url", "status", "ord"))
        self.at = columns.index("at") if "at" in columns else None
        self.width, self.told = len(columns), Row(*columns, *_OUTCOME_NAMES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.page = handle.getValueState("page", "urls string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.page.get()
        known = {} if held is None else {url: state for url, *state in json.loads(held[0])}
        batch: dict[str | None, _Attempts] = {}
        for row in rows:
            url = row[self.url]
            attempts = batch.get(url)
            if attempts is None:
                done, before, _ = known.get(url, (False, 0, None))
                if done:
                    continue
                attempts = batch[url] = _Attempts(ingest.MAX_ATTEMPTS - before)
            attempts.add(row, row[self.status], row[self.ord], None if self.at is None else row[self.at])
        if not batch:
            return
        for url, attempts in batch.items():
            outcome, row, failed, next_at = attempts.judged()
            known[url] = (outcome != RETRY, failed, _millis(next_at))
            yield self.told(*row[:self.width], outcome, failed, next_at)
        self.page.update((json.dumps([(url, *state) for url, state in known.items()], ensure_ascii=False, separators=(",", ":")),))

    def close(self) -> None:
        pass


def _millis(at: datetime | None) -> int | None:
    """Milliseconds since 1970; a time without a zone is in UTC."""
    return None if at is None else int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def fetch_outcomes(attempts: DataFrame, event_time: bool = False, delay: str = "1 minute", forget: float = 7 * 86400.0) -> DataFrame:
    """A stream of attempts (``pdf_url``, ``status``, ``ord``, perhaps ``at`` and more) to one of outcomes: their columns and ``OUTCOME``.

    Without ``event_time`` there are no timers: a URL stays known for good, ``next_at`` is told where ``at`` is known. With it ``at``
    is the event time, which may come ``delay`` late, and done URLs are forgotten ``forget`` seconds later. Rows without a
    URL are one URL. A batch takes attempts in the order of ``ord``; batches are taken as they come. Without ``event_time`` URLs are
    judged page by page.
    """
    spark = attempts.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
    types = dict(attempts.dtypes)
    if "content" in types:  # a body that is not accepted is not needed
        attempts = attempts.withColumn("content", F.when(F.col("status") == 200, F.col("content")))
    if "at" in types:
        attempts = attempts.withColumn("at", F.col("at").cast("timestamp"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in attempts.dtypes) + ", " + OUTCOME
    if event_time:
        timed = attempts.withWatermark("at", delay)
        return timed.groupBy("pdf_url").transformWithState(UrlProgress(attempts.columns, True, forget), schema, "Append", "EventTime")
    paged = attempts.withColumn("_page", F.pmod(F.xxhash64("pdf_url"), F.lit(PAGES)).cast("int"))
    return paged.groupBy("_page").transformWithState(PageProgress(attempts.columns), schema, "Append", "None")
