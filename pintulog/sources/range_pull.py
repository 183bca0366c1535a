"""Pulling a time range from a log store, as a Spark data source.

The range is cut into half-open steps, one input partition each, so steps are fetched
side by side on the executors and a failed step is retried by Spark as a whole. Where the
store can count its entries, steps follow their volume: dense spans are cut, sparse ones
joined. Inside a step pages follow one another: the next page starts at the last time seen,
and the entries of that time already delivered are left out. A page may be shorter than
asked for, so a step ends only when a page shows that nothing was cut off, see :func:`pull`.
Entries go to Spark as Arrow batches of raw lines; Spark decodes them like any other line.

Filters on the pulled table go to the store as far as it can apply them: bounds on
``store_time`` shorten the range before it is cut into steps, labels that equal a text and
texts that a line contains go into the query. The rest stays in Spark.

How a page is fetched is up to a ``fetch`` callable, so the same source runs against
HTTP, files or a test double:

    fetch(query, start_ns, end_ns, limit) -> response body (text)

with the store's contract: entries with ``start <= time < end`` in time order, at most
``limit`` of them over all series, or at most as many as the store ever returns at once,
which is two or more. An optional ``volume(query, start_ns, end_ns, bins) -> list of counts`` tells how
many entries lie in equal parts of a range; a wrong count makes uneven steps and nothing else.
"""

import itertools
import json
import time
import urllib.parse
import urllib.request
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringContains,
)

Fetch = Callable[[str, int, int, int], str]
Volume = Callable[[str, int, int, int], list[int]]
Entry = tuple[int, str, tuple[str | None, ...]]

NANOS = 1_000_000_000
HOUR = 3600 * NANOS
STEP_HOURS = "0.1"
SLICE_ENTRIES = "50000"
STEPS_PER_BATCH = "240"
RAW_DDL = "store_time bigint, line string"
ROWS_PER_BATCH = 4096
BINS = 64

# How far a search for a longer page goes; stores refuse ranges of more than a month.
PROOF_SPAN = 30 * 24 * HOUR


class StoreLimit(RuntimeError):
    """The store returns no page large enough for all entries of one time."""


def to_nanos(text: str) -> int:
    """ISO time to nanoseconds since 1970; digits past microseconds are kept."""
    text = text.strip().replace("Z", "+00:00")
    head, dot, tail = text.partition(".")
    fraction, zone = "", ""
    if dot:
        digits = len(tail) - len(tail.lstrip("0123456789"))
        fraction, zone = tail[:digits], tail[digits:]
    whole = datetime.fromisoformat(head + zone)
    if whole.tzinfo is None:
        whole = whole.replace(tzinfo=timezone.utc)
    return int(whole.timestamp()) * NANOS + int(fraction.ljust(9, "0")[:9] or 0)


def http_fetch(url: str, timeout: float = 600.0) -> Fetch:
    """Pages over HTTP, oldest entries first. An HTTP error fails the task."""

    def fetch(query: str, start: int, end: int, limit: int) -> str:
        arguments = urllib.parse.urlencode(
            {"query": query, "start": start, "end": end, "limit": limit, "direction": "FORWARD"}
        )
        with urllib.request.urlopen(f"{url}?{arguments}", timeout=timeout) as response:
            return response.read().decode("utf-8")

    return fetch


def http_volume(url: str, timeout: float = 600.0) -> Volume:
    """Counts over HTTP, from the store's count of entries per stretch of time."""

    def volume(query: str, start: int, end: int, bins: int) -> list[int]:
        seconds = max(1, -(-(end - start) // (bins * NANOS)))
        arguments = urllib.parse.urlencode(
            {"query": f"sum(count_over_time({query}[{seconds}s]))", "start": start + seconds * NANOS, "end": end + seconds * NANOS, "step": seconds}
        )
        with urllib.request.urlopen(f"{url}?{arguments}", timeout=timeout) as response:
            series = json.loads(response.read())["data"]["result"]
        counts = [0] * bins
        for at, count in (point for one in series for point in one["values"]):
            # a count stands at the end of its stretch
            place = (int(float(at) * NANOS) - seconds * NANOS - start) * bins // max(1, end - start)
            counts[min(max(place, 0), bins - 1)] += int(float(count))
        return counts

    return volume


def page_entries(body: str, labels: tuple[str, ...] = ()) -> list[Entry]:
    """All entries of a page over its series, in time order, each with its values of ``labels``."""
    entries = []
    for one in json.loads(body)["data"]["result"]:
        known = tuple(one.get("stream", {}).get(name) for name in labels)
        entries += [(int(at), line, known) for at, line, *_ in one["values"]]
    return sorted(entries, key=lambda entry: entry[0])


class _Pages:
    """Pages of one query, and the longest one the store has returned."""

    def __init__(self, fetch: Fetch, query: str, labels: tuple[str, ...], store_page: int | None):
        self.fetch, self.query, self.labels = fetch, query, labels
        self.longest, self.store_page = 0, store_page

    def page(self, start: int, end: int, limit: int) -> list[Entry]:
        entries = page_entries(self.fetch(self.query, start, end, limit), self.labels)
        self.longest = max(self.longest, len(entries))
        return entries

    def is_whole(self, count: int, at: int) -> bool:
        """Whether a page of ``count`` entries, fewer than asked for, is all there was.

        It is if the store can return more at once: by its contract, by what is told of it, or
        because it has done so. If it never has, wider and wider ranges round ``at`` are asked
        for one entry more.
        """
        if self.store_page is not None:
            return count < self.store_page
        span = HOUR
        while count >= max(2, self.longest) and span <= PROOF_SPAN:
            self.page(max(at - span, 0), at + span, count + 1)
            span *= 4
        return count < max(2, self.longest)

    def instant(self, at: int, limit: int) -> list[Entry]:
        """All entries of one time."""
        size = limit
        while len(entries := self.page(at, at + 1, size)) >= size:
            size *= 2
        if not self.is_whole(len(entries), at):
            raise StoreLimit(f"{len(entries)} entries at time {at} are as many as the store returns at once; there may be more")
        return entries


def pull(
    fetch: Fetch, query: str, start: int, end: int, limit: int, labels: tuple[str, ...] = (), store_page: int | None = None
) -> Iterator[Entry]:
    """Every entry (time, line, labels) of ``[start, end)`` once, page by page, or :class:`StoreLimit`.

    Only the entries at the newest time seen are remembered. What a page holds before its last
    time is complete; its last time may be cut, so the next page starts there. A page that ends
    at the time it starts from is the end if it is whole (:meth:`_Pages.is_whole`). Else that one
    time is asked for by itself, with larger pages; when no page of the store was ever longer
    than its entries, some may be missing and the pull fails, unless ``store_page`` says how
    many entries the store returns at most.
    """
    pages = _Pages(fetch, query, labels, store_page)
    cursor, delivered = start, Counter()

    def fresh(entries: list[Entry]) -> Iterator[Entry]:
        left = Counter(delivered)
        for entry in entries:
            if left[entry] > 0:
                left[entry] -= 1
            else:
                yield entry

    while cursor < end:
        entries = [e for e in pages.page(cursor, end, limit) if cursor <= e[0] < end]
        if not entries:
            return
        last = entries[-1][0]
        if last > cursor:
            yield from fresh(entries)
            cursor, delivered = last, Counter(e for e in entries if e[0] == last)
        elif len(entries) < limit and pages.is_whole(len(entries), cursor):
            yield from fresh(entries)
            return
        else:
            yield from fresh(pages.instant(cursor, limit))
            cursor, delivered = cursor + 1, Counter()


class Step(InputPartition):
    """A half-open slice of the range, in nanoseconds."""

    def __init__(self, start: int, end: int) -> None:
        super().__init__((start, end))
        self.start = start
        self.end = end


def steps(start: int, end: int, width: int) -> list[Step]:
    return [Step(at, min(at + width, end)) for at in range(start, end, width)]


def volume_steps(volume: Volume, query: str, start: int, end: int, most: int) -> list[Step]:
    """Steps of about ``most`` entries: dense spans are cut into parts, neighbours with few joined.

    A span is cut as long as it holds more than ``most`` entries and is longer than a
    nanosecond, so the calls grow with the dense spans and not with the range.
    """
    counted: list[tuple[int, int, int]] = []
    spans = [(start, end, None)] if start < end else []
    while spans:
        low, high, count = spans.pop()
        if count is not None and (count <= most or high - low < 2):
            counted.append((low, high, count))
            continue
        bins = min(BINS, high - low) if count is None else min(2 * -(-count // most), BINS, high - low)
        counts = volume(query, low, high, bins)
        cuts = [low + (high - low) * k // bins for k in range(bins + 1)]
        if count is not None and sum(counts) <= 0:
            counts = [-(-count // bins)] * bins  # counts that contradict each other still cut the span
        # the first part on top, so spans come in time order
        spans += [(a, b, n) for a, b, n in zip(cuts, cuts[1:], counts)][::-1]
    out: list[Step] = []
    held = 0
    for low, high, count in counted:
        if out and held + count <= most:
            out[-1] = Step(out[-1].start, high)
            held += count
        else:
            out.append(Step(low, high))
            held = count
    return out


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)


def narrowed(query: str, labels: dict[str, str], contained: Iterable[str]) -> str:
    """``query`` with further label matchers in its selector and line filters after it.

    A query without a selector in braces is left as it is.
    """
    quote, at = None, 0
    if not query.startswith("{"):
        return query
    while at < len(query) and (quote or query[at] != "}"):
        if quote and query[at] == "\\" and quote == '"':
            at += 1
        elif quote is None and query[at] in "\"`":
            quote = query[at]
        elif query[at] == quote:
            quote = None
        at += 1
    if at >= len(query):
        return query
    matchers = [f"{name}={_quoted(value)}" for name, value in labels.items()]
    inside = query[1:at].strip()
    selector = ", ".join(([inside] if inside else []) + matchers)
    return "{" + selector + query[at:] + "".join(f" |= {_quoted(text)}" for text in contained)


class _Pull:
    """What both readers share: options, and reading one step."""

    def __init__(self, options: dict, fetch: Fetch, volume: Volume | None = None) -> None:
        self.fetch, self.volume = fetch, volume
        self.query = options.get("query", "")
        self.limit = int(options.get("limit", "500"))
        self.width = int(float(options.get("stepHours", STEP_HOURS)) * HOUR)
        self.most = int(options.get("sliceEntries", SLICE_ENTRIES))
        self.labels = label_names(options)
        self.store_page = int(options["storePage"]) if "storePage" in options else None
        self.start = to_nanos(options["start"])
        self.end = to_nanos(options["end"]) if "end" in options else None
        if self.limit < 1 or self.width < 1 or self.most < 1:
            raise ValueError("limit, stepHours and sliceEntries must be positive")

    def cut(self, start: int, end: int) -> list[Step]:
        if self.volume is None:
            return steps(start, end, self.width)
        return volume_steps(self.volume, self.query, start, end, self.most)

    def read(self, partition: Step) -> Iterator[pa.RecordBatch]:
        entries = pull(self.fetch, self.query, partition.start, partition.end, self.limit, self.labels, self.store_page)
        while some := list(itertools.islice(entries, ROWS_PER_BATCH)):
            times, lines, known = zip(*some)
            values = [pa.array(column, pa.string()) for column in zip(*known)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(times, pa.int64()), pa.array(lines, pa.string()), *values], ["store_time", "line", *self.labels]
            )


class RangeReader(_Pull, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over bounds on the time; labels and texts narrow the query and are checked again."""
        labels, contained = {}, []
        for one in filters:
            column = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            if column == "store_time" and isinstance(one, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(one, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.start = max(self.start, one.value + isinstance(one, GreaterThan))
                if isinstance(one, (EqualTo, LessThan, LessThanOrEqual)):
                    bound = one.value + (not isinstance(one, LessThan))
                    self.end = bound if self.end is None else min(self.end, bound)
                continue
            # a label has one value, so of two texts it should equal only the first is sent
            if isinstance(one, EqualTo) and column in self.labels:
                labels.setdefault(column, one.value)
            elif isinstance(one, StringContains) and column == "line":
                contained.append(one.value)
            yield one
        self.query = narrowed(self.query, labels, contained)

    def partitions(self) -> list[Step]:
        if self.end is None:
            raise ValueError("a batch pull needs an end")
        return self.cut(self.start, self.end)


class RangeStreamReader(_Pull, DataSourceStreamReader):
    """The same range as it fills: the offset is the start of what comes next.

    ``lagSeconds`` keeps the newest entries back until late ones have arrived. A batch takes
    in at most ``stepsPerBatch`` steps past the last one, so a backlog comes in many batches,
    of which an ``availableNow`` run takes one. A query asks how far to go before it says where it begins; if
    it resumes, Spark first has it plan the empty batch at its last offset, so it knows.
    """

    def __init__(self, options: dict, fetch: Fetch, now: Callable[[], int], volume: Volume | None = None) -> None:
        super().__init__(options, fetch, volume)
        self.now = now
        self.lag = int(float(options.get("lagSeconds", "60")) * NANOS)
        self.reach = int(options.get("stepsPerBatch", STEPS_PER_BATCH)) * self.width
        self.planned = self.start
        if self.reach < 1:
            raise ValueError("stepsPerBatch must be positive")

    def initialOffset(self) -> dict:
        return {"next": self.start}

    def latestOffset(self) -> dict:
        ready = max(self.now() - self.lag, self.start)
        if self.end is not None:
            ready = min(ready, self.end)
        return {"next": max(self.planned, min(ready, self.planned + self.reach))}

    def partitions(self, start: dict, end: dict) -> list[Step]:
        self.planned = end["next"]
        return self.cut(start["next"], end["next"])


def label_names(options: dict) -> tuple[str, ...]:
    return tuple(filter(None, (name.strip() for name in options.get("labels", "").split(","))))


def range_source(
    fetch: Fetch, name: str = "log_range", now: Callable[[], int] = time.time_ns, volume: Volume | None = None
) -> type[DataSource]:
    """A data source over ``fetch``, for ``spark.dataSource.register``.

    Options: ``start``, ``end`` (ISO times), ``query``, ``limit`` (page size), ``labels``
    (names, with commas; each a column), ``stepHours``, or with ``volume`` ``sliceEntries``;
    ``storePage`` (entries the store returns at most, if known), and for streams
    ``lagSeconds`` and ``stepsPerBatch``. Filters are pushed down where
    ``spark.sql.python.filterPushdown.enabled`` is on.
    """

    class RangeSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ", ".join([RAW_DDL, *(f"`{label}` string" for label in label_names(self.options))])

        def reader(self, schema) -> DataSourceReader:
            return RangeReader(self.options, fetch, volume)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return RangeStreamReader(self.options, fetch, now, volume)

    return RangeSource
