"""A paged web source as a Spark data source: pages are fetched in parallel by executors.

How a page is fetched is up to the caller, who hands over a function of (date_range, skip, limit, options) that returns
the page as JSON text, or None when there is nothing. It raises ``SourceUnavailable`` when the service cannot be reached.

Batch:  register(spark, fetch); spark.read.format("paged_reports").option("date_range", ...).load()
Stream: the same with readStream. The offset holds how many rows of each window were handed out, so a batch that is
        planned again fetches the same pages, and a window that grows later is carried on.

The service serves at most ``cap`` rows of a window. A larger window is split by days until each part fits; a single day
above the cap is an error. A page that should be there and is not is an error too: no row is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from caselight.session import ship_package
from caselight.sources.windows import EARLIEST_YEAR, PAGE_LIMIT, SKIP_CAP, halves, steps_back, years_back

Fetcher = Callable[[str, int, int, dict], "str | None"]
PAGES_PER_TASK = 10


class SourceUnavailable(RuntimeError):
    """The service cannot be reached; a load may fall back to what landed before."""


class MissingPage(RuntimeError):
    """The service announced rows that it does not hand out."""


class Pages(InputPartition):
    """Rows ``start`` to ``end`` of one window, fetched page by page by one task."""

    def __init__(self, date_range: str, start: int, end: int):
        self.date_range, self.start, self.end = date_range, start, end


class Service:
    """Sizes, parts and pages of windows."""

    def __init__(self, options: dict, fetch: Fetcher):
        self.options = dict(options)
        self.fetcher = fetch
        self.limit = int(options.get("limit", PAGE_LIMIT))
        self.cap = int(options.get("cap", SKIP_CAP))
        self.rows_per_task = self.limit * int(options.get("pages_per_task", PAGES_PER_TASK))
        self.earliest = int(options.get("earliest_year", EARLIEST_YEAR))

    def size(self, date_range: str) -> int:
        """Rows of a window, from the envelope of its first page."""
        page = self.fetcher(date_range, 0, self.limit, self.options)
        envelope = json.loads(page) if page else {}
        return int(envelope.get("meta", {}).get("results", {}).get("total", 0)) if envelope.get("results") else 0

    def parts(self, date_range: str) -> list[list]:
        """[range, rows] of a window, or of the parts that it takes to stay within the cap; empty parts are left out."""
        rows = self.size(date_range)
        if rows > self.cap:
            return [part for half in halves(date_range) for part in self.parts(half)]
        return [[date_range, rows]] if rows else []

    def earlier(self, date_range: str) -> list[str]:
        """The window and all before it, newest first."""
        return [years_back(date_range, n) for n in range(steps_back(date_range, self.earliest) + 1)]

    def tasks(self, parts: list[list], start: int, end: int) -> list[Pages]:
        """Runs of pages for rows ``start`` to ``end``, counted over all parts of a window."""
        out, before = [], 0
        for date_range, rows in parts:
            first, last = max(start - before, 0), min(end - before, rows)
            out += [Pages(date_range, at, min(at + self.rows_per_task, last)) for at in range(first, last, self.rows_per_task)]
            before += rows
        return out

    def pages(self, run: Pages) -> Iterator[tuple[str, int, str]]:
        """The last page of a window is asked for with what is left, so any start works and the cap is never passed."""
        for skip in range(run.start, run.end, self.limit):
            wanted = min(self.limit, run.end - skip)
            page = self.fetcher(run.date_range, skip, wanted, self.options)
            found = len(json.loads(page).get("results") or []) if page else 0
            if found < wanted:
                raise MissingPage(f"{found} of {wanted} rows at skip={skip} in {run.date_range}")
            yield run.date_range, skip, page


def position(options: dict, fetch: Fetcher) -> dict:
    """Where a batch starts: the cursor itself, or the start of the newest earlier window with rows once it is used up.

    Returns {date_range, skip, parts}; without any rows left ``parts`` is empty.
    """
    service, skip = Service(options, fetch), int(options.get("skip", 0))
    for date_range in service.earlier(options["date_range"]):
        parts = service.parts(date_range)
        if skip < sum(rows for _, rows in parts):
            return {"date_range": date_range, "skip": skip, "parts": parts}
        skip = 0
    return {"date_range": options["date_range"], "skip": int(options.get("skip", 0)), "parts": []}


class PagedBatchReader(DataSourceReader):
    """The rows of a window from ``skip`` on, all of them or at most ``max_rows``."""

    def __init__(self, options: dict, fetch: Fetcher):
        self.service, self.options, self.fetch = Service(options, fetch), dict(options), fetch

    def partitions(self) -> list[Pages]:
        where = position(self.options, self.fetch)
        end = sum(rows for _, rows in where["parts"])
        if "max_rows" in self.options:
            end = min(end, where["skip"] + int(self.options["max_rows"]))
        # Spark wants one partition at least.
        return self.service.tasks(where["parts"], where["skip"], end) or [Pages(where["date_range"], 0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple[str, int, str]]:
        yield from self.service.pages(partition)


class PagedStreamReader(DataSourceStreamReader):
    """All pages from the cursor to the end of the earliest window; the checkpoint keeps what was handed out."""

    def __init__(self, options: dict, fetch: Fetcher):
        self.service = Service(options, fetch)
        self.date_range = options["date_range"]
        self.skip = int(options.get("skip", 0))

    def initialOffset(self) -> dict:
        return {"windows": {}}

    def latestOffset(self) -> dict:
        return {"windows": {window: self.service.parts(window) for window in self.service.earlier(self.date_range)}}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        """A window that had to be split anew since the last batch is fetched again as a whole: loads are by key."""
        out: list[Pages] = []
        for window, parts in end["windows"].items():
            before = start["windows"].get(window, [])
            same = [part[0] for part in before] == [part[0] for part in parts]
            if same:
                for (date_range, had), (_, has) in zip(before, parts):
                    out += self.service.tasks([[date_range, has]], had, has)
            else:
                skip = self.skip if window == self.date_range and not before else 0
                out += self.service.tasks(parts, skip, sum(rows for _, rows in parts))
        return out or [Pages(self.date_range, 0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple[str, int, str]]:
        yield from self.service.pages(partition)

    def commit(self, end: dict) -> None:
        """Nothing to release: the checkpoint holds the offset."""


class PagedReports(DataSource):
    """Rows (date_range, skip, page). Subclasses say how to fetch, see ``register``."""

    fetch: Fetcher

    @classmethod
    def name(cls) -> str:
        return "paged_reports"

    def schema(self) -> str:
        return "date_range string, skip bigint, page string"

    def reader(self, schema) -> DataSourceReader:
        return PagedBatchReader(self.options, type(self).fetch)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStreamReader(self.options, type(self).fetch)


def register(spark: SparkSession, fetch: Fetcher) -> None:
    """Make the format ``paged_reports`` available in a session, fetching pages with the given function."""
    ship_package()
    spark.dataSource.register(type("PagedReports", (PagedReports,), {"fetch": staticmethod(fetch)}))
