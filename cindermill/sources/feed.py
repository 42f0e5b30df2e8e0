"""A paged feed of tasks: pages of at most 200 items, each naming the next page's cursor, as a batch and a stream source.

A page is a JSON document ({"items": [...], "nextCursor": text or nothing}) under a folder: the first is ``first.json``, the
others are named by their cursors. The items' text is kept as it is in the page, so any projection can follow.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from cindermill.sources.files import Rejected, exists, place, read_json

#: Items of a page, pages of one look-up, the kind of job that a calculation is.
PAGE, PAGES = 200, 5
JOB_KIND = "lcia_result.package_build"
#: A feed of more pages has several in a partition.
PARTITIONS = 256
FIRST = "first"


def page_name(cursor: str) -> str:
    return f"{quote(cursor, safe='')}.json"


class Pages:
    """The pages of a folder; picklable."""

    def __init__(self, path: str):
        self.path = path

    def get(self, cursor: str) -> tuple[list[str], str | None] | None:
        """The items' texts and the next cursor of a page; None where it isn't there (yet)."""
        page = self.read(cursor)
        return page and ([json.dumps(i, ensure_ascii=False) for i in page[0]], page[1])

    def read(self, cursor: str) -> tuple[list, str | None] | None:
        """As ``get``, the items as they are."""
        system, inner = place(self.path)
        at = f"{inner}/{page_name(cursor)}"
        if not exists(system, at):
            return None
        page = read_json(system, at)
        page = page if isinstance(page, dict) else {}
        items = page.get("items") if isinstance(page.get("items"), list) else []
        if len(items) > PAGE:
            raise Rejected("feed_page_too_large", f"{cursor}: {len(items)}")
        return items, page.get("nextCursor") or None


class PageRange(InputPartition):
    """Pages in a row: the first one's number (0: the row of what is beyond) and the cursors."""

    def __init__(self, number: int, cursors: list[str]):
        self.number, self.cursors = number, cursors


class PageReader(DataSourceReader):
    """Follows the cursors when planned (at most ``maxPages``), reads a page in a task, or several in a row where there are more than ``PARTITIONS``. A feed that goes on beyond has a last row without an item, of which the cursor is the next page's."""

    def __init__(self, options):
        self.pages, self.most = Pages(options["path"]), int(options.get("maxPages", PAGES))

    def partitions(self) -> list[PageRange]:
        out, cursor, seen = [], FIRST, set()
        while cursor and len(out) < self.most:
            if cursor in seen:
                raise Rejected("feed_cursor_repeats", cursor)
            seen.add(cursor)
            page = self.pages.read(cursor)
            if page is None:
                raise Rejected("feed_page_missing", cursor)
            out.append(cursor)
            cursor = page[1]
        size = -(-len(out) // PARTITIONS) or 1
        ranges = [PageRange(i + 1, out[i : i + size]) for i in range(0, len(out), size)]
        return [*ranges, PageRange(0, [cursor])] if cursor else ranges

    def read(self, partition: PageRange) -> Iterator[tuple]:
        if not partition.number:
            yield None, partition.cursors[0], None, None
            return
        for number, cursor in enumerate(partition.cursors, partition.number):
            for place_in_page, item in enumerate(self.pages.get(cursor)[0], 1):
                yield number, cursor, place_in_page, item


class PageStream(SimpleDataSourceStreamReader):
    """Offset: the last page read. A batch reads at most ``maxPages`` pages from there on; the same offsets give the same rows again.

    A page without a next cursor is the end for now: it is asked again at the next trigger, and read on from when it has one.
    """

    def __init__(self, options):
        self.pages, self.most = Pages(options["path"]), int(options.get("maxPages", PAGES))

    def initialOffset(self) -> dict:
        return {"page": "", "number": 0}

    def follow(self, start: dict, most: int, last: str | None = None) -> tuple[list[tuple], dict]:
        rows, at = [], dict(start)
        for _ in range(most):
            if at["page"] == last:
                break
            before = self.pages.get(at["page"]) if at["page"] else None
            cursor = before[1] if before else None if at["page"] else FIRST
            page = self.pages.get(cursor) if cursor else None
            if page is None:
                break
            at = {"page": cursor, "number": at["number"] + 1}
            rows += [(at["number"], cursor, i, item) for i, item in enumerate(page[0], 1)]
        return rows, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self.follow(start, self.most)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self.follow(start, end["number"] - start["number"], end["page"])[0])


class PagedFeed(DataSource):
    """``spark.read`` or ``spark.readStream`` ``.format("paged_feed")``: page, cursor, position, item (JSON text)."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "page int, cursor string, position int, item string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PageStream(self.options)


TASK = "jobId string, jobKind string, workerStatus string, domainStatus string, domainValidity string, phase string, progressFraction double, updatedAt string"


def tasks(items: DataFrame) -> DataFrame:
    """The calculation tasks among the items: page, position and the fields of ``TASK``, blank texts as null."""
    rows = items.where("item is not null").select("page", "position", F.from_json("item", TASK).alias("t")).select("page", "position", "t.*")
    texts = [c for c, kind in rows.dtypes if kind == "string"]
    trimmed = rows.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in texts})
    return trimmed.where((F.col("jobKind") == JOB_KIND) & F.col("jobId").isNotNull())


def feed(spark: SparkSession, path: str, pages: int = PAGES) -> DataFrame:
    spark.dataSource.register(PagedFeed)
    return spark.read.format("paged_feed").option("maxPages", pages).load(path)


def feed_stream(spark: SparkSession, path: str, pages: int = PAGES) -> DataFrame:
    spark.dataSource.register(PagedFeed)
    return spark.readStream.format("paged_feed").option("maxPages", pages).load(path)


def lookup(spark: SparkSession, path: str, job_id: str, pages: int = PAGES) -> DataFrame:
    """One row: the first task of that job with its page, or the code of why there is none."""
    items = feed(spark, path, pages)
    found = tasks(items).where(F.col("jobId") == job_id).agg(F.min_by(F.struct("*"), F.struct("page", "position")).alias("t"))
    more = items.agg(F.coalesce(F.bool_or(F.col("page").isNull()), F.lit(False)).alias("more"))
    code = F.when(F.col("t").isNotNull(), F.lit(None)).when(F.col("more"), "calculation_task_lookup_incomplete").otherwise("calculation_task_not_found")
    return found.crossJoin(more).select(F.lit(job_id).alias("job_id"), "t.page", "t.workerStatus", "t.progressFraction", code.cast("string").alias("code"))  # one row each
