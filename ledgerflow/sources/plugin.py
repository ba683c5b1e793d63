"""Landed envelope pages as a Spark data source (G1, S2-S7): ``spark.read.format("landed_pages")``
and ``spark.readStream.format("landed_pages")``, after :func:`register`.

A page's array is cut into its elements while the file streams through, so a task holds one
element and one read buffer of a page, however large the page is; parsing the elements is
left to Spark. A row is (landed, page, file, pos, record): the extraction day, the page
number, the file, the element's place in its page and its JSON text.

Options: ``path``; ``envelope`` (the key of the array; absent for pages that are bare
arrays); ``landed_on`` (the folder key of extraction days); ``partition_bytes`` (files read
by one task). A filter on ``landed`` is used while partitions are planned: the folders of
other days are not listed. The stream's offset is the modification time and name of the last
file, so pages must be moved into the landing area whole and with a new time stamp; the area
is listed when all pages of the listing before have been read;
``files_per_batch`` bounds a micro-batch.
"""

from __future__ import annotations

import codecs
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from ledgerflow.sources.records import PAGE_PATTERN, drop_keys, ordinal

FORMAT = "landed_pages"
SCHEMA = "landed date, page long, file string, pos long, record string"
READ_BYTES = 1 << 20
ROWS_OUT = 1000
BYTES_OUT = 4 << 20

_MARK = re.compile(r'["{}\[\],]')
_IN_TEXT = re.compile(r'["\\]')


class PageError(Exception):
    pass


class ArrayCutter:
    """Cuts the elements out of one array of a JSON document that is fed in pieces: the
    document itself, or the value of a top-level key. Elements come as text, unparsed."""

    def __init__(self, key: str | None):
        self.key, self.inside = key, 1 if key is None else 2  # depth of the array's elements
        self.text, self.at, self.depth = "", 0, 0
        self.start: int | None = None  # of the element that is being read
        self.quoted = False
        self.opened, self.name = 0, ""  # of the last text at depth 1, which may be a key
        self.root = self.found = False

    def feed(self, piece: str) -> Iterator[str]:
        self.text += piece
        while True:
            mark = (_IN_TEXT if self.quoted else _MARK).search(self.text, self.at)
            if mark is None:
                self.at = len(self.text)
                break
            sign, self.at = mark.group(), mark.end()
            if self.quoted:
                if sign == "\\":
                    if self.at == len(self.text):
                        self.at -= 1  # what is escaped comes with the next piece
                        break
                    self.at += 1
                else:
                    self.quoted = False
                    if self.depth == 1 and self.key is not None:
                        self.name = self.text[self.opened:self.at]
            elif sign == '"':
                self.quoted, self.opened = True, mark.start()
            elif sign in "{[":
                self._open(sign)
            else:
                yield from self._end(sign, mark.start())
        # what lies before the element, or before an open text that may be the key, is done with
        keep = self.start if self.start is not None else self.opened if self.quoted and self.depth == 1 else self.at
        self.text, self.at, self.opened = self.text[keep:], self.at - keep, self.opened - keep
        if self.start is not None:
            self.start = 0

    def _open(self, sign: str) -> None:
        self.depth += 1
        if self.depth == 1:
            if sign != ("[" if self.key is None else "{"):
                raise PageError(f"the page is not {'an array' if self.key is None else 'an object'}")
            self.root = True
            if self.key is None:
                self.found, self.start = True, self.at
        elif self.depth == 2 and self.key is not None and json.loads(self.name or '""') == self.key and self.start is None:
            if sign != "[":
                raise PageError(f"{self.key} is not an array")
            self.found, self.start = True, self.at

    def _end(self, sign: str, at: int) -> Iterator[str]:
        if self.start is not None and self.depth == self.inside and sign in ",]":
            element = self.text[self.start:at].strip()
            if element:
                yield element
            self.start = self.at if sign == "," else None
        if sign != ",":
            self.depth -= 1
        elif self.depth == 1:
            self.name = ""

    def close(self) -> None:
        if self.depth or self.quoted or not self.root:
            raise PageError("the page ends before its end")


def page_of(path: str) -> int:
    found = re.search(PAGE_PATTERN, path)
    if found is None:
        raise PageError(f"no page number in the landed file name {path}")
    return int(found.group(1) or found.group(2))


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Page:
    path: str
    size: int
    changed: int  # nanoseconds
    landed: date | None


@dataclass
class PageGroup(InputPartition):
    """Whole pages for one task."""

    def __init__(self, pages: tuple[Page, ...]):
        super().__init__(pages)
        self.pages = pages


class Days:
    """Bounds on the extraction day, taken from filters."""

    def __init__(self):
        self.least: date | None = None
        self.most: date | None = None
        self.only: frozenset[date] | None = None

    def take(self, f: Filter) -> bool:
        """Whether the planning does all that the filter asks."""
        if getattr(f, "attribute", None) != ("landed",):
            return False
        if isinstance(f, EqualTo | In):
            wanted = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
            self.only = wanted if self.only is None else self.only & wanted
            return True
        if isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.least = f.value if self.least is None else max(self.least, f.value)
        elif isinstance(f, LessThan | LessThanOrEqual):
            self.most = f.value if self.most is None else min(self.most, f.value)
        return isinstance(f, GreaterThanOrEqual | LessThanOrEqual)  # the others keep the bound itself out

    def hold(self, day: date | None) -> bool:
        if day is None:
            return self.least is None and self.most is None and self.only is None
        return not (self.least and day < self.least or self.most and day > self.most or self.only is not None and day not in self.only)


class Landing:
    """The files of a landing area, and how a page is read."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.envelope, self.landed_on = options.get("envelope"), options.get("landed_on")
        self.partition_bytes = int(options.get("partition_bytes", 128 << 20))

    def pages(self, days: Days | None = None) -> list[Page]:
        from pyarrow import fs

        days = days or Days()
        store, top = _files(self.path)
        tops: list[tuple[str, date | None]] = [(top, None)]
        if self.landed_on:
            listed = store.get_file_info(fs.FileSelector(top))
            named = [(f.path, re.fullmatch(rf"{re.escape(self.landed_on)}=(\d{{4}}-\d\d-\d\d)", f.base_name)) for f in listed]
            tops = [(p, date.fromisoformat(m.group(1))) for p, m in named if m]
        out = []
        for folder, day in tops:
            if not days.hold(day):
                continue
            for f in store.get_file_info(fs.FileSelector(folder, recursive=True)):
                if f.is_file and not any(part[:1] in "._" for part in f.path[len(top):].split("/") if part):
                    out.append(Page(f.path, f.size, f.mtime_ns or 0, day))
        return sorted(out, key=lambda p: (p.changed, p.path))

    def groups(self, pages: list[Page]) -> list[PageGroup]:
        """Groups of about ``partition_bytes``; a larger page is a group of its own."""
        out, held, size = [], [], 0
        for p in pages:
            if held and size + p.size > self.partition_bytes:
                out.append(PageGroup(tuple(held)))
                held, size = [], 0
            held.append(p)
            size += p.size
        return out + ([PageGroup(tuple(held))] if held else [])

    def elements(self, page: Page) -> Iterator[str]:
        store, _ = _files(self.path)
        decode, cutter = codecs.getincrementaldecoder("utf-8")(), ArrayCutter(self.envelope)
        try:
            with store.open_input_stream(page.path) as file:
                while piece := file.read(READ_BYTES):
                    yield from cutter.feed(decode.decode(piece))
            yield from cutter.feed(decode.decode(b"", True))
            cutter.close()
        except PageError as e:
            raise PageError(f"{page.path}: {e}") from None

    def rows(self, group: PageGroup):
        import pyarrow as pa

        kinds, held, size = (pa.date32(), pa.int64(), pa.string(), pa.int64(), pa.string()), [], 0
        names = [field.split()[0] for field in SCHEMA.split(", ")]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*held), kinds)], names=names)

        for page in group.pages:
            number = page_of(page.path)
            for pos, element in enumerate(self.elements(page)):
                held.append((page.landed, number, page.path, pos, element))
                size += len(element)
                if len(held) == ROWS_OUT or size > BYTES_OUT:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.landing, self.days = Landing(options), Days()

    def pushFilters(self, filters: list[Filter]):
        return [f for f in filters if not self.days.take(f)]

    def partitions(self):
        return self.landing.groups(self.landing.pages(self.days))

    def read(self, partition: PageGroup):
        return self.landing.rows(partition)


def _place(page: Page) -> tuple[int, str]:
    return page.changed, page.path


class PagesStream(DataSourceStreamReader):
    """Offsets are (modification time, path) of the last file of a micro-batch."""

    def __init__(self, options: dict[str, str]):
        self.landing = Landing(options)
        self.most = int(options.get("files_per_batch", 1000))
        self.reached: tuple[int, str] = (-1, "")
        # what the last listing found behind ``self.listed``, in order; kept on the driver
        # like the backlog of Spark's own file source, one entry per page
        self.listed: tuple[int, str] = (-1, "")
        self.found: list[Page] = []

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def _list(self, start: tuple[int, str]) -> None:
        self.listed = start
        self.found = [p for p in self.landing.pages() if _place(p) > start]

    def latestOffset(self) -> dict:
        # the landing area is listed again only when the last listing is used up: once for a
        # backlog of any size, not once for each of its micro-batches
        if not self.found or _place(self.found[-1]) <= self.reached:
            self._list(self.reached)
        at = bisect_right(self.found, self.reached, key=_place)
        if new := self.found[at:at + self.most]:
            self.reached = _place(new[-1])
        return {"changed": self.reached[0], "path": self.reached[1]}

    def partitions(self, start: dict, end: dict):
        low, high = ((o["changed"], o["path"]) for o in (start, end))
        self.reached = max(self.reached, high)  # a restarted stream goes on behind its checkpoint
        if low < self.listed or not self.found or high > _place(self.found[-1]):
            self._list(low)
        first, behind = (bisect_right(self.found, o, key=_place) for o in (low, high))
        return self.landing.groups(self.found[first:behind])

    def read(self, partition: PageGroup):
        return self.landing.rows(partition)


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))

    def streamReader(self, schema) -> PagesStream:
        return PagesStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPages)


def page_records(pages: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """``ordinal, record`` of the source's rows; ``drop`` removes per-row keys."""
    record: Column = F.parse_json("record")
    if drop:
        record = drop_keys(record, drop)
    place = ordinal(F.col("page"), F.col("pos"), F.col("file"), landed=F.col("landed"))
    return pages.select(place.alias("ordinal"), record.alias("record"))
