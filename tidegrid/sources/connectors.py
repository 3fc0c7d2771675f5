"""Planning of downloads: which datasets give which days. Clients of remote services plug in here."""

from __future__ import annotations

import datetime as dt
import logging
import re
from abc import ABC, abstractmethod
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path
from typing import Protocol

from tidegrid.model import BBox, DateRange

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DownloadTask:
    dataset_id: str
    dataset_type: str
    dates: DateRange
    remote_path: str | None = None


def plan(request: DateRange, reprocessed: tuple[str, DateRange] | None, near_real_time: tuple[str, DateRange] | None) -> list[DownloadTask]:
    """Reprocessed data where there is any, then near-real-time data from the day after it."""
    tasks, start = [], request.start
    if reprocessed and (part := request.intersection(reprocessed[1])):
        tasks.append(DownloadTask(reprocessed[0], "rep", part))
        start = max(start, reprocessed[1].end + dt.timedelta(days=1))
    if near_real_time and start <= request.end and (part := DateRange(start, request.end).intersection(near_real_time[1])):
        tasks.append(DownloadTask(near_real_time[0], "nrt", part))
    return tasks


def last_published_month(today: dt.date) -> dt.date:
    """Last day of the last month that a monthly archive has: before the 10th that of two months ago."""
    first = today.replace(day=1)
    for _ in range(2 if today.day < 10 else 1):
        first = (first - dt.timedelta(days=1)).replace(day=1)
    return (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def archive_request(variables: Sequence[str], year: int, months: Sequence[int], days: Sequence[int], bbox: BBox) -> dict:
    return {
        "product_type": "reanalysis", "format": "grib", "variable": list(variables), "year": str(year), "month": [f"{m:02d}" for m in months], "day": [f"{d:02d}" for d in days],
        "time": [f"{h:02d}:00" for h in range(24)], "area": [bbox.ymax, bbox.xmin, bbox.ymin, bbox.xmax],
    }


class Connector(ABC):
    """A remote service. Only what talks to it is left to subclasses."""

    def __init__(self) -> None:
        self.available = lru_cache(maxsize=128)(self._available)

    @abstractmethod
    def _available(self, dataset_id: str) -> DateRange | None:
        """First and last day that the service has."""

    @abstractmethod
    def fetch(self, task: DownloadTask, target: str) -> list[str]:
        """Download a task; paths of its files."""

    def run(self, request: DateRange, rep: str | None, nrt: str | None, target: str, retries: int = 3) -> list[str]:
        spans = [(d, a) if d and (a := self.available(d)) else None for d in (rep, nrt)]
        paths: list[str] = []
        for task in plan(request, *spans):
            for attempt in range(retries):
                try:
                    paths += self.fetch(task, target)
                    break
                except OSError:
                    if attempt + 1 == retries:
                        raise
        return paths


def warn_if_reprocessed(key: str, stored_end: dt.date | None, offered_end: dt.date, has_near_real_time: bool = True) -> bool:
    """Warn that reprocessed data reach further than what is stored of them, where near-real-time data fill in."""
    ahead = has_near_real_time and stored_end is not None and offered_end > stored_end
    if ahead:
        log.warning("%s: reprocessed data now end on %s, not %s", key, offered_end, stored_end)
    return ahead


class Transport(Protocol):
    """What an archive of files needs of FTP, HTTP or a mounted folder."""

    def listing(self, folder: str) -> list[tuple[str, bool]]:
        """(path, is a folder) of what a folder holds."""

    def download(self, path: str, target: str) -> None: ...


class Archive(Connector):
    """A service that is a tree of files with days in their names (one group) or spans of days (two)."""

    def __init__(self, transport: Transport, pattern: str, workers: int = 2):
        super().__init__()
        self.transport, self.pattern, self.workers = transport, re.compile(pattern), workers
        if self.pattern.groups not in (1, 2):
            raise ValueError("the pattern needs one or two groups")

    def files(self, folder: str) -> list[str]:
        found: list[str] = []
        for path, is_folder in self.transport.listing(folder):
            found += self.files(path) if is_folder else [path]
        return sorted(found)

    def span(self, path: str) -> DateRange | None:
        """The days of a file by its name; None for other files."""
        if not (m := self.pattern.search(path.rsplit("/", 1)[-1])):
            return None
        days = [dt.datetime.strptime(g, "%Y%m%d").date() for g in m.groups()]
        return DateRange(days[0], days[-1])

    def _available(self, dataset_id: str) -> DateRange | None:
        spans = [s for f in self.files(dataset_id) if (s := self.span(f))]
        return DateRange(min(s.start for s in spans), max(s.end for s in spans)) if spans else None

    def fetch(self, task: DownloadTask, target: str) -> list[str]:
        """The task's files below target/rep or target/nrt; one that is there stays. Each is renamed once it is whole."""
        wanted = [f for f in self.files(task.dataset_id) if (s := self.span(f)) and s.overlaps(task.dates)]
        folder = Path(target) / task.dataset_type
        folder.mkdir(parents=True, exist_ok=True)

        def one(path: str) -> str:
            out = folder / path.rsplit("/", 1)[-1]
            if not out.exists():
                part = out.with_name(out.name + ".part")
                self.transport.download(path, str(part))
                part.replace(out)
            return str(out)

        with ThreadPoolExecutor(self.workers) as pool:
            return list(pool.map(one, wanted))


@dataclass
class Connectors:
    """Connectors by name."""

    known: dict[str, type[Connector]] = field(default_factory=dict)

    def register(self, name: str, kind: type[Connector]) -> None:
        self.known[name] = kind

    def make(self, name: str, *args, **kwargs) -> Connector:
        if name not in self.known:
            raise ValueError(f"no connector {name}; there are {', '.join(sorted(self.known)) or 'none'}")
        return self.known[name](*args, **kwargs)
