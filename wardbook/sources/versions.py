"""Tables whose months are loaded one by one and switched to all at once.

A load writes its rows to a folder of its own, ``load=<id>``, which no reader looks at yet. A
version is a small file that names the load of every month; the one with the highest number
counts. Publishing writes the next such file under another name and renames it, so whatever
cuts a run off leaves the old version or the new one. A month that is loaded again is replaced
whole, also in areas that get no rows any more: its older rows are no longer named.

Rows that no version names are deleted after the switch, and those of runs that were cut off
after the next one. Only one run may load a table at a time. Beside the rows, a load may write
other tables by month, such as digests and partial aggregates; they are switched along with them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD = "load"
#: Folders that plain readers of the table pass over.
VERSIONS, ASIDE = "_versions", "_aside"


@dataclass(frozen=True)
class Version:
    """The load of every month; number 0 is the table before any load."""

    number: int = 0
    months: Mapping[str, str] = field(default_factory=dict)

    def after(self, load: str, months: Sequence[str], keep: bool) -> Version:
        """The next version, with these months from ``load`` and, if ``keep``, all others as they are."""
        others = self.months if keep else {}
        return Version(self.number + 1, {**others, **dict.fromkeys(months, load)})


def new_load() -> str:
    return uuid.uuid4().hex


class VersionedTable:
    """A table at ``path``, partitioned by load and then by the columns ``by``, of which one is the month."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], month: str = "year_month"):
        self.spark, self.path, self.by, self.month = spark, path.rstrip("/"), list(by), month
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> Version:
        """What readers see. The file is read on the driver: it has one entry per month."""
        numbers = [int(n.removesuffix(".json")) for n in self._names(f"{self.path}/{VERSIONS}") if n.endswith(".json")]
        if not numbers:
            return Version()
        row = self.spark.read.text(self._file_of(max(numbers)), wholetext=True).first()
        return Version(max(numbers), json.loads(row["value"]))

    def folder(self, load: str, name: str | None = None) -> str:
        """Where ``load`` writes its rows, or the table ``name`` beside them."""
        return f"{self.path}/{LOAD}={load}" if name is None else f"{self.path}/{ASIDE}/{name}/{LOAD}={load}"

    def read(self, version: Version, schema: str, name: str | None = None, months: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its months; other months' partitions are not opened."""
        loads: dict[str, list[str]] = {}
        for month, load in sorted(version.months.items()):
            if months is None or month in set(months):
                loads.setdefault(load, []).append(month)
        if not loads:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, {LOAD} string").option(
            "basePath", self.path if name is None else f"{self.path}/{ASIDE}/{name}"
        ).parquet(*[self.folder(load, name) for load in loads])
        wanted: Column = F.lit(False)
        for load, of_load in loads.items():
            wanted = wanted | ((F.col(LOAD) == load) & F.col(self.month).isin(of_load))
        return rows.filter(wanted).drop(LOAD)

    def publish(self, version: Version) -> None:
        """Make ``version`` what readers see. Fails if another run has published since it was read."""
        target, staged = self._path(self._file_of(version.number)), self._path(f"{self.path}/{VERSIONS}/.{uuid.uuid4().hex}")
        out = self._files.create(staged, False)
        out.write(bytearray(json.dumps(version.months).encode()))
        out.close()
        if self._files.exists(target) or not self._files.rename(staged, target):
            self._files.delete(staged, False)
            raise FileExistsError(f"version {version.number} of {self.path} is there already")

    def sweep(self) -> None:
        """Delete what the current version does not name, and older versions."""
        version = self.current()
        for number in (int(n.removesuffix(".json")) for n in self._names(f"{self.path}/{VERSIONS}") if n.endswith(".json")):
            if number < version.number:
                self._delete(self._file_of(number))
        named = set(version.months.items())
        roots = [self.path, *(f"{self.path}/{ASIDE}/{n}" for n in self._names(f"{self.path}/{ASIDE}"))]
        for root in roots:
            for load in (n for n in self._names(root) if n.startswith(f"{LOAD}=")):
                if load.removeprefix(f"{LOAD}=") not in version.months.values():
                    self._delete(f"{root}/{load}")
        for load in set(version.months.values()):
            for folder in self._partitions(self.folder(load)):
                month = self._path(folder).getName() if self.by[-1] == self.month else ""
                if month and (month.removeprefix(f"{self.month}="), load) not in named:
                    self._delete(folder)

    def _partitions(self, folder: str) -> list[str]:
        found = [folder]
        for column in self.by:
            found = [f"{at}/{n}" for at in found for n in self._names(at) if n.startswith(f"{column}=")]
        return found

    def _file_of(self, number: int) -> str:
        return f"{self.path}/{VERSIONS}/{number:010d}.json"

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []

    def _delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)
