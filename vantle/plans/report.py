"""Step logs: sections, values and seconds of a run, as text and JSON, and row counts by observation."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.tables import write_json


class StepLog:
    """Collects what a run did. Counts come from observations, so they cost no extra pass."""

    def __init__(self, path: str | None = None):
        self.path, self.entries, self.seconds, self.io = path, [], {}, {}
        self._observed: dict[str, Observation] = {}
        self._began = time.monotonic()
        if path:
            os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
            open(path, "w").close()

    def _line(self, text: str) -> None:
        if self.path:
            with open(self.path, "a", encoding="utf-8") as file:
                file.write(text + "\n")

    def section(self, title: str) -> None:
        self.entries.append({"section": title})
        self._line(f"\n== {title}")

    def value(self, name: str, value: object) -> None:
        self.entries.append({name: value})
        self._line(f"{name}: {json.dumps(value, default=str)}")

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        self.section(name)
        began = time.monotonic()
        yield
        self.seconds[name] = round(time.monotonic() - began, 3)
        self.value("seconds", self.seconds[name])

    def add_read(self, label: str, n: int = 1) -> None:
        self.io.setdefault("read", {}).setdefault(label, 0)
        self.io["read"][label] += n

    def add_write(self, label: str, n: int = 1) -> None:
        self.io.setdefault("write", {}).setdefault(label, 0)
        self.io["write"][label] += n

    def counted(self, df: DataFrame, name: str) -> DataFrame:
        """df, counting its rows while some action computes it."""
        self._observed[name] = Observation(name)
        return df.observe(self._observed[name], F.count(F.lit(1)).alias("rows"))

    def summary(self) -> dict:
        """Everything so far; asks observations of computed frames only."""
        rows = {n: o.get["rows"] for n, o in self._observed.items()}
        io = {f"total_{k}_ops": sum(v.values()) for k, v in self.io.items()} | {"by_label": self.io}
        return {"total_pipeline_runtime": round(time.monotonic() - self._began, 3), "seconds": self.seconds, "rows": rows, "io": io, "entries": self.entries}

    def write_summary(self, path: str, **paths: str) -> None:
        write_json(path, self.summary() | {"paths": paths})
