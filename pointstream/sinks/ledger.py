"""What is delivered: a folder to which rows are only ever added.

``settings.json`` has the first run's settings, by name.  ``acks`` has a row for each chunk that the target took, and
``ends`` one for each shard that is through; a task that delivers adds to files of its own and puts each row on disk
before it goes on.  The folder must be one that the driver and all executors see.  What the rows mean is said by the
joins of ``operators.resume``, which are their only reader.

A change of settings or input files would cut chunks elsewhere, so a ledger refuses other settings."""

from __future__ import annotations

import json
import os
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators import resume

ACKS, ENDS = "acks", "ends"
SCHEMAS = {ACKS: "source_id string, shard_id string, seq int, rows long, bytes long, at double", ENDS: "source_id string, shard_id string, chunks int, at double"}


class Changed(RuntimeError):
    """The ledger belongs to a run with other settings or files."""


class Writer:
    """Adds rows from one task, or from the driver."""

    def __init__(self, folder: str):
        self.folder, self.name, self.open = folder, uuid.uuid4().hex, {}

    def add(self, table: str, **row) -> None:
        """On disk when this returns."""
        if table not in self.open:
            self.open[table] = open(Path(self.folder, table, f"{self.name}.json"), "a")
        f = self.open[table]
        f.write(json.dumps(row | {"at": time.time()}) + "\n")
        f.flush()
        os.fsync(f.fileno())

    def close(self) -> None:
        for f in self.open.values():
            f.close()


class Ledger:
    def __init__(self, folder: str):
        self.folder = folder
        for table in SCHEMAS:
            Path(folder, table).mkdir(parents=True, exist_ok=True)

    def check(self, settings: dict[str, str]) -> None:
        """The first run's settings stay."""
        place = Path(self.folder, "settings.json")
        try:
            with place.open("x") as f:
                json.dump(settings, f)
        except FileExistsError:
            kept = json.loads(place.read_text())
            if differ := sorted(k for k in kept.keys() | settings.keys() if kept.get(k) != settings.get(k)):
                raise Changed(f"the ledger was begun with other settings: {', '.join(differ)}") from None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """Rows of a table; a line cut short by a crash is left out."""
        rows = spark.read.schema(f"{SCHEMAS[name]}, broken string").option("columnNameOfCorruptRecord", "broken").json(f"file://{os.path.abspath(self.folder)}/{name}")
        return rows.where("broken is null").drop("broken")

    def acks(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, ACKS)

    def ends(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, ENDS)

    def summary(self, spark: SparkSession) -> tuple[int, int, int]:
        """(shards begun, shards through, rows)."""
        return tuple(resume.summary(self.acks(spark), self.ends(spark).select(*resume.LEDGER_KEY).distinct()).first())
