"""Which shards a folder has.  Runs on the driver over names and sizes only."""

from __future__ import annotations

import re
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

BUCKET_ID = re.compile(r"[0-9a-f]{16}")
UNKNOWN, V1, V2 = 0, 1, 2


class Shard(NamedTuple):
    source_id: str
    database: str
    retention: str
    shard_id: str
    dir: str
    tsm_files: list[str]
    wal_files: list[str]


SCHEMA = "source_id string, database string, retention string, shard_id string, dir string, tsm_files array<string>, wal_files array<string>"


def _folders(path: Path) -> list[Path]:
    return sorted((p for p in path.iterdir() if p.is_dir()), key=lambda p: p.name) if path.is_dir() else []


def _has_v2(path: Path) -> bool:
    return any(BUCKET_ID.fullmatch(d.name) and (d / "autogen").is_dir() for d in _folders(path))


def _has_v1(path: Path) -> bool:
    return any(r.name != "_series" for d in _folders(path) for r in _folders(d))


def detect(path: str) -> tuple[str, int]:
    """(folder of the databases, layout): the newer layout is tried first; an unknown path comes back as it is."""
    root = Path(path)
    for layout, test, places in ((V2, _has_v2, (root / "engine" / "data", root / "data", root)), (V1, _has_v1, (root / "data", root))):
        for p in places:
            if test(p):
                return str(p), layout
    return path, UNKNOWN


def files(folder: Path, suffix: str) -> list[Path]:
    return sorted((p for p in folder.iterdir() if p.is_file() and p.name.endswith(suffix)), key=lambda p: p.name) if folder.is_dir() else []


def shards(data_dir: str, wal_dir: str | None = None, databases: list[str] = (), internal: bool = False) -> list[Shard]:
    """Shards with a column file or a log that isn't empty, from both folders, by database, retention and shard as strings."""
    found: dict[tuple[str, str, str], tuple[list[str], list[str]]] = {}
    for top, suffix, at in ((data_dir, ".tsm", 0), (wal_dir, ".wal", 1)):
        if not top:
            continue
        for database in _folders(Path(top)):
            if database.name == "_internal" and not internal or databases and database.name not in databases:
                continue
            for retention in _folders(database):
                if retention.name == "_series":
                    continue
                for shard in _folders(retention):
                    own = found.setdefault((database.name, retention.name, shard.name), ([], []))
                    own[at].extend(str(p) for p in files(shard, suffix))
    out = []
    for (database, retention, shard), (tsm, wal) in sorted(found.items()):
        if tsm or any(Path(w).stat().st_size > 0 for w in wal):
            out.append(Shard(database, database, retention, shard, str(Path(data_dir) / database / retention / shard), tsm, wal))
    return out


def shard_table(spark: SparkSession, found: list[Shard]) -> DataFrame:
    return spark.createDataFrame(found, SCHEMA)


def file_stamps(found: list[Shard]) -> list[tuple[str, int, int]]:
    """(name, size, time of change) of all files, for the fingerprint."""
    return [(f, Path(f).stat().st_size, Path(f).stat().st_mtime_ns) for s in found for f in (*s.tsm_files, *s.wal_files)]
