"""Sizes, times and fingerprints of the command line."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWEST, HIGHEST = -(2**63), 2**63 - 1
_POWERS = {"": 0, "K": 1, "M": 2, "G": 3}


def parse_byte_size(text: str) -> int:
    """``450MB``, ``1G``, ``200mb``, ``1024B`` or a bare number; all units are binary."""
    m = re.fullmatch(r"\s*(\d+)\s*([KMG]?)(?:I?B)?\s*", text.upper())
    if not m or re.search(r"\d\s*IB", text.upper()):
        raise ValueError(f"not a size in bytes: {text!r}")
    return int(m[1]) * 1024 ** _POWERS[m[2]]


def parse_time(text: str) -> int:
    """Nanoseconds since 1970 of an RFC 3339 time, with up to nine decimals."""
    m = re.fullmatch(r"(\d{4}-\d\d-\d\d)[Tt ](\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?([Zz]|[+-]\d\d:\d\d)", text.strip())
    if not m:
        raise ValueError(f"not a time: {text!r}")
    zone = "+00:00" if m[4] in "Zz" else m[4]
    whole = datetime.fromisoformat(f"{m[1]}T{m[2]}{zone}") - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (whole.days * 86400 + whole.seconds) * 10**9 + int((m[3] or "").ljust(9, "0"))


def show_time(ns: int) -> str:
    seconds, rest = divmod(ns, 10**9)
    fraction = f".{rest:09d}".rstrip("0").rstrip(".")
    day = datetime(1970, 1, 1, tzinfo=timezone.utc).toordinal() + seconds // 86400
    clock = seconds % 86400
    return f"{datetime.fromordinal(day):%Y-%m-%d}T{clock // 3600:02d}:{clock % 3600 // 60:02d}:{clock % 60:02d}{fraction}Z ({ns})"


def floor_micros(ns: Column) -> Column:
    """Whole microseconds, rounded down before 1970 too."""
    return F.floor(ns.cast("decimal(20,0)") / F.lit(1000).cast("decimal(5,0)")).cast("bigint")


#: Factors from nanoseconds to the precisions a target may ask for.
PRECISIONS = {"ns": 1, "us": 10**3, "ms": 10**6, "s": 10**9}


def parse_rename(pairs: list[str]) -> dict[str, str]:
    """``old=new`` pairs, split at the first "="."""
    out = {}
    for p in pairs:
        old, found, new = p.partition("=")
        if not found or not old or not new:
            raise ValueError(f"not old=new: {p!r}")
        out[old] = new
    return out


def fingerprint(chunk_bytes: int, start: int, end: int, precision: str, renames: dict[str, str], files: list[tuple[str, int, int]] = ()) -> dict[str, str]:
    """All that decides where chunks are cut, by name, with the files read, so that a resumed run can tell a change."""
    stamps = hashlib.sha256("\n".join(f"{name}:{size}:{changed}" for name, size, changed in sorted(files)).encode()).hexdigest()
    renamed = ",".join(f"{a}={b}" for a, b in sorted(renames.items()))
    return {"chunk size": str(chunk_bytes), "start": str(start), "end": str(end), "precision": precision, "renames": renamed, "input files": stamps}
