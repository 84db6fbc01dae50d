"""Zone transition tables: when each zone's offset changes, from the installed zone database.

A zone's table is read once per worker from the database's own file, from its first transition
(local mean time before that) to the last one that is listed, and from there to ``LAST_YEAR`` by the
rule that the file closes with. It is searched for whole batches. ``VERSION`` names the release
of the database that the tables come from, so that a result can state it.
"""

from __future__ import annotations

import re
import struct
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from importlib import resources
from pathlib import Path
from zoneinfo import TZPATH, ZoneInfo, ZoneInfoNotFoundError

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Year up to which a file's closing rule is followed; later, the last offset holds.
LAST_YEAR = 2101
_STEP_S = 7 * 86_400


def database_version() -> str:
    """Release of the zone database, such as 2024a, or 'unknown'."""
    for folder in TZPATH:
        p = Path(folder, "tzdata.zi")
        if p.exists():
            with p.open() as f:
                if m := re.search(r"version (\S+)", f.readline()):
                    return m[1]
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


VERSION = database_version()


def _file_of(zone: str) -> bytes | None:
    """The database's file of a zone, from the system or the installed package."""
    for folder in TZPATH:
        p = Path(folder, zone)
        if p.is_file():
            return p.read_bytes()
    try:
        return resources.files("tzdata.zoneinfo").joinpath(*zone.split("/")).read_bytes()
    except (ModuleNotFoundError, OSError):
        return None


def listed(data: bytes) -> tuple[list[int], list[tuple[int, str]]]:
    """(seconds of the listed transitions, (offset, abbreviation) before the first and from each on) of a TZif file (RFC 8536)."""

    def block(at: int, width: int) -> tuple[int, list[int], list[tuple[int, str]]]:
        utc, std, _, times, types, chars = struct.unpack_from(">6I", data, at + 20)
        leap = struct.unpack_from(">I", data, at + 28)[0]
        at += 44
        moments = list(struct.unpack_from(f">{times}{'q' if width == 8 else 'i'}", data, at))
        at += times * width
        kinds = data[at : at + times]
        at += times
        names = data[at + 6 * types : at + 6 * types + chars]
        found = []
        for k in range(types):
            offset, _, first = struct.unpack_from(">iBB", data, at + 6 * k)
            found.append((offset, names[first : names.index(0, first)].decode("ascii")))
        return at + 6 * types + chars + leap * (width + 4) + std + utc, moments, [found[0], *(found[k] for k in kinds)]

    end, *rest = block(0, 4)
    if data[4:5] >= b"2":
        _, *rest = block(end, 8)
    return rest[0], rest[1]


@lru_cache(maxsize=700)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray, dict[str, int]] | None:
    """(local second from which each offset holds, offsets in seconds, offset of each abbreviation), or None for an unknown zone.

    A local time that occurs twice means its first occurrence; one that is skipped keeps the
    offset from before the gap. An abbreviation that the zone used with several offsets means
    the latest.
    """
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_+-]*(/[A-Za-z0-9_+-]+)*", zone):
        return None
    try:
        z = ZoneInfo(zone)
        data = _file_of(zone)
    except (ZoneInfoNotFoundError, ValueError, OSError):
        return None
    if not data or data[:4] != b"TZif":
        return None
    moments, states = listed(data)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def at(second: int) -> tuple[int, str]:
        d = (epoch + timedelta(seconds=second)).astimezone(z)
        return int(d.utcoffset().total_seconds()), d.tzname() or ""

    # beyond the listed transitions the zone goes by its closing rule
    now, second = states[-1], max(moments[-1] if moments else 0, 0)
    hi = int((datetime(LAST_YEAR, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
    for second in range(second + _STEP_S, hi, _STEP_S):
        later = at(second)
        if later == now:
            continue
        a, b = second - _STEP_S, second
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if at(mid) == now else (a, mid)
        moments.append(b)
        states.append(later)
        now = later
    starts, offsets, names = [-(2**62)], [states[0][0]], {states[0][1].upper(): states[0][0]}
    for moment, before, after in zip(moments, states, states[1:]):
        starts.append(moment + max(before[0], after[0]))
        offsets.append(after[0])
        names[after[1].upper()] = after[0]
    return np.array(starts, np.int64), np.array(offsets, np.int64), names


def utc_offsets(local: np.ndarray, zone: str, abbreviation: str | None) -> np.ndarray | None:
    """Offsets in seconds for local seconds in a zone, or the fixed offset of one of its abbreviations; None if unknown."""
    t = transitions(zone)
    if t is None:
        return None
    if abbreviation:
        fixed = t[2].get(abbreviation.upper())
        return None if fixed is None else np.full(len(local), fixed, np.int64)
    return t[1][np.searchsorted(t[0], local, "right") - 1]


@F.arrow_udf(T.LongType())
def zone_offset(local: pa.Array, zone: pa.Array, abbreviation: pa.Array) -> pa.Array:
    """Offset from UTC in seconds; null for null or unknown zones and abbreviations."""
    n = len(local)
    seconds = local.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    z = zone.dictionary_encode() if not pa.types.is_dictionary(zone.type) else zone
    a = abbreviation.dictionary_encode()
    zi, ai = z.indices.fill_null(-1).to_numpy(zero_copy_only=False), a.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    zs, as_ = z.dictionary.to_pylist(), a.dictionary.to_pylist()
    out, ok = np.zeros(n, np.int64), np.zeros(n, bool)
    for code in np.unique(zi.astype(np.int64) * (len(as_) + 1) + ai + 1):
        zk, ak = int(code) // (len(as_) + 1), int(code) % (len(as_) + 1) - 1
        if zk < 0 or zk >= len(zs):
            continue
        pick = (zi == zk) & (ai == ak)
        got = utc_offsets(seconds[pick], zs[zk], as_[ak] if ak >= 0 else None)
        if got is not None:
            out[pick], ok[pick] = got, True
    ok &= local.is_valid().to_numpy(zero_copy_only=False)
    return pa.array(out, mask=~ok)


def offset_of(local_seconds: Column, zone: Column, abbreviation: Column) -> Column:
    """Column form of :data:`zone_offset`."""
    return zone_offset(local_seconds, zone, abbreviation)
