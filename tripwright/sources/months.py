"""Months that a ZIP member's name stands for, and the comparison of two inventories."""

from __future__ import annotations

import re
from collections import Counter

from tripwright.sources.rental import SourceError

#: Fixed format: a name ends with a year (20xx, or 15 to 29 for 2015 to 2029), a separator or none and a
#: month; then nothing, a number of the part after "_", the other month of a range after "~" (years of
#: four digits with a separator) or one digit of the part (years of two digits without a separator).
_YEAR, _MONTH = r"20\d\d|1[5-9]|2\d", r"0[1-9]|1[0-2]"
_END = re.compile(rf"(?<!\d)({_YEAR})([._-]?)({_MONTH})(?:(_\d{{1,2}})|\s*~\s*({_MONTH})|([1-9]))?$")
_DATE = re.compile(rf"(?<!\d)(?:{_YEAR})[._-]?(?:{_MONTH})(?!\d)")


def months_of(name: str) -> list[str] | None:
    """Months of a CSV member in order, None for other files; names of doubt are an error."""
    stem, dot, kind = name.rpartition(".")
    if not dot or kind.lower() != "csv":
        return None
    stem = stem.rsplit("/", 1)[-1].rstrip()
    found = _END.search(stem)
    if not found:
        raise SourceError(f"{name}: no month")
    if _DATE.search(stem[: found.start()]):
        raise SourceError(f"{name}: more than one month")
    year, separator, month, _, last, part = found.groups()
    if (last and not (len(year) == 4 and separator)) or (part and not (len(year) == 2 and not separator)):
        raise SourceError(f"{name}: no clear month")
    year = year if len(year) == 4 else f"20{year}"
    if last is None:
        return [f"{year}-{month}"]
    if int(month) >= int(last):
        raise SourceError(f"{name}: no clear range of months")
    return [f"{year}-{k:02d}" for k in range(int(month), int(last) + 1)]


def compare_inventories(old: dict[str, list[tuple[int, str]]], new: dict[str, list[tuple[int, str]]]) -> dict[str, str]:
    """Month to NEW, UNCHANGED, REVISED or REMOVED, by the multiset of its members' (size, SHA-256)."""
    out = {}
    for month in sorted(old.keys() | new.keys()):
        if month not in old:
            out[month] = "NEW"
        elif month not in new:
            out[month] = "REMOVED"
        else:
            out[month] = "UNCHANGED" if Counter(old[month]) == Counter(new[month]) else "REVISED"
    return out
