"""strftime formats as Java date patterns.

Numbers may lack leading zeros where no digit or number stands beside them. Two-digit years up to 69 are of this century's
first half, from 70 on of the last (as POSIX has it). Names of days are skipped: the rest fixes the date.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.errors import EvalError

# Directives that stand for others, and the pattern of each one (padded, and not padded).
_LONG = {"F": "%Y-%m-%d", "D": "%m/%d/%y", "T": "%H:%M:%S", "R": "%H:%M", "x": "%m/%d/%y", "v": "%e-%b-%Y"}
_NUMBERS = {"Y": ("yyyy", "yyyy"), "m": ("MM", "M"), "d": ("dd", "d"), "e": ("dd", "d"), "y": ("yy", "yy"), "j": ("DDD", "D"), "H": ("HH", "H"), "I": ("hh", "h"), "M": ("mm", "m"), "S": ("ss", "s")}
_NAMES = {"b": "MMM", "h": "MMM", "B": "MMMM", "p": "a"}
_DAYS = {"a": "(?i)(Mon|Tue|Wed|Thu|Fri|Sat|Sun)", "A": "(?i)(Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|Mon|Tue|Wed|Thu|Fri|Sat|Sun)"}


@dataclass(frozen=True)
class DateFormat:
    """A Java pattern, what to require of the text and strip from it beforehand, and whether years have two digits."""

    pattern: str
    day: tuple[str, str] | None
    short_year: bool

    def parse(self, text: Column) -> Column:
        """The date, or null where the text does not fit as a whole."""
        if self.day:
            before, name = self.day
            shape = f"^({before})({name})"
            text = F.when(text.rlike(shape), F.regexp_replace(text, shape, "$1"))
        got = F.try_to_date(text, self.pattern)
        return F.when(F.year(got) >= 2070, F.add_months(got, -1200)).otherwise(got) if self.short_year else got


def _split(fmt: str) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    at = 0
    while at < len(fmt):
        if fmt[at] != "%":
            out.append(("text", fmt[at]))
            at += 1
            continue
        m = re.match(r"%([-0_]?)(.)", fmt[at:], re.S)
        if not m:
            raise EvalError(f"date format `{fmt}` ends in a single %")
        flag, d = m[1], m[2]
        at += m.end()
        if d == "%":
            out.append(("text", "%"))
        elif d in ("n", "t"):
            out.append(("text", "\n" if d == "n" else "\t"))
        elif d in _LONG:
            out += _split(_LONG[d])
        elif d in _NUMBERS:
            out.append(("loose" if flag == "-" else "number", d))
        elif d in _NAMES:
            out.append(("name", d))
        elif d in _DAYS:
            out.append(("day", d))
        else:
            raise EvalError(f"unsupported date directive `%{d}` in `{fmt}`")
    return out


def date_format(fmt: str) -> DateFormat:
    """Translate a strftime format; EvalError for directives that dates have no use for."""
    parts = _split(fmt)
    days = [i for i, (kind, _) in enumerate(parts) if kind == "day"]
    day = None
    if days:
        if len(days) > 1 or any(kind != "text" for kind, _ in parts[: days[0]]):
            raise EvalError(f"a day's name must come first in `{fmt}`")
        day = (re.escape("".join(x for _, x in parts[: days[0]])), _DAYS[parts[days[0]][1]])
        parts = [p for p in parts if p[0] != "day"]
    out: list[str] = []
    literal = ""
    for i, (kind, x) in enumerate([*parts, ("end", "")]):
        if kind == "text":
            literal += x
            continue
        if literal:
            out.append("'" + literal.replace("'", "''") + "'" if any(c.isalpha() or c in "[]{}#'" for c in literal) else literal)
            literal = ""
        if kind in ("number", "loose"):
            beside = [parts[j] for j in (i - 1, i + 1) if 0 <= j < len(parts)]
            tight = any(k in ("number", "loose") or (k == "text" and c.isdigit()) for k, c in beside)
            out.append(_NUMBERS[x][0 if tight else 1])
        elif kind == "name":
            out.append(_NAMES[x])
    return DateFormat("".join(out), day, any(k in ("number", "loose") and x == "y" for k, x in parts))
