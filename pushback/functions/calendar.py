"""US federal holidays (observed dates) built by rule for any year range.

Fixed-date holidays falling on Saturday are observed the Friday before, on
Sunday the Monday after. The list is bounded (at most 11 per year), so it is
inlined as a literal set instead of joined.
"""

from __future__ import annotations

import datetime as dt

# fixed values: (name, month, day) observed on the nearest weekday
FIXED_HOLIDAYS = [("new_year", 1, 1), ("juneteenth", 6, 19), ("independence", 7, 4),
                  ("veterans", 11, 11), ("christmas", 12, 25)]
# fixed values: (name, month, weekday Mon=0, n-th; -1 = last)
FLOATING_HOLIDAYS = [("mlk", 1, 0, 3), ("presidents", 2, 0, 3), ("memorial", 5, 0, -1),
                     ("labor", 9, 0, 1), ("columbus", 10, 0, 2), ("thanksgiving", 11, 3, 4)]
# fixed values: first year a holiday is on the calendar
FIRST_YEAR = {"mlk": 1986, "juneteenth": 2021}


def _nearest_weekday(d: dt.date) -> dt.date:
    if d.weekday() == 5:
        return d - dt.timedelta(days=1)
    if d.weekday() == 6:
        return d + dt.timedelta(days=1)
    return d


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> dt.date:
    if n > 0:
        first = dt.date(year, month, 1)
        return first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    last = nxt - dt.timedelta(days=1)
    return last - dt.timedelta(days=(last.weekday() - weekday) % 7)


def federal_holidays(first_year: int, last_year: int) -> list[dt.date]:
    """Observed federal holiday dates of the years in [first_year, last_year]."""
    out = []
    for y in range(first_year, last_year + 1):
        for name, m, d in FIXED_HOLIDAYS:
            if y >= FIRST_YEAR.get(name, 0):
                out.append(_nearest_weekday(dt.date(y, m, d)))
        for name, m, wd, n in FLOATING_HOLIDAYS:
            if y >= FIRST_YEAR.get(name, 0):
                out.append(_nth_weekday(y, m, wd, n))
    return sorted(out)
