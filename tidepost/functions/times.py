"""Times from text: one pattern takes a text apart, tables and ``make_timestamp`` put it together."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of months and weekdays with their usual short forms, and the offsets of zone
# names in minutes.
MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|"
    "oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
WEEKDAYS = "mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun"
ZONES = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120,
    "eet": 120, "eest": 180, "msk": 180, "pkt": 300, "ist": 330, "ict": 420, "wib": 420,
    "wita": 480, "wit": 540, "sgt": 480, "hkt": 480, "awst": 480, "jst": 540, "kst": 540,
    "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480,
    "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}

_MARK = "\x01"
_PARTS = ["year", "month", "day", "hour", "minute", "second", "half", "sign", "away", "past", "zone", "turn"]


def _time_pattern() -> tuple[str, str]:
    """The pattern of all forms, and the replacement that lists the parts of the one that matched."""
    groups: dict[str, list[str]] = {p: [] for p in _PARTS}

    def part(name: str, what: str) -> str:
        groups[name].append(f"{name}{len(groups[name])}")
        return f"(?<{groups[name][-1]}>{what})"

    def clock() -> str:
        second, half = part("second", r"\d{1,2}(?:[.,]\d{1,9})?"), part("half", r"[ap]\.?m\.?")
        hour, minute = part("hour", r"\d{1,2}"), part("minute", r"\d{2}")
        return rf"{hour}:{minute}(?::{second})?(?:\s*{half})?"

    def zone() -> str:
        shift = rf"(?:utc|gmt)?{part('sign', '[+-]')}{part('away', r'\d{1,2}')}(?::?{part('past', r'\d{2}')})?"
        return rf"(?:\s*(?:{shift}|{part('zone', '|'.join(ZONES))})(?:\s*\([a-z ]+\))?)?"

    def date(*order: str, named: bool = False) -> dict[str, str]:
        what = {"year": r"\d{4}", "month": rf"(?:{MONTHS})\.?" if named else r"\d{1,2}"}
        return {name: part(name, what.get(name, r"\d{1,2}")) for name in order}

    iso, numbers = date("year", "month", "day"), date("month", "day", "year")
    british = date("day", "month", "year", named=True)
    american = date("month", "day", "year", named=True)
    posted = date("month", "day", "year", named=True)
    ordinal = "(?:st|nd|rd|th)?"
    dates = "|".join(
        [
            rf"{iso['year']}(?<s0>[-/.]){iso['month']}\k<s0>{iso['day']}",
            rf"{british['day']}{ordinal}[\s-]*{british['month']},?[\s-]*{british['year']}",
            rf"{american['month']}\s*{american['day']}{ordinal},?\s+{american['year']}",
            rf"{numbers['month']}{part('turn', '[-/]')}{numbers['day']}\k<turn0>{numbers['year']}",
        ]
    )
    plain = rf"(?:{dates})(?:(?:\s*t\s*|,?\s+(?:at\s+)?){clock()}{zone()})?"
    feed = rf"{posted['month']}\s+{posted['day']}\s+{clock()}{zone()}\s+{posted['year']}"
    two = {name: part(name, r"\d{2}") for name in ("month", "day", "hour", "minute")}
    packed = (
        rf"{part('year', r'\d{4}')}{two['month']}{two['day']}(?:[t\s]?{two['hour']}{two['minute']}"
        rf"(?:{part('second', r'\d{2}(?:[.,]\d{1,9})?')})?{zone()})?"
    )
    weekday = rf"(?:(?:{WEEKDAYS})(?:day)?\.?(?:\s*,\s*|\s+))?"
    marked = _MARK.join("".join(f"${{{g}}}" for g in groups[p]) for p in _PARTS)
    return rf"(?i)^\s*{weekday}(?:{plain}|{feed}|{packed})\s*$", _MARK + marked


PATTERN, _TAKEN = _time_pattern()


def _put_together(parts: Column) -> Column:
    """Timestamp of the parts that the pattern has found; without parts it is null."""
    part = {name: F.get(parts, F.lit(i + 1)) for i, name in enumerate(_PARTS)}
    number = {name: part[name].try_cast("int") for name in _PARTS}
    short = [m[:3] for m in MONTHS.split("|")]
    named = F.array_position(F.array(*[F.lit(m) for m in short]), F.lower(F.substring(part["month"], 1, 3)))
    first, second = F.coalesce(number["month"], named.cast("int")), number["day"]
    swapped = (first > 12) & (part["turn"] != "")
    half = F.lower(F.substring(part["half"], 1, 1))
    twelve = F.when(
        number["hour"].between(1, 12), number["hour"] % 12 + F.when(half == "p", 12).otherwise(0)
    )
    hour = F.when(half == "", F.coalesce(number["hour"], F.lit(0))).otherwise(twelve)
    seconds = F.coalesce(
        F.substring(F.translate(part["second"], ",", "."), 1, 9).try_cast("decimal(8,6)"),
        F.lit(0).cast("decimal(8,6)"),
    )
    away = number["away"] * 60 + F.coalesce(number["past"], F.lit(0))
    fits = (number["away"] <= 14) & F.coalesce(number["past"] < 60, F.lit(True))
    table = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    shift = (
        F.when(part["sign"] == "+", F.when(fits, away))
        .when(part["sign"] == "-", F.when(fits, -away))
        .otherwise(F.try_element_at(table, F.lower(part["zone"])))
    )
    fields = {
        "years": number["year"],
        "months": F.when(swapped, second).otherwise(first),
        "days": F.when(swapped, first).otherwise(second),
        "hours": hour,
        "mins": F.coalesce(number["minute"], F.lit(0)),
        "secs": seconds,
    }
    local = F.try_make_timestamp(**fields, timezone=F.current_timezone())
    zoned = F.timestamp_add("MINUTE", -shift, F.try_make_timestamp(**fields, timezone=F.lit("UTC")))
    has_zone = F.length(F.concat(part["sign"], part["zone"])) > 0
    return F.when(F.size(parts) > len(_PARTS), F.when(has_zone, zoned).otherwise(local))


def parse_time(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Timestamp from text, bad text gives null; text without a zone is in the session zone (UTC).

    ``formats`` (Spark patterns, a weekday in front is skipped) are tried first, then ISO text, then
    all forms of one pattern: year, month, day with ``-``, ``/``, ``.`` or nothing between them; day, name
    of month, year; name of month, day, year; month, day, year in numbers (day first where the first
    is above 12); each with or without a time of day, of 24 hours or with am and pm, and a zone, an
    offset or a name in ``ZONES``; and name of month, day, time, zone, year. A weekday may come first.
    """
    text = F.col(c) if isinstance(c, str) else c
    text = F.trim(text.cast("string"))
    bare = F.regexp_replace(text, rf"(?i)^\s*(?:{WEEKDAYS})(?:day)?\.?(?:\s*,\s*|\s+)", "")
    own = [F.try_to_timestamp(bare, F.lit(re.sub(r"^E+,? *", "", f))) for f in formats]
    iso = F.when(F.substring(text, 5, 1).isin("-", ""), text.try_cast("timestamp"))
    # the text is taken apart once: its parts are the argument of a function of one element
    taken = F.array(F.split(F.regexp_replace(text, PATTERN, _TAKEN), _MARK))
    parts = F.get(F.transform(taken, _put_together), F.lit(0))
    return F.coalesce(*own, iso, parts)


def is_lost(text: Column | str, value: Column | str) -> Column:
    """True where a text that isn't blank has given no value."""
    text = F.col(text) if isinstance(text, str) else text
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() & F.coalesce(F.trim(text.cast("string")) != "", F.lit(False))
