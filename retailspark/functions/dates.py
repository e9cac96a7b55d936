"""Lenient timestamp parsing and year repair, all on TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARLIEST_YEAR = 1900
LATEST_YEAR = 2025
# Month and weekday names as date texts have them, whole or shortened.
MONTHS = (
    "jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?",
    "sep(?:t|tember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?",
)
WEEKDAYS = "(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:r|rs)?|fri|sat(?:ur)?|sun)(?:day)?"

_SEP = r"[ ,./-]*"


# What the readings below leave as it is: by far the most common form, which need not go through them.
ISO = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?)?\z"
HALF_DAY = r"(?i)^(.*[ ,])([0-9]{1,2})((?::[0-9]{2}){0,2}(?:\.[0-9]{1,9})?) *([ap])\.?m\.?$"


def _by_24_hours(text: Column) -> Column:
    """A text that ends in am or pm with its hour as 24 hours have it."""
    front, hour, rest, half = (F.regexp_extract(text, HALF_DAY, i) for i in range(1, 5))
    hour = hour.try_cast("int") % 12 + F.when(F.lower(half) == "p", 12).otherwise(0)
    return F.concat(front, F.lpad(hour.cast("string"), 2, "0"), F.when(rest == "", ":00").otherwise(rest))


def _with_names(text: Column) -> Column:
    """Year, month and day in figures, of a text in lower case with the month's name: day first, month first or year
    first, or no day, which is the first of the month then. Any other text stays as it is."""
    t = F.regexp_replace(text, rf"^{WEEKDAYS}\.?,? +", "")
    t = F.regexp_replace(t, r"(?<=[0-9])(?:st|nd|rd|th)\b", "")
    # One match finds every month; its first three letters become figures without another.
    months = "|".join(f"({name[:3]}){name[3:]}" for name in MONTHS)
    t = F.regexp_replace(t, rf"(?<![a-z])(?:{months})(?![a-z])\.?", f"#{''.join(f'${i}' for i in range(1, 13))}#")
    for number, name in enumerate(MONTHS, 1):
        t = F.replace(t, F.lit(f"#{name[:3]}#"), F.lit(f"#{number:02d}#"))
    # Three orders with a day, two without; at most one of each line fits, and groups that do not are empty.
    end, month, year = "(?=$|[ ,])", "#([0-9]{2})#", "([0-9]{4}|[0-9]{2})"
    for pattern, figures in (
        (
            rf"^(?:([0-9]{{1,2}}){_SEP}{month}{_SEP}{year}|{month}{_SEP}([0-9]{{1,2}})[ ,./-]+{year}"
            rf"|([0-9]{{4}}){_SEP}{month}{_SEP}([0-9]{{1,2}})){end}",
            "$3$6$7-$2$4$8-$1$5$9",
        ),
        (rf"^(?:{month}{_SEP}([0-9]{{4}})|([0-9]{{4}}){_SEP}{month}){end}", "$2$3-$1$4-01"),
    ):
        t = F.regexp_replace(t, pattern, figures)
    return t


def _in_figures(text: Column) -> Column:
    """Year first, of a text of figures."""
    for pattern, figures in (
        (
            r"^([0-9]{4})(?:[/.]([0-9]{1,2})[/.]([0-9]{1,2})(?![0-9])|([0-9]{2})([0-9]{2})(?=$|[ T]))",
            "$1-$2$4-$3$5",
        ),
        (r"^([0-9-]+[ T])([0-9]{2})([0-9]{2})([0-9]{2})$", "$1$2:$3:$4"),
        (r"^([0-9-]+[ T])([0-9]{2})([0-9]{2})$", "$1$2:$3"),
        # Day first if the first number can be no month; in one match, or the day would be taken for a year of two digits.
        (
            r"^(?:(1[3-9]|2[0-9]|3[01])[/.-]([0-9]{1,2})|([0-9]{1,2})[/.-]([0-9]{1,2}))[/.-]([0-9]{4}|[0-9]{2})"
            r"(?=$|[ T,])",
            "$5-$2$3-$1$4",
        ),
    ):
        text = F.regexp_replace(text, pattern, figures)
    return text


def parse_timestamp(c: Column, dtype: str = "string", formats: tuple[str, ...] = ()) -> Column:
    """Timestamp of ``c`` or NULL.

    Reads ISO dates and times, dates of figures with ``/``, ``.`` or ``-`` or none of them, and dates with a month's name,
    whole or shortened, in any order and case, with or without a weekday; all with a time behind, by 24 hours or with am
    and pm. Dates of two small numbers and a year are month first, or day first if the first number is over 12; a year of
    two digits lies in 1969..2068; a month and a year are the first of the month. ``formats`` are datetime patterns
    of the caller's, which go before all this, in their order.
    """
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return c.cast("timestamp_ntz")
    raw = F.trim(c)
    text = F.when(raw.rlike(HALF_DAY), _by_24_hours(raw)).otherwise(raw)
    named = raw.rlike("[A-Za-z]{3}") & raw.rlike("[0-9]")
    plain = F.when(named, _with_names(F.lower(text))).otherwise(_in_figures(text))
    for pattern, figures in (
        ("^(?=(?:69|[7-9][0-9])-)", "19"),
        ("^(?=[0-6][0-9]-)", "20"),
        ("^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})[ ,]+(?=[0-9])", "$1 "),
    ):
        plain = F.regexp_replace(plain, pattern, figures)
    attempts = [F.try_to_timestamp(raw, F.lit(f)).cast("timestamp_ntz") for f in formats]
    plain = F.regexp_extract(plain, "^[0-9]{4}-[0-9].*$", 0)
    attempts.append(F.when(raw.rlike(ISO), raw).otherwise(plain).try_cast("timestamp_ntz"))
    return F.coalesce(*attempts) if formats else attempts[0]


def given(c: Column) -> Column:
    """Whether ``c`` is not NULL, asked with a lambda, which keeps a projection out of whole-stage code.

    There, the readings of two or three dates make one method of more than 8,000 bytes, which the JVM does not compile but
    interprets, several times slower. A projection by itself is cut into short methods. What has a lambda in it is not
    computed once for several mentions, though, so it has to stand beside a reading, not around it.
    """
    return F.exists(F.array(c), lambda value: value.isNotNull())


def unread(c: Column, dtype: str = "string", formats: tuple[str, ...] = ()) -> Column:
    """Whether there is a text that no date can be read from."""
    return given(c) & parse_timestamp(c, dtype, formats).isNull()


def repair_year(ts: Column, mode: str = "repair", latest: int = LATEST_YEAR, of: Column | None = None) -> Column:
    """Mend years before 1900.

    ``repair`` moves the date forward by whole millennia (1016 -> 2016) and gives
    NULL when no such move lands in [1900, latest]; ``null`` gives NULL outright. ``of`` is the text that ``ts`` is read
    from, if it is.
    """
    # Stated as a sum, both parts of which are always needed, so that ``ts`` is computed once.
    year, months = F.year(ts), F.lit(0) if of is None else F.when(given(of), 0)
    if mode == "null":
        return ts + F.make_ym_interval(F.when(year >= EARLIEST_YEAR, 0), months)
    if mode != "repair":
        raise ValueError(f"unknown year repair mode: {mode}")
    shift = F.floor((F.lit(latest) - year) / F.lit(1000)).cast("int") * F.lit(1000)
    years = F.when(year >= EARLIEST_YEAR, 0).when((year + shift).between(EARLIEST_YEAR, latest), shift)
    return ts + F.make_ym_interval(years, months)
