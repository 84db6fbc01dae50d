"""Problem 5: dates and times of many formats, precisions and zones in one form.

Each value's shape mask replaces every digit by 9 and every letter by a. The distinct masks
are few; each is mapped once to a parser: the places of year, month, day, time and zone in
values of that shape. Masks that fit no grammar have no parser, so the table of parsers is
small for most columns; it is written once and counted, broadcast up to ``BROADCAST_ROWS`` parsers and
joined by a shuffle beyond (zone names of any length make many shapes). Values are then cut up
at those places by JVM expressions, and local times are converted through zone transition
tables in Arrow batches.

Defined results: null, blank and unreadable values and days that no calendar has give nulls
and precision 'none'; counts of seconds or milliseconds are instants; times without a zone
take the dataset's zone (no result instant where it has none); abbreviations other than UTC
and GMT are those of the dataset's zone; a skipped local time keeps the offset from before the
gap, one that occurs twice means the first; coarser values (month, quarter, year, decade)
give their first day and their precision.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliolake.functions.zones import VERSION, offset_of
from heliolake.session import cut

#: Most parsers that are broadcast; one takes about 300 bytes.
BROADCAST_ROWS = 50_000
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed values.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

_DATES = (
    r"(?P<y>9{4})(?P<sep>[-/.])(?P<m>9{1,2})(?P=sep)(?P<d>9{1,2})",
    r"(?P<y>9{4})(?P<m>99)(?P<d>99)",
    r"(?P<p>9{1,2})(?P<sep>[-/.])(?P<q>9{1,2})(?P=sep)(?P<y>9{4})",
    r"(?:a{2,9},? )?(?P<d>9{1,2})(?:aa)?[ -](?P<n>a{3,9})\.?,?[ -](?P<y>9{4})",
    r"(?:a{6,9},? )?(?P<n>a{3,9})\.? (?P<d>9{1,2})(?:aa)?,? (?P<y>9{4})",
    r"(?P<y>9{4})年(?P<m>9{1,2})月(?P<d>9{1,2})日",
)
_TIME = r"(?:[ a]|, | aa )?(?:(?P<h>9{1,2}):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9{1,9}))?)?|(?P<h2>99)(?P<mi2>99)(?:(?P<s2>99)(?:[.,](?P<f2>9{1,9}))?)?)(?: ?(?P<ap>aa)(?!a))?"
_REGION = r"a+(?:[/_+-]a+)*"
_ZONE = rf"(?: ?(?P<u>a)| ?(?P<o>[+-]99(?::?99)?)(?: ?\[{_REGION}\])?| ?\[(?P<r>{_REGION})\]| (?P<r2>a+(?:_a+)*(?:/a+(?:[_-]a+)*)+)| ?(?P<ab>a{{3,5}}))?"
_PARTS = ("y", "m", "d", "p", "q", "n", "h", "mi", "s", "f", "ap", "u", "o", "r", "ab")
_COARSE = (
    ("year", r"~?(?P<y>9{4})"),
    ("month", r"(?P<y>9{4})[-/](?P<m>99)"),
    ("month", r"(?P<n>a{3,9}) (?P<y>9{4})"),
    ("quarter", r"a(?P<q>9) (?P<y>9{4})"),
    ("quarter", r"(?P<y>9{4})-a(?P<q>9)"),
    ("decade", r"(?P<y>9{4})a"),
    ("year", r"(?P<y>9{4})\.\.9{4}"),
    ("seconds", r"(?P<y>9{9,10})"),
    ("milliseconds", r"(?P<y>9{12,13})"),
)


def parser_of(mask: str) -> dict[str, int | str] | None:
    """Places (from 1, with lengths) of the parts in every value of this mask, or None."""
    found, form = None, ""
    for date in _DATES:
        if m := re.fullmatch(date, mask):
            found, form = m, "day"
        elif m := re.fullmatch(date + _TIME + _ZONE, mask):
            # digits must not run on from the date into the time, but for one compact form
            found, form = m, "instant"
        if found:
            break
    if not found:
        for name, pattern in _COARSE:
            if m := re.fullmatch(pattern, mask):
                found, form = m, name
                break
    if not found:
        return None
    got = found.groupdict()
    spans = {k: found.span(k) for k, v in got.items() if v is not None}
    for plain, other in (("h", "h2"), ("mi", "mi2"), ("s", "s2"), ("f", "f2"), ("r", "r2")):
        if other in spans:
            spans[plain] = spans[other]
    if form == "instant" and "h2" in got and got.get("h2") and mask[spans["h"][0] - 1] == "9":
        return None
    out: dict[str, int | str] = {"mask": mask, "form": form}
    for k in _PARTS:
        a, b = spans.get(k, (0, 0))
        out[k], out[k + "_n"] = a + 1 if b else 0, b - a
    return out


_SCHEMA = "mask string, form string, " + ", ".join(f"{k} int, {k}_n int" for k in _PARTS)


def _parsers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["mask", "form", *[c for k in _PARTS for c in (k, f"{k}_n")]]
    for b in batches:
        rows = [p for p in map(parser_of, b["mask"]) if p]
        yield pd.DataFrame(rows, columns=columns)


def tidy(value: Column) -> Column:
    """Without outer blanks, inner runs of white space as one space."""
    return F.trim(F.regexp_replace(value, r"[    \s]+", " "))


def shape_mask(value: Column) -> Column:
    """Character-class mask of a tidied value."""
    return F.translate(value, "0123456789" + _LETTERS, "9" * 10 + "a" * 52)


def utc_day(instant: Column) -> Column:
    """The calendar day of an instant in UTC, whatever the session's time zone."""
    us = F.unix_micros(instant)
    return F.date_from_unix_date(((us - F.pmod(us, F.lit(86_400_000_000))) / 86_400_000_000).cast("int"))


def normalise(df: DataFrame, value: str, zone: Column, date_order: Column) -> DataFrame:
    """Add ``written_date``, ``instant`` (UTC), ``day`` (date where no time is given), ``precision``, ``zone_source`` and ``tz_version``.

    ``zone`` and ``date_order`` (DMY, MDY, YMD) hold for values that don't say themselves.
    Columns of these names in the input are replaced; names that begin with two underscores
    are reserved.
    """
    work = df.withColumns({"__v": tidy(F.col(f"`{value}`")), "__zone": zone, "__order": date_order})
    work = work.withColumn("__mask", shape_mask(F.col("__v")))
    parsers = work.select(F.col("__mask").alias("mask")).filter("mask IS NOT NULL").distinct().mapInPandas(_parsers, _SCHEMA)
    p = parsers.select(F.col("mask").alias("__mask"), F.struct(*[c for c in parsers.columns if c != "mask"]).alias("__p"))
    p = cut(p)
    work = work.drop("__p").join(F.broadcast(p) if p.count() <= BROADCAST_ROWS else p, "__mask", "left")

    def part(k: str) -> Column:
        return F.when(F.col(f"__p.{k}") > 0, F.substring(F.col("__v"), F.col(f"__p.{k}"), F.col(f"__p.{k}_n")))

    def number(k: str) -> Column:
        return part(k).try_cast("int")

    form = F.col("__p.form")
    # a month is told by three letters, and the rest must go on as its name does
    name = F.lower(part("n"))
    place = F.position(F.substring(name, 1, 3), F.lit("".join(m[:3] for m in MONTHS)))
    named = F.when(place % 3 == 1, (place / 3).cast("int") + 1)
    full = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.coalesce(named, F.lit(1)))
    named = F.when(F.startswith(full, name), named)
    p1, q1 = number("p"), number("q")
    month_first = F.when(F.col("__order") == "MDY", ~((p1 > 12) & (q1 <= 12))).otherwise((q1 > 12) & (p1 <= 12))
    day_form = form.isin("day", "instant")
    month = F.when(form == "quarter", F.when(q1.between(1, 4), q1 * 3 - 2)).when(form.isin("year", "decade"), F.lit(1)).otherwise(
        F.coalesce(number("m"), named, F.when(month_first, p1).otherwise(q1)))
    day = F.when(day_form, F.coalesce(number("d"), F.when(month_first, q1).otherwise(p1))).otherwise(F.lit(1))
    said = F.when(~form.isin("seconds", "milliseconds"), F.concat_ws("-", part("y"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")))
    date = F.when(month.isNotNull() & day.isNotNull(), said.try_cast("date"))
    work = work.withColumns({"__date": date, "__h": number("h"), "__ap": F.upper(part("ap"))})
    hour = (
        F.when(F.col("__ap").isNull(), F.when(F.col("__h") <= 23, F.col("__h")))
        .when(F.col("__ap").isin("AM", "PM") & F.col("__h").between(1, 12), F.col("__h") % 12 + F.when(F.col("__ap") == "PM", 12).otherwise(0))
    )
    minute, second = number("mi"), F.coalesce(number("s"), F.lit(0))
    micros = F.coalesce(F.substring(F.rpad(part("f"), 9, "0"), 1, 6).try_cast("int"), F.lit(0))
    local = F.when(
        (form == "instant") & (minute <= 59) & (second <= 60),
        F.unix_date("__date").cast("long") * 86_400 + hour * 3600 + minute * 60 + second,
    )
    offset_text = F.regexp_replace(part("o"), ":", "")
    offset_h, offset_m = F.substring(offset_text, 2, 2).try_cast("int"), F.coalesce(F.substring(offset_text, 4, 2).try_cast("int"), F.lit(0))
    stated = F.when(F.substring(offset_text, 1, 1) == "-", -1).otherwise(1) * (offset_h * 3600 + offset_m * 60)
    abbreviation = F.upper(part("ab"))
    region = part("r")
    fixed = (
        F.when(stated.isNotNull(), stated)
        .when(F.upper(part("u")) == "Z", F.lit(0))
        .when(abbreviation.isin("UTC", "GMT") | F.upper(region).isin("UTC", "GMT", "Z"), F.lit(0))
    )
    odd = part("u").isNotNull() & (F.upper(part("u")) != "Z")
    looked_up = F.when(fixed.isNull() & ~F.coalesce(odd, F.lit(False)), F.coalesce(region, F.col("__zone")))
    work = work.withColumns(
        {
            "__local": local,
            "__us": micros,
            "__fixed": fixed,
            "__look": looked_up,
            "__abbr": F.when(fixed.isNull() & region.isNull(), abbreviation),
            "zone_source": F.when(local.isNull(), F.lit(None).cast("string")).when(stated.isNotNull(), "offset").when(region.isNotNull(), "region").when(abbreviation.isNotNull(), "abbreviation").when(part("u").isNotNull(), "Z").otherwise("dataset"),
        }
    )
    work = work.withColumn("__off", F.coalesce(F.col("__fixed").cast("long"), offset_of(F.col("__local"), F.col("__look"), F.col("__abbr"))))
    epoch = part("y").try_cast("long")
    instant_us = (
        F.when(form == "seconds", epoch * 1_000_000)
        .when(form == "milliseconds", epoch * 1000)
        .otherwise((F.col("__local") - F.col("__off")) * 1_000_000 + F.col("__us"))
    )
    clock = form.isin("seconds", "milliseconds")
    out = work.withColumns(
        {
            "written_date": F.when(day_form, F.col("__date")),
            "instant": F.timestamp_micros(instant_us),
            "day": F.when((form != "instant") & ~clock, F.col("__date")),
            "precision": F.when(clock & epoch.isNotNull(), "instant").when(F.col("__date").isNull(), "none").when(form == "instant", F.when(instant_us.isNotNull(), "instant").otherwise("none")).otherwise(F.coalesce(form, F.lit("none"))),
            "tz_version": F.when(F.col("__local").isNotNull(), F.lit(VERSION)),
        }
    )
    return out.withColumn("precision", F.coalesce("precision", F.lit("none"))).drop("__v", "__zone", "__order", "__mask", "__p", "__date", "__h", "__ap", "__local", "__us", "__fixed", "__look", "__abbr", "__off")
