"""Column expressions with the semantics that the workloads rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"^([0-9]{1,8})-([1-9][0-9]{3})\z"


def matched(value: Column, pattern: str, group: int) -> Column:
    """The group of a match, null without one."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def text(value: Column) -> Column:
    """As in a message: a null is empty, a date is written as a date."""
    return F.coalesce(value.cast("string"), F.lit(""))


def is_true(condition: Column) -> Column:
    """Unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def month_of(package: Column) -> Column:
    """The month of a package named monthly/YYYY-MM, null for others."""
    return F.when(package.startswith("monthly/"), F.try_to_date(F.substring(package, 9, 7), "yyyy-MM"))


def seconds(a: Column, b: Column) -> Column:
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1000000


def identity(raw: Column) -> Column:
    """publication_number and publication_year of a name such as 000995_2020.xml; null for anything else or number 0."""
    pattern = r"^([0-9]{1,8})[-_]([1-9][0-9]{3})(\.xml)?\z"
    number = matched(raw, pattern, 1).try_cast("long")
    return F.when(number > 0, F.struct(number.alias("publication_number"), matched(raw, pattern, 2).try_cast("int").alias("publication_year")))


def notice_date(raw: Column) -> Column:
    """A date written YYYYMMDD, or YYYY-MM-DD at the start; null if blank or no such day."""
    t = F.trim(raw)
    return F.when(t.rlike(r"^[0-9]{8}\z"), F.try_to_date(t, "yyyyMMdd")).when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))


def country(raw: Column, codes: dict[str, str]) -> Column:
    """buyer_country, its two-letter code and a status: two letters are their own code, others have that of ``codes`` or none."""
    c = F.nullif(F.upper(F.trim(raw)), F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    iso = F.when(c.rlike(r"^[A-Z]{2}\z"), c).otherwise(F.try_element_at(known, c))
    return F.struct(c.alias("buyer_country"), iso.alias("buyer_country_iso"), F.when(c.isNull(), "absent").otherwise("present").alias("buyer_country_status"))
