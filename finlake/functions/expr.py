"""Column expressions of the finance domain. Money is decimal throughout."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.contracts import COUNTRY_ALIASES

MONEY, RATE, RATIO, WIDE = "decimal(20,2)", "decimal(18,6)", "decimal(18,4)", "decimal(38,18)"


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def code(c: Column) -> Column:
    return F.upper(stripped(c))


def country(c: Column) -> Column:
    aliases = F.create_map(*[F.lit(x) for pair in COUNTRY_ALIASES.items() for x in pair])
    return F.coalesce(aliases[code(c)], code(c))


def identifier(c: Column) -> Column:
    return F.translate(code(c), " ", "-")


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def strict_date(c: Column) -> Column:
    """A date from yyyy-MM-dd and nothing else; null otherwise."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def number(c: Column) -> Column:
    """A finite decimal without thousands marks; null otherwise."""
    text = stripped(c)
    return F.when(~text.rlike(r"[,\s_]"), text.try_cast(WIDE))


def half_up(c: Column, kind: str = MONEY) -> Column:
    return c.cast(kind)


def money_product(amount: Column, rate: Column) -> Column:
    """amount x rate, exact, rounded once: decimal(18,2) x decimal(18,6) fits decimal(37,8)."""
    return (amount.cast("decimal(18,2)") * rate.cast(RATE)).cast(MONEY)


def month(c: Column) -> Column:
    return F.trunc(c, "month")


def ratio(n: Column, d: Column, kind: str = RATIO) -> Column:
    return F.when(d != 0, n / d).cast(kind)


def per_unit(n: Column, count: Column) -> Column:
    return ratio(n, count.cast("decimal(20,0)"), MONEY)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def total(c: Column) -> Column:
    return F.sum(c).cast(MONEY)


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast(MONEY)


def date_key(c: Column) -> Column:
    """yyyymmdd as a number, without text on the way but for years before 0, whose sign goes before all digits."""
    return F.when(F.year(c) >= 0, F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).otherwise(F.date_format(c, "yyyyMMdd").cast("int"))


def reasons(rules: Iterable[tuple[str, Column]]) -> Column:
    """The reasons whose predicate holds; null predicates don't."""
    return F.array_compact(F.array(*[F.when(p, F.lit(r)) for r, p in rules]))


def joined(codes: Column) -> Column:
    return F.concat_ws("|", F.array_sort(F.array_distinct(codes)))


def spreadsheet_safe(c: Column) -> Column:
    """An apostrophe before cells that a spreadsheet would run."""
    return F.when(c.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), c)).otherwise(c)


def payload(*columns: Column) -> Column:
    """A digest of values in which null, empty and neighbouring values can't be mixed up."""
    marked = [F.when(c.isNull(), F.lit("n;")).otherwise(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"), F.lit(";"))) for c in columns]
    return F.sha2(F.concat(*marked), 256)


def storage_id(fingerprint: Column) -> Column:
    return F.when(fingerprint.rlike("^[0-9a-f]{64}$"), F.substring(fingerprint, 1, 20))
