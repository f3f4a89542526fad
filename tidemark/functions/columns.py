"""Column helpers without user functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), where value is computed once, also for lambdas inside body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ratio(a, b) -> Column:
    """a / b, or null where b is 0 or either is null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def finite(c: Column) -> Column:
    """Null for what is not a finite number."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def parse_number(text: Column) -> Column:
    """A finite number from text, or null: what does not look like a number is none, whatever a venue writes for it."""
    t = F.trim(text)
    return finite(F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double")))


def parse_whole(text: Column) -> Column:
    n = parse_number(text)
    return F.when(n == F.floor(n), n.cast("long"))


def parse_positive(text: Column) -> Column:
    n = parse_number(text)
    return F.when(n > 0, n)


def parse_non_negative(text: Column) -> Column:
    n = parse_number(text)
    return F.when(n >= 0, n)


def bps(value: Column, centre: Column) -> Column:
    """How far value is from centre, in hundredths of a percent; null unless centre is positive."""
    return F.when(centre > 0, (value - centre) / centre * 10_000.0)


def name_key(name: Column) -> Column:
    """A name for comparison: lower case, everything else than letters and digits one blank."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def asset_id(space: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit("asset"), F.lit(space), *parts)


def id_space(identifier: Column) -> Column:
    """The second part of an identifier, as in asset:<space>:..."""
    return F.split_part(identifier, F.lit(":"), F.lit(2))


def shard(identifier: Column, shards: int) -> Column:
    """First eight bytes of the SHA-256 as a big-endian number, modulo the number of shards."""
    head = F.conv(F.substring(F.sha2(identifier.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, F.lit(shards).cast("decimal(20,0)")).cast("int")


#: Observations before 2010 or more than 26 hours ahead have no plausible time.
FIRST_MS, AHEAD_MS = 1_262_304_000_000, 26 * 3_600_000


def plausible_ms(ms: Column, now: Column, ahead_ms: int = AHEAD_MS) -> Column:
    return F.when((ms >= FIRST_MS) & (ms <= now + ahead_ms), ms)


SLOT_MS = 900_000


def slot(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(SLOT_MS))


def slot_label(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(slot(ms)), "yyyyMMdd'T'HHmmss'Z'")


def round_for_output(c: Column, digits: int = 12) -> Column:
    """To so many significant digits, so that results print the same on every machine; 0 stays 0, and what is not finite is null."""
    size = F.floor(F.log10(F.abs(finite(c))))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - size)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.rint(finite(c) * scale) / scale)


def step_decimals(step: Column) -> Column:
    """Decimals of a price step such as 0.001, null unless it is positive."""
    text = F.regexp_replace(F.format_string("%.12f", step), "0+$", "")
    return F.when(step > 0, F.length(F.split_part(text, F.lit("."), F.lit(2))))


def without_prefix(text: Column, *prefixes: str) -> Column:
    out = text
    for p in reversed(prefixes):
        out = F.when(text.startswith(p) & (F.length(text) > len(p)), F.substr(text, F.lit(len(p) + 1))).otherwise(out)
    return out


def split_pair(symbol: Column, separators: str = "-_/:") -> Column:
    """base and quote of a symbol with one separator, null without."""
    parts = F.split(symbol, f"[{separators}]")
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("base"), parts[1].alias("quote")))


def iso_ms(text: Column) -> Column:
    """Milliseconds of an ISO time; without a zone it is UTC."""
    return F.unix_millis(F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")))
