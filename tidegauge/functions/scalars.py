"""Column expressions: every one stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge import settings

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def whole_div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


# --- text ---------------------------------------------------------------


def truncate_text(text: Column) -> Column:
    keep = settings.MAX_TEXT_CHARS - 3
    shortened = F.concat(F.left(text, F.lit(keep)), F.lit("..."))
    return F.when(F.char_length(text) > settings.MAX_TEXT_CHARS, shortened).otherwise(text)


def statement_type(text: Column) -> Column:
    kind = F.lit("OTHER")
    for word in ("DELETE", "UPDATE", "INSERT", "SELECT"):
        kind = F.when(text.startswith(word), word).otherwise(kind)
    return kind


# Wait event prefix and the category reported for it.
WAIT_CATEGORIES = (
    ("wait/io/file/innodb/", "InnoDB File IO"),
    ("wait/io/file/aria/", "Aria File IO"),
    ("wait/io/file/sql/", "SQL File IO"),
    ("wait/io/socket/", "Network IO"),
    ("wait/synch/cond/", "Condition Wait"),
    ("wait/synch/mutex/", "Mutex"),
    ("wait/lock/table/", "Table Lock"),
    ("wait/lock/metadata/", "Metadata Lock"),
    ("wait/lock/transaction/", "Transaction Lock"),
)


def wait_category(event_name: Column) -> Column:
    # The prefixes exclude each other, so the order of the branches is free.
    category = F.lit("Other")
    for prefix, label in WAIT_CATEGORIES:
        category = F.when(event_name.startswith(prefix), label).otherwise(category)
    return category


def full_scan_flag(no_index_used: Column) -> Column:
    return F.when(no_index_used > 0, "Yes").otherwise("No")


# A literal is a closed quoted string, the part of an unclosed one that '' can
# close, a hex number or a word-bounded number. Quantifiers over quoted text
# are possessive: a megabyte-long literal must not recurse per character. The
# word boundary is ASCII, and (?d) keeps '.' away from line feeds only.
_LITERAL = (
    r"(?d)'(?:[^'\\]++|\\.|'')*+'"
    r"|'(?:(?:[^'\\]++|\\.)*+''(?=(?:[^'\\]++|\\.)*+''))*+(?:[^'\\]++|\\.)*+'"
    r"|0x[0-9a-fA-F]+"
    r"|(?<![0-9A-Za-z_])\d+(?:\.\d+)?(?![0-9A-Za-z_])"
)


def anonymize_sql(text: Column) -> Column:
    return F.regexp_replace(text, _LITERAL, "?")


def escape_json_strings(text: Column) -> Column:
    """Backslash, then double quote, then backtick: the order matters."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("`", "\\`")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


# --- time ---------------------------------------------------------------


def _half_up(total: Column, unit: Column) -> Column:
    """round(total / unit) for non-negative integers, ties up, no overflow."""
    extra = F.when((total % unit) * 2 >= unit, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return whole_div(total, unit) + extra


def _thousandths(value: Column) -> Column:
    return value.cast("double") / F.lit(1000.0)


def ps_to_ms(picoseconds: Column) -> Column:
    return _thousandths(_half_up(picoseconds, F.lit(1_000_000).cast("long")))


def ps_to_seconds(picoseconds: Column) -> Column:
    return picoseconds.cast("double") / F.lit(1e12)


def us_to_ms(microseconds: Column) -> Column:
    # Microseconds are thousandths of a millisecond: nothing is rounded off.
    return _thousandths(microseconds)


def _mean_us(picoseconds: Column, count: Column) -> Column:
    unit = F.nullif(count, F.lit(0).cast("long")) * F.lit(1_000_000).cast("long")
    return _half_up(picoseconds, unit)


def mean_ps_to_ms(picoseconds: Column, count: Column) -> Column:
    """round(sum / count / 1e9, 3) in exact integers; count 0 gives null."""
    return _thousandths(_mean_us(picoseconds, count))


def mean_ps_to_ms_text(picoseconds: Column, count: Column) -> Column:
    """The same mean as decimal text with three places."""
    us = _mean_us(picoseconds, count)
    places = F.lpad((us % 1000).cast("string"), 3, "0")
    return F.concat(whole_div(us, 1000).cast("string"), F.lit("."), places)


def utc_iso(wall_clock: Column, zone: Column | str = "UTC") -> Column:
    """Server-local wall clock to ISO-8601 UTC text, whole seconds."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    moved = F.convert_timezone(zone, F.lit("UTC"), wall_clock.cast("timestamp_ntz"))
    return F.date_format(moved, ISO_UTC)


# --- versions -----------------------------------------------------------


def is_mariadb(version: Column) -> Column:
    return F.lower(version).contains("maria")


def db_flavor(version: Column) -> Column:
    return F.when(is_mariadb(version), "mariadb").otherwise("mysql")


def sanitize_version(version: Column) -> Column:
    """``major.minor.patch``; MariaDB and anything unreadable count as 5.7.0."""
    shape = r"^(\d+)(?:\.(\d+))?(?:\.(\d+))?"
    parts = [F.regexp_extract(version, shape, i) for i in (1, 2, 3)]
    filled = [F.when(p == "", "0").otherwise(p) for p in parts]
    readable = version.rlike(r"^\d") & ~is_mariadb(version)
    return F.when(readable, F.concat_ws(".", *filled)).otherwise(settings.FALLBACK_VERSION)


def go_int(text: Column) -> Column:
    """Optional sign and digits only, within 64 bits; otherwise null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("long"))


def version_part(version: Column, index: int) -> Column:
    return go_int(F.get(F.split(version, r"\."), F.lit(index)))


def version_lt(version: Column, major: int, minor: int | None = None) -> Column:
    """True when older, and also when the needed part cannot be read."""
    first = version_part(version, 0)
    if minor is None:
        return F.coalesce(first < major, F.lit(True))
    second = version_part(version, 1)
    older = (first < major) | ((first == major) & (second < minor))
    return F.when(first.isNull() | second.isNull(), True).otherwise(older)


def version_at_least(version: Column, major: int, minor: int | None = None) -> Column:
    """Support check: needs a dotted version, a suffix after '-' in the minor
    part is dropped, and an unreadable part is not supported."""
    dotted = F.size(F.split(version, r"\.")) >= 2
    first = version_part(version, 0)
    if minor is None:
        enough = first >= major
    else:
        second = go_int(F.get(F.split(F.get(F.split(version, r"\."), F.lit(1)), "-"), F.lit(0)))
        enough = F.when(second.isNotNull(), (first > major) | ((first == major) & (second >= minor)))
    return F.coalesce(dotted & enough, F.lit(False))


# --- numbers as text ----------------------------------------------------


def _exact_decimals(fraction: Column, places: int) -> Column:
    """round(fraction * 10**places) of the exact binary value, ties to even.

    The fraction is a whole number of 2**-73 (smaller ones round to zero
    anyway), so it is rounded in integers.
    """
    high = fraction * F.lit(float(2**40))
    low = (high - F.floor(high).cast("double")) * F.lit(float(2**33))
    scaled = F.floor(high).cast("decimal(13,0)") * F.lit(2**33).cast("decimal(11,0)") + F.floor(low).cast("decimal(11,0)")
    product = (scaled * F.lit(10**places).cast("decimal(7,0)")).cast("decimal(30,0)")
    unit = F.lit(str(2**73)).cast("decimal(23,0)")
    down = whole_div(product, unit)
    rest2 = (product % unit).cast("decimal(24,0)") * F.lit(2).cast("decimal(1,0)")
    up = (rest2 > unit) | ((rest2 == unit) & (down % 2 == 1))
    return down + up.cast("long")


def _whole_text(value: Column) -> Column:
    """Exact decimal digits of a double from 2**53 up, which is a whole number.

    The number is an integer of at most 54 bits doubled over and over; it is kept in limbs of
    nine digits, lowest first, and up to 20 doublings are one multiplication.
    """
    limb = 10**9
    # One less than needed: the logarithm of a number just below a power of two may be rounded up.
    power = F.greatest(F.floor(F.log2(value)).cast("int") - 53, F.lit(0))
    half = F.floor(power / 2)
    odd = F.floor(value / F.pow(F.lit(2.0), half.cast("double")) / F.pow(F.lit(2.0), (power - half).cast("double")))
    odd = odd.cast("long")
    first = F.array(odd % limb, whole_div(odd, limb) % limb)

    def times(limbs: Column, shift: Column) -> Column:
        def carry(state: Column, x: Column) -> Column:
            product = x * shift + state["carry"]
            return F.struct(whole_div(product, limb).alias("carry"), F.concat(state["out"], F.array(product % limb)).alias("out"))

        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(limbs, start, carry, lambda s: F.when(s["carry"] > 0, F.concat(s["out"], F.array(s["carry"]))).otherwise(s["out"]))

    twenty = F.sequence(F.lit(1), whole_div(power + 19, 20).cast("int"))
    steps = F.when(power > 0, F.transform(twenty, lambda i: F.pow(F.lit(2.0), F.least(F.lit(20), power - (i - 1) * 20).cast("double")).cast("long")))
    limbs = F.aggregate(F.coalesce(steps, F.array().cast("array<bigint>")), first, times)
    text = F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.ltrim(text, F.lit("0"))


def fixed_decimals(value: Column, places: int) -> Column:
    """``%.<places>f`` of the exact binary value, ties to even; null unless finite.

    The JVM formatter rounds the shortest decimal text instead, so 1.005 would
    print as 1.01. Exact arithmetic is needed only next to a tie, for up to five
    places. From 2**53 up a double is a whole number, printed digit by digit.
    """
    size = F.abs(value)
    finite = size < F.lit(float("inf"))
    large = size >= F.lit(float(2**53))
    small = F.when(~large, size).otherwise(F.lit(0.0))
    whole = F.floor(small)
    fraction = small - whole.cast("double")
    near = fraction * F.lit(float(10**places))
    below = F.floor(near)
    rest = near - below.cast("double")
    clear = F.abs(rest - F.lit(0.5)) > F.lit(1e-6)
    digits = F.when(clear, below + (rest > F.lit(0.5)).cast("long")).otherwise(_exact_decimals(fraction, places))
    shown = F.when(large, _whole_text(size)).otherwise((whole + whole_div(digits, 10**places)).cast("string"))
    text = F.concat(
        F.when(value < 0, "-").otherwise(""),
        shown,
        F.lit("."),
        F.lpad((digits % 10**places).cast("string"), places, "0"),
    )
    return F.when(finite, text)
