"""Dates, amounts, hashes, arrays and JSON: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Day patterns that are read, with what they look like.
DATE_FORMATS = ((r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{8}$", "yyyyMMdd"))
#: Lower ends of spending tiers and their names; a null amount is in the first.
TIERS = ((0.0, "under 1k"), (1_000.0, "1k to 10k"), (10_000.0, "10k to 100k"), (100_000.0, "100k and more"))


def iso_date(c: Column) -> Column:
    """A date in one of three notations as ISO text, its time of day dropped; other text unchanged."""
    day = F.trim(F.regexp_replace(c, r"[ T]\d{1,2}:\d{2}.*$", ""))
    tried = [F.date_format(F.try_to_date(F.when(day.rlike(look), day), fmt), "yyyy-MM-dd") for look, fmt in DATE_FORMATS]
    return F.coalesce(*tried, day)


def cycle_year(c: Column) -> Column:
    """The first four characters of an ISO date, if they are digits."""
    y = F.substring(c, 1, 4)
    return F.when(y.rlike(r"^\d{4}$"), y)


def clean_amount(c: Column) -> Column:
    """A number from text with currency signs and thousands commas; null if it isn't one."""
    return F.regexp_replace(c.cast("string"), r"[$,\s]", "").try_cast("double")


def amount_text(c: Column) -> Column:
    """Two decimals, without '.00'."""
    return F.when(c.isNotNull(), F.regexp_replace(F.format_string("%.2f", c), r"\.00$", ""))


def tier(c: Column) -> Column:
    """The half-open tier of an amount."""
    out = F.lit(TIERS[0][1])
    for low, name in TIERS[1:]:
        out = F.when(c >= low, name).otherwise(out)
    return out


def threshold_label(n: int) -> str:
    """10000 as '10k'."""
    return f"{n // 1_000_000}m" if n % 1_000_000 == 0 and n else f"{n // 1000}k" if n % 1000 == 0 and n else str(n)


def threshold_text(c: Column) -> Column:
    """threshold_label of a column of whole numbers."""
    return F.when((c % 1_000_000 == 0) & (c != 0), F.concat((c / 1_000_000).cast("bigint").cast("string"), F.lit("m"))).when((c % 1000 == 0) & (c != 0), F.concat((c / 1000).cast("bigint").cast("string"), F.lit("k"))).otherwise(c.cast("string"))


def name_uuid(c: Column) -> Column:
    """A UUID of version 8 (free form) that a text always gets again, from its SHA-256; null for null."""
    h = F.sha2(c, 256)
    return F.when(c.isNotNull(), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)), F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)))


def log_bin(c: Column, per_decade: int = 4) -> Column:
    """The number of the logarithmic bin of a positive amount; null otherwise."""
    return F.when(c > 0, F.floor(F.log10(c) * per_decade))


def confidence_bin(c: Column, edges: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75)) -> Column:
    """The left-closed bin of a confidence, named by its lower edge."""
    out = F.lit(None).cast("double")
    for e in edges:
        out = F.when(c >= e, F.lit(e)).otherwise(out)
    return out


def ratio(part: Column, whole: Column) -> Column:
    """part / whole with whole at least 1."""
    return part / F.greatest(whole, F.lit(1))


def dedup_key(*columns: Column) -> Column:
    """The md5 of the columns joined by '|', null as ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def set_id(values: Column, prefix: str = "") -> Column:
    """An id of a set of keys, whatever their order and repeats."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.array_join(F.array_sort(F.array_distinct(values)), "||"), 256), 1, 16))


def zipped_rows(*lists: Column, sep: str = r"\|") -> Column:
    """Parallel delimited lists as an array of structs, shorter ones filled with null."""
    return F.arrays_zip(*[F.split(c, sep) for c in lists])


def json_field(c: Column, name: str) -> Column:
    """A top-level field of a JSON object as text; null for text that is none."""
    return F.get_json_object(c, f"$.{name}")
