"""Parsing of addresses, meter lines and metadata strings as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(text: Column, default: float | None = None) -> Column:
    """A number, or ``default`` where the text is none."""
    return F.coalesce(text.try_cast("double"), F.lit(default).cast("double"))


def positive(text: Column) -> Column:
    """A number above zero, else null: resolutions of zero or less count as missing."""
    value = text.try_cast("double")
    return F.when(value > 0, value)


def physical_size(first: Column, second: Column) -> Column:
    """Micrometres per pixel from the first place that has them, else 1."""
    return F.coalesce(positive(first), positive(second), F.lit(1.0))


def meter_line(line: Column) -> Column:
    """``struct(util, used, total)`` of the first line of comma-separated readings.

    Fewer than three parts, or a part that is no number, make all three null.
    """
    parts = F.transform(F.split(F.get(F.split(line, "\n"), F.lit(0)), ","), lambda x: F.trim(x).try_cast("double"))
    three = F.slice(parts, 1, 3)
    good = (F.size(parts) >= 3) & F.forall(three, lambda x: x.isNotNull())
    pick = lambda i: F.when(good, F.get(three, F.lit(i)))
    return F.struct(pick(0).alias("util"), pick(1).alias("used"), pick(2).alias("total"))


def memory_mib(text: Column) -> Column:
    """MiB of a string such as "8 GB" or "1536 MB"; null where it has no number in front."""
    number = F.get(F.split(F.trim(text), r"\s+"), F.lit(0)).try_cast("double")
    unit = F.upper(F.coalesce(F.get(F.split(F.trim(text), r"\s+"), F.lit(1)), F.lit("")))
    return F.when(unit == "GB", number * 1024).otherwise(number).cast("int")


def address(url: Column, default_port: Column | None = None) -> Column:
    """``struct(scheme, host, port, path)`` of an address.

    The port is the address's own, else ``default_port``, else 443 for https and wss and 80 for
    others; the path is ``/`` where there is none. Text without ``://`` is a bare host.
    """
    whole = F.coalesce(url, F.lit(""))
    bare = F.instr(whole, "://") == 0
    scheme = F.when(bare, F.lit("")).otherwise(F.lower(F.substring_index(whole, "://", 1)))
    rest = F.when(bare, whole).otherwise(F.regexp_replace(whole, r"^[^:]*://", ""))
    place = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.regexp_extract(place, r"^(?:.*@)?([^:]*)", 1)
    port = F.regexp_extract(place, r":(\d+)$", 1).try_cast("int")
    usual = F.when(scheme.isin("https", "wss"), 443).otherwise(80)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.struct(
        scheme.alias("scheme"), host.alias("host"), F.coalesce(port, default_port if default_port is not None else F.lit(None).cast("int"), usual).alias("port"),
        F.when(path == "", "/").otherwise(path).alias("path"),
    )


def lookup(key: Column, table: Mapping[str, object], default: str) -> Column:
    """The entry of a small fixed table; a null key means ``default``, an unknown one fails the query."""
    entries = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    found = F.try_element_at(entries, F.coalesce(key, F.lit(default)))
    message = F.concat(F.lit("unknown version "), key, F.lit("; there are " + ", ".join(sorted(table))))
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(message).cast("string"))
