"""Column functions on paths and URIs. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def path_segments(path: ColumnOrName) -> Column:
    return F.split(as_column(path), "/")


def class_from_path(path: ColumnOrName) -> Column:
    """Name of the directory that holds the file; NULL for a path without one."""
    return F.try_element_at(path_segments(path), F.lit(-2))


def percent_encode(text: ColumnOrName) -> Column:
    """RFC 3986 encoding of everything but letters, digits and `-._~`.

    Spark's url_encode writes form encoding, which differs in these three characters.
    """
    encoded = F.url_encode(as_column(text))
    for form, percent in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(percent))
    return encoded


def format_uri(template: str, *parts: ColumnOrName) -> Column:
    """printf-style URI template over columns, e.g. `s3a://%s/%s`."""
    return F.format_string(template, *[as_column(part) for part in parts])


def plain_path(origin: ColumnOrName) -> Column:
    """The image source's percent-encoded `origin`, spelled like binaryFile's `path`."""
    decoded = F.url_decode(F.replace(as_column(origin), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:///", "file:/")
