"""XML payloads carried in a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import LOG_XML_FIELDS


def parse_log(col: Column | str, schema: T.StructType = LOG_XML_FIELDS,
              mode: str = "FAILFAST") -> Column:
    """Parse one ``<log>`` element per value into a struct.

    ``FAILFAST`` raises on malformed XML (NULL stays NULL); ``PERMISSIVE`` gives NULL fields.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.from_xml(c, schema, {"mode": mode})


def render_log(fields: Column) -> Column:
    """The inverse of :func:`parse_log`: a struct rendered as one ``<log>`` element."""
    return F.to_xml(fields, {"rowTag": "log"})
