"""URL pieces and URL templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# One rule for every engine: scheme, optional user info, host up to a port,
# path, query or fragment.  A URL that does not fit has the empty host and
# path; nothing raises.
HOST_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, HOST_PATTERN, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, PATH_PATTERN, 1)


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Substitute ``${name}`` placeholders of a URL template with columns.

    Placeholders without a value stay as written; the request itself is not
    issued (no HTTP client in a data job).
    """
    out: Column = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("${" + name + "}"), value.cast("string"))
    return out
