"""URL column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, text_of

#: Sports in the order they are looked for.
SPORTS = ("nba", "ncaab", "nfl", "mlb", "nhl")


def host_of(url) -> Column:
    """Host name, null for a URL that does not parse."""
    return F.try_parse_url(as_col(url), F.lit("HOST"))


def path_of(url) -> Column:
    """Everything after scheme and host, as sent to the server."""
    return F.regexp_replace(as_col(url), r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")


def resolve_link(href, base_url, page_url) -> Column:
    """Absolute URL of a card's link.

    Only root-relative and absolute links resolve; anything else, including a
    missing link, falls back to the page's own URL.
    """
    link = text_of(href)
    return (
        F.when(link.startswith("/"), F.concat(as_col(base_url), link))
        .when(link.startswith("http"), link)
        .otherwise(as_col(page_url))
    )


def sport_from_path(path) -> Column:
    """First listed sport that occurs anywhere in the path, upper-cased."""
    low = F.lower(as_col(path))
    found = F.lit("UNKNOWN")
    for sport in reversed(SPORTS):
        found = F.when(F.contains(low, F.lit(sport)), F.lit(sport.upper())).otherwise(found)
    return found


def decoded(url) -> Column:
    """Percent-decoded text; ``+`` and broken escapes stay as they are."""
    safe = F.regexp_replace(as_col(url), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B"))), as_col(url))
