"""Text column functions: trimming, slugs, file names, escaping, counting.

Character classes are spelled out because Java's ``\\s`` and ``\\w`` are ASCII
only while the results must follow Unicode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
# the plain range first: most characters are settled by one comparison
NOT_SPACE = r"[!-~[^\s\x0b\x1c-\x1f\x85\p{Z}]]"
_NOT_WORD_SPACE_DASH = r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}-]"


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def bind(value, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_of(c) -> Column:
    """``c`` with null read as the empty string."""
    return F.coalesce(as_col(c), F.lit(""))


def strip(c) -> Column:
    """Remove Unicode white space from both ends."""
    return F.regexp_replace(as_col(c), rf"\A{SPACE}+|{SPACE}+\z", "")


def word_count(c) -> Column:
    return F.regexp_count(as_col(c), F.lit(NOT_SPACE + "+"))


def slugify(title) -> Column:
    """Lower-case dashed slug of at most 60 characters."""
    kept = F.regexp_replace(strip(F.lower(as_col(title))), _NOT_WORD_SPACE_DASH, "")
    dashed = F.regexp_replace(kept, r"[_\s\x0b\x1c-\x1f\x85\p{Z}]+", "-")
    return F.btrim(F.left(dashed, F.lit(60)), F.lit("-"))


def safe_filename(content_type, title) -> Column:
    """``<type>_<title>.md``; unlike a slug, underscores and a cut-off dash stay."""
    kept = strip(F.regexp_replace(as_col(title), _NOT_WORD_SPACE_DASH, ""))
    dashed = F.lower(F.regexp_replace(kept, SPACE + "+", "-"))
    return F.concat(as_col(content_type), F.lit("_"), F.left(dashed, F.lit(60)), F.lit(".md"))


def title_case(c) -> Column:
    """Capitalise the first letter of every run of letters, lower the rest."""
    runs = F.regexp_extract_all(as_col(c), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def xml_escape(c) -> Column:
    out = F.replace(as_col(c), F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def json_string_list(c) -> Column:
    """JSON array text with ``", "`` between the items."""
    quoted = F.transform(
        as_col(c),
        lambda x: F.concat(
            F.lit('"'),
            F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
            F.lit('"'),
        ),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
