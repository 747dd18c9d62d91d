"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them, so they are kept together here.
LINK_HOST = "https://www.reddit.com"
DETAIL_SUFFIX = ".json"
DESCRIPTION_CHARS = 269
MAX_PAGE_SIZE = 100
DEAD_STATUSES = (400, 401, 403, 404, 407, 410)
TEMPORARY_STATUSES = (408, 429, 500, 502, 503, 504, 520, 522, 524)
COOLDOWN_BASE_SECONDS = 300
COOLDOWN_CAP = 6
DEAD_AFTER_FAILURES = 7

# Unicode white space plus the four ASCII separators that Python also strips.
_BLANKS = r"[\s\x1c-\x1f]+"


def present(column: Column) -> Column:
    """True for a non-empty string, false for null and ''."""
    return F.coalesce(F.length(column) > 0, F.lit(False))


def post_key(id_col: Column, permalink: Column) -> Column:
    """Identity of a post: its id, else its permalink, else ''."""
    return F.coalesce(F.nullif(id_col, F.lit("")), permalink, F.lit(""))


def post_link(permalink: Column, url: Column, host: str = LINK_HOST) -> Column:
    return F.when(present(permalink), F.concat(F.lit(host), permalink)).otherwise(F.coalesce(url, F.lit("")))


def post_description(selftext: Column) -> Column:
    return F.substring(F.coalesce(selftext, F.lit("")), 1, DESCRIPTION_CHARS)


def detail_url(permalink: Column, host: str = LINK_HOST) -> Column:
    return F.concat(F.lit(host), permalink, F.lit(DETAIL_SUFFIX))


def normalize_endpoint(line: Column) -> Column:
    """Strip blanks; '' stays ''; add ``http://`` unless a scheme is there (case-sensitive)."""
    bare = F.regexp_replace(line, f"(?U)^{_BLANKS}|{_BLANKS}$", "")
    has_scheme = bare.startswith("http://") | bare.startswith("https://")
    return F.when((bare == "") | has_scheme, bare).otherwise(F.concat(F.lit("http://"), bare))


def classify_failure(status: Column) -> Column:
    """``dead`` or ``temporary`` for an HTTP status; a missing status (connection error) is temporary."""
    return (
        F.when(status.isNull() | status.isin(*TEMPORARY_STATUSES), "temporary")
        .when(status.isin(*DEAD_STATUSES), "dead")
        .when(status >= 500, "temporary")
        .otherwise("dead")
    )


def cooldown_seconds(failures: Column, base: int = COOLDOWN_BASE_SECONDS, cap: int = COOLDOWN_CAP) -> Column:
    return F.least(failures, F.lit(cap)) * F.lit(base)


def clamp_page_size(size: int) -> int:
    return max(1, min(size, MAX_PAGE_SIZE))


def words(text: Column) -> Column:
    """Lower-case words of letters, their marks and digits of any script; everything else separates words."""
    return F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
