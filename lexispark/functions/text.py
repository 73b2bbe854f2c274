"""Column functions over strings and dates: normalization, escaping, identifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c evaluated once: expressions in lambdas are not shared, so each use would be evaluated anew."""
    return F.get(F.transform(F.array(c), f), 0)


def norm_str(c: Column) -> Column:
    """Without white space at both ends; null where nothing is left."""
    return F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def norm_strs(c: Column) -> Column:
    """Array of normalized strings without the empty ones."""
    return F.filter(F.transform(c, norm_str), lambda x: x.isNotNull())


def norm_str_set(c: Column) -> Column:
    """Distinct normalized strings, sorted; null where none is left."""
    found = F.array_sort(F.array_distinct(norm_strs(c)))
    return F.when(F.size(found) > 0, found)


def join_strs(c: Column, sep: str) -> Column:
    return F.nullif(F.array_join(norm_strs(c), sep), F.lit(""))


def norm_title(c: Column) -> Column:
    """A full stop after another punctuation mark is dropped."""
    return F.regexp_replace(c, r"([!,\-./:;?\[\]{}])\.", "$1")


def tag_list(c: Column, separators: str = r"[:\s]") -> Column:
    """Sorted non-empty parts."""
    return F.array_sort(F.filter(F.split(c, separators), lambda x: F.trim(x) != ""))


def tags_json(c: Column) -> Column:
    return F.to_json(tag_list(c))


def norm_date(c: Column) -> Column:
    """A date; null for years, months of a year and what is no date."""
    s = norm_str(c)
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "dd.MM.yyyy", "yyyy/MM/dd", "yyyyMMdd", "d MMMM yyyy")])
    return F.when(s.rlike(r"^[0-9]{4}(-[0-9]{2})?$"), F.lit(None).cast("date")).otherwise(parsed)


def norm_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"([0-9]{4})", 1), F.lit("")).cast("int")


def date_to_year(c: Column) -> Column:
    """The leading four digits."""
    return F.nullif(F.regexp_extract(c, r"^([0-9]{4})", 1), F.lit("")).cast("int")


def valid_date(c: Column) -> Column:
    """The string itself if it is an ISO date."""
    return F.when(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull(), c)


def format_date(c: Column) -> Column:
    return F.date_format(c, "dd.MM.yyyy")


def url_quote(c: Column) -> Column:
    """Percent-encoding that leaves slashes."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def doc_urn(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"urn:{kind}:"), F.concat_ws(":", *parts))


def escape_token(c: Column) -> Column:
    """For a pre-analyzed token: backslash first, then what separates tokens and attributes."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for sign in (" ", ",", "=", "\n", "\r", "\t"):
        shown = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}.get(sign, "\\" + sign)
        out = F.replace(out, F.lit(sign), F.lit(shown))
    return out


def escape_stored(c: Column) -> Column:
    """For the stored text of a pre-analyzed field."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("="), F.lit("\\="))


def socket_term(c: Column) -> Column:
    """A quoted term of the socket query language."""
    return F.regexp_replace(c, r"(['\\])", r"\\$1")


def rest_term(c: Column) -> Column:
    """A term of the REST query language: signs with a meaning are dropped."""
    return F.translate(c, ' ()#,"', "")


def socket_command(*parts: Column) -> Column:
    return F.concat_ws("\x01", *parts)


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def merged_maps(*maps: Column) -> Column:
    """Later maps win, whatever spark.sql.mapKeyDedupPolicy says."""
    out = maps[0]
    for m in maps[1:]:
        out = F.map_concat(_without(out, m), m)
    return out


def _without(a: Column, b: Column) -> Column:
    return F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k))
