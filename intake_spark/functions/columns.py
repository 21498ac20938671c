"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Country spellings that mean another.
COUNTRY_ALIASES = {
    "us": "united states", "usa": "united states", "u.s.": "united states", "u.s.a.": "united states", "united states of america": "united states", "america": "united states",
    "uk": "united kingdom", "u.k.": "united kingdom", "great britain": "united kingdom", "britain": "united kingdom", "england": "united kingdom", "scotland": "united kingdom",
    "wales": "united kingdom", "northern ireland": "united kingdom", "ca": "canada",
}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, use) -> Column:
    """use(c) with c computed once, however often it is used, and wherever the optimiser moves the expression."""
    return F.try_element_at(F.transform(F.array(c), use), F.lit(1))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c != "", c)


def first_filled(*columns: Column | str) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in columns])


def normalize_domain(c: Column | str, mode: str = "strict") -> Column:
    """Host of an address: lower case, no scheme, path, query, or leading www.

    strict also drops user info, port, fragment and outer dots, and is null without a dot. crm leaves those in and gives the empty string.
    site only knows http and https and is null without a dot.
    """
    c = F.lower(strip(c))
    cut = lambda x, mark: F.substring_index(x, mark, 1)
    no_www = lambda x: F.regexp_replace(x, r"^www\.", "")
    with_dot = lambda x: F.when(F.contains(x, F.lit(".")), x)
    if mode == "crm":
        return no_www(cut(cut(F.regexp_replace(F.coalesce(c, F.lit("")), "^[a-z]+://", ""), "/"), "?"))
    if mode == "site":
        return with_dot(no_www(cut(F.regexp_replace(F.regexp_replace(c, "^https://", ""), "^http://", ""), "/")))
    host = cut(cut(cut(F.regexp_replace(c, r"^[a-z][a-z0-9+.-]*://", ""), "/"), "?"), "#")
    host = F.regexp_replace(cut(F.substring_index(host, "@", -1), ":"), r"^\.+|\.+$", "")
    return with_dot(no_www(host))


def to_int(c: Column | str) -> Column:
    """Whole part of a number as it is typed: commas are dropped, anything else than a number is null."""
    number = F.regexp_replace(as_col(c).cast("string"), ",", "").try_cast("double")
    return F.when(F.abs(number) < 9.2e18, number.cast("bigint"))


def employees(c: Column | str) -> Column:
    n = to_int(c)
    return F.when(n > 0, n)


def to_list(c: Column | str) -> Column:
    """An array without nulls and blanks; null if nothing is left."""
    kept = F.filter(as_col(c), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept)


def country(c: Column | str) -> Column:
    """Lower-case country name with known spellings folded; empty for null."""
    plain = F.coalesce(F.lower(strip(c)), F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in COUNTRY_ALIASES.items() for x in pair])
    return F.coalesce(names[plain], plain)


def is_json_object(c: Column | str) -> Column:
    """Whether the text is one JSON object and nothing else. Spark's parsers stop at the end of the first value, so the text is parsed as
    the first of two members: whatever follows it spoils the second."""
    members = lambda x: F.json_object_keys(F.concat(F.lit('{"row":'), x, F.lit(',"end":1}')))
    good = lambda x: F.startswith(x, F.lit("{")) & F.coalesce(members(x) == F.array(F.lit("row"), F.lit("end")), F.lit(False))
    return let(strip(c), good)


def search_signals(**values) -> Column:
    """A map of what every row of a search has matched on; empty values are left out."""
    given = {k: v if isinstance(v, str) else ", ".join(v) for k, v in values.items() if v}
    if not given:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in given.items() for x in pair])


def strip_verdict(c: Column | str) -> Column:
    """Prose without a closing JSON line and the fences around it."""
    text = F.regexp_replace(as_col(c), r"(?U)\s+$", "")
    text = F.regexp_replace(text, r"(?:^|\n)[ \t`]*\{[^\n]*$", "")
    return F.concat(F.regexp_replace(F.regexp_replace(text, r"(?:(?:^|\n)[ \t]*(?:```(?:json)?)?[ \t]*)+$", ""), r"(?U)\s+$", ""), F.lit("\n"))


def page_name(url: Column | str) -> Column:
    """File-safe name of host and path; one of over 90 characters is cut to 80, and a hash of the address keeps it apart from others."""
    u = as_col(url)
    place = F.regexp_replace(F.concat(F.coalesce(F.try_parse_url(u, F.lit("HOST")), F.lit("")), F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit(""))), "^/+|/+$", "")
    name = F.regexp_replace(F.regexp_replace(place, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    short = lambda x: F.when(F.length(x) > 90, F.concat(F.left(x, F.lit(80)), F.lit("-"), F.left(F.sha1(u), F.lit(8)))).otherwise(x)
    return F.when(name != "", let(name, short)).otherwise("index")


def reset_wait(message: Column | str, now: Column) -> Column:
    """Seconds from now until the reset time that a limit message names: an epoch after a bar, or a clock time (the next such time)."""
    text = F.coalesce(as_col(message), F.lit(""))
    epoch = F.regexp_extract(text, r"\|(\d{10})\b", 1).try_cast("bigint")
    # How a message names an epoch or a clock time.
    clock = lambda i: F.regexp_extract(text, r"(?i)resets?(?:\s+at)?\s+(\d{1,2})(?::(\d{2}))?\s*(am|pm)?", i)
    hour, minute, half = clock(1).try_cast("int"), F.coalesce(clock(2).try_cast("int"), F.lit(0)), F.lower(clock(3))
    hour = F.when((half == "pm") & (hour != 12), hour + 12).when((half == "am") & (hour == 12), 0).otherwise(hour)
    at = F.when((hour <= 23) & (minute <= 59), F.unix_timestamp(F.date_trunc("day", now)) + hour * 3600 + minute * 60)
    since = F.unix_timestamp(now)
    return F.when(epoch.isNotNull(), F.greatest(F.lit(0), epoch - since)).otherwise(F.when(at <= since, at + 86400 - since).otherwise(at - since)).cast("double")
