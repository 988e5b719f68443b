"""Dates: a list of formats, a run date from outside, and null where a text is not one date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RELATIVE_DAYS
from .text import let, any_of, normalize_space, text
from .url import same_day_url

FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")


def parse_date(x) -> Column:
    """Timestamp in UTC of a date written in full; anything else is null."""
    x = F.regexp_replace(normalize_space(x), "^[A-Za-z]{3,9}, (?=\\d)", "")  # a day's name before the date
    # No format takes a text without digits or of more than 128 characters; the formats are not tried on these.
    return let(x, lambda v: F.when((F.length(v) <= 128) & F.regexp_like(v, F.lit("[0-9]")), F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in FORMATS])))


def iso(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))


def parse_iso(x) -> Column:
    return iso(parse_date(x))


def date_or(x, run_date: str) -> Column:
    return F.coalesce(F.to_date(parse_date(x)), F.lit(run_date).cast("date"))


def days_from(x, target_date: str) -> Column:
    """Days between the first ten characters and the day; 999 if they are no date."""
    day = F.to_date(F.try_to_timestamp(F.substring(text(x), 1, 10), F.lit("yyyy-MM-dd")))
    return F.coalesce(F.abs(F.datediff(day, F.lit(target_date).cast("date"))), F.lit(999))


def relative_hint(hint) -> Column:
    return any_of(F.lower(normalize_space(hint)), RELATIVE_DAYS)


def hint_matches(hint, target_date: str, run_date: str) -> Column:
    """A relative word matches if the day is the run's; else the date has to be the day."""

    def matches(x: Column) -> Column:
        relative = any_of(F.lower(x), (*RELATIVE_DAYS, "moments ago"))
        return F.when(x == "", False).when(relative, F.lit(target_date == run_date)).otherwise(F.coalesce(F.to_date(parse_date(x)) == F.lit(target_date).cast("date"), F.lit(False)))

    return let(normalize_space(hint), matches)


def candidate_same_day(hint, url, target_date: str, run_date: str) -> Column:
    return hint_matches(hint, target_date, run_date) | same_day_url(url, target_date)


def recent_enough(published, target_date: str | None, allow_missing: bool = False) -> Column:
    if not target_date:
        return F.lit(True)
    return F.when(text(published) == "", F.lit(allow_missing)).otherwise(F.substring(text(published), 1, 10) == target_date)


def article_same_day(published, hint, target_date: str, run_date: str) -> Column:
    return (F.substring(text(published), 1, 10) == target_date) | hint_matches(hint, target_date, run_date)


def query_tokens(target_date: str) -> Column:
    day = F.lit(target_date).cast("date")
    return F.array(F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "MMMM d, yyyy"), F.date_format(day, "MMM d, yyyy"), F.lit("today"))


def date_evidence(found: list[tuple[str, Column]], target_date: str, run_date: str) -> Column:
    """ranked_evidence of (label, value) columns in order of trust."""
    return ranked_evidence(F.array(*[F.struct(F.lit(k).alias("label"), text(v).alias("value")) for k, v in found]), target_date, run_date)


def ranked_evidence(found: Column, target_date: str, run_date: str, visible: Column | None = None) -> Column:
    """The first value that is on the day, else the first that is a date.

    found: array of struct(label, value) in order of trust. visible: all text of the page, whose relative words count
    when nothing else is on the day. Returns struct(published_at, same_day, checked): checked are the labels up to the match.
    """
    judged = F.transform(F.filter(found, lambda s: s["value"] != ""), lambda s: F.struct(s["label"].alias("label"), parse_date(s["value"]).alias("ts"), hint_matches(s["value"], target_date, run_date).alias("hit")))

    def pick(items: Column) -> Column:
        at = F.array_position(F.transform(items, lambda s: s["hit"]), F.lit(True)).cast("int")
        dated = F.get(F.filter(items, lambda s: s["ts"].isNotNull()), F.lit(0))["ts"]
        hit = F.get(items, at - 1)
        best = F.when(at > 0, F.coalesce(hit["ts"], F.lit(target_date).cast("timestamp"))).otherwise(dated)
        seen = F.transform(F.slice(items, F.lit(1), F.when(at > 0, at).otherwise(F.size(items))), lambda s: s["label"])
        told = F.when(at > 0, F.lit(False)).otherwise(hint_matches(visible, target_date, run_date)) if visible is not None else F.lit(False)

        def result(told: Column) -> Column:
            last = F.when(told, F.array(F.lit("visible_relative_text"))).otherwise(F.array().cast("array<string>"))
            return F.struct(iso(best).alias("published_at"), ((at > 0) | told).alias("same_day"), F.concat(seen, last).alias("checked"))

        return let(told, result)

    return let(judged, pick)
