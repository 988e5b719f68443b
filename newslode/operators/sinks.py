"""Sinks: new and repeated rows, alert rows, audit lines, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import text, truncate
from .ranking import best_by


def first_of_each(rows: DataFrame, key: str = "UniqueKey", ord_: str = "ord") -> DataFrame:
    return best_by(rows, [key], [-F.col(ord_)])


def new_rows(rows: DataFrame, existing: DataFrame, key: str = "UniqueKey", ord_: str = "ord") -> DataFrame:
    """The first row of each key that the sink doesn't hold."""
    return first_of_each(rows, key, ord_).join(existing.select(key).distinct(), key, "left_anti")


def duplicate_rows(rows: DataFrame, existing: DataFrame, key: str = "UniqueKey", ord_: str = "ord") -> DataFrame:
    """Rows whose key the sink holds, and later rows of a key in the same batch."""
    created = new_rows(rows, existing, key, ord_).select(key, ord_)
    return rows.join(created, [key, ord_], "left_anti")


def append_new(rows: DataFrame, path: str, existing: DataFrame) -> None:
    new_rows(rows, existing).write.mode("append").parquet(path)


def alert_rows(created: DataFrame, duplicates: DataFrame, generated: DataFrame, mode: str) -> DataFrame:
    if mode == "all_generated":
        return generated
    if mode == "created_or_duplicates" and created.isEmpty():
        return duplicates
    return created


def counters(created: DataFrame, duplicates: DataFrame) -> DataFrame:
    both = created.select(F.lit("created").alias("what")).unionByName(duplicates.select(F.lit("skipped").alias("what")))
    return both.agg(F.count_if(F.col("what") == "created").alias("created"), F.count_if(F.col("what") == "skipped").alias("skipped"), F.count("*").alias("total"))


def legacy_fields(articles: DataFrame) -> DataFrame:
    return articles.select(truncate("title", 250).alias("Title"), F.substring(text("published_at"), 1, 10).alias("BriefDate"), F.col("source_name").alias("SourceName"), F.col("source_url").alias("SourceUrl"), text("published_at").alias("PublishedAt"), truncate("author", 255).alias("ArticleAuthor"), F.col("scope").alias("Metal"), truncate("body_text", 12_000).alias("RawExcerpt"), F.col("fetch_method").alias("FetchMethod"), F.array_join("warnings", "\n").alias("Warnings"))


def write_audit(events: DataFrame, path: str) -> None:
    """One JSON object a line, a folder for each run."""
    events.write.mode("append").partitionBy("run_id").json(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def warnings_map(warnings):
    """map of `key:value` warnings, the first of each key."""
    pairs = F.filter(warnings, lambda w: F.contains(w, F.lit(":")))
    entries = F.transform(pairs, lambda w: F.struct(F.trim(F.substring_index(w, ":", 1)).alias("key"), F.trim(F.regexp_replace(w, "^[^:]*:", "")).alias("value")))
    firsts = F.aggregate(entries, F.array().cast("array<struct<key:string,value:string>>"), lambda kept, e: F.when(F.exists(kept, lambda k: k["key"] == e["key"]), kept).otherwise(F.concat(kept, F.array(e))))
    return F.map_from_entries(firsts)


def warning_value(warnings, prefix: str, default: str = ""):
    return F.coalesce(F.try_element_at(warnings_map(warnings), F.lit(prefix)), F.lit(default))
