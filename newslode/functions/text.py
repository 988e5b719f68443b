"""Text columns: white space, truncation, merging, splitting, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lines that no article text is made of (fixed values).
BOILERPLATE = ("advertisement", "newsletter", "sign up", "related articles", "read more", "follow us", "purchase licensing rights", "request a demo", "subscribe")


def as_col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(df, **columns: Column):
    """df with the columns computed once. A generator of one row stands between: the optimiser merges no later
    expression into it, so what follows reads values and the plan stays small."""
    keep = [c for c in df.columns if c not in columns]
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("bound")
    return df.select(*keep, one).select(*keep, *[F.col(f"bound.{n}").alias(n) for n in columns])


def text(x) -> Column:
    """Missing is empty."""
    return F.coalesce(as_col(x).cast("string"), F.lit(""))


def normalize_space(x) -> Column:
    # A single plain space stays as it is, so that nothing is replaced between most words.
    return F.trim(F.regexp_replace(text(x), r"(?U) \s+|[\s&&[^ ]]\s*", " "))


def first_nonempty(*xs) -> Column:
    return F.coalesce(*[F.nullif(normalize_space(x), F.lit("")) for x in xs], F.lit(""))


def truncate_text(x, most: int) -> Column:
    """Cut at the last space before `most` characters, with dots."""

    def cut(x: Column) -> Column:
        head = F.substring(x, 1, most)
        return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(F.when(F.instr(head, " ") > 0, F.regexp_replace(head, " [^ ]*$", "")).otherwise(head)), F.lit("...")))

    return let(normalize_space(x), cut)


def truncate(x, most: int) -> Column:
    """For sinks: cut at `most` characters and add dots."""

    def cut(x: Column) -> Column:
        return F.when(F.length(x) <= most, x).otherwise(F.concat(F.regexp_replace(F.substring(x, 1, most), r"(?U)\s+$", ""), F.lit("...")))

    return cut(text(x)) if isinstance(x, str) else let(text(x), cut)


def merge_blocks(*xs, most: int | None = 16_000, mode: str = "longest_wins") -> Column:
    """Join blocks by an empty line, leaving out those that others hold; with most None whole.

    first_wins leaves a later block out if it holds an earlier one or is held by it;
    longest_wins replaces the earlier block by a later one that holds it.
    """
    blocks = F.filter(F.array(*[F.struct(x.alias("own"), F.lower(x).alias("low")) for x in map(normalize_space, xs)]), lambda b: b["own"] != "")

    def step(kept: Column, b: Column) -> Column:
        inside = F.exists(kept, lambda k: F.contains(k["low"], b["low"]))
        holds = F.exists(kept, lambda k: F.contains(b["low"], k["low"]))
        if mode == "first_wins":
            return F.when(inside | holds, kept).otherwise(F.concat(kept, F.array(b)))
        return F.when(inside, kept).otherwise(F.concat(F.filter(kept, lambda k: ~F.contains(b["low"], k["low"])), F.array(b)))

    def cut(joined: Column) -> Column:
        return F.when(F.length(joined) <= most, joined).otherwise(F.trim(F.regexp_replace(F.substring(joined, 1, most), " [^ ]*$", "")))

    kept = F.aggregate(blocks, F.array().cast("array<struct<own:string,low:string>>"), step)
    joined = F.array_join(kept["own"], "\n\n")
    return joined if most is None else let(joined, cut)


def distinct_by(array: Column, key) -> Column:
    """First of each key, in order: the keys are computed once and sorted, not compared each with all."""
    placed = F.sort_array(F.transform(array, lambda x, i: F.struct(key(x).alias("k"), F.struct(i.alias("i"), x.alias("x")).alias("v"))))
    firsts = let(placed, lambda p: F.filter(p, lambda s, j: (j == 0) | (s["k"] != F.get(p, j - 1)["k"])))
    return F.sort_array(firsts["v"])["x"]


def collect_text(nodes: Column, min_len: int = 30, boilerplate: tuple[str, ...] = BOILERPLATE) -> Column:
    """Node texts long enough and without boilerplate, first of each regardless of case, one a line."""
    clean = F.filter(F.transform(nodes, normalize_space), lambda n: (F.length(n) >= min_len) & ~any_of(F.lower(n), boilerplate))
    return F.array_join(distinct_by(clean, F.lower), "\n")


def any_of(x: Column, terms) -> Column:
    """x is computed for each term; where that costs much, let() binds it first."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(x, F.lit(t))
    return out


def dedupe(array: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(array, normalize_space), lambda x: x != ""))


def dedupe_lower(array: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(array, lambda x: F.lower(normalize_space(x))), lambda x: x != ""))


def unique_nonempty(array: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(array, lambda x: F.trim(text(x))), lambda x: x != ""))


def sentences(x) -> Column:
    return F.filter(F.transform(F.split(text(x), r"(?<=[.!?])\s+"), normalize_space), lambda s: s != "")


def structured_points(x) -> Column:
    """Lines without bullets, or what semicolons separate if there is one line; first of each."""
    raw = F.trim(text(x))
    clean = lambda s: normalize_space(F.regexp_replace(s, "^[-*•· ]+", ""))
    return let(dedupe(F.transform(F.split(raw, r"[\r\n]+"), clean)), lambda lines: F.when(F.size(lines) > 0, lines).otherwise(dedupe(F.split(raw, r"\s*;\s*"))))


def escape_html(x) -> Column:
    out = text(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def htmlize(x) -> Column:
    return F.replace(escape_html(x), F.lit("\n"), F.lit("<br>"))


def parse_list(x, separators: str = ";,", lower: bool = False) -> Column:
    parts = F.filter(F.transform(F.split(text(x), f"[{separators}]"), F.trim), lambda p: p != "")
    return F.array_distinct(F.transform(parts, F.lower)) if lower else parts


def parse_names(x) -> Column:
    return parse_list(x, "\\n,;", lower=True)


def strip_fences(x) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text(x)), r"^```[A-Za-z0-9_-]*\s*", ""), r"\s*```$", ""))


def stable_key(*parts) -> Column:
    return F.substring(F.sha2(F.concat_ws("||", *[F.lower(F.trim(text(p))) for p in parts]), 256), 1, 40)
