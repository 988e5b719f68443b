"""Work and memory of the page functions grow with the page, not with its square or the size of a batch."""

import time

import pyarrow as pa
from pyspark.sql import functions as F

from newslode.functions import dates, dom, text


def test_many_lines_of_one_page(spark):
    """Every line was compared with all lines, each computed anew."""
    lines = [f"Line number {i % 3000} of a page that is long enough to be kept" for i in range(4000)]
    began = time.time()
    got = spark.createDataFrame([(lines,)], "xs array<string>").select(text.collect_text(F.col("xs"))).first()[0]
    assert got.split("\n") == lines[:3000]
    assert time.time() - began < 15


def test_first_of_each_key_in_order(spark):
    rows = spark.createDataFrame([(["b", "A", "a", "B", "c", "b"],), ([],), (None,)], "xs array<string>")
    assert [r[0] for r in rows.select(text.distinct_by(F.col("xs"), F.lower)).collect()] == [["b", "A", "c"], [], None]


def test_trees_leave_the_parser_in_small_batches():
    """All trees of a batch, of ten thousand pages at most, were held at once."""
    page = "<div>" + "<p class='a b' id=x>word</p>" * 99 + "</div>"
    got = list(dom.tree.func(iter([pa.array([page] * 900 + [None])])))
    assert len(got) == 5 and sum(map(len, got)) == 901
    assert max(sum(len(r["nodes"]) for r in b.to_pylist()) for b in got) <= dom.BATCH_NODES
    one = got[0][0].as_py()
    assert one["pieces"] == ["word"] * 99 and one["nodes"][1]["classes"] == ["a", "b"] and dict(one["nodes"][1]["attrs"]) == {"class": "a b", "id": "x"}
    assert got[-1][-1].as_py() == {"nodes": [], "pieces": []}


def test_no_date_is_looked_for_where_none_can_be(spark):
    rows = spark.createDataFrame([("Tue, 7 April 2026",), ("no digit",), ("7 April 2026 " + "x" * 200,), (None,)], "x string")
    assert [str(r[0]) if r[0] else None for r in rows.select(dates.parse_date("x")).collect()] == ["2026-04-07 00:00:00", None, None, None]


def test_a_summary_splits_its_body_once(spark):
    """The body was split anew for each part of a summary, and lower-cased for each term."""
    from newslode.operators import summary

    rows = spark.createDataFrame([("t", "b")], "title string, body string").select(summary.rule_summary("title", "body").alias("s"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("lower(") <= 5


def test_white_space_is_made_alike(spark):
    rows = ["a b", " a  b ", "a\tb", "a \tb", "a\t b  c", "\n a\n", "", None, "a　 b"]
    import re

    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(text.normalize_space("x")).collect()]
    assert got == [re.sub(r"\s+", " ", x or "").strip(" ") for x in rows]
