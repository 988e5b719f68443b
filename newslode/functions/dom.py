"""The node tree of a page, and CSS selectors over it.

One Arrow function parses a page into balanced nodes. A node is an interval: its own number and that of
its last descendant, so "inside" is a comparison of numbers; its text is a slice of the page's pieces of
text. All else, selectors included, is native functions over these arrays. A selector may be known when
the plan is made (select) or be data, one list for each row (select_by).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import BOILERPLATE, collect_text, first_nonempty, let, merge_blocks, normalize_space, text

_S, _I = T.StringType(), T.IntegerType()
NODE = T.StructType(
    [T.StructField(n, _I) for n in ("ord", "last", "depth", "parent", "prev", "first", "next")]
    + [T.StructField("tag", _S), T.StructField("classes", T.ArrayType(_S)), T.StructField("attrs", T.MapType(_S, _S))]
)
TREE = T.StructType([T.StructField("nodes", T.ArrayType(NODE)), T.StructField("pieces", T.ArrayType(_S))])
ATTR = T.StructType([T.StructField(n, _S) for n in ("name", "op", "value")])
STEP = T.StructType([T.StructField("link", _S), T.StructField("tag", _S), T.StructField("classes", T.ArrayType(_S)), T.StructField("attrs", T.ArrayType(ATTR))])

#: Elements without an end tag, elements whose text nobody reads, and what ends an open element (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "noscript", "template"))
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDED_BY = {"p": BLOCKS | {"li", "dd", "dt", "td", "th", "tr"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)), "option": frozenset(("option",))}
#: An open element is not looked for outside of these.
WALLS = {"li": frozenset(("ul", "ol")), "td": frozenset(("table",)), "th": frozenset(("table",)), "tr": frozenset(("table",))}


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.pieces: list[str] = []
        self.open: list[dict] = []
        self.older: list[int] = [-1]  # of each open level the last child so far

    def handle_starttag(self, tag, attrs):
        for back in range(len(self.open) - 1, -1, -1):
            there = self.open[back]["tag"]
            if tag in ENDED_BY.get(there, ()):
                self.close_to(back)
                break
            if there in WALLS.get(tag, ()) or there in BLOCKS and there != "p":
                break
        own = {k: v if v is not None else "" for k, v in reversed(attrs)}
        n = len(self.nodes)
        node = {"ord": n, "last": n, "depth": len(self.open), "parent": self.open[-1]["ord"] if self.open else -1, "prev": self.older[-1], "first": len(self.pieces), "next": len(self.pieces), "tag": tag, "classes": own.get("class", "").split(), "attrs": own}
        self.older[-1] = n
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.older.append(-1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for back in range(len(self.open) - 1, -1, -1):
            if self.open[back]["tag"] == tag:
                self.close_to(back)
                return

    def close_to(self, back: int) -> None:
        for node in self.open[back:]:
            node["last"], node["next"] = len(self.nodes) - 1, len(self.pieces)
        del self.open[back:], self.older[back + 1 :]

    def handle_data(self, data):
        if not any(n["tag"] in SILENT for n in self.open) and (data := " ".join(data.split())):
            self.pieces.append(data)


#: Nodes of one batch that the parser hands back: whatever the size of the batches it is given, it holds no more trees than that (and the last page's).
BATCH_NODES = 20_000


def _filled(trees: list[_Tree]) -> pa.Array:
    """The trees as one array of TREE, column by column."""
    nodes = [n for t in trees for n in t.nodes]
    starts = lambda sizes: pa.array(list(accumulate(sizes, initial=0)), pa.int32())
    places = [pa.array([n[f.name] for n in nodes], pa.int32()) for f in NODE.fields if f.dataType == _I]
    classes = pa.ListArray.from_arrays(starts(len(n["classes"]) for n in nodes), pa.array([c for n in nodes for c in n["classes"]], pa.string()))
    attrs = pa.MapArray.from_arrays(starts(len(n["attrs"]) for n in nodes), pa.array([k for n in nodes for k in n["attrs"]], pa.string()), pa.array([v for n in nodes for v in n["attrs"].values()], pa.string()))
    rows = pa.StructArray.from_arrays([*places, pa.array([n["tag"] for n in nodes], pa.string()), classes, attrs], [f.name for f in NODE.fields])
    pieces = pa.ListArray.from_arrays(starts(len(t.pieces) for t in trees), pa.array([p for t in trees for p in t.pieces], pa.string()))
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(starts(len(t.nodes) for t in trees), rows), pieces], ["nodes", "pieces"])


@F.arrow_udf(TREE)
def tree(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """nodes (number, last descendant, depth, parent, sibling before, pieces of text, tag, classes, attributes) and pieces of a page. Null is an empty page."""
    for batch in html:
        trees, n = [], 0
        for raw in batch:
            t = _Tree()
            t.feed(raw.as_py() or "")
            t.close()
            t.close_to(0)
            trees.append(t)
            n += len(t.nodes)
            if n >= BATCH_NODES:
                yield _filled(trees)
                trees, n = [], 0
        if trees:
            yield _filled(trees)


# --- Anchors ---------------------------------------------------------------------------------------------------------

ANCHOR = T.StructType([T.StructField("ord", _I), *(T.StructField(n, _S) for n in ("href", "anchor", "title", "snippet", "published")), T.StructField("box", _I)])
#: Containers of an anchor, its own descriptions, classes and marks of a container's summary, and how much of it is taken (fixed values).
BOXES = frozenset(("article", "li", "div", "section"))
TITLES, DESCRIPTIONS = ("data-title", "title", "aria-label"), ("data-description", "data-summary", "aria-description")
SUMMARY_CLASSES, SUMMARY_MARKS = ("summary", "excerpt", "description", "dek", "subhead", "lead", "standfirst"), ("summary", "excerpt", "description")
SNIPPET_CHARS = 360


@F.pandas_udf(T.ArrayType(ANCHOR))
def anchors(html: pd.Series) -> pd.Series:
    """Every anchor with an href: its place, text (or, where it has none, the heading of its container), title, the snippet and
    the first time of its container, and the container's number (0: none). The container is the nearest one around it.

    title: what the anchor says of itself, else the container's heading, else the text. snippet: the anchor's and the container's
    descriptions and the container's paragraphs, else its whole text.
    """
    clean = lambda x: " ".join((x or "").split())

    def cut(x: str) -> str:
        return x if len(x) <= SNIPPET_CHARS else (x[:SNIPPET_CHARS].rsplit(" ", 1)[0] if " " in x[:SNIPPET_CHARS] else x[:SNIPPET_CHARS]).rstrip() + "..."

    def read(raw):
        t = _Tree()
        t.feed(raw or "")
        t.close()
        t.close_to(0)
        told = lambda n: " ".join(t.pieces[n["first"] : n["next"]])
        boxes: dict[int, dict] = {}

        def box_of(n: int) -> dict:
            """What a container tells, read once for all its anchors."""
            if n not in boxes:
                top = t.nodes[n]
                inside = t.nodes[n + 1 : top["last"] + 1]
                first = lambda test: next((x for x in inside if test(x)), None)
                head = first(lambda x: x["tag"] in ("h1", "h2", "h3", "h4", "h5"))
                when = first(lambda x: x["tag"] == "time")
                marks = [first(lambda x, c=c: c in x["classes"]) for c in SUMMARY_CLASSES] + [first(lambda x, c=c: c in x["attrs"].get("data-testid", "")) for c in SUMMARY_MARKS]
                lines, seen = [], set()
                for x in inside:
                    if x["tag"] in ("p", "li") and len(y := told(x)) >= 18 and y.lower() not in seen and not any(b in y.lower() for b in BOILERPLATE):
                        seen.add(y.lower())
                        lines.append(y)
                boxes[n] = {"heading": (clean(head["attrs"].get("aria-label")) or told(head)) if head else "", "plain": told(head) if head else "", "time": (clean(when["attrs"].get("datetime")) or told(when)) if when else "", "parts": [told(x) for x in marks if x and told(x)] + (["\n".join(lines)] if lines else []), "text": told(top)}
            return boxes[n]

        out = []
        for a in t.nodes:
            href = a["attrs"].get("href")
            if a["tag"] != "a" or not href:
                continue
            up = a["parent"]
            while up >= 0 and t.nodes[up]["tag"] not in BOXES:
                up = t.nodes[up]["parent"]
            box = box_of(up) if up >= 0 else None
            text = told(a)
            own = [clean(a["attrs"].get(k)) for k in DESCRIPTIONS if clean(a["attrs"].get(k))]
            blocks: list[str] = []
            for x in map(clean, own + (box["parts"] if box else [])):
                if not any(x.lower() in k.lower() for k in blocks):
                    blocks = [k for k in blocks if k.lower() not in x.lower()] + [x]
            title = next((v for k in TITLES if (v := clean(a["attrs"].get(k)))), "") or (box["heading"] if box else "") or text
            snippet = cut(clean(" ".join(blocks))) if blocks else cut(box["text"]) if box else ""
            out.append({"ord": len(out), "href": href, "anchor": text or (box["plain"] if box else ""), "title": title, "snippet": snippet, "published": box["time"] if box else "", "box": up + 1 if up >= 0 else 0})
        return out

    return html.map(read)


# --- Selectors -------------------------------------------------------------------------------------------------------

_PART = re.compile(r"(?P<tag>[\w-]+|\*)|\.(?P<class>[\w-]+)|#(?P<id>[\w-]+)|\[\s*(?P<name>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?P<q>['\"]?)(?P<value>.*?)(?P=q)\s*)?\]")


def compile_selector(css: str) -> list[dict]:
    """The steps of a selector: link to the step before ("" at the start, " " inside, ">" child, "+" next sibling), tag, classes, attributes. What is no such selector is an error."""
    steps, at, link = [], 0, ""
    css = " ".join(css.split())
    while at < len(css):
        if m := re.compile(r"\s*([>+])\s*|\s+").match(css, at):
            link, at = m[1] or " ", m.end()
            continue
        step = {"link": link if steps else "", "tag": "", "classes": [], "attrs": []}
        began = at
        while at < len(css) and (m := _PART.match(css, at)) and not (m["tag"] and at > began):
            if m["tag"]:
                step["tag"] = "" if m["tag"] == "*" else m["tag"].lower()
            elif m["class"]:
                step["classes"].append(m["class"])
            elif m["id"]:
                step["attrs"].append({"name": "id", "op": "=", "value": m["id"]})
            else:
                step["attrs"].append({"name": m["name"].lower(), "op": m["op"] or "", "value": m["value"] or ""})
            at = m.end()
        if at == began:
            raise ValueError(f"no selector: {css}")
        steps.append(step)
    if not steps:
        raise ValueError("an empty selector")
    return steps


@F.pandas_udf(T.ArrayType(T.ArrayType(STEP)))
def compiled(selectors: pd.Series) -> pd.Series:
    """Lists of selectors compiled, for the small table of profiles; those that are none are left out, as a page has nothing for them."""

    def each(xs):
        out = []
        for x in xs if xs is not None else ():
            try:
                out.append(compile_selector(x))
            except ValueError:
                continue
        return out

    return selectors.map(each)


@F.pandas_udf(T.ArrayType(_S))
def valid_selectors(selectors: pd.Series) -> pd.Series:
    """Of lists of selectors those that compiled() takes."""

    def each(xs):
        out = []
        for x in xs if xs is not None else ():
            try:
                compile_selector(x)
                out.append(x)
            except ValueError:
                continue
        return out

    return selectors.map(each)


def _attr_ok(have: Column, op, value) -> Column:
    """An attribute's test; have is null where the node has no such attribute."""
    op, value = (x if isinstance(x, Column) else F.lit(x) for x in (op, value))
    some = value != ""
    ok = F.when(op == "", True).when(op == "=", have == value).when(op == "*=", some & F.contains(have, value)).when(op == "^=", some & F.startswith(have, value)).when(op == "$=", some & F.endswith(have, value))
    return have.isNotNull() & F.coalesce(ok.when(op == "~=", F.array_contains(F.split(have, r"\s+"), value)).otherwise((have == value) | F.startswith(have, F.concat(value, F.lit("-")))), F.lit(False))


def _linked(link, a: Column, n: Column) -> Column:
    link = link if isinstance(link, Column) else F.lit(link)
    return F.when(link == ">", n["parent"] == a["ord"]).when(link == "+", n["prev"] == a["ord"]).otherwise((n["ord"] > a["ord"]) & (n["ord"] <= a["last"]))


def select(nodes: Column, css: str) -> Column:
    """The nodes of a selector, or of several with commas between them, in the order of the page."""
    parts = [p for p in css.split(",") if p.strip()]
    if len(parts) > 1:
        places = F.flatten(F.array(*[F.transform(select(nodes, p), lambda n: n["ord"]) for p in parts]))
        return let(places, lambda found: F.filter(nodes, lambda n: F.array_contains(found, n["ord"])))
    found = None
    for step in compile_selector(css):
        fits = _fits(step)
        found = F.filter(nodes, fits) if found is None else _after(nodes, found, fits, step["link"])
    return found


def _fits(step: dict):
    def fits(n: Column) -> Column:
        ok = n["tag"] == step["tag"] if step["tag"] else F.lit(True)
        for c in step["classes"]:
            ok = ok & F.array_contains(n["classes"], c)
        for a in step["attrs"]:
            ok = ok & _attr_ok(F.try_element_at(n["attrs"], F.lit(a["name"])), a["op"], a["value"])
        return ok

    return fits


def _after(nodes: Column, found: Column, fits, link: str) -> Column:
    """Of nodes those that fit and are linked to one that was found before."""
    return let(F.transform(found, _place), lambda before: F.filter(nodes, lambda n: fits(n) & F.exists(before, lambda a: _linked(link, a, n))))


def _place(n: Column) -> Column:
    return F.struct(*[n[c].alias(c) for c in ("ord", "last", "first", "next")])


def select_by(nodes: Column, steps: Column) -> Column:
    """The nodes of a compiled selector that is data."""

    def fits(n: Column, s: Column) -> Column:
        own = ((s["tag"] == "") | (n["tag"] == s["tag"])) & F.forall(s["classes"], lambda c: F.array_contains(n["classes"], c))
        return own & F.forall(s["attrs"], lambda a: _attr_ok(F.try_element_at(n["attrs"], a["name"]), a["op"], a["value"]))

    def step(found: Column, s: Column) -> Column:
        return F.filter(nodes, lambda n: fits(n, s) & ((s["link"] == "") | F.exists(found, lambda a: _linked(s["link"], a, n))))

    return F.aggregate(steps, F.filter(nodes, lambda n: F.lit(False)), step)


def text_of(tree_: Column, n: Column) -> Column:
    """All text of a node, pieces joined by a space."""
    return F.array_join(F.slice(tree_["pieces"], n["first"] + 1, n["next"] - n["first"]), " ")


# --- Main text -------------------------------------------------------------------------------------------------------

#: Scopes of the main text in order, places of a lead, and places of dates (fixed values).
BODY_SCOPES = ("article", "main", "[role=main]", ".article-body", ".article-content", ".entry-content", ".post-content", ".story-content", ".content", ".rich-text")
LEADS = ("article h2 + p", "main h1 + p", ".article-content p", ".entry-content p", ".story-content p", ".news-content p")
DATE_PLACES = ("header time", "article time", "main time", "time", "relative-time", "abbr[data-utime]", "[data-testid*='date']", "[class*='publish']", "[class*='updated']", "[class*='date']", "[itemprop='datePublished']", "[itemprop='dateModified']")
DATE_ATTRIBUTES = ("datetime", "content", "data-date", "data-datetime", "title", "aria-label")
META_DATES = ("article:published_time", "og:published_time", "publish-date", "parsely-pub-date", "last-modified", "article:modified_time", "date", "dc.date")
#: Default selectors of an article's body where a source names none (fixed values).
PROFILE_BODY = ("article", "main", "[role=main]", ".article-body", ".article-content", ".story-content", ".news-content", ".entry-content", ".rich-text")

BODY = "struct<text: string, method: string>"


def _told(blocks: Column, scope: Column, tree_: Column, min_len: int = 30) -> Column:
    """The texts of the blocks inside one of the nodes of a scope."""
    inside = F.filter(blocks, lambda b: F.exists(scope, lambda a: (b["ord"] > a["ord"]) & (b["ord"] <= a["last"])))
    return collect_text(F.transform(inside, lambda b: text_of(tree_, b)), min_len)


def _blocks(nodes: Column, *tags: str) -> Column:
    return F.transform(F.filter(nodes, lambda n: n["tag"].isin(*tags)), _place)


def _first_long(named: Column, blocks: Column, tree_: Column, least: Column) -> Column:
    """The text of the first scope that has enough, with its name; named: array of struct(name, nodes). Later scopes are not looked at."""
    none = F.struct(F.lit("").alias("text"), F.lit("").alias("method"))
    return F.aggregate(named, none, lambda got, s: F.when(got["text"] != "", got).otherwise(let(_told(blocks, s["nodes"], tree_), lambda x: F.when(F.length(x) >= least, F.struct(x.alias("text"), s["name"].alias("method"))).otherwise(none))))


def main_text(tree_: Column, least) -> Column:
    """struct(text, method): paragraphs and items of the first scope with enough text, else all paragraphs of forty characters, else nothing."""
    least = least if isinstance(least, Column) else F.lit(least)

    def read(nodes: Column) -> Column:
        named = F.array(*[F.struct(F.lit(f"css:{s}").alias("name"), F.transform(select(nodes, s), _place).alias("nodes")) for s in BODY_SCOPES])
        found = let(_blocks(nodes, "p", "li"), lambda blocks: _first_long(named, blocks, tree_, least))
        rest = let(collect_text(F.transform(_blocks(nodes, "p"), lambda b: text_of(tree_, b)), 40), lambda x: F.struct(x.alias("text"), F.when(x != "", "paragraphs").otherwise("empty").alias("method")))
        return let(found, lambda f: F.when(f["text"] != "", f).otherwise(rest))

    return read(tree_["nodes"])


def profile_text(tree_: Column, selectors: Column, compiled_: Column, least) -> Column:
    """struct(text, method) by a source's own selectors: selectors their names, compiled_ the same compiled."""
    named = F.zip_with(selectors, compiled_, lambda name, steps: F.struct(F.concat(F.lit("profile:"), name).alias("name"), F.transform(select_by(tree_["nodes"], steps), _place).alias("nodes")))
    return let(_blocks(tree_["nodes"], "p", "li"), lambda blocks: _first_long(named, blocks, tree_, least))


def lead_text(tree_: Column) -> Column:
    """The first place of a lead that has text: three nodes of twenty characters at most."""
    nodes = tree_["nodes"]
    leads = F.array(*[F.transform(F.slice(select(nodes, s), 1, 3), _place) for s in LEADS])
    return F.aggregate(leads, F.lit(""), lambda got, ns: F.when(got != "", got).otherwise(collect_text(F.transform(ns, lambda n: text_of(tree_, n)), 20)))


def article_body(tree_: Column, jsonld_body: Column, selectors: Column, compiled_: Column, least, rescue_chars: int = 110, mode: str = "longest_wins") -> Column:
    """struct(text, method): the main text; where it is short, what the source's selectors or the page's metadata say if they say more; where even that
    is under half of what is wanted, all of them together with the lead and every paragraph."""
    least = (least if isinstance(least, Column) else F.lit(least)).cast("int")
    enough = F.greatest(F.lit(60), F.least(least, F.lit(rescue_chars)))

    def rescued(main: Column) -> Column:
        def best(profile: Column) -> Column:
            one = F.when(F.length(profile["text"]) > F.length(main["text"]), F.struct(profile["text"].alias("text"), F.coalesce(F.nullif(profile["method"], F.lit("")), main["method"]).alias("method"))).otherwise(main)
            two = let(one, lambda x: F.when(F.length(jsonld_body) > F.length(x["text"]), F.struct(jsonld_body.alias("text"), F.lit("jsonld_body").alias("method"))).otherwise(x))

            def whole(x: Column) -> Column:
                every = collect_text(F.transform(_blocks(tree_["nodes"], "p"), lambda b: text_of(tree_, b)), 35)
                merged = merge_blocks(x["text"], profile["text"], jsonld_body, lead_text(tree_), every, most=None, mode=mode)
                return let(merged, lambda m: F.when(F.length(m) > F.length(x["text"]), F.struct(m.alias("text"), F.when(x["method"].isin("", "empty"), "paragraphs_rescue").otherwise(x["method"]).alias("method"))).otherwise(x))

            return let(two, lambda x: F.when(F.length(x["text"]) < F.greatest(F.lit(60), F.floor(least / 2)), whole(x)).otherwise(x))

        return let(profile_text(tree_, selectors, compiled_, enough), best)

    return let(main_text(tree_, least), lambda main: F.when(F.length(main["text"]) >= least, main).otherwise(rescued(main)))


def heading(tree_: Column) -> Column:
    """The first h1 that has text, else the first h2."""
    nodes = tree_["nodes"]
    return first_nonempty(*[F.coalesce(F.get(F.filter(F.transform(_blocks(nodes, t), lambda n: text_of(tree_, n)), lambda x: x != ""), F.lit(0)), F.lit("")) for t in ("h1", "h2")])


# --- Dates -----------------------------------------------------------------------------------------------------------


def _value(tree_: Column, n: Column, attributes) -> Column:
    return first_nonempty(*[F.try_element_at(n["attrs"], F.lit(a)) for a in attributes], text_of(tree_, n))


def visible_dates(tree_: Column, most: int = 12) -> Column:
    """Values of the places where pages show dates: of each place its first nodes, the first attribute that tells a date or the text."""
    nodes = tree_["nodes"]
    return F.flatten(F.array(*[F.filter(F.transform(F.slice(select(nodes, s), 1, most), lambda n: _value(tree_, n, DATE_ATTRIBUTES)), lambda v: v != "") for s in DATE_PLACES]))


def node_time(tree_: Column) -> Column:
    """The first date of the article, else of the main part, else of the page: by its time elements, else by any element with a datetime."""
    nodes = tree_["nodes"]
    scope = F.coalesce(F.get(select(nodes, "article"), F.lit(0)), F.get(select(nodes, "main"), F.lit(0)))
    own = F.filter(nodes, lambda n: scope.isNull() | ((n["ord"] > scope["ord"]) & (n["ord"] <= scope["last"])))
    first = lambda tests, attributes: F.coalesce(F.get(F.filter(F.transform(F.filter(own, tests), lambda n: _value(tree_, n, attributes)), lambda v: v != ""), F.lit(0)), F.lit(""))
    return first_nonempty(first(lambda n: n["tag"] == "time", ("datetime", "content", "title")), first(lambda n: F.map_contains_key(n["attrs"], "datetime"), ("datetime", "content")))


def labelled(label: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(label).alias("label"), normalize_space(v).alias("value")))


def meta_dates(tree_: Column) -> Column:
    """label and value of the metadata of the head, in order of trust; of a name the first element with a content."""
    nodes = tree_["nodes"]
    metas = F.filter(nodes, lambda n: n["tag"] == "meta")
    of = lambda key, name: F.get(F.filter(metas, lambda n: F.coalesce(F.try_element_at(n["attrs"], F.lit(key)) == name, F.lit(False))), F.lit(0))
    found = [F.struct(F.lit(f"meta:{name}").alias("label"), normalize_space(F.coalesce(F.try_element_at(F.coalesce(of("property", name), of("name", name))["attrs"], F.lit("content")), F.lit(""))).alias("value")) for name in META_DATES]
    return F.array(*found)


def page_evidence(tree_: Column, jsonld_dates: Column, hint: Column, url_date: Column, metadata: Column | None = None) -> Column:
    """label and value of all a page says of its date, in order of trust, empty values left out. metadata: label and value of what another reader found."""
    groups = [labelled("jsonld", jsonld_dates), meta_dates(tree_), labelled("visible_date_selector", visible_dates(tree_)), labelled("node_time_tags", F.array(node_time(tree_)))]
    if metadata is not None:
        groups.append(metadata)
    groups += [labelled("candidate_published_hint", F.array(text(hint))), labelled("final_url_date", F.array(text(url_date)))]
    return F.filter(F.flatten(F.array(*groups)), lambda e: F.coalesce(e["value"], F.lit("")) != "")
