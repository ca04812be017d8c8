"""Main text of web pages: blocks by markup, boilerplate by a host suffix array.

Blocks inside a page's article are its text. For all other blocks the tokens of a host's pages are laid out as
suffixes, sorted, and compared with their neighbours: tokens in a run shared by several pages are covered. On every page,
with an article or without, a block outside stays if the markup does not name it as something else and part of it is unique.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm.common import arrow_columns
from matchweave.session import stage

#: Tokens of a shared run at least; the covered share at which a block goes; suffixes walked at once.
RUN, COVERED, STRETCH = 8, 0.9, 20_000
#: Pages with shared runs are broadcast (some hundred bytes each) up to this number; beyond it blocks and runs meet in a shuffled join.
BROADCAST_PAGES = 200_000

MAIN = {"article", "main"}
SKIPPED = {"script", "style", "template", "noscript", "svg", "iframe", "object", "canvas", "head", "textarea", "select", "button"}
OTHER = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Kind of what a form or a named wrapper outside articles holds: ruled out, but for an article in it.
WRAPPED = 3
#: Whole words of class, id or role of things that are not the article, alone or in one word with others that only say where or what part.
_noise = regex.compile(
    r"(?:(?:site|page|main|global|top|bottom|left|right|mobile)[-_]+)*(?:(?:ads?|adverts?|advertisements?|banner|sponsor(ed)?|promo(tion)?|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|"
    r"comments?|replies|disqus|respond|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|related|recommended|share|social|"
    r"widget|login|search|contentinfo|complementary)(?:[-_]+|$))+(?:(?:buttons?|bar|box|block|body|item|list|links?|form|area|section|container|wrapper|inner|slot|unit|top|bottom|left|right|[0-9]+)(?:[-_]+|$))*"
)
#: Those whose articles are not the page's own.
_foreign = regex.compile(r"(?:^|[-_])(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promo(?:tion)?|newsletter|comments?|replies|disqus|respond|related|recommended)(?:[-_]|$)")
_tag = regex.compile(r"<!--.*?(?:-->|\z)|<![^>]*+(?:>|\z)|<\?[^>]*+(?:>|\z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+)(?:>|\z)", regex.S)
_attribute = regex.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*+)(?:\"|\z)|'([^']*+)(?:'|\z)|([^\s>]*+)))?", regex.S)
_space = regex.compile(r"\s+")
_separators = regex.compile(r"[\x1c-\x1f]")
_ends = {name: regex.compile(rf"</{name}", regex.I) for name in RAW}
_parts = regex.compile(r"[-_]+")


def _one_space(text: str) -> str:
    """White space as one space, none at the ends. ``str.split`` takes four control characters for spaces as well."""
    return _space.sub(" ", text).strip(" ") if _separators.search(text) else " ".join(text.split())


def _names(attributes: str, inside: bool) -> list[str]:
    """The words of class, id and role that name something other than the article. ``inside`` an article a header is its own."""
    words: list[str] = []
    for name, *values in _attribute.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            words += "".join(values).lower().split()
    if inside:
        words = ["-".join(p for p in _parts.split(w) if p not in ("header", "masthead")) for w in words]
    return [w for w in words if _noise.fullmatch(w)]


def blocks(page: str) -> list[tuple[str, int]]:
    """Text blocks of a page in order, with 2 for those in an article, 1 for undecided ones, 0 for those the markup rules out.

    A block ends where a block element begins or ends, and where what the text is changes.
    """
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and what the text around them is
    open_: dict[str, int] = {}  # how many of each name are open
    kind, at = 1, 0

    def close() -> None:
        if held:
            text = "".join(held)
            held.clear()
            if kind >= 0 and (text := _one_space(html.unescape(text))):
                out.append((text, 0 if kind == WRAPPED else kind))

    def pop() -> str:
        nonlocal kind
        name, before = stack.pop()
        open_[name] -= 1
        if before != kind:
            close()
            kind = before
        return name

    for_tag = _tag.search
    while at < len(page):
        found = for_tag(page, at)
        if found is None:
            held.append(page[at:])
            break
        if found.start() > at:
            held.append(page[at : found.start()])
        at = found.end()
        ended, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS or name in SKIPPED:
            close()
        if ended:
            if open_.get(name):
                while pop() != name:
                    pass
            continue
        if name in VOID or attributes.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in _ended_by_next and stack and stack[-1][0] == name:
            pop()
        stack.append((name, kind))
        open_[name] = open_.get(name, 0) + 1
        now = kind
        if name in SKIPPED or kind < 0:
            now = -1
        elif name in OTHER and not (name == "header" and kind == 2):
            now = WRAPPED if name == "form" and kind in (1, WRAPPED) else 0
        elif name in MAIN and kind in (1, WRAPPED):
            now = 2  # whatever it is named
        elif name not in ("html", "body") and attributes and (named := _names(attributes, kind == 2)):
            now = WRAPPED if kind in (1, WRAPPED) and not any(map(_foreign.search, named)) else 0
        if now != kind:
            close()
            kind = now
        if name in RAW:  # no markup inside
            end = _ends[name].search(page, at)
            stop = end.start() if end else len(page)
            held.append(page[at:stop])
            close()
            at = stop
    close()
    return out


#: Elements that end with the next one of their kind.
_ended_by_next = frozenset(("p", "li", "td", "tr", "dd", "dt", "option"))


BLOCK = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("kind", T.IntegerType())]))


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page_hash, blocks) of each page row."""
    def make():
        return lambda texts: [[[{"text": t, "kind": k} for t, k in blocks(x or "")] for x in texts]]

    keyed = pages.select("page_id", "url", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"), F.xxhash64("page_id", "url", "html").alias("page_hash"), "html")
    return arrow_columns(keyed, "html", [T.StructField("blocks", BLOCK)], make)


def streams(pages: DataFrame) -> DataFrame:
    """(page_hash, host, words, places): tokens of all blocks outside articles, page by page in order, and the block of each."""
    blocks_of = F.transform("blocks", lambda b, k: F.struct(b["kind"].alias("kind"), k.alias("place"), F.split(F.lower(b["text"]), " ").alias("words")))
    outside = F.filter(blocks_of, lambda b: b["kind"] < 2)
    each = pages.select("page_hash", "host", outside.alias("b"))
    places = F.flatten(F.transform("b", lambda b: F.array_repeat(b["place"], F.size(b["words"]))))
    return each.select("page_hash", "host", F.flatten(F.transform("b", lambda b: b["words"])).alias("words"), places.alias("places")).where(F.size("words") >= RUN)


def shared_lengths(run: int, stretch: int):
    """Of suffixes in order, how many leading tokens each shares with a neighbour of another page, from ``run`` on.

    Takes (host, suffix, pages, page), gives (host, suffix, shared). A neighbour of the same page hands on what it
    shares with the next page beyond it. Suffixes are walked in stretches; the last of one begins the next.
    """
    def walk(rows: list[tuple], final: bool) -> pa.RecordBatch:
        words = [r[1].split(" ") for r in rows]
        both = [0]
        for (h, *_), (g, *_), a, b in zip(rows, rows[1:], words, words[1:]):
            n = 0
            if h == g:
                for x, y in zip(a, b):
                    if x != y:
                        break
                    n += 1
            both.append(n)
        best = [len(w) if r[2] > 1 else 0 for r, w in zip(rows, words)]
        for order in (range(1, len(rows)), range(len(rows) - 2, -1, -1)):
            reach = 0
            for i in order:
                j, n = (i - 1, both[i]) if order.step > 0 else (i + 1, both[i + 1])
                reach = n if rows[j][2] > 1 or rows[i][2] > 1 or rows[j][3] != rows[i][3] else min(reach, n)
                best[i] = max(best[i], reach)
        own = [i for i in range(len(rows) if final else len(rows) - 1) if best[i] >= run]
        return pa.RecordBatch.from_arrays([pa.array([rows[i][k] for i in own], pa.string()) for k in (0, 1)] + [pa.array([best[i] for i in own], pa.int32())], ["host", "suffix", "shared"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(4)))
            if len(held) >= stretch:
                yield walk(held, False)
                held = held[-2:]  # the one before keeps its place as a neighbour
        yield walk(held, True)

    return stream


def covered(streamed: DataFrame) -> DataFrame:
    """(page_hash, runs): token runs (first, end) of each page's stream that the host's other pages have as well.

    A suffix can only share a run if its first ``RUN`` tokens are on another page of the host, so places are first counted by a hash of
    those, and only the others become suffixes. These are dealt by the same hash, so that a host of any size is many slices
    of its suffix array; equal suffixes are one row in it with the number of their pages.
    """
    starts = F.sequence(F.lit(1), F.size("words") - RUN + 1)
    places = streamed.where(F.size("words") >= RUN).select("page_hash", "host", "words", F.explode(starts).alias("at"))
    places = places.select("page_hash", "at", F.xxhash64("host", F.slice("words", F.col("at"), RUN)).alias("lead"))
    busy = places.groupBy("lead").agg((F.min("page_hash") != F.max("page_hash")).alias("several")).where("several").select("lead")
    live = places.join(busy, "lead").groupBy("page_hash").agg(F.collect_list(F.struct("at", "lead")).alias("live"))
    each = streamed.join(live, "page_hash").select("page_hash", "host", "words", F.explode("live").alias("l"))
    at = stage(each.select("page_hash", "host", F.col("l.at").alias("at"), F.col("l.lead").alias("lead"), F.array_join(F.slice("words", F.col("l.at"), 2 * RUN), " ").alias("suffix")), "suffixes")
    counted = at.groupBy("host", "lead", "suffix").agg((F.min("page_hash") != F.max("page_hash")).alias("several"), F.min("page_hash").alias("page"))
    array = counted.select("host", "suffix", F.when(F.col("several"), 2).otherwise(1).alias("pages"), "page", "lead").repartition("lead")
    shared = array.sortWithinPartitions("host", "suffix").select("host", "suffix", "pages", "page").mapInArrow(shared_lengths(RUN, STRETCH), "host string, suffix string, shared int")
    shared = shared.groupBy("host", "suffix").agg(F.max("shared").alias("shared"))  # the first of a stretch was the last but one before
    runs = at.join(shared, ["host", "suffix"]).groupBy("page_hash").agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("shared")).alias("b")))).alias("runs"))
    empty = F.expr("named_struct('done', cast(array() as array<struct<a:int,b:int>>), 'a', -1, 'b', -1)")

    def step(s, x):
        joined = F.struct(s["done"].alias("done"), s["a"].alias("a"), F.greatest(s["b"], x["b"]).alias("b"))
        fresh = F.struct(F.when(s["a"] < 0, s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(s["a"].alias("a"), s["b"].alias("b"))))).alias("done"), x["a"].alias("a"), x["b"].alias("b"))
        return F.when((s["a"] >= 0) & (x["a"] <= s["b"]), joined).otherwise(fresh)

    return runs.select("page_hash", F.aggregate("runs", empty, step, lambda s: F.concat(s["done"], F.array(F.struct(s["a"].alias("a"), s["b"].alias("b"))))).alias("runs"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_outside, n_shared) of each row of ``pages`` (page_id, url, html).

    The text is what stands in the page's article, and of the blocks outside it, or of all without one, those that the markup
    does not rule out and that are not covered, to nine tenths, by runs that other pages of the host have as well; if that leaves
    nothing, the undecided blocks with their covered ones. n_outside counts the tokens outside the article, n_shared those in
    shared runs. Null and empty pages have an empty text; rows repeat as given, copies of a page being one page;
    a null or odd url is a host of its own, the empty one; an empty table gives none.
    """
    found = parsed(pages)
    streamed = stage(streams(found).dropDuplicates(["page_hash"]), "streams")
    by_page = streamed.join(covered(streamed), "page_hash")
    hits = F.flatten(F.transform("runs", lambda r: F.slice("places", r["a"], r["b"] - r["a"])))
    by_page = stage(by_page.select(F.col("page_hash").alias("hash"), hits.alias("hits")), "hits")
    few = by_page.count() <= BROADCAST_PAGES
    joined = found.join(F.broadcast(by_page) if few else by_page, found["page_hash"] == by_page["hash"], "left")
    none = F.expr("cast(array() as array<int>)")
    marked = joined.select("page_id", "url", F.coalesce("hits", none).alias("hits"), F.transform("blocks", lambda b, k: F.struct(b["text"].alias("text"), b["kind"].alias("kind"), k.alias("k"), F.size(F.split(b["text"], " ")).alias("n"))).alias("blocks"))
    open_ = F.filter("blocks", lambda b: b["kind"] == 1)
    unique = lambda b: F.size(F.filter("hits", lambda x: x == b["k"])) < F.lit(COVERED) * b["n"]
    own = F.filter("blocks", lambda b: (b["kind"] == 2) | (b["kind"] == 1) & unique(b))
    chosen = F.when(F.size(own) > 0, own).otherwise(open_)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n")
    outside = F.aggregate(F.filter("blocks", lambda b: b["kind"] < 2), F.lit(0).cast("long"), lambda s, b: s + b["n"])
    done = marked.select("page_id", "url", text.alias("text"), outside.alias("n_outside"), F.size("hits").cast("long").alias("n_shared"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_outside", "n_shared")
