"""Main text of web pages by consensus host paths.

1. Every page is parsed once into text blocks, each with the path of the block-level
   elements above it (``html>body>div.post-#>p``: tag, class names, numbers
   generalised to ``#``) and scored by its characters outside links.  A page
   votes for one container: if ``article``/``main`` elements hold at least half
   of its text, for these, else for the lowest container with ``NEARLY`` all of
   it, and from there up (below ``body``) as long as headings, paragraphs,
   quotes or the like lie outside.  Blocks, the page's own container and its candidates are written once: containers
   that leave out nearly nothing of what the own one holds (a tenth, or ``SHORT`` characters).
2. The scores are votes: Spark sums them per (host, path), that is per host and
   template (map-side sums, so a host with a third of all pages is a few rows
   per task).
3. The candidates, rows without text, are joined to the votes by (host, path).  A page whose own
   container ``AGREE`` pages voted for takes it; others take the candidate with the highest score of the host, if another page
   voted for one, else their own.  So a host may have any number of templates.
4. The blocks are joined to the chosen path by row, and those under it are the text; with them, on pages without
   ``article``/``main``, those under a container beside it that has ``SHORT`` characters here and ``AGREE`` votes of the host.

Left out everywhere: scripts, styles, heads, forms and controls, navigation,
page headers, footers, asides, and elements whose class, id or role names an
advert, menu, sidebar, notice, comment list or the like.  A name alone does not do: ``no-sidebar``, ``ad-free`` or
``category-social`` say nothing of that kind; ``related-work`` only has such a word, so that element goes only if its text is
mostly links; and one that is named so (``share-buttons``, ``user-comments``) stays where it holds the page's text, that is
where less than ``REST`` of the text outside links lies elsewhere.  Character references
are decoded, white space inside a block becomes one space, blocks are trimmed
and joined by one line break in page order; a ``br`` is white space in its block.

Defined results: null or empty html gives empty text; truncated markup is
dropped from its ``<`` on; a null url is a host of its own; repeated rows
repeat their result; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stash

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens only after "="
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)"
    r"(?P<attrs>(?>=\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?|[^>=])*+)(?:>|\Z)",
    re.S | re.I)
#: Elements whose content is no markup, up to their end tag.
RAW = frozenset("script style iframe textarea title xmp noframes".split())
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW}
#: Elements left out with all that is in them; empty if they end in "/>".
SKIPPED = frozenset("svg math object noscript template".split())
FOREIGN = frozenset("svg math".split())
#: Elements within ``FOREIGN`` that may hold blocks; elsewhere a block ends an open ``FOREIGN`` element.
HOLDERS = frozenset("foreignobject desc annotation-xml".split())
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CONTAINERS = frozenset("html body article main section div td th blockquote figure center dd".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt pre table tbody thead tfoot tr caption figcaption address hr details "
    "summary nav header footer aside form fieldset menu head dialog button select label option hgroup".split())
#: Elements that hold no article text.
BAD_TAGS = frozenset("nav footer aside form fieldset menu head dialog button select option input".split())
#: Words of a class, id or role that mark an element without article text.
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu menus nav "
    "navigation navbar breadcrumb breadcrumbs masthead footer comment comments disqus respond reply replies related "
    "recommended recommendations share sharing social widget widgets toolbar pagination pager login signup "
    "search contentinfo complementary".split())
#: Words that say nothing of their own beside a bad word: place, form and parts of an element.
PLAIN_WORDS = frozenset(
    "box block wrapper wrap container area slot unit list item items left right top bottom main inner outer section module "
    "panel bar button buttons link links icon icons post posts article articles form head header title text content image "
    "site page global primary secondary mobile desktop sticky fixed floating small large wide full row col column group "
    "body the and for your our us more also you may like this on in to by js id u s x xs sm md lg xl".split())
#: Words that make a name say something else of a bad word.
DENYING = frozenset("no not non without has have with is are hide free category cat categories tag tags type format layout".split())
NEVER_BAD = frozenset("html body article main".split())
VOID = frozenset("hr input".split())
WORD = re.compile(r"[a-z]+")
NUMBER = re.compile(r"\d+")
#: Blocks that belong to a text whose container they lie beside.
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre table tr td th caption figure figcaption blockquote".split())
NEARLY = 0.9
SHORT = 80      # characters that a path may leave out of what a page's own container holds
AGREE = 2
LOOKED_UP = 100_000      # rows of a page's paths (a few hundred bytes) that a task may hold; more are joined by a shuffle
REST = 0.25     # share of the text that must lie outside an element that goes for its name
LINKED = 0.5    # share of links from which on one bad word among others tells
Block = tuple[str, str, str, int]  # path, container path, text, characters outside links


def _named(value: str) -> int:
    """2 if a class, id or role names an element without article text, 1 if it only has a word of that kind, else 0."""
    told = 0
    for name in value.split():      # camelCase, hyphens and the like part words
        words = WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
        if BAD_WORDS.isdisjoint(words) or not DENYING.isdisjoint(words):
            continue
        # the last word says what it is: "user-comments" are comments, a "share-price" is a price
        told = max(told, 2 if words[-1] in BAD_WORDS or all(w in BAD_WORDS or w in PLAIN_WORDS for w in words) else 1)
    return told


def _step(tag: str, attrs: str) -> tuple[str, int]:
    """Generalised path step of an element, and whether its names mark it as no article text (``_named``)."""
    if not attrs or "=" not in attrs:
        return tag, 0
    classes, bad = "", 0
    for m in ATTR.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "class":
            classes = "." + ".".join(sorted(set(NUMBER.sub("#", value).split()))) if value.strip() else ""
        bad = max(bad, _named(m[2] or m[3] or m[4] or ""))
    return tag + classes.replace(">", ""), bad


def blocks(page: str) -> list[Block]:
    """The text blocks of a page outside of the elements left out, in page order."""
    out: list[Block] = []
    suspects: list[tuple[int, int]] = []  # elements with a bad name: the suspect around it, how it is named
    of: list[int] = []  # the innermost suspect around each block
    # open block elements: tag, path, bad, container path, innermost suspect
    stack: list[tuple[str, str, bool, str, int]] = [("", "", False, "", -1)]
    text: list[str] = []
    linked = 0
    in_link = False
    skip: list[str] = []  # open elements from a skipped one on

    def flush():
        nonlocal linked
        if text:
            flat = " ".join(html.unescape("".join(text)).split())
            if flat:
                _, path, _, container, suspect = stack[-1]
                out.append((path, container, flat, max(0, len(flat) - linked)))
                of.append(suspect)
            text.clear()
        linked = 0

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at and not skip and not stack[-1][2]:
            piece = page[at:m.start()]
            text.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        closed = m["attrs"].endswith("/")
        if tag in RAW and not m["end"]:
            if not (closed and skip and skip[0] in FOREIGN):
                end = RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if skip:
            if m["end"]:
                if tag in skip:
                    del skip[len(skip) - 1 - skip[::-1].index(tag):]
                    continue
                if tag not in BLOCKS or all(s[0] != tag for s in stack):
                    continue
                skip.clear()  # the element around the skipped one ends
            elif tag in BLOCKS and skip[0] in FOREIGN and HOLDERS.isdisjoint(skip):
                skip.clear()
            else:
                if (tag in BLOCKS or tag in SKIPPED or tag in HOLDERS) and tag not in VOID and not closed:
                    skip.append(tag)
                continue
        if tag in SKIPPED:
            if not m["end"] and not closed:
                skip.append(tag)
            continue
        if tag not in BLOCKS:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = not m["end"]
            continue
        flush()
        in_link = False
        if m["end"]:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == tag:
                    del stack[n:]
                    break
            continue
        # elements that end an open one of their kind
        if stack[-1][0] == "p" or tag in ("li", "option", "dt", "dd", "tr", "td", "th") and stack[-1][0] == tag:
            stack.pop()
        if tag in VOID:
            continue
        step, bad = _step(tag, m["attrs"])
        _, path, under_bad, container, suspect = stack[-1]
        path = f"{path}>{step}" if path else step
        inside = any(s[0] in ("article", "main") for s in stack)
        if bad and tag not in NEVER_BAD:
            suspects.append((suspect, bad))
            suspect = len(suspects) - 1
        if tag in CONTAINERS and not (inside and container):
            container = path
        bad_tag = tag in BAD_TAGS or (tag == "header" and not inside)
        stack.append((tag, path, under_bad or bad_tag, container, suspect))
    if at < len(page) and not skip and not stack[-1][2]:
        text.append(page[at:])
    flush()
    gone = _without_text(out, of, suspects)
    return [b for b, s in zip(out, of) if s not in gone] if gone else out


def _without_text(out: list[Block], of: list[int], suspects: list[tuple[int, int]]) -> set[int]:
    """The suspect elements that hold no article text, by their names and their text."""
    score, size = [0] * len(suspects), [0] * len(suspects)
    for b, s in zip(out, of):
        while s >= 0:
            score[s] += b[3]
            size[s] += len(b[2])
            s = suspects[s][0]
    whole = sum(b[3] for b in out)
    gone: set[int] = set()
    for s, (around, told) in enumerate(suspects):      # outer ones come first
        if around in gone or (whole - score[s] >= REST * whole if told == 2 else size[s] - score[s] > LINKED * size[s]):
            gone.add(s)
    return gone


def under(path: str, top: str) -> bool:
    return not top or path == top or path.startswith(top + ">")


def weights(own: list[Block]) -> list[int]:
    """Characters of each block outside links; all characters if every text is a link."""
    score = [b[3] for b in own]
    return score if any(score) else [len(b[2]) for b in own]


def _tag(path: str) -> str:
    return path.rsplit(">", 1)[-1].split(".", 1)[0]


def own_container(own: list[Block]) -> tuple[str, int]:
    """The container that a page votes for, and its score."""
    score = weights(own)
    marked = [n for n, b in enumerate(own) if _tag(b[1]) in ("article", "main")]
    if 2 * sum(score[n] for n in marked) >= sum(score):  # article text only
        use = marked
    else:
        use = list(range(len(own)))
    held: dict[str, int] = {}
    for n in use:
        steps = own[n][1].split(">")
        for k in range(len(steps) + 1):
            if not k or steps[k - 1].split(".", 1)[0] in CONTAINERS:
                top = ">".join(steps[:k])
                held[top] = held.get(top, 0) + score[n]
    whole = sum(score[n] for n in use)
    path = max((p for p, x in held.items() if x >= NEARLY * whole), key=lambda p: (p.count(">") + bool(p), held[p], p))
    while use is not marked:
        above = max((p for p in held if p != path and under(path, p)), key=len, default="")
        if _tag(above) in ("", "html", "body"):
            break
        outside = [own[n][0] for n in use if under(own[n][0], above) and not under(own[n][0], path)]
        if all(_tag(p) not in CONTENT for p in outside):
            break
        path = above
    return path, held[path]


def candidates(own: list[Block]) -> tuple[str, int, list[str], list[str]]:
    """The page's own container, its score, other containers that hold nearly what it holds, and those beside it with text."""
    score = weights(own)
    path, held = own_container(own)
    cover: dict[str, int] = {}
    beside: dict[str, int] = {}
    whole = 0
    for b, x in zip(own, score):
        inside = under(b[0], path)
        whole += inside * x
        steps = b[0].split(">")
        for k in range(len(steps) + 1):
            if not k or steps[k - 1].split(".", 1)[0] in CONTAINERS:
                top = ">".join(steps[:k])
                if inside:
                    cover[top] = cover.get(top, 0) + x
                elif not under(path, top):
                    beside[top] = beside.get(top, 0) + x
    spare = max((1 - NEARLY) * whole, SHORT)
    others = sorted(p for p, x in cover.items() if p != path and x > 0 and whole - x <= spare)
    marked = any(_tag(b[1]) in ("article", "main") for b in own if under(b[0], path))
    return path, held, others, [] if marked else sorted(p for p, x in beside.items() if x >= SHORT)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, url, host, html)`` to ``(id, url, host, own, score, others, beside, blocks)``."""
    for b in batches:
        rows = []
        for page in b.column(3).to_pylist():
            own = blocks(page)
            rows.append((*(candidates(own) if own else ("", 0, [], [])), [{"path": x[0], "text": x[2]} for x in own]))
        path, held, others, beside, parts = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(path, pa.string()), pa.array(held, pa.int64()),
             pa.array(others, pa.list_(pa.string())), pa.array(beside, pa.list_(pa.string())),
             pa.array(parts, pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())])))],
            ["id", "url", "host", "own", "score", "others", "beside", "blocks"])


def host_of(url_col: str = "url"):
    """Lower-case host of a url without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The pages' blocks and containers, written once, with a row key."""
    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    made = rows.mapInArrow(_parse, f"id {kinds[id_col]}, url {kinds[url_col]}, host string, own string, score long, "
                                   "others array<string>, beside array<string>, blocks array<struct<path:string,text:string>>")
    return stash(made.withColumn("row", F.monotonically_increasing_id()), "pages")


def host_votes(rows: DataFrame) -> DataFrame:
    """``(host, path, score, pages)``: the votes of all pages with text."""
    return rows.where(F.size("blocks") > 0).groupBy("host", F.col("own").alias("path")).agg(
        F.sum("score").alias("score"), F.count(F.lit(1)).alias("pages"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row."""
    rows = parsed(pages, id_col, url_col, html_col)
    votes = stash(host_votes(rows), "page-votes")
    # pages whose own container has too few votes look at their other candidates: a row per candidate, without text
    few = votes.where(F.col("pages") < AGREE).select("host", F.col("path").alias("own"))
    asked = rows.where(F.size("others") > 0).select("row", "host", "own", "others").join(few, ["host", "own"])
    asked = asked.select("row", "host", F.explode("others").alias("path"))
    best = asked.join(votes, ["host", "path"]).groupBy("row").agg(
        F.max_by("path", F.struct("score", "pages", "path")).alias("best"))
    # containers beside the page's own that other pages of the host have as their own
    also = rows.where(F.size("beside") > 0).select("row", "host", F.explode("beside").alias("path")).join(
        votes.where(F.col("pages") >= AGREE), ["host", "path"]).groupBy("row").agg(F.collect_list("path").alias("also"))
    other = stash(best.join(also, "row", "full"), "page-paths")
    if other.count() <= LOOKED_UP:      # few pages take anything but their own container: texts are not shuffled for them
        other = F.broadcast(other)
    out = rows.join(other, "row", "left")
    tops = F.concat(F.array(F.coalesce("best", "own")), F.coalesce("also", F.array().cast("array<string>")))
    out = out.withColumn("tops", tops)
    inside = F.filter("blocks", lambda b: F.exists("tops", lambda t: (t == "") | (b["path"] == t) | F.startswith(
        b["path"], F.concat(t, F.lit(">")))))
    text = F.array_join(F.transform(inside, lambda b: b["text"]), "\n")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
