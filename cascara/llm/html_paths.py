"""Main text of web pages by tag-path ratios.

A page becomes its text nodes, each with the root-to-leaf path of tags above it. Text length and punctuation are summed
per path and divided by the path's nodes; the two ratios are fused, smoothed along the page (a short paragraph between
long ones stays high, a lone teaser falls) and compared with a threshold from their own spread. The paths over it say
where the article is: the narrowest container that holds nearly all their text. Inside it every block belongs to the
article, apart from elements that are by their tag, class, id or role menus, headers, footers, sidebars, notices,
adverts, forms or reader comments. Pages are independent, so this is one pass without a shuffle.

Defined cases: a null, empty or text-free page has the empty text; broken markup (unclosed or stray tags, a page that
ends early) is read as browsers do in the common cases; repeated pages give equal rows; an empty table gives no rows;
only the three columns named are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import prepare

#: Elements whose content is no markup, read up to their end tag.
_RAW = re.compile(r"<(script|style|title|textarea|noscript|iframe|template|svg|xmp|select|object)\b", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article main section div body html td center".split())
#: A start tag of the key ends an open element of these tags, up to the nearest of the second group.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}

#: What is never the article: by tag, by role, by a word of the class or id.
_OTHER_TAGS = frozenset("head nav header footer aside menu dialog button label".split())
#: By tag, unless most of the text is in it.
_OTHER_WRAPPERS = frozenset("form fieldset".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "disqus respond reply replies pagination pager toolbar copyright".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that hold running text: a low score alone does not drop them.
_TEXT = frozenset("blockquote caption dd dt figcaption li p pre summary td th".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")


def _excluded(tag: str, attributes: str) -> int:
    """2: never the article; 1: not unless it holds most of the text; 0: not excluded."""
    if tag in _OTHER_TAGS:
        return 2
    out = int(tag in _OTHER_WRAPPERS)
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return 2
        if name == "role" and value.strip() in _OTHER_ROLES:
            if value.strip() != "form":
                return 2
            out = 1
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and not _OTHER_WORDS.isdisjoint(re.split(r"[\s_-]+", value)):
            out = 1
        if name in ("class", "id") and tag == "article" and {"comment", "comments"} & set(re.split(r"[\s_-]+", value)):
            out = 1
    return out


def tokens(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash of an end tag, tag, attributes) of all markup in page order; comments, declarations and raw
    elements have no tag. A tag ends at the first ``>`` outside quotes; without one its ``<`` is text. Linear in the page:
    where a tag was once found not to end, no later one is read on from there."""
    last = html.rfind(">")
    lone: dict[str, int] = {}  # of each quote the position from which on no other follows
    endless: set[int] = set()  # positions outside quotes from which on no tag ends

    def tag_end(at: int) -> int:
        seen = []
        while at not in endless:
            seen.append(at)
            stop = _STOP.search(html, at)
            if stop is None:
                break
            at = stop.end()
            if stop[0] == ">":
                return at
            partner = html.find(stop[0], at) if at < lone.get(stop[0], len(html) + 1) else -1
            if partner < 0:
                lone[stop[0]] = min(at, lone.get(stop[0], at))
                break
            at = partner + 1
        endless.update(seen)
        return -1

    at = html.find("<")
    while at >= 0:
        end, slash, tag, attributes = -1, "", "", ""
        if html.startswith("<!--", at) or html[at : at + 9].upper() == "<![CDATA[":
            close = "-->" if html.startswith("<!--", at) else "]]>"
            end = html.find(close, at + (4 if close == "-->" else 9))
            end = len(html) if end < 0 else end + 3
        elif at < last:
            if html[at + 1] in "!?":
                end = html.index(">", at) + 1
            elif raw := _RAW.match(html, at):
                end = html.index(">", raw.end()) + 1
                if html[end - 2] != "/":
                    close = _closing(raw[1].lower()).search(html, end)
                    end = close.end() if close else len(html)
            elif m := _TAG.match(html, at):
                end = tag_end(m.end())
                slash, tag, attributes = m[1], m[2], html[m.end() : end - 1] if end > 0 else ""
        if end < 0:
            at = html.find("<", at + 1)
            continue
        yield at, end, slash, tag, attributes
        at = html.find("<", end)


@lru_cache(maxsize=32)
def _closing(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}\s*>", re.I)


def text_nodes(html: str) -> tuple[list[str], list[int], list[int], list[tuple[int, str]], list[int]]:
    """(texts, element of each, block of each, elements as (parent, tag)) outside elements that are never the article,
    in page order, and the elements that are not unless they hold most of the text."""
    elements: list[tuple[int, str]] = [(-1, "")]
    doubted: list[int] = []
    stack, skipped = [(0, "")], 0  # skipped: depth of the stack at which an excluded element began
    open_at: dict[str, list[int]] = {}  # where the open elements of each tag stand in the stack
    texts, owners, blocks = [], [], []
    block = last = 0

    def close(to: int) -> None:
        nonlocal skipped
        while len(stack) > to:
            open_at[stack.pop()[1]].pop()
        if len(stack) < skipped:
            skipped = 0

    def innermost(tags: Iterable[str]) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def text(end: int) -> None:
        if not skipped and end > last:
            texts.append(html[last:end])
            owners.append(stack[-1][0])
            blocks.append(block)

    for start, end, slash, tag, attributes in tokens(html):
        text(start)
        last = end
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BLOCK or tag == "br":
            block += 1
        if slash:
            if at := innermost([tag]):
                close(at)
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK and innermost(["p"]) > innermost(_CONTAINER):  # a block ends an open paragraph
            close(innermost(["p"]))
        if tag in _ENDS:
            ended, within = _ENDS[tag]
            if innermost(ended) > innermost(within):
                close(innermost(ended))
        elements.append((stack[-1][0], tag))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append((len(elements) - 1, tag))
        if not skipped and (other := _excluded(tag, attributes)):
            if other == 2:
                skipped = len(stack)
            else:
                doubted.append(len(elements) - 1)
        if attributes.endswith("/") and tag not in _BLOCK:
            close(len(stack) - 1)
    text(len(html))
    return texts, owners, blocks, elements, doubted


def main_text(html: str | None, radius: int = 2, spread: float = 0.5, share: float = 0.9) -> str:
    """The article of a page. ``radius``: nodes to either side that smooth a node's ratio; ``spread``: the threshold in
    standard deviations of the smoothed ratios; ``share``: of the selected text, what an article or main element must hold to be the container by its tag."""
    if not html:
        return ""
    raw, owners, blocks, elements, doubted = text_nodes(html)
    texts = [" ".join(unescape(t).split()) for t in raw]
    # a path is a number: that of the parent's path and the tag
    numbers: dict[tuple[int, str], int] = {}
    paths, depths = [0], [0]
    holder, linked = [0], [False]  # the innermost block around an element's text, and whether a link is on the way to it
    for e, (parent, tag) in enumerate(elements[1:], 1):
        paths.append(numbers.setdefault((paths[parent], tag), len(numbers) + 1))
        depths.append(depths[parent] + 1)
        holder.append(e if tag in _BLOCK else holder[parent])
        linked.append(tag not in _BLOCK and (tag == "a" or linked[parent]))

    def within(tops: set[int]) -> set[int]:
        out = set(tops)
        for e in range(min(tops, default=len(elements)) + 1, len(elements)):
            if elements[e][0] in out:
                out.add(e)
        return out

    def select(left: list[int]) -> tuple[dict[int, int], set[int]]:
        """Selected text in each element, and the paths that score low themselves."""
        total: dict[int, list[float]] = {}  # ratios of each path, fused, at each of its nodes
        for i in left:
            x = total.setdefault(paths[owners[i]], [0, 0, 0])
            x[0] += len(texts[i])
            x[1] += len(_PUNCTUATION.findall(texts[i]))
            x[2] += 1
        fused = {p: x[0] / x[2] * (1 + x[1] / x[2]) for p, x in total.items()}
        ratio = np.array([fused[paths[owners[i]]] for i in left])
        kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(1, radius / 2)) ** 2)
        smooth = np.convolve(np.pad(ratio, radius, mode="edge"), kernel / kernel.sum(), "valid")
        bound = spread * smooth.std()
        sums = [0] * len(elements)
        for i, r in zip(left, smooth, strict=True):
            if r >= bound:
                sums[owners[i]] += len(texts[i])
        for e in range(len(elements) - 1, 0, -1):  # an element comes after its parent
            sums[elements[e][0]] += sums[e]
        weight = {e: w for e, w in enumerate(sums) if w}
        return weight, {p for p, r in fused.items() if r < bound}

    kept = [i for i, t in enumerate(texts) if t]
    if not kept:
        return ""
    if doubted:
        weight, _ = select(kept)
        most = [e for e in doubted if 2 * weight.get(e, 0) > weight.get(0, 0)]
        apart = within(set(doubted))
        # An article or main element elsewhere says itself what the page is about, however long the comments on it are.
        if most and not any(elements[e][1] in ("article", "main") and w and e not in apart and most[-1] not in within({e}) for e, w in weight.items()):
            doubted = [e for e in doubted if e not in most]
            apart = within(set(doubted))
        kept = [i for i in kept if owners[i] not in apart]
        if not kept:
            return ""
    else:
        apart = set()
    weight, low = select(kept)
    # The innermost article that holds nearly all the selected text; without one, the narrowest container of all of it.
    whole = weight.get(0, 0)
    marked = [e for e, w in weight.items() if w >= share * whole and elements[e][1] in ("article", "main")]
    home = max(marked or (e for e, w in weight.items() if w == whole and (e == 0 or elements[e][1] in _CONTAINER)), key=depths.__getitem__, default=0)
    inside = within({home}) - apart
    joined: dict[int, list[int]] = {}
    for i, (o, b) in enumerate(zip(owners, blocks, strict=True)):
        if o in inside:
            joined.setdefault(b, []).append(i)
    # Blocks whose paths all score low go if they are no text elements or mostly links, headings with all beside them.
    dropped, holds = set(), set()
    for b, own in joined.items():
        size = sum(len(texts[i]) for i in own)
        if not size:
            continue
        tops, links = set(), 0
        for i in own:
            if texts[i]:
                tops.add(holder[owners[i]])
                links += linked[owners[i]] * len(texts[i])
        if any(elements[e][1] in _HEADING for e in tops):
            continue
        if home not in tops and all(paths[owners[i]] in low for i in own if texts[i]) and (2 * links > size or not any(elements[e][1] in _TEXT for e in tops)):
            dropped.add(b)
        else:
            for e in tops:
                while e > home and e not in holds:
                    holds.add(e)
                    e = elements[e][0]
    holds.add(home)
    for b, own in joined.items():
        for e in (holder[owners[i]] for i in own if texts[i]):
            if elements[e][1] in _HEADING and e != home and elements[e][0] not in holds:
                dropped.add(b)
    return " ".join(filter(None, (" ".join(unescape("".join(raw[i] for i in own)).split()) for b, own in sorted(joined.items()) if b not in dropped)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    prepare(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")
