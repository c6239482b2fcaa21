"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one a block element, and what page furniture encloses
(menus, forms, adverts, scripts, reader comments, ...) loses its text with its markup.
Elements are furniture by their name or by whole tokens of their class, id or role; an
article is so only as a reader's comment, and a wrapper known by its tokens, or a form,
gives way to an article or main region inside it.
Every line weighs its characters outside links. Where the page declares an article or
main region, a line inside weighs SURGE more and one outside OUTSIDE less, so a region
bends the curve but doesn't replace it: an undeclared stretch of text that is long
enough still surges. Weights are summed over sliding windows of lines. The curve surges
where a line's weight reaches SURGE, or a window's sum does and the following ones stay
above zero; it dives where a window's sum falls to zero or a line's weight below it. The
text between the two points is kept, every line of it, and so are the lines with weight
that adjoin it before.

Defined results: null html counts as empty; a page without a surge gives its lines
that aren't mostly links, an empty page the empty text; unclosed or broken markup is
read as far as it goes, in time proportional to the page; equal rows give equal rows;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_arrow, released, text_batches

WINDOW, SURGE = 3, 80
#: what a line outside all declared regions weighs less: beyond this many characters it can surge
OUTSIDE = 1000

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: their content is no markup and no text of the page
RAW = frozenset("script style noscript template textarea title iframe svg canvas audio video select noembed noframes xmp".split())
FURNITURE = frozenset("nav aside form footer head menu dialog button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: whole tokens of class, id or role that mark furniture, whatever the element
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies disqus"
    " footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply respond"
    " search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: such a word joined to one of these by - or _ is a whole token too: site-footer, cookie-notice, comment-list
_BEFORE = "site main global primary secondary top bottom left right mobile".split()
_AFTER = "container wrapper wrap area box bar banner notice popup modal overlay panel inner list links menu form buttons icons slot unit widget left right".split()
_joined = lambda words: words | {f"{a}{j}{b}" for w in words for j in "-_" for a, b in [*((x, w) for x in _BEFORE), *((w, x) for x in _AFTER)]}
COMMENT_TOKENS = _joined(COMMENT_WORDS) | {"comments-section", "comment-body", "comment-thread", "comment-respond"}
READER_TOKENS = COMMENT_TOKENS | _joined(frozenset(["related"])) | {f"related{j}{w}" for j in "-_" for w in ("posts", "articles", "stories", "content")}
TOKENS = _joined(FURNITURE_WORDS) | READER_TOKENS
HEADER_TOKENS = _joined(frozenset(["header"])) - {"main-header", "main_header"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][\w:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)>""", re.S)
MAIN_ROLES = frozenset(["main", "article"])
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: attributes without any of these words say nothing about what an element is
TELLS = re.compile(r"\b(?:class|id|role|hidden|style)\b", re.I)
NOT_SHOWN = re.compile(r"(?<![\w-])display\s*:\s*none\b", re.I)


def _attributes(raw: str) -> dict[str, str]:
    """Values by attribute name in lower case; of a repeated name the first counts, a bare one has the empty value."""
    out: dict[str, str] = {}
    if TELLS.search(raw):
        for found in ATTRIBUTE.finditer(raw):
            out.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    return out


def _hidden(named: dict[str, str]) -> bool:
    """A hidden attribute (but until-found), aria-hidden=true, or a style of display:none."""
    bare = "hidden" in named and named["hidden"].strip().lower() != "until-found"
    return bare or named.get("aria-hidden", "").strip().lower() == "true" or bool(NOT_SHOWN.search(named.get("style", "")))


def _furniture(name: str, named: dict[str, str], in_main: bool) -> str:
    """Why an element is furniture: ``tag``, ``words`` or, for what readers wrote and related pages, ``readers``; empty if it isn't."""
    if name in FURNITURE or name == "header" and not in_main:
        return "tag"
    if name in ("html", "body", "main") or not named:
        return ""
    words: set[str] = set()
    for key in ("class", "id", "role"):
        tokens = named.get(key, "").lower().split()
        # the id of a heading, or of a section of the main text, is an anchor named after the heading
        if key != "id" or name not in HEADINGS and not (in_main and name == "section"):
            words.update(tokens)
        elif name == "section":
            words.update(COMMENT_TOKENS.intersection(tokens))
    if name == "article":
        return "readers" if words & COMMENT_TOKENS else ""
    if words & READER_TOKENS:
        return "readers"
    if words & TOKENS or _hidden(named) or not in_main and words & HEADER_TOKENS:
        return "words"
    return ""


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters in links, in a declared main region) of each line outside furniture, in page order."""
    lines: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = 0
    skip_name, skip_depth, skip_why = "", 0, ""
    main: list[str] = []
    met = False
    link = 0
    at = 0
    # behind the last > no tag can end, so nothing is searched there; nor is an end tag that isn't there, twice
    edge = page.rfind(">") + 1
    unclosed: set[str] = set()
    last_close: dict[str, int] = {}

    def closed_later(name: str) -> bool:
        if name not in last_close:
            last_close[name] = max((m.start() for m in re.finditer(rf"</{name}\b", page, re.I)), default=-1)
        return last_close[name] >= at

    def end_line() -> None:
        nonlocal linked
        line = " ".join("".join(text).split())
        if line:
            lines.append((line, min(linked, len(line)), bool(main)))
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not skip_name:
            raw = entities.unescape(raw)
            text.append(raw)
            if link:
                linked += len(" ".join(raw.split()))

    while True:
        tag = TAG.search(page, at, edge) if at < edge else None
        if not tag:
            comment = page.find("<!--", max(at, edge))
            add(page[at:] if comment < 0 else page[at:comment])
            break
        add(page[at : tag.start()])
        at = tag.end()
        if at == edge and page.startswith("<!--", tag.start()) and not page.startswith("-->", edge - 3):
            break  # a comment that is never closed
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        if not closing and name in RAW:
            end = None if name in unclosed else re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at, edge)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                break
            else:
                unclosed.add(name)
            continue
        named = {} if closing else _attributes(attributes)
        why = "" if closing or name in VOID or attributes.endswith("/") else _furniture(name, named, bool(main))
        if not closing and not why and (name in ("article", "main") or MAIN_ROLES.intersection(named.get("role", "").lower().split())):
            end_line()
            # furniture that was never closed, or is a wrapper known by its words only, ends where the article begins;
            # what readers wrote does so at a main region, or if the page had no article before
            if skip_name and (name == "main" or skip_name == "form" or skip_why == "words" or skip_why == "readers" and not met or not closed_later(skip_name)):
                skip_name, skip_depth = "", 0
            if not skip_name:
                met = True
                main.append(name)
                continue
        if skip_name:
            if name == skip_name and name not in VOID:
                skip_depth += -1 if closing else 1
                if not skip_depth:
                    skip_name = ""
            continue
        if name in BLOCKS:
            end_line()
        elif name == "br":
            text.append(" ")
        if closing:
            if main and name == main[-1]:
                main.pop()
            if name == "a":
                link = 0
        elif name in VOID or attributes.endswith("/"):
            continue
        elif why:
            end_line()
            skip_name, skip_depth, skip_why = name, 1, why
        elif name == "a":
            link = 1
    end_line()
    return lines


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The page's main text, its blocks joined by line feeds."""
    lines = lines_of(page)
    if not lines:
        return ""
    declared = any(inside for _, _, inside in lines)
    weight = [max(0, len(t) - 2 * linked) + (0 if not declared else surge if inside else -OUTSIDE) for t, linked, inside in lines]
    n = len(lines)
    ends = [0]
    for w in weight:
        ends.append(ends[-1] + w)
    block = [ends[min(n, i + window)] - ends[i] for i in range(n)]
    kept = [False] * n
    i = 0
    while i < n:
        if weight[i] >= surge or weight[i] > 0 and block[i] >= surge and min(block[i : i + window]) > 0:
            j = i
            while j and weight[j - 1] > 0 and not kept[j - 1]:
                j -= 1
            kept[j:i] = [True] * (i - j)
            while i < n and weight[i] >= 0 and (block[i] > 0 or weight[i] > 0):
                kept[i] = True
                i += 1
        else:
            i += 1
    if not any(kept):
        kept = [2 * linked < len(t) for t, linked, _ in lines]
    return "\n".join(t for (t, _, _), k in zip(lines, kept, strict=True) if k)


def extract(df: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keys plus text and n_chars (code points) of every whole page."""
    bound_arrow(df.sparkSession)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.coalesce(F.col(html_col), F.lit("")).alias("text"))
    types = T.StructType([*(rows.schema[n] for n in names), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, pages in text_batches(batches):
            got = [main_text(p) for p in pages]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), pa.array(got, pa.string())], names=[*names, "text"])

    found = rows.mapInArrow(released(run), types)
    return found.select(*(F.col(n).alias(k) for n, k in zip(names, keys, strict=True)), "text", F.length("text").cast("long").alias("n_chars"))
