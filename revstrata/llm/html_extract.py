"""Main text of web pages by tag-path ratios.

A page is cut into text leaves, each with the path of block tags from the root. For every
path the characters, punctuation marks and leaves are summed; a path's score is its
characters a leaf times its punctuation a leaf. Scores are smoothed over neighbouring
leaves in page order, both ratios fused, and leaves over a share of the deviation are
content. The container that holds most of the content is then taken whole, and so is the
innermost one of each content leaf outside it, less what their markup declares to be
something else (menus, adverts, forms, comments and the like), so that short headings and
paragraphs beside the long ones stay, and no content leaf is lost.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm.common import ship

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'](?=[^\"']*+>))*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"']+)")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg object audio video canvas annotation annotation-xml".split())
#: Of these, those that end at their parent, or at the next block, where they are not closed; the others then reach to the page's end.
EMBEDDED = frozenset("template svg object audio video canvas annotation annotation-xml".split())
SECTIONS = frozenset("article main section div td blockquote".split())
#: Elements that never hold main text, and what roles, classes and ids say of the same kind.
OTHER = frozenset("aside button datalist dialog footer head menu nav option search select".split())
#: Declared to be something else as names are: unless they hold most of the selected text.
OTHER_MAYBE = frozenset("fieldset form".split())
OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
OTHER_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|alert|banner|breadcrumbs?|byline-share|captcha|comments?|commentlist|consent|"
    r"cookies?|disclaimer|disqus|drawer|feedback|footer|gdpr|header-nav|hidden|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|notification|"
    r"overlay|pager|paginat\w*|paywall|popup|promos?|promotion|promoted|recommend\w*|related|replies|reply|respond|search|share|sharing|sidebars?|sidenav|signup|"
    r"skip|social|sponsor\w*|subscribe|subscription|teasers?|toolbar|topbar|widgets?)(?:$|[\s_-])",
    re.I,
)
#: Names that tell of a page's layout or state, not of what an element is: has-sidebar, no-sidebar, main-with-nav, comments-open, content-sidebar-wrap.
LAYOUT_NAMES = re.compile(r"(?:(?<=[\s_-])|^)(?:(?:has|no|with|without)[_-][^\s]*|[^\s_-]+[_-](?:open|opened|closed)(?=$|[\s_-])|content[_-]sidebars?(?=$|[\s_-]))", re.I)
#: Words that do not speak for a paragraph or a heading: there they tell of its style, or of what it is about.
SOFT_NAMES = re.compile(r"^(?:comments?|feedback|recommend\w*|related|replies|reply|respond|search|share|sharing|social|teasers?|notices?|disclaimer|promoted|skip)$", re.I)
#: Words of elements that hold what readers wrote, however much that is.
READER_NAMES = frozenset("comment comments commentlist disqus replies respond".split())
#: Headings behind which readers write, and blocks that are notices about cookies.
READER_HEADING = re.compile(r"(?:\d+\s+)?(?:reader\s+|user\s+)?(?:comments?|responses?|replies|kommentare?|commentaires?|comentarios?)(?:\s*[(\[]?\d+[)\]]?)?\s*:?|(?:leave|post|write|add) a (?:comment|reply|response)\W*", re.I)
COOKIES = re.compile(r"\b(?:we|(?:this|our) (?:web\s?)?sites?) uses? cookies\b", re.I)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、'\"“”«»()¿¡-]")
CLOSES_P = BLOCKS - {"option", "optgroup", "legend", "caption"}


def _declared_other(tag: str, raw: str, in_article: bool) -> str:
    """Whether an element is declared to be something else: "surely", the word that says so (of its names, or form), or ""."""
    if tag in OTHER or (tag == "header" and not in_article):
        return "surely"
    found = tag if tag in OTHER_MAYBE else ""
    if not raw.strip(" /"):
        return found
    for m in ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            names = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", html_lib.unescape(value))
            word = OTHER_NAMES.search(names) and OTHER_NAMES.search(LAYOUT_NAMES.sub("", names))
            heard = word and word[0].strip(" \t\r\n\f_-").lower()
            if heard and not (tag in ("p", *HEADINGS) and SOFT_NAMES.match(heard)):
                found = heard
        if name == "role" and value.strip().lower() in OTHER_ROLES:
            if tag not in OTHER_MAYBE or value.strip().lower() != "form":
                return "surely"
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return "surely"
    return found


def leaves_of(page: str) -> tuple[list[str], list[int], list[int], list[bool], list[tuple[tuple[str, int], ...]], list[int], list[str], list[int]]:
    """Text leaves in page order: text, number of its path of block tags, block number, surely-other flag, words of maybe-other elements with their depth, innermost container (-1: none); and each container's tag and parent.

    Paths and containers are numbers with links to their parents, so that deeply nested pages take no more than linear space.
    """
    texts, paths, blocks, others, maybes, inside = [], [], [], [], [], []
    #: Tag, whether it opened a container, and for what is inside it: path, container, surely other, maybe other, in an article.
    stack: list[tuple[str, bool, int, int, bool, tuple[tuple[str, int], ...], bool]] = [("", True, 0, -1, False, (), False)]
    numbers: dict[tuple[int, str], int] = {}
    tags: list[str] = []
    parents: list[int] = []
    block, at, size = 0, 0, len(page)
    unclosed: set[str] = set()

    def text(piece: str) -> None:
        if not piece.isspace() or texts and blocks[-1] == block:
            _, _, path, chain, other, maybe, _ = stack[-1]
            texts.append(piece)
            paths.append(path)
            blocks.append(block)
            others.append(other)
            maybes.append(maybe)
            inside.append(chain)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        c = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
        elif c in ("!", "?") or (c == "/" and not page[lt + 2 : lt + 3].isalpha()):
            end = page.find(">", lt + 2)
            at = size if end < 0 else end + 1
        elif not c.isalpha() and c != "/":
            text("<")
            at = lt + 1
        else:
            m = TAG.match(page, lt)
            if not m:  # the page ends inside a tag
                break
            at = m.end()
            tag = m[2].lower()
            if tag == "br":
                text(" ")
            if m[1]:
                if tag in BLOCKS:
                    block += 1
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if stack[k][0] in ("td", "th", "table", "article", "body") and tag not in ("article", "main", "body", "html", "table", "tr", "tbody"):
                        break
                continue
            if tag in RAW:
                if not m[3].rstrip().endswith("/"):
                    end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                    if not end and tag in EMBEDDED:
                        unclosed.add(tag)
                        _, _, path, chain, _, maybe, article = stack[-1]
                        if stack[-1][0] not in EMBEDDED:
                            stack.append((tag, False, path, chain, True, maybe, article))
                        continue
                    if not end:
                        break
                    close = page.find(">", end.end() - 1)
                    at = size if close < 0 else close + 1
                continue
            if tag in BLOCKS:
                block += 1
                if unclosed:
                    first = next((k for k, x in enumerate(stack) if x[0] in EMBEDDED), len(stack))
                    del stack[first:]
                if tag in CLOSES_P or tag == "li":
                    closed = {"p", "li"} if tag == "li" else {"dt", "dd", "p"} if tag in ("dt", "dd") else {"p"}
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in closed:
                            del stack[k:]
                            break
                        if stack[k][1]:
                            break
            if tag in VOID:
                continue
            _, _, path, chain, other, maybe, article = stack[-1]
            declared = _declared_other(tag, m[3], article)
            if declared == "surely":
                other = True
            elif declared and len(maybe) < 50:  # in deeper ones the outer words decide
                maybe = (*maybe, (declared, sum(w == declared for w, _ in maybe)))
            if tag in BLOCKS:
                parents.append(chain)
                chain, path = len(tags), numbers.setdefault((path, tag), len(numbers) + 1)
                tags.append(tag)
            stack.append((tag, tag in BLOCKS, path, chain, other, maybe, article or tag in ("article", "main")))
    return texts, paths, blocks, others, maybes, inside, tags, parents


def path_scores(paths: list[int], lengths: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Each leaf's fused, smoothed ratio: characters and punctuation of its path a leaf of that path."""
    at = np.unique(np.array(paths), return_inverse=True)[1]
    n = np.bincount(at)
    fused = np.sqrt((np.bincount(at, lengths) / n) * (1.0 + np.bincount(at, marks) / n))[at]
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    around = np.convolve(fused * lengths, kernel, "same")[: len(paths)] if len(paths) >= 5 else fused * lengths
    weight = np.convolve(lengths, kernel, "same")[: len(paths)] if len(paths) >= 5 else lengths
    return np.where(weight > 0, around / np.maximum(weight, 1e-9), 0.0)


def discarded(lengths: np.ndarray, content: np.ndarray, named: list[bool], maybes: list[tuple[tuple[str, int], ...]]) -> set[tuple[str, int]]:
    """The words whose elements are discarded: those without most of the selected text, and none if no selected text would stay.

    Elements that stand beside each other under one word count together; one inside another of the same word counts apart.
    Beside an article (``named``: what is in one) with selected text of its own, text outside articles does not speak for a word.
    What readers wrote goes even where it holds most of the selected text, if a tenth of that stands elsewhere.
    """
    beside = any(named[k] and not maybes[k] for k in np.flatnonzero(content))
    held: dict[tuple[str, int], float] = {}
    for k in np.flatnonzero(content):
        for e in maybes[k] if named[k] or not beside else ():
            held[e] = held.get(e, 0.0) + lengths[k]
    total = float(lengths[content].sum())
    readers = {e for m in maybes for e in m if e[0] in READER_NAMES}
    elsewhere = sum(lengths[k] for k in np.flatnonzero(content) if readers.isdisjoint(maybes[k]))
    drop = {e for m in maybes for e in m if held.get(e, 0.0) <= 0.5 * total or e in readers and elsewhere >= 0.1 * total}
    return drop if any(drop.isdisjoint(maybes[k]) for k in np.flatnonzero(content)) else set()


def reader_parts(texts: list[str], blocks: list[int], inside: list[int], tags: list[str], parents: list[int]) -> list[bool]:
    """Of each leaf whether it is a notice about cookies, or stands behind a heading over what readers wrote.

    What is behind such a heading reaches to the end of the heading's parent, or to the parent's next heading of that rank or above.
    """
    out = [False] * len(texts)
    whole: dict[int, str] = {}
    for t, b in zip(texts, blocks, strict=True):
        whole[b] = whole.get(b, "") + t
    found = {b for b, t in whole.items() if len(t) <= 400 and COOKIES.search(t)}
    open_: list[tuple[int, int]] = []  # parent and rank of headings that are in force
    above: dict[int, set[int]] = {}

    def chain(c: int) -> set[int]:
        if c not in above:
            held, at = set(), c
            while at >= 0:
                held.add(at)
                at = parents[at]
            above[c] = held
        return above[c]

    headings = any(t in HEADINGS for t in tags)
    for k, (b, c) in enumerate(zip(blocks, inside, strict=True)):
        if b in found:
            out[k] = True
        if not headings or not open_ and (c < 0 or tags[c] not in HEADINGS):
            continue
        held = chain(c)
        open_ = [(p, rank) for p, rank in open_ if p in held or p < 0]
        if c >= 0 and tags[c] in HEADINGS:
            rank = int(tags[c][1])
            open_ = [(p, r) for p, r in open_ if not (parents[c] == p and rank <= r)]
            if READER_HEADING.fullmatch(" ".join(whole[b].split())):
                open_.append((parents[c], rank))
        out[k] = out[k] or bool(open_)
    return out


def _inside_of(parents: list[int], chosen: set[int]) -> list[bool]:
    """Of each container, and at the end of none, whether it is a chosen one or inside one."""
    out = [False] * (len(parents) + 1)
    for c, p in enumerate(parents):
        out[c] = c in chosen or out[p]
    return out


def main_text(page: str | None, share: float = 0.5) -> str:
    """The main text of one page: blocks joined by an empty line; ``share`` of the scores' deviation is the threshold."""
    if not page:
        return ""
    texts, paths, blocks, others, maybes, inside, tags, parents = leaves_of(page)
    if not texts:
        return ""
    in_article = [False] * (len(tags) + 1)  # the last is no container
    for c, p in enumerate(parents):
        in_article[c] = in_article[p] or tags[c] in ("article", "main")
    decoded = [html_lib.unescape(t) if "&" in t else t for t in texts]
    others = [o or r for o, r in zip(others, reader_parts(decoded, blocks, inside, tags, parents), strict=True)]
    own = np.array([not o for o in others])
    lengths = np.array([len(t.strip()) for t in decoded], dtype=np.float64) * own
    marks = np.array([len(PUNCTUATION.findall(t)) if o else 0 for t, o in zip(decoded, own, strict=True)], dtype=np.float64)
    scores = path_scores(paths, lengths, marks)
    content = own & (lengths > 0) & (scores >= share * scores.std())
    if any(maybes):  # names are heard only after the ratios, then the rest is scored without what they discard
        drop = discarded(lengths, content, [in_article[c] for c in inside], maybes)
        own &= np.array([drop.isdisjoint(x) for x in maybes])
        others = [not o for o in own]
        lengths, marks = lengths * own, marks * own
        scores = path_scores(paths, lengths, marks)
        content = own & (lengths > 0) & (scores >= share * scores.std())
    total = float(lengths[content].sum())
    root = -1
    around: set[int] = set()
    if total:
        held = [0.0] * (len(tags) + 1)
        for k in np.flatnonzero(content):
            held[inside[k]] += lengths[k]
        for c in range(len(tags) - 1, -1, -1):  # a container's number is above its parent's
            held[parents[c]] += held[c]
        named = [c for c, t in enumerate(tags) if t in ("article", "main") and held[c] >= 0.5 * total]
        if named:
            root = max(named, key=lambda c: (held[c], -c))
        else:
            root = max((c for c in range(len(tags)) if held[c] >= 0.8 * total), default=-1)
            while root >= 0 and tags[root] not in ("article", "main", "section", "div", "body", "html", "td", "blockquote"):
                root = parents[root]
    whole, alone = {root}, set()
    if root >= 0:
        c = parents[root]
        while c >= 0:
            around.add(c)
            c = parents[c]
        below = _inside_of(parents, whole)
        section = [-1] * (len(tags) + 1)  # each container's innermost section that does not hold the root
        for c, p in enumerate(parents):
            section[c] = c if tags[c] in SECTIONS and c not in around else section[p]
        for k in np.flatnonzero(content):
            if not below[inside[k]]:  # its innermost section, or its block alone where that would hold the root
                alone.add(blocks[k])
                whole.add(section[inside[k]] if section[inside[k]] >= 0 else root)
    below = _inside_of(parents, whole)
    out: list[str] = []
    last = None
    for t, b, o, x in zip(decoded, blocks, others, inside, strict=True):
        if o or (root >= 0 and b not in alone and not below[x]):
            continue
        if b == last:
            out[-1] += t
        else:
            out.append(t)
        last = b
    return "\n\n".join(y for y in (" ".join(x.split()) for x in out) if y)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of its column ``html`` in the column ``out``; other columns stay.

    A null, empty or unreadable page has the text "". A page that is plain text is its own main
    text. Each row is worked on alone, so ties, repeated rows and hot hosts need no care.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    return pages.withColumn(out, F.pandas_udf(of, "string")(F.col(html)))


ship(__name__)
