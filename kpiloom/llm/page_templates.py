"""Main text of web pages by equivalence classes of template tokens.

Pages of one host are read in groups of about ``group`` pages. A page's tokens are its words, the
text blocks and their openings, each under its element path (tags with id and class, from the
root). Tokens with the same occurrence vector over the pages of the group form an equivalence class;
a class of ``tokens`` or more in nearly all pages is valid if its tokens follow each other in one
order and it is nested with the other classes. A token outside all classes counts as another one
in each gap of theirs, and classes are sought again until none is added. Classes that occur the
same number of times in nearly all pages are the page template, what stands between their tokens fills its
slots; classes that occur as often as a page has records are data. Copies say nothing about a template:
vectors go over distinct pages, where pages that share ``copy`` of their words beside the side
parts are one, and fewer than ``pages`` of them have no template.

The article is all text that is neither template nor inside an element of the named side roles.
If article or main elements hold such text, theirs is taken, from all of them; otherwise every part
of the page stays, a lead or a second section like the longest one. Inside article and main the
header, captions, formulas, headings that several articles share, and paragraphs that only a name
like "related work" would mark as a side part belong to the text.

A host of any size is split by a hash of its pages, so no task holds more than a few hundred
pages, and a page alone is its own group. Defined results: a NULL or empty page gives an empty
text; a NULL url counts as a host of its own; unclosed elements end with their parent; repeated
rows are pages of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mix

# Fixed values of HTML: elements by their role.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select head title".split())
SIDE = frozenset("nav header footer aside form button dialog menu label fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var img wbr input "
    "math annotation mfenced mfrac mi mn mo mover mrow msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tr td th br hr address".split())
ARTICLE = frozenset(["article", "main"])
# Names in class, id or role that mark parts beside the article.
SIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|header|footer|sidebar\w*|side|aside|"
    r"comments?|commentlist|disqus\w*|repl(?:y|ies)|respond|cookies?|consent|notice\w*|alert\w*|popup\w*|modal\w*|"
    r"overlay|subscribe\w*|newsletter\w*|signup|login|share|sharing|social\w*|related|recommend\w*|breadcrumbs?|"
    r"pagination|pager|toolbar|search\w*|widget\w*|tags|copyright|legal|skip\w*)(?=$|[\s_-])", re.I)
# Names that a paragraph, heading or list inside the article does not bear as a part of its text.
FOREIGN_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|commentlist|disqus\w*|cookies?|newsletter\w*|share|sharing)"
    r"(?=$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class Settings:
    group: int = 128
    pages: int = 4
    share: float = 0.9
    tokens: int = 2
    copy: float = 0.8


@dataclass(frozen=True)
class Block:
    path: tuple[str, ...]
    text: str
    side: bool


def _label(tag: str, attributes: str, inside: bool) -> tuple[str, bool]:
    """Tag with id and class, and whether they name a side role; ``inside``: within article or main.

    The article's own header holds its headline, and a paragraph called "related work" or "legal
    notice" is part of its text, while a container of that name is not.
    """
    by_tag = tag in SIDE and not (inside and tag == "header")
    if not attributes.strip():
        return tag, by_tag
    named = {k.lower(): v.strip("\"'") for k, v in _NAMED.findall(attributes)}
    words = f"{named.get('class', '')} {named.get('id', '')} {named.get('role', '')}"
    names = FOREIGN_NAMES if inside and (tag in LEAF or tag == "header") else SIDE_NAMES
    side = by_tag or "hidden" in named or bool(names.search(words))
    return f"{tag}.{named.get('class', '')}#{named.get('id', '')}".lower(), side and tag not in ARTICLE and tag != "body"


def blocks(page: str) -> tuple[list[Block], Counter]:
    """Text blocks in page order, and how often each element path opens."""
    out: list[Block] = []
    paths: Counter = Counter()
    stack: list[tuple[str, str, bool]] = []
    words: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(words)).strip()
        words.clear()
        if text:
            out.append(Block(tuple(label for _, label, _ in stack), text, bool(stack) and stack[-1][2]))

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            words.append(html.unescape(page[at:end]))
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag or tag in INLINE:
            continue
        if found[1]:
            close()
            names = [x for x, _, _ in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag) :]
            continue
        if tag in RAW and not found[3].rstrip().endswith("/"):
            shut = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = shut.end() if shut else (len(page) if tag in ("script", "style", "template") else at)
            continue
        close()
        # A paragraph ends where the next block starts, a list item where the next one does.
        if stack and stack[-1][0] == "p" or stack and tag == "li" and stack[-1][0] == "li":
            stack.pop()
        label, side = _label(tag, found[3], any(name in ARTICLE for name, _, _ in stack))
        side = side or bool(stack) and stack[-1][2]
        if tag in VOID or found[3].rstrip().endswith("/"):
            continue
        stack.append((tag, label, side))
        paths[tuple(x for _, x, _ in stack)] += 1
    close()
    return out, paths


def grouped(vectors: dict, n: int, settings: Settings) -> dict[tuple, set]:
    """Equivalence classes by occurrence vector: large (``tokens`` or more) and frequent in the ``n`` pages."""
    by_vector: dict[tuple, set] = defaultdict(set)
    for token, seen in vectors.items():
        if len(seen) >= settings.share * n:
            by_vector[tuple(sorted(seen.items()))].add(token)
    return {seen: tokens for seen, tokens in by_vector.items() if len(tokens) >= settings.tokens}


def steady(vector: tuple) -> bool:
    """The class occurs equally often in its pages: it is of the page, not of a record that repeats."""
    return len({count for _, count in vector}) == 1


def classes(vectors: dict, n: int, settings: Settings) -> set:
    """Tokens of the classes that occur the same number of times in nearly all of ``n`` pages."""
    return set().union(*[tokens for seen, tokens in grouped(vectors, n, settings).items() if steady(seen)])


def ordered(tokens: set, pages: list[list]) -> list:
    """The tokens of a class that follow each other in one order each time the class occurs; empty if none do.

    Tokens that keep their rank best are taken first, one that changes sides with a taken one is left out.
    """
    parts: dict[tuple, None] = {}
    for page in pages:
        found = [t for t in page if t in tokens]
        for at in range(0, len(found), len(tokens)):
            parts[tuple(found[at : at + len(tokens)])] = None
    if not all(len(set(part)) == len(tokens) for part in parts):
        return []
    if len(parts) == 1:
        return list(next(iter(parts)))
    order = list(next(iter(parts)))
    number = {t: k for k, t in enumerate(order)}
    rank = np.stack([np.argsort([number[t] for t in part]) for part in parts])
    taken = np.zeros(len(order), dtype=bool)
    for k in np.argsort(rank.var(axis=0), kind="stable"):
        before = rank[:, taken] < rank[:, [k]]
        taken[k] = (before == before[:1]).all()
    kept = np.flatnonzero(taken)
    return [order[k] for k in kept[np.argsort(rank[0, kept])]]


def nested(inner: list[np.ndarray], size: int, outer: list[np.ndarray], width: int) -> bool:
    """Each occurrence of a class of ``size`` tokens lies between two neighbours of the other, or beside it.

    ``inner``, ``outer``: the places of the tokens in each page.
    """
    for places, others in zip(inner, outer):
        gaps = np.searchsorted(others, places) % width
        parts = gaps[: len(gaps) - len(gaps) % size].reshape(-1, size)
        if (parts != parts[:, :1]).any():
            return False
    return True


def template(pages: list[list], chosen: list[int], settings: Settings) -> list[list[bool]]:
    """Which places of each page hold a token of the page template, by the classes of the ``chosen`` pages.

    Classes are valid if they are ordered and nested with the larger ones. A token outside all classes
    then counts as another one in each of their gaps, and classes are sought anew, until none is added.
    """
    pages = [list(page) for page in pages]
    done = -1
    while True:
        vectors: dict = defaultdict(dict)
        for k in chosen:
            for token, count in Counter(pages[k]).items():
                vectors[token][k] = count
        found = grouped(vectors, len(chosen), settings)
        orders = [(v, ordered(tokens, [pages[k] for k in chosen])) for v, tokens in found.items()]
        orders = [(v, order) for v, order in orders if len(order) >= settings.tokens]
        orders.sort(key=lambda o: (not steady(o[0]), -len(o[1]), o[0]))
        owner = {t: k for k, (_, order) in enumerate(orders) for t in order}
        owners = [np.array([owner.get(t, -1) for t in page], dtype=np.int64) for page in pages]
        valid: list[tuple[int, list[np.ndarray]]] = []
        fixed: set = set()
        inside: set = set()
        for k, (seen, order) in enumerate(orders):
            places = [np.flatnonzero(o == k) for o in owners]
            mine = [places[c] for c in chosen]
            if all(nested(mine, len(order), [other[c] for c in chosen], width) for width, other in valid):
                valid.append((len(order), places))
                inside.update(order)
                if steady(seen):
                    fixed.update(order)
        if len(inside) <= done or not valid:
            return [[t in fixed for t in page] for page in pages]
        done = len(inside)
        for k, page in enumerate(pages):
            gap = np.zeros(len(page), dtype=np.uint64)
            for width, places in valid:
                gap = mix(gap + (np.searchsorted(places[k], np.arange(len(page))) % width).astype(np.uint64))
            page[:] = [t if t in inside else (t, g) for t, g in zip(page, gap.tolist())]


def _tag(label: str) -> str:
    return re.split(r"[.#]", label, maxsplit=1)[0]


def distinct(pages: list[list[Block]], settings: Settings) -> list[int]:
    """Places of pages with text, one of each set of near copies: those like an earlier page are left out."""
    first: list[int] = []
    sizes: list[int] = []
    holders: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for k, found in enumerate(pages):
        if not found:
            continue
        words: Counter = Counter()
        for block in found:
            if not block.side:
                words[block.text] += len(block.text.split())
        size = sum(words.values())
        both: Counter = Counter()
        for text, n in words.items():
            for page, m in holders.get(text, ()):
                both[page] += min(n, m)
        like = any(n >= settings.copy * (size + sizes[page] - n) for page, n in both.items())
        if like or not size and 0 in sizes:
            continue
        for text, n in words.items():
            holders[text].append((len(first), n))
        first.append(k)
        sizes.append(size)
    return first


def tokens(parsed: list[list[Block]], chosen: list[int], settings: Settings) -> list[list[list]]:
    """Tokens of each block of each page: its path, its whole text and its words, each under its path.

    A token of fewer pages than a class needs belongs to none and is left out.
    """
    spread: dict[tuple, Counter] = defaultdict(Counter)
    for k in chosen:
        met: dict[tuple, set] = defaultdict(set)
        for block in parsed[k]:
            met[block.path].update(block.text.split(), [("",), (block.text,)])
        for path, those in met.items():
            spread[path].update(those)
    least = settings.share * len(chosen)
    often = {path: {t for t, n in those.items() if n >= least} for path, those in spread.items()}
    number = {path: n for n, path in enumerate(often)}
    out = []
    for found in parsed:
        page = []
        for block in found:
            known = often.get(block.path, ())
            page.append([
                (number[block.path], t) for t in [("",), (block.text,), *block.text.split()] if t in known])
        out.append(page)
    return out


def extract(pages: list[str | None], settings: Settings = Settings()) -> list[str]:
    """Main texts of pages of one host."""
    parsed = [blocks(page or "")[0] for page in pages]
    chosen = distinct(parsed, settings)
    # Words that recur in a few pages say nothing about a template.
    shared: list[list[tuple[bool, int]]] = [[(False, 0)] * len(found) for found in parsed]
    if len(chosen) >= settings.pages:
        per_block = tokens(parsed, chosen, settings)
        marks = template([[t for block in page for t in block] for page in per_block], chosen, settings)
        for k, (page, mark) in enumerate(zip(per_block, marks)):
            at = 0
            for j, block in enumerate(page):
                told = [t[1] for t, m in zip(block, mark[at : at + len(block)]) if m]
                at += len(block)
                words = sum(isinstance(t, str) for t in told)
                shared[k][j] = (parsed[k][j].text,) in told, words

    def named(path: tuple[str, ...]) -> tuple[str, ...]:
        """The path of the outermost article or main element; empty outside."""
        inside = next((k for k, label in enumerate(path) if _tag(label) in ARTICLE), -1)
        return path[: inside + 1]

    def of_template(block: Block, whole: bool, words: int) -> bool:
        """Headings that the articles of a host share are headings; all else they share is template.

        A block with slots is template outside article and main if most of its words are; inside,
        what fills the slots is the article's, and the block stays as it is.
        """
        slots = len(block.text.split()) - words
        if named(block.path):
            heading = _tag(block.path[-1]) in HEADINGS
            return (whole or not slots) and not heading
        return whole or words > slots

    own = [
        [b for b, of in zip(found, those) if not b.side and not of_template(b, *of)]
        for found, those in zip(parsed, shared)]
    out = []
    for found in own:
        inside = [b for b in found if named(b.path)]
        out.append(" ".join(b.text for b in inside or found))
    return out


def main_text(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", "html", host.alias("_host"))
    sizes = rows.groupBy("_host").agg(F.ceil(F.count(F.lit(1)) / settings.group).alias("_parts"))
    parted = rows.join(sizes, "_host").withColumn("_part", F.pmod(F.xxhash64("page_id", "url"), F.col("_parts")))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["page_id", "url"])
        texts = extract(frame["html"].tolist(), settings)
        return pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})

    return (
        parted.groupBy("_host", "_part").applyInPandas(run, f"page_id {kind}, url string, text string")
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )
