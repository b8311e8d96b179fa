"""The main text of web pages, by two passes of rules over blocks.

A page is cut into blocks of text at block-level tags. The first pass decides each block by itself:
the density of stop words, the length and the share of text in links make it good, bad or ambiguous;
elements that never hold article text (menus, forms, asides and so on) make it bad. In the second
pass an ambiguous block takes the label of the nearest decided blocks, before and behind it.

Stop words are not listed but counted over all pages: words that are frequent in a language and
script are its stop words, and a block is dense or sparse by what is usual there. Where no word is
frequent (a script without spaces, a language of few pages), density is left out, and so it is on a
page of which it leaves nothing.

A class or id that says nothing but page furniture (`comments-area`, `ad`) makes its blocks bad; a
furniture word beside others (`social-history`) makes them ambiguous only. Where a page marks its
article, blocks outside are bad, and blocks inside are judged more mildly and take labels from
neighbours inside only.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.llm.common import stored

# Element and attribute names of HTML, and the words that pages use to name their parts.
UNSEEN = frozenset(
    "head script style template noscript iframe object svg canvas audio video map math title".split()
)
RAW = frozenset("script style textarea title noscript iframe template".split())
CHROME = frozenset(
    "nav aside footer form menu dialog button select option datalist textarea fieldset label".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar status".split()
)
CHROME_WORDS = frozenset(
    "ad ads adbox advert advertisement advertising adsense sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription "
    "signup login sidebar widget widgets related recommended recommendations share sharing social "
    "comment comments disqus reply replies respond nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead pagination pager toolbar sidenav topnav subnav".split()
)
# Words of web pages only, which say furniture whatever stands beside them, and words that say nothing
# of the text.
CHROME_ALWAYS = frozenset(
    "ad adbox ads adsense advert advertisement advertisements advertising adverts breadcrumb breadcrumbs "
    "comment commentlist comments disqus footer gdpr login masthead modal nav navbar newsletter pager "
    "pagination popup promo sidebar sidenav signup sponsored subnav subscribe toolbar topnav widget "
    "widgets".split()
)
LAYOUT_WORDS = frozenset(
    "accept area article bar block body bottom box button buttons col column container content count entry "
    "feed fixed follow form grid group header heading icon icons image info inner item items js label large "
    "law left level link links list main media message messages meta mobile module outer page panel policy "
    "post posts privacy reader right row section settings site slot small sticky stories story text thread "
    "title top unit up us user view wp wrap wrapper zone".split()
)
ABOUT_PAGE = frozenset("has with no without".split())
PAGE_HEAD_WORDS = frozenset("header topbar".split())
MAIN_WORDS = frozenset("article post entry story content main body".split())

RIGHTS = re.compile(r"(©|\(c\)|copyright\b|all rights reserved)", re.IGNORECASE)
WORDS = re.compile(r"[^\W\d_]+")
TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s"'>/=]+)""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LANGUAGE = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2})(?![A-Za-z])""", re.IGNORECASE)
NO_TEXT = re.compile(
    r"<(script|style|title|noscript|textarea|nav|footer)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;",
    re.IGNORECASE | re.DOTALL,
)
WIDE = re.compile("[\u1100-\u115f\u2e80-\ua4cf\uac00-\ud7a3\uf900-\ufaff\uff00-\uff60]")
SENTENCE_END = re.compile(r"""[.!?…。！？।؟]["'”’»)\]]*$""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

LINKED = 0.5  # share of a block's characters in links from which it is bad
FEW_LINKS = 0.2  # share up to which it can be good
# Density of stop words, as a share of what is usual in the language: good from, bad below.
DENSE, SPARSE = 0.6, 0.3
SHORT, LONG = 70, 200  # characters, wide ones as two: ambiguous below, good without density from
MILD_SHORT = 25

FREQUENT = 1 / 300  # share of a group's words that makes a word a stop word
PRIOR_WORDS = 2_000  # words of no kind added to every group, so that few pages give few stop words
USUAL = 0.1  # share of stop words in a group below which density says nothing
COUNTED = 500_000  # counts that a task holds at most, but for those of one batch
GROUPS = 2_000  # groups with stop words of their own, the largest ones

#: Stop words of a group, and their share of its words. Groups: "en LATIN", and "LATIN" over all pages.
Stops = dict[str, tuple[frozenset[str], float]]

GOOD, BAD, UNSURE = 1, 0, None


@dataclass
class Element:
    tag: str
    chrome: bool  # holds no article text
    unseen: bool  # holds no text at all
    main: int  # 2 in an article element, 1 in one that is named so, 0 elsewhere
    link: bool
    hint: bool = False  # a furniture word is in a name, beside other words


@dataclass
class Block:
    chrome: bool
    main: int
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    hint: bool = False

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def names_chrome(parts: list[str]) -> bool:
    """Whether a name says page furniture and nothing else."""
    if any(part in CHROME_ALWAYS for part in parts):
        return True
    return hints_chrome(parts) and all(part in CHROME_WORDS or part in LAYOUT_WORDS for part in parts)


def hints_chrome(parts: list[str]) -> bool:
    return any(part in CHROME_WORDS for part in parts)


def attributes(source: str) -> dict[str, str]:
    return {
        (m[1] or m[5]).lower(): entities.unescape(m[2] or m[3] or m[4] or "")
        for m in ATTRIBUTE.finditer(source)
    }


def opened(tag: str, source: str, parent: Element) -> Element:
    """What an element means for the text within."""
    found = attributes(source) if source and not source.isspace() else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    names = [[part.lower() for part in NAME_PARTS.findall(name)] for name in names]
    names = [parts for parts in names if parts and parts[0] not in ABOUT_PAGE]
    shows_chrome = any(names_chrome(parts) for parts in names)
    hint = parent.hint
    shows_main = any(part in MAIN_WORDS for parts in names for part in parts)
    shows_head = any(part in PAGE_HEAD_WORDS for parts in names for part in parts)
    role = found.get("role", "").lower()
    unseen = parent.unseen or tag in UNSEEN or "hidden" in found
    unseen = unseen or found.get("aria-hidden") == "true" or bool(HIDDEN.search(found.get("style", "")))
    chrome = parent.chrome or tag in CHROME or role in CHROME_ROLES
    main = parent.main
    if tag not in ("html", "body", "main"):
        chrome = chrome or shows_chrome
        hint = hint or any(hints_chrome(parts) for parts in names)
        if not main and (tag == "header" or shows_head and not shows_main):
            chrome = True
    if not chrome:
        if tag in ("article", "main") or role in ("main", "article"):
            main = 2
        elif not main and (
            tag in ("div", "section", "td") and shows_main
            or found.get("itemprop") == "articleBody"
        ):
            main = 1
    return Element(tag, chrome, unseen, main, parent.link or tag == "a", hint)


def blocks(page: str) -> list[Block]:
    """The blocks of a page that hold any text, in page order."""
    stack = [Element("", False, False, 0, False)]
    found: list[Block] = []
    block: Block | None = None

    def add(raw: str) -> None:
        nonlocal block
        top = stack[-1]
        if not raw or top.unseen:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        if block is None:
            if text.isspace():
                return
            block = Block(top.chrome, top.main, any(e.tag in HEADINGS for e in stack), hint=top.hint)
            found.append(block)
        block.parts.append(text)
        if top.link:
            block.linked += len(text)

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        if page.startswith("<!--", start):
            add(page[at:start])
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            add(page[at:start])
            end = page.find(">", start)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, start)
        if m is None:
            follows = page[start + 1 : start + 3].lstrip("/")
            end = page.find(">", start) if follows[:1].isalpha() else -1
            if end < 0 and follows[:1].isalpha() and follows[:1].isascii():
                add(page[at:start])  # a tag that the page ends in
                break
            if end < 0 or not follows[:1].isascii():
                add(page[at : start + 1])
                at = start + 1
                continue
            add(page[at:start])
            at = end + 1
            continue
        add(page[at:start])
        at = m.end()
        tag = m[1].lower()
        closing = page[start + 1] == "/"
        if tag in BLOCKS:
            block = None
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag == "li":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "li":
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "menu"):
                    break
        if tag in VOID or m[2].endswith("/") and tag not in BLOCKS:
            continue
        stack.append(opened(tag, m[2], stack[-1]))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = n if end is None else end.start()
    return found


@lru_cache(100_000)
def script(letter: str) -> str:
    """The script of a letter, by the first word of its name: LATIN, CYRILLIC, CJK."""
    return unicodedata.name(letter, "UNKNOWN").partition(" ")[0]


def language(page: str) -> str:
    """The two letters of the language that a page says it is in; empty if it does not."""
    said = LANGUAGE.search(page)
    return said[1].lower() if said else ""


def density(text: str, said: str, stops: Stops) -> float | None:
    """The share of stop words in a text over the usual one of its script; None if there is none.

    The script goes by the most words. The language that the page names counts where that is higher:
    pages name wrong ones.
    """
    words = WORDS.findall(text.lower())
    if not words:
        return None
    scripts: Counter = Counter()
    for letter, n in Counter(map(itemgetter(0), words)).items():
        scripts[script(letter)] += n
    written = scripts.most_common(1)[0][0]
    shares = [
        sum(map(stops[group][0].__contains__, words)) / len(words) / stops[group][1]
        for group in (f"{said} {written}", written)
        if group in stops
    ]
    return max(shares, default=None)


def size(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


def link_share(block: Block) -> float:
    return min(1.0, block.linked / max(1, len("".join(block.parts).strip())))


def first_pass(block: Block, text: str, main: int, dense_of: Callable[[str], float | None]):
    """GOOD, BAD or UNSURE for one block by itself; `dense_of` gives a density, None if it says nothing."""
    if block.chrome or block.main < main:
        return BAD
    links, n = link_share(block), size(text)
    if links > LINKED:
        return UNSURE if main and not block.hint and not links > 0.9 else BAD
    if block.hint:
        if n < MILD_SHORT and not block.heading and not SENTENCE_END.search(text):
            return BAD
        if n < LONG or links > FEW_LINKS:
            return UNSURE
        dense = dense_of(text)
        return GOOD if dense is None or dense >= DENSE else UNSURE
    if main:
        if n >= LONG:
            return GOOD
        if n < MILD_SHORT and not block.heading or links > FEW_LINKS:
            return UNSURE
        dense = dense_of(text)
        return UNSURE if dense is not None and dense < SPARSE else GOOD
    if n < SHORT:
        return BAD if RIGHTS.match(text) else UNSURE
    dense = dense_of(text)
    if dense is None:
        return GOOD if n >= LONG and links <= FEW_LINKS else UNSURE
    if dense < SPARSE:
        return BAD if n < LONG or links > FEW_LINKS else UNSURE
    return GOOD if links <= FEW_LINKS and (dense >= DENSE or n >= LONG) else UNSURE


def without_density(block: Block, text: str):
    """The label of a block outside any article, on a page that has no good block by density."""
    if block.chrome or link_share(block) > LINKED:
        return BAD
    n = size(text)
    full = n >= SHORT or n >= MILD_SHORT and SENTENCE_END.search(text)
    if full and link_share(block) <= FEW_LINKS and not block.hint:
        return GOOD
    return BAD if RIGHTS.match(text) else UNSURE


def second_pass(labels: list, chrome: list[bool], headings: list[bool], otherwise) -> list:
    """Labels with every UNSURE one replaced by that of the nearest decided block, before or behind.

    Where both are as near, a heading goes with the block behind it, other blocks with the one before.

    Blocks that `chrome` marks keep their label and are no neighbours; without any decided
    neighbour a block becomes `otherwise`.
    """
    n = len(labels)
    before, behind = [None] * n, [None] * n
    for order, near in ((range(n), before), (range(n - 1, -1, -1), behind)):
        last = None
        for k in order:
            if chrome[k]:
                continue
            if labels[k] is UNSURE:
                near[k] = last
            else:
                last = k
    out = list(labels)
    for k in range(n):
        if labels[k] is not UNSURE:
            continue
        a, b = before[k], behind[k]
        if a is None and b is None:
            out[k] = otherwise
        elif a is None or b is None:
            out[k] = labels[b if a is None else a]
        else:
            out[k] = labels[a] if k - a < b - k + (not headings[k]) else labels[b]
    return out


def main_text(page: str | None, stops: Stops | None = None) -> str:
    """The main text of a page: its good blocks in order, joined by a space; empty if none.

    Without `stops` density is left out.
    """
    page = page or ""
    found = [(block, text) for block in blocks(page) if (text := block.text())]
    main = max((block.main for block, _ in found if not block.chrome), default=0)
    said = language(page) if stops else ""

    def dense_of(text: str) -> float | None:
        return density(text, said, stops) if stops else None

    labels = [first_pass(block, text, main, dense_of) for block, text in found]
    if not main and GOOD not in labels:
        labels = [without_density(block, text) for block, text in found]
    outside = [block.chrome or block.main < main for block, _ in found]
    headings = [block.heading for block, _ in found]
    labels = second_pass(labels, outside, headings, GOOD if main else BAD)
    return " ".join(text for (_, text), label in zip(found, labels, strict=True) if label == GOOD)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(said, script, word, n): how often a word is on pages that say a language.

    A task adds up its pages and sends its counts on whenever it has COUNTED of them.
    """
    counts: dict[str, Counter] = {}

    def out() -> pd.DataFrame:
        rows = [(said, word, n) for said, found in counts.items() for word, n in found.items()]
        counts.clear()
        return pd.DataFrame(
            {
                "said": pd.Series([said for said, _, _ in rows], dtype=object),
                "script": pd.Series([script(word[0]) for _, word, _ in rows], dtype=object),
                "word": pd.Series([word for _, word, _ in rows], dtype=object),
                "n": pd.Series([n for _, _, n in rows], dtype="int64"),
            }
        )

    for batch in batches:
        for page in batch["page"]:
            if page:
                found = counts.setdefault(language(page), Counter())
                found.update(WORDS.findall(NO_TEXT.sub(" ", page).lower()))
        if sum(map(len, counts.values())) >= COUNTED:
            yield out()
    yield out()


def stop_words(pages: DataFrame, page: str) -> Stops:
    """The stop words of every language and script of a table, with their share, from all its pages.

    Words are counted in the tasks and added up by a grouped aggregate. What reaches the driver is at
    most 1 / FREQUENT words for each of GROUPS groups: some 12 MB. Null and empty pages count nothing,
    repeated pages count each time, an empty table gives no stop words; other columns are not read.
    """
    counts = stored(
        pages.select(F.col(page).alias("page"))
        .mapInPandas(_word_counts, "said string, script string, word string, n long")
        .groupBy("said", "script", "word")
        .agg(F.sum("n").alias("n"))
    )
    # Words on pages that say a language count for it and for their script.
    of_script = F.col("script").alias("group")
    of_both = F.concat_ws(" ", "said", "script").alias("group")
    sums = counts.groupBy("said", "script").agg(F.sum("n").alias("n"))
    totals = sums.select(of_script, "n").unionAll(sums.where("said <> ''").select(of_both, "n"))
    totals = totals.groupBy("group").agg((F.sum("n") + PRIOR_WORDS).alias("total"))
    largest = totals.orderBy(F.desc("total"), "group").limit(GROUPS)
    # A word that is frequent in a script is so in one of the languages of its pages at least.
    least = sums.select("said", "script", (F.col("n") * FREQUENT).alias("least"))
    # Pairs of two letters and a script are few.
    likely = counts.join(F.broadcast(least), ["said", "script"]).where("n >= least")
    likely = likely.select("script", "word").distinct()
    frequent = counts.join(likely, ["script", "word"]).select("said", "script", "word", "n")
    frequent = (
        frequent.select(of_script, "word", "n")
        .unionAll(frequent.where("said <> ''").select(of_both, "word", "n"))
        .groupBy("group", "word").agg(F.sum("n").alias("n"))
        .join(F.broadcast(largest), "group")
        .where(F.col("n") >= F.col("total") * FREQUENT)
        .select("group", "word", (F.col("n") / F.col("total")).alias("share"))
    )
    stops: dict[str, tuple[set, list]] = {}
    for row in frequent.orderBy("group", "word").collect():
        words, shares = stops.setdefault(row["group"], (set(), []))
        words.add(row["word"])
        shares.append(row["share"])
    return {
        group: (frozenset(words), sum(shares))
        for group, (words, shares) in stops.items()
        if sum(shares) >= USUAL
    }


def extract(page: Column, stops: Stops | None = None) -> Column:
    """The main text of a column of pages, by the stop words of the table (see `stop_words`).

    Whole pages are read. Null and empty pages give ''; every row is judged by itself, so repeated
    rows give the same text, and an empty table gives an empty column.
    """

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, stops) for page in pages], dtype=object)

    return extracted(page)
