"""Main text of web pages by two passes over blocks.

The first pass decides blocks by link density, length and density of stop words, as good or bad or not yet; where a block
stands is one feature more. The second lets the undecided ones inherit from their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, per_batch

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: Elements whose content isn't markup or isn't shown; it ends with their end tag or the page.
RAW = frozenset("script style noscript template svg iframe object textarea select button title xmp".split())
QUOTED = re.compile(r"""[^>"']*(["'>])""")
#: Tags that begin and end blocks.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: What these hold isn't the page's main text.
AWAY = frozenset("nav footer aside form menu dialog fieldset head".split())
INSIDE = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that tell the same of any element.
NAMED = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted promotion related replies reply respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget complementary contentinfo search".split())
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=]|$)|display\s*:\s*none""", re.I)
#: The most frequent words of some languages.
STOP = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so said what up its about into than them can only other"  # English
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"  # German
    " le la les des et en un une du que est pour dans qui par sur pas au plus avec ce il sont ne se"  # French
    " el los las y del se por con para una su al lo como más pero sus este ya o".split()  # Spanish
)


@dataclass(frozen=True)
class Rules:
    """Lengths in characters, densities as shares: of characters in links, of words that are stop words."""

    long: int = 200
    short: int = 70
    links: float = 0.2
    article_links: float = 0.8
    stop: float = 0.3


@dataclass
class Block:
    text: str
    linked: int
    place: str  # article, away, or open
    heading: bool
    label: str = field(default="")


def away_by_name(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        if NAMED & set(re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower())):
            return True
    return bool(HIDDEN.search(attributes))


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it ends an element, attributes) of each piece of markup; comments and the like, and elements whose content isn't shown, have no name. Each character is looked at a bounded number of times."""
    at, quotes = page.find("<"), True
    ends: dict[str, re.Pattern] = {}
    while at >= 0:
        if page.startswith(("<!", "<?"), at):
            mark = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ">"
            end = page.find(mark, at + 2)
            end = len(page) if end < 0 else end + len(mark)
            yield at, end, "", False, ""
            at = page.find("<", end)
            continue
        closes = page.startswith("/", at + 1)
        m = NAME.match(page, at + 1 + closes)
        if not m:
            at = page.find("<", at + 1)
            continue
        end = page.find(">", m.end())
        if end < 0:
            return  # no tag ends any more
        if quotes:
            i = m.end()
            while (q := QUOTED.match(page, i)) and q[1] != ">":
                i = page.find(q[1], q.end()) + 1
                if not i:
                    break
            if q and i:
                end = q.end() - 1
            else:
                quotes = False  # a quote that nothing closes: from here on tags end at the next >
        name = m[0].lower()
        if name in RAW and not closes:
            if name not in ends:
                ends[name] = re.compile(rf"</{name}\s*>", re.I)
            close = ends[name].search(page, end)
            yield at, (close.end() if close else len(page)), "", False, ""
            at = page.find("<", close.end()) if close else -1
            continue
        yield at, end + 1, name, closes, page[m.end() : end]
        at = page.find("<", end + 1)


class Open:
    """The open elements with the place inside each, and how many there are of each kind."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.all: list[tuple[str, str]] = [("", "open")]
        self.names: Counter[str] = Counter()
        self.kinds: Counter[str] = Counter()

    def push(self, name: str, place: str) -> None:
        self.all.append((name, place))
        self.names[name] += 1
        self.kinds[place] += 1
        self.kinds[f"{place} {name}"] += 1

    def pop(self) -> tuple[str, str]:
        name, place = self.all.pop()
        self.names[name] -= 1
        self.kinds[place] -= 1
        self.kinds[f"{place} {name}"] -= 1
        return name, place


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, those without text left out. Elements that aren't closed end with what holds them."""
    out: list[Block] = []
    opened = Open()
    parts: list[str] = []
    linked = in_link = 0
    heading = False

    def close() -> None:
        nonlocal linked, heading
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, min(linked, len(text)), opened.all[-1][1], heading))
        parts.clear()
        linked, heading = 0, False

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            t = html.unescape(raw)
            parts.append(t)
            if in_link:
                linked += len(" ".join(t.split()))

    at = 0
    for start, end, name, closes, attributes in markup(page):
        say(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = 0 if closes else 1
        elif closes:
            if name in BLOCK:
                close()
            if opened.names[name]:
                place = opened.all[-1][1]
                while opened.names[name] and opened.all[-1][0] != name:
                    opened.pop()
                last = opened.pop()
                if {place, last[1]} != {opened.all[-1][1]} and parts:
                    opened.all.append(("", place))  # what was said stands where it was said
                    close()
                    opened.all.pop()
        elif name not in VOID or name == "hr":
            if name in BLOCK:
                close()
                in_link = 0
            if name == "hr":
                continue
            place = opened.all[-1][1]
            if name in INSIDE:
                held = any(opened.kinds[f"away {n}"] for n in ("aside", "form", "dialog"))
                if place == "away" and not held:
                    opened.clear()  # what stands before wasn't closed
                opened.push(name, "away" if held else "article")
                continue
            if name == "body":
                opened.clear()
            elif name in AWAY or (name == "header" and place != "article") or (name != "html" and away_by_name(attributes)):
                if parts:
                    close()
                opened.push(name, "away")
            elif name in BLOCK or opened.kinds["away"]:
                if name == "p" and opened.all[-1][0] == "p":  # a paragraph ends the one before
                    opened.pop()
                    place = opened.all[-1][1]
                opened.push(name, place)
            if name[0] == "h" and name[1:].isdigit():
                heading = True
    say(page[at:])
    close()
    return out


def first_pass(b: Block, rules: Rules) -> str:
    """good, bad, or undecided: near (some stop words), weak (long, without, in an article), short."""
    links = b.linked / len(b.text)
    words = b.text.lower().split()
    stop = sum(w.strip(".,;:!?\"'()»«") in STOP for w in words) / max(1, len(words))
    article = b.place == "article"
    if b.place == "away" or links > (rules.article_links if article else rules.links) or (not article and "\xa9" in b.text):
        return "bad"
    if len(b.text) < rules.short:
        return "bad" if b.linked and not article else "short"
    if stop >= rules.stop:
        return "good" if len(b.text) > rules.long else "near"
    return "weak" if article else "bad"


def classify(found: list[Block], rules: Rules) -> None:
    """Labels each block good or bad. Undecided ones inherit from the nearest decided blocks around them: both alike, that; else, near and weak ones, headings before a good one and all of an article's are good. Within an article only its own blocks count, and its ends speak for good; elsewhere a page's ends speak for bad."""
    for b in found:
        b.label = first_pass(b, rules)

    def nearest(order: list[Block]) -> list[str]:
        """The label of each block's nearest decided one, of those before it."""
        out, last = [], {"article": "good", "open": "bad", "away": "bad"}
        for b in order:
            out.append(last[b.place])
            if b.label in ("good", "bad"):
                last[b.place] = b.label
                if b.place != "article":
                    last["open"] = b.label
            elif b.place == "article":
                last["open"] = "good"
        return out

    before, after = nearest(found), nearest(found[::-1])[::-1]
    for b, x, y in zip(found, before, after, strict=True):
        if b.label not in ("good", "bad"):
            b.label = x if x == y else "good" if b.place == "article" or b.label == "near" or (b.heading and y == "good") else "bad"


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The good blocks, each with runs of white space as one space, joined by an empty line."""
    found = blocks(page or "")
    classify(found, rules)
    return "\n\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of pages (page_id, url, html).

    Kept are the good blocks' texts: what articles hold but menus, headers and footers of the page, sidebars, notices,
    adverts, forms, scripts, styles and readers' comments; without an article, what reads like running text. Character
    references are decoded. A null or empty html, or one without good blocks, has an empty text and 0; a null url stays.
    Markup that isn't closed ends with what holds it or the page. Repeated rows give repeated results, empty tables no
    rows; other columns are left out. Pages are read whole, where they are, in time that grows with their length; no shuffle.
    """
    batches_of(pages.sparkSession)

    def run(ids: list[int], urls: list[str | None], htmls: list[str | None]) -> list:
        texts = [main_text(h, rules) for h in htmls]
        return [ids, urls, texts, [len(t) for t in texts]]

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(per_batch(run, schema, ["page_id", "url", "html"]), "page_id long, url string, text string, n_chars long")
