"""Main text of HTML pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.common import staged, table

#: Markup. Each alternative ends at the next "<" if it is not closed before, and repeats are possessive: time is linear.
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(script|style|noscript|template|iframe|textarea|select|svg|title|object|button)\b(?:"[^"]*"|'[^']*'|[^'"<>])*+>(?:.*?</\1\s*>|.*\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/><]*)((?:"[^"]*"|'[^']*'|[^'"<>])*+)>|<[!?][^<>]*+>?|<[a-zA-Z/][^<>]*+(?:>|(?=<)|\Z)""",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)

# Element names of the HTML standard by what they mean here.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 html body".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav aside footer form dialog menu".split())
#: Words of class and id, and roles, of what is not part of an article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer login menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply respond share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Stop words are learned: the most frequent words, by the pages that have them, that cover STOP_COVER of all; STOP_WORDS at
#: most. A word counts once a page, so that no page decides.
STOP_COVER, STOP_WORDS = 0.25, 2_000
#: Words of a block: fewer than SHORT leave it open, LONG make it text if it has few links.
SHORT, LONG = 10, 25
#: Stop-word density: from HIGH on a block of middle length is text, inside an article from LOW on; below LOW it is not,
#: inside an article it is open.
LOW, HIGH = 0.08, 0.2
MAX_LINKS = 0.33


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    aside: bool
    region: int
    heading: bool


def blocks_of(page: str) -> tuple[list[Block], dict[int, int]]:
    """The blocks of a page in order, and the number of words in each outermost article or main element (by number)."""
    found: list[Block] = []
    words: dict[int, int] = {}
    pieces: list[str] = []
    linked = links = 0
    stack: list[tuple[str, bool, int]] = []  # open containers: name, aside, region (0: none)
    open_names: Counter = Counter()
    regions = at = 0
    heading = False

    def flush() -> None:
        nonlocal linked, heading
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                _, aside, region = stack[-1] if stack else ("", False, 0)
                found.append(Block(text, linked, aside, region, heading))
                if region and not aside:
                    words[region] = words.get(region, 0) + text.count(" ") + 1
        linked, heading = 0, False

    def text_piece(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece)  # markup within a reference ends it
            pieces.append(piece)
            if links:
                linked += len("".join(piece.split()))

    for m in TOKEN.finditer(page):
        text_piece(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if name == "br" or not name:
            if name == "br":
                pieces.append(" ")
        elif name == "a":
            links = max(0, links - 1) if m[2] else links + 1
        elif name in BLOCKS:
            flush()
            links = 0
            if m[2]:
                if name in CONTAINERS and open_names[name]:
                    while True:
                        gone = stack.pop()[0]
                        open_names[gone] -= 1
                        if gone == name:
                            break
            else:
                heading = name[0] == "h" and name[1:].isdigit()
                if name in CONTAINERS:
                    _, aside, region = stack[-1] if stack else ("", False, 0)
                    aside = aside or is_aside(name, m[4], region)
                    if name in MAIN and not region and not aside:
                        regions += 1
                        region = regions
                    if name in ("li", "tr", "td", "th", "dd", "dt") and stack and stack[-1][0] == name:
                        open_names[stack.pop()[0]] -= 1  # these close their like
                    stack.append((name, aside, region))
                    open_names[name] += 1
    text_piece(page[at:])
    flush()
    return found, words


def is_aside(name: str, attributes: str, region: int) -> bool:
    """Whether an element stands beside the article: by its name, role, class or id, or because it is not shown."""
    if name in ASIDE or name == "header" and not region:
        return True
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id") and not ASIDE_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
        if key == "role" and value in ASIDE_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def plain(word: str) -> str:
    return word.strip("!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~«»¿¡").lower()


def first_pass(block: Block, region: int, stops: frozenset[str]) -> bool | None:
    """True: text of the article, False: not; None: open. ``region``: the article element of the page, 0 without one.

    Links, length and stop words decide; standing in the article element only lowers the density that is asked for.
    """
    words = block.text.split()
    inside = region and block.region == region
    links = block.linked / max(1, len(block.text) - len(words) + 1)
    if block.aside or region and not inside:
        return False
    if links > MAX_LINKS:
        return None if inside and len(words) > 3 else False
    if len(words) < SHORT or block.heading:
        return None
    if len(words) >= LONG:
        return True
    density = sum(plain(w) in stops for w in words) / len(words)
    if density >= (LOW if inside else HIGH):
        return True
    return None if inside or density >= LOW else False


def main_text(page: str, stops: frozenset[str] = frozenset()) -> str:
    """First pass: each block is decided by stop-word density, length and link density, or left open. Second pass: open
    blocks take the label of the nearest decided block of their region; the next one on ties, and without any, that of
    their region: inside an article element text, else not."""
    blocks, words = blocks_of(page)
    region = max(words, key=lambda r: (words[r], -r), default=0)
    labels = [first_pass(b, region, stops) for b in blocks]
    inside = lambda i: not (blocks[i].aside or region and blocks[i].region != region)
    before: list[tuple[int, bool] | None] = []
    after: list[tuple[int, bool] | None] = [None] * len(blocks)
    last = None
    for i, label in enumerate(labels):
        if label is not None and inside(i):
            last = (i, label)
        before.append(last)
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        if labels[i] is not None and inside(i):
            last = (i, labels[i])
        after[i] = last
    kept = []
    for i, label in enumerate(labels):
        if label is None:
            a, b = before[i], after[i]
            nearest = b if b and (a is None or b[0] - i <= i - a[0]) else a
            label = nearest[1] if nearest else bool(region)
        if label:
            kept.append(blocks[i].text)
    return "\n\n".join(kept)


def learned_stops(df: DataFrame, source: str = "html") -> frozenset[str]:
    """The most frequent words of all pages' blocks, by the number of pages that have them, up to STOP_COVER of the sum of
    these numbers and STOP_WORDS words. Null pages have none; an empty table gives an empty set."""

    @arrow_udf("array<string>")
    def distinct(pages: pa.Array) -> pa.Array:
        words = [sorted({w for b in blocks_of(p.as_py())[0] if not b.aside for w in map(plain, b.text.split()) if w.isalpha() and len(w) < 64}) for p in pages]
        return pa.array(words, pa.list_(pa.string()))

    counts = df.select(F.explode(distinct(F.coalesce(F.col(source), F.lit("")))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("pages"))
    counts = staged(counts, "words")
    total = counts.agg(F.sum("pages")).first()[0] or 0
    found, covered = set(), 0
    for row in counts.orderBy(F.desc("pages"), "word").limit(STOP_WORDS).collect():
        if covered >= STOP_COVER * total:
            break
        covered += row["pages"]
        found.add(row["word"])
    return frozenset(found)


def extract_text(df: DataFrame, source: str = "html", out: str = "text", stops: frozenset[str] | None = None) -> DataFrame:
    """Add ``out``, the main text of the page in ``source``: blocks in page order, joined by two line feeds.

    ``stops``: stop words; they are learned from the pages if not given. Null and empty pages give the empty text, as do
    pages without an article. Character references are decoded and white space within a block is one space. Other columns
    stay, whatever their names; one named ``out`` is replaced. Repeated rows each get their text; an empty table gives an
    empty one. No shuffle but that of the word counts.
    """
    stops = learned_stops(df, source) if stops is None else stops

    @arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), stops) for p in pages], pa.string())

    return df.withColumn(out, texts(F.coalesce(F.col(source), F.lit(""))))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op6_html_text": op6_html_text}
