"""The main text of web pages, by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by their text: how dense stop words
are, how long they are, and how much of them is links. Headings and short blocks without links remain open. Tags and
names are evidence: parts set aside go unless they wrap almost all accepted text, and a part tagged as main is the
main one if most accepted text stands in it. In the second pass these take the label of the nearest decided blocks before
and after them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import map_rows, table

# Common function words of the languages, tags by what they do, and names of parts of a page.
STOP_WORDS = frozenset(
    (
        "the of and to in is was for that with on are by this it be from as at an or not have has had were which but "
        "le la les de des du et un une en est que qui dans pour par sur au aux avec ne pas plus se ce il elle son sa "
        "der die das und den dem ein eine ist von zu mit sich auf für nicht als auch es im am aus bei nach oder wie "
        "el los las y en un una es del al con por para se su lo como más pero sus o este"
    ).split()
)
SILENT = frozenset("script style noscript template svg math iframe object canvas head title select option textarea button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    (
        "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
        "thead tr ul caption br"
    ).split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset(["article", "main"])
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"sidebar|side-?bar|footer|header|masthead|topbar|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscri\w*|signup|login|comments?|comment-?list|disqus|replies|respond|share|sharing|social|related|recommended|"
    r"widget\w*|pager|pagination|toolbar|search)(?:$|[\s_-])",
    re.IGNORECASE,
)
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article-?(?:body|content|text)|post-?(?:body|content)|entry-?content|story-?body|main-?content)(?:$|[\s_-])", re.IGNORECASE)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""",
    re.DOTALL,
)
# The same where a quote that nothing closes has been met: a tag ends at the next sign that ends one.
LOOSE_PIECE = re.compile(PIECE.pattern.replace("""(?:[^>"']|"[^"]*"|'[^']*')*+""", "[^>]*+"), re.DOTALL)
START = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, OPEN = 1, 0, -1


@dataclass(frozen=True)
class Rules:
    """The thresholds: blocks shorter than ``short`` letters are open; beyond ``links`` of its letters in links a
    block is not text; with at least ``many_stops`` stop words among its words it is, with fewer than ``few_stops`` not."""

    short: int = 70
    links: float = 0.2
    few_stops: float = 0.05
    many_stops: float = 0.15


@dataclass
class Block:
    """One block: its text, letters in links, whether it is a heading, and where it stands: the numbers of the parts
    around it that are set aside by tag or name, and whether one is tagged as main."""

    text: str
    linked: int
    heading: bool
    asides: tuple[int, ...]
    main: bool
    label: int = OPEN


def part_of(tag: str, attributes: str, aside: bool, main: bool) -> tuple[bool, bool, bool]:
    """Whether what is inside a tag is hidden, set aside, or main text, given what holds around it."""
    found = {}
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    if tag in ("html", "body"):
        found = {n: v for n, v in found.items() if n not in ("class", "id", "role")}  # they tell about the layout
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    named = f"{found.get('class', '')} {found.get('id', '')}"
    named_aside = bool(ASIDE_NAMES.search(named)) or found.get("role", "").lower() in ASIDE_ROLES
    named_main = bool(MAIN_NAMES.search(named)) or found.get("itemprop") == "articleBody" or found.get("role") in MAIN
    if tag in MAIN or named_main:
        return hidden, named_aside or (aside and main), True
    if tag in ASIDE or named_aside or (tag == "header" and not main):
        return hidden, True, main
    return hidden, aside, main


def pieces_of(page: str) -> Iterator[re.Match]:
    """Tags, comments and the like, in order. What begins a tag that nothing ends is text."""
    at, pattern, last = 0, PIECE, page.rfind(">")
    while (start := START.search(page, at)) is not None:
        place, at = start.start(), start.end()
        if place > last and start[0] not in ("<!", "<?"):
            continue
        match = pattern.match(page, place)
        if match is None and pattern is PIECE:
            # Looked at to the end of the page once, not once for each tag.
            pattern = LOOSE_PIECE
            match = pattern.match(page, place)
        if match is not None:
            at = match.end()
            yield match


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, those without text left out. Tags need not match: an end closes what is open
    inside of it, and one that nothing opened is passed over."""
    blocks: list[Block] = []
    words: list[str] = []
    linked = 0
    heading = False
    stack: list[tuple[str, bool, tuple[int, ...], bool, bool, bool]] = []  # tag, hidden, asides, main, link, heading
    hidden = main = link = False
    asides: tuple[int, ...] = ()
    parts = 0
    silent, unclosed = "", set()

    def close() -> None:
        nonlocal words, linked
        text = " ".join("".join(words).split())
        if text:
            blocks.append(Block(text, linked, heading, asides, main))
        words, linked = [], 0

    at = 0
    for match in pieces_of(page):
        if match.start() > at and not silent and not hidden:
            text = html.unescape(page[at : match.start()])
            words.append(text)
            if link:
                linked += len("".join(text.split()))
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if silent:
            if match[1] and tag == silent:
                silent = ""
            continue
        ends = bool(match[1])
        if tag in SILENT:
            if tag in BLOCK:
                close()
            if not ends and not match[3].endswith("/"):
                # Without its end tag it would swallow the page.
                if tag not in unclosed and re.compile(rf"</{tag}\b", re.IGNORECASE).search(page, at):
                    silent = tag
                else:
                    unclosed.add(tag)
            continue
        if tag in BLOCK:
            close()
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    _, hidden, asides, main, link, heading = stack[i]
                    del stack[i:]
                    break
        elif tag not in VOID and not match[3].endswith("/"):
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                _, hidden, asides, main, link, heading = stack.pop()
            stack.append((tag, hidden, asides, main, link, heading))
            # Whether this tag itself sets aside, and whether it lifts what its surroundings do.
            now_hidden, own, now_main = part_of(tag, match[3], False, main)
            if not part_of(tag, match[3], True, main)[1] or (own and now_main and not main):
                asides = ()
            if own:
                parts += 1
                asides += (parts,)
            main = now_main
            hidden = hidden or now_hidden
            link = link or tag == "a"
            heading = heading or tag in HEADINGS
    if not silent and not hidden:
        words.append(html.unescape(page[at:]))
    close()
    return blocks


def barred(block: Block, rules: Rules) -> bool:
    """Whether a block is no text wherever it stands: links, or a short line of rights."""
    letters = max(1, len(block.text.replace(" ", "")))
    return block.linked > rules.links * letters or ("©" in block.text and len(block.text) < 3 * rules.short)


def by_text(block: Block, rules: Rules) -> int:
    """What the text alone tells of a block: stop words, length and links."""
    size = len(block.text)
    if barred(block, rules):
        return BAD
    if block.heading or size < rules.short:
        return OPEN
    words = WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= rules.many_stops:
        return GOOD
    return BAD if density < rules.few_stops and size < 3 * rules.short else OPEN


def wrappers(blocks: list[Block], most: float = 0.75) -> set[int]:
    """Parts that are set aside though almost all accepted text of the page stands in them: they wrap the page."""
    held: dict[int, int] = {}
    for block in blocks:
        if block.label == GOOD:
            for part in block.asides:
                held[part] = held.get(part, 0) + len(block.text)
    total = sum(len(b.text) for b in blocks if b.label == GOOD)
    return {part for part, size in held.items() if size > most * total}


def inherit(blocks: list[Block]) -> None:
    """The second pass: an open block takes the label of its decided neighbours. Where they differ the nearer one
    counts, the text on a tie; a page without a decided block keeps all that is open and not set aside."""
    count = len(blocks)
    before: list[int | None] = [None] * count
    last = None
    for i, block in enumerate(blocks):
        before[i] = last
        if block.label != OPEN:
            last = i
    after = None
    labels = []
    for i in range(count - 1, -1, -1):
        block = blocks[i]
        if block.label != OPEN:
            after = i
            labels.append(block.label)
            continue
        left = before[i]
        if left is None and after is None:
            labels.append(GOOD)
        elif left is None or after is None:
            labels.append(blocks[after if left is None else left].label)
        elif blocks[left].label == blocks[after].label:
            labels.append(blocks[left].label)
        elif i - left == after - i:
            labels.append(GOOD)
        else:
            labels.append(blocks[left if i - left < after - i else after].label)
    for block, label in zip(blocks, reversed(labels), strict=True):
        block.label = label


def main_text(page: str, rules: Rules = Rules()) -> str:
    """The main text of a page."""
    blocks = blocks_of(page)
    for block in blocks:
        block.label = by_text(block, rules)
    lifted = wrappers(blocks)
    near = [b for b in blocks if lifted.issuperset(b.asides)]
    # What is tagged as main is so only if most accepted text stands there; else those are cards beside the story.
    sizes = {side: sum(len(b.text) for b in near if b.label == GOOD and b.main == side) for side in (True, False)}
    tagged = any(b.main for b in near)
    if tagged:
        # Where no tagged block is accepted, being short or without stop words, what is no link or heading counts, and
        # twice for its tag.
        open_text = sum(len(b.text) for b in near if b.main and not b.heading and not barred(b, rules))
        sizes[True] = sizes[True] or 2 * open_text
        side = sizes[True] >= sizes[False]
        near = [b for b in near if b.main == side]
        if side:
            # The tag speaks for a block that only lacks stop words, such as a row of a table: its neighbours decide.
            for block in near:
                if block.label == BAD and not barred(block, rules):
                    block.label = OPEN
    chosen = {id(b) for b in near}
    for block in blocks:
        if id(block) not in chosen:
            block.label = BAD
    # Only blocks of the main part are each other's neighbours, if the page has one.
    inherit(near if tagged else blocks)
    return " ".join(b.text for b in blocks if b.label == GOOD)


def extract(pages: DataFrame, key: str, url: str, page: str, rules: Rules = Rules()) -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every row.

    Null pages and pages without main text give an empty text. Null keys and addresses are kept, repeated rows give a row
    each, an empty table gives no rows; other columns are not looked at.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = [main_text(p or "", rules) for p in batch["page"]]
            yield {"key": batch["key"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    found = map_rows(rows, work, f"key {kind}, url string, text string, n_chars bigint")
    return found.withColumnsRenamed({"key": key, "url": url})


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), "page_id", "url", "html")
