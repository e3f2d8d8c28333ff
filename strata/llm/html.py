"""HTML extraction by two passes of block rules.

The page is cut into blocks at block-level tags.  The first pass decides blocks by where they
stand and by their text: a block inside a container that holds no article text (menus, headers,
footers, sidebars, notices, adverts, forms, comments; by tag, role, class or id) is boilerplate
(an article in it with more text than the page has outside boilerplate overrides it).  Every other
block is judged by its text: long blocks with enough function words and few links are content,
blocks of links are boilerplate, and short or sparse blocks stay ambiguous.  Standing in the
article's container (article or main, by tag, role or property) is evidence, not a verdict: it
stands in for the function words of a long block, and a single block of links stays ambiguous
there, as a title may be one (so do two; three in a row are a list of links).  Where the page's
text holds hardly any of the known function words, its language is taken as unknown and length alone
speaks for a block.  In the second pass an ambiguous block takes the label of its nearest
decided neighbours on its own side of the article's border: both alike decide it, otherwise the
nearer one does, except that a block of text inside an article is boilerplate only between two blocks of
boilerplate.  On equal distance, where nothing is decided, or in an article without a block that
is content by its text, the border decides: content inside an article, boilerplate outside and in
an article of links alone.  If all this leaves no content, the ambiguous blocks that are no links are it.
A run of text inside a paragraph that its own element marks as hidden or as boilerplate (an advert in a
span) is left out of the block.

Text is never cut: every content block is kept whole, its character references decoded, white
space made one blank and trimmed, blocks joined by one newline.  A null or empty page, or one
without content, gives an empty text; unclosed and stray tags are accepted, in time that is
linear in the page; repeated rows are extracted alike; an empty table gives an empty result.  Further
columns stay as they are; one that has the name of the new text column is replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fields, load, map_rows
from strata.llm.quality import FUNCTION_WORDS

# Tags that end a block, tags whose content is never text, void tags.
BLOCK_TAGS = frozenset("""address article aside blockquote body br button caption center dd details dialog
div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul
""".split())
DROPPED_TAGS = frozenset("""script style noscript template head title svg math canvas iframe object
textarea select button audio video map""".split())
RAW_TAGS = ("script", "style", "textarea", "title")
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOILER_TAGS = frozenset("nav aside footer form menu dialog search".split())
ARTICLE_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert menu
menubar form""".split())
BOILER_NAMES = frozenset("""ad ads adv advert advertisement advertising banner sponsor sponsored promo
promotion popup modal overlay cookie cookies consent gdpr notice notices alert newsletter subscribe
subscription signup login share sharing social related recommended recommendations recommend nav
navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget widgets footer masthead
comment comments disqus replies reply respond toolbar pagination pager copyright legal disclaimer
skip search tags toc outbrain taboola""".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only after an equals sign; elsewhere, or unclosed, it is a character.
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)",
    re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'<>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)""")
_NAME = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.IGNORECASE) for t in RAW_TAGS}

CONTENT, BOILER, AMBIGUOUS, HIDDEN = 1, 0, -1, -2
LONG_CHARS = 140
LINK_ROW = 3  # blocks of links in a row that are a list of links inside an article
KNOWN_SHARE = 0.05  # function words in the text of a page whose language is known


def _boiler_name(value: str) -> bool:
    """Whether a class or id value holds a token that is a boilerplate name or made only of such:
    ``sidebar`` and ``cookie-notice``, but not ``has-sidebar``."""
    return any(parts and BOILER_NAMES.issuperset(parts) for parts in map(_NAME.findall, value.lower().split()))


def _zone(tag: str, attrs: str, inside_article: bool) -> int:
    """What opening this element says of the blocks in it: CONTENT, BOILER, HIDDEN or AMBIGUOUS (nothing)."""
    named = {}
    if "=" in attrs:
        named = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    if named.get("aria-hidden") == "true" or "hidden" in _NAME.findall(_ATTR.sub("", attrs)) \
            or "display:none" in named.get("style", "").replace(" ", ""):
        return HIDDEN
    if tag in BOILER_TAGS or tag == "header" and not inside_article:
        return BOILER
    role = named.get("role", "").lower()
    if role in BOILER_ROLES:
        return BOILER
    if tag not in ("html", "body", "main") and any(_boiler_name(named.get(k, "")) for k in ("class", "id")):
        return BOILER
    if tag in ARTICLE_TAGS or role in ("main", "article") or named.get("itemprop") == "articleBody":
        return CONTENT
    return AMBIGUOUS


def _freed(found: list[tuple[str, int, int, int, int]], outer: list[int], long_chars: int) -> set[int]:
    """Articles inside boilerplate that override it: long, with more text outside links than the page
    has outside boilerplate.  One inside another is also held against those freed before it."""
    sizes = [0] * len(outer)
    free = 0
    for text, z, linked, inner, article in found:
        if z not in (BOILER, HIDDEN):
            free += len(text) - linked
        elif inner == CONTENT:
            sizes[article] += len(text) - linked
    freed: set[int] = set()
    more = 0
    for article in range(1, len(outer)):
        if sizes[article] >= long_chars and sizes[article] > free + more * (outer[article] in freed):
            freed.add(article)
            more += sizes[article]
    return freed


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """Blocks in page order: (text, zone, characters of it inside links, number of its article or 0)."""
    out: list[tuple[str, int, int, int, int]] = []
    # Open elements: tag, zone that holds inside, the same as its article alone says, the article's
    # number, and whether the element is an inline one that takes its text out of the block.
    stack: list[tuple[str, int, int, int, bool]] = []
    open_blocks: Counter[str] = Counter()
    open_inline = [Counter()]  # inline elements by name, for each open block
    off = 0
    outer = [0]  # by article, the one around it
    parts: list[str] = []
    linked = 0
    links = 0
    dropped = 0
    at = 0

    def zone() -> tuple[int, int, int]:
        return stack[-1][1:4] if stack else (AMBIGUOUS, AMBIGUOUS, 0)

    def close_top() -> str:
        nonlocal links, dropped, off
        name, *_, out_of_block = stack.pop()
        links -= name == "a"
        dropped -= name in DROPPED_TAGS
        off -= out_of_block
        if name in BLOCK_TAGS:
            open_blocks[name] -= 1
            open_inline.pop()
        else:
            open_inline[-1][name] -= 1
        return name

    def flush(now: tuple[int, int, int]) -> None:
        nonlocal linked
        text = _SPACE.sub(" ", _html.unescape("".join(parts))).strip()
        if text:
            out.append((text, now[0], linked, *now[1:]))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not dropped and not off:
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    pos, size = 0, len(page)
    while pos < size:
        m = _TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        add(page[pos:m.start()])
        pos = m.end()
        if m["cdata"] is not None:
            add(_html.escape(m["cdata"], quote=False))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in BLOCK_TAGS:
            flush(zone())
        if not m["close"]:
            if tag in RAW_TAGS:  # its content is not markup
                end = _RAW_END[tag].search(page, pos)
                pos = end.end() if end else size
                continue
            if tag in VOID_TAGS or m["attrs"].rstrip().endswith("/") and tag not in BLOCK_TAGS:
                continue
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                close_top()  # an open paragraph or item ends where the next begins
            held, inner, article = zone()
            said = _zone(tag, m["attrs"], inner == CONTENT)
            if said == CONTENT and inner in (BOILER, AMBIGUOUS):
                outer.append(article)
                article = len(outer) - 1
            inner = HIDDEN if HIDDEN in (inner, said) else inner if said == AMBIGUOUS else said
            block = tag in BLOCK_TAGS
            out_of_block = not block and said in (HIDDEN, BOILER)
            stack.append((tag, HIDDEN if HIDDEN in (held, said) else BOILER if BOILER in (held, said)
                          else CONTENT if CONTENT in (held, said) else AMBIGUOUS, inner, article, out_of_block))
            links += tag == "a"
            dropped += tag in DROPPED_TAGS
            off += out_of_block
            if block:
                open_blocks[tag] += 1
                open_inline.append(Counter())
            else:
                open_inline[-1][tag] += 1
        elif open_blocks[tag] if tag in BLOCK_TAGS else open_inline[-1][tag]:
            # Close the nearest such element; an inline tag never closes a block around it.
            while close_top() != tag:
                pass
    flush(zone())
    freed = _freed(out, outer, LONG_CHARS)
    # An article that stays boilerplate is no article.
    held = {article for _, z, _, inner, article in out if z in (BOILER, HIDDEN) and inner == CONTENT} - freed
    return [(text, max(inner if article in freed else z, BOILER) if z != AMBIGUOUS else z, linked, 0 if article in held else article)
            for text, z, linked, inner, article in out]


def classify(found: list[tuple[str, int, int, int]], *, max_links: float = 0.5, long_chars: int = LONG_CHARS,
             short_chars: int = 60, function_share: float = 0.15) -> list[int]:
    """Two passes; returns CONTENT or BOILER per block."""
    linky = [linked > max_links * len(text) for text, _, linked, _ in found]
    row = [0] * len(found)  # how many blocks of links stand in a row here, in one article
    for i in range(len(found)):
        if linky[i] and not row[i]:
            end = i
            while end < len(found) and linky[end] and found[end][1] == found[i][1] and found[end][3] == found[i][3]:
                end += 1
            row[i:end] = [end - i] * (end - i)
    plain = [text.lower().split() for (text, z, *_), x in zip(found, linky) if z != BOILER and not x]
    total = sum(map(len, plain))
    known = sum(w in FUNCTION_WORDS for words in plain for w in words) >= KNOWN_SHARE * total
    labels = []
    for i, (text, z, _, article) in enumerate(found):
        if z == BOILER:
            labels.append(BOILER)
        elif linky[i]:
            # A few blocks of links inside an article may be its title or a part of its text.
            labels.append(BOILER if z != CONTENT or row[i] >= LINK_ROW else AMBIGUOUS)
        else:
            words = text.lower().split()
            share = sum(map(FUNCTION_WORDS.__contains__, words)) / max(1, len(words))
            if len(text) >= long_chars and (share >= function_share or z == CONTENT) or not known and len(text) >= long_chars // 2:
                labels.append(CONTENT)
            elif len(text) >= short_chars and share >= 2 * function_share:
                labels.append(CONTENT)
            else:
                labels.append(AMBIGUOUS)
    final = list(labels)
    sides: dict[int, list[int]] = {}
    for i, (_, z, _, article) in enumerate(found):
        # Boilerplate inside an article is no part of its text.
        if not article or z == CONTENT:
            sides.setdefault(article, []).append(i)
    for article, members in sides.items():
        border = CONTENT if article and not all(linky[i] for i in members) else BOILER
        decided = [i for i in members if labels[i] != AMBIGUOUS]
        if article and CONTENT not in (labels[i] for i in decided):
            decided = []
        at = 0
        for i in members:
            if labels[i] != AMBIGUOUS:
                continue
            while at < len(decided) and decided[at] < i:
                at += 1
            around = decided[max(0, at - 1):at + 1] if at else decided[:1]
            near = min((abs(k - i) for k in around), default=0)
            said = {labels[k] for k in around if abs(k - i) == near}
            if len({labels[k] for k in around}) == 1:
                said = {labels[around[0]]}
            if article and not linky[i] and (len(around) < 2 or CONTENT in (labels[k] for k in around)):
                said = {border}
            final[i] = said.pop() if len(said) == 1 else border
    if CONTENT not in final:
        final = [CONTENT if label == AMBIGUOUS and not x else f for label, x, f in zip(labels, linky, final)]
    return final


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(text for (text, *_), keep in zip(found, classify(found)) if keep == CONTENT)


def extract(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``df`` with the main text of each page."""

    def setup():
        return lambda pages: [[main_text(p) for p in pages]]

    return map_rows(df, [html_col], fields(f"{name} string"), setup, slice_rows=128)


def op4_html(spark, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text",
                                 F.char_length("text").cast("long").alias("n_chars"))
