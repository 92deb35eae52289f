"""Main text of web pages, by two-pass block rules."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

#: Function words of the languages that pages come in (fixed lists).
STOP_WORDS = {
    "en": frozenset(
        """a an and are as at be been but by can do for from had has have he her his i if in is it its more no not of on or our she so than that the
        their there they this to was we were what when which who will with you""".split()
    ),
    "de": frozenset(
        """aber als am an auch auf aus bei bin das dem den der des die durch ein eine einen er es für hat ich im in ist mit nach nicht noch nur oder sich
        sie sind so um und von war wie wir zu zum zur""".split()
    ),
    "es": frozenset("al como con de del el en es esta este ha la las le lo los más me mi no o para pero por que se si sin su sus un una y ya".split()),
    "fr": frozenset("au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qui se ses son sont sur une vous".split()),
}
#: Share of stop words of prose, and of what may be prose; characters of a short and of a long block; most of its text that may be links.
STOP_HIGH, STOP_LOW, SHORT, LONG, LINKS = 0.12, 0.05, 80, 200, 0.3
#: Evidence from which a block is content, and below which it is not; what lies between inherits.
CONTENT, REJECT = 2.0, 0.0

#: Elements whose text is never shown or never prose.
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title", "xmp", "noframes", "noembed")
_SKIP = frozenset({*_RAW, "head", "nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "object", "canvas", "audio", "video", "label", "fieldset"})
_BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup
    hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words in class, id or role that mark what is not the article.
_BAD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|byline-links|captcha|comment(?:s|list|-?section|-?area)?|complementary|contentinfo|consent|cookies?|disqus|disclaimer|dropdown|footer|form|gdpr|header|hidden"
    r"|login|masthead|menu|menubar|modal|nav|navbar|navigation|newsletter|notices?|notification|alert|overlay|pager|pagination|paywall|popup|promo\w*|recommend\w*|related|replies|respond|search|share|sharing|shoutbox|sidebar|signup"
    r"|skip(?:-?link)?|social|sponsor\w*|subscri\w*|syndication|tags?|toc|toolbar|tooltip|trending|widget)(?:$|[\s_-])",
    re.I,
)
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|content|body)(?:$|[\s_-])", re.I)
#: The same on an article element: not the article of the page.
_OTHER_ARTICLE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|promo\w*|related|repl(?:y|ies)|sponsor\w*|teasers?)(?:$|[\s_-])", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[A-Za-z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in _RAW}
_WORD = re.compile(r"[^\W\d_]+")
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)
_RIGHTS = re.compile(r"(?:©|\(c\)\s|copyright\b)", re.I)


class Block:
    """A block's text, the characters of it in links, the section it stands in, whether the page marks it as its article
    (``inside``), whether its element is never prose (``vetoed``) or its class or id is that of something else (``marked``)."""

    __slots__ = ("text", "links", "parent", "inside", "vetoed", "marked", "heading", "stops", "label")

    def __init__(self, text: str, links: int, parent: int, inside: int, vetoed: bool, marked: bool, heading: bool):
        self.text, self.links, self.parent, self.inside, self.vetoed, self.marked, self.heading, self.label = text, links, parent, inside, vetoed, marked, heading, None
        words = _WORD.findall(text.lower())
        #: Share of stop words, by language.
        self.stops = {lang: sum(w in STOP_WORDS[lang] for w in words) / len(words) if words else 0.0 for lang in STOP_WORDS}


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order.  A block ends at any block element and at two line breaks in a row."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int, int]] = []  # name, vetoed, marked, inside (1: the main part, 2: an article), number of the section
    parts: list[tuple[str, bool]] = []
    links = breaks = sections = 0
    pos, end = 0, len(html)
    heading = False

    def flush() -> None:
        nonlocal parts, heading
        if parts:
            raw = "".join(x for x, _ in parts)
            text = " ".join(entities.unescape(raw).split())
            if text:
                linked = sum(len(" ".join(entities.unescape(x).split())) for x, a in parts if a)
                _, vetoed, marked, inside, section = stack[-1] if stack else ("", False, False, 0, 0)
                out.append(Block(text, linked, section, inside, vetoed, marked, heading))
            parts = []
        heading = False

    for m in _TOKEN.finditer(html):
        if m.start() < pos:
            continue
        if m.start() > pos:
            parts.append((html[pos : m.start()], links > 0))
            if html[pos : m.start()].strip():
                breaks = 0
        pos = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["close"]:
            if name in _BLOCK:
                flush()
            if name == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name == "br":
            breaks += 1
            parts.append((" ", False))
            if breaks > 1:
                flush()
            continue
        if name in _RAW:
            stop = _RAW_END[name].search(html, pos)
            if name in ("title", "textarea", "iframe") or name in ("svg", "math", "template", "noscript", "script", "style", "xmp", "noframes", "noembed"):
                pos = stop.end() if stop else end
            continue
        if name in _BLOCK:
            flush()
            links = 0
            if name == "p" or name in _HEADINGS:
                while stack and (stack[-1][0] == "p" or stack[-1][0] in _HEADINGS):
                    stack.pop()
            heading = name in _HEADINGS
        elif name == "a":
            links += 1
        if name in _VOID or (m["attrs"] or "").rstrip().endswith("/"):
            continue
        if name not in _BLOCK and name != "span" and name not in _SKIP:
            continue
        _, vetoed, marked, inside, section = stack[-1] if stack else ("", False, False, 0, 0)
        marks = {}
        if m["attrs"]:
            marks = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(m["attrs"])}
        named = f"{marks.get('class', '')} {marks.get('id', '')} {marks.get('role', '')}"
        article = name in ("article", "main") or marks.get("role") in ("main", "article")
        if name in _SKIP or (name == "header" and not inside):
            vetoed = True
        elif "display:none" in marks.get("style", "").replace(" ", "").lower() or "hidden" in marks or marks.get("aria-hidden") == "true":
            vetoed = True
        if name == "article" and _OTHER_ARTICLE.search(named):
            marked = True
        elif not article and name not in ("html", "body", "p", *_HEADINGS) and _BAD.search(named) and not (_GOOD.search(named) and not re.search(r"comment|side|foot|nav|menu|relat|share", named, re.I)):
            marked = True
        if article and not vetoed and not marked:
            inside = max(inside, 2 if name == "article" or marks.get("role") == "article" else 1)
        if name in ("article", "main", "section", "div", "td", "ul", "ol", "table", "aside", "header", "footer", "nav", "form", "body", "blockquote", "dl"):
            sections += 1
            # Quotes and lists belong to the section around them.
            section = section if name in ("blockquote", "ul", "ol", "dl") and not vetoed else sections
        stack.append((name, vetoed, marked, inside, section))
    if pos < end:
        # A page may be cut anywhere: what is left of a tag or of a character reference is no text.
        rest = html[pos:end]
        cut = rest.rfind("<")
        if cut >= 0 and re.match(r"<[A-Za-z/!?]|<\Z", rest[cut:]):
            rest = rest[:cut]
        parts.append((rest, links > 0))
    flush()
    return out


def reads(block: Block, lang: str | None) -> float:
    """What a block's own text says: stop words of the page's language, length, and links."""
    n, own = len(block.text), block.stops.get(lang, 0.0)
    score = 0.0
    if n >= SHORT or block.inside:
        score += 2.0 if own >= STOP_HIGH else 1.0 if own >= STOP_LOW and n >= SHORT else 0.0
    if n >= SHORT and lang and own < STOP_LOW and max(block.stops.values()) >= STOP_HIGH:
        score -= 1.0  # prose of another language than the page's
    if block.links > LINKS * n and not block.heading:
        score -= 3.0
    if _RIGHTS.match(block.text):
        score -= 3.0
    return score + (n >= LONG)


def classify(block: Block, lang: str | None, trust: float, believe_marks: bool) -> bool | None:
    """First pass: content (True), not content (False) or, for lack of evidence, neither.

    Markup is evidence beside the text: what stands in the page's article gains up to one
    point, what stands outside loses up to two (``trust``: how much of the page's prose is
    in it), and a class of menus, notices, adverts or comments outweighs all the rest.
    """
    if block.vetoed:
        return False
    score = reads(block, lang) + (trust if block.inside else -2 * trust) - 5 * (block.marked and believe_marks)
    return True if score >= CONTENT else False if score < REJECT else None


def inherit(blocks: list[Block]) -> None:
    """Second pass: undecided blocks take the label of the nearest decided block of their section,
    or else of the nearest ones on both sides, which must then agree on content; a heading may lead content.
    Of two equally near ones, content wins in the same section.  Blocks of vetoed elements,
    and lines of links in an article, say nothing of their neighbours."""
    n = len(blocks)
    for own in (True, False):
        before, after, last = [None] * n, [None] * n, {}
        for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
            last.clear()
            for i in order:
                key = blocks[i].parent if own else 0
                near[i] = last.get(key)
                if blocks[i].label is not None and not blocks[i].vetoed and not (blocks[i].inside and blocks[i].links > LINKS * len(blocks[i].text)):
                    last[key] = i
        new = {}
        for i, b in enumerate(blocks):
            if b.label is not None:
                continue
            sides = [(abs(j - i), not blocks[j].label, blocks[j].label) for j in (before[i], after[i]) if j is not None]
            if own:
                if sides:
                    new[i] = min(sides)[2]
            else:
                new[i] = len(sides) == 2 and all(x[2] for x in sides) or (b.heading and after[i] is not None and after[i] - i == 1 and blocks[after[i]].label is True)
        for i, label in new.items():
            blocks[i].label = label


def label_blocks(blocks: list[Block], declared: str | None = None) -> None:
    """Both passes over a page's blocks.  The page's language is the one whose stop words it has most of, or the declared one."""
    seen = [b for b in blocks if not b.vetoed]
    lang = declared if declared in STOP_WORDS else None
    for pool in (seen, [b for b in seen if not b.marked]):
        weight = {x: sum(len(b.text) * b.stops[x] for b in pool) for x in STOP_WORDS}
        if any(weight.values()):
            lang = max(weight, key=weight.get)
    for believe in (True, False):
        # Classes are doubted only where nothing is left beside them and no article is marked.
        prose = [(b, len(b.text)) for b in seen if reads(b, lang) >= CONTENT and not (b.marked and believe)]
        total = sum(n for _, n in prose)
        trust = 1.0 if not total else sum(n for b, n in prose if b.inside) / total
        if not any(b.inside for b in seen):
            trust = 0.0
        for b in blocks:
            b.label = classify(b, lang, trust, believe)
        if any(b.label or b.inside for b in seen) or not any(b.marked for b in seen):
            break
    inherit(blocks)
    if lang and not any(b.label for b in blocks):
        # Too short for stop words to show: what the page marks as its article is taken, but for links.
        for b in seen:
            b.label = b.inside > 0 and not b.marked and b.links <= LINKS * len(b.text)


def main_text(html: str | None) -> str:
    """The article's blocks in page order, joined by an empty line."""
    if not html:
        return ""
    blocks = blocks_of(html)
    declared = _LANG.search(html)
    label_blocks(blocks, declared[1].lower() if declared else None)
    return "\n\n".join(b.text for b in blocks if b.label)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Pass one splits the page into blocks and labels each by link density, length and
    stop-word density in the page's language.  Markup is evidence beside them: elements
    that are never prose (menus, footers, forms, scripts) veto what they hold, classes of
    menus, notices, adverts or comments speak against it, and an article element for it
    as far as it holds the page's prose.  Pass two lets undecided blocks inherit from their
    nearest decided neighbours.  Languages are those of STOP_WORDS; of a page in another
    one, only long blocks in a marked article and what stands beside them are found.

    Null, empty and textless pages give an empty text, very long ones are read whole,
    repeated rows give repeated rows, an empty table an empty one; other columns, whatever
    their names, are not read.
    """
    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kind = lambda c: src.schema[c].dataType.simpleString()
    return src.transform(arrow_map, _extract, f"page_id {kind('page_id')}, url {kind('url')}, text string, n_chars bigint")


def op1_html(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
