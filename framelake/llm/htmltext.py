"""Main text of web pages: blocks are judged by stop words, length and links, then by their neighbours."""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from .io import null_ids, table, with_ids

#: Common function words of the supported languages.
STOP_WORDS = frozenset(
    "a an and are as at be by for from had has he her his i in is it not of on or she that the their they this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas pour qui que sa se ses son sur un une vous "
    "aber als am auch auf aus bei das dem den der des die ein eine einen er es für hat ich im in ist mit nicht oder sich sie sind und von war wie wir zu zum zur "
    "al como con de del el ella en es esta la las lo los más no o para pero por que se sin su sus un una y".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object select".split())
DROPPED = frozenset("head nav footer aside button menu dialog script style noscript template textarea title svg math iframe object select canvas".split())
END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: Where reading goes on if such an element never ends.
RESUME = re.compile(r"<(?=/?(?:head|body|main|article|section|header|footer|nav|aside|div|p|h[1-6]|ul|ol|table|form)(?:[\s/>]))", re.I)
PRIORITY = frozenset(("article", "main"))
#: Parts of class and id values that mark boilerplate anywhere in a name, and those that do so only as its first part.
MARKED = frozenset(
    "ads adsbygoogle advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment commentlist comments cookie cookies consent disqus footer menu nav navbar "
    "navigation newsletter popup promo promos promoted promotion replies respond sidebar sponsor sponsored sponsors subscribe".split()
)
MARKED_FIRST = frozenset("ad notice related share sharing social widget".split())
#: Marks that count on a part of a line, too.
ADVERTS = frozenset("ads adsbygoogle advert adverts advertisement advertising promo promoted sponsored".split())
#: Names with one of these parts tell how a page is laid out: no-sidebar, has-menu.
LAYOUT = frozenset("no has with without hide show".split())
#: Elements of running text: only a whole name marks them.
RUNNING = frozenset("p li dt dd td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption tr table".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ROLES = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|dialog|alert|menu)$", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
#: Quotes count only after an equals sign.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAMES, PARTS = re.compile(r"\S+"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Why an element is dropped: by its class or id (or as a form), for certain, or as an article within one of the first kind.
BY_CLASS, CERTAIN, WITHIN = 1, 2, 3
SHORT, LONG, STOP_INSIDE, STOP_LOW, STOP_HIGH, LINK_HIGH, LINK_MOST = 70, 200, 0.05, 0.20, 0.30, 0.3, 0.9
#: Scripts written without spaces: there words, and so stop words, cannot be counted.
UNSPACED = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]")
#: An article is not the page's main text if what stands outside it holds this many times its running text.
OUTWEIGHED = 2
#: So many linked blocks in a row are a list of other pages, in an article too.
LINKS_IN_A_ROW = 3


class Block:
    __slots__ = ("parts", "linked", "inside", "dropped", "heading", "hard", "soft", "first", "label", "known_text", "known_density")

    def __init__(self, inside: bool = False, dropped: int = 0, heading: bool = False, hard: bool = False, soft: int = 0):
        self.parts, self.linked, self.inside, self.dropped, self.heading, self.hard, self.soft, self.first, self.label = [], 0, inside, dropped, heading, hard, soft, "", ""
        self.known_text = self.known_density = None

    def text(self) -> str:
        """Asked for once the block is complete."""
        if self.known_text is None:
            self.known_text = " ".join("".join(self.parts).split())
        return self.known_text

    def density(self) -> float:
        """Share of stop words; below zero for text in a script without spaces."""
        if self.known_density is None:
            text = self.text()
            words = text.lower().split()
            stops = sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words)
            self.known_density = -1.0 if not text.isascii() and 4 * len(UNSPACED.findall(text)) > len(text) else stops / len(words)
        return self.known_density


def _marks(value: str, tag: str, inside: bool) -> str:
    """Whether a class or id value marks boilerplate: by a whole name, by a part of one, or not ("")."""
    found = ""
    for name in NAMES.findall(value):
        parts = [x.lower() for x in PARTS.findall(name)]
        if not parts or LAYOUT.intersection(parts):
            continue
        if tag in RUNNING:
            marked = len(parts) == 1 and parts[0] in MARKED | MARKED_FIRST
        else:
            # the page's headers go, an article's own header stays
            marked = parts[0] in MARKED_FIRST or parts[-1] == "ad" or bool(MARKED.intersection(parts)) or (not inside and "header" in parts)
        if marked and len(parts) == 1:
            return "whole"
        if marked:
            found = "part"
    return found


def _boilerplate(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """Why an element is dropped (0: it is not), and whether that is only evidence: a form, or a name with a marked part, may hold the whole page."""
    if tag in DROPPED or (tag == "header" and not inside):
        return CERTAIN, False
    kind, soft = (BY_CLASS, True) if tag == "form" else (0, False)
    if tag in ("html", "body") or not attributes:
        return kind, soft
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and ROLES.match(value)) or (name == "style" and UNSEEN.search(value)):
            return CERTAIN, False
        if name in ("class", "id") and tag not in PRIORITY and (mark := _marks(value, tag, inside)):
            kind, soft = BY_CLASS, mark == "part" and (soft or not kind)
    return kind, soft


def _muted(attributes: str) -> bool:
    """Whether a part of a line is not seen, or an advert."""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "style" and UNSEEN.search(value)) or (name == "class" and ADVERTS.intersection(value.lower().split())):
            return True
    return False


def _after_raw(page: str, tag: str, at: int) -> int:
    """Where reading goes on after a raw element: behind its end tag, or at the next block if it never ends."""
    end, block = END[tag].search(page, at), None
    if tag == "title" or not end:  # a title holds no blocks
        block = RESUME.search(page, at)
    if end and not (block and block.start() < end.start()):
        return end.end()
    return block.start() if block else len(page)


def blocks_of(page: str, lifted: frozenset[int] = frozenset(), parents: list[int] | None = None) -> list[Block]:
    """Text blocks in page order. Open elements are kept on a stack; missing end tags end with their parent.

    Elements that are dropped on evidence only are numbered from 1 in page order; ``lifted`` ones are not dropped. ``parents`` gets, for each number, that of
    the next such element around it.
    """
    parents = [0] if parents is None else parents
    marks = 0
    stack: list[tuple[str, int, bool, bool, int]] = []  # tag, dropped, inside article or main, dropped on more than evidence, number of the nearest mark
    done: list[Block] = []
    now = Block()
    links = at = depth = 0
    mute: list[str] = []  # open parts of a line that are not read, and those within

    def cut() -> None:
        nonlocal now
        if now.parts:
            done.append(now)
        now = Block(stack[-1][2], stack[-1][1], stack[-1][0] in HEADINGS, *stack[-1][3:]) if stack else Block()

    while m := TOKEN.match(page, at):
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith(("<!", "<?")):
                continue
            if mute:
                continue
            now.parts.append(words := html.unescape(m[0]))
            if links:
                now.linked += len("".join(words.split()))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                if tag in mute:
                    while mute.pop() != tag:
                        pass
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            if len(stack) < depth:
                mute.clear()
            cut()
            continue
        if tag == "br":
            now.parts.append("\n")
            continue
        if tag in VOID:
            if tag == "hr":
                cut()
            continue
        if tag in INLINE:
            if not m[3].endswith("/"):
                links += tag == "a"
                if mute:
                    mute.append(tag)
                elif m[3] and _muted(m[3]):
                    mute.append(tag)
                    depth = len(stack)
            continue
        if tag in RAW:
            if not m[3].endswith("/"):  # what stands inside is not markup
                at = _after_raw(page, tag, at)
            continue
        if stack and stack[-1][0] == "head":  # all that may stand in a head was read above
            stack.pop()
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6") and stack and stack[-1][0] == tag:
            stack.pop()
        if stack and stack[-1][0] == "p":
            stack.pop()
        if len(stack) < depth:
            mute.clear()
        _, dropped, inside, hard, soft = stack[-1] if stack else ("", 0, False, False, 0)
        if dropped == BY_CLASS and tag in PRIORITY and not inside:
            dropped = WITHIN
        inside = inside or tag in PRIORITY
        kind, evidence = _boilerplate(tag, m[3], inside)
        if evidence:
            marks += 1
            parents.append(soft)
            soft = marks
            kind = 0 if marks in lifted else kind
        hard = hard or (kind != 0 and not evidence)
        stack.append((tag, CERTAIN if kind == CERTAIN else dropped if dropped in (BY_CLASS, CERTAIN) else kind or dropped, inside, hard, soft))
        links = 0
        cut()
    cut()
    return [b for b in done if b.text()]


def _judge(block: Block, known: bool, prior: bool | None) -> str:
    """First pass: good, bad, or an open label (near, short).

    Density, length and links decide. ``known``: the page's language has stop words here. ``prior``: whether the block stands
    in the page's article, None if the page marks none; within it less is asked for, outside it nothing is good.
    """
    if block.dropped in (BY_CLASS, CERTAIN) or prior is False:
        return "bad"
    return _by_text(block, known, prior)


def _by_text(block: Block, known: bool, prior: bool | None) -> str:
    text = block.text()
    length = len(text)
    links = block.linked / max(1, len("".join(text.split())))
    if length < SHORT:
        return "short" if prior or not block.linked else "bad"
    if links > (LINK_MOST if prior else LINK_HIGH):
        return "near" if prior else "bad"
    density = block.density()
    if prior:
        return "near" if known and 0 <= density < STOP_INSIDE else "good"
    if density < 0 or not known:
        return "good" if length > LONG else "near"
    if density >= STOP_HIGH:
        return "good" if length > LONG else "near"
    return "near" if density >= STOP_LOW else "bad"


def _running(blocks: list[Block], known: bool) -> int:
    """Characters that the first pass, without a prior, takes for running text."""
    return sum(len(b.text()) for b in blocks if _judge(b, known, None) in ("good", "near"))


def classified(page: str) -> list[Block]:
    """The page's blocks with their final labels, good or bad, and the labels of the first pass (``first``).

    Where an article stands within an element that its class marks, the mark does not count, unless there is another one.
    """
    blocks = _without_wrappers(page)
    if not any(b.inside and not b.dropped for b in blocks):
        for b in blocks:
            b.dropped = 0 if b.dropped == WITHIN else b.dropped
    else:
        for b in blocks:
            b.dropped = BY_CLASS if b.dropped == WITHIN else b.dropped
    free = [b for b in blocks if not b.dropped]
    known = any(b.density() >= STOP_LOW for b in free if len(b.text()) >= SHORT)
    inner, outer = [b for b in free if b.inside], [b for b in free if not b.inside]
    marked = bool(inner) and _running(outer, known) <= OUTWEIGHED * sum(len(b.text()) for b in inner)
    for b in blocks:
        b.first = b.label = _judge(b, known, b.inside if marked else None)
    if marked:
        _mark_link_lists(blocks)
    # second pass: open blocks take after the nearest decided ones on both sides; in an article, after its own
    good = any(b.first == "good" for b in blocks)
    decided = [b.first if b.first in ("good", "bad") and (not marked or b.inside and not b.dropped) else "" for b in blocks]
    before, after = _nearest(decided), _nearest(decided[::-1])[::-1]
    for b, left, right in zip(blocks, before, after):
        if b.first in ("good", "bad"):
            continue
        if marked:  # within the article; one of short blocks alone is good as a whole
            b.label = "good" if "good" in (left, right) or not good else "bad"
        elif b.first == "short":  # a heading belongs to what follows it
            b.label = "good" if right == "good" and (b.heading or left == "good") else "bad"
        else:
            b.label = "bad" if left == right == "bad" and good else "good"
    if not marked and not any(b.label == "good" for b in blocks):
        _judge_runs(blocks)
    return blocks


def _without_wrappers(page: str) -> list[Block]:
    """The page's blocks. Where nothing that is not dropped is running text or stands in an article, forms and elements with a partly marked name that hold over half
    of the running text hold the page, and their marks do not count; what is marked within them does."""
    parents = [0]
    blocks = blocks_of(page, parents=parents)
    free = [b for b in blocks if not b.dropped]
    if len(parents) == 1 or any(b.inside for b in blocks if b.dropped in (0, WITHIN)):
        return blocks
    known = any(b.density() >= STOP_LOW for b in blocks if not b.hard and len(b.text()) >= SHORT)
    if _running(free, known):
        return blocks
    held = [0] * len(parents)
    for b in blocks:
        if b.soft and not b.hard and _by_text(b, known, None) in ("good", "near"):
            held[b.soft] += len(b.text())
    total = sum(held)
    for k in range(len(parents) - 1, 0, -1):
        held[parents[k]] += held[k] if parents[k] else 0
    lifted = frozenset(k for k in range(1, len(parents)) if 2 * held[k] > total)
    return blocks_of(page, lifted) if lifted else blocks


def _mark_link_lists(blocks: list[Block]) -> None:
    """In an article: blocks in a row that are links as a whole, and the heading above them, are bad if the article has other text."""
    own = [b for b in blocks if b.inside and not b.dropped]
    if not any(b.first == "good" for b in own):
        return
    k = 0
    while k < len(own):
        end = k
        while end < len(own) and own[end].linked > LINK_MOST * len("".join(own[end].text().split())):
            end += 1
        if end - k >= LINKS_IN_A_ROW:
            for b in own[k - 1 if k and own[k - 1].heading else k : end]:
                b.first = b.label = "bad"
        k = max(end, k + 1)


def _judge_runs(blocks: list[Block]) -> None:
    """On a page without a good block: short blocks in a row are judged as one, by their length and stop words."""
    run: list[Block] = []
    for b in [*(b for b in blocks if not b.dropped), None]:
        if b is not None and b.first == "short":
            run.append(b)
            continue
        words = " ".join(x.text() for x in run).lower().split()
        if sum(len(x.text()) for x in run) > LONG and sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) >= STOP_HIGH * len(words):
            for x in run:
                x.label = "good"
        run = []


def _nearest(decided: list[str]) -> list[str]:
    """For every block the label of the nearest decided one before it."""
    out, last = [], "bad"
    for label in decided:
        out.append(last)
        last = label or last
    return out


def main_text(page: str | None) -> str:
    """The page's main text, one block a line; empty for null, empty and text-free pages."""
    return "\n".join(b.text() for b in classified(page) if b.label == "good") if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. Whole pages; null html gives an empty text; repeated rows are kept; other columns
    are left out; an empty table gives no rows."""

    def rows(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    out = with_ids(pages, "page_id", "url", "html").mapInPandas(rows, "page_id long, url string, text string, n_chars long")
    return null_ids(out, "page_id")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
