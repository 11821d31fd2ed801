"""Main text of HTML pages by two-pass block rules.

Pass one cuts a page into text blocks and judges each by itself: its place (menus, forms, notices and the like are
out), link density, length and stop-word density. Blocks that this does not decide stay open. Pass two gives every
open block the label of its nearest decided neighbours: of both if they agree, else of the nearer one (the earlier at
equal distance); a heading goes with what follows it.

An ``article`` or ``main`` is a prior for what is inside: links or rare stop words alone do not rule a block out there,
and an open block stays unless both its neighbours go. What is outside of it goes, but only if the article holds most of
what the rules call text; beside a mere teaser the rest of the page is judged as on a page without one.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from pagelake.llm.common import small_batches

#: HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas select button".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul caption legend head".split()
)
OUT = frozenset("nav footer aside form header menu head dialog fieldset".split())
ARTICLE = frozenset(["article", "main"])
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end tag may be left out, with the start tags that end them.
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "head"}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}
#: Words that put an element out wherever they stand in its class or id.
OUT_WORDS = (
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted nav navbar"
    " navigation menu menubar breadcrumb breadcrumbs footer masthead sidebar"
    " comment comments disqus cookie cookies consent gdpr newsletter subscribe"
    " subscription popup modal pagination pager toolbar"
).split()
#: Words that do so as a whole class or id; as a part of one they make what is inside doubtful.
DOUBT_WORDS = (
    "header side widget related recommended reply replies respond notice signup login share sharing social overlay skip"
    " copyright legal disclaimer"
).split()
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())
HINT = re.compile(r"(?:^|[\s_-])(?:" + "|".join(OUT_WORDS) + r")(?:$|[\s_-])|(?:^|\s)(?:" + "|".join(DOUBT_WORDS) + r")(?:$|\s)")
DOUBT = re.compile(r"(?:^|[\s_-])(?:" + "|".join(DOUBT_WORDS) + r")(?:$|[\s_-])")
#: Frequent words of the four languages.
STOP = frozenset(
    ("the of and to in is it for on that with as was are be by this at from or an a not have he she they we you"
     " der die das und in den von zu mit ist sich des auf für im dem ein eine als auch es an nicht er sie wir ihr"
     " le la les de des et un une du en que qui pour dans par sur au avec est pas plus ce il elle nous vous se"
     " el los las de que y en un una por con para su al es se del lo como no más pero sus le ya o").split()
)
LONG, STOP_HIGH, STOP_LOW, LINKS = 200, 0.25, 0.12, 0.5
SHORT = 70

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")


class Block:
    __slots__ = ("text", "linked", "out", "doubt", "inside", "heading", "item")

    def __init__(self, text: str, linked: int, out: bool, doubt: bool, inside: bool, heading: bool, item: bool):
        self.text, self.linked, self.out, self.doubt = text, linked, out, doubt
        self.inside, self.heading, self.item = inside, heading, item


def _standing(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element's name, or its class, id or role, puts it out of the main text, or into doubt."""
    if tag in OUT and not (tag == "header" and inside):
        return True, False
    if "=" not in attributes and "hidden" not in attributes:
        return False, False
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", "").lower()):
        return True, False
    if values.get("role", "").lower() in OUT_ROLES:
        return True, False
    if tag in ("body", "html", "article", "main"):
        return False, False
    names = f"{values.get('class', '')} {values.get('id', '')}"
    # sideBar is one name and two words.
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", names).lower()
    return bool(HINT.search(f"{names.lower()} {words}")), bool(DOUBT.search(words))


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in page order, white space collapsed, character references decoded."""
    out: list[Block] = []
    # tag, and whether something around is out, doubtful, an article, a link, a heading, a list item
    stack: list[tuple[str, bool, bool, bool, bool, bool, bool]] = [("", False, False, False, False, False, False)]
    parts: list[str] = []
    linked: list[str] = []

    def text(piece: str) -> None:
        if piece:
            piece = entities.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if stack[-1][4]:
                linked.append(piece)

    def close_block() -> None:
        if parts:
            joined = BLANKS.sub(" ", "".join(parts)).strip(" ")
            if joined:
                _, gone, doubt, inside, _, heading, item = stack[-1]
                out.append(Block(joined, len(BLANKS.sub(" ", "".join(linked)).strip(" ")), gone, doubt, inside, heading, item))
            parts.clear()
            linked.clear()

    def pop_to(depth: int) -> None:
        if any(s[0] in BLOCK for s in stack[depth:]):
            close_block()
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
                # an inline end tag does not reach over a block that is still open
                if tag not in BLOCK and stack[depth][0] in BLOCK:
                    break
            else:
                if tag == "p":
                    close_block()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else (end if tag in ("script", "style", "textarea", "title") else at)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                close_block()
            continue
        if tag in BLOCK:
            close_block()
            if tag in ENDS_P:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == "p":
                        pop_to(depth)
                        break
                    if stack[depth][0] in BLOCK:
                        break
            for depth in range(len(stack) - 1, 0, -1):
                name = stack[depth][0]
                if tag in ENDED_BY.get(name, ()):
                    pop_to(depth)
                    break
                if name in ("ul", "ol", "dl", "table") or (name in BLOCK and name not in ENDED_BY):
                    break
        _, gone, doubt, inside, link, heading, item = stack[-1]
        out_here, doubt_here = _standing(tag, m[3], inside)
        stack.append((
            tag, gone or out_here, doubt or doubt_here, inside or tag in ARTICLE, link or tag == "a",
            heading or tag in HEADING, item or tag == "li",
        ))
    close_block()
    return out


def judge(block: Block) -> bool | None:
    """True: main text, False: not, None: not to be told from the block alone."""
    if block.out:
        return False
    if block.linked > LINKS * len(block.text):
        # A linked line of an article may belong to it; a list of links does not.
        return None if block.inside and not block.item and not block.doubt else False
    if len(block.text) < SHORT or (block.heading and not block.inside):
        return False if block.doubt else None
    words = block.text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP for w in words) / max(len(words), 1)
    if block.doubt:
        return stops >= STOP_HIGH
    if block.inside:
        return True if stops >= STOP_LOW else None
    if len(block.text) >= LONG:
        return stops >= STOP_LOW
    return True if stops >= STOP_HIGH else None if stops >= STOP_LOW else False


def _prior(blocks: list[Block], first: list[bool | None]) -> bool:
    """Whether the articles of a page hold most of what may be text, so that they decide what is outside."""
    inside = sum(len(b.text) for b, label in zip(blocks, first, strict=True) if b.inside and label is not False)
    outside = sum(len(b.text) for b, label in zip(blocks, first, strict=True) if not b.inside and label)
    return inside > 0 and inside >= outside


def _neighbours(blocks: list[Block], first: list[bool | None], inside: bool) -> list[list[tuple[bool, int] | None]]:
    """Label and place of the last decided block before each place, and of the next one after it.

    For blocks of an article only those of articles count, and none that is out: what is cut out of an article says
    nothing about the rest of it.
    """
    sides = []
    for order in (range(len(first)), reversed(range(len(first)))):
        last, found = None, [None] * len(first)
        for i in order:
            counts = blocks[i].inside and not blocks[i].out if inside else True
            last = (first[i], i) if first[i] is not None and counts else last
            found[i] = last
        sides.append(found)
    return sides


def labels_of(blocks: list[Block]) -> list[bool]:
    """Both passes: blocks judged alone, then open ones by their nearest decided neighbours."""
    first = [judge(b) for b in blocks]
    prior = _prior(blocks, first)
    if prior:
        first = [label if b.inside else False for b, label in zip(blocks, first, strict=True)]
    if True not in first and not prior:
        # Nothing speaks for any block (short pages, other languages): what nothing speaks against is text.
        return [not b.out and not b.doubt and b.linked <= LINKS * len(b.text) for b in blocks]
    near = {flag: _neighbours(blocks, first, flag) for flag in (False, True)}
    out = []
    for i, (block, label) in enumerate(zip(blocks, first, strict=True)):
        if label is None:
            left, right = (side[i] for side in near[prior and block.inside])
            if prior and block.inside:
                gone = [side is not None and not side[0] for side in (left, right)]
                label = not (gone[1] if block.heading else all(gone))
            elif left and right:
                label = left[0] if left[0] == right[0] or i - left[1] <= right[1] - i else right[0]
                if block.heading:
                    label = right[0]
            else:
                label = (left or right or (False, 0))[0]
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """Main text of one page; null and pages without any give the empty string."""
    if not page:
        return ""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, good in zip(blocks, labels_of(blocks), strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null or empty html gives an empty text; page_id and url pass as they are, null included; repeated
    rows are answered one by one; very long pages are read whole. An empty table gives no rows; other columns are
    not looked at.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = small_batches(pages).select("page_id", "url", "html")
    kind = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")
