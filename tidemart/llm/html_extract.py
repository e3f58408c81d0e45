"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block element. Lines inside menus, headers, footers, sidebars,
notices, adverts, forms and comments count as empty. Over the text lengths of the lines a window slides, once over the
lines of article and main elements and once over the others; where its sum rises from nothing to a surge the
main text begins, where it dives to nothing it ends, and what lies between is kept. The others need a larger
surge if a window inside is the largest. The next lines before and after such a stretch, empty ones aside, belong
to it as well if they are prose themselves or of the same article or main element.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Text length of a window from which lines surge.
SURGE = 60
#: Share at which lines outside of article and main elements count where a window inside is the largest.
OUTSIDE = 0.25
#: The end of a sentence.
PROSE = re.compile(r"[.!?…:;。！？][\"'»”’)\]]*$")

#: Elements whose text never shows, or is never main text (fixed values of HTML).
SKIP = {"script", "style", "noscript", "template", "head", "title", "iframe", "svg", "object", "canvas", "audio", "video", "math", "map", "select", "textarea", "button", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
BLOCK = {
    "p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th",
    "caption", "blockquote", "pre", "hr", "br", "figure", "figcaption", "address", "details", "summary", "body", "html", "center", "hgroup", "search",
} | AROUND
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words in class, id or role that mark such parts, whole words between separators.
WORDS = (
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|widget|ads?|advert|adverts|advertisement|banner|promo|sponsor|sponsored|cookies?|consent|"
    r"notice|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|comments?|commentlist|disqus|replies|respond|pagination|pager|complementary|contentinfo")
MARKED = re.compile(rf"(?:^|[\s_-])(?:{WORDS})(?:[\s_-]|$)", re.I)
#: Inside an article or main element only a name made of such words counts, and only on these elements; a header there holds a title.
MARKED_INSIDE = re.compile(rf"(?:^|\s)(?!header|masthead)(?:{WORDS})(?:[_-](?:{WORDS}|posts|articles|stories|links|buttons|list|box|slot|container|wrapper))*(?:\s|$)", re.I)
CONTAINER = {"div", "section", "ul", "ol", "dl", "table", "figure", "details", "center", "search"}
CONTENT = {"article", "main"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")


def lines(page: str):
    """(text, around, element) of each block in page order: raw text with references decoded and white space folded.

    around: inside a part that isn't main text; element: number of the outermost article or main element around, or 0.
    """
    stack: list[tuple[str, bool, bool]] = []
    around, content, element, at = 0, 0, 0, 0
    held: list[str] = []
    out = []

    def close():
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, around > 0, element if content else 0))

    n = len(page)
    while at < n:
        m = TAG.search(page, at)
        held.append(page[at : m.start() if m else n])
        if not m:
            break
        at = m.end()
        slash, name, attributes = m.groups()[:3] if m[2] else m.groups()[3:]
        if not name:
            continue
        name = name.lower()
        if slash:
            if name in BLOCK or name in SKIP:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    for _, a, c in stack[i:]:
                        around -= a
                        content -= c
                    del stack[i:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in BLOCK or name in SKIP:
            close()
        if name in VOID or m[0].endswith("/>"):
            continue
        if name == "p":
            # an open paragraph ends where the next begins
            i = len(stack) - 1
            while i >= 0 and stack[i][0] not in BLOCK:
                i -= 1
            if i >= 0 and stack[i][0] == "p":
                for _, a, c in stack[i:]:
                    around -= a
                    content -= c
                del stack[i:]
        marked = name in AROUND or name in SKIP or _marked(attributes, name, content > 0)
        # a header of an article holds its title
        if name == "header" and content and not around:
            marked = False
        stack.append((name, marked, name in CONTENT))
        around += marked
        element += name in CONTENT and not content
        content += name in CONTENT
    close()
    return out


def _marked(attributes: str, name: str, inside: bool) -> bool:
    if name in ("body", "html", "article", "main") or not attributes:
        return False
    words = MARKED if not inside else MARKED_INSIDE if name in CONTAINER else None
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "hidden" or words and key in ("class", "id", "role") and words.search(value.strip("\"'")):
            return True
    return False


def _stretches(size: np.ndarray, ahead: np.ndarray, need: float) -> np.ndarray:
    """Whether a line lies between a surge, a window of at least ``need``, and the next dive to nothing."""
    keep = np.zeros(len(size), bool)
    i = 0
    while i < len(size):
        if size[i] and ahead[i] >= need:
            j = i
            while j < len(size) and ahead[j] > 0:
                j += 1
            keep[i:j] = size[i:j] > 0
            i = j
        else:
            i += 1
    return keep


def _grow(keep: np.ndarray, size: np.ndarray, found: list, order: range) -> None:
    """Add the lines that follow a kept one in ``order`` while they are prose or of its element."""
    last = None
    for k in order:
        if keep[k]:
            last = found[k][2]
        elif size[k]:
            text, _, element = found[k]
            if last is not None and (PROSE.search(text) or element and element == last):
                keep[k], last = True, element
            else:
                last = None


def main_text(page: str) -> str:
    """The lines between surges and dives and their neighbours, joined by line feeds; all lines if nothing surges."""
    found = lines(page)
    if not found:
        return ""
    size = np.array([0 if a else len(t) for t, a, _ in found])
    element = np.array([e for _, _, e in found])
    sizes = [np.where(element > 0, size, 0), np.where(element > 0, 0, size)]
    # the window that begins at line i
    inside, outside = (np.convolve(s, np.ones(WINDOW, int))[WINDOW - 1 : len(s) + WINDOW - 1] for s in sizes)
    need = SURGE / (OUTSIDE if inside.max() >= outside.max() else 1)
    keep = np.zeros(len(size), bool)
    for s, ahead, n in ((sizes[0], inside, SURGE), (sizes[1], outside, need)):
        part = _stretches(s, ahead, n)
        if part.any() and (part < (s > 0)).any():
            _grow(part, s, found, range(len(s)))
            _grow(part, s, found, range(len(s) - 1, -1, -1))
        keep |= part
    if not keep.any():
        keep = size > 0
    return "\n".join(t for k, (t, _, _) in zip(keep, found) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: one Arrow pass, no shuffle.

    A null or empty page, or one without main text, has an empty text. White space inside a block is one space; blocks
    are joined by \\n. Repeated rows repeat; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(p or "") for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
