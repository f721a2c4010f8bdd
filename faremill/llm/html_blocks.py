"""Text blocks of one HTML page, with what its markup says of each."""

from __future__ import annotations

import re
from html import unescape

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never an article's.
_CHROME_TAGS = frozenset("head nav header footer aside form button select option dialog menu script style noscript template textarea svg iframe".split())
#: Words of class, id or role that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
_CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot alert banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus disclaimer footer form gdpr header hidden legal login masthead menu modal nav navbar navigation navigationbar newsletter notice notices notification overlay pager pagination popup promo promoted promotion related reply replies respond responses search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
_REGION_NAMES = frozenset("article content post entry story main".split())
_LAYOUT = frozenset("no with has without".split())
#: Starting one of these ends an open element of the second group.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

CHROME, PLAIN, REGION, ARTICLE, MAIN = 0, 1, 2, 3, 4


def _kind(tag: str, attributes: str) -> tuple[bool, int]:
    """Whether an element is chrome, and the region it opens."""
    region = MAIN if tag == "main" else ARTICLE if tag == "article" else PLAIN
    if tag in _CHROME_TAGS:
        return True, region
    if not attributes or tag in ("html", "body"):
        return False, region
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if values.get("role", "").lower() == "main":
        return False, MAIN
    if "articlebody" in values.get("itemprop", "").lower():
        return False, ARTICLE
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes), re.I) or values.get("aria-hidden", "").lower() == "true":
        return True, region
    if re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
        return True, region
    for key in ("class", "id", "role"):
        for name in values.get(key, "").split():
            words = [w.lower() for w in _NAME.findall(name)]
            if _CHROME_NAMES.intersection(words) and not _LAYOUT.intersection(words) and tag != "main":
                return True, region
            if region == PLAIN and tag in ("div", "section") and words and words[0] in _REGION_NAMES and len(words) <= 2:
                region = REGION
    return False, region


def blocks(html: str) -> list[tuple[str, int, float]]:
    """(text, zone, share of it in links) in page order; white space is one space, empty blocks are left out.

    Scripts, styles, comments and the head are gone. The zone is CHROME, PLAIN or the surest region around.
    """
    out: list[tuple[str, int, float]] = []
    parts: list[str] = []
    linked = 0
    # (tag, chrome, zone) of open elements.
    stack: list[tuple[str, bool, int]] = [("", False, PLAIN)]
    links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                _, chrome, zone = stack[-1]
                out.append((text, CHROME if chrome else zone, linked / max(1, sum(map(len, parts)))))
            parts.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        if any(t in _BLOCK for t, _, _ in stack[depth:]):
            flush()
        links -= sum(t == "a" for t, _, _ in stack[depth:])
        del stack[depth:]

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if links:
                linked += len(raw)

    at = 0
    for m in _TAG.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            # An inline end tag doesn't close blocks around it.
            if depth and (tag in _BLOCK or not any(t in _BLOCK for t, _, _ in stack[depth + 1 :])):
                close(depth)
            elif tag == "p":
                flush()
            continue
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        if tag in _BLOCK:
            flush()
            if stack[-1][0] == "p" or any(t == "p" for t, _, _ in stack[-4:]):
                depth = max((i for i in range(1, len(stack)) if stack[i][0] == "p"), default=0)
                if depth and not any(t in _BLOCK for t, _, _ in stack[depth + 1 :]):
                    close(depth)
            for ended in _ENDS.get(tag, ()):
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in ("ul", "ol", "dl", "table", "select") or stack[i][0] == ended), 0)
                if depth and stack[depth][0] == ended:
                    close(depth)
        if tag in _VOID:
            continue
        chrome, region = _kind(tag, m[4])
        _, above, zone = stack[-1]
        if not m[4].endswith("/"):
            stack.append((tag, above or chrome, max(zone, region)))
            links += tag == "a"
    text(html[at:])
    flush()
    return out


def marked_region(found: list[tuple[str, int, float]]) -> int:
    """The surest region that holds text, or PLAIN."""
    return max((z for _, z, _ in found), default=PLAIN) if found else PLAIN
