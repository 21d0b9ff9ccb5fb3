"""Read job cards out of one page. This is the per-row helper of the page operators.

It follows the markup once and fills the fields of every open card. Everything after
the raw fields (filters, keys across pages, joins) is DataFrame work.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

from jobloom import fixed_values as fv

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# An opening tag of the first kind ends an open one of the second kind.
_ENDED_BY = {
    "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
} | dict.fromkeys(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split(),
    {"p"},
)
_SCOPES = frozenset("ul ol table dl select div body html".split())
_HIDDEN = frozenset(("script", "style", "template"))

_PART = re.compile(
    r"(?P<tag>^[a-z]\w*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
    r"|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)'(?P<value>[^']*)')?\]"
)


# Text up to a plain tag, and the tag: nearly all of a page. The standard parser reads the rest.
_PLAIN = re.compile(
    r"""([^<&]*)<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:[ \n][a-zA-Z][\w-]*="[^"&]*")*))>""", re.ASCII
)
_PLAIN_ATTR = re.compile(r"""[ \n]([a-zA-Z][\w-]*)="([^"]*)\"""", re.ASCII)
#: Characters that the standard parser is given at first, when a page is not plain.
_PORTION = 64
# Paths that are put behind the site's name as they are.
_PLAIN_PATH = re.compile(r"(?:/[\w-]+)+(?:\?[\w=&%+-]+)?", re.ASCII)
_PLAIN_SITE = re.compile(r"https?://[a-z0-9.-]+")
# Nodes of different looks that are remembered at a time.
_MOST_KNOWN = 10_000


class _Node:
    __slots__ = ("tag", "attrs", "classes", "captures", "scope")

    def __init__(self, tag, attrs):
        self.tag, self.attrs = tag, attrs
        self.classes = attrs["class"].split() if "class" in attrs else ()
        self.captures, self.scope = (), None


class _Step:
    """One part of a selector: a tag, classes, and attributes with their tests."""

    def __init__(self, text):
        self.tag, self.classes, self.attrs = None, [], []
        for part in _PART.finditer(text):
            tag, cls, node_id, attr, op, value = part.groups()
            if tag:
                self.tag = tag
            elif cls:
                self.classes.append(cls)
            else:
                given = ("id", "=", node_id) if node_id else (attr, op, value)
                self.attrs.append(given)

    def meets(self, node):
        if self.tag and self.tag != node.tag:
            return False
        for cls in self.classes:
            if cls not in node.classes:
                return False
        for name, op, value in self.attrs:
            given = node.attrs.get(name)
            if given is None or (op == "=" and given != value):
                return False
            if op == "*=" and value not in given:
                return False
        return True


class _Selectors:
    """Fixed selectors by name, looked up by the tag of a node.

    What a node meets by itself depends on its tag, its class and the attributes that
    selectors test, so it is remembered by these.
    """

    def __init__(self, **lists):
        self.of_any, self.of_tag = [], {}
        self.known, self.by_value, self.by_name = {}, {}, {}
        for name, selectors in lists.items():
            for text in selectors:
                *above, last = map(_Step, text.split())
                entry = (name, last, above[0] if above else None)
                for attr, op, _ in last.attrs:
                    (self.by_value if op else self.by_name)[attr] = None
                if last.tag:
                    self.of_tag.setdefault(last.tag, []).append(entry)
                else:
                    self.of_any.append(entry)

    def _met(self, node):
        """Name and needed ancestor of the selectors whose last step the node meets."""
        given = node.attrs
        seen = node.tag
        if given:
            seen = (
                seen, given.get("class"),
                *[given.get(name) for name in self.by_value], *[name in given for name in self.by_name],
            )
        met = self.known.get(seen)
        if met is None:
            if len(self.known) >= _MOST_KNOWN:
                self.known.clear()
            entries = self.of_tag.get(node.tag, []) + self.of_any
            met = self.known[seen] = [(name, above) for name, last, above in entries if last.meets(node)]
        return met

    def names(self, node, ancestors):
        """The names whose selectors the node meets, given the nodes around it."""
        met = self._met(node)
        if not met:
            return ()
        return {name for name, above in met if above is None or any(map(above.meets, ancestors))}


_FIELDS = dict(
    title=fv.TITLE_SELECTORS,
    link=fv.LINK_SELECTORS,
    company=fv.COMPANY_SELECTORS,
    location=fv.LOCATION_SELECTORS,
    salary=fv.SALARY_SELECTORS,
    posting_date=fv.DATE_SELECTORS,
    description=fv.SNIPPET_SELECTORS,
)
_SCOPE = "scope"
_CARD = _Selectors(**_FIELDS, scope=fv.CARD_SELECTORS)
_FALLBACK_CARD = _Selectors(**_FIELDS, scope=fv.FALLBACK_CARD_SELECTORS)
_DETAIL = _Selectors(detail=fv.DETAIL_SELECTORS)


class _FieldReader(HTMLParser):
    """Collects, for every scope, the first node of each field below it.

    Scopes are the nodes that the selectors of ``_SCOPE`` meet, or with ``whole`` the page.
    """

    def __init__(self, selectors, whole=False):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.open, self.pending = [], []
        # Pairs of a scope's node and its fields; a field is its node and text pieces.
        self.found = [(None, {})] if whole else []
        self.within = list(self.found)

    def read(self, page):
        at, portion = 0, _PORTION
        while at < len(page):
            done = not self.rawdata and self.cdata_elem is None
            plain = _PLAIN.match(page, at) if done else None
            if plain:
                self._plain(*plain.groups())
                at, portion = plain.end(), _PORTION
            else:
                # Portions grow until the parser is done with them, so that it does not
                # read the same over and over.
                portion = _PORTION if done else 2 * portion
                self.feed(page[at : at + portion])
                at += portion
        self.close()
        self._end_text()
        return self.found

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def _plain(self, text, ended, begun, attrs):
        if text:
            self.pending.append(text)
        if ended:
            self.handle_endtag(ended.lower())
            return
        tag = begun.lower()
        self.handle_starttag(tag, [(n.lower(), v) for n, v in _PLAIN_ATTR.findall(attrs)] if attrs else ())
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)

    def _end_text(self):
        if not self.pending:
            return
        text, self.pending = "".join(self.pending).strip(), []
        if text and not (self.open and self.open[-1].tag in _HIDDEN):
            for node in self.open:
                for pieces in node.captures:
                    pieces.append(text)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag, attrs):
        self._end_text()
        if tag in _ENDED_BY:
            self._close_implied(_ENDED_BY[tag])
        given = {}
        for name, value in attrs:
            given.setdefault(name, value or "")
        node = _Node(tag, given)
        names = self.selectors.names(node, self.open)
        if names:
            for _, fields in self.within:
                for name in names:
                    if name not in fields and name != _SCOPE:
                        fields[name] = (node, [])
                        node.captures = (*node.captures, fields[name][1])
            if _SCOPE in names:
                node.scope = (node, {})
                self.found.append(node.scope)
        if tag not in _VOID:
            self.open.append(node)
            if node.scope:
                self.within.append(node.scope)

    def _close(self, depth):
        for node in reversed(self.open[depth:]):
            if node.scope:
                self.within.pop()
        del self.open[depth:]

    def _close_implied(self, ended):
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth].tag
            if tag in ended:
                self._close(depth)
                return
            if tag in _SCOPES:
                return

    def handle_endtag(self, tag):
        self._end_text()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                self._close(depth)
                return


def parse_cards(page: str, site_url: str = fv.SITE_URL) -> list[dict]:
    """Every card on the page, in document order; later cards of a job are marked."""
    found = _FieldReader(_CARD).read(page)
    if not found:
        found = _FieldReader(_FALLBACK_CARD).read(page)
    seen, cards = set(), []
    for node, fields in found:
        card = _card(node, fields, site_url)
        key = card["job_key"] or card["url"] or card["job_title"]
        card["repeated"] = bool(card["job_title"]) and key in seen
        if card["job_title"]:
            seen.add(key)
        cards.append(card)
    return cards


def _joined(site_url, link):
    if not link:
        return ""
    if _PLAIN_PATH.fullmatch(link) and _PLAIN_SITE.fullmatch(site_url):
        return site_url + link
    try:
        return urljoin(site_url, link)
    except ValueError:  # a link that is none costs its card the link, not the page its cards
        return ""


def _card(node, fields, site_url):
    def attribute(name, key):
        return fields[name][0].attrs.get(key, "") if name in fields else ""

    def text(name):
        return " ".join(fields[name][1]) if name in fields else ""

    link = _joined(site_url, attribute("link", "href"))
    in_link = re.search("[?&]jk=([a-zA-Z0-9]+)", link)
    job_key = (
        node.attrs.get("data-jk")
        or attribute("link", "data-jk")
        or (in_link.group(1) if in_link else "")
    )
    return {
        "job_title": (attribute("title", "title") or text("title")).strip(),
        "company": text("company"),
        "location": text("location"),
        "salary": text("salary"),
        "description": text("description"),
        "url": link or (fv.JOB_URL.format(site=site_url, key=job_key) if job_key else ""),
        "posting_date": text("posting_date"),
        "job_key": job_key,
    }


def parse_detail(page: str) -> str:
    """The description text of a detail page, or blank."""
    [(_, fields)] = _FieldReader(_DETAIL, whole=True).read(page)
    return "\n".join(fields["detail"][1]) if "detail" in fields else ""
