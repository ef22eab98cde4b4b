"""Per-page helper: picks the advert's parts out of one HTML text.

One compiled pattern cuts the text into tags, comments and raw elements; attributes are only read where a wanted
element could start. That costs a fraction of what the standard library's event parser does per tag.
"""

from __future__ import annotations

import json
import re
from html import unescape

from kamienica.functions import rules

# A quote opens a value only after `=`; elsewhere it is a stray character. A tag cut off by the end is a tag.
_ATTRIBUTES = r"""((?:=\s*+(?:"[^"]*"|'[^']*')|[^>=]++|=)*+)"""
_TOKEN = re.compile(
    rf"<(?:([a-z][^\s/>]*+){_ATTRIBUTES}(?:>|\Z)|/([a-z][^\s>/]*+)[^>]*+(?:>|\Z)|!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z))", re.S | re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>|\Z", re.I) for tag in ("script", "style")}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a start tag ends implicitly: the open elements it closes, and the containers the search stops at.
_IMPLIED = {
    **{tag: ({"p"}, {"table", "button"}) for tag in
       "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
       "pre section table ul".split()},
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value))
    return found


class AdvertParts:
    """Texts of the wanted elements, in document order of their start tags."""

    def __init__(self, html: str):
        self._open: list[tuple[str, bool, list]] = []  # tag, is the remote-viewing block, text buffers
        self._filling: list[list[str]] = []  # buffers of all open elements
        self.labels: list[list[str]] = []
        self.values: list[list[str]] = []
        self.first: dict[str, list[str]] = {}
        self.json: str | None = None
        position, token = 0, _TOKEN.search(html)
        while token:
            if self._filling and token.start() > position:
                self._add_text(html[position:token.start()])
            position = token.end()
            started, attributes, ended = token.groups()
            if started:
                tag = started.lower()
                if tag in _RAW_END:
                    position = self._raw_element(html, position, tag, attributes)
                else:
                    self._start_tag(tag, attributes)
            elif ended:
                self._end_tag(ended.lower())
            token = _TOKEN.search(html, position)
        if self._filling and position < len(html):
            self._add_text(html[position:])

    def _raw_element(self, html, position, tag, attributes):
        """Skip a script or style, keeping the text of the one that holds the JSON."""
        end = _RAW_END[tag].search(html, position)
        if self.json is None and tag == "script" and _attributes(attributes).get("id") == rules.JSON_SCRIPT_ID:
            self.json = html[position:end.start()]
        return end.end()

    def _add_text(self, text):
        text = unescape(text) if "&" in text else text
        for buffer in self._filling:
            buffer.append(text)

    def _start_tag(self, tag, attributes):
        if tag in _IMPLIED:
            self._close_implied(*_IMPLIED[tag])
        names = attributes.lower()
        wanted = tag == "p" or "data-" in names or "aria-label" in names
        given = _attributes(attributes) if wanted else {}
        buffers = self._buffers_for(tag, given) if wanted else []
        if tag not in _VOID:
            self._open.append((tag, given.get("aria-label") == rules.REMOTE_LABEL, buffers))
            self._filling.extend(buffers)

    def _end_tag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                self._close_from(depth)
                return

    def _close_from(self, depth):
        for _, _, buffers in self._open[depth:]:
            if buffers:
                del self._filling[-len(buffers):]
        del self._open[depth:]

    def _close_implied(self, ended, stop):
        for depth in range(len(self._open) - 1, -1, -1):
            name = self._open[depth][0]
            if name in stop:
                return
            if name in ended:
                self._close_from(depth)
                return

    def _start(self, name, buffers):
        if name not in self.first:
            self.first[name] = []
            buffers.append(self.first[name])

    def _buffers_for(self, tag, given):
        """New text buffers that the element just opened has to fill."""
        buffers = []
        cell = given.get("data-cy", "")
        if cell.startswith(rules.LABEL_PREFIX):
            self.labels.append([])
            buffers.append(self.labels[-1])
        is_value = given.get("data-testid", "").startswith(rules.VALUE_PREFIX)
        if not is_value and cell.startswith(rules.MISSING_PREFIX):
            is_value = not any(remote for _, remote, _ in self._open)
        if is_value:
            self.values.append([])
            buffers.append(self.values[-1])
        if tag == "p":
            if "class" not in given:
                self._start("paragraph", buffers)
        elif tag == "a":
            if given.get("aria-label") == rules.ADDRESS_LABEL:
                self._start("address", buffers)
        elif tag == "strong":
            if given.get("aria-label") == rules.PRICE_LABEL:
                self._start("price", buffers)
        elif tag == "div" and cell == rules.DESCRIPTION_CELL:
            self._start("description", buffers)
        return buffers


def json_leaves(node: dict):
    """(key, value) of every leaf in reading order; only objects are entered, lists stay whole."""
    for key, value in node.items():
        if isinstance(value, dict):
            yield from json_leaves(value)
        else:
            yield key, value


def as_text(value) -> str | None:
    """JSON scalar as plain text, a list as JSON text."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def advert_row(html: str | None, keep_keys: frozenset[str]) -> dict:
    """The parts of one advert page, or `error` with the reason the page cannot be used."""
    empty = {"labels": None, "values": None, "address": None, "price": None, "description": None,
             "fields": None, "error": None}
    try:
        parts = AdvertParts(html)
        text = {name: "".join(pieces) for name, pieces in parts.first.items()}
        for name in ("address", "price"):
            if name not in text:
                return {**empty, "error": f"no {name}"}
        description = text.get("paragraph", text.get("description"))
        if description is None:
            return {**empty, "error": "no description"}
        if parts.json is None:
            return {**empty, "error": "no embedded JSON"}
        labels = ["".join(pieces) for pieces in parts.labels]
        return {
            "labels": [label for label in labels if label != rules.REMOTE_LABEL],
            "values": ["".join(pieces) for pieces in parts.values],
            "address": text["address"], "price": text["price"], "description": description,
            "fields": [{"key": k, "value": as_text(v)} for k, v in json_leaves(json.loads(parts.json))
                       if k in keep_keys],
            "error": None,
        }
    except Exception as problem:  # one bad page must not end the job
        return {**empty, "error": f"{type(problem).__name__}: {problem}"}
