"""Reader that turns nested HTML into Markdown, one text at a time.

Used row by row inside the Arrow UDF of `operators.render`.
"""

from __future__ import annotations

import re
from collections import Counter
from html import escape
from html.parser import HTMLParser

from tidemark.functions.html import CLASS_HINTS, STRIP_TAGS
from tidemark.functions.text import JS_WHITESPACE

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "html", "li", "main", "ol", "p",
    "pre", "section", "ul",
}
_TEXT_BLOCKS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
_STYLES = {"b": "**", "strong": "**", "i": "_", "em": "_"}

# Tags whose end may be left out, with the starting tags that imply it.
_CELL = {"td", "th", "tr", "tbody", "tfoot"}
_CLOSED_BY = {
    "p": _BLOCKS | {"table", "hr", "form", "nav", "header", "footer"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": _CELL,
    "th": _CELL,
    "tr": {"tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
# What a start tag's implied ends do not reach beyond.
_SCOPES = {"ul", "ol", "dl", "table", "select", "div", "section", "article", "blockquote"}

_SPECIAL = re.compile(r"[\\*_`\[\]]")
_LINE_START = re.compile(r"^(?:[->]|\+ |=+|#{1,6} |~~~)")
_NUMBER_START = re.compile(r"^(\d+)\. ")


def _escape(text: str) -> str:
    text = _SPECIAL.sub(lambda m: "\\" + m.group(), text)
    text = _LINE_START.sub(lambda m: "\\" + m.group(), text)
    return _NUMBER_START.sub(r"\1\\. ", text)


class _Frame:
    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.parts, self.items = tag, attrs, [], 0


class MarkdownReader(HTMLParser):
    """Markdown of one HTML text. `hints` and `drop` are what cleaning removes.

    Tags need not be closed: a block closes the paragraph it starts in, and a
    style left open goes on in the next block.
    """

    def __init__(self, drop=STRIP_TAGS, hints=CLASS_HINTS):
        super().__init__(convert_charrefs=True)
        self._drop, self._hints = set(drop), tuple(hints)

    def render(self, html: str) -> str:
        self.reset()
        self._stack, self._skip, self._resume = [_Frame("", {})], [], []
        self._n_open = Counter()
        self._table = 0
        self.feed(html)
        self.close()
        while len(self._stack) > 1:
            self._pop()
        return "".join(self._stack[0].parts).strip(JS_WHITESPACE)

    def _dropped(self, tag: str, attrs: dict) -> bool:
        classes = (attrs.get("class") or "").lower()
        return tag in self._drop or any(hint in classes for hint in self._hints)

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if self._skip:
            self._skip_implied_end(tag)
        if self._skip:
            if tag not in _VOID:
                self._skip.append(tag)
        elif self._dropped(tag, attrs):
            if tag not in _VOID:
                self._skip.append(tag)
        elif self._table or tag == "table":
            self._table += tag == "table"
            self._add(("\n\n" if tag == "table" and self._table == 1 else "") + self.get_starttag_text())
        elif tag in _VOID:
            self._void(tag, attrs)
        else:
            if tag in _BLOCKS:
                self._close_paragraph()
            if tag == "li" and self._open("li") > max(self._open("ul"), self._open("ol")):
                self._pop_to("li")
            self._push(tag, attrs)

    def _skip_implied_end(self, tag: str):
        """Leave the skipped elements whose end this start tag implies."""
        for i in range(len(self._skip) - 1, -1, -1):
            if tag in _CLOSED_BY.get(self._skip[i], ()):
                del self._skip[i:]
                return
            if self._skip[i] in _SCOPES:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._skip:
            if tag in self._skip:
                while self._skip.pop() != tag:
                    pass
                return
            # the end of a parent ends what needs no end tag of its own
            if self._skip[0] not in _CLOSED_BY or not (self._open(tag) or self._table):
                return
            self._skip.clear()
        if self._table:
            self._add(f"</{tag}>")
            self._table -= tag == "table"
            if not self._table:
                self._add("\n\n")
        elif tag in self._resume and not self._open(tag):
            self._resume.remove(tag)
        elif self._open(tag):
            self._pop_to(tag)

    def handle_data(self, data):
        if self._skip:
            return
        if self._table:
            self._add(escape(data, quote=False).replace("\u00a0", "&nbsp;"))
        elif self._open("pre"):
            self._add(data)
        else:
            text = re.sub(r"[ \t\r\n]+", " ", data)
            if text.strip(" "):
                self._restyle()
            at_start = not self._line().strip(" ")
            if self._open("code"):
                self._add(text)
            else:
                self._add(_escape(text.lstrip(" ") if at_start else text))

    def _line(self) -> str:
        """What the current block holds so far."""
        for frame in reversed(self._stack):
            tail = "".join(frame.parts[-2:])
            if tail or frame.tag in _BLOCKS:
                return tail.rsplit("\n", 1)[-1]
        return ""

    def _open(self, tag: str) -> int:
        """Depth of the innermost open `tag`, 0 if none is open."""
        if not self._n_open[tag]:
            return 0
        return next((i for i in range(len(self._stack) - 1, 0, -1) if self._stack[i].tag == tag), 0)

    def _add(self, text: str):
        self._stack[-1].parts.append(text)

    def _restyle(self):
        for tag in self._resume:
            self._push(tag, {})
        self._resume = []

    def _close_paragraph(self):
        depth = max(map(self._open, _TEXT_BLOCKS))
        if depth:
            self._pop_to(self._stack[depth].tag)

    def _pop_to(self, tag: str):
        left_open = []
        while self._stack[-1].tag != tag:
            if self._stack[-1].tag in _STYLES and tag in _BLOCKS:
                left_open.insert(0, self._stack[-1].tag)
            self._pop()
        self._pop()
        self._resume = left_open + self._resume

    def _push(self, tag: str, attrs: dict):
        self._stack.append(_Frame(tag, attrs))
        self._n_open[tag] += 1

    def _pop(self):
        frame = self._stack.pop()
        self._n_open[frame.tag] -= 1
        self._add(self._rendered(frame, "".join(frame.parts)))

    def _void(self, tag: str, attrs: dict):
        if tag == "br":
            self._add("  \n")
        elif tag == "hr":
            self._close_paragraph()
            self._add("\n\n* * *\n\n")
        elif tag == "img" and attrs.get("src"):
            self._restyle()
            self._add(f"![{attrs.get('alt') or ''}]({attrs['src']}{_title(attrs)})")

    def _rendered(self, frame: _Frame, text: str) -> str:
        tag = frame.tag
        if tag in _STYLES:
            return _wrap(text, _STYLES[tag])
        if tag == "code" and not self._open("pre"):
            return _wrap(text, "``" if "`" in text else "`")
        if tag == "a" and frame.attrs.get("href") and text.strip():
            return f"[{text}]({frame.attrs['href']}{_title(frame.attrs)})"
        if tag == "pre":
            return _fence(text.strip("\n"), frame.attrs)
        if tag == "code":
            parent = self._stack[self._open("pre")]
            parent.attrs.setdefault("class", frame.attrs.get("class"))
            return text
        if tag not in _BLOCKS:
            return text
        text = text.strip(" \n")
        if tag == "li":
            return self._item(text)
        if not text:
            return ""
        if tag[0] == "h" and tag[1:].isdigit():
            return f"\n\n{'#' * int(tag[1])} {re.sub(r' *\n+', ' ', text)}\n\n"
        if tag == "blockquote":
            text = re.sub(r"\n{3,}", "\n\n", text)
            return "\n\n" + re.sub(r"(?m)^", "> ", text) + "\n\n"
        if tag in ("ul", "ol") and self._stack[-1].tag == "li":
            return f"\n{text}\n"
        return f"\n\n{text}\n\n"

    def _item(self, text: str) -> str:
        parent = self._stack[-1]
        parent.items += 1
        mark = "*   "
        if parent.tag == "ol":
            start = parent.attrs.get("start") or "1"
            mark = f"{(int(start) if start.isdigit() else 1) + parent.items - 1}.  "
        text = re.sub(r"\n{3,}", "\n\n", text)
        return mark + re.sub(r"\n(?=.)", "\n    ", text) + "\n"


def _title(attrs: dict) -> str:
    return f' "{attrs["title"]}"' if attrs.get("title") else ""


def _wrap(text: str, mark: str) -> str:
    """Put `mark` around the text, edge blanks and line breaks left outside."""
    core = text.strip()
    if not core:
        return text
    start = text.index(core)
    return text[:start] + mark + core + mark + text[start + len(core) :]


def _fence(code: str, attrs: dict) -> str:
    language = re.search(r"language-(\S+)", attrs.get("class") or "")
    fence = "```"
    while fence in code:
        fence += "`"
    return f"\n\n{fence}{language.group(1) if language else ''}\n{code}\n{fence}\n\n"
