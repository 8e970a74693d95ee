"""Article fields of one HTML page: the per-row helper behind ``operators.articles``.

Follows a lenient tree: void elements never stay open, an end tag closes its innermost open
element and whatever is open inside it, an unclosed element ends with its parent. Text is kept as
one list of strings; an element is a range in it, so nested unclosed paragraphs cost nothing extra.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())
# Their text is not part of what a reader sees.
HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))
WANTED = frozenset(("h1", "time", "p"))


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self.pending: list[str] = []
        self.stack: list[tuple[str, list | None]] = []
        self.open: dict[str, int] = {}
        self.hidden = 0
        self.found: dict[str, list[list]] = {name: [] for name in WANTED}
        self.metas: list[dict[str, str]] = []

    def _flush(self):
        if self.pending:
            if not self.hidden:
                self.strings.append("".join(self.pending))
            self.pending = []

    def handle_starttag(self, tag, attrs):
        self._flush()
        values = {name: value or "" for name, value in attrs}
        if tag == "meta":
            self.metas.append(values)
        if tag in VOID:
            return
        entry = None
        if tag in WANTED:
            entry = [values, len(self.strings), None]
            self.found[tag].append(entry)
        self.stack.append((tag, entry))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if not self.open.get(tag):
            return
        while self._pop() != tag:
            pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def _pop(self) -> str:
        tag, entry = self.stack.pop()
        self.open[tag] -= 1
        self.hidden -= tag in HIDDEN
        if entry is not None:
            entry[2] = len(self.strings)
        return tag

    def finish(self, html: str):
        self.feed(html)
        self.close()
        self._flush()
        while self.stack:
            self._pop()
        return self

    def text(self, entry, sep: str = " ") -> str:
        parts = (s.strip() for s in self.strings[entry[1] : entry[2]])
        return sep.join(p for p in parts if p)

    def raw(self, entry) -> str:
        return "".join(self.strings[entry[1] : entry[2]])

    def first(self, tag):
        return next(iter(self.found[tag]), None)

    def meta(self, key: str, value: str):
        return next((m for m in self.metas if m.get(key) == value), None)

    def paragraph(self, longer_than: int) -> str:
        for entry in self.found["p"]:
            text = self.text(entry)
            if len(text) > longer_than:
                return text
        return ""


def feed_fields(html: str) -> tuple[str | None, str, str]:
    """(title or None, date text, paragraph) for pages reached through a feed."""
    page = _Page().finish(html)
    h1, time = page.first("h1"), page.first("time")
    date = ""
    if time:
        date = time[0].get("datetime") or page.text(time, "")
    if not date:
        date = (page.meta("property", "article:published_time") or {}).get("content", "")
    return (page.text(h1) if h1 else None), date, page.paragraph(60)


def standalone_fields(html: str) -> tuple[str | None, str, str]:
    """(title or None, date text, paragraph) for single pages: metadata fills in for the title."""
    page = _Page().finish(html)
    h1, time = page.first("h1"), page.first("time")
    if h1:
        title = page.text(h1)
    else:
        title = (page.meta("property", "og:title") or {}).get("content")
    date = ""
    if time:
        date = time[0].get("datetime") or time[0].get("content") or page.raw(time)
    else:
        # The first one present decides, even when it is empty.
        meta = page.meta("property", "article:published_time") or page.meta("name", "date") or {}
        date = meta.get("datetime") or meta.get("content") or ""
    return title, date, page.paragraph(50)
