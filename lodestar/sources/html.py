"""HTML without outside libraries: visible text, headings, tables and links."""

from __future__ import annotations

from html.parser import HTMLParser

HIDDEN = {"script", "style", "noscript", "template", "nav", "header", "footer", "aside"}
BREAKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.heading, self.parts, self.links, self.rows = 0, "", [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden += 1
        elif tag in BREAKS:
            self.parts.append(("break", ""))
        if tag in HEADINGS:
            self.heading = tag
        if tag == "tr":
            self.rows.append([])
        if tag in ("td", "th") and self.rows:
            self.rows[-1].append("")
        if tag == "a" and (href := dict(attrs).get("href")):
            self.links.append(href)

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        if tag in HEADINGS:
            self.heading = ""
            self.parts.append(("break", ""))

    def handle_data(self, data):
        if self.hidden:
            return
        self.parts.append((self.heading or "text", data))
        if self.rows and self.rows[-1]:
            self.rows[-1][-1] += data.strip()


def _read(html: str) -> _Reader:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader


def visible_text(html: str) -> str:
    lines = "".join("\n" if kind == "break" else data for kind, data in _read(html).parts).split("\n")
    return "\n".join(t for t in (" ".join(x.split()) for x in lines) if t)


def sections(html: str) -> list[tuple[str, str, str]]:
    """(heading level, title, text up to the next heading)."""
    out: list[list[str]] = []
    for kind, data in _read(html).parts:
        if kind in HEADINGS:
            if out and out[-1][0] == kind and not out[-1][2]:
                out[-1][1] += data
            else:
                out.append([kind, data, ""])
        elif out:
            out[-1][2] += "\n" if kind == "break" else data
    return [(a, " ".join(b.split()), " ".join(c.split())) for a, b, c in out]


def tables(html: str) -> list[list[str]]:
    return [r for r in _read(html).rows if r]


def links(html: str) -> list[str]:
    return _read(html).links


class _Grids(HTMLParser):
    """Tables as rows of cells; a table within a cell is a table of its own, after the one that holds it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.done.append([])
            self.open.append((self.done[-1], [False]))
        elif self.open:
            rows, cell = self.open[-1]
            if tag == "tr":
                rows.append([])
                cell[0] = False
            elif tag in ("td", "th"):
                if not rows:
                    rows.append([])
                rows[-1].append("")
                cell[0] = True

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
        elif tag in ("td", "th", "tr") and self.open:
            self.open[-1][1][0] = False

    def handle_data(self, data):
        if self.open and self.open[-1][1][0]:
            self.open[-1][0][-1][-1] += data


def table_grids(html: str) -> list[list[list[str]]]:
    """Each table of a page as rows of cells, white space within a cell made single blanks; rows without cells are left out."""
    reader = _Grids()
    reader.feed(html)
    reader.close()
    return [[[" ".join(c.split()) for c in row] for row in table if row] for table in reader.done]
