"""Web pages of papers to Markdown, with the standard library's parser only."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# What is removed from pages, by tag and by class.
REMOVED_TAGS = {"nav", "header", "footer", "svg", "button", "script", "style", "head"}
REMOVED_CLASSES = {
    "ltx_authors",
    "ltx_note",
    "ltx_page_footer",
    "ltx_dates",
    "ltx_role_footnote",
    "ltx_TOC",
    "ltx_classification",
    "ltx_keywords",
    "ltx_tag_item",
    "ltx_bib_cited",
}
VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "col", "area", "base", "source", "track", "embed", "param"}
BLOCKS = {"p", "div", "section", "article", "main", "ul", "ol", "blockquote", "figure", "figcaption", "dl", "dt", "dd", "body", "html"}
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Node:
    """An element with its children; text children are strings."""

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        self.classes = set((attrs.get("class") or "").split())

    def walk(self):
        """This element and all below it, in order; without recursion, so depth doesn't matter."""
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self, between: str = " ") -> str:
        """The text below, with blanks collapsed."""
        parts: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                stack.extend(reversed(item.children))
        return " ".join(between.join(parts).split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        while len(self.open) > 1 and self.open[-1].tag in SELF_CLOSING.get(tag, ()):
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    """The tree of a page; unclosed and stray tags are borne."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _prune(root: Node) -> None:
    """Removes what is no part of the text, and images, everywhere below."""
    for node in root.walk():
        node.children = [
            c
            for c in node.children
            if isinstance(c, str) or not (c.tag in REMOVED_TAGS or c.classes & REMOVED_CLASSES or c.tag == "img")
        ]


def _first(root: Node, fits) -> Node | None:
    return next((n for n in root.walk() if fits(n)), None)


def _is_table(node: Node) -> bool:
    return node.tag == "table" or "ltx_tabular" in node.classes


def _is_row(node: Node) -> bool:
    return node.tag == "tr" or "ltx_tr" in node.classes


def _is_cell(node: Node) -> bool:
    return node.tag in ("td", "th") or bool({"ltx_td", "ltx_th"} & node.classes)


def _outermost(node: Node, fits) -> list[Node]:
    """Elements below that fit and have no fitting element above them, in order."""
    found, stack = [], [c for c in reversed(node.children) if isinstance(c, Node)]
    while stack:
        item = stack.pop()
        if fits(item):
            found.append(item)
        else:
            stack.extend(c for c in reversed(item.children) if isinstance(c, Node))
    return found


def _table(node: Node) -> str:
    """Rows with any text, cells joined by bars."""
    rows = [[c.text() for c in _outermost(r, _is_cell)] for r in _outermost(node, _is_row)]
    return "\n".join(" | ".join(cells) for cells in rows if any(cells))


def _entry(item: Node) -> str:
    """A bibliography entry as ``- [key] label. body``."""
    tag = _first(item, lambda n: "ltx_tag" in n.classes)
    label = tag.text() if tag else ""
    if tag:
        tag.children = []
    body = item.text()
    return f"- [{item.attrs.get('id', '')}] " + (f"{label}. {body}" if label else body)


def _render(node: Node) -> str:
    out: list[str] = []
    for child in node.children:
        if isinstance(child, str):
            out.append(child if node.tag == "pre" else re.sub(r"\s+", " ", child))
            continue
        tag, classes = child.tag, child.classes
        if tag == "math":
            alt = child.attrs.get("alttext", "").strip()
            out.append(f" ${alt}$ " if alt else "")
        elif tag == "section" and "ltx_bibliography" in classes:
            items = [_entry(n) for n in child.walk() if n.tag == "li" and "ltx_bibitem" in n.classes]
            out.append("\n\n## References\n\n" + "\n".join(items) + "\n\n")
        elif _is_table(child):
            out.append("\n\n" + _table(child) + "\n\n")
        elif re.fullmatch(r"h[1-6]", tag):
            level = 2 if "ltx_title_abstract" in classes else int(tag[1])
            out.append(f"\n\n{'#' * level} {' '.join(_render(child).split())}\n\n")
        elif tag == "a":
            text = _render(child).strip() if child.attrs.get("href", "").startswith("#bib.") else _render(child)
            out.append(f"[{text}]({child.attrs['href']})" if child.attrs.get("href", "").startswith("#bib.") else text)
        elif tag in ("b", "strong"):
            inner = _render(child).strip()
            out.append(f"**{inner}**" if inner else "")
        elif tag in ("i", "em"):
            inner = _render(child).strip()
            out.append(f"*{inner}*" if inner else "")
        elif tag == "code":
            out.append(f"`{child.text()}`")
        elif tag == "pre":
            out.append("\n\n```\n" + "".join(c if isinstance(c, str) else c.text() for c in child.children).strip("\n") + "\n```\n\n")
        elif tag == "br":
            out.append("  \n")
        elif tag == "hr":
            out.append("\n\n---\n\n")
        elif tag == "li":
            out.append(f"\n- {' '.join(_render(child).split())}")
        elif tag in BLOCKS:
            out.append("\n\n" + _render(child).strip() + "\n\n")
        else:
            out.append(_render(child))
    return "".join(out)


def to_markdown(html: str) -> tuple[str, str]:
    """Title and Markdown of a page: its article if it has one, else its body."""
    root = parse(html)
    heading = _first(root, lambda n: n.tag == "h1" and "ltx_title_document" in n.classes) or _first(root, lambda n: n.tag == "title")
    article = _first(root, lambda n: n.tag == "article" and "ltx_document" in n.classes)
    body = article or _first(root, lambda n: n.tag == "body") or root
    _prune(body)
    abstract = _first(body, lambda n: "ltx_abstract" in n.classes)
    if abstract:
        title = _first(abstract, lambda n: n.tag == "h6" or "ltx_title_abstract" in n.classes)
        if title:
            title.tag = "h2"
    text = re.sub(r"[ \t]+\n", "\n", _render(body))
    text = re.sub(r"\n[ \t]+(?=\S)", "\n", text)
    return heading.text() if heading else "", re.sub(r"\n{3,}", "\n\n", text).strip() + "\n"
