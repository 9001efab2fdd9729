"""Markup residue in text: HTML, Markdown, wiki and LaTeX to clean text that keeps its structure.

A field is read into one tree, whatever the mixture of markups: HTML elements, LaTeX environments, fences and
heading or list lines become nodes, inline markup becomes text. Paragraph-like nodes then pass points for their length
and commas to their parent and, halved, to the parent's parent; every container's points are discounted by its link
density. The best container and the siblings that hold up against it are kept, and boilerplate beside it is left out.
What is kept comes out as blocks: headings, paragraphs, list items, code and formulas.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.session import spread

# Element names.
_BLOCK = frozenset("address article aside blockquote body center dd div dl dt fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
_INLINE = frozenset("a abbr acronym b big br cite code del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow msub msubsup msup mtext msqrt annotation semantics nowiki q ref references s samp small source span strike strong sub sup syntaxhighlight tt u var wbr gallery poem".split())
_DROPPED = frozenset("script style head noscript template".split())
_BOILERPLATE = frozenset("nav footer aside header form".split())
_VOID = frozenset("br hr img wbr ref references".split())
_CODE = frozenset("pre source syntaxhighlight".split())
_HEADINGS = {f"h{n}": n for n in range(1, 7)}

_ATTRIBUTES = r"(?:\s+[A-Za-z_:][\w:.-]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))*"
_TAG = re.compile(rf"<!--(?P<comment>.*?)(?:-->|\Z)|</(?P<close>[A-Za-z][A-Za-z0-9]*)\s*>|<(?P<open>[A-Za-z][A-Za-z0-9]*)(?P<attr>{_ATTRIBUTES})\s*(?P<void>/?)>|<!doctype[^>]*>|-->", re.S | re.I)
_AUTOLINK = re.compile(r"<(?:https?|ftp|mailto):[^\s<>]+>")
_FORMULA = re.compile(r"(?<![\\$])\$(?![\s$])[^$\n]+?(?<!\\)\$(?!\$)")
_DISPLAY = re.compile(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)|\\begin\{(equation|align|gather|multline|displaymath|math|eqnarray)\*?\}(.+?)\\end\{\4\*?\}", re.S)
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n`]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)|\\begin\{(verbatim|lstlisting|minted)\}[^\n]*\n?(.*?)\\end\{\3\}", re.S | re.M)
_MATH_TAG = re.compile(r"<math\b([^>]*)>(.*?)</math>", re.S | re.I)
_ALT = re.compile(r"alttext\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_SPECIAL = re.compile(r"[<>&*_`~#\[\]{}\\]|\$\$|''|^(?:[-+*=|;:]|\d+[.)]) |^-{3,}$|^[ \t]*={2,}", re.M)

#: What stands for a formula or a block of code while markup is read: a counter in private digits between two marks.
_HELD = re.compile("\ue000([\ue010-\ue019]+)\ue001")
_PRIVATE = re.compile("[\ue000\ue001\ue010-\ue019]")
_TO_DIGITS, _FROM_DIGITS = {ord("0") + n: 0xE010 + n for n in range(10)}, {0xE010 + n: ord("0") + n for n in range(10)}
_PAGE_LINE = r"(?![ \t]*(?:\d+|[ivxlc]+)[ \t]*[-–—]?[ \t]*$)"

# (pattern, replacement): inline markup, in order; a replacement keeps what is shown.
_INLINE_RULES: list[tuple[re.Pattern, str]] = [(re.compile(p, re.S | re.M), r) for p, r in [
    (r"!\[([^\]\n]*)\]\([^)\n]*\)", r""),
    (r"\[([^\]\[\n]+)\]\((?:[^()\s]*)\)", r"\1"),
    (r"\[([^\]\[\n]+)\]\[[^\]\n]*\]", r"\1"),
    (r"\[\^[^\]\s]{1,20}\]:?", r""),
    (r"\[\[(?:File|Image|Datei|Fichier|Archivo):[^\]]*\]\]", r""),
    (r"\[\[(?:[^\]\[|\n]*\|)?([^\]\[]*)\]\]", r"\1"),
    (r"\[(?:https?|ftp)://[^\s\]]+\s+([^\]]*)\]", r"\1"),
    (r"\[(?:https?|ftp)://[^\s\]]+\]", r""),
    (r"\{\{(?:cn|citation needed|fact|dn|clarify|who|when)(?:\|[^{}]*)?\}\}", r""),
    (r"\{\{[^{}|]*\|([^{}]*)\}\}", r"\1"),
    (r"\{\{([^{}]*)\}\}", r"\1"),
    (r"\[\[(?:[^\]\[|\n]*\|)?|\]\]", r""),
    (r"\{\{(?:\w+\|)?|\}\}", r""),
    (r"\[(?:https?|ftp)://\S+ ?", r""),
    (r"(?<![A-Za-z0-9Α-ω†±$})\]_^'])'''''(?=\S)|(?<=\S)'''''(?!')", r""),
    (r"(?<![A-Za-z0-9Α-ω†±$})\]_^'])'''(?=[^\s'])(.*?)'''", r"\1"),
    (r"(?<![A-Za-z0-9Α-ω†±$})\]_^'`])''(?=[^\s'])([^`\n]*?)''", r"\1"),
    (r"``(?=\S)(.*?)''", r"“\1”"),
    (r"(?<!`)`([^`\n]+)`(?!`)", r"\1"),
    (r"```+|`", r""),
    (r"(?<!\*)\*\*\*?(?=[^\s*])(.*?)\*\*\*?", r"\1"),
    (r"(?<![A-Za-z0-9*\\)\]}])\*(?=[^\s*])([^*\n]*?[^\s*])\*(?![A-Za-z0-9*])", r"\1"),
    (r"(?<![A-Za-z0-9_$\\^])__(?=[^\s_])(.*?)__(?![A-Za-z0-9_])", r"\1"),
    (r"(?<![A-Za-z0-9_$\\^}])_(?=[^\s_{])([^_\n]*?[^\s_])_(?![A-Za-z0-9_])", r"\1"),
    (r"~~(?=\S)(.*?)~~|~~~?", r"\1"),
    (r"\\footnote\{[^{}]*\}|\\(?:label|index|vspace|hspace|input|bibliography|bibliographystyle)\*?\{[^{}]*\}", r""),
    (r"\(~?\\(?:eq)?ref\{[^{}]*\}\) ?", r""),
    (r"~?\\(?:cite[a-z]*|ref|eqref|autoref|pageref)\*?(?:\[[^\]]*\])*\{[^{}]*\}", r""),
    (r"\\textcolor\{[^{}]*\}\{([^{}]*)\}|\\href\{[^{}]*\}\{([^{}]*)\}", r"\1\2"),
    (r"\\(?:text[a-z]{2,6}|emph|underline|mbox|uline|textrm|title|author|caption|url)\*?\{([^{}]*)\}", r"\1"),
    (r"\{\\(?:it|bf|em|sc|tt|rm|sl|sf|small|large|Large|itshape|bfseries|color\{[^{}]*\})\b\s*([^{}]*)\}", r"\1"),
    (r"\\\\(?:\[[^\]]*\])?", r" "),
    (r"\\(?:noindent|par|medskip|smallskip|bigskip|newline|linebreak|centering|hfill|quad|qquad|clearpage|newpage|maketitle)(?![A-Za-z])", r" "),
    (r"\\([%&#_{}$])", r"\1"),
    (r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?", r""),
    (r"\\[A-Za-z]{2,}\*?(?:\{([^{}]*)\})?", r"\1"),
]]
_LINE_RULES = [(k, re.compile(p, re.M)) for k, p in [
    ("heading", r"^[ \t]*(?:#{1,6}[ \t]+(?P<md>\S.*?)[ \t#]*|(?P<eq>={2,6})[ \t]*(?P<wiki>[^=\n]+?)[ \t]*(?P=eq)[ \t]*|\\(?:sub)*section\*?\{(?P<tex>[^{}]*)\}|\\(?:paragraph|chapter)\*?\{(?P<par>[^{}]*)\})$"),
    ("list_item", rf"^[ \t]*(?:[-*+]{_PAGE_LINE}[ \t]+(?P<md>\S.*?)|\\item(?:\[[^\]]*\])?[ \t]*(?P<tex>.*?))[ \t]*$"),
]]
_SETEXT = re.compile(r"^(\S[^\n]*)\n(?:={3,}|-{3,})[ \t]*$", re.M)
_TABLE_ROW = re.compile(r"^\s*(?:\{\|.*|\|[-+}].*|\|.*\|\s*|!.*!!.*)$", re.M)
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|[^\n]*\n?(.*?)(?:^[ \t]*\|\}[ \t]*$|\Z)", re.S | re.M)
_PIPE_TABLE = re.compile(r"^[ \t]*\|?[^\n|]*\|[^\n]*\n[ \t]*\|?(?:[ \t]*:?-{3,}:?[ \t]*\|)+[ \t]*(?::?-{3,}:?)?[ \t]*(?:\n[ \t]*\|?[^\n|]*\|[^\n]*)*", re.M)


def _cells(row: str) -> str:
    return ", ".join(c.strip() for c in row if c.strip())


def _wiki_table(m: re.Match) -> str:
    """Rows of a wiki table on lines of their own, cells after commas; what stands before a cell's single bar is its format."""
    rows: list[list[str]] = [[]]
    for line in m[1].split("\n"):
        text = line.strip()
        if text.startswith("|-"):
            rows.append([])
        elif text.startswith(("|+", "|", "!")):
            parts = re.split(r"\|\||!!", text[2 if text.startswith("|+") else 1 :])
            rows[-1] += [re.sub(r"^[^|\[\]{}]*=[^|\[\]{}]*\|", "", c) for c in parts]
        elif text and rows[-1]:
            rows[-1][-1] += " " + text
    return "\n".join(c for r in rows if (c := _cells(r)))


def _pipe_table(m: re.Match) -> str:
    lines = m.group().split("\n")
    return "\n".join(c for n, x in enumerate(lines) if n != 1 and (c := _cells(x.split("|"))))


class Node:
    """A node of the tree: text is kept in ``parts`` between child nodes; ``residue`` counts its pieces of markup."""

    __slots__ = ("kind", "parent", "parts", "score", "level", "residue", "size", "linked")

    def __init__(self, kind: str, parent: Node | None) -> None:
        self.kind, self.parent, self.parts, self.score, self.level, self.residue, self.size, self.linked = kind, parent, [], 0.0, 0, 0, 0, 0

    def nodes(self) -> list[Node]:
        """The node and all below it, in order."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            out.append(n)
            stack += [p for p in reversed(n.parts) if isinstance(p, Node)]
        return out

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack += reversed(n.parts)
        return "".join(out)

    def measure(self) -> list[Node]:
        """All nodes with their length without blanks, and what of it is in links."""
        every = self.nodes()
        for n in reversed(every):  # children come before their parents
            n.size = sum(len("".join(p.split())) if isinstance(p, str) else p.size for p in n.parts)
            n.linked = n.size if n.kind == "a" else sum(p.linked for p in n.parts if isinstance(p, Node))
        return every

    def link_density(self) -> float:
        return self.linked / self.size if self.size else 0.0


class Reader:
    """Reads one text into a tree whose nodes know the markup that was met in them."""

    def __init__(self, text: str) -> None:
        self.held: list[tuple[str, str]] = []
        self.root = Node("body", None)
        self._read(text)

    @property
    def residue(self) -> int:
        return sum(n.residue for n in self.root.nodes())

    def _hold(self, kind: str, text: str) -> str:
        self.held.append((kind, text))
        return f"\ue000{str(len(self.held) - 1).translate(_TO_DIGITS)}\ue001"

    def _at(self, m: re.Match) -> tuple[str, str]:
        return self.held[int(m[1].translate(_FROM_DIGITS))]

    @staticmethod
    def _count(node: Node, pattern: re.Pattern, to, text: str) -> str:
        text, n = pattern.subn(to, text)
        node.residue += n
        return text

    def _read(self, text: str) -> None:
        text = _PRIVATE.sub("", text)
        text = self._count(self.root, _FENCE, lambda m: "\n" + self._hold("code", m[2] if m[1] else m[4]) + "\n", text)
        text = self._count(self.root, _MATH_TAG, lambda m: self._hold("formula", html.unescape((a := _ALT.search(m[1])) and (a[1] or a[2]) or _TAG.sub("", m[2]))), text)
        text = self._count(self.root, _DISPLAY, lambda m: self._hold("display", next(x for x in (m[1], m[2], m[3], m[5]) if x is not None).strip()), text)
        text = _FORMULA.sub(lambda m: self._hold("formula", m.group()[1:-1]), text)
        for _ in range(3):  # entities of entities
            if not (_ENTITY.search(text)):
                break
            text, n = _ENTITY.subn(lambda m: html.unescape(m.group()).replace("\x00", ""), text)
            self.root.residue += n
        text = self._count(self.root, _AUTOLINK, "", text)
        at, node = 0, self.root
        for m in _TAG.finditer(text):
            name = (m["open"] or m["close"] or "").lower()
            if name and name not in _BLOCK and name not in _INLINE and name not in _DROPPED:
                continue
            self._text(node, text[at : m.start()])
            at = m.end()
            holder = node
            if m["open"]:
                if name in _BLOCK or name in _DROPPED or name in ("a", *_CODE):
                    if name in ("p", "li", "dt", "dd") and node.kind == name:
                        node = node.parent
                    child = Node(name, node)
                    child.level = _HEADINGS.get(name, 0)
                    node.parts.append(child)
                    holder = child
                    if not m["void"] and name not in _VOID:
                        node = child
                elif name in ("sub", "sup", "br"):
                    node.parts.append(" " if name == "br" else "")
            elif m["close"]:
                up = node
                while up.parent is not None and up.kind != name:
                    up = up.parent
                if up.parent is not None:
                    node = up.parent
            holder.residue += 1
        self._text(node, text[at:])

    def _text(self, node: Node, text: str) -> None:
        if not text:
            return
        if node.kind in _CODE:
            node.parts.append(text)
            return
        text = self._count(node, _SETEXT, r"# \1", text)
        text = self._count(node, _WIKI_TABLE, _wiki_table, text)
        text = self._count(node, _PIPE_TABLE, _pipe_table, text)
        node.residue += sum(m.group().count("|") >= 2 for m in _TABLE_ROW.finditer(text))
        text = _TABLE_ROW.sub(lambda m: _cells(re.split(r"\|\||!!|\|", re.sub(r"^\s*(?:\{\|.*|\|[-+}].*|!)", "", m.group()))) if m.group().count("|") >= 2 else m.group(), text)
        for pattern, to in _INLINE_RULES[:13]:
            text = self._count(node, pattern, to, text)
        # lines before the rest of the inline markup, whose commands could swallow them
        pieces, at = [], 0
        marks = sorted(((m.start(), m.end(), kind, next((g for k, g in m.groupdict().items() if k != "eq" and g is not None), "")) for kind, p in _LINE_RULES for m in p.finditer(text)))
        for a, b, kind, inner in marks:
            if a < at:
                continue
            pieces.append(("text", text[at:a]))
            pieces.append((kind, inner))
            node.residue += 1
            at = b
        pieces.append(("text", text[at:]))
        for kind, piece in pieces:
            for pattern, to in _INLINE_RULES[13:]:
                piece = self._count(node, pattern, to, piece)
            if kind == "text":
                node.parts.append(piece)
            else:
                child = Node({"heading": "h2", "list_item": "li"}[kind], node)
                child.level = 2 if kind == "heading" else 0
                child.parts.append(piece)
                node.parts.append(child)

    # ---------------------------------------------------------------- scoring

    def best(self) -> list[Node]:
        """The container with the most points and its siblings that hold up; the whole tree if it has no containers."""
        containers: list[Node] = []
        for n in self.root.measure():
            own = "".join(p for p in n.parts if isinstance(p, str)).strip()
            if n.kind not in ("p", "pre", "td", "blockquote", "li", "body", "div", "section", "article") or len(own) < 25:
                continue
            points = 1 + own.count(",") + own.count("，") + own.count("、") + min(len(own) / 100, 3)
            for up, share in ((n if n is self.root else n.parent, 1.0), (n.parent.parent if n.parent else None, 0.5)):
                if up is not None:
                    if up.score == 0:
                        containers.append(up)
                    up.score += points * share
        if not containers:
            return [self.root]
        for c in containers:
            c.score *= 1 - c.link_density()
        top = max(containers, key=lambda c: c.score)
        if top.parent is None:
            return [top]
        limit = max(10, top.score * 0.2)
        keep = []
        for sibling in top.parent.parts:
            if sibling is top or isinstance(sibling, str):
                keep.append(sibling)
            elif sibling.kind in _BOILERPLATE or sibling.kind in _DROPPED:
                continue
            elif sibling.score >= limit or sibling.link_density() < 0.25:
                keep.append(sibling)
        wrapper = Node("body", None)
        wrapper.parts = keep
        return [wrapper]

    def blocks(self) -> list[tuple[str, str]]:
        """Blocks of the kept nodes: (kind, text), kind one of heading, paragraph, list_item, code, formula."""
        out: list[tuple[str, str]] = []
        flow: list[str] = []

        def flush() -> None:
            for part in re.split(r"\n\s*\n", "".join(flow)):
                self._emit(part, out)
            flow.clear()

        stack: list[Node | str | None] = list(reversed(self.best()))  # None ends a block
        while stack:
            p = stack.pop()
            if p is None:
                flush()
            elif isinstance(p, str):
                flow.append(p)
            elif p.kind in _DROPPED or p.kind in _BOILERPLATE and p.link_density() > 0.5:
                continue
            elif p.kind in _CODE:
                flush()
                out.append(("code", p.text().strip("\n")))
            elif p.level or p.kind == "li":
                flush()
                self._emit(p.text(), out, "heading" if p.level else "list_item")
            else:
                if p.kind in _BLOCK and p.kind != "body":
                    flush()
                    stack.append(None)
                stack += reversed(p.parts)
        flush()
        return out

    def _emit(self, text: str, out: list[tuple[str, str]], kind: str = "paragraph") -> None:
        start = 0
        for m in _HELD.finditer(text):
            what, held = self._at(m)
            if what in ("code", "display"):
                self._plain(text[start : m.start()], out, kind)
                out.append(("code" if what == "code" else "formula", held.strip("\n")))
                start = m.end()
        self._plain(text[start:], out, kind)

    def _plain(self, text: str, out: list[tuple[str, str]], kind: str) -> None:
        text = _HELD.sub(lambda m: f"${self._at(m)[1]}$", text)
        text = re.sub(r"[ \t\xa0]*\n[ \t]*|[ \t\xa0]+", lambda m: "\n" if "\n" in m.group() and kind == "paragraph" else " ", text).strip()
        if text:
            out.append((kind, text))


def render(blocks: list[tuple[str, str]]) -> str:
    """Blocks as text: headings on their own line, items after a dash, code and formulas on lines of their own."""
    mark = {"heading": "{}\n", "list_item": "- {}", "code": "{}", "formula": "${}$", "paragraph": "{}"}
    return "\n".join(mark[kind].format(text) for kind, text in blocks)


def convert(text: str | None) -> tuple[str | None, list[tuple[str, int, float]], list[tuple[str, str]]]:
    """Clean text, the tree's nodes with markup (kind, pieces of markup, points), blocks. Text without markup comes back unchanged."""
    if text is None:
        return None, [], []
    plain = [("paragraph", text)] if text else []
    if not _SPECIAL.search(text):
        return text, [], plain
    reader = Reader(text)
    if not reader.residue:
        return text, [], plain
    blocks = reader.blocks()
    return render(blocks), [(n.kind, n.residue, n.score) for n in reader.root.nodes() if n.residue], blocks


def clean(fields: DataFrame) -> DataFrame:
    """``(field, id, text, residue, nodes, blocks)`` for every row of ``fields(field, id, text)``.

    ``nodes`` are the nodes of the tree in which markup was met, with its pieces and the node's points. Rows are only
    scanned. Null texts come back null with no blocks, empty ones empty; unbalanced markup is removed and its text kept;
    repeated rows give repeated rows; other columns are ignored. Private-use characters U+E000, U+E001 and U+E010 to
    U+E019 are taken out of texts with markup.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [convert(t) for t in batch["text"]]
            yield pd.DataFrame({
                "field": batch["field"], "id": batch["id"], "text": [g[0] for g in got], "residue": pd.Series([sum(n for _, n, _ in g[1]) for g in got], dtype="int32"),
                "nodes": [[{"kind": k, "residue": n, "score": s} for k, n, s in g[1]] for g in got], "blocks": [[{"kind": k, "text": t} for k, t in g[2]] for g in got]})

    schema = "field string, id long, text string, residue int, nodes array<struct<kind:string,residue:int,score:double>>, blocks array<struct<kind:string,text:string>>"
    return spread(fields.select("field", "id", "text")).mapInPandas(run, schema)


def fields_of(equations: DataFrame, dataset: DataFrame) -> DataFrame:
    """The fields of the task in long form."""
    long = equations.select(F.col("row_id").alias("id"), F.explode(F.create_map(F.lit("text_before"), F.col("text_before"), F.lit("text_after"), F.col("text_after"))).alias("field", "text"))
    meanings = dataset.select(F.col("rec_id").alias("id"), F.lit("meaning").alias("field"), F.col("meaning").alias("text"))
    return long.unionByName(meanings)


def found(equations: DataFrame, dataset: DataFrame) -> DataFrame:
    """``p2_found``: fields whose tree has a node with markup."""
    return clean(fields_of(equations, dataset)).where(F.exists("nodes", lambda n: n["residue"] > 0)).select("field", "id")
