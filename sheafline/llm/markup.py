"""Markup residue: HTML, Markdown, wiki and LaTeX turned into clean text with its structure kept.

A text is read into a tree of blocks. HTML containers are scored as follows: every paragraph passes
points for its length and commas to its parent and, halved, to its grandparent; a container's score
is discounted by its link density. The best container is kept together with those siblings that
score well or hold prose of their own; of the containers above it, headings, prose, lists, code and tables stay unless links make
up most of them. Markdown, wiki and LaTeX have a flat block structure: their
blocks stand under one container, so the same selection keeps all of them.

A grammar proposes the languages of a text; residue is what the reader then took away to reach the clean text. Each construct is owned by one
language; constructs that several languages share (tags, LaTeX formulas, plain lists) go to the
language that the text is written in. Nested constructs are read with a stack, so any depth is opened, in linear time.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML that count as tags in running text.
TAGS = frozenset(
    "a abbr address article aside b base big blockquote body br caption center cite code col colgroup dd del details dfn "
    "div dl dt em figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li "
    "link main mark math meta nav nobr ol option p pre q s samp script section select small span strike strong style sub "
    "summary sup table tbody td textarea tfoot th thead time title tr tt u ul var video wbr".split()
)
#: Extension tags of wiki markup.
WIKI_TAGS = frozenset("ref references nowiki syntaxhighlight source gallery noinclude includeonly onlyinclude poem math chem".split())
TABLE_TAGS = frozenset("table thead tbody tfoot tr td th html body".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav "
    "ol p pre section table tbody td tfoot th thead tr ul math".split()
)
VOID_TAGS = frozenset("br hr img input meta link base col wbr".split())


class Forward:
    """A pattern whose constructs run to an end mark, of any length. In texts of more than ``short`` characters (or, by ``line``, with such a line) an opening is
    only tried where its end mark follows, and the next mark of each kind is remembered, so openings without an end do not cost the square of the length.

    ``closing`` gives for an opening: a name and pattern of its end mark and the first place of the mark, or None if the pattern needs no help.
    """

    def __init__(self, pattern: re.Pattern[str], opening: str, closing: Callable[[re.Match[str]], tuple[str, int] | None], short: int, line: bool = False):
        self.pattern, self.opening, self.closing, self.short, self.line = pattern, re.compile(opening), closing, short, line

    def finditer(self, text: str) -> Iterator[re.Match[str]]:
        if len(text) <= self.short or self.line and max(map(len, text.split("\n"))) <= self.short:
            yield from self.pattern.finditer(text)
            return
        following: dict[str, int] = {}
        at, end_of_line = 0, -1
        while o := self.opening.search(text, at):
            at = o.start() + 1
            if (mark := self.closing(o)) is not None:
                closer, least = mark
                if following.get(closer, -1) < least:
                    m = re.compile(closer).search(text, least)
                    following[closer] = m.start() if m else len(text) + 2
                if self.line and end_of_line < o.end():
                    end_of_line = text.find("\n", o.end()) % (len(text) + 1)
                # a mark may stand right behind the line break, where the pattern takes it for the last character
                if following[closer] > (end_of_line + 1 if self.line else len(text)):
                    continue
            if m := self.pattern.match(text, o.start()):
                yield m
                at = m.end()

    def findall(self, text: str) -> list[str]:
        return [m[0] for m in self.finditer(text)]

    def sub(self, new: str | Callable[[re.Match[str]], str], text: str) -> str:
        out, at = [], 0
        for m in self.finditer(text):
            out += [text[at : m.start()], m.expand(new) if isinstance(new, str) else new(m)]
            at = m.end()
        return "".join([*out, text[at:]])


def _math_end(o: re.Match[str]) -> tuple[str, int] | None:
    if o[0] in ("\\(", "\\["):
        return (r"\\\)" if o[0] == "\\(" else r"\\\]"), o.end() + 1
    return (rf"\\end\{{{o[1]}\*?\}}", o.end()) if o[1] else ("</math>", o.end()) if o[0] == "<math>" else None


TAG = Forward(re.compile(r"<!--.*?-->|</?([A-Za-z][A-Za-z0-9]*)((?:\s+[^<>]*?)?)\s*/?>", re.S), r"<!--|<", lambda o: ("-->", o.end()) if len(o[0]) > 1 else None, 20000)
ENTITY = re.compile(r"&(?:#\d{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z][A-Za-z0-9]{1,31});")
SUSPECT = r"""[<>&\\$`~\[{|*_#=+]|''|-{3,}"""

SUSPECTED = re.compile(SUSPECT)

MATH = Forward(re.compile(r"\$\$[^$]+\$\$|\$[^$\n]+\$|\\\(.+?\\\)|\\\[.+?\\\]|\\begin\{(equation|align|displaymath|math|gather|array|cases|matrix|pmatrix)\*?\}.*?\\end\{\1\*?\}|<math>.*?</math>", re.S), r"\$|\\[(\[]|\\begin\{(equation|align|displaymath|math|gather|array|cases|matrix|pmatrix)\*?\}|<math>", _math_end, 20000)
LATEX_CODE = Forward(re.compile(r"\\begin\{(verbatim|lstlisting|minted)\*?\}(?:\{[^}\n]*\}|\[[^\]\n]*\])*(.*?)\\end\{\1\*?\}|\\(?:verb|lstinline)\*?([|!+/])(.*?)\3", re.S), r"\\begin\{(verbatim|lstlisting|minted)\*?\}|\\(?:verb|lstinline)\*?([|!+/])", lambda o: (rf"\\end\{{{o[1]}\*?\}}", o.end()) if o[1] else (re.escape(o[2]), o.end()), 20000)
LATEX_CMD = re.compile(
    r"(?<![\\\w:])\\(?:(?:text|math)(?:bf|it|rm|sf|tt|sc|sl|up|md|normal)|emph|uline|underline|sout|mbox|hbox|fbox|makebox|(?:sub)*section\*?|chapter\*?|part\*?|(?:sub)?paragraph\*?|title|author|date|caption|"
    r"label|ref|eqref|pageref|cite[a-z]*|footnote|footnotemark|footnotetext|href|url|textcolor|color|colorbox|begin|end|item|maketitle|tableofcontents|documentclass|usepackage|newcommand|renewcommand|"
    r"includegraphics|input|include|bibliography|bibliographystyle|hline|toprule|midrule|bottomrule|cline|[vh]space\*?|vskip|hskip|noindent|indent|centering|raggedright|raggedleft|newpage|clearpage|pagebreak|linebreak|newline|"
    r"par|medskip|smallskip|bigskip|bf|it|rm|sf|tt|sc|em|sl|tiny|scriptsize|footnotesize|small|normalsize|large|Large|LARGE|huge|Huge|"
    r"dots|ldots|textsuperscript|textsubscript|textdegree|degree|LaTeX|TeX|multicolumn|multirow|hfill|vfill|thanks|index|glqq|grqq|guillemotleft|guillemotright|ensuremath|hyperref|nocite|protect|phantom|hphantom|vphantom|rule|parbox|minipage|marginpar|enquote)(?![A-Za-z])"
    r"|\{\\(?:bf|it|rm|sf|tt|sc|em|sl|small|large|bfseries|itshape|scshape|ttfamily)(?![A-Za-z])|\\(?:bfseries|itshape|scshape|ttfamily|sffamily)(?![A-Za-z])|\\\\\[-?\d+(?:\.\d+)?(?:mm|cm|pt|em|ex|in|bp)\]"
)
#: Commands of formulas; without delimiters around them they count only where no other language claims the text.
MATH_CMD = re.compile(r"(?<![\\\w:])\\(?:frac|sqrt|sum|int|prod|cdot|times|leq?|geq?|circ|alpha|beta|gamma|delta|Delta|sigma|pi|text|operatorname|q?quad|left|right|max|min)(?![A-Za-z])")
LATEX_MATHY = re.compile(r"\\[A-Za-z]+|[_^]\s*\{|\^\s*\\|[A-Za-z]\s*[_^]\s*[\w{]|=")
LATEX_NOT_MONEY = re.compile(r"\\[A-Za-z]+|[_^]|[A-Za-zα-ωΑ-Ω]")

WIKI_LINK = re.compile(r"\[\[(?:[^\[\]\n|]+)(?:\|[^\[\]\n]*)*\]\]")
WIKI_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}", re.S)
WIKI_QUOTE = Forward(re.compile(r"(?<!')('{2,6})(?=[^\s'])([^\n]*?[^\s'])\1(?!')"), r"(?<!')'{2,6}(?=[^\s'])", lambda o: (rf"(?<=[^\s'])'{{{len(o[0])}}}(?!')", o.end() + 1), 2000, line=True)
WIKI_HEAD = re.compile(r"(?m)^[ \t]*(={1,6})[ \t]*([^=\n][^\n]*?[^=\s]|[^=\s])[ \t]*\1[ \t]*$")
WIKI_TABLE = Forward(re.compile(r"(?ms)^[ \t]*\{\|.*?^[ \t]*\|\}"), r"(?m)^[ \t]*\{\|", lambda o: (r"(?m)^[ \t]*\|\}", o.end()), 20000)
WIKI_REF = Forward(re.compile(r"(?is)<ref\b[^>/]*/>|<ref\b[^>]*>.*?</ref>|</?nowiki\s*/?>|<references\s*/?>"), r"(?i)<ref\b[^>]*>|</?nowiki|<references", lambda o: ("(?i)</ref>", o.end()) if o[0][:4].lower() == "<ref" and o[0][4:5].lower() != "e" and o[0][-2:] != "/>" else None, 20000)
CODE_TAG = Forward(re.compile(r"(?is)<(syntaxhighlight|source|pre|code)\b[^>]*>(.*?)</\1>"), r"(?i)<(syntaxhighlight|source|pre|code)\b[^>]*>", lambda o: (rf"(?i)</{o[1]}>", o.end()), 20000)
MATH_TAG = Forward(re.compile(r"(?is)<math>(.*?)</math>"), r"(?i)<math>", lambda o: ("(?i)</math>", o.end()), 20000)
SCRIPT = Forward(re.compile(r"(?is)<(script|style)\b.*?</\1>"), r"(?i)<(script|style)\b", lambda o: (rf"(?i)</{o[1]}>", o.end()), 20000)
TABULAR = Forward(re.compile(r"\\begin\{tabular\}\{[^}\n]*\}(.*?)\\end\{tabular\}", re.S), r"\\begin\{tabular\}\{[^}\n]*\}", lambda o: (r"\\end\{tabular\}", o.end()), 20000)
WIKI_EXTLINK = re.compile(r"(?<!\[)\[(?:https?|ftp)://[^\s\]]+(?:\s[^\]\n]*)?\](?!\()")
WIKI_MISC = re.compile(r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__|~{3,5}(?=\s|$)")

MD_FENCE = re.compile(r"(?ms)^[ \t]{0,3}(```+|~~~+)[^\n]*\n(.*?)^[ \t]{0,3}\1[`~]*[ \t]*$")
MD_HEAD = re.compile(r"(?m)^[ ]{0,3}(#{1,6})[ \t]+(\S[^\n]*?)(?:[ \t]+#+)?[ \t]*$")
MD_UNDERLINE = re.compile(r"(?m)^[ ]{0,3}(={3,}|-{3,})[ \t]*$")
MD_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\(([^()\s]+)(?:[ \t]+[\"'][^\"'\n]*[\"'])?\)|!?\[([^\[\]\n]+)\]\[[^\[\]\n]*\]|(?m:^[ ]{0,3}\[[^\]\n]+\]:[ \t]+\S+.*$)|<https?://[^>\s]+>")
MD_STRONG = Forward(re.compile(r"(?<![*\w\\])(\*{1,3})(?=[^\s*])([^*\n]*?[^\s*])\1(?![*\w])|(?<![*\\])(\*{2,3})(?=[^\s*])([^*\n]*?[^\s*])\3(?!\*)|(?<![\w\\])(_{1,3})(?=[^\s_])([^\n]*?[^\s_\\])\5(?!\w)"), r"\*|(?<![\w\\])(_{1,3})(?=[^\s_])", lambda o: (rf"(?<=[^\s_\\])_{{{len(o[0])}}}(?!\w)", o.end() + 1) if o[1] else None, 2000, line=True)
MD_STRIKE = re.compile(r"(?<!~)(~{2,4})(?=[^\s~])([^~\n]*?[^\s~])\1(?!~)")
MD_TICK = Forward(re.compile(r"(?<!`)(`{1,2})(?=[^`])([^\n]*?[^`])\1(?!`)"), r"(?<!`)`{1,2}(?=[^`])", lambda o: (rf"(?<=[^`])`{{{len(o[0])}}}(?!`)", o.end() + 1), 2000, line=True)
MD_QUOTE = re.compile(r"(?m)^[ ]{0,3}>[ \t]?(?=\S)")
MD_TABLE = re.compile(r"(?m)^[ ]{0,3}\|?[^|\n]+(?:\|[^|\n]*)+\|?[ \t]*\n[ ]{0,3}\|?[ \t]*:?-{1,}:?[ \t]*(?:\|[ \t]*:?-{1,}:?[ \t]*)+\|?[ \t]*$")
MD_TASK = re.compile(r"(?m)^[ \t]*[-*+][ \t]+\[[ xX]\][ \t]")
MD_RULE = re.compile(r"(?m)^[ ]{0,3}(?:\*[ ]?){3,}$|^[ ]{0,3}(?:-{3,}|_{3,})[ \t]*$")
MD_FOOT = re.compile(r"\[\^[\w-]+\]")
MD_ESCAPE = re.compile(r"\\[*_#`~>+.!|\[\]()-]")


class Node:
    """A container or block of the tree: ``role`` is a tag name or a block role."""

    __slots__ = ("kids", "level", "linked", "parent", "role", "score", "size", "text")

    def __init__(self, role: str, parent: Node | None = None, text: str = "", level: int = 0):
        self.role, self.parent, self.text, self.level, self.kids, self.score = role, parent, text, level, [], 0.0
        self.size = self.linked = 0
        if parent is not None:
            parent.kids.append(self)

    def link_density(self) -> float:
        return self.linked / self.size if self.size else 0.0


def measure(root: Node) -> None:
    """Sets each node's characters and the share of them inside links, bottom up."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(n.kids)
    for n in reversed(order):
        n.size = len(n.text.strip()) + sum(k.size for k in n.kids)
        n.linked = n.size if n.role == "a" else sum(k.linked for k in n.kids)


# ---------------------------------------------------------------- reading


def html_tree(text: str) -> Node:
    """A forgiving reader: unclosed cells, rows, items and paragraphs are closed by their successors."""
    root = node = Node("body")
    at = 0
    opened: Counter[str] = Counter()

    def leave(n: Node) -> Node:
        opened[n.role] -= 1
        return n.parent or root

    closes = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
    for m in TAG.finditer(text):
        name = (m[1] or "").lower()
        if name and name not in TAGS and name not in WIKI_TAGS:
            continue
        if m.start() > at:
            Node("#", node, text[at : m.start()])
        at = m.end()
        if not name:
            continue
        if m[0][1] == "/":
            if opened[name] > 0:
                while node.role != name:
                    node = leave(node)
                node = leave(node)
            continue
        if name in BLOCK_TAGS and node.role == "p" and name != "p":
            node = leave(node)
        for _ in range(3):
            if node.role in closes.get(name, ()) and node.parent is not None:
                node = leave(node)
        if name == "br":
            Node("#", node, "\n")
            continue
        new = Node(name, node, "", int(name[1]) if re.fullmatch("h[1-6]", name) else 0)
        if name not in VOID_TAGS and not m[0].endswith("/>"):
            node = new
            opened[name] += 1
    if at < len(text):
        Node("#", node, text[at:])
    return root


def score_tree(root: Node) -> Node:
    """Scores containers and returns the best one (the root if nothing scores)."""
    measure(root)
    stack, best = [root], root
    scored: list[Node] = []
    while stack:
        n = stack.pop()
        stack.extend(n.kids)
        if n.role in ("p", "pre", "td", "blockquote", "li", "div"):
            own = "".join(k.text for k in n.kids if k.role == "#") + "".join(g.text for k in n.kids if k.role not in BLOCK_TAGS for g in k.kids)
            if len(own.strip()) < 25 or n.parent is None:
                continue
            points = 1 + own.count(",") + min(len(own) // 100, 3)
            n.parent.score += points
            scored.append(n.parent)
            if n.parent.parent is not None:
                n.parent.parent.score += points / 2
                scored.append(n.parent.parent)
    for n in scored:
        if n.score * (1 - n.link_density()) > best.score * (1 - best.link_density()):
            best = n
    return best


HEADS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def worthy(n: Node, bar: float, beside: bool) -> bool:
    """Whether a sibling of the best container (``beside``), or of a container around it, stays."""
    if n.role in HEADS or n.role == "#":
        return True
    if n.role in ("ul", "ol", "dl", "pre", "math", "table", "blockquote"):
        return beside or n.link_density() < 0.5
    if n.role in ("p", "div", "section", "article", "main", "center"):
        return n.score >= bar or n.link_density() < 0.25 or n.size > 80 and n.link_density() < 0.5
    return beside and n.score >= bar or n.role not in BLOCK_TAGS and n.link_density() < 0.5


def main_nodes(root: Node) -> list[Node]:
    """The best container, its worthy siblings and those of the containers around it, in document order."""
    best = node = score_tree(root)
    bar = max(10.0, best.score * 0.2)
    before: list[list[Node]] = []
    after: list[list[Node]] = []
    while node.parent is not None:
        kids = node.parent.kids
        at = kids.index(node)
        before.append([k for k in kids[:at] if worthy(k, bar, node is best)])
        after.append([k for k in kids[at + 1 :] if worthy(k, bar, node is best)])
        node = node.parent
    return [*(k for level in reversed(before) for k in level), best, *(k for level in after for k in level)]


def html_blocks(nodes: list[Node]) -> list[tuple[str, int, str]]:
    out: list[tuple[str, int, str]] = []
    buffer: list[str] = []

    def flush(role: str = "para", level: int = 0) -> None:
        text = "".join(buffer)
        buffer.clear()
        text = text.strip("\n") if role == "code" else tidy(text)
        if text.strip():
            out.append((role, level, text))

    roles = {"li": "item", "pre": "code", "math": "formula", "blockquote": "quote", "td": "cell", "th": "cell"}
    # (node, its role, its level, whether its kids are done): a stack, so depth costs nothing
    stack = [(n, "para", 0, False) for n in reversed(nodes)]
    while stack:
        n, role, level, done = stack.pop()
        if done:
            flush(role, level)
            continue
        if n.role == "#":
            buffer.append(n.text)
            continue
        if n.role in ("script", "style", "head"):
            continue
        mine, lvl = ("heading", n.level) if n.level else (roles.get(n.role, role), level)
        if n.role == "tr":
            flush(role, level)
            cells = [tidy(plain(c)) for c in n.kids if c.role in ("td", "th")]
            if any(cells):
                out.append(("row", 0, " | ".join(cells)))
            continue
        if n.role in BLOCK_TAGS:
            flush(role, level)
            stack.append((n, mine, lvl, True))
        stack.extend((k, mine, lvl, False) for k in reversed(n.kids))
    flush()
    return out


def plain(n: Node) -> str:
    out, stack = [], [n]
    while stack:
        n = stack.pop()
        out.append(n.text)
        stack.extend(reversed(n.kids))
    return "".join(out)


def tidy(text: str) -> str:
    text = text.replace("\xa0", " ").replace("\t", " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text.replace(" \n", "\n").replace("\n ", "\n").strip()


# ---------------------------------------------------------------- languages


def money(m: str) -> bool:
    """Whether a dollar pair holds amounts rather than a formula."""
    return not LATEX_NOT_MONEY.search(m.strip("$"))


def find_kinds(text: str) -> dict[str, int]:
    """How many constructs of each language the text holds; shared constructs are attributed already."""
    got: Counter[str] = Counter()
    if not text:
        return got
    wiki = len(WIKI_LINK.findall(text)) + len(WIKI_TEMPLATE.findall(text)) if "[[" in text or "{{" in text else 0
    if "''" in text:
        wiki += sum(1 for _ in WIKI_QUOTE.finditer(text))
    if "=" in text:
        wiki += sum(1 for m in WIKI_HEAD.finditer(text) if re.search(r"[^\W\d_]{2}", m[2]))
    if "{|" in text:
        wiki += len(WIKI_TABLE.findall(text))
    wiki += len(WIKI_MISC.findall(text)) if "__" in text else 0

    rest = text
    code_spans = 0
    if "```" in text or "~~~" in text:
        rest, code_spans = MD_FENCE.subn("\n", rest)
    html_n = wiki_tags = 0
    if "<" in rest:
        for m in TAG.finditer(rest):
            name = (m[1] or "").lower()
            if not name:
                html_n += 1
            elif name in WIKI_TAGS and name not in ("source", "math"):
                wiki_tags += 1
            elif name in TAGS:
                html_n += 1
    if "&" in rest:
        html_n += len(ENTITY.findall(rest))
    wiki += wiki_tags

    bare = rest
    maths = []
    if "$" in rest or "\\" in rest:
        bare = LATEX_CODE.sub(" \\\\verb ", bare) if "\\" in bare else bare
        maths = [m[0] for m in MATH.finditer(bare) if m[0][0] != "$" or not money(m[0])]
        bare = MATH.sub(lambda m: m[0] if m[0][0] == "$" and money(m[0]) else " ", bare)
    maths = [m for m in maths if not m.startswith("<math>")]
    latex = len(LATEX_CMD.findall(bare)) if "\\" in bare else 0
    if "\\" in rest and "\\\\verb " in bare:
        latex += 1

    md = code_spans
    if "<" in bare:
        bare = TAG.sub(lambda m: m[0] if (m[1] or "").lower() not in TAGS | WIKI_TAGS and m[1] else " ", bare)
    if "*" in bare or "_" in bare:
        md += sum(1 for m in MD_STRONG.finditer(bare) if re.search(r"[^\W_]", m[0]))
    if "`" in bare:
        md += len(MD_TICK.findall(bare))
    if "~~" in bare:
        md += len(MD_STRIKE.findall(bare))
    if "](" in bare or "][" in bare or "]:" in bare:
        md += len(MD_LINK.findall(bare))
    if "[^" in bare:
        md += len(MD_FOOT.findall(bare))
    if "#" in bare:
        md += markdown_heads(bare, wiki)
    if "===" in bare or "---" in bare:
        md += sum(1 for m in MD_UNDERLINE.finditer(bare) if underlined(bare, m.start()))
    if "|" in bare:
        md += len(MD_TABLE.findall(bare))
    if ">" in bare:
        md += len(MD_QUOTE.findall(bare))

    if wiki:
        got["wiki"] = wiki + html_n
    elif html_n:
        got["html"] = html_n
    if md:
        got["markdown"] = md
    if latex:
        got["latex"] = latex + len(maths)
    elif not got and (maths or "\\" in bare and MATH_CMD.search(bare)):
        got["latex"] = max(1, len(maths))
    return got


def underlined(text: str, at: int) -> str:
    """The heading that a line of = or - at ``at`` underlines, or nothing."""
    if at < 2:
        return ""
    start = text.rfind("\n", 0, at - 1) + 1
    line = text[start : at - 1]
    return line if 0 < len(line.strip()) < 200 and line[0] not in "=-|#> \t" and re.search(r"\w", line) else ""


def setext(text: str) -> str:
    """Underlined headings rewritten as marked heading lines."""
    out, at = [], 0
    for m in MD_UNDERLINE.finditer(text):
        if line := underlined(text, m.start()):
            start = m.start() - 1 - len(line)
            if start >= at:
                out += [text[at:start], f"\ue002h{1 if m[1][0] == '=' else 2} {line}"]
                at = m.end()
    return "".join([*out, text[at:]])


def markdown_heads(text: str, wiki: int) -> int:
    """ATX headings; in a wiki text a run of lines that begin with # is a numbered list."""
    n = 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if line[:1] == "#" and MD_HEAD.fullmatch(line):
            if wiki:
                near = [x[:1] for x in (*lines[max(0, i - 1) : i], *lines[i + 1 : i + 2])]
                if "#" in near or "*" in near:
                    continue
            n += 1
    return n


_TEMPLATE_MARK = re.compile(r"\{\{|\}\}")


def open_templates(t: str) -> str:
    """Templates, at any depth: those with named parameters go, of others the last parameter stays. Openings and ends without a partner stay."""
    stack: list[list[str]] = [[]]
    at = 0
    for m in _TEMPLATE_MARK.finditer(t):
        stack[-1].append(t[at : m.start()])
        at = m.end()
        if m[0] == "{{":
            stack.append([])
        elif len(stack) == 1:
            stack[-1].append(m[0])
        else:
            body = "".join(stack.pop())
            stack[-1].append("" if "=" in body else body.rsplit("|", 1)[-1])
    stack[-1].append(t[at:])
    return "{{".join("".join(part) for part in stack)


_BRACE = re.compile(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{|\\.|[{}]", re.S)


def open_commands(t: str) -> str:
    """Commands with an argument, at any depth, replaced by the argument; plain braces stay outside of them."""
    stack: list[tuple[str, list[str]]] = [("", [])]
    inside = at = 0
    for m in _BRACE.finditer(t):
        stack[-1][1].append(t[at : m.start()])
        at = m.end()
        if m[0][-1] == "{" and m[0] != "\\{":
            stack.append((m[0], []))
            inside += m[0] != "{"
        elif m[0] == "}" and len(stack) > 1:
            mark, parts = stack.pop()
            inside -= mark != "{"
            body = "".join(parts)
            stack[-1][1].append(body if mark != "{" or inside else "{" + body + "}")
        else:
            stack[-1][1].append(m[0])
    stack[-1][1].append(t[at:])
    return "".join(mark + "".join(parts) for mark, parts in stack)


def strip_latex(t: str) -> str:
    t = re.sub(r"\\(?:label|ref|eqref|pageref|cite[a-z]*|vspace\*?|hspace\*?|index|bibliographystyle|bibliography|input|include|includegraphics|usepackage|documentclass)(?:\[[^\]\n]*\])?\{[^{}\n]*\}", "", t)
    t = re.sub(r"\\(?:textcolor|colorbox|href)\{[^{}\n]*\}", "", t)
    t = open_commands(re.sub(r"\\\\(?:\[-?\d[^\]\n]*\])?", " ", t))
    t = re.sub(r"\\(?:hline|toprule|midrule|bottomrule|maketitle|noindent|centering|newpage|par|bigskip|medskip|smallskip|hfill)(?![A-Za-z])", "", t)
    t = re.sub(r"\{\\[a-z]+\s+([^{}]*)\}", r"\1", t)
    t = re.sub(r"\\[A-Za-z]+\*?(?![A-Za-z])[ ]?", "", t)
    t = re.sub(r"\\([%&#$_{}])", r"\1", t)
    # two of them are marks of Markdown
    return re.sub("(?<!~)~(?!~)", " ", t)


_RUN = re.compile(r"\*+|_+")


def open_strong(t: str) -> str:
    """Emphasis marks, at any depth, taken away: a run of one to three stars or underscores that opens at the beginning of a word (two or three stars anywhere), and the same run that ends one."""
    if "*" not in t and "_" not in t:
        return t
    lines = t.split("\n")
    for k, line in enumerate(lines):
        if "*" not in line and "_" not in line:
            continue
        gone: list[tuple[int, int]] = []
        # openings that wait for their end: [sign, first place, end]
        waiting: list[list] = []
        count = {"*": 0, "_": 0}
        for m in _RUN.finditer(line):
            a, b, sign = m.start(), m.end(), m[0][0]
            if b - a > 3:
                continue
            before, after = line[a - 1 : a], line[b : b + 1]
            many = sign == "*" and b - a > 1
            if before != "" and not before.isspace() and before != "\\" and (many or not (after.isalnum() or after == "_")):
                while a < b and count[sign]:
                    # what opened inside and did not end is no mark
                    while waiting[-1][0] != sign:
                        count[waiting.pop()[0]] -= 1
                    top = waiting[-1]
                    n = min(b - a, top[2] - top[1])
                    gone += [(top[2] - n, top[2]), (a, a + n)]
                    a += n
                    top[2] -= n
                    if top[1] == top[2]:
                        waiting.pop()
                        count[sign] -= 1
            if a < b and after and not after.isspace() and before != "\\" and (many or not (before.isalnum() or before == "_")):
                waiting.append([sign, a, b])
                count[sign] += 1
        if gone:
            out, at = [], 0
            for a, b in sorted(gone):
                out.append(line[at:a])
                at = b
            lines[k] = "".join([*out, line[at:]])
    return "\n".join(lines)


_AMPS = re.compile(r"&(?:(?:amp|AMP|#0*38|#[xX]0*26);)+")


def unescaped(t: str) -> str:
    """Escapes read until none is left, also those that were escaped several times."""
    while "&" in t:
        new = html.unescape(_AMPS.sub("&", t))
        if new == t:
            break
        t = new
    return t


def read(text: str, kinds: dict[str, int]) -> tuple[list[tuple[str, int, str]], set[str]]:
    """The blocks (role, level, text) of a text in the proposed languages, and those of the languages of which something was taken away."""
    kept: list[tuple[str, str]] = []
    took: set[str] = set()
    t = text

    def keep(role: str, body: str) -> str:
        kept.append((role, body))
        return f"\n\ue000{len(kept) - 1}\ue001\n" if role in ("code", "formula") and "\n" in body or role == "code" else f"\ue000{len(kept) - 1}\ue001"

    def became(kind: str, new: str) -> None:
        nonlocal t
        if new != t:
            took.add(kind)
            t = new

    tags = "wiki" if "wiki" in kinds else "html"
    if "markdown" in kinds:
        became("markdown", MD_FENCE.sub(lambda m: keep("code", m[2].rstrip("\n")), t))
    if "latex" in kinds:
        became("latex", LATEX_CODE.sub(lambda m: keep("code", (m[2] or m[4] or "").strip("\n")), t))
    if "wiki" in kinds or "html" in kinds:
        became(tags, CODE_TAG.sub(lambda m: keep("code" if "\n" in m[2] or m[1].lower() != "code" else "inline", html.unescape(m[2])), t))
        became(tags, MATH_TAG.sub(lambda m: keep("formula", m[1].strip()), t))
    if kinds:
        # formulas are LaTeX residue only where the text is LaTeX
        new = MATH.sub(lambda m: m[0] if m[0][0] == "$" and money(m[0]) else keep("formula", m[0].strip("$").removeprefix("\\(").removesuffix("\\)").removeprefix("\\[").removesuffix("\\]").strip()), t)
        became("latex", new)
    if "wiki" in kinds:
        new = WIKI_REF.sub("", t)
        new = re.sub(r"\[\[(?:Файл|File|Изображение|Image):[^\[\]\n|]*\|(?:[^\[\]\n]*\|)?(?:мини|thumb|frame|\d+px)?\]\]", "", new)
        new = open_templates(WIKI_LINK.sub(lambda m: m[0][2:-2].rsplit("|", 1)[-1], new))
        while (opened := WIKI_QUOTE.sub(r"\2", new)) != new:
            new = opened
        new = re.sub(r"(?m)^[ \t]*(?:\{\|.*|\|\}|\|-.*|\|\+.*)$", "", new)
        new = re.sub(r"(?m)^[ \t]*[|!](.*)$", lambda m: "\ue002r " + re.sub(r"\|\||!!", " | ", m[1]).strip(), new)
        new = WIKI_HEAD.sub(lambda m: f"\ue002h{len(m[1])} {m[2]}", new)
        signs = "[*:;]" if "markdown" in kinds and markdown_heads(new, 1) else "[*#:;]"
        became("wiki", re.sub(rf"(?m)^{signs}+[ \t]*(?=\S)", "\ue002i ", new))
    if "latex" in kinds:
        new = re.sub(r"\\((?:sub)*)(?:section|chapter|part|title)\*?\{([^{}\n]*)\}", lambda m: f"\n\ue002h{1 + len(m[1]) // 3} {m[2]}\n", t)
        new = TABULAR.sub(lambda m: "\n" + "\n".join("\ue002r " + " | ".join(strip_latex(c).strip() for c in row.split("&")) for row in m[1].split("\\\\") if strip_latex(row).strip()) + "\n", new)
        new = re.sub(r"\\item(?:\[[^\]\n]*\])?[ \t]*", "\n\ue002i ", new)
        new = re.sub(r"\\(?:begin|end)\{[^}\n]*\}(?:\[[^\]\n]*\])?", "\n", new)
        became("latex", strip_latex(new))
    if "markdown" in kinds:
        new = re.sub(r"(?m)^[ ]{0,3}\|?[ \t]*:?-{1,}:?[ \t]*(?:\|[ \t]*:?-{1,}:?[ \t]*)+\|?[ \t]*$", "", t)
        new = re.sub(r"(?m)^[ ]{0,3}\|(.*)\|[ \t]*$", lambda m: "\ue002r " + " | ".join(c.strip() for c in m[1].split("|")), new)
        new = MD_HEAD.sub(lambda m: f"\ue002h{len(m[1])} {m[2]}", new)
        if "===" in new or "---" in new:
            new = setext(new)
        new = MD_QUOTE.sub("\ue002q ", MD_RULE.sub("", new))
        new = re.sub(r"(?m)^[ \t]*(?:[-*+]|\d+[.)])[ \t]+(?:\[[ xX]\][ \t]+)?(?=\S)", "\ue002i ", new)
        new = MD_LINK.sub(lambda m: "" if m[0][0] == "!" else (m[1] or m[3] or ""), new)
        new = MD_TICK.sub(r"\2", MD_STRIKE.sub(r"\2", open_strong(new)))
        became("markdown", MD_ESCAPE.sub(lambda m: m[0][1], MD_FOOT.sub("", new)))
    blocks: list[tuple[str, int, str]]
    if "html" in kinds or "wiki" in kinds:
        became(tags, unescaped(t))
        became(tags, SCRIPT.sub("", t))
        root = html_tree(t)
        if plain(root) != t:
            took.add(tags)
        blocks = html_blocks(main_nodes(root))
    else:
        blocks = [("para", 0, t)]

    out: list[tuple[str, int, str]] = []

    def restore(s: str) -> str:
        return re.sub("\ue000(\\d+)\ue001", lambda m: kept[int(m[1])][1], s)

    for role, level, body in blocks:
        for part in re.split(r"\n(?=\ue002|\ue000\d+\ue001[ \t]*(?:\n|$))|(?<=\ue001)\n|\n{2,}", body):
            r, lvl, p = role, level, part
            if m := re.match(r"\s*\ue002([hirq])(\d?) ?", p):
                r, lvl, p = {"h": "heading", "i": "item", "r": "row", "q": "quote"}[m[1]], int(m[2] or 0), p[m.end() :]
                p, _, after = p.partition("\n") if r == "heading" else (p, "", "")
            else:
                after = ""
            if m := re.fullmatch("\\s*\ue000(\\d+)\ue001\\s*", p):
                r, p = ("code" if kept[int(m[1])][0] == "code" else "formula" if kept[int(m[1])][0] == "formula" else r), kept[int(m[1])][1]
            else:
                p = tidy(restore(p.replace("\ue002q ", "").replace("\ue002", "")))
            if p.strip():
                out.append((r, lvl, p))
            if after.strip():
                out.append((role, level, tidy(restore(after))))
    return out, took & kinds.keys()


def clean_text(text: str | None) -> tuple[str | None, list[str], list[tuple[str, int, str]]]:
    """Clean text, the languages that were taken away, and the blocks. Null stays null; plain text is unchanged."""
    if text is None:
        return None, [], []
    kinds = find_kinds(text)
    if not kinds:
        return text, [], [("para", 0, text)] if text.strip() else []
    blocks, took = read(text, kinds)
    if not took:
        return text, [], [("para", 0, text)] if text.strip() else []
    return "\n".join(b[2] for b in blocks), sorted(took), blocks


# ---------------------------------------------------------------- tables and formulas


def table_cells(table_html: str) -> list[list[str]]:
    """Rows of raw cells of the first table: inner markup kept, ordinary escapes read once."""
    rows: list[list[str]] = []
    cell: list[str] | None = None
    at = 0

    def close() -> None:
        nonlocal cell
        if cell is not None:
            if not rows:
                rows.append([])
            rows[-1].append(html.unescape("".join(cell)).replace("\xa0", " ").strip() if "<" not in "".join(cell) else "".join(cell).strip())
        cell = None

    for m in TAG.finditer(table_html):
        name = (m[1] or "").lower()
        if cell is not None:
            cell.append(table_html[at : m.start()])
        at = m.end()
        if name in TABLE_TAGS:
            if name in ("td", "th"):
                close()
                if m[0][1] != "/":
                    cell = []
            else:
                close()
                if name == "tr" and m[0][1] != "/":
                    rows.append([])
        elif cell is not None:
            cell.append(m[0])
    close()
    return [r for r in rows if r]


WRAP = re.compile(r"\\(?:text|textrm|textit|textbf|textsf|texttt|mathrm|mathit|mathbf|mathsf|mathtt|mathcal|operatorname|mbox|hbox|boldsymbol|bf|it|rm)\*?(?![A-Za-z])")


def formula_prose(formula: str) -> tuple[bool, str]:
    """Whether a formula is prose in formula markup, and the prose.

    Word wrappers are opened, spaced-out letters joined, spacing commands and ~ read as word breaks. It is prose when
    whole words outside sub- and superscripts make up what is said and nothing relates or computes.
    """
    t = re.sub(r"\\(?:begin|end)\s*\{[^}]*\}(?:\s*\{[^}]*\})?", " ", formula.strip().strip("$"))
    math = bool(re.search(r"=|\\(?:leq?|geq?|neq|approx|sim|equiv|in|frac|sqrt|sum|prod|int|cdot|times|pm|partial|nabla|infty|to|rightarrow)(?![A-Za-z])|[<>≤≥≈±×·]", t))
    t = re.sub(r"[_^]\s*(?:\{[^{}]*\}|\\?\w+)", " ", t)
    t = re.sub(r"\\[;,:! ]|\\q?quad|\\\\|&|~", " \ue003 ", t)
    t = WRAP.sub(" \ue003 ", t)
    t = re.sub(r"\\[A-Za-z]+", " \ue003 ", t)
    t = re.sub(r"\}", " \ue003 ", t).replace("{", " ")
    words = []
    for chunk in t.split("\ue003"):
        for piece in re.split(r"\s{2,}", chunk.strip()):
            parts = piece.split()
            if len(parts) > 1 and sum(len(p) == 1 for p in parts) >= 0.7 * len(parts):
                words.append("".join(parts))
            else:
                words.extend(parts)
    prose = [w for w in words if re.search(r"[^\W\d_]{2}", w)]
    said = " ".join(w for w in words if w)
    if math:
        return len(prose) >= 4 and sum(map(len, prose)) > 0.6 * len(re.sub(r"\W", "", said)), said
    return len(prose) >= 2 or any(len(w) >= 5 for w in prose), said


# ---------------------------------------------------------------- operators

BLOCKS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("text", T.StringType())]))
CLEANED = T.StructType([T.StructField("clean", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType())), T.StructField("blocks", BLOCKS)])


@F.pandas_udf(CLEANED)
def _clean_udf(texts: pd.Series) -> pd.DataFrame:
    got = [clean_text(t) for t in texts]
    return pd.DataFrame({"clean": [g[0] for g in got], "kinds": [g[1] for g in got], "blocks": [[{"role": r, "level": lv, "text": x} for r, lv, x in g[2]] for g in got]})


def clean_markup(df: DataFrame, text: str = "text", out: str = "markup") -> DataFrame:
    """Adds ``out`` = struct(clean, kinds, blocks) for the column ``text``; other columns are untouched.

    Texts without any character that markup needs stay in the JVM: they pass unchanged as one block. A null text gives
    null clean text and no kinds, an empty one gives empty. ``out`` replaces a column of that name.
    """
    plain_blocks = F.when(F.trim(F.col(text)) == "", F.array().cast(BLOCKS)).otherwise(F.array(F.struct(F.lit("para").alias("role"), F.lit(0).alias("level"), F.col(text).alias("text"))))
    suspect = F.col(text).rlike(SUSPECT)
    # the pandas UDF sees null for plain texts, so their characters never leave the JVM
    cleaned = df.withColumn("__seen", _clean_udf(F.when(suspect, F.col(text))))
    is_plain = F.col(text).isNotNull() & ~suspect
    result = F.struct(
        F.when(is_plain, F.col(text)).otherwise(F.col("__seen.clean")).alias("clean"),
        F.when(is_plain | F.col(text).isNull(), F.array().cast("array<string>")).otherwise(F.col("__seen.kinds")).alias("kinds"),
        F.when(is_plain, plain_blocks).when(F.col(text).isNull(), F.array().cast(BLOCKS)).otherwise(F.col("__seen.blocks")).alias("blocks"),
    )
    return cleaned.withColumn(out, result).drop("__seen")


def read_table(table_html: str | None) -> tuple[list[list[str]] | None, list[str]]:
    """The clean cells of a table, and the languages taken out of them once the table itself has been read."""
    if not table_html:
        return None, []
    got = [[clean_text(c) if SUSPECTED.search(c) else (c, [], []) for c in row] for row in table_cells(table_html)]
    return [[c[0] or "" for c in row] for row in got], sorted({k for row in got for c in row for k in c[1]})


def kinds_of_cells(table_html: str | None) -> list[str]:
    return read_table(table_html)[1]


FRAGMENT = T.StructType(
    [
        T.StructField("clean", T.StringType()),
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("table_rows", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("formula_text", T.StringType()),
    ]
)


@F.pandas_udf(FRAGMENT)
def _fragment_udf(texts: pd.Series, tables: pd.Series, formulas: pd.Series) -> pd.DataFrame:
    rows: list[dict] = []
    for text, table, formula in zip(texts, tables, formulas, strict=True):
        clean, kinds, _ = clean_text(text)
        kinds = set(kinds)
        cells, of_cells = read_table(table)
        kinds.update(of_cells)
        said = None
        if formula:
            mangled, prose = formula_prose(formula)
            said = prose if mangled else formula
            if mangled:
                kinds.add("mangled")
        rows.append({"clean": clean, "kinds": sorted(kinds), "table_rows": cells, "formula_text": said})
    return pd.DataFrame(rows, columns=[f.name for f in FRAGMENT])


def clean_fragments(df: DataFrame, text: str = "text", table_html: str = "structured_payload.table_html", formula: str = "formula", out: str = "markup") -> DataFrame:
    """Adds ``out`` = struct(clean, kinds, table_rows, formula_text): text and table cells cleaned, formulas that are prose
    in formula markup spelled out, true formulas kept. Null inputs give null outputs. Plain texts, and cells without any
    suspicious character, are passed by value."""
    t = F.col(text)
    seen = df.withColumn("__seen", _fragment_udf(F.when(t.rlike(SUSPECT), t), F.col(table_html), F.col(formula)))
    result = F.struct(
        F.coalesce(F.col("__seen.clean"), t).alias("clean"),
        F.col("__seen.kinds").alias("kinds"),
        F.col("__seen.table_rows").alias("table_rows"),
        F.col("__seen.formula_text").alias("formula_text"),
    )
    return seen.withColumn(out, result).drop("__seen")


def found(documents: DataFrame, fragments: DataFrame) -> DataFrame:
    """(rec_table, rec_id, kind): the records whose cleaning took markup of that kind away."""
    docs = clean_markup(documents.select("doc_id", "text"))
    docs = docs.select(F.lit("documents").alias("rec_table"), F.col("doc_id").alias("rec_id"), F.explode("markup.kinds").alias("kind"))
    frags = clean_fragments(fragments.select("fragment_no", "text", "formula", "structured_payload"))
    frags = frags.select(F.lit("fragments").alias("rec_table"), F.col("fragment_no").alias("rec_id"), F.explode("markup.kinds").alias("kind"))
    return docs.unionByName(frags)
