import random
import time

import pytest

from sheafline.llm import markup as M

DOC = "doc_id long, text string"


def kinds(text):
    return sorted(M.find_kinds(text))


def test_languages_are_told_apart():
    assert kinds("<p>Open the <b>valve</b>.</p>") == ["html"]
    assert kinds("# Head\n\nText with **strong** words.") == ["markdown"]
    assert kinds("== Head ==\n\nA [[link|word]] and '''bold''' text.<ref>p. 2</ref>") == ["wiki"]
    assert kinds("\\section{Head}\n\nThe \\textbf{brass} pump.") == ["latex"]
    assert kinds("<p>Let</p> <math>a = \\sqrt{b}</math>") == ["html"]
    assert kinds("The \\emph{main} valve and ~~old~~ seal.") == ["latex", "markdown"]
    assert kinds("&amp;nbsp;Text") == ["html"]


def test_plain_text_is_no_residue():
    for t in ("A & B, a < b: run(1)", "* see p. 3", "No 168 | 86", "$116 / 5 $", "pos. #10", "D:\\album\\sheet34\\new", "= = = = =", "a_3 - b_7", "x <9> y", "[1], [2]", "- item\n- item", "2 * 3 * 4", "file_1_rev_2.dxf", "1^2 ~ 3"):
        assert kinds(t) == [], t


def test_structure_is_kept():
    clean, _, blocks = M.clean_text("# Head\n\nText **strong**.\n\n- one\n- two\n\n```\ncode  *x*\n```\n")
    roles = [b[0] for b in blocks]
    assert roles == ["heading", "para", "item", "item", "code"]
    assert "code  *x*" in clean and "**strong**" not in clean and "strong" in clean


def test_main_container_is_kept_and_navigation_dropped():
    nav = "<div>" + "".join(f'<a href="/{i}">chapter number {i}</a> ' for i in range(12)) + "</div>"
    body = "<div>" + "<p>The pump, which feeds the tank, turns the shaft, and the valve closes the line. It runs, as planned, all day.</p>" * 4 + "</div>"
    clean, _, _ = M.clean_text(f"<html><body>{nav}{body}</body></html>")
    assert "feeds the tank" in clean and "chapter number" not in clean


def test_latex_and_wiki_tables():
    _, _, blocks = M.clean_text("\\section{A}\n\\begin{tabular}{ll}\na & b \\\\ \\hline\nc & d \\\\\n\\end{tabular}")
    assert ("row", 0, "a | b") in blocks and ("row", 0, "c | d") in blocks
    clean, _, _ = M.clean_text("== A ==\n{|\n|-\n| x || y\n|}")
    assert "x | y" in clean


def test_cells_and_formulas():
    assert M.kinds_of_cells("<table><tr><td>A &amp; B</td><td>&lt; 3</td><td>2 * 3</td></tr></table>") == []
    assert M.kinds_of_cells("<TABLE><TR><TD>a<TD><b>x</b></TABLE>") == ["html"]
    assert M.kinds_of_cells("<table><tr><td>''x''</td><td>~~y~~</td></tr></table>") == ["markdown", "wiki"]
    assert M.formula_prose("\\mathrm { T h e ~ p u m p ~ s t o p s }") == (True, "The pump stops")
    for f in ("P = \\frac{h_1}{49}", "Q_{\\mathrm{max}} = 62", "a_{\\text{max}} \\leq 9, \\quad \\text{if } k = 3", "\\mathrm{Re} = \\sigma"):
        assert not M.formula_prose(f)[0], f


def test_nulls_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "plain"), (3, "plain"), (4, "<b>x</b>"), (5, "<p>" + "word, " * 40_000 + "</p>"), (None, "**b**")]
    df = spark.createDataFrame([(*r, 7) for r in rows], DOC + ", markup long")
    got = M.clean_markup(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): r.markup for r in got}
    assert by[1, None].clean is None and by[1, None].kinds == []
    assert by[2, ""].clean == "" and by[2, ""].blocks == []
    assert by[3, "plain"].clean == "plain" and by[4, "<b>x</b>"].clean == "x"
    assert M.clean_markup(spark.createDataFrame([], DOC)).count() == 0
    frags = spark.createDataFrame([(1, None, None, None), (2, "", "", ("<table></table>",))], "fragment_no long, text string, formula string, structured_payload struct<table_html: string>")
    assert {r.fragment_no: r.markup.kinds for r in M.clean_fragments(frags).collect()} == {1: [], 2: []}


def test_constructs_of_any_length_are_read():
    long = "слово и ещё " * 4000
    for text, kind in ((f"до <!-- {long} --> после", "html"), (f"\\emph{{a}} \\( x {long} \\) b", "latex"), (f"\\emph{{a}} \\begin{{align*}} x {long} \\end{{align*}} b", "latex"), (f"до ''{long}конец'' после", "wiki"), (f"до _{long}конец_ после", "markdown"), (f"до `{long}` после", "markdown")):
        clean, kinds, blocks = M.clean_text(text)
        short, _, short_blocks = M.clean_text(text.replace(long, "слово "))
        assert list(kinds) == [kind] and [b[0] for b in blocks] == [b[0] for b in short_blocks]
        assert not any(mark in clean and mark not in short for mark in ("<!--", "\\(", "\\begin", "''", "_", "`"))


def test_forward_scan_finds_what_the_pattern_finds():
    rng = random.Random(1)
    signs = ["<!--", "-->", "<b>", "\\(", "\\)", "\\[", "\\]", "\\begin{align}", "\\begin{math*}", "\\end{align*}", "\\end{math}", "<math>", "</math>", "$", "'", "''", "_", "__", "`", "``", "*", "a", " ", "\n", "\\"]
    scans = (M.TAG, M.MATH, M.WIKI_QUOTE, M.MD_STRONG, M.MD_TICK)
    for _ in range(1500):
        text = "".join(rng.choices(signs, k=rng.randint(2, 40)))
        for f in scans:
            forward = M.Forward(f.pattern, f.opening.pattern, f.closing, -1, f.line)
            assert [m.span() for m in forward.finditer(text)] == [m.span() for m in f.pattern.finditer(text)]
    began = time.time()
    for f, opening in zip(scans, ("<!-- ", "\\( ", " ''a", " _a", " `a"), strict=True):
        assert not [m for m in f.finditer(opening * 20_000) if len(m[0]) > 40_000]
    assert time.time() - began < 10


@pytest.mark.parametrize(
    "text, kind, clean",
    [
        ("before <!--" + "x" * 20_005 + "--> after", "html", "before after"),
        (r"\textbf{b} \(" + "x+1 " * 20_005 + r"\) end", "latex", "b " + ("x+1 " * 20_005).strip() + " end"),
        ("see {{a|{{b|{{c|{{d|{{e|deep}}}}}}}}}} end", "wiki", "see deep end"),
        (r"\textbf{a \emph{b \textit{c \textsf{d \texttt{e \underline{f}}}}}}", "latex", "a b c d e f"),
        ("<b>x " * 1200, "html", ("x " * 1200).strip()),
        ("&amp;amp;amp;lt;b&amp;amp;gt;bold &nbsp;", "html", "bold"),
        ("**bold *and __deep__ marks***", "markdown", "bold and deep marks"),
        (r"seals\\[2mm] the \emph{pump}", "latex", "seals the pump"),
        (r"\emph{a} b ~~c~~", "latex", "a b c"),
    ],
)
def test_constructs_of_any_length_and_depth(text, kind, clean):
    got, kinds, _ = M.clean_text(text)
    assert kind in kinds and " ".join(got.split()) == clean


def test_hostile_texts_stay_cheap():
    began = time.time()
    for text in ("<b>" * 40_000 + "</i>" * 40_000, "{{" * 40_000 + "}}" * 40_000 + "[[a]]", "*_" * 20_000 + "a" + "_*" * 20_000, "\\textbf{" * 20_000 + "}" * 20_000, "<pre>" * 20_000 + "<!--" * 20_000, "&" + "amp;" * 20_000 + "lt;b>"):
        M.clean_text(text)
    assert time.time() - began < 30


def test_what_stands_around_the_best_container_stays():
    page = (
        "<p>Intro paragraph that is long enough, with commas, and more.</p><ul><li>one</li><li>two</li></ul><pre>x = 1\ny = 2</pre>"
        + "<div><div><p>" + "Long text, with commas, of the winner. " * 30 + "</p><p>" + "More text, of it. " * 20 + "</p></div></div>"
        + "<p>Closing paragraph, long enough to stay.</p><table><tr><td>a</td><td>b</td></tr></table><ul><li><a href=x>Home</a></li><li><a href=y>About us</a></li></ul><nav><a href=z>Next</a></nav>"
    )
    clean, kinds, blocks = M.clean_text(page)
    assert kinds == ["html"]
    for part in ("Intro paragraph", "one", "two", "x = 1\ny = 2", "Long text", "Closing paragraph", "a | b"):
        assert part in clean
    assert "Home" not in clean and "Next" not in clean
    assert clean.index("Intro") < clean.index("Long") < clean.index("Closing")


def test_kinds_are_what_the_reader_took():
    assert M.clean_text("plain text, 5 < 6 & 7 > 3")[1] == []
    blocks, took = M.read("plain text", {"html": 1, "markdown": 1})
    assert took == set() and blocks == [("para", 0, "plain text")]
