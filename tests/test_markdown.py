"""Markdown to text: hand-made answers after the CommonMark specification, and inputs that must not take long."""

import time

import pytest

from contentlake.functions.markdown import Blocks, inline_text, markdown_rendered, rendered_text

CASES = {
    # titles and rules
    "Title\n=====\n\npara": "Title\npara", "a\n---\nb": "a\nb", "two\nlines\n===": "two\nlines", "# H1 #\n## H *two* ##\n#no\n#": "H1\nH two\n#no",
    "* * *\n- - -\n___\ntext": "text", "####### seven": "####### seven", "    # code": "",
    # lists and quotes
    "- one\n  - two\n    continues\n\n      nested para\n- three": "one\ntwo\ncontinues\nnested para\nthree",
    "1. a\n2. b\n\n   c\n\n       code": "a\nb\nc", "-\n  foo": "foo", "The number\n14. x": "The number\n14. x", "The number\n1. x": "The number\nx",
    "> quote *em*\nlazy\n\n> - x\n>   y": "quote em\nlazy\nx\ny", "> a\n# b": "a\nb", "- a\n\n      code\n  b": "a\nb", "10) ten\n\n    still": "ten\nstill",
    # code
    "```py\ncode\n```\ntext\n~~~\nmore\n~~~~\nend": "text\nend", "    code\n\ntext\n    cont": "text\ncont", "\tcode\n\n\ttab": "",
    "```\nnever closed": "", "> ```\n> code\nafter": "after", "`` a`b `` ```": "a`b ```", "a `b *c*` d": "a b *c* d", "``` a`b": "``` a`b", "` `` `": "``",
    # emphasis
    "**d** __e__ f_g_h *i": "d e f_g_h *i", "***bold em*** and **a*b*c**": "bold em and abc", "*a _b* c_": "a _b c_", "** x **": "** x **",
    "word*** other*** third***": "word*** other*** third***", "~~gone~~ a ~ b": "gone a ~ b", "a*b*c 2*3": "abc 2*3", "_(x)_ snake_case": "(x) snake_case",
    "*foo**bar**baz*": "foobarbaz", "**foo*": "*foo",
    # links, images, references
    "[ref][1] and [2] and [x]\n\n[1]: http://x.y/z 'T'\n[2]: <u>": "ref and 2 and [x]", "[a [b](c) d](e)": "[a b d](e)", "[a](b(c)d) e": "a e",
    "![alt](x.png) [l *i*](u \"t\") <http://a.b> <me@x.org>": "l i http://a.b me@x.org", "[foo]:\n/url\n\n[FOO][] [Foo]": "FOO Foo", "[a]: b c": "[a]: b c",
    "[x]({{< relref \"/a b.md\" >}}) y": "x y", "[![i](a)](b) t": "t", "] [ ![": "] [ ![", "[a](": "[a](", "[not][missing]": "[not][missing]",
    # escapes, entities, tags
    r"\*x\* \# \a": r"*x* # \a", "<b>bold</b> &amp; &lt; &#33; &nosuch; AT&T": "bold & < ! &nosuch; AT&T", "`<b>` <b x='>'>t</b> a < b": "<b> t a < b",
    "x <!-- c --> y <!-- open": "x  y <!-- open", "line  \nbreak\\\nthree": "line\nbreak\nthree", "a <pre>code</pre> b": "a  b",
    "<div>\n*not em* &amp;\n</div>\n\n*em*": "*not em* &\nem", "<pre>\ngone\n\nstill\n</pre>\nafter": "after", "<!-- c\n\n d -->\nx": "x",
    # tables
    "| a | b |\n|---|:-:|\n| 1 | *c* \\| e |\n\nafter": "a b\n1 c | e\nafter", "a | b\n--- | ---\n1 | `x`": "a b\n1 x", "a | b\n---": "a | b", "| a |\n|--|--|": "| a |\n|--|--|",
    "": "", "\n \n": "", "a\r\nb\rc": "a\nb\nc",
}


@pytest.mark.parametrize("source", CASES)
def test_hand_made(source):
    assert rendered_text(source) == CASES[source]


@pytest.mark.parametrize("piece", ["onor*** the&&& ", "*a ", "[a ", "a] ", "`a ``b ", "<a ", "*a_ ", "~~a ", "[a](b ", "![[", "&", "a\n", "<!--", "x <!--", "<?", "\\", "- x\n", "> ", "(", "[a]: b\n", "|a"])
def test_no_input_takes_more_than_its_length(piece):
    def took(n):
        start = time.perf_counter()
        rendered_text(piece * n)
        return time.perf_counter() - start

    n = 20_000 if piece != "> " else 500
    took(n // 4)
    assert took(n) < max(1.0, 12 * took(n // 4))


def test_column(apply):
    assert apply(["*a*", None, ""], markdown_rendered) == ["a", None, ""]
    assert inline_text("[a]", {"a"}) == "a" and Blocks("[A  b]: c").labels == {"a b"}
