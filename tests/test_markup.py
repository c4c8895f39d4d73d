import html
import random
from html.parser import HTMLParser

import pytest

from tablerich.operators.markup import markdown


def test_what_a_page_keeps():
    assert markdown("&eacute; &#8212; &#x41; &amp;lt;") == "é — A &lt;"
    assert markdown("see <a href='/x?a=1&amp;b=2'>the <i>link</i></a>, <a>none</a> <a href=u></a>") == "see [the link](/x?a=1&b=2), none"
    assert markdown("a<img alt=\"a>b\" src=q>c<img alt=x>") == "a![a>b](q)c"
    assert markdown("<table><tr><th>1</th><td>2</td></tr><tr><td>3<td>4</table>") == "1 | 2\n3 | 4"
    assert markdown("x<pre>a  b\n  c\n\n\td</pre>y  z") == "x\na  b\n  c\n\n\td\ny z"
    assert markdown("<ul><li>a<ul><li>b<ol><li>c</ol></ul><li>d</ul>") == "- a\n  - b\n    - c\n- d"
    assert markdown("a<!-- <p>b</p> --><script>if (x<y && 'q) </p>\"</script>c<style>p{}") == "a c"
    assert markdown("1 < 2 <3 a<b>c</b> <") == "1 < 2 <3 ac <"
    assert markdown("<p>a<p>b<div>c</div></p></div></ul>d</a>") == "a\nb\nc\nd"
    assert markdown("<h2>T</h2>x<br>y<br/>z") == "## T\nx\ny\nz"
    assert markdown("") == "" and markdown(None) is None and markdown("<p> </p>") == "" and markdown("<a href='x") == "<a href='x"


def test_main_text():
    page = "<nav><a href=/a>Aa Bb</a> <a href=/b>Cc</a></nav><p>Real text <a href=x>here</a></p><ul><li><a href=1>x y</a></ul><p>more"
    assert markdown(page, True) == "Real text [here](x)\nmore"
    assert markdown(page) == "[Aa Bb](/a) [Cc](/b)\nReal text [here](x)\n- [x y](1)\nmore"


class Words(HTMLParser):
    """The words of a page by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        self.found.append(" " if tag not in ("b", "i", "a", "span") else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        self.found.append(" " if tag not in ("b", "i", "a", "span") else "")

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


@pytest.mark.parametrize("seed", range(5))
def test_no_text_is_lost_or_made_up(seed):
    rng = random.Random(seed)

    def build(depth):
        if depth == 0 or rng.random() < 0.3:
            return html.escape("".join(rng.choices("ab<>&\"' é", k=rng.randrange(1, 8)))) + rng.choice(["", "&eacute;", "&#233;", " "])
        tag = rng.choice(["p", "div", "b", "i", "h2", "section", "span"])
        inner = "".join(build(depth - 1) for _ in range(rng.randrange(1, 4)))
        return f'<{tag} class="x>y" data=1>{inner}' + (f"</{tag}>" if tag in ("b", "i", "span", "h2") or rng.random() < 0.7 else "")

    for _ in range(100):
        page = "".join(build(4) for _ in range(3)) + rng.choice(["", "<script>var a = '<p>x';</script>", "<!-- c -->"])
        plain = Words()
        plain.feed(page)
        plain.close()
        assert markdown(page).replace("#", " ").split() == "".join(plain.found).replace("#", " ").split()
