import math
import random
import time

from bourse.llm.html_text import BLOCK, Page, extract_text, main_text

LONG = "This paragraph has quite a number of words in it, as articles do, and no links at all. " * 3


def page(body, head="<title>T &amp; t</title><style>p{margin:0}</style><script>var t='</p>';if(a<b){}</script>"):
    return f"<!DOCTYPE html><html lang=en><head>{head}</head><body>{body}"


def test_article_without_its_surroundings():
    html = page(
        '<nav><ul><li><a href="/a">Menu</a></li></ul></nav><header><h2>Site</h2></header><!-- ad <p>no</p> --><div class="ad">Buy</div>'
        f"<article><h1>Title &copy; one &am</h1><p><b>First&nbsp; line\n two.<br><p>{LONG}</p><aside>side</aside><form>f<input>"
        "<p>x</p></form><ul><li>a<li>b &lt; c</ul><div id='comments-list'><p>reader says</p></div><script>no()</script></article>"
        '<div class="cookie-notice">We use cookies</div><footer>&copy; us</footer></body></html>'
    )
    assert main_text(html) == "\n".join(["Title © one &am", "First line two.", LONG.strip(), "a", "b < c"])


def test_text_density_finds_unmarked_content():
    links = "".join(f'<div><a href="/{i}">some link text number {i}</a></div>' for i in range(12))
    html = page(f"<div>{links}</div><div id=c><h2>Head of the text</h2><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div>{links}</div></body>")
    assert main_text(html) == "\n".join(["Head of the text", *[LONG.strip()] * 3])
    assert main_text(page(f"<main><p>{LONG}</p></main><div><p>{LONG}{LONG}</p></div>")) == LONG.strip()
    # an aside's name on a wrapper of the article, and a form around the page
    assert main_text(page(f'<div class="sidebar-layout menu"><article><p>{LONG}</p></article></div>')) == LONG.strip()
    assert main_text(page(f"<form><div><p>{LONG}</p><p>{LONG}</p><p>b</p></div></form>")) == "\n".join([LONG.strip()] * 2 + ["b"])


def test_broken_pages():
    assert main_text("") == main_text("<p>") == main_text(page("<nav>only a menu</nav>")) == ""
    assert main_text("plain  text \n only") == "plain text only"
    assert main_text("<article><p>cut <b>off<p>here <a hre") == "cut off\nhere"
    assert main_text('<article><p class="a>b">x</p><p title="open>y</p>') == "x\ny"
    assert main_text("<article>a < b <3 </nothing> &#x41;&#65;&bogus;</p>") == "a < b <3 AA&bogus;"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("<article><table><tr><td>1<td>2<tr><th>3</table><dl><dt>t<dd>d</dl><pre>a\n b</pre>") == "1\n2\n3\nt\nd\na b"
    assert main_text("<article>" + "<p>w " * 20_000).count("\n") == 19_999


def test_rows(spark):
    rows = [(1, "u", "<article><p>é 😀</article>", 5), (2, None, None, 5), (None, "v", "", 5), (1, "u", "<article><p>é 😀</article>", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((str(r.page_id), r.url, r.text, r.n_chars) for r in extract_text(df).collect()), key=str)
    assert got == sorted([("1", "u", "é 😀", 3), ("1", "u", "é 😀", 3), ("2", None, "", 0), ("None", "v", "", 0)], key=str)
    assert extract_text(df.where("false")).count() == 0


def test_density_decides_where_articles_are_not_the_story():
    cards = "".join(f'<article><h3><a href="/{i}">Teaser of another story {i}</a></h3><p>Short words.</p></article>' for i in range(6))
    story = f"<div><h1>The story</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    want = "\n".join(["The story", *[LONG.strip()] * 3])
    assert main_text(page(f"{story}<div>{cards}</div>")) == want
    assert main_text(page(f"<div>{cards}</div>{story}")) == want
    assert main_text(page(f"<main>{story}<div>{cards}</div></main>")) == want
    assert main_text(page(f"<main></main>{story}")) == want
    # a story in several articles; an article of one paragraph in a page of little else
    parts = "".join(f"<article><h2>Part {i}</h2><p>{LONG}</p><p>{LONG}</p></article>" for i in range(3))
    assert main_text(page(parts)) == "\n".join(x for i in range(3) for x in (f"Part {i}", LONG.strip(), LONG.strip()))
    assert main_text(page(f"<div>By a writer</div><article><p>{LONG}</p></article>")) == LONG.strip()


def test_names_are_believed_only_if_the_text_agrees():
    story = f"<h1>The story</h1><p>{LONG}</p><p>{LONG}</p>"
    want = "\n".join(["The story", *[LONG.strip()] * 2])
    links = "".join(f'<li><a href="/{i}">some link text number {i}</a></li>' for i in range(20))
    side = f'<div class="sidebar"><p>Short words.</p></div><div class="related"><ul>{links}</ul></div><div id="comments">{LONG}</div>'
    for name in ("content has-sidebar", "page-with-nav", "social-science", "menu-open", "post comments-open cookies-ok"):
        assert main_text(page(f'<div class="{name}">{story}</div>')) == want
    for name in ("content has-sidebar", "page-with-nav", "social-science", "menu-open"):
        assert main_text(page(f'<div class="{name}">{story}{side}</div>')) == want
    for name in ("notice", "related-work"):
        assert main_text(page(f'<article>{story}<div class="{name}"><p>{LONG}</p><p>{LONG}</p></div>{side}</article>')) == "\n".join([want, *[LONG.strip()] * 2])


PIECES = "p div li ul td tr table tbody th dl dt dd article main b i a button section h2 option select".split()


def soup(seed, names=PIECES, n=80):
    rnd = random.Random(seed)
    out = []
    for _ in range(rnd.randint(1, n)):
        kind = rnd.random()
        if kind < 0.7:
            out.append(f"<{'/' if kind > 0.45 else ''}{rnd.choice(names)}>")
        else:
            out.append(" ".join(rnd.choice(["word", "longer words", "x, y"]) for _ in range(rnd.randint(1, 40))))
    return "".join(out)


class WalkedPage(Page):
    """Open elements found by walking the whole stack from the innermost outward."""

    def _read(self, html):
        self.stack = []
        super()._read(html)

    def _push(self, node, stack):
        self.stack = stack
        super()._push(node, stack)

    def _innermost(self, tags):
        for place in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[place]] in tags:
                return place
        return -1


def test_open_elements_equal_a_walk_of_the_stack():
    for seed in range(600):
        a, b = Page(soup(seed)), WalkedPage(soup(seed))
        assert (a.tag, a.parent, a.events, a.span) == (b.tag, b.parent, b.events, b.span)


def brute_content(page):
    """The content nodes of a page without asides, articles and mains: every density computed anew from the node's own subtree."""
    count = len(page.tag)

    def chain(i):
        while i >= 0:
            yield i
            i = page.parent[i]

    subtree = [[j for j in range(count) if i in chain(j)] for i in range(count)]
    linked = [any(page.tag[j] == "a" for j in chain(i)) for i in range(count)]

    def density(i):
        own = set(subtree[i])
        sizes = [(n, len("".join(t.split()))) for n, t in page.events if t is not None]
        c, lc = sum(s for n, s in sizes if n in own), sum(s for n, s in sizes if n in own and linked[n])
        body, body_link = sum(s for _, s in sizes), sum(s for n, s in sizes if linked[n])
        t = max(1, sum(j > 0 for j in own) - 1)
        lt = max(1, sum(page.tag[j] == "a" for j in own))
        if not c:
            return 0.0
        base = math.log(math.log(c / max(1, c - lc) * lc + body_link / body * c + math.e + 1))
        return c / t * max(0.0, math.log(c / max(1, lc) * t / lt)) / base

    blocks = [i for i in range(count) if i == 0 or page.tag[i] in BLOCK]
    dense = {i: density(i) for i in blocks}
    up = {i: next(j for j in chain(page.parent[i]) if j in dense) for i in blocks if i}
    kids = {i: [j for j in blocks if j and up[j] == i] for i in blocks}
    sums = {i: sum(dense[j] for j in kids[i]) if kids[i] else dense[i] for i in blocks}
    centre = max(blocks, key=lambda i: (sums[i], -i))
    path = [i for i in chain(centre) if i in dense]
    threshold = max(min([dense[i] for i in path if i] or [dense[0]]), 1e-9)
    beside = {j for i in path if i != centre for j in kids[i] if j not in path and dense[j] >= threshold}
    return sorted({centre} | beside)


def test_content_equals_brute_force():
    several = 0
    for seed in range(500):
        page = Page(soup(seed, "p div li ul section a b i h2 td tr table".split(), 60))
        roots = brute_content(page)
        several += len(roots) > 1
        assert page.main_text() == page._render(roots, [False] * len(page.tag)), seed
    assert several > 20


def test_deep_and_wide_pages_take_linear_time():
    n = 50_000
    pages = ["<b>" * n + "</i>" * n, "<div>" * n + "x", "<div>" * n + "<article>w x</article>" * n, "<table>" + "<tr><td>x" * n, "<div><p>ab cd</p>" * n]
    start = time.monotonic()
    sizes = [len(main_text(p)) for p in pages]
    assert time.monotonic() - start < 60  # minutes each if open elements were walked for every tag
    assert sizes[0] == 0 and sizes[1] == 1 and sizes[3] == 2 * n - 1
