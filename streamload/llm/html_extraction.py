"""Main text of raw web pages by tree scoring (operator 11).

A page is read into a flat tree (a parent per element, in page order) and its text into blocks: runs of text between
the borders of block elements.  Then

1. menus, page headers, footers, sidebars, notices, adverts, forms and reader comments go, by element, role or the words
   of their class and id.  An element that holds an article is a frame around the page and stays, and so is, on a page
   without one, an element of three blocks or more with over half of the page's points; comments never are;
2. every remaining block passes points (one, one per comma, up to three for its length; less for text in links) to the
   containers around it: all to the nearest, half to the next, then a third, a sixth, a ninth of what it has;
3. a container's points are discounted by the share of its text in links.  The best one is kept.  If it stands in an
   ``article`` (or in a ``main`` that has no article), that element is taken whole, since its other parts are the same text;
4. siblings of the best container stay if they score a fifth of it (ten points at least), are paragraphs of prose, or are
   a heading just before it; beside an ``article`` only other articles stay;
5. inside, lists and boxes of links that hold less than half of the text go.

The blocks left are joined in page order.  White space inside a block, line breaks included, becomes one space.

Everything is one pass over a page and one scan of the table, without a shuffle: a page is the unit of work, so no key can
be hot.  The tree holds numbers and slices of the page, so memory is a few times the page.

Defined results: null or empty html, and pages without text, give the empty text.  Rows are independent of each other, so
repeated rows, null ids and ties give each row its own result.  An empty table gives none.  Other columns pass through;
the operator adds only the struct ``__llm_article``.  Unclosed elements end where HTML ends them, an unfinished tag at the
end of a page is dropped, and a ``<`` that starts no tag is text.  If nothing but class and id words took all the text
away, they are not used.
"""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

# Elements by what they mean for the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
CONTAINERS = frozenset("article center details div form main section td th body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MINOR = HEADINGS | frozenset("li dt th caption figcaption summary".split())
PROSE = frozenset("p pre blockquote".split())
LISTS = frozenset("ul ol dl table div section".split())
DROPPED = frozenset("nav footer aside button select menu dialog template svg math canvas audio video object applet "
                    "datalist fieldset legend label output progress meter".split())
FRAMES = frozenset("form header".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar "
                          "form tablist".split())
#: Elements that a start tag of the same group ends, and the ones beyond which it does not look.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
        "option": ({"option"}, {"select", "datalist"})}
SCOPE = frozenset("td th caption table button object".split())
#: Words of a class or id that mark what is not the article.
UNLIKELY = frozenset("ad ads adv adsense adslot adbox adunit banner promo promotion cookie cookies consent gdpr notice notices "
                     "alert popup modal overlay newsletter subscribe subscription signup signin login register share sharing "
                     "social related recommended recommendations sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                     "pagination pager footer header masthead toolbar widget skip copyright disclaimer".split())
UNLIKELY_STARTS = ("adsby", "advert", "googlead", "sponsor", "sidebar", "navbar", "breadcrumb", "newsletter", "cookie")
COMMENTS = frozenset("comment comments commentlist commentform commenters disqus reply replies respond responses "
                     "usercomments discussion".split())
LIKELY = frozenset("article body content entry main page post text blog story".split())
NEGATIONS = ("no", "with", "has", "is", "without")

TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)
|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=|[^\s>/=]++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?+)?+)*+)>
|</?[a-zA-Z][^>]*+\Z""", re.S | re.X)
ATTR = re.compile(r"""([^\s>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*+))?+)?+""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """The elements of a page as arrays (element 0 is the body) and its text as pieces of blocks."""

    def __init__(self, text: str):
        self.tag, self.parent, self.names, self.hidden = ["body"], [-1], [()], [False]
        self.pieces: list[tuple[int, int, str]] = []  # block, element, text
        self.block = 0
        self._read(text)

    def _open(self, tag: str, parent: int, attrs: str) -> int:
        names, hidden = (), False
        if attrs.strip(" /\n\t"):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
            names = tuple(words(f"{found.get('class', '')} {found.get('id', '')}"))
            hidden = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                      or found.get("role", "").lower() in DROPPED_ROLES or bool(HIDDEN.search(found.get("style", ""))))
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.hidden.append(hidden)
        return len(self.tag) - 1

    def _read(self, text: str) -> None:
        stack, open_tags = [0], {}

        def close(depth: int) -> None:
            while len(stack) > depth:
                tag = self.tag[stack.pop()]
                open_tags[tag] -= 1
                self.block += tag not in INLINE

        def end(tags, limits) -> None:
            if any(open_tags.get(t) for t in tags):
                for k in range(len(stack) - 1, 0, -1):
                    tag = self.tag[stack[k]]
                    if tag in tags:
                        return close(k)
                    if tag in limits:
                        return None

        at, size = 0, len(text)
        while at < size:
            m = TAG.search(text, at)
            piece = text[at:m.start()] if m else text[at:]
            if piece:
                self.pieces.append((self.block, stack[-1], _html.unescape(piece) if "&" in piece else piece))
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in ("html", "head", "body"):
                self.block += 1
            elif m[1]:
                if open_tags.get(tag):
                    end((tag,), () if tag not in INLINE else _Blocks)
                elif tag == "p":
                    self.block += 1
            elif tag == "br":
                self.pieces.append((self.block, stack[-1], " "))
            elif tag in VOID:
                self.block += tag == "hr"
            elif tag in RAW and (done := RAW_END[tag].search(text, at)) is not None:
                at = done.end()
            elif tag in ("script", "style"):
                break
            else:
                if tag not in INLINE:
                    end(("p",), SCOPE)
                    self.block += 1
                if tag in ENDS:
                    end(*ENDS[tag])
                stack.append(self._open(tag, stack[-1], m[3]))
                open_tags[tag] = open_tags.get(tag, 0) + 1


class _NotInline:
    """Every element name that is not inline: an inline end tag does not end what lies outside its block."""

    def __contains__(self, tag: str) -> bool:
        return tag not in INLINE


_Blocks = _NotInline()


def words(names: str) -> list[str]:
    """The words of class and id values; a name like ``no-sidebar`` says nothing."""
    out = []
    for name in names.split():
        parts = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]
        if parts and parts[0] not in NEGATIONS:
            out += parts
    return out


def is_comment(names) -> bool:
    return any(w in COMMENTS for w in names)


def is_unlikely(names) -> bool:
    return any(w in UNLIKELY or w.startswith(UNLIKELY_STARTS) for w in names)


def points(tag: str, text: str, linked: int) -> float:
    """What a block is worth: commas and length, less for headings and list items, less for text in links."""
    n = len(text)
    share = min(1.0, n / 25) * (0.25 if tag in MINOR else 1.0) * (1 - min(1.0, linked / n))
    return share * (1 + text.count(",") + min(3.0, n / 100))


def main_text(page: str | None, by_class: bool = True) -> str:
    """The blocks of the best container and its kept siblings, one per line."""
    if not page:
        return ""
    p = Page(page)
    n = len(p.tag)
    owner, link = [0] * n, [False] * n  # the nearest element that is not inline; whether the text is a link's
    article, main = [False] * n, [False] * n
    for e in range(1, n):
        up = p.parent[e]
        inline = p.tag[e] in INLINE
        owner[e] = owner[up] if inline else e
        link[e] = p.tag[e] == "a" or (link[up] and inline)
    for e in range(n - 1, 0, -1):
        up = p.parent[e]
        article[up] |= article[e] or (p.tag[e] == "article" and not is_comment(p.names[e]))
        main[up] |= main[e] or p.tag[e] == "main"

    def blocks(kept):
        """(element, text, characters in links) of the blocks that kept elements have."""
        got, last = [], None
        for block, e, piece in p.pieces:
            if kept[e]:
                if block != last:
                    got.append((owner[e], [], []))
                    last = block
                got[-1][1].append(piece)
                if link[e]:
                    got[-1][2].append(piece)
        for e, pieces, links in got:
            if text := " ".join("".join(pieces).split()):
                yield e, text, min(len(text), len(" ".join("".join(links).split())))

    shown = [True] * n
    for e in range(1, n):
        shown[e] = shown[p.parent[e]] and not p.hidden[e] and p.tag[e] not in DROPPED
    total, count = [0.0] * n, [0] * n
    for e, text, linked in blocks(shown):
        total[e] += points(p.tag[e], text, linked)
        count[e] += 1
    for e in range(n - 1, 0, -1):
        total[p.parent[e]] += total[e]
        count[p.parent[e]] += count[e]
    bare = not (article[0] or main[0])

    kept, inside = [True] * n, [False] * n  # inside: in an article or main
    for e in range(1, n):
        up, tag, names = p.parent[e], p.tag[e], p.names[e]
        inside[e] = inside[up] or tag in ("article", "main")
        frame = article[e] or main[e] or (bare and count[e] > 2 and total[e] > total[0] / 2)
        gone = not shown[e] or (tag in FRAMES and not frame and not (tag == "header" and inside[e]))
        if by_class and not gone and names:
            gone = is_comment(names) or (is_unlikely(names) and not frame and tag not in ("article", "main"))
        kept[e] = kept[up] and not gone

    got = list(blocks(kept))
    if not got:
        return main_text(page, False) if by_class else ""
    score, length, linked_length, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for e, text, linked in got:
        worth = points(p.tag[e], text, linked)
        length[e] += len(text)
        linked_length[e] += linked
        up, level = e, 0
        while up >= 0 and level < 5:
            if p.tag[up] in CONTAINERS:
                score[up] += worth / (1 if level == 0 else 2 if level == 1 else 3 * (level - 1))
                level += 1
            up = p.parent[up]
    for e in range(n - 1, 0, -1):
        up = p.parent[e]
        links[e] += p.tag[e] == "a" and kept[e]
        length[up] += length[e]
        linked_length[up] += linked_length[e]
        links[up] += links[e]
    for e in range(n):
        if length[e]:
            likely = p.tag[e] in ("article", "main") or any(w in LIKELY for w in p.names[e])
            score[e] *= (1 - linked_length[e] / length[e]) * (1.5 if likely else 1.0)

    best = max(range(n), key=lambda e: (score[e], -e))
    semantic, up = 0, best
    while up > 0 and not semantic:
        if p.tag[up] == "article" or (p.tag[up] == "main" and not article[up]):
            semantic = up
        up = p.parent[up]
    best = semantic or best

    chosen = [False] * n
    chosen[best] = True
    siblings = [e for e in range(1, n) if p.parent[e] == p.parent[best] and kept[e]] if best else []
    for e in siblings:
        tag = p.tag[e]
        if p.tag[best] == "article":
            chosen[e] |= tag == "article" and score[e] >= 0.2 * score[best]
        elif tag in CONTAINERS:
            chosen[e] |= score[e] >= max(10.0, 0.2 * score[best])
        elif tag in PROSE and length[e]:
            chosen[e] |= linked_length[e] < 0.25 * length[e] and (length[e] > 80 or not linked_length[e])
    for e, after in zip(siblings[::-1], [None, *siblings[::-1]]):
        if after is not None and p.tag[e] in HEADINGS and chosen[after] and not linked_length[e]:
            chosen[e] = True
    for e in range(1, n):
        up = p.parent[e]
        if not chosen[e] and chosen[up]:
            box = p.tag[e] in LISTS and links[e] >= 3 and linked_length[e] > 0.6 * length[e] and length[e] < length[best] / 2
            chosen[e] = not box
        chosen[e] = chosen[e] and kept[e]
    return "\n".join(text for _, text, _ in blocks(chosen))


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def article_text(html: Column) -> Column:
    """The main text of an html column, as a column."""
    return _main_text(F.coalesce(html, F.lit("")))


def extract_articles(pages: DataFrame) -> DataFrame:
    """``pages`` with an added struct ``__llm_article``: text and n_chars (its code points)."""
    out = pages.withColumn("__llm_article", article_text(F.col("html")))
    return out.withColumn("__llm_article", F.struct(F.col("__llm_article").alias("text"),
                                                    F.length("__llm_article").cast("long").alias("n_chars")))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_articles(pages).select("page_id", "url", "__llm_article.text", "__llm_article.n_chars")


#: What the method gives for pages whose article is one ``article`` of headings and paragraphs, as in the given tables.
OP11_SQL = r"""
WITH b AS (SELECT page_id, url, list_filter(list_transform(
    string_split_regex(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '<br>', ' ', 'g'), '</?(p|h1)>'),
    lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM pages)
SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text, length(coalesce(array_to_string(blocks, chr(10)), '')) AS n_chars FROM b
"""
