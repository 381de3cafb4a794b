"""Main-text extraction by composite text density.

A small tolerant parser builds the tree of a page's block elements. Parts that
are surely named as something else than the article (menus, headers, footers,
side bars, adverts, forms, scripts, reader comments) are cut, and so are threads
of readers and boxes that ask for consent, unless a form
or a part with such a class, id or role turns out to hold the article; a doubtful
name (share, search, widget) decides within the article only where a part has
less text for each tag than half the article's. Every node left has a density: characters per tag, adjusted by how much of the text is
links, here and in the whole body. The node whose children's densities have the
largest sum lies in the article, which is the article or main element around
it if there is one. The smallest density on the way from it to the body is the
threshold under which a part of the article that is mostly links is left out,
and from which a part of the body beside it counts as well. Lists of links that
belong to the article stay. So do level-one
headings, parts with half the text for each tag, and what stands between two
parts that count.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import arrow_map, free_name, quoted, spread, table

_TAG = re.compile(r"""<(?:!--(?:(?:(?!-->).)*+)(?:-->|$)|!\[CDATA\[(?P<cdata>(?:(?!\]\]>).)*+)(?:\]\]>|$)|[!?][^>]*+>|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*?)>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of HTML by how they are treated here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CUT = frozenset("head script style noscript template textarea title iframe object embed canvas svg math audio video nav footer aside button select input dialog menu noembed noframes xmp option".split())
#: Blocks that a paragraph can't hold: their start ends an open one.
CLOSES_P = frozenset("address article aside blockquote body center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
#: A start tag that ends an open element of the same family.
FAMILY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that the search for an open one doesn't leave.
SCOPE = frozenset("table ul ol dl select html body article section div main td th".split())
#: Elements that hold a piece of running text; what they stand in holds the article.
PIECES = frozenset("blockquote dd details dl dt figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody tfoot thead tr ul".split())
#: Elements that may be one link within running text.
LINES = frozenset("p li dd dt td th blockquote figcaption caption h1 h2 h3 h4 h5 h6".split())
#: Words that say, alone or with words of the lists below, that a part isn't the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense sponsored breadcrumb breadcrumbs comment comments commentlist disqus consent gdpr footer masthead nav navbar navigation sidebar aside newsletter notice notices popup modal related recommended recommendations".split()
)
#: Words that may also name a subject; a part so named stays if it reads like the article.
DOUBTFUL = frozenset("banner cc cookie cookies window header menu menubar alert overlay promo promotion share sharing social sponsor sponsors search subscribe subscription paywall toolbar widget widgets login signup register respond tags pagination pager dialog".split())
#: Words that only say what kind of box it is, or where.
BOXES = frozenset("area block box container holder wrap wrapper inner outer item items list section slot unit bar module region panel form button buttons icons left right top bottom site page global main primary secondary user users reader readers google mobile desktop sticky fixed side".split())
#: What the first are often named with, and what of these makes them sure.
TEASERS, TEASED = frozenset("posts articles stories content links news".split()), frozenset("related recommended recommendations sponsored popular latest".split())
#: Values of role that are surely not the article.
ROLES = frozenset("banner navigation contentinfo complementary search dialog alert alertdialog status menu menubar toolbar".split())
#: Names that an article element may have too.
READERS = frozenset(("comment", "comments"))
#: Words of names that say that readers speak in a part: surely, or if it holds several parts of one class.
SPEAKERS, THREADS = frozenset("comment comments commentlist disqus".split()), frozenset("discussion discussions replies responses reactions feedback reviews thread threads forum".split())
#: What a short part beside the article speaks of, with a button in it, when it asks for consent; and how long it is at most.
CONSENT, SHORT = re.compile(r"\b(?:cookies?|consent|gdpr)\b", re.I), 800
#: A heading over links to other articles, and one over those that belong to this.
ELSEWHERE = re.compile(r"\b(?:related|recommended|popular|trending|latest|more (?:from|on|in|stories|articles|news)|read (?:more|next|also)|see also|you may)\b", re.I)
SOURCES = re.compile(r"\b(?:sources?|references?|notes|footnotes|bibliography|further reading|links|quellen|literatur|fuentes|sources)\b", re.I)
#: What stands after these in a name isn't what the part is.
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NOT_OTHER = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|without|no)[_-]\S*", re.I)
#: Share of the page's text outside links with which a part isn't something else, where no article, main or h1 with text stands outside such parts, or where it stands in one itself and holds so many times its other text.
MOST, TIMES = 0.75, 10


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "chars", "link_chars", "tags", "links", "density", "total", "kept", "other", "doubtful", "plain", "speakers", "buttons", "name")

    def __init__(self, tag: str, parent: Node | None, cut: bool) -> None:
        self.tag, self.parent, self.cut = tag, parent, cut
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.links = 0
        self.density = self.total = 0.0
        self.other = self.doubtful = False  # whether it is named as something else than the article, and by doubtful words only
        self.plain = 0
        self.speakers = False  # whether it is named as what readers say
        self.buttons = 0
        self.name = ""
        self.kept = 0  # 1 if parts of it count, 2 if all of it does


def preorder(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.children) if isinstance(x, Node) and not x.cut]
    return out


def _attributes(rest: str) -> list[tuple[str, str]]:
    return [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)]


def _is_cut(tag: str, attributes: list[tuple[str, str]], inside: bool) -> bool:
    """Whether a start tag begins what is never shown or never the article; inside: within article or main."""
    if tag in CUT or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return _is_hidden(attributes)


def _is_hidden(attributes: list[tuple[str, str]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value) is not None for name, value in attributes)


def _named(value: str) -> int:
    """How surely a class, id or role names something else than the article: 2 surely, 1 doubtful, 0 not.

    One of its names has to consist of such words and of boxes throughout, so
    market-share and related-work are no such names.
    """
    found = 0
    for name in _NOT_OTHER.sub("", value).split():
        said = _words_in(name)
        teased = any(x in TEASED for x in said)
        words = [x for x in said if x not in BOXES and not (teased and x in TEASERS)]
        if "".join(said) in NAMES or words and all(x in NAMES or x in DOUBTFUL for x in words) and any(x in NAMES for x in words):
            return 2
        # two doubtful words (cookie-banner), or one with a box of the site (site-header), are sure
        if words and all(x in DOUBTFUL for x in words):
            found = max(found, 2 if len(words) > 1 or "site" in said or "page" in said else 1)
    return found


def _is_other(tag: str, attributes: list[tuple[str, str]]) -> int:
    """How surely a start tag names something else than the article, as in _named."""
    if tag == "form":
        return 2
    if tag in ("html", "body"):
        return 0
    values = [value for name, value in attributes if name in ("class", "id")]
    if tag in ("article", "main"):
        return 2 * any(x in READERS for value in values for x in re.split(r"[\s_-]+", value.lower()))
    if any(name == "role" and value.strip().lower() in ROLES for name, value in attributes):
        return 2
    return max(map(_named, values), default=0)


def _words_in(name: str) -> list[str]:
    return [x.lower() for x in _WORD.findall(name) if len(x) > 1]


def _is_thread(node: Node) -> bool:
    """Whether a part is named like a discussion and holds several blocks of one element and class: what readers say."""
    if not any(x in THREADS for name in node.name.split() for x in _words_in(name)) or node.tag in ("html", "body", "article", "main"):
        return False
    alike = Counter((x.tag, x.name) for x in preorder(node)[1:] if x.tag in ("li", "article") or x.name)
    return bool(alike) and max(alike.values()) > 1


def _asks_for_consent(node: Node) -> bool:
    """Whether a part is a short text about cookies or consent with a button."""
    held = preorder(node)
    return 0 < sum(x.chars for x in held) <= SHORT and CONSENT.search(" ".join(x for y in held for x in y.children if isinstance(x, str))) is not None


def _further_others(root: Node) -> list[Node]:
    """Parts that are something else than the article by what they hold: threads, and boxes with a button that ask for consent, none of them within an article or main element."""
    found, inside = [], {None: False}
    for node in preorder(root):
        inside[node] = inside[node.parent] or node.tag in ("article", "main")
        if inside[node] or node.other or node.tag in ("html", "body", "#root"):
            continue
        if _is_thread(node):
            node.speakers = True
            found.append(node)
        elif node.buttons and _asks_for_consent(node):
            found.append(node)
    for node in found:
        node.other, node.doubtful = True, False
    return found


def _cut_others(root: Node, others: list[Node]) -> None:
    """Cut the parts surely named as something else, but for those that hold the article.

    Parts named by doubtful words stay doubtful if they don't hold it.

    That is the longest article or main element, if there is no longer one
    outside such parts and no more text right in what is around it; the first
    h1 if none stands outside; or else, where no article, main or h1 with text
    stands outside, most of the text. A part within an article or main element
    that has nearly all text of the page is its body, whatever its name. What
    readers say holds the article only where nothing else does.
    """
    nodes = preorder(root)
    under: dict[Node | None, Node | None] = {None: None}  # the innermost of others around a node
    spoken = {None: False}  # whether it is what readers say
    elements = {None: False}  # whether it is in an article or main element
    beside: Counter[Node | None] = Counter()  # text right in one of others, or in none, but in no such element
    for node in nodes:
        under[node] = node if node.other else under[node.parent]
        spoken[node] = node.speakers or spoken[node.parent]
        elements[node] = elements[node.parent] or node.tag in ("article", "main")
        node.plain = node.chars - node.link_chars
        if not elements[node]:
            beside[under[node]] += node.plain
    free: dict[Node, int] = {}  # text that doesn't stand in others
    for node in reversed(nodes):
        free[node] = (0 if under[node] else node.plain) + sum(free[x] for x in node.children if isinstance(x, Node) and not x.cut)
        node.plain += sum(x.plain for x in node.children if isinstance(x, Node) and not x.cut)
    marked = [x for x in nodes if x.tag in ("article", "main")]
    outside = max((free[x] for x in marked if not under[x]), default=0)
    holds = []
    inner = max((x for x in marked if under[x] and not spoken[x]), key=lambda x: x.plain, default=None)
    if inner is not None and inner.plain > outside:
        up, most = under[inner], beside[None]
        while up is not None:
            most, up = max(most, beside[up]), under[up.parent]
        if inner.plain > most:
            holds.append(inner)
    titles = [x for x in nodes if x.tag == "h1" and x.plain]
    told = [x for x in titles if not spoken[x]]
    if told and all(under[x] for x in titles):
        holds.append(told[0])
    shown = outside > 0 or any(not under[x] for x in titles)
    held = {x for x in others if x.plain >= max(1, MOST * root.plain) and (not holds and not shown or elements[x] and not spoken[x] and x.plain >= TIMES * outside)}
    for up in holds:
        while up is not None:
            held.add(up)
            up = up.parent
    for node in others:
        if node in held:
            node.doubtful = False
        elif not node.doubtful:
            node.cut = True


def parse(html: str) -> tuple[Node, int, int]:
    """The tree of blocks; characters and link characters of the whole body, cut parts included."""
    root = Node("#root", None, False)
    others: list[Node] = []
    node, line, link, link_line = root, [], 0, 0
    open_tags: list[tuple[str, Node | None]] = []  # inline elements have no node
    # where elements of a name stand in open_tags, those that an inline end tag doesn't end, and those that a start tag looks at: no tag has to go through all that are open
    places: defaultdict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []
    scopes: list[int] = []
    inside = body_chars = body_links = 0
    hidden: list[int] = []  # where inline elements that aren't shown stand in open_tags
    at, size, last = 0, len(html), html.rfind(">")

    def opened(tag: str, own: Node | None) -> None:
        k = len(open_tags)
        open_tags.append((tag, own))
        places[tag].append(k)
        if own is not None and tag != "p":
            blocks.append(k)
        if tag == "p" or tag in SCOPE or tag in FAMILY:
            scopes.append(k)

    def flush() -> None:
        nonlocal link_line
        if line:
            text = " ".join("".join(line).split())
            if text:
                node.children.append(text)
                node.chars += len(text)
                node.link_chars += min(link_line, len(text))
            line.clear()
        link_line = 0

    def close(upto: int) -> None:
        """End all open elements from number upto."""
        nonlocal node, link, inside
        while len(open_tags) > upto:
            tag, own = open_tags.pop()
            places[tag].pop()
            for held in (blocks, scopes):
                if held and held[-1] == len(open_tags):
                    held.pop()
            if own is None:
                link -= tag == "a"
                if hidden and hidden[-1] == len(open_tags):
                    hidden.pop()
            else:
                flush()
                inside -= tag in ("article", "main")
                node = own.parent

    def text(part: str) -> None:
        nonlocal body_chars, body_links, link_line
        if "&" in part:
            part = unescape(part)
        n = len(" ".join(part.split()))
        body_chars += n
        body_links += n if link else 0
        if not node.cut and not hidden:
            line.append(part)
            link_line += n if link else 0

    while at < size:
        m = _TAG.search(html, at) if at <= last else None
        if m is None:  # an open comment or character data reach to the end
            rest, _, data = html[at:].partition("<!--")[0].partition("<![CDATA[")
            text(rest)
            if data:
                text(data)
            break
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        if m["cdata"]:
            text(m["cdata"])
        if not m["name"]:
            continue
        tag = m["name"].lower()
        if m["close"]:
            if tag == "br" and not node.cut:
                line.append(" ")
            if tag == "p" and not places["p"]:
                flush()
            if places[tag] and not (tag in INLINE and blocks and blocks[-1] > places[tag][-1]):  # an inline end tag doesn't end blocks
                close(places[tag][-1])
            continue
        if tag in CLOSES_P or tag in FAMILY:
            wanted = FAMILY.get(tag, ())
            for k in reversed(scopes):
                name = open_tags[k][0]
                if name == "p" and tag in CLOSES_P or name in wanted:
                    close(k)
                    if not (tag == "tr" and name in ("td", "th")):
                        break
                elif name in SCOPE:
                    break
        if tag in INLINE or tag in VOID:
            if tag not in ("br", "wbr") and tag not in INLINE:
                flush()
            if tag == "br" and not node.cut:
                line.append(" ")
            node.tags += 1
            if tag == "a":
                node.links += 1
            node.buttons += tag == "input"
            if tag not in VOID:
                if ("hidden" in m["rest"] or "none" in m["rest"]) and _is_hidden(_attributes(m["rest"])):
                    hidden.append(len(open_tags))
                opened(tag, None)
                link += tag == "a"
            continue
        flush()
        node.buttons += tag == "button"
        inside += tag in ("article", "main")
        if tag in ("html", "body") and places[tag]:
            continue
        attributes = _attributes(m["rest"])
        child = Node(tag, node, node.cut or bool(hidden) or _is_cut(tag, attributes, bool(inside)))
        child.name = " ".join(value for name, value in attributes if name in ("class", "id"))
        child.speakers = any(x in SPEAKERS for name in child.name.split() for x in _words_in(name))
        if not child.cut and (surely := _is_other(tag, attributes)):
            child.other, child.doubtful = True, surely == 1
            others.append(child)
        node.children.append(child)
        if m["rest"].endswith("/") and tag not in RAW and tag not in CLOSES_P:
            continue
        opened(tag, child)
        node = child
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            close(len(open_tags) - 1)
    close(0)
    flush()
    others += _further_others(root)
    if others:
        _cut_others(root, others)
    return root, body_chars, body_links


def composite_density(chars: int, link_chars: int, tags: int, links: int, body_chars: int, body_links: int) -> float:
    """Characters per tag, scaled by a logarithm of the text's and the tags' freedom from links; counts of 0 become 1 where they divide."""
    if not chars:
        return 0.0
    plain = max(1, chars - link_chars)
    base = log(chars / plain * link_chars + body_links / max(1, body_chars) * chars + e)
    freedom = chars / max(1, link_chars) * max(1, tags) / max(1, links)
    return chars / max(1, tags) * max(0.0, log(freedom)) / log(max(base, 1.001))


def _mostly_links(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _plain_rate(node: Node) -> float:
    """Characters outside links per tag."""
    return (node.chars - node.link_chars) / max(1, node.tags)


def _free(node: Node) -> bool:
    """Whether the text right in the node isn't mostly links."""
    parts = [x for x in node.children if isinstance(x, Node) and not x.cut]
    return 2 * (node.link_chars - sum(x.link_chars for x in parts)) <= node.chars - sum(x.chars for x in parts)


def measure(nodes: list[Node], body_chars: int, body_links: int) -> None:
    """Counts, densities and sums of the children's densities of nodes in preorder."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, Node) and not child.cut:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.tags += child.tags + 1
                node.links += child.links
        node.density = composite_density(node.chars, node.link_chars, node.tags, node.links, body_chars, body_links)
        node.total = sum(x.density for x in node.children if isinstance(x, Node) and not x.cut)
        # text that stands in the node itself counts like a child without tags
        own = sum(len(x) for x in node.children if isinstance(x, str))
        if own and node.total:
            node.total += composite_density(own, 0, 1, 0, body_chars, body_links)


def _text_in(node: Node) -> str:
    return " ".join(x for y in preorder(node) for x in y.children if isinstance(x, str))


def _lists_of_the_article(article: Node) -> set[Node]:
    """Lists of links that belong to the article: in an article or main element those after its first text, elsewhere those over which SOURCES stands.

    Lists under a heading that leads ELSEWHERE don't.
    """
    out: set[Node] = set()
    marked, heading, begun = article.tag in ("article", "main"), "", False
    for node in preorder(article)[1:]:
        if re.fullmatch(r"h[1-6]", node.tag):
            heading, begun = _text_in(node), True
        elif node.tag == "p" and not _mostly_links(node) and node.chars:
            begun = True
            heading = heading if node.chars < 40 else ""
        elif node.tag in ("ul", "ol", "dl") and _mostly_links(node) and begun and not node.doubtful:
            if not ELSEWHERE.search(heading) and (marked or SOURCES.search(heading)):
                out.add(node)
    return out


def main_text(html: str) -> str:
    """The article's blocks in page order, joined by blank lines."""
    root, body_chars, body_links = parse(html)
    nodes = preorder(root)
    measure(nodes, body_chars, body_links)
    filled = [x for x in nodes if x.chars]
    if not filled:
        return ""
    best = max(filled, key=lambda x: x.total)
    if not best.total:
        best = max(filled, key=lambda x: x.density)
    threshold, rate, up = best.density, _plain_rate(best), best.parent
    while up is not None and up.tag not in ("html", "#root"):
        threshold, rate = min(threshold, up.density), min(rate, _plain_rate(up))
        up = up.parent
    article = best
    while article.tag in PIECES and article.parent is not None:
        article = article.parent
    around, up = set(), article
    while up is not None:
        if up.tag in ("article", "main"):
            article = up
        up = up.parent
    up = article.parent
    while up is not None:
        around.add(up)
        up = up.parent

    within = set(preorder(article))
    for node in nodes:  # within the article doubtful names decide only where the text doesn't
        if node.doubtful and node is not article and node not in around and (node not in within or _mostly_links(node) or 2 * _plain_rate(node) < _plain_rate(article)):
            node.cut = True

    def counts(part: Node | str, free: bool) -> bool:
        """Whether a part counts by itself; free: the lines beside it aren't mostly links."""
        if isinstance(part, str):
            return free and 2 * len(part) >= rate
        return not part.cut and part.kept > 0

    for node in reversed(nodes):
        if node is article:
            node.kept = 2
        elif node.chars and node not in around and (node.density >= threshold > 0 or not _mostly_links(node) and (node.tag == "h1" or 2 * _plain_rate(node) >= rate)):
            node.kept = 2
        elif node.chars:
            free = _free(node)
            node.kept = int(any(counts(x, free) for x in node.children))
    told = _lists_of_the_article(article)
    blocks: list[str] = []
    todo: list[Node | str] = [root]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            blocks.append(item)
        elif item.kept == 2:
            for x in reversed(item.children):
                if isinstance(x, str):
                    todo.append(x)
                elif not x.cut and (x in told or item in told or x.density >= threshold or not _mostly_links(x) or x.tag in LINES and not _mostly_links(item)):
                    x.kept = 2
                    if item in told:
                        told.add(x)
                    todo.append(x)
        elif item.kept:
            free = _free(item)
            at = [k for k, x in enumerate(item.children) if counts(x, free)]
            for x in reversed(item.children[at[0] : at[-1] + 1]):
                if isinstance(x, str):
                    if free:
                        todo.append(x)
                elif not x.cut:
                    if not x.kept and not _mostly_links(x):
                        x.kept = 2
                    todo.append(x)
    return "\n\n".join(blocks)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars (code points).

    Defined results: null and empty pages, and pages without an article, have
    text '' and n_chars 0; unclosed and misnested tags are closed as browsers
    do for blocks; repeated rows have equal results; an empty table gives no
    rows; whole pages are read, however long; ``keep`` names the columns that go
    through, text and n_chars not among them, and further ones are ignored.
    """
    inner = free_name(pages, "_html")
    schema = StructType([*(pages.schema[x] for x in keep), StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) if x else "" for x in batch.column(inner).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*keep, "text", "n_chars"])

    return arrow_map(pages.select(*map(quoted, keep), F.col(html).alias(inner)), run, schema)


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(spread(table(spark, sf_dir, "pages")))
