"""Main text of web pages by a site style tree.

Pages of one host are merged into a tree of branches (paths of tags and classes below ``body``). A page's node in a
branch has a content (a hash of all text below it) that comes again on other pages of the host, or in the same branch
of other hosts, or is its own. A branch's importance is the share of its pages whose content is their own, where hosts
with few pages lean on what the branch is over all hosts, each host alike; it is no higher than the entropy of its
contents and presentations (sequences of child tags) allows. A menu says the same on many pages, an article does not.
The limit follows from the host: halfway between full importance and that of its least important branch, and no higher
than LIMIT. On each page, the nodes go whose content comes again and whose branch is below the limit. A node's content
is that of all below it, so importance is built from the leaves upward: where a whole branch is the page's own, its
parts are still judged by themselves. What marks an article is never removed, nor its plain paragraphs and headings,
and within it a node goes only if half of the host's pages say the same there.

The tree can't know what comes but once. So tags and names (of class, id or role) that mean menus, headers, footers,
sidebars, notices, adverts, forms or comments speak where it is silent. A name counts as a whole: each of its words has
to fit, so ``share-price`` and ``related-work`` say nothing. Within articles, what may be a matter of the text (alerts,
notices, related posts) stays unless the tree removes it.

A page is parsed in time linear in its length, however deep it nests: an element's content is one hash of its
texts and of its elements' hashes, and a branch is told by its name, of bounded length.

Counts are aggregated before they are shuffled, so a host with a third of all pages is no hot key, and a page is sent
the names of its own branches only.

Defined results: a null or empty page has the text '' and a null url belongs to the host ''; malformed HTML
is closed where a browser would; repeated rows come back as often, but count once in the tree; other columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import discard, materialize, slices

#: Tags without text for readers.
SILENT = frozenset("title script style noscript template svg iframe object canvas select button textarea input datalist".split())
#: Of these, the ones that hold characters only.
RAW = frozenset("script style textarea".split())
#: Tags of navigation and forms; ``header`` and ``footer`` count as such everywhere, header within an article not.
NOISE_TAGS = frozenset("nav footer aside form menu dialog header".split())
#: Words of class and id that mark such branches.
NOISE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar widget footer masthead header cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription "
    "comment comments respond disqus reply share sharing social related recommended pagination pager search login signup toolbar skip "
    "complementary contentinfo".split()
)
#: Of these, what an article may say of its own text, and what may go with the others in one name there.
DOUBTFUL_WORDS = frozenset("alert banner header menu notice promo recommended related reply respond search skip".split())
FILLING_WORDS = frozenset("area bar block bottom box btn button buttons col column container content fixed form global header icon inner item items left link links list main outer page post posts primary right secondary section site slot sticky sub text title top unit widget wrap wrapper".split())
#: With one of these a doubtful word speaks of the page, not of an article in it.
PAGE_WORDS = frozenset("global page site".split())
#: Whole names of classes that mark an article where no tag does.
ARTICLE_NAMES = frozenset("article article-body article-content entry entry-content hentry post post-body post-content story story-body".split())
#: Roles that mark noise.
NOISE_ROLES = frozenset("banner complementary contentinfo navigation search".split())
#: Branches that hold an article whatever their entropy.
ARTICLE_TAGS = frozenset({"article", "main"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("p div section article main header footer aside nav h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr pre blockquote figure figcaption form fieldset address hr body html details summary center".split())
INLINE = frozenset("a b i u s em strong span small big sub sup code kbd q cite abbr mark time font label td th img br wbr tt var del ins".split())
#: Tags that an opening one of the same group closes, and those that it doesn't reach beyond.
CLOSES = {t: frozenset({"p"}) for t in BLOCKS} | {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"})}
SCOPE = frozenset("ul ol dl table article main section div nav aside header footer form body".split())

#: Branches without a class that are an article's prose, whatever their entropy.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption".split())
#: Longer names of branches become hashes, so that deep pages take no more room a step than flat ones.
NAME_CHARS = 200
#: A branch of this importance or more is never low, whatever its host; a host's own pages weigh against so many of others.
LIMIT, LEAN = 0.75, 2
#: Within an article, the share of the host's pages that must say the same.
COMMON = 0.5

#: Nothing is tried twice: a tag that doesn't end is given up where it can't go on, and other declarations reach to the next > or the end.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>\"']*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")


class Branch:
    """What one page has in one branch: the labels next below it, runs counting once, and the hash of its elements' contents."""

    __slots__ = ("below", "content", "last")

    def __init__(self):
        self.below, self.content, self.last = xxhash.xxh3_64(), xxhash.xxh3_64(), None

    def add(self, element: _Open) -> None:
        for label in element.below:
            if label != self.last:
                self.below.update(f"{label}\n".encode("utf-8", "replace"))
                self.last = label
        self.content.update(element.content.digest())


class _Open:
    """An open element."""

    __slots__ = ("tag", "label", "branch", "noise", "article", "low", "below", "content", "inline", "block")

    def __init__(self, tag: str, label: str, branch: str, noise: bool, article: bool, low: bool, above: _Open | None):
        self.tag, self.label, self.branch, self.noise, self.article, self.low = tag, label, branch, noise, article, low
        self.below: list[str] = []  # labels of what has text in it
        self.content = None  # hash of the texts in it, if there are any
        self.inline: dict[str, int] = {}  # open inline elements in it and outside the next block
        self.block: _Open = above.block if above and tag in INLINE else self

    def holds(self, label: str, digest: bytes) -> None:
        if self.content is None:
            self.content = xxhash.xxh3_64()
        self.content.update(digest)
        if not self.below or self.below[-1] != label:
            self.below.append(label)


def _means_noise(name: str, in_article: bool) -> bool:
    """Whether the whole of a name says noise: every word of it, within an article at least one beyond doubt."""
    words = set(_NAME.findall(name))
    sure = words & (NOISE_WORDS - FILLING_WORDS - (DOUBTFUL_WORDS if in_article and not words & PAGE_WORDS else frozenset()))
    return bool(sure or name in ("widget", "header") and not in_article or "header" in words and words & PAGE_WORDS) and words <= NOISE_WORDS | FILLING_WORDS


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[str, bool, bool]:
    """The label of an element, and whether its tag or attributes mark it as noise, and as an article."""
    label, noise, article = tag, tag in NOISE_TAGS and not (tag == "header" and in_article), tag in ARTICLE_TAGS
    if attributes and not attributes.isspace():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        given = {k: found.get(k, "").lower() for k in ("class", "id", "role")}
        names = given["class"].split() + ([given["id"]] if tag not in PROSE else [])  # an id of prose is what a link says
        marked = any(_means_noise(n, in_article or article) for n in names) or bool(NOISE_ROLES & set(given["role"].split()))
        noise = noise or marked and tag not in ("body", "html") or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        article = article or tag not in PROSE and bool(ARTICLE_NAMES & set(names))
        if found.get("class"):
            label = f"{tag}.{'.'.join(sorted(found['class'].split()))}"
    return label, noise, article


def _below(branch: str, label: str) -> str:
    name = f"{branch}/{label}" if branch else label
    return name if len(name) <= NAME_CHARS else "#" + hashlib.md5(name.encode("utf-8", "replace")).hexdigest()


def parse(page: str | None, low: frozenset[str] | None = None, common: frozenset[str] = frozenset(), marks: bool = True) -> tuple[list[str], dict[str, Branch]]:
    """The texts of the page's blocks outside noise and outside the branches ``low``, in page order, white space
    turned into single blanks; without ``low`` also what the page has in each branch. Within articles only the
    branches ``common`` are left out. Without ``marks`` tags and names mean nothing, but for articles."""
    build, low = low is None, low or frozenset()
    kept: list[str] = []
    tree: dict[str, Branch] = {}
    top = _Open("", "", "", False, False, False, None)
    stack, pieces, silent, deep, at = [top], [], "", 0, 0
    open_: dict[str, int] = {}  # open elements by tag

    def flush() -> None:
        if pieces:
            text = " ".join(htmllib.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                above = stack[-1]
                if build:
                    above.holds(above.tag, xxhash.xxh3_64_digest(text.encode("utf-8", "replace")))
                if not above.noise and not above.low:
                    kept.append(text)

    def close(k: int) -> None:
        """Ends the elements from place k of the stack on, the innermost first."""
        while len(stack) > k:
            e = stack.pop()
            open_[e.tag] -= 1
            above = stack[-1]
            if e.tag in INLINE:
                above.block.inline[e.tag] -= 1
            if e.content is not None:
                above.holds(e.label if e.tag not in INLINE else above.tag, e.content.digest())
                if e.tag not in INLINE:
                    tree.setdefault(e.branch, Branch()).add(e)

    for m in _TOKEN.finditer(page or ""):
        if m.start() > at and not silent:
            pieces.append(page[at : m.start()])
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if silent:
            if tag == silent and tag not in RAW and not closing and not m[3].endswith("/"):
                deep += 1  # such an element within itself
            elif tag == silent and closing:
                silent, deep = (silent, deep - 1) if deep else ("", 0)
            continue
        if tag in SILENT:
            if not closing and tag not in VOID and not m[3].endswith("/"):
                silent, deep = tag, 0
            continue
        if tag in ("html", "head", "body"):  # a head without its end tag ends where text begins
            flush()
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            pieces.append(" ")
        if closing:
            if tag in INLINE:  # reaches to the next block only
                if stack[-1].block.inline.get(tag):
                    k = len(stack) - 1
                    while stack[k].tag != tag:
                        k -= 1
                    close(k)
            elif open_.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
        elif tag not in VOID:
            ends = CLOSES.get(tag)
            if ends and any(open_.get(t) for t in ends):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in ends:
                        close(k)
                        break
                    if stack[k].tag in SCOPE:
                        break
            above = stack[-1]
            label, noise, article = _marks(tag, m[3], above.article)
            branch, under = above.branch, above.low
            if tag not in INLINE:
                branch = _below(branch, label)
                under = under or tag not in ARTICLE_TAGS and (branch in common and label not in PROSE if above.article else branch in low)
            else:
                above.block.inline[tag] = above.block.inline.get(tag, 0) + 1
            stack.append(_Open(tag, label, branch, marks and noise or above.noise, article or above.article, under, above))
            open_[tag] = open_.get(tag, 0) + 1
    if page and not silent and at < len(page):
        pieces.append(page[at:])
    flush()
    close(1)
    return kept, tree


def main_text(page: str | None, low: frozenset[str], common: frozenset[str] = frozenset(), marks: bool = True) -> str:
    """The blocks outside noise and outside branches of low importance, joined by an empty line."""
    return "\n\n".join(parse(page, low, common, marks)[0])


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _numbered(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Pages with their host and a number that pages alike share."""
    named = pages.withColumns({"_host": host_of(url), "_page": F.coalesce(F.col(html), F.lit(""))})
    return named.withColumn("_number", F.xxhash64("_host", "_page"))


def page_nodes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, branch, style, content and page (its number): what each distinct page has in each of its branches."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_page", 64):
            columns: tuple[list, ...] = ([], [], [], [], [])
            for host, page, number in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for branch, found in parse(page)[1].items():
                    for column, value in zip(columns, (host, branch, found.below.intdigest(), found.content.intdigest(), number), strict=True):
                        column.append(value)
            hashes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in columns[2:4]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), *hashes, pa.array(columns[4], pa.int64())], ["host", "branch", "style", "content", "page"])

    return _numbered(pages, url, html).select("_host", "_page", "_number").mapInArrow(features, "host string, branch string, style bigint, content bigint, page bigint").distinct()


def _entropy(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Entropy of counts ``n`` relative to the log of their sum, by keys; of a single page 1."""
    summed = groups.groupBy(*keys).agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    return summed.select(*keys, "pages", F.coalesce(1 - F.try_divide(F.col("nlogn"), F.col("pages") * F.log("pages")), F.lit(1.0)).alias("entropy"))


def style_tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, branch, content, n, again, pages) of each content: pages of the host with it, and whether it comes again,
    there or in another host; and (host, branch, pages, importance)."""
    counted = materialize(nodes.groupBy("host", "branch", "content").agg(F.count("*").alias("n")), "contents")
    hosts = counted.groupBy("branch", "content").agg(F.count("*").alias("hosts")).where("hosts > 1")
    again = counted.join(hosts, ["branch", "content"], "left").withColumn("again", (F.col("n") > 1) | F.col("hosts").isNotNull()).drop("hosts")
    again = materialize(again, "contents-again")
    own = again.groupBy("host", "branch").agg(F.sum("n").alias("pages"), F.sum(F.when(F.col("again"), F.col("n")).otherwise(0)).alias("_again"))
    shared = own.groupBy("branch").agg(F.avg(F.col("_again") / F.col("pages")).alias("_shared"))
    entropy = [_entropy(df, ["host", "branch"]).select("host", "branch", F.col("entropy").alias(f"_{name}")) for df, name in ((counted, "content"), (nodes.groupBy("host", "branch", "style").agg(F.count("*").alias("n")), "style"))]
    joined = own.join(shared, "branch").join(entropy[0], ["host", "branch"]).join(entropy[1], ["host", "branch"])
    unlike = 1 - (F.col("_again") + LEAN * F.col("_shared")) / (F.col("pages") + LEAN)
    tree = joined.select("host", "branch", "pages", F.least(unlike, F.greatest("_content", "_style")).alias("importance"))
    return again, materialize(tree, "style-tree")


def low_nodes(nodes: DataFrame) -> DataFrame:
    """page, low and common: of each page, its branches whose content comes again and is of low importance, and those of
    them whose content half of the host's pages have. Pages without any are left out."""
    again, tree = style_tree(nodes)
    limits = tree.groupBy("host").agg(F.least(F.lit(LIMIT), (1 + F.min("importance")) / 2).alias("_limit"))
    low = tree.join(limits, "host").where(F.col("importance") < F.col("_limit")).select("host", "branch", "pages")
    contents = again.where("again").join(low, ["host", "branch"]).select("host", "branch", "content", ((F.col("n") >= COMMON * F.col("pages")) & (F.col("n") > 1)).alias("_common"))
    contents = materialize(contents, "low-contents")
    found = nodes.join(contents, ["host", "branch", "content"])
    return found.groupBy("page").agg(F.sort_array(F.collect_set("branch")).alias("low"), F.sort_array(F.collect_set(F.when(F.col("_common"), F.col("branch")))).alias("common"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", marks: bool = True) -> DataFrame:
    """One row per input row: key, url, text. Without ``marks`` the tree alone decides."""
    nodes = materialize(page_nodes(pages, url, html), "nodes")
    low = materialize(low_nodes(nodes), "low-nodes")
    discard(nodes)
    joined = _numbered(pages, url, html).select(F.col(key).cast("bigint").alias(key), F.col(url).alias(url), "_page", "_number")
    # Nearly every page has such branches, so the table grows with the pages: it is merged at every size, never broadcast.
    joined = joined.join(low.hint("merge"), F.col("_number") == F.col("page"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_page", 64):
            texts = [main_text(p, frozenset(b or ()), frozenset(c or ()), marks) for p, b, c in zip(*(part.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], [key, url, "text"])

    return joined.select(key, url, "_page", "low", "common").mapInArrow(cut, f"`{key}` bigint, `{url}` string, text string")
