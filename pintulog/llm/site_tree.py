"""Main text of web pages by site style trees.

The pages of a host are merged into one tree. A node stands for an element's place: the
chain of block elements, with their classes, that leads to it. On each node pages show a
presentation, the sequence of the element's block children, and content, the text blocks
below it. A node's importance is the entropy of its presentations together with one less
the mean entropy of its content features over the pages: a menu that many pages share has
little, an article whose text no other page has all. Branches of low importance are
removed from each page.

Hosts of few pages say little, so the importance on a host is smoothed towards that of the
same node over all hosts. An article or main element counts as ``PRIOR_PAGES`` pages of full
importance for what is in it, of none for the rest of the page, and what is in it is as
important as on the host or over all hosts, whichever is more. All else is up to the entropy.
A page of which nothing would be left, such as one of many equal pages, keeps its most
important branches.

What markup declares to be hidden, navigation, a footer or a control is no text of the page.
A class or id that speaks of a sidebar, comments and the like is a sign only: such a branch
is a tree of its own, and it goes if the page has other text in the same place. If an article
or main element has no other text, or a page without them, its named branches stay by their
own entropy. So does a form in an article; elsewhere forms go.

Pages are parsed twice: once for the tree, which holds 64-bit node ids and text hashes only,
and once to cut the text, after the importance of each place has come back. Elements deeper
than ``DEEPEST`` blocks stand on the node at that depth. Tags are read in time linear in the
page; a tag whose quotes are still open after ``TAG_SIZE`` characters ends at its next ``>``.
"""

import html
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintulog.llm.batches import bounded_batches, slices
from pintulog.llm.components import lookup
from pintulog.llm.language import host_of
from pintulog.shared import drop_settled, free_shuffles, settle

CONTENT_SHARE = 0.9
HOST_PAGES = 10.0
PRIOR_PAGES = 5.0
LEAST = 0.4
DEEPEST = 128
TAG_SIZE = 65_536

# Element kinds of HTML, and words by which sites name what is no article.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp", "noembed", "noframes", "template"}
BLOCK = set(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr caption ul".split()
)
CLOSES_ITS_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"},
    "tfoot": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"},
}
HOLDS_OPEN = {"ul": {"li"}, "ol": {"li"}, "menu": {"li"}, "dl": {"dt", "dd"}, "table": {"tr", "td", "th", "tbody", "thead", "tfoot"}, "select": {"option", "optgroup"}}
NOISE_TAGS = {"head", "nav", "footer", "aside", "button", "select", "menu", "dialog", "search", "svg", "canvas", "object", "audio", "video", "datalist", "fieldset"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "tablist"}
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners nav navbar "
    "navigation menu menus topbar breadcrumb breadcrumbs sidebar sidebars widget widgets footer foot masthead comment comments commentlist "
    "disqus replies respond cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations toolbar pagination pager skip".split()
)
LANDMARKS = {"article", "main"}

HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WITHOUT = {"no", "non", "without", "has", "with"}

TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


class Open:
    """An open element: its tag, whether it is a block, its nodes from the top, and what it inherits."""

    __slots__ = ("tag", "block", "chain", "gone", "named", "landmark")

    def __init__(self, tag: str, block: bool, chain: tuple[int, ...], gone: bool, named: bool, landmark: bool):
        self.tag, self.block, self.chain, self.gone, self.named, self.landmark = tag, block, chain, gone, named, landmark


class Block(NamedTuple):
    """A text block: the nodes it is below, whether it is in a named branch, in an article, and its text."""

    chain: tuple[int, ...]
    named: bool
    landmark: bool
    text: str


def is_gone(tag: str, attributes: dict[str, str], in_landmark: bool) -> bool:
    """Whether markup itself declares that the element is not shown or no article."""
    if tag in NOISE_TAGS or tag in RAW or tag in ("header", "form") and not in_landmark:
        return True
    role = attributes.get("role", "").lower()
    return (
        "hidden" in attributes or attributes.get("aria-hidden") == "true" or role in NOISE_ROLES or role == "form" and not in_landmark
        or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    )


def is_named(tag: str, attributes: dict[str, str], in_landmark: bool) -> bool:
    """Whether a class or id speaks of boilerplate. A heading's id is an anchor, "no-sidebar" says that there is none."""
    if tag == "form":
        return True
    if not attributes or tag in LANDMARKS or tag in ("html", "body"):
        return False
    names = attributes.get("class", "").split()
    if tag not in HEADINGS:
        names += attributes.get("id", "").split()
    for name in names:
        words = [x.lower() for x in NAME_PART.findall(name)]
        said = {word for before, word in zip(["", *words], words) if before not in WITHOUT}
        if in_landmark:
            said -= {"widget", "widgets"}
        if said & NOISE_WORDS or "header" in said and not in_landmark:
            return True
    return False


def node_id(above: int, name: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{above}/{name}") - (1 << 63)


def page_blocks(source: str) -> list[Block]:
    """The text blocks in page order without those that are gone; white space made one space."""
    stack = [Open("", True, (), False, False, False)]
    opened: Counter = Counter()
    blocks: list[Block] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            inner = stack[-1]
            if not inner.gone:
                text = SPACE.sub(" ", html.unescape("".join(pending))).strip()
                if text:
                    blocks.append(Block(inner.chain, inner.named, inner.landmark, text))
            pending.clear()

    def close(count: int) -> None:
        """Leave the elements from the ``count``-th on."""
        if any(x.block for x in stack[count:]) or (stack[-1].gone, stack[-1].named) != (stack[count - 1].gone, stack[count - 1].named):
            flush()
        opened.subtract(x.tag for x in stack[count:])
        del stack[count:]

    def end_tag(tag: str) -> None:
        if opened[tag] > 0:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    return close(i)
                if stack[i].block and tag not in BLOCK:
                    return None
        return None

    def start_tag(tag: str, rest: str) -> None:
        block = tag in BLOCK
        if block:
            closes = CLOSES_ITS_KIND.get(tag, set())
            left = opened["p"] + sum(opened[x] for x in closes)
            for i in range(len(stack) - 1, 0, -1):
                if not left:
                    break
                if stack[i].tag == "p" or stack[i].tag in closes:
                    close(i)
                    left = opened["p"] + sum(opened[x] for x in closes)
                elif stack[i].block and (not closes or closes <= HOLDS_OPEN.get(stack[i].tag, set()) or stack[i].tag in HOLDS_OPEN):
                    break
            flush()
        above = stack[-1]
        attributes: dict[str, str] = {}
        if rest and rest.strip(" /"):
            for key, a, b, c in ATTRIBUTE.findall(rest):
                attributes.setdefault(key.lower(), html.unescape(a or b or c))
        gone = above.gone or is_gone(tag, attributes, above.landmark)
        named = above.named or is_named(tag, attributes, above.landmark)
        if (gone, named) != (above.gone, above.named):
            flush()
        landmark = above.landmark or tag in LANDMARKS or attributes.get("role", "").lower() in LANDMARKS
        chain = above.chain
        if block and len(chain) < DEEPEST:
            style = ".".join(sorted({x.lower() for x in NAME_PART.findall(attributes.get("class", ""))}))
            chain = (*chain, node_id(chain[-1] if chain else 0, f"{tag}.{style}"))
        stack.append(Open(tag, block, chain, gone, named, landmark))
        opened[tag] += 1

    at, size, last = 0, len(source), source.rfind(">")
    while at < size:
        begin = source.find("<", at)
        if begin < 0:
            begin = size
        pending.append(source[at:begin])
        at = begin
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        if at >= last:  # no tag ends any more
            following = source.find("<!--", at)
            pending.append(source[at : following if following >= 0 else size])
            at = following if following >= 0 else size
            continue
        after = source[at + 1]
        if after in "!?":
            at = source.find(">", at) + 1
            continue
        name = TAG_NAME.match(source, at + 1 + (after == "/"))
        if not name:
            pending.append("<")
            at += 1
            continue
        tag = name[0].lower()
        whole = None if after == "/" else TAG.match(source, at, at + TAG_SIZE)
        end = whole.end() if whole else source.find(">", name.end()) + 1
        rest = whole[2] if whole else source[name.end() : end - 1]
        at = end
        if after == "/":
            end_tag(tag)
        elif tag in VOID:
            if tag == "br":
                pending.append(" ")
            elif tag == "hr":
                flush()
        elif tag in RAW:
            closed = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            at = closed.end() if closed else size
        else:
            start_tag(tag, rest)
    flush()
    return blocks


class Place(NamedTuple):
    """Where a block stands, as one id, with all that decides its weight."""

    at: int
    prior: float | None
    chain: tuple[int, ...]


def place_of(host: str, block: Block, told: bool) -> Place:
    """``told``: the page says itself where its article is."""
    prior = float(block.landmark) if told else None
    chain = block.chain or (0,)
    if block.named:  # a tree of its own, which tells nothing about the nodes above it
        chain = (node_id(chain[-1], "named"),)
    return Place(xxhash.xxh3_64_intdigest(f"{host}\n{chain[-1]}\n{prior}") - (1 << 63), prior, chain)


def chosen(blocks: list[Block], weights: list[float], least: float) -> list[str]:
    """The texts that stay."""
    told = any(b.landmark for b in blocks)
    plain = [w for b, w in zip(blocks, weights, strict=True) if not b.named and (b.landmark or not told)]
    if plain:
        needed = min(least, max(w for b, w in zip(blocks, weights, strict=True) if not b.named))
        return [b.text for b, w in zip(blocks, weights, strict=True) if not b.named and w >= needed]
    return [b.text for b, w in zip(blocks, weights, strict=True) if w >= least and (b.landmark or not told or not b.named)]


PARSED = "key binary, host string, fresh array<struct<node:long,value:long>>, shown array<struct<node:long,style:long>>, places array<struct<at:long,prior:double,chain:array<long>>>"
PAIR = lambda name: pa.list_(pa.struct([("node", pa.int64()), (name, pa.int64())]))
PLACES = pa.list_(pa.struct([("at", pa.int64()), ("prior", pa.float64()), ("chain", pa.list_(pa.int64()))]))


def page_features(host: str, source: str) -> tuple[list[dict], list[dict], list[dict]]:
    """(node, text hash) pairs, (node, presentation) pairs and places of a page, each once."""
    blocks = page_blocks(source)
    told = any(b.landmark for b in blocks)
    children: dict[int, dict[int, None]] = {}
    fresh: dict[tuple[int, int], None] = {}
    places: dict[int, Place] = {}
    for block in blocks:
        place = place_of(host, block, told)
        places[place.at] = place
        value = xxhash.xxh3_64_intdigest(block.text) - (1 << 63)
        for node in place.chain:
            fresh[node, value] = None
            children.setdefault(node, {})
        for above, below in zip(place.chain, place.chain[1:]):
            children[above][below] = None
    return (
        [{"node": node, "value": value} for node, value in fresh],
        [{"node": node, "style": xxhash.xxh3_64_intdigest(",".join(map(str, below))) - (1 << 63)} for node, below in children.items()],
        [p._asdict() for p in places.values()],
    )


def _parse(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            key, hosts, pages = part.columns
            made = [page_features(host, source or "") for host, source in zip(hosts.to_pylist(), pages.to_pylist(), strict=True)]
            fresh, shown, places = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [key, hosts, pa.array(fresh, PAIR("value")), pa.array(shown, PAIR("style")), pa.array(places, PLACES)],
                ["key", "host", "fresh", "shown", "places"],
            )


def importance(features: DataFrame, styles: DataFrame, by: list[str]) -> DataFrame:
    """Pages and importance of each node, from (host, node, value, n) and (host, node, style, n)."""
    pages = styles.groupBy(*by, "style").agg(F.sum("n").alias("n")).groupBy(*by).agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("spread")
    )
    presented = F.when(F.col("pages") > 1, 1 - F.col("spread") / F.col("pages") / F.log("pages")).otherwise(1.0)
    shared = features.groupBy(*by, "value").agg(F.sum("n").alias("n")).groupBy(*by).agg(F.avg(F.log("n")).alias("shared"))
    said = F.when(F.col("pages") > 1, 1 - F.col("shared") / F.log("pages")).otherwise(1.0)
    return pages.join(shared, by).select(*by, "pages", (presented * (1 - CONTENT_SHARE) + said * CONTENT_SHARE).alias("importance"))


def place_weights(blocks: DataFrame) -> DataFrame:
    """The weight of each place: that of its least important node, rounded so that no order of summing decides."""
    features = blocks.select("host", F.explode("fresh").alias("x")).select("host", "x.*")
    features = settle(features.groupBy("host", "node", "value").agg(F.count("*").alias("n")))
    styles = blocks.select("host", F.explode("shown").alias("x")).select("host", "x.*")
    styles = styles.groupBy("host", "node", "style").agg(F.count("*").alias("n"))
    own = importance(features, styles, ["host", "node"])
    overall = importance(features, styles, ["node"]).select("node", F.col("pages").alias("seen"), F.col("importance").alias("overall"))
    smoothed = (F.col("importance") * F.col("pages") + F.col("overall") * HOST_PAGES) / (F.col("pages") + HOST_PAGES)
    both = lookup(own, overall, "node").withColumn("smoothed", smoothed)
    entropy = F.when(F.col("prior") > 0, F.greatest("importance", "overall")).otherwise(F.col("smoothed"))
    weight = F.coalesce((entropy * F.col("seen") + F.col("prior") * PRIOR_PAGES) / (F.col("seen") + PRIOR_PAGES), entropy)
    places = blocks.select("host", F.explode("places").alias("x")).select("host", "x.*").groupBy("at").agg(
        F.first("host").alias("host"), F.first("prior").alias("prior"), F.first("chain").alias("chain")
    )
    weights = places.withColumn("node", F.explode("chain")).join(both, ["host", "node"]).groupBy("at").agg(F.round(F.min(weight), 9).alias("weight"))
    weights = settle(weights)
    drop_settled(features)
    return weights


def extract(df: DataFrame, source: str = "html", host: Column | None = None, to: str = "text", least: float = LEAST, keep: list[str] | None = None) -> DataFrame:
    """``df`` with the main text of each page in column ``to``, blocks in page order joined by line feeds.

    White space within a block is one space, character references are decoded. A page
    that is null, empty or has no main text gets an empty string; a row without a host
    belongs to the host "". Rows are never dropped, and equal rows get equal texts. A
    column named ``to`` is replaced. ``keep`` names the columns to return, all by default;
    a page moves once, to meet its weights.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    where = F.coalesce(host if host is not None else host_of(F.col("url")), F.lit(""))
    page = F.col(source).cast("string")
    key = F.unhex(F.sha2(F.concat_ws("\n", where, F.coalesce(page, F.lit(""))), 256))
    kept = [c for c in (df.columns if keep is None else keep) if c != to]
    rows = df.select(*kept, key.alias("__key"), where.alias("__host"), page.alias("__page"))
    blocks = settle(rows.select(F.col("__key").alias("key"), F.col("__host").alias("host"), F.col("__page").alias("html")).mapInArrow(_parse, PARSED))
    weights = place_weights(blocks)
    own = blocks.select("key", F.explode("places.at").alias("at")).distinct()
    own = lookup(own, weights, "at").groupBy("key").agg(F.collect_list(F.struct("at", "weight")).alias("__weights"))
    own = settle(own.withColumnRenamed("key", "__key"))
    drop_settled(blocks, weights)
    free_shuffles(spark)

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "__page"):
                hosts, pages, known = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("__host", "__page", "__weights"))
                texts = []
                for where, html_, found in zip(hosts, pages, known, strict=True):
                    found = {x["at"]: x["weight"] for x in found or []}
                    blocks = page_blocks(html_ or "") if found else []
                    told = any(b.landmark for b in blocks)
                    weights = [found[place_of(where, b, told).at] for b in blocks]
                    texts.append("\n".join(chosen(blocks, weights, least)))
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, to])

    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(to, T.StringType())])
    return lookup(rows, own, "__key", "left").mapInArrow(cut, schema)


def page_texts(df: DataFrame) -> DataFrame:
    """One row per page: its main text and the number of its code points."""
    texts = extract(df.select("page_id", "url", "html"), keep=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
