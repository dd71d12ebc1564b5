"""Main text of web pages by equivalence classes of tokens across the pages of a host.

Tokens are the container elements of a page, told apart by their path (tag names with class and id words).
Two tokens are in one equivalence class if they have the same occurrence vector, that is, the same number
of occurrences on every page of the host. Vectors are compared by a sum of hashes of (page, count), so they
are built by a partial aggregate and a host with a third of all pages is not one task. A class is valid if it
has several tokens (or the host one page) and occurs on at least half of the host's pages. Paths nest the valid
classes into the host's template. Its slots are what lies inside its containers; the content slot is the
deepest one that occurs once a page and holds the article: an ``article`` or ``main`` element if the template
has one, else the element with at least half of the text. The text of the content slot is returned, block by
block, without the elements inside it that carry navigation, notices, adverts, forms or reader comments; they are
told by whole names of class, id and role (or the last word of a compound name, or the first before a layout word),
at any depth below the slot, and never include ``html`` or ``body``.
A page that lacks its host's content slot is read by its own ``article``, ``main`` or ``body``.

Defined cases: null or empty html has no text; unclosed elements end with their parents; markup cut off at the
end of a page is dropped as markup; a null url, or one without host, is the empty host; repeated pages are
read one by one (and count one by one in the vectors); long pages are handled whole; other columns pass through;
empty tables give empty results.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import ensure_checkpoint_dir

#: HTML's raw-text, void, block and container elements.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "title")
BLOCKS = frozenset("address blockquote caption dd details dt figcaption h1 h2 h3 h4 h5 h6 hr legend li option p pre summary td th tr".split())
CONTAINERS = frozenset("html head body main article section div nav header footer aside form ul ol dl menu table thead tbody tfoot "
                       "figure fieldset dialog select button".split())
DROPPED = frozenset("head nav footer aside form menu dialog select button fieldset".split())
#: Whole names in class, id and role of what is not the article; and words that, last in a compound name (or first
#: before one of PARTS), say the same: "cookie-notice" and "sidebar-left" do, "no-sidebar" and "social-story" do not.
NOT_CONTENT = re.compile(
    r"^(ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alert|newsletter|subscri\w*|popup|modal|overlay|"
    r"sidebar\w*|side|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|comments?|respond|replies|disqus\w*|"
    r"share|sharing|social|related|recommend\w*|widgets?|toolbar|pagination|pager|skip|search|login|signup|complementary|contentinfo)$")
PARTS = frozenset("area bar block body bottom box button buttons container content footer form header holder icons inner items left link links "
                  "list main menu outer panel posts articles primary right secondary section slot thread top unit wrap wrapper".split())
#: First words that turn a compound into a remark on the layout of what holds the article.
LAYOUT = frozenset("no not has have with without hide hidden show by is".split())
#: Elements that hold the whole page: never dropped for their names.
WHOLE = frozenset(("html", "body"))
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(RAW) + r")(?=[\s/>])[^>]*(?:>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z)", re.S | re.I)
LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


def _labels(attributes: str) -> list[str]:
    words = []
    for found in LABEL.finditer(attributes):
        words += WORDS.findall((found[1] or found[2] or found[3] or "").lower())
    return words


def _not_content(name: str) -> bool:
    """Whether one name of a class, id or role attribute names what is not the article."""
    words = WORDS.findall(name)
    if len(words) < 2:
        return bool(words) and NOT_CONTENT.match(words[0]) is not None
    if any(w in LAYOUT for w in words[:-1]):
        return False
    return NOT_CONTENT.match(words[-1]) is not None or (NOT_CONTENT.match(words[0]) is not None and all(w in PARTS for w in words[1:]))


def _names(attributes: str) -> list[str]:
    return [n for found in LABEL.finditer(attributes) for n in (found[1] or found[2] or found[3] or "").lower().split()]


def walk(page: str):
    """(path, dropped, block, text) of every stretch of text, and with text None of every container that opens; path: tuple
    of open containers, each with its class words; dropped: depths of the open containers that are no content, the
    innermost last; block: a number that changes with every block."""
    stack: list[tuple[str, str, bool]] = []
    block, at = 0, 0
    path: tuple[str, ...] = ()
    dropped: tuple[int, ...] = ()

    def state():
        return tuple(s[1] for s in stack), tuple(i for i, s in enumerate(stack) if s[2])

    for found in TOKEN.finditer(page):
        if found.start() > at:
            yield path, dropped, block, page[at:found.start()]
        at = found.end()
        name = (found[3] or found[6] or "").lower()
        if not name:
            if found[1]:
                block += found[1].lower() not in ("svg", "math", "canvas")
            continue
        closing = bool(found[2] or found[5])
        if name in CONTAINERS:
            block += 1
            if not closing:
                attributes = found[4] or found[7] or ""
                words = _labels(attributes)
                bad = name in DROPPED or (name not in WHOLE and any(_not_content(n) for n in _names(attributes)))
                bad |= name == "header" and not any(s[0] in ("article", "main") for s in stack)
                stack.append((name, ".".join([name, *words]), bad))
            else:
                at_level = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if at_level is not None:
                    del stack[at_level:]
            path, dropped = state()
            if not closing:
                yield path, dropped, block, None
        elif name in BLOCKS:
            block += 1
        elif name == "br":
            yield path, dropped, block, " "
    if at < len(page):
        yield path, dropped, block, page[at:]


def _tokens(batches):
    """(host, page, path, count, chars): containers of each page and the kept text inside them."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            out: dict[str, list] = {"host": [], "page": [], "path": [], "n": [], "chars": []}
            part = batch.slice(lo, 256)
            for host, page, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                opened: dict[tuple, int] = {}
                chars: dict[tuple, int] = {}
                for path, dropped, _, piece in walk(text or ""):
                    if piece is None:
                        opened[path] = opened.get(path, 0) + 1
                    elif not dropped:
                        for d in range(len(path)):
                            chars[path[:d + 1]] = chars.get(path[:d + 1], 0) + len(piece)
                for path, n in opened.items():
                    out["host"].append(host)
                    out["page"].append(page)
                    out["path"].append("/".join(path))
                    out["n"].append(n)
                    out["chars"].append(chars.get(path, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["host"], pa.string()), pa.array(out["page"], pa.int64()), pa.array(out["path"], pa.string()),
                 pa.array(out["n"], pa.int64()), pa.array(out["chars"], pa.int64())], list(out))


def templates(tokens: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, slot): the content slot of each host's template."""
    of = lambda seed: F.sum(F.shiftrightunsigned(F.xxhash64("page", "n", F.lit(seed)), 32))
    vectors = tokens.groupBy("host", "path").agg(F.count("*").alias("on"), F.sum("n").alias("all"), F.sum("chars").alias("chars"),
                                                 of(1).alias("v1"), of(2).alias("v2")).checkpoint()  # read three times; pages are parsed once
    classes = vectors.groupBy("host", "on", "all", "v1", "v2").agg(F.count("*").alias("tokens"), F.max("chars").alias("most"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    text = vectors.groupBy("host").agg(F.max("chars").alias("text"))
    valid = (vectors.join(classes.drop("most"), ["host", "on", "all", "v1", "v2"]).join(hosts, "host").join(text, "host")
             .where("(tokens > 1 or pages = 1) and on * 2 >= pages and on = all"))
    last = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^[a-z0-9]+", 0)
    named = F.when(last == "article", 2).when(last == "main", 1).otherwise(0)
    enough = F.col("chars") * 2 >= F.col("text")
    depth = F.size(F.split("path", "/"))
    best = F.max(F.struct(named.alias("named"), enough.alias("enough"), F.when(enough, depth).otherwise(-depth).alias("depth"), "chars", "path"))
    return valid.where((F.col("chars") > 0) & (enough | (named > 0))).groupBy("host").agg(best.alias("b")).select("host", F.col("b.path").alias("slot"))


def main_text(page: str, slot: str | None) -> str:
    """The text of the content slot, one line per block."""
    pieces = [p for p in walk(page) if p[3] is not None]
    wanted = tuple(slot.split("/")) if slot else None
    inside = lambda path: wanted is not None and path[:len(wanted)] == wanted
    if not any(inside(p) for p, *_ in pieces):
        for name in ("article", "main", "body"):
            own = next((p[:i + 1] for p, *_ in pieces for i, s in enumerate(p) if s.split(".")[0] == name), None)
            if own is not None:
                wanted = own
                break
        else:
            wanted = ()
    blocks: list[list[str]] = []
    last = None
    for path, dropped, block, text in pieces:
        if path[:len(wanted)] != wanted or (dropped and dropped[-1] >= len(wanted)):
            continue
        if block != last:
            blocks.append([])
            last = block
        blocks[-1].append(text)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def _texts(batches, html_at: int, slot_at: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = [main_text(h or "", s) for h, s in zip(part.column(html_at).to_pylist(), part.column(slot_at).to_pylist())]
            columns = [part.column(i) for i in range(part.num_columns) if i not in (html_at, slot_at)]
            names = [n for i, n in enumerate(part.schema.names) if i not in (html_at, slot_at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, "text"])


def extract(pages: DataFrame, url: str = "url", html: str = "html", broadcast_rows: int = 50_000) -> DataFrame:
    """``pages`` without ``html``, with ``text``."""
    if "text" in pages.columns or "_slot" in pages.columns or "_host" in pages.columns:
        raise ValueError("columns named text, _slot or _host would clash with the result")
    ensure_checkpoint_dir(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.withColumn("_host", host)
    page = F.xxhash64(F.col(url), F.col(html))
    tokens = rows.select(F.col("_host").alias("host"), page.alias("page"), F.col(html).alias("html")).mapInArrow(
        _tokens, "host string, page long, path string, n long, chars long")
    found = templates(tokens, rows.select(F.col("_host").alias("host"))).checkpoint()
    side = found.withColumnRenamed("host", "_host").withColumnRenamed("slot", "_slot")
    if found.count() <= broadcast_rows:
        side = F.broadcast(side)
    rest = [f for f in pages.schema.fields if f.name != html]
    joined = rows.join(side, "_host", "left").select(*[F.col(f"`{f.name}`") for f in rest], F.col(html), "_slot")
    at = len(rest)
    return joined.mapInArrow(lambda b: _texts(b, at, at + 1), T.StructType([*rest, T.StructField("text", T.StringType())]))
