"""Main text of pages by wrapper induction.

Pages of a host are aligned by the path of their elements. Spark counts, per host, on how many
different pages each path stands and on how many each block of text stands at its path, so
nothing is capped and no order of pages or tasks matters. Blocks that stay the same on most pages
are template, all other text is the varying mass of its path and of those above. The paths that
enough pages share are the host's wrapper; its content node is the one of most varying mass, an
article or main where that holds a fair part of it. The text of a page is what stands under the
content node, without boilerplate elements and without template blocks.

Trees of a host are thus aligned by the paths they share, counted over all its pages, and not by
matching them two by two: counts add up across tasks in any order and need no bound, where merged
trees keep every sibling that any page ever had, or a capped choice of them.

Words of class, id and role are hints. They mark a candidate, which stays where it holds an
article, a main or most of the page's text, and wherever it is a part of a sentence.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, released, settled, ship

#: Wrappers of all hosts up to this size are broadcast; beyond it pages and wrappers are joined.
BROADCAST_BYTES = 8 << 20
#: Different pages that must agree before a block counts as template.
LEAST_PAGES, LEAST_SHARE = 4, 0.8
#: Share of a host's pages on which a path of its wrapper stands.
PATH_SHARE = 0.25
#: An article or main is the content node if it has this part of the mass of the one found by mass.
HINT_SHARE = 0.5
#: Rows and hosts a task counts at once before it hands them on.
MOST_ROWS, MOST_HOSTS = 100_000, 2_000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCK - set("html head body td th tr tbody thead tfoot caption option legend".split())
#: Opening the key ends the nearest open one of the values, not looking past the bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr"}, {"table"}),
}
DROPPED = set(
    "head script style noscript template nav footer aside button select option input textarea iframe "
    "object embed applet canvas svg audio video map menu dialog noembed noframes xmp title".split()
)
#: Elements of running text: a listed word must be one of their classes or their id as a whole.
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figcaption caption summary address".split())
#: What marks never take away.
KEPT = set("# html body article main".split())
#: Share of a page's text from which a candidate is the page, and no boilerplate.
MOST_TEXT = 0.5
#: Words of class, id and role that mark boilerplate.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation navi menu submenu breadcrumb breadcrumbs pagination pager sidebar aside widget "
    "footer foot contentinfo complementary search masthead topbar toolbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay dialog newsletter subscribe subscription signup login share sharing "
    "social follow related recommended recommendations comment comments commentlist disqus reply replies "
    "respond paywall skip".split()
)
CONTENT_TAGS = ("article", "main")
TAGS = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "key", "kids", "drop", "doubt")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.key, self.kids, self.drop, self.doubt = tag, "", [], tag in DROPPED, tag == "form"
        if attrs.strip():
            names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attrs)}
            self.key = " ".join(sorted(names.get("class", "").split()))[:80] or names.get("id", "")[:80]
            self.drop = self.drop or bool(HIDDEN.search(attrs))
            if "main" in names.get("role", "").split() and self.tag != "article":
                self.tag = "main"
            self.doubt = self.doubt or self._marked(" ".join(names.values()))

    def _marked(self, named: str) -> bool:
        if self.tag in KEPT or self.tag not in BLOCK:
            return False
        if self.tag in TEXTUAL:
            return not MARKS.isdisjoint(named.lower().split())
        return not MARKS.isdisjoint(SPLIT.split(CAMEL.sub(" ", named).lower()))


def decide(root: Node) -> Node:
    """Candidates go, unless they hold an article, a main or most of the page's text.

    From the leaves up, over a list of nodes, as trees are deep. Text counts by its characters
    without white space; that of elements which always go counts for nothing.
    """
    order, above = [root], {}
    for node in order:
        for kid in node.kids:
            if isinstance(kid, Node) and not kid.drop:
                above[id(kid)] = node
                order.append(kid)
    size, holds = {}, {}
    for node in reversed(order):
        own = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        size[id(node)] = size.get(id(node), 0) + own
        holds[id(node)] = holds.get(id(node), False) or node.tag in CONTENT_TAGS
        if id(node) in above:
            top = id(above[id(node)])
            size[top] = size.get(top, 0) + size[id(node)]
            holds[top] = holds.get(top, False) or holds[id(node)]
    for node in order:
        if node.doubt and not holds[id(node)] and size[id(node)] <= MOST_TEXT * size[id(root)]:
            node.drop = True
    return root


def parse(page: str) -> Node:
    """A forgiving tree: unknown ends are ignored, missing ends implied."""
    root = Node("#")
    stack, at, n = [root], 0, len(page)

    def close(names: set, bounds: set) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in bounds:
                return

    while at < n:
        m = TAGS.search(page, at)
        if not m:
            stack[-1].kids.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].kids.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in ENDS_P:
            close({"p"}, {"table", "td", "th", "button", "object"})
        if tag in ENDS:
            close(*ENDS[tag])
        node = Node(tag, m[3])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].endswith("/") and len(stack) < 200:
            stack.append(node)
    return decide(root)


# --- wrappers: [tag, key, pages, text hash or None, length of changing text, children] ------


def content_node(wrapper: list) -> list:
    """The deepest node with most of the varying text, or an article or main with a fair part of it."""
    masses: dict[int, int] = {}
    named: list = []

    def mass(node: list) -> int:
        if node[0] in CONTENT_TAGS:
            named.append(node)
        own = node[4] if node[3] is None or node[2] < LEAST_PAGES else 0
        masses[id(node)] = own + sum(map(mass, node[5]))
        return masses[id(node)]

    mass(wrapper)
    node = wrapper
    while node[5]:
        heavy = max(node[5], key=lambda x: masses[id(x)])
        if heavy[0] == "p" or masses[id(heavy)] < 0.6 * max(1, masses[id(node)]):
            break
        node = heavy
    # an article inside a main counts for itself
    for tag in CONTENT_TAGS:
        if best := [x for x in named if x[0] == tag]:
            hint = max(best, key=lambda x: (masses[id(x)], x[2]))
            if masses[id(hint)] >= HINT_SHARE * masses[id(node)]:
                return hint
    return node


# --- blocks ----------------------------------------------------------------------------------


def _name(*parts) -> int:
    data = "\0".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class Places:
    """Places of block elements: names of their paths by tag alone and by tag and key, tag, key and
    the place above."""

    def __init__(self):
        self.root = (0, 0, "#", "", None)
        self.known: dict[tuple, tuple] = {}

    def under(self, place: tuple, node: Node) -> tuple:
        at = (place[:2], node.tag, node.key)
        found = self.known.get(at)
        if found is None:
            if len(self.known) > MOST_ROWS:
                self.known.clear()
            names = _name(place[0], node.tag), _name(place[1], node.tag, node.key)
            found = self.known[at] = (*names, node.tag, node.key, place)
        return found


def flow(page: Node, places: Places, wrapper: list | None = None, target: list | None = None) -> list[tuple]:
    """Blocks outside boilerplate elements: text, place, content tags around it, whether under the
    content node, and whether in a header there."""
    out: list[tuple] = []
    buffer: list[str] = []
    kids_of: dict[int, dict] = {}

    def look(slot: list, node: Node) -> list | None:
        if id(slot) not in kids_of:
            kids_of[id(slot)] = {(k[0], k[1]): k for k in reversed(slot[5])}
        return kids_of[id(slot)].get((node.tag, node.key))

    def flush(place: tuple, around: frozenset, inside: bool, header: bool) -> None:
        text = SPACES.sub(" ", "".join(buffer)).strip()
        if text:
            out.append((text, place, around, inside, header))
        buffer.clear()

    def visit(node: Node, slot: list | None, place: tuple, state: tuple) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                buffer.append(kid)
                continue
            if kid.drop:
                continue
            under = look(slot, kid) if slot is not None else None
            opens = under is not None and under is target
            if kid.tag in BLOCK or opens:
                flush(place, *state)
                around, inside, header = state
                if kid.tag in CONTENT_TAGS:
                    around |= {kid.tag}
                inner = (around, inside or opens, not opens and (header or kid.tag == "header"))
                below = places.under(place, kid)
                visit(kid, under, below, inner)
                flush(below, *inner)
            else:
                if kid.tag == "br":
                    buffer.append(" ")
                visit(kid, slot if under is None else under, place, state)

    state = (frozenset(), wrapper is not None and target is wrapper, False)
    visit(page, wrapper, places.root, state)
    flush(places.root, *state)
    return out


def extract(
    page: Node, wrapper: list, template: frozenset | set = frozenset(), target: list | None = None,
    places: Places | None = None,
) -> str:
    """The page's blocks under the wrapper's content node, less those of ``template``.

    A page without the content node, or whose own article or main has a fair part of its varying
    text, gives that; else all that is not boilerplate or template. An article that is template
    throughout is kept.
    """
    target = target or content_node(wrapper)
    found = flow(page, places or Places(), wrapper, target)
    fresh = [(b[1][0], _name(b[0])) not in template for b in found]

    def mass(blocks: list[int]) -> int:
        return sum(len(found[k][0]) for k in blocks if fresh[k])

    chosen, explicit = [k for k, b in enumerate(found) if b[3]], target[0] in CONTENT_TAGS
    if not chosen:
        chosen, explicit = list(range(len(found))), False
    if not explicit:
        # its own article or main may stand where the wrapper has none, under a key of this page
        for tag in CONTENT_TAGS:
            named = [k for k, b in enumerate(found) if tag in b[2]]
            if named and mass(named) >= HINT_SHARE * mass(chosen):
                chosen, explicit = named, True
                break
    if not explicit:
        chosen = [k for k in chosen if not found[k][4]]
    varying = [k for k in chosen if fresh[k]]
    return "\n\n".join(found[k][0] for k in (varying or (chosen if explicit else [])))


# --- Spark ------------------------------------------------------------------------------------

COUNTS = (
    "_host string, _path bigint, _above array<bigint>, _tag string, _key string, "
    "_place bigint, _block bigint, _pages bigint, _chars bigint"
)


def _count_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of paths (``_block`` null) and of blocks at their place, with pages and characters."""
    names = [part.split()[0] for part in COUNTS.split(", ")]
    held: dict[tuple, list] = {}
    places = Places()

    def out() -> pd.DataFrame:
        rows = [(*k[:2], *v[:3], *k[2:], *v[3:]) for k, v in held.items()]
        frame = pd.DataFrame(rows, columns=names, dtype=object)
        return frame.astype({"_path": "int64", "_place": "Int64", "_block": "Int64", "_pages": "int64", "_chars": "int64"})

    def above(place: tuple) -> list[int]:
        """Names of the path and those above it, the root first."""
        names = []
        while place:
            names.append(place[1])
            place = place[4]
        return names[::-1]

    for batch in batches:
        for host, page in zip(batch["_host"], batch["_html"], strict=True):
            paths, chars, seen = {0: places.root}, defaultdict(int), set()
            for text, place, *_ in flow(parse(page), places):
                block = (place[0], _name(text))
                row = held.setdefault((host, place[1], *block), [None, None, None, 0, 0])
                # a page counts once, under whichever keys the block stands there
                row[3] += block not in seen
                row[4] += len(text)
                seen.add(block)
                while place:
                    paths[place[1]] = place
                    chars[place[1]] += len(text)
                    place = place[4]
            for path, place in paths.items():
                row = held.setdefault((host, path, None, None), [None, *place[2:4], 0, 0])
                if row[0] is None:
                    row[0] = above(place)
                row[3] += 1
                row[4] += chars[path]
            if len(held) > MOST_ROWS:
                yield out()
                held = {}
    if held:
        yield out()


def _wrapper_of(group: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of a host from its rows of paths and template blocks."""
    template, nodes = [], {}
    for row in group.sort_values(["_depth", "_path"]).itertuples(index=False):
        place, path, above, tag, key, block, pages, chars = row[1:9]
        if tag is None:
            template.append([int(place), int(block)])
            continue
        nodes[path] = [tag, key, int(pages), None, int(chars), []]
        if len(above) > 1:
            parent = nodes[above[-2]]
            parent[5].append(nodes[path])
            parent[4] -= int(chars)  # what stands below is counted there
    return pd.DataFrame({"_host": [group["_host"].iloc[0]], "_w": [json.dumps([nodes[0], template])]})


def _different(pages: DataFrame) -> DataFrame:
    """``_host, _html`` with one page of those of a host whose visible text is the same."""
    shown = F.regexp_replace("_html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|\s+", "")
    keyed = pages.withColumn("_same", F.xxhash64("_host", shown))
    again = keyed.groupBy("_same").count().where("count > 1").select("_same")
    near = marked(keyed, F.col("_same"), bitmap(again, "_same"), "_may")
    once = near.where("_may").groupBy("_host", "_same").agg(F.min("_html").alias("_html"))
    return near.where("NOT _may").select("_host", "_html").unionByName(once.select("_host", "_html"))


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``_host, _w``: wrapper and template blocks per host, from all of its pages; needs ``_host, _html``."""
    counted = settled(_different(pages).mapInPandas(released(_count_pages), COUNTS))
    paths = settled(
        counted.where("_block IS NULL").groupBy("_host", "_path").agg(
            F.first("_above").alias("_above"), F.first("_tag").alias("_tag"), F.first("_key").alias("_key"),
            F.sum("_pages").alias("_pages"), F.sum("_chars").alias("_chars"),
        )
    )
    hosts = paths.where("_path = 0").select("_host", F.col("_pages").alias("_n"))
    blocks = counted.where("_block IS NOT NULL")
    template = settled(
        blocks.groupBy("_host", "_place", "_block").agg(F.sum("_pages").alias("_pages"))
        .where(F.col("_pages") >= LEAST_PAGES).join(hosts, "_host")
        .where(F.col("_pages") >= LEAST_SHARE * F.col("_n")).select("_host", "_place", "_block")
    )
    # template is no varying mass of its path nor of those above
    key = ["_host", "_place", "_block"]
    same = F.xxhash64(*key)
    near = marked(blocks, same, bitmap(template.select(same.alias("_same")), "_same"), "_may").where("_may")
    fixed = (
        near.join(template, key).groupBy("_host", "_path").agg(F.sum("_chars").alias("_fixed"))
        .join(paths.select("_host", "_path", "_above"), ["_host", "_path"])
        .select("_host", F.explode("_above").alias("_path"), "_fixed")
        .groupBy("_host", "_path").agg(F.sum("_fixed").alias("_fixed"))
    )
    # zeros, not nulls: pandas would make doubles of names beside a null
    zero = F.lit(0).cast("bigint")
    kept = (
        paths.join(hosts, "_host").where(F.col("_pages") >= PATH_SHARE * F.col("_n"))
        .join(fixed, ["_host", "_path"], "left")
        .select(
            "_host", zero.alias("_place"), "_path", "_above", "_tag", "_key", zero.alias("_block"), "_pages",
            (F.col("_chars") - F.coalesce("_fixed", F.lit(0))).alias("_chars"), F.size("_above").alias("_depth"),
        )
    )
    marks = template.select(
        "_host", "_place", zero.alias("_path"), F.array().cast("array<bigint>").alias("_above"),
        F.lit(None).cast("string").alias("_tag"), F.lit(None).cast("string").alias("_key"), "_block",
        zero.alias("_pages"), zero.alias("_chars"), F.lit(0).alias("_depth"),
    )
    return kept.unionByName(marks).groupBy("_host").applyInPandas(_wrapper_of, "_host string, _w string")


def _extractor() -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple] = {}
        places = Places()
        for batch in batches:
            texts = []
            for host, page, text in zip(batch["_host"], batch["_html"], batch["_w"], strict=True):
                if host not in known:
                    if len(known) >= MOST_HOSTS:
                        known.clear()
                    wrapper, template = json.loads(text)
                    known[host] = (wrapper, {tuple(t) for t in template}, content_node(wrapper))
                texts.append(extract(parse(page), *known[host], places))
            yield batch[["_id", "_url"]].assign(_text=texts)

    return released(run)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text``, ``n_chars`` (code points).

    Null or empty html gives an empty text. A null or malformed url counts to the empty host.
    Rows that repeat an id each get a row. Elements nested deeper than 200 hang from their
    200th ancestor. Other columns are not read; no pages, no rows.
    """
    spark = pages.sparkSession
    ship(spark)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = pages.select(
        # as text, since pandas would make doubles of integers beside a null
        F.col(id_col).cast("string").alias("_id"), F.col(url_col).alias("_url"), host.alias("_host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
    )
    wrappers = settled(induce_wrappers(rows.select("_host", "_html")))
    size = wrappers.agg(F.sum(F.octet_length("_w") + F.octet_length("_host"))).first()[0] or 0
    side = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    kind = pages.schema[id_col].dataType.simpleString()
    found = rows.join(side, "_host").mapInPandas(_extractor(), "_id string, _url string, _text string")
    return found.select(
        F.col("_id").cast(kind).alias(id_col), F.col("_url").alias(url_col), F.col("_text").alias("text"),
        F.char_length("_text").cast("bigint").alias("n_chars"),
    )


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
