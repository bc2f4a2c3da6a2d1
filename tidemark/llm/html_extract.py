"""The main text of pages, with the template of each site removed.

A page is read once into a tree of elements. The hash of every subtree, with the path of elements that it stands in, is
counted in Spark, per host and per section of it: over pages that differ in their main text, so that copies of a page
don't make a template of their article. Subtrees that recur on a good part of a host's pages, or of a section's, are
deleted, then what is marked up as menu, header, footer, sidebar, notice, advert, form or comments, and the blocks of the
article that are left (or of the page, where nothing is marked as the article) are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.shared import lean, settled

# A template is on so many pages, and on this part of all pages, of a host or of a section.
MIN_PAGES = 3
MIN_SHARE = 0.2

# Fixed values of the markup language and of customary names.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
_CLOSES_P = _BLOCKS - {"body", "html", "caption", "legend", "tbody", "tfoot", "thead", "tr"} | {"hr"}
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = set("ul ol dl table select menu".split())
_NEVER = set("head script style nav footer aside form noscript template iframe object svg canvas button select textarea input label title dialog menu audio video map search".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAMES = set(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup "
    "modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead comment comments disqus respond reply replies "
    "share sharing social related recommended newsletter subscribe subscription signup login pagination pager toolbar widget".split()
)
# Of names with several parts the last tells, as in "reader-comments" or "cookie-notice"; of these the first does too.
_FIRST_NAMES = set("ad ads advert adverts advertisement cookie cookies consent gdpr nav navbar breadcrumb breadcrumbs sidebar footer share sharing social newsletter disqus".split())
_MAIN_NAMES = set("articlebody post-content entry-content article-content article-body main-content post-body story-body".split())

_TAG = re.compile(
    r"<(?:!--(?:.*?)(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?P<close>>|\Z)"
    r"|/?[a-zA-Z][^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("name", "marks", "children")

    def __init__(self, name: str, rest: str) -> None:
        self.name, self.children = name, []
        self.marks = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(rest)} if rest and not rest.isspace() else {}

    def boilerplate(self) -> bool:
        """Whether its markup says that it is not the text."""
        if self.name in _NEVER or self.marks.get("role") in _ROLES or "hidden" in self.marks:
            return True
        if self.name in ("html", "body", "main", "article"):
            return False
        return self.named(_NAMES)

    def named(self, wanted: set[str]) -> bool:
        for name in f"{self.marks.get('class', '')} {self.marks.get('id', '')}".split():
            parts = re.split(r"[-_]+", name)
            if name in wanted or parts[-1] in wanted or parts[0] in wanted & _FIRST_NAMES:
                return True
        return False

    def head(self) -> bool:
        """Whether it is, or is named as, a header."""
        return self.name == "header" or self.name in ("div", "section") and self.named({"header", "masthead"})

    def main(self) -> bool:
        if self.name in ("article", "main") or self.marks.get("role") in ("main", "article"):
            return True
        return any(x in _MAIN_NAMES for x in f"{self.marks.get('class', '')} {self.marks.get('id', '')} {self.marks.get('itemprop', '')}".split())


def parse(page: str) -> Element:
    """The tree of a page; unclosed, misnested and torn markup is taken as browsers do, roughly."""
    root = Element("html", "")
    stack, at = [root], 0
    # Where in the stack elements of a name are open, outermost first.
    open_at: dict[str, list[int]] = {}

    def cut(length: int) -> None:
        while len(stack) > length:
            open_at[stack.pop().name].pop()

    def innermost(names: set[str]) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=0)

    def close(names: set[str], until: set[str]) -> None:
        """Close the innermost element of ``names``, unless one of ``until`` is inside of it."""
        k = innermost(names)
        if k > innermost(until):
            cut(k)

    def say(text: str) -> None:
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    for found in iter(lambda: _TAG.search(page, at), None):
        say(page[at : found.start()])
        at = found.end()
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if found["close"] != ">":
            break
        if found["end"]:
            if open_at.get(name):
                cut(open_at[name][-1])
            continue
        if name in ("html", "body"):
            continue
        if name in _CLOSES_P:
            close({"p"}, _LISTS | {"div", "section", "article", "td", "th", "button"})
        if name in _CLOSED_BY:
            close(_CLOSED_BY[name], _LISTS - {"tr"})
        element = Element(name, found["rest"])
        stack[-1].children.append(element)
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            after = _TAG.match(page, end.start()) if end else None
            at = after.end() if after else len(page)
        elif name not in _VOID and not found["rest"].endswith("/"):
            open_at.setdefault(name, []).append(len(stack))
            stack.append(element)
    else:
        say(page[at:])
    return root


def _roots(element: Element) -> list[Element]:
    """The outermost elements marked as the article; of several kinds, articles rather than what holds them."""
    found, todo = [], [element]
    while todo:
        e = todo.pop()
        if e is not element and e.main():
            inner = [] if e.name == "article" else _roots(e)
            found += inner or [e]
        elif e is element or not e.boilerplate():
            todo += [c for c in reversed(e.children) if isinstance(c, Element)]
    return found


def _kept(element: Element) -> set[int]:
    """Elements that only their class or id names speak against, and that hold most of the text: names may err."""
    size, doubtful, todo = {}, [], [(element, False)]
    while todo:
        e, ready = todo.pop()
        if not ready:
            todo.append((e, True))
            todo += [(c, False) for c in e.children if isinstance(c, Element)]
            continue
        # What is surely not text doesn't count.
        own = sum(len(c) for c in e.children if isinstance(c, str)) + sum(size[id(c)] for c in e.children if isinstance(c, Element))
        size[id(e)] = 0 if e is not element and e.name in _NEVER else own
        if e is not element and e.name not in _NEVER and e.boilerplate() and e.named(_NAMES):
            doubtful.append(e)
    return {id(e) for e in doubtful if 2 * size[id(e)] > size[id(element)]}


def _walk(element: Element, deleted, hashes: dict[int, int], inside: bool) -> list[str]:
    """The blocks of text below an element. ``inside``: it is in the article, where paragraphs don't belong to a template."""
    blocks, line = [], []
    kept = _kept(element) if inside else set()

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            blocks.append(text)
        line.clear()

    # Each entry: an element or text to visit, or None where a block ends.
    todo: list = [element]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif x is not element and deleted and hashes.get(id(x)) in deleted and not (inside and x.name in _TEXTUAL):
            line.append(" ")
        elif x is not element and inside and x.head() and (x.name == "header" or any(isinstance(c, Element) and c.name in _HEADINGS for c in x.children)):
            # An article's own header keeps its headings.
            flush()
            todo.append(None)
            todo += reversed([c for c in x.children if isinstance(c, Element) and c.name in _HEADINGS])
        elif x is not element and (x.name == "header" or x.boilerplate()) and id(x) not in kept:
            line.append(" ")
        elif x.name == "br" or x.name in ("td", "th", "hr"):
            todo += [" ", *reversed(x.children), " "]
        elif x.name in _BLOCKS:
            flush()
            todo.append(None)
            todo += reversed(x.children)
        else:
            todo += reversed(x.children)
    flush()
    return blocks


_TEXTUAL = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd b i em strong span a code sub sup u q cite mark small br td th tr figcaption".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())


def _hash(element: Element, parts: list[Element]) -> tuple[list[tuple[int, bool]], dict[int, int]]:
    """(hash, fixed) of each subtree with text where it stands, and these hashes by element. ``parts``: what is marked as
    the article.

    fixed: recurrence changes nothing, as the markup alone deletes the subtree or keeps it (the article's paragraphs).
    """
    mains = {id(p) for p in parts}
    hashes, placed, out, todo = {}, {}, [], [(element, b"", not parts, False, False)]
    while todo:
        e, path, inside, fixed, ready = todo.pop()
        name = f"{e.name}\0{e.marks.get('class', '')}\0{e.marks.get('id', '')}".encode()
        if not ready:
            gone = fixed or e is not element and (e.name == "header" or e.boilerplate())
            below = inside or id(e) in mains
            # Only what stands in the article can be deleted from it, and not its paragraphs.
            todo.append((e, path, inside, gone or not inside or bool(parts) and e.name in _TEXTUAL, True))
            down = blake2b(path + name, digest_size=8).digest()
            todo += [(c, down, below, gone, False) for c in e.children if isinstance(c, Element)]
            continue
        own = blake2b(name, digest_size=8)
        some = False
        for c in e.children:
            if isinstance(c, str):
                text = _SPACE.sub(" ", c).strip()
                own.update(b"\1" + text.encode())
                some |= bool(text)
            else:
                own.update(b"\2" + (hashes.get(id(c), 0) % (1 << 64)).to_bytes(8, "little"))
                some |= hashes.get(id(c), 0) != 0
        hashes[id(e)] = int.from_bytes(own.digest(), "little", signed=True) if some else 0
        if some and e is not element:
            there = blake2b(path + own.digest(), digest_size=8).digest()
            placed[id(e)] = int.from_bytes(there, "little", signed=True)
            out.append((placed[id(e)], fixed))
    return out, placed


def text_of(page: str, deleted: frozenset[int] = frozenset()) -> str:
    """The main text of a page; ``deleted``: hashes of its site's template."""
    root = parse(page)
    parts = _roots(root)
    hashes = _hash(root, parts)[1] if deleted else {}
    if not parts:
        return "\n\n".join(_walk(root, deleted, hashes, False))
    return "\n\n".join(b for part in parts for b in _walk(part, deleted, hashes, True))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        host, part, content, subtree, fixed = [], [], [], [], []
        for name, section, page in zip(*(batch.column(c).to_pylist() for c in range(3))):
            root = parse(page or "")
            parts = _roots(root)
            main = "\0".join(b for p in parts or [root] for b in _walk(p, (), {}, bool(parts)))
            own = int.from_bytes(blake2b(main.encode(), digest_size=8).digest(), "little", signed=True)
            # The page itself counts as a subtree 0.
            for value, same in {(0, True), *_hash(root, parts)[0]}:
                host.append(name), part.append(section), content.append(own), subtree.append(value), fixed.append(same)
        columns = [pa.array(host, pa.string()), pa.array(part, pa.string()), pa.array(content, pa.int64()), pa.array(subtree, pa.int64()), pa.array(fixed, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "section", "content", "subtree", "fixed"])


def templates(
    pages: DataFrame, host: Column, html_col: str = "html", section: Column | None = None, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE
) -> DataFrame:
    """(host, section, subtree, fixed, n): subtrees that belong to the template of a host or of a section of it.

    They are on ``min_pages`` pages and on ``min_share`` of all pages there, of those that differ in their main text. A
    host's are listed for each section that has them, with their count ``n`` there. fixed: recurrence changes nothing.
    """
    section = F.lit("") if section is None else F.coalesce(section, F.lit(""))
    rows = pages.select(host.alias("host"), section.alias("section"), F.col(html_col).alias("html"))
    each = rows.mapInArrow(lean(_subtrees), "host string, section string, content bigint, subtree bigint, fixed boolean")
    once = each.groupBy("host", "section", "subtree", "content").agg(F.min("fixed").alias("fixed"))
    here = settled(once.groupBy("host", "section", "subtree").agg(F.min("fixed").alias("fixed"), F.count("*").alias("n")))

    def often(counts: DataFrame, place: list[str]) -> DataFrame:
        """The subtrees that are on enough of the pages of a place."""
        all_ = counts.where("subtree = 0").select(*(F.col(c).alias(f"of_{c}") for c in place), F.col("n").alias("pages"))
        several = counts.where((F.col("subtree") != 0) & (F.col("n") >= min_pages))
        met = several.join(all_, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in place])
        return met.where(F.col("n") >= F.col("pages") * min_share).select(*place, "subtree")

    whole = here.groupBy("host", "subtree").agg(F.sum("n").alias("n"))
    everywhere = often(whole, ["host"]).select(F.col("host").alias("h"), F.col("subtree").alias("s"))
    by_host = here.join(everywhere, F.col("host").eqNullSafe(F.col("h")) & (F.col("subtree") == F.col("s")), "left_semi")
    local = often(here, ["host", "section"]).select(F.col("host").alias("h"), F.col("section").alias("p"), F.col("subtree").alias("s"))
    same = F.col("host").eqNullSafe(F.col("h")) & (F.col("section") == F.col("p")) & (F.col("subtree") == F.col("s"))
    found = by_host.union(here.join(local, same, "left_semi")).distinct()
    # What recurrence may delete on one page of a host it may delete on all that have it.
    loose = here.groupBy(F.col("host").alias("h"), F.col("subtree").alias("s")).agg(F.min("fixed").alias("all_fixed"))
    met = found.join(loose, F.col("host").eqNullSafe(F.col("h")) & (F.col("subtree") == F.col("s")))
    return met.select("host", "section", "subtree", F.col("all_fixed").alias("fixed"), "n")


def main_texts(
    pages: DataFrame,
    host: Column,
    id_col: str = "page_id",
    html_col: str = "html",
    section: Column | None = None,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per row of ``pages``: its id and ``text``, the blocks in page order with a blank line between them.

    ``host`` names the site, ``section`` a part of it with a template of its own, if it has any. White space inside a block is one space, character references are decoded. Subtrees of the
    site's template (see ``templates``) and those marked as something else than the text are deleted; within what is
    marked as the article, paragraphs and their like stay however often they recur. Null or empty pages have an empty
    text. Ids, null or repeated, are carried along: rows that share id, host and section share what is deleted.

    A page needs its site's template only where recurrence decides: the hashes of such subtrees alone are sent to the
    pages that have them.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    part = F.lit("") if section is None else F.coalesce(section, F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), part.alias("section"), F.col(html_col).alias("html"))
    found = settled(templates(rows, F.col("host"), "html", F.col("section"), min_pages, min_share).where("NOT fixed").select("host", "section", "subtree"))
    if found.isEmpty():
        plain = rows.select("id", "html", F.lit(None).cast("array<bigint>").alias("deleted"))
    else:
        own = rows.mapInArrow(lean(_own_subtrees), f"id {kind}, host string, section string, subtree bigint")
        named = found.select(F.col("host").alias("site"), F.col("section").alias("of_section"), F.col("subtree").alias("part"))
        same = F.col("host").eqNullSafe(F.col("site")) & (F.col("section") == F.col("of_section")) & (F.col("subtree") == F.col("part"))
        hit = own.join(named, same, "left_semi")
        hit = hit.groupBy(F.col("id").alias("of"), F.col("host").alias("on"), F.col("section").alias("within")).agg(F.collect_set("subtree").alias("deleted"))
        here = F.col("id").eqNullSafe(F.col("of")) & F.col("host").eqNullSafe(F.col("on")) & (F.col("section") == F.col("within"))
        plain = rows.join(hit, here, "left").select("id", "html", "deleted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, deleted = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts = [text_of(p or "", frozenset(d or ())) for p, d in zip(pages, deleted)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return plain.mapInArrow(lean(run), f"id {kind}, text string").withColumnRenamed("id", id_col)


def _own_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place, subtree = [], []
        for k, page in enumerate(batch.column(3).to_pylist()):
            root = parse(page or "")
            own = {value for value, same in _hash(root, _roots(root))[0] if not same}
            place += [k] * len(own)
            subtree += own
        at = pa.array(place, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), pa.array(subtree, pa.int64())], names=["id", "host", "section", "subtree"])
