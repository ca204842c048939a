"""Main text of web pages by a site style tree.

The pages of one host are merged: nodes with the same path of tags and classes are one node of the
host's tree. A node's presentation importance is the entropy of the child sequences it appears with, a
leaf's content importance falls with the entropy of its text blocks over pages (a block that is on all
pages says nothing), each block weighed by how often it occurs. A branch's composite importance is `(1 - g**l) * presentation + g**l * content`, for
l child sequences and the mean content importance of its leaves. Branches that enough pages have and
whose importance is low are removed from each page; so are branches whose tag, role or class says that
they are no content. In an article a branch is judged only if others there are important, since copies of one article
say nothing; text blocks directly in an article are its text and stay however often they recur.

Pages of a host with the same text blocks (outside dropped elements) are copies and count as one, so a
page copied often does not look like boilerplate. Statistics are sums over (host, path, feature) of those
distinct pages, added up before they are shuffled, so a host with a third of all pages is no larger a group
than its style tree.

Blocks end at block-level tags; `<br>` is white space. In a block character references are decoded and
white space becomes one space; blocks are joined by a line feed.

Edge cases: null and empty pages have an empty text. A null or unusual url belongs to no host, and the
page is judged by itself. If everything outside articles were removed as unimportant, it stays (a host of
identical pages). Unclosed and stray tags are read as browsers do, roughly; text after an unclosed comment
is lost, as in a browser. Repeated rows give repeated rows (and count once). An empty table gives an empty
table; columns other than the three named are never read.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.base import settled


@dataclass(frozen=True)
class StyleTree:
    least_pages: int = 5  # pages of a host that must have a branch before it is judged
    least_importance: float = 0.4
    article_importance: float = 0.6  # of some branch of an article, for others to be judged: copies of one article say nothing
    decay: float = 0.9  # how fast a variety of child sequences outweighs the content below
    depth: int = 48  # deeper nodes share the path of their ancestor at this depth


def _set(words: str) -> frozenset[str]:
    return frozenset(words.split())


BLOCKS = _set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul")
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title iframe noembed noframes xmp")
#: Elements that are never part of the main text.
DROPPED = _set(
    "nav footer aside form script style noscript template svg math canvas iframe object applet audio video button select textarea"
    " dialog menu head title fieldset datalist noembed noframes search")
#: Words in a class, id or role that say so too.
HINTS = _set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav navbar navigation menu menubar"
    " breadcrumb breadcrumbs sidebar complementary contentinfo footer masthead topbar toolbar cookie cookies consent gdpr notice notices"
    " notification alert alertdialog dialog popup modal overlay newsletter subscribe subscription signup social share sharing related"
    " recommended recommendations comment comments commentlist disqus reply replies respond search login pagination pager copyright")
HEAD = _set("base basefont bgsound link meta title style script noscript template")
ENDS_P = BLOCKS - {"html", "head", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "dd", "dt", "li", "legend", "summary"}
#: What a start tag closes, and where the search for it ends.
CLOSES = {
    "li": (_set("li"), _set("ul ol menu dir")), "dt": (_set("dt dd"), _set("dl")), "dd": (_set("dt dd"), _set("dl")),
    "tr": (_set("tr"), _set("table")), "td": (_set("td th"), _set("tr table")), "th": (_set("td th"), _set("tr table")),
    "tbody": (_set("thead tbody tfoot"), _set("table")), "thead": (_set("thead tbody tfoot"), _set("table")), "tfoot": (_set("thead tbody tfoot"), _set("table")),
}
WRAPPERS = _set("div section ul ol dl table figure details center dir header hgroup address")
#: Elements on which a word in an id decides in an article as well; on others there it must hold an article of its own (a reader's).
ID_DECIDES = _set("div ul ol")
#: Elements whose blocks do not end a paragraph around them.
SCOPES = _set("noscript template svg math object applet button select")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


def _hinted(value: str) -> bool:
    return any(w.lower() in HINTS for w in _WORD.findall(value))


def described(attributes: str) -> tuple[str, bool, bool]:
    """The part of a node's path that its classes make, whether its attributes rule it out, and whether its id would."""
    if not attributes.strip():
        return "", False, False
    classes, out, by_id = "", False, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "role", "id"):
            value = "".join(values)
            if name == "class":
                classes = "." + ".".join(sorted(value.split()))
            if _hinted(value):
                out, by_id = out or name != "id", by_id or name == "id"
        elif name == "hidden" or (name == "style" and _HIDDEN.search("".join(values))):
            out = True
    return re.sub(r"[\s/\d]+", "", classes), out, by_id


class Page:
    """The text blocks of a page, each with its path and how it stands to the main text.

    `watch` is called with (path, child names) for each element and (path, None, text) for each block.
    """

    def __init__(self, source: str, low: frozenset[str] = frozenset(), depth: int = 48, watch=None):
        self.blocks: list[tuple[str, bool, bool]] = []  # text, in an article, removed as unimportant
        self.low, self.depth, self.watch = low, depth, watch
        # tag, path, dropped, in an article, removed as unimportant, names of the children, `mark` before it, below an id with a hint
        self.stack = [["#", "", False, False, False, [], 0, False]]
        self.text: list[str] = []
        self.mark = 0  # where the text of the innermost dropped inline element begins; what is before waits for its end
        at = 0
        for m in iter(lambda: _TOKEN.search(source, at), None):
            if m.start() > at:
                self.text.append(source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if not name:
                continue
            name = name.lower()
            if m.group(1):
                self._end(name)
                continue
            self._start(name, m.group(3))
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else len(source)
        self.text.append(source[at:])
        while len(self.stack) > 1:
            self._pop()
        self._flush()

    def _start(self, name: str, attributes: str) -> None:
        stack = self.stack
        if name not in HEAD and name != "head" and any(f[0] == "head" for f in stack):
            self._pop_to({"head"}, frozenset())
        if name in ENDS_P:
            self._pop_to({"p"}, SCOPES | WRAPPERS | {"article", "main", "body", "td", "th", "li", "blockquote", "#"} if name != "p" else SCOPES)
        if name in CLOSES:
            self._pop_to(*CLOSES[name])
        if name == "br":
            self.text.append(" ")
            return
        if name in VOID:
            if name in BLOCKS:
                self._flush()
            return
        if name in RAW:
            return  # its body is skipped
        top = stack[-1]
        classes, ruled_out, by_id = described(attributes)
        # In an article ids are made from headings too: there, one decides only on lists and plain boxes.
        hinted = by_id and top[3] and (name not in ID_DECIDES or "section" in classes.split("."))
        ruled_out = ruled_out or (by_id and not hinted) or (top[7] and name == "article")
        inside = top[3] or ((name == "article" or name == "main") and not top[2])
        dropped = top[2] or name in DROPPED or (name == "header" and not top[3]) or (ruled_out and name not in ("html", "body", "main"))
        block = name in BLOCKS
        if not block and dropped == top[2] and not (dropped and any(f[0] == name for f in stack)):
            return  # an inline element changes nothing; in a dropped one, its own end tag must not end that
        if block:
            self._flush()
        path = top[1] if len(stack) > self.depth or not block else f"{top[1]}/{name}{classes}"
        removed = top[4] or (path in self.low and (name in WRAPPERS or not inside) and name not in ("html", "body", "article", "main"))
        if block and self.watch:
            top[5].append(name + classes)
        stack.append([name, path, dropped, inside and not dropped, removed, [], self.mark, top[7] or hinted])
        if not block:
            self.mark = len(self.text)

    def _end(self, name: str) -> None:
        if name in BLOCKS:
            self._flush()
        if any(f[0] == name for f in self.stack):
            self._pop_to({name}, frozenset())

    def _pop_to(self, names, barrier) -> None:
        """Close the nearest element of one of these names, unless a barrier comes first."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in barrier:
                return

    def _pop(self) -> None:
        name, path, _, _, _, children, mark, _ = self.stack[-1]
        if name in BLOCKS:
            self._flush()
            if self.watch:
                runs = [c for c, before in zip(children, [None, *children]) if c != before]
                self.watch(path, runs, None)
        else:
            del self.text[self.mark :]
            self.mark = mark
        self.stack.pop()

    def _flush(self) -> None:
        if len(self.text) > self.mark:
            raw = "".join(self.text[self.mark :])
            del self.text[self.mark :]
            text = " ".join(html.unescape(raw).split())
            if text:
                name, path, dropped, inside, removed, *_ = self.stack[-1]
                if self.watch and (name in BLOCKS or not dropped):
                    self.watch(path, None, text)
                if not dropped:
                    self.blocks.append((text, inside, removed))

    def main_text(self) -> str:
        inside = [t for t, i, r in self.blocks if i and not r]
        if not inside:
            inside = [t for t, i, _ in self.blocks if i] or [t for t, _, r in self.blocks if not r] or [t for t, _, _ in self.blocks]
        return "\n".join(inside)


def host_of(url: Column) -> Column:
    """The host of an absolute url, in lower case; null for others."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _crc(text: str) -> int:
    data = text.encode()
    return zlib.crc32(data) << 31 ^ zlib.crc32(data[::-1])


def _digest(rows: list[tuple]) -> int:
    return int.from_bytes(hashlib.blake2b(repr(rows).encode(), digest_size=8).digest(), "big", signed=True)


PRESENT, STYLE, CONTENT = 0, 1, 2
PAGE = "host string, same bigint, whole bigint, features array<struct<path:string,kind:int,feature:bigint,n:bigint>>"


def page_features(pages: DataFrame, p: StyleTree) -> DataFrame:
    """Per page of a host: a digest of its text blocks that are not dropped, one of all features, and the features."""

    def batch(hosts, same, whole, ends, rows) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        features = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["path", "kind", "feature", "n"])
        return pa.RecordBatch.from_arrays(
            [hosts, pa.array(same, pa.int64()), pa.array(whole, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), features)],
            ["host", "same", "whole", "features"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            first, same, whole, ends, rows = 0, [], [], [0], []
            for at, source in enumerate(part.column(1), 1):
                seen: dict[tuple, int] = {}

                def watch(path, children, text):
                    key = (path, STYLE, _crc("|".join(children))) if text is None else (path, CONTENT, _crc(text))
                    seen[key] = seen.get(key, 0) + 1

                page = Page(source.as_py() or "", depth=p.depth, watch=watch)
                for path in {k[0] for k in seen}:
                    seen[(path, PRESENT, 0)] = 1
                own = sorted((*k, n) for k, n in seen.items())
                rows += own
                ends.append(len(rows))
                same.append(_digest([(t, i) for t, i, _ in page.blocks]))
                whole.append(_digest(own))
                if len(rows) >= 1 << 16 or at == part.num_rows:
                    yield batch(part.column(0).slice(first, at - first), same, whole, ends, rows)
                    first, same, whole, ends, rows = at, [], [], [0], []

    return pages.filter("host IS NOT NULL").select("host", "html").mapInArrow(run, PAGE)


def tree_sums(pages: DataFrame, p: StyleTree) -> DataFrame:
    """Per host, path and feature: the distinct pages that have it, its occurrences n, and the sum of n * ln(n) by page.

    Pages of a host with the same text blocks outside dropped elements are copies and count as one, the one
    whose features have the smallest digest.
    """
    distinct = page_features(pages, p).groupBy("host", "same").agg(F.min_by("features", "whole").alias("features"))
    found = distinct.select("host", F.inline("features"))
    n = F.col("n")
    return found.groupBy("host", "path", "kind", "feature").agg(F.count(F.lit(1)).alias("pages"), F.sum(n).alias("n"), F.sum(n * F.log(n)).alias("n_log_n"))


def importance(sums: DataFrame, p: StyleTree) -> DataFrame:
    """host, path, pages and the composite importance of each branch that enough pages have."""
    own = ["host", "path"]
    present = sums.filter(F.col("kind") == PRESENT).select(*own, F.col("pages").alias("m")).filter(F.col("m") >= p.least_pages)
    rows = sums.join(present, own)
    base = F.log(F.greatest(F.col("m"), F.lit(2)))
    nlogn = F.col("n") * F.log("n")
    styles = rows.filter(F.col("kind") == STYLE).groupBy(*own, "m").agg(
        F.count(F.lit(1)).alias("l"), (F.log(F.sum("n")) - F.sum(nlogn) / F.sum("n")).alias("h"))
    styles = styles.select(*own, "m", "l", F.least(F.lit(1.0), F.col("h") / base).alias("presentation"))
    spread = (F.log("n") - F.col("n_log_n") / F.col("n")) / base
    leaves = rows.filter(F.col("kind") == CONTENT).groupBy(*own, "m").agg((1 - F.sum(F.col("n") * F.least(F.lit(1.0), spread)) / F.sum("n")).alias("content"))
    # Each leaf counts for all branches above it.
    steps = F.split("path", "/")
    above = F.explode(F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/")))
    below = leaves.withColumn("branch", above).groupBy("host", F.col("branch").alias("path")).agg(
        (F.sum(F.col("content") * F.col("m")) / F.sum("m")).alias("content"))
    weight = F.pow(F.lit(p.decay), F.col("l"))
    composite = (1 - weight) * F.col("presentation") + weight * F.coalesce("content", F.lit(1.0))
    return styles.join(below, own, "left").select(*own, F.col("m").alias("pages"), composite.alias("importance"))


def unimportant(judged: DataFrame, p: StyleTree) -> DataFrame:
    """host and path of the branches to remove: those of low importance, in an article only beside important ones."""
    rows = judged.withColumn("article", F.regexp_extract("path", r"^(.*?/(?:article|main)[^/]*)/", 1))
    beside = rows.filter("article <> ''").groupBy("host", "article").agg(F.max("importance").alias("most")).filter(F.col("most") >= p.article_importance)
    low = rows.filter(F.col("importance") < p.least_importance)
    return low.join(beside, ["host", "article"], "left").filter("article = '' OR most IS NOT NULL").select("host", "path")


def main_texts(pages: DataFrame, key: str, url: str, source: str, p: StyleTree = StyleTree()) -> DataFrame:
    """Per row: key, url, text, n_chars."""
    used = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(source).alias("html"), host_of(F.col(url)).alias("host"))
    low = unimportant(settled(importance(settled(tree_sums(used, p), "style-sums"), p), "style-importance"), p)
    rules = settled(low.groupBy("host").agg(F.collect_set("path").alias("low")), "style-rules")
    # Pages without a host would all meet at null; they look for a host that no page has.
    spread = F.coalesce("host", F.concat(F.lit("?"), F.xxhash64("key", "html").cast("string")))
    rows = used.withColumn("host", spread).join(rules, "host", "left").select("key", "url", "html", "low")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset[str]] = {}
        for part in parts:
            texts = []
            for source, low in zip(part.column(2), part.column(3)):
                listed = tuple(low.as_py() or ())
                if listed not in known:
                    known.clear()
                    known[listed] = frozenset(listed)
                texts.append(Page(source.as_py() or "", known[listed], p.depth).main_text())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["key", "url", "text", "n_chars"])

    kind = used.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, url string, text string, n_chars bigint").withColumnRenamed("key", key)
