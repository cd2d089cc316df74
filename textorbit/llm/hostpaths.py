"""HTML extraction by consensus host paths.

Pages of a host share a template. Each page's containers are scored by the running text that
stands in them; every container votes, with its share of its page's score, for its tag-class
path, where numbers are generalised. Spark adds the votes up per host and path, and each page
is read again with the paths that its host has chosen, widened to the article around them. A page that has none of them is read
with its own best container. Votes are combined before their shuffle, so a host with a third of
all pages sends few rows; chosen paths meet pages by host and a salt.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textorbit.llm.common import append_columns, slices, table, without
from textorbit.llm.urlrules import host

# Paths that a host keeps, in order of votes; a page uses the first that it has.
PATHS = 3
SALTS = 16

# HTML's vocabulary, and words of class, id and role that mark other matter.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
SKIPPED = frozenset(
    "script style noscript template nav header footer aside form button select textarea option iframe object svg canvas "
    "audio video map dialog menu head title fieldset".split()
)
RAW = frozenset("script style textarea title noscript iframe".split())
CONTAINERS = frozenset("article main section div td body center".split())
# Containers that words of class, id and role can mark; html, body, main and article are never marked.
MARKABLE = CONTAINERS - frozenset(["article", "main", "body"])
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
OTHER_WORDS = frozenset(
    "ad ads advert advertisement adsense adbox banner banners breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "paywall popup promo promoted related respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar topbar widget widgets".split()
)

# A tag up to its end, quoted values whole; nothing is given back, so a failure looks at a character once.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.IGNORECASE) for t in RAW}
_DIGITS = re.compile(r"[0-9]+")
_WORD = re.compile(r"[a-z]+")
# Longer paths stand as a digest, so that deep nesting stays small.
PATH_CHARS = 2000


class Tags:
    """The tags of a page, forward only.

    A ``<`` that no ``>`` outside quotes ends is text. Such a search runs over the rest of the page; where
    one has passed, from the end of one quoted value to that of the next, no other goes again, so
    that a page full of broken tags is read in time that grows with its length.
    """

    def __init__(self, text: str):
        self.text, self.last = text, text.rfind(">")
        self.stops: list[int] | None = None
        self.failed: set[int] = set()

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """Start and end of the next tag from ``at``, whether it closes, its name (None: comment or
        declaration) and attributes."""
        text = self.text
        while True:
            start = text.find("<", at)
            if start < 0:
                return None
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                return start, len(text) if end < 0 else end + 3, False, None, ""
            if start > self.last:
                # Without another end only a comment can follow.
                start = text.find("<!--", start)
                return None if start < 0 else self.next(start)
            if self.stops is None:
                found = _TAG.match(text, start)
                if found:
                    return start, found.end(), bool(found[1]), found[2].lower(), found[3]
            name = _NAME.match(text, start)
            end = self._end(name.end()) if name else None
            if end is not None:
                return start, end + 1, bool(name[1]), name[2].lower(), text[name.end() : end]
            if text[start + 1 : start + 2] in ("!", "?", "/"):
                return start, text.index(">", start) + 1, False, None, ""
            at = start + 1

    def _end(self, at: int) -> int | None:
        """The next ``>`` outside quotes, looked up among the places of ends and quotes."""
        if self.stops is None:
            found = [m.start() for m in _STOP.finditer(self.text)]
            self.stops, self.next_same, later = found, [-1] * len(found), {}
            for i in range(len(found) - 1, -1, -1):
                sign = self.text[found[i]]
                self.next_same[i] = later.get(sign, -1)
                later[sign] = i
        i, passed = bisect_left(self.stops, at), []
        while i < len(self.stops) and i not in self.failed:
            if self.text[self.stops[i]] == ">":
                return self.stops[i]
            passed.append(i)
            if self.next_same[i] < 0:
                break
            i = self.next_same[i] + 1
        self.failed.update(passed)
        return None


class Page:
    """Blocks of running text in page order, each with the container it stands in."""

    def __init__(self, text: str):
        self.parents: list[int] = [-1]
        self.names: list[str] = [""]
        self.paths: list[str] = [""]
        self.tags: list[str] = [""]
        self.blocks: list[tuple[int, str, int]] = []
        self.marked: set[int] = set()  # containers whose class, id or role says other matter
        self.heads: list[int] = []  # containers that hold an h1
        self._read(text)
        if self.marked:
            self._drop_marked()

    def _read(self, text: str) -> None:
        stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, container, other matter
        words: list[str] = []
        linked, in_link, at = 0, 0, 0
        tags, last = Tags(text), text.rfind(">")
        open_: Counter[str] = Counter()  # tags on the stack

        def pop() -> None:
            open_[stack.pop()[0]] -= 1

        def close(names: frozenset, bounds: frozenset) -> None:
            """Close an open element of ``names`` with all that is in it, but not beyond ``bounds``."""
            if not any(open_[n] for n in names):
                return
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] in names:
                    while len(stack) > place:
                        pop()
                    return
                if stack[place][0] in bounds or stack[place][0] in SKIPPED:
                    return

        def flush() -> None:
            nonlocal linked
            if words:
                block = " ".join(htmllib.unescape("".join(words)).split())
                if block:
                    self.blocks.append((stack[-1][1], block, min(linked, len(block))))
                    if stack[-1][0] == "h1":
                        self.heads.append(stack[-1][1])
                words.clear()
            linked = 0

        while True:
            found = tags.next(at)
            piece = text[at : found[0] if found else len(text)]
            if piece and not stack[-1][2]:
                words.append(piece)
                if in_link:
                    linked += len(piece)
            if not found:
                break
            _, at, closing, tag, attrs = found
            if tag is None:
                continue
            if tag == "a":
                in_link = 0 if closing else 1
            if tag == "br":
                if not stack[-1][2]:
                    words.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if closing:
                if tag in INLINE and not any(s[0] == tag for s in stack[-3:]):
                    continue
                if open_[tag]:
                    if tag not in INLINE:
                        flush()
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                elif tag == "p":
                    flush()
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(text, at, last + 1) if at <= last else None
                at = end.end() if end else len(text)
                continue
            marked = bool(attrs) and tag not in SKIPPED and self._other(attrs)
            hides = tag in SKIPPED or (marked and tag not in CONTAINERS and tag != "html")
            other = stack[-1][2] or hides
            if tag in INLINE:
                # Inline tags matter only where they hide what is in them.
                if other and not stack[-1][2]:
                    stack.append((tag, stack[-1][1], True))
                    open_[tag] += 1
                continue
            flush()
            if stack[-1][0] == "p" and tag not in ("p",) or tag == "p":
                close(frozenset(["p"]), CONTAINERS)
                other = stack[-1][2] or hides
            elif tag in CLOSED_BY:
                close(CLOSED_BY[tag], frozenset(["ul", "ol", "dl", "table"]))
                other = stack[-1][2] or hides
            if attrs.endswith("/") and tag not in CONTAINERS and tag != "p":
                continue
            holder = stack[-1][1]
            if tag in CONTAINERS and not other:
                name = self._name(tag, attrs)
                self.parents.append(holder)
                self.tags.append(tag)
                self.names.append(name)
                path = f"{self.paths[holder]}>{name}" if self.paths[holder] else name
                if len(path) > PATH_CHARS:
                    path = "#" + hashlib.sha256(path.encode("utf-8", "surrogatepass")).hexdigest()
                self.paths.append(path)
                holder = len(self.parents) - 1
                if marked and tag in MARKABLE:
                    self.marked.add(holder)
            stack.append((tag, holder, other))
            open_[tag] += 1
        flush()

    def _drop_marked(self) -> None:
        """Drop what stands in marked containers, but not in one that has most of the page's running
        text and all its h1: that is a wrapper, named after a part of it or of the layout."""
        under = self._running(1.0)
        heads = [0] * len(self.parents)
        for node in self.heads:
            heads[node] += 1
        for node in range(len(heads) - 1, 0, -1):
            heads[self.parents[node]] += heads[node]
        out = [False] * len(self.parents)
        for node in range(1, len(out)):
            out[node] = out[self.parents[node]]
            if node in self.marked and not out[node]:
                out[node] = not (2 * under[node] > under[0] and heads[node] == len(self.heads))
        self.blocks = [b for b in self.blocks if not out[b[0]]]
        self.heads = [h for h in self.heads if not out[h]]

    def _above(self, node: int) -> list[int]:
        """A container and those around it, from within."""
        found = []
        while node > 0:
            found.append(node)
            node = self.parents[node]
        return found

    def _whole(self, node: int) -> int:
        """The container that holds the whole article of which ``node`` has most text: the outermost
        article around it, else main, else the next one that has an h1 of its own; body is too wide."""
        above = self._above(node)
        for tag in ("article", "main"):
            around = [a for a in above if self.tags[a] == tag]
            if around:
                return around[-1]
        return next((a for a in above if a in self.heads and self.tags[a] != "body"), node)

    @staticmethod
    def _attributes(attrs: str) -> Iterator[tuple[str, str]]:
        for found in _ATTR.finditer(attrs):
            yield found[1].lower(), (found[2] or found[3] or found[4] or "").lower()

    def _other(self, attrs: str) -> bool:
        if "class" not in attrs and "id" not in attrs and "role" not in attrs and "hidden" not in attrs:
            lowered = attrs.lower()
            if "class" not in lowered and "id" not in lowered and "role" not in lowered:
                return False
        for _, value in self._attributes(attrs):
            if not OTHER_WORDS.isdisjoint(_WORD.findall(value)):
                return True
        return False

    def _name(self, tag: str, attrs: str) -> str:
        classes = next((v for k, v in self._attributes(attrs) if k == "class"), "") if attrs else ""
        return ".".join([tag, *sorted(set(_DIGITS.sub("#", classes).split()))])

    def scores(self) -> list[float]:
        """Text that stands in a container, links not counted, and half of its children's score."""
        return self._running(0.5)

    def _running(self, part: float) -> list[float]:
        """Text that stands in a container, links not counted, and ``part`` of its children's figure."""
        out = [0.0] * len(self.parents)
        for holder, block, linked in self.blocks:
            out[holder] += max(0, len(block) - 2 * linked)
        for node in range(len(out) - 1, 0, -1):
            if self.parents[node] >= 0:
                out[self.parents[node]] += part * out[node]
        return out

    def votes(self) -> dict[str, float]:
        """Share of each path in the page's score."""
        out: dict[str, float] = {}
        for path, score in zip(self.paths, self.scores()):
            if score > 0 and path:
                out[path] = max(out.get(path, 0.0), score)
        total = sum(out.values())
        return {path: score / total for path, score in out.items()}

    def text(self, paths: list[str]) -> tuple[str, str | None]:
        """Text of the article around the first of ``paths`` that the page has, else around its best
        container; and the path of what was read."""
        have = {}
        for node, path in enumerate(self.paths):
            have.setdefault(path, []).append(node)
        for path in paths:
            if path in have:
                whole = [self._whole(node) for node in have[path]]
                found = self._under(set(whole))
                if found:
                    return found, self.paths[whole[0]]
        scores = self.scores()
        best = max(range(len(scores)), key=lambda i: (scores[i], -i))
        best = self._whole(best)
        return self._under({best}), self.paths[best] or None

    def _under(self, nodes: set[int]) -> str:
        inside: dict[int, bool] = {-1: False}
        for node, parent in enumerate(self.parents):
            inside[node] = node in nodes or inside[parent]
        return "\n\n".join(block for holder, block, _ in self.blocks if inside[holder])


def path_votes(pages: DataFrame) -> DataFrame:
    """Votes per host and path, summed over all pages."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sums: dict[tuple[str, str], list[float]] = {}
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for path, share in Page(text or "").votes().items():
                        entry = sums.setdefault((name, path), [0.0, 0])
                        entry[0] += share
                        entry[1] += 1
                keys = list(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                     pa.array([sums[k][0] for k in keys], pa.float64()), pa.array([sums[k][1] for k in keys], pa.int64())],
                    ["host", "path", "votes", "pages"],
                )

    rows = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(
        read, "host string, path string, votes double, pages long"
    )
    # Rounding makes the sums, and so the choice, independent of the order of addition.
    return rows.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"), F.sum("pages").alias("pages"))


def chosen_paths(votes: DataFrame, paths: int = PATHS) -> DataFrame:
    """The paths of each host with the most votes, best first; ties by path."""
    rank = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    best = votes.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= paths)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "path")))
    return best.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def _packed(texts: list[str | None]) -> list[list]:
    """Pages as they travel to their host's paths."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return [[pack(t.encode("utf-8", "surrogatepass")) if t else None for t in texts]]


def extract_text(pages: DataFrame, paths: int = PATHS, salts: int = SALTS) -> DataFrame:
    """Append ``text``, ``n_chars`` and ``content_path`` to every row of ``pages``.

    Null, empty and text-free pages give an empty text; a null or odd url counts as a host of
    its own name, the empty one. Equal votes go to the path that sorts first. Repeated rows
    vote and are read each; an empty table stays empty; long pages are read whole. The html is
    dropped; other columns are carried along, and columns named like a result are replaced by it.
    """
    chosen = chosen_paths(path_votes(pages), paths)
    added = ["text", "n_chars", "content_path"]
    keep = without(pages, [*added, "html"])
    rows = pages.select(
        *[F.col(f"`{c}`") for c in keep],
        pages["html"].alias("__html"),
        host(pages["url"]).alias("__host"),
        F.pmod(F.xxhash64(pages["html"]), F.lit(salts)).cast("int").alias("__salt"),
    )
    spread = chosen.select(
        F.col("host").alias("__host"), "paths", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    )
    rows = append_columns(rows, ["__html"], "__packed binary", _packed).drop("__html")
    rows = rows.join(spread, ["__host", "__salt"], "left").select(*[F.col(f"`{c}`") for c in keep], "__packed", "paths")
    schema = T.StructType([*rows.schema.fields[: len(keep)], *T.StructType.fromDDL("text string, n_chars long, content_path string").fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, unpack = len(keep), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in slices(batch):
                found = [
                    Page(unpack(data).decode("utf-8", "surrogatepass") if data else "").text(names or [])
                    for data, names in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist())
                ]
                arrays = [
                    pa.array([t for t, _ in found], pa.string()),
                    pa.array([len(t) for t, _ in found], pa.int64()),
                    pa.array([p for _, p in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *arrays], [*part.schema.names[:n], *added])

    return rows.mapInArrow(read, schema)


def op10_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


QUERIES = {"op10_host_paths": op10_host_paths}
ORACLES: dict[str, str] = {}
