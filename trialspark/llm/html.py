"""Main text of web pages by suffix arrays over the pages of a host."""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import slices, written
from trialspark.llm.recompress import mix, word_names

#: Bytes of text that are compared with each other; larger hosts are dealt into several such parts.
PART_CHARS = 1_500_000
#: Tokens of the shortest repeat.
REPEAT = 8
#: A repeat stands in so many pages of a host: as a number, and as a share of the host's pages.
REPEAT_PAGES, REPEAT_SHARE = 3, 0.05
#: In an article even a repeat is text, unless it stands in more than this share of at least so many pages.
ARTICLE_SHARE, ARTICLE_PAGES = 0.5, 8

_OPENING = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_QUOTED = re.compile(r"(?:\"[^\"]*\"|'[^']*'|[^'\"])*")
_COMMENT = re.compile("<!--")
_CUT_OFF = re.compile(r"<[/!?a-zA-Z]")
_MARKS = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PIECES = re.compile(r"[^a-z0-9]+")
_RAW_END = re.compile(r"</([a-zA-Z]+)(?=[\s/>])")

# Elements and names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_DROPPED = frozenset(
    "head nav footer aside form button select dialog menu object svg canvas audio video fieldset".split()
)
_MAIN = frozenset("article main".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead title tr ul".split()
)
_HINTED = frozenset("div section ul ol dl table p span li figure header td tr a center blockquote".split())
_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe signup sidebar widget related "
    "recommended recommendations share sharing social comment comments disqus respond reply replies menu nav "
    "navbar navigation breadcrumb breadcrumbs footer pagination pager login search toolbar masthead complementary "
    "contentinfo".split()
)

_COMMENTS = frozenset("comment comments disqus respond reply replies".split())
_STATED = frozenset("no not non has have with without".split())
_CELLS = frozenset("td th caption table".split())
_TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
_HEAD = frozenset("base basefont bgsound link meta".split()) | _RAW
_INLINE = frozenset(["a", "span"])
#: Elements whose nesting is followed.
_NESTED = (_BLOCK | _HINTED | _DROPPED | _CELLS) - _VOID
#: An opening tag ends these elements, whose end tags may be omitted, unless one of those stands between.
_ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, {"dl", "table"})),
    **dict.fromkeys(("td", "th"), ({"td", "th", "caption"}, {"table"})),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (_TABLE - {"table"}, {"table"})),
    **{name: ({name}, _CELLS) for name in ("a", "button", "select")},
}

NEUTRAL, MAIN = "1", "2"


class _Tags:
    """The tags of a page, found in time linear in its length, whatever is broken in it.

    A tag ends at the first ``>`` outside quotes. Mostly that is the next ``>``. Where a quote is open
    there, the ends from every quote and ``>`` of the page are worked out once, from the last to the first.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.places: list[int] | None = None

    def _end(self, at: int) -> int:
        """Behind the ``>`` that ends a tag whose attributes start at ``at``; -1 if none does."""
        page = self.page
        if at > self.last:
            return -1
        if self.places is None:
            close = page.find(">", at)
            if _QUOTED.fullmatch(page, at, close):
                return close + 1
            self.places = [m.start() for m in _MARKS.finditer(page)]
            self.ends = [-1] * (len(self.places) + 1)
            following: dict[str, int] = {}
            for k in range(len(self.places) - 1, -1, -1):
                mark = page[self.places[k]]
                if mark == ">":
                    self.ends[k] = self.places[k] + 1
                else:
                    pair = following.get(mark)
                    self.ends[k] = -1 if pair is None else self.ends[pair + 1]
                    following[mark] = k
        return self.ends[bisect_left(self.places, at)]

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, name in lower case (empty: a comment or declaration) and attributes."""
        page = self.page
        while m := _OPENING.search(page, at, self.last + 1) or _COMMENT.search(page, at):
            start = m.start()
            if m.group().startswith("<!--"):
                return start, (page.find("-->", m.end()) + 3) if page.find("-->", m.end()) >= 0 else len(page), False, "", ""
            if m.lastindex is None:
                return start, page.find(">", start) + 1, False, "", ""
            end = self._end(m.end())
            if end >= 0:
                return start, end, bool(m.group(1)), m.group(2).lower(), page[m.end() : end - 1]
            at = start + 1
        return None

    def without_open_end(self, at: int) -> str:
        """The text from ``at`` on, up to a tag that the end of the page cuts off."""
        cut = _CUT_OFF.search(self.page, max(at, self.last + 1))
        return self.page[at : cut.start()] if cut else self.page[at:]


def _behind_raw(page: str, name: str, at: int) -> int:
    """Where the scan goes on when a raw element has opened before ``at``: its content has no tags but its own end."""
    for m in _RAW_END.finditer(page, at):
        if m.group(1).lower() == name:
            return (page.find(">", m.end()) + 1) or len(page)
    return len(page)


def _hints(name: str, attributes: str) -> set[str]:
    """The hints in class, id and role; behind has, with, no and the like they tell of the page, not of the element."""
    found: set[str] = set()
    if attributes and (name in _HINTED or name in _MAIN or name == "form"):
        for value in _ATTRIBUTE.findall(attributes):
            for word in value.strip("\"'").lower().split():
                pieces = _PIECES.split(word)
                if not _HINTS.isdisjoint(pieces):
                    stated = next((i for i, piece in enumerate(pieces) if piece in _STATED), len(pieces))
                    found.update(_HINTS.intersection(pieces[:stated]))
    return found


class _Nesting:
    """The open elements, by the rules of HTML for end tags that are omitted, and what follows for the text.

    ``skip`` is the place of the element that is left out, ``comments`` that of the one in it that holds
    comments (-1: none). ``group`` tells apart the text of each article (from 1 on), that of a form around
    other elements (-1) and the rest (0); ``wrapped`` are articles that lie in an element that is left out.
    """

    def __init__(self) -> None:
        self.open: list[str] = []
        self.count: Counter[str] = Counter()
        self.skip = self.comments = -1
        self.group = self.articles = 0
        self.wrapped: set[int] = set()
        self._entered: list[tuple[int, int, int, int]] = []

    def cut(self, place: int) -> None:
        """All elements from this place on end."""
        self.count.subtract(self.open[place:])
        del self.open[place:]
        while self._entered and self._entered[-1][0] >= place:
            _, self.group, self.skip, self.comments = self._entered.pop()
        if self.skip >= place:
            self.skip = -1
        if self.comments >= place:
            self.comments = -1

    def _end(self, names, barriers) -> None:
        """End the outermost of the names that no barrier and no article hides."""
        found = -1
        if not any(self.count[name] for name in names):
            return
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place] in names:
                found = place
            elif self.open[place] in barriers or self.open[place] in _MAIN:
                break
        if found >= 0:
            self.cut(found)

    def close(self, name: str) -> None:
        if not self.count[name]:
            return
        hidden = () if name in _MAIN or name == "form" else ("table",) if name in _TABLE else _CELLS
        for place in range(len(self.open) - 1, -1, -1):
            own = self.open[place]
            if own == name:
                self.cut(place)
                return
            if own in hidden or (own in _MAIN and name not in _MAIN) or (name in _INLINE and own not in _INLINE):
                break
        if name in _INLINE and self.skip >= 0 and self.open[self.skip] == name:
            self.cut(self.skip)

    def start(self, name: str, attributes: str) -> None:
        if name == "form" and self.count["form"]:
            return
        if attributes.endswith("/") and (name == "svg" or self.count["svg"]):
            return
        if name in _BLOCK:
            self._end(("p",), _CELLS)
        if name in _ENDED:
            self._end(*_ENDED[name])
        place = len(self.open)
        self.open.append(name)
        self.count[name] += 1
        hints = _hints(name, attributes)
        comments = not hints.isdisjoint(_COMMENTS)
        if name in _MAIN:
            if self.skip >= 0 and name != "main":
                if self.comments >= 0 or comments:
                    self.comments = self.comments if self.comments >= 0 else place
                    return
                self._enter(place)
                self.wrapped.add(self.group)
                return
            self.skip = self.comments = -1
            if self.group <= 0:
                self._enter(place)
        elif self.skip >= 0:
            if comments and self.comments < 0:
                self.comments = place
        elif name == "form" and not self.group and not hints:
            self._entered.append((place, 0, -1, -1))
            self.group = -1
        elif name in _DROPPED or (name == "header" and self.group <= 0) or hints:
            self.skip = place
            self.comments = place if comments else -1

    def _enter(self, place: int) -> None:
        self._entered.append((place, self.group, self.skip, self.comments))
        self.skip = self.comments = -1
        self.articles += 1
        self.group = self.articles


def blocks_of(page: str) -> list[tuple[str, str]]:
    """The text blocks of a page that its markup doesn't rule out, each with its zone.

    Zone MAIN lies in an article or main element. Menus, page headers, footers, sidebars, forms,
    scripts, styles and elements whose class, id or role names them are left out. A main element ends
    what is left out. An article in it that isn't a comment is taken when it is as long as the longest
    article elsewhere or, where there is none, the articles in it are as long as the other text together;
    so is a form's text when it is as long as the text around. Character references are decoded and
    white space is one space.
    """
    out: list[tuple[str, int]] = []
    held: list[str] = []
    nest = _Nesting()
    at = 0

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, nest.group))

    def hold(text: str) -> None:
        if nest.skip >= 0 and nest.open[-1] == "head" and text.strip():
            nest.cut(len(nest.open) - 1)  # text isn't part of a head
        if nest.skip < 0:
            held.append(text)

    tags = _Tags(page)
    while found := tags.next(at):
        start, end, closing, name, attributes = found
        if start > at:
            hold(page[at:start])
        at = end
        if not name:
            continue
        if not closing and name in _RAW:
            if not attributes.endswith("/"):
                at = _behind_raw(page, name, at)
            continue
        if not closing and nest.open and nest.open[-1] == "head" and name not in _HEAD:
            nest.cut(len(nest.open) - 1)
        if name in _BLOCK:
            flush()
        if name in _NESTED:
            if closing:
                nest.close(name)
            else:
                nest.start(name, attributes)
        if name in ("br", "td", "th") and nest.skip < 0:
            held.append(" ")
    if at < len(page):
        hold(tags.without_open_end(at))
    flush()

    size = Counter()
    for text, group in out:
        size[group] += len(text)
    longest = max((n for g, n in size.items() if g > 0 and g not in nest.wrapped), default=0)
    if longest:
        left = {g for g in nest.wrapped if size[g] < longest}
    else:
        left = nest.wrapped if sum(size[g] for g in nest.wrapped) < size[0] + size[-1] else set()
    if size[-1] < size[0] or any(g > 0 and g not in left for g in size):
        left = left | {-1}
    return [(text, MAIN if group > 0 else NEUTRAL) for text, group in out if group not in left]


def _runs(tokens: np.ndarray, page: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of all runs of ``length`` tokens in suffix order, the group of equal runs of each, and a group's pages.

    ``tokens`` are the pages' streams one after the other, ``page`` is non-decreasing. The suffix
    array is sorted by doubling to the depth of the run: equal ranks are suffixes whose common
    prefix is long enough.
    """
    n = len(tokens)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < length:
        step_by = min(step, length - step)
        behind = np.full(n, -1, np.int64)
        behind[:-step_by] = rank[step_by:]
        rank = np.unique(rank * (n + 1) + behind + 1, return_inverse=True)[1].astype(np.int64)
        step += step_by
    whole = np.zeros(n, bool)  # suffixes that do not run into the next page
    whole[: n - length + 1] = page[length - 1 :] == page[: n - length + 1]
    array = np.flatnonzero(whole)
    array = array[np.lexsort((page[array], rank[array]))]
    r, p = rank[array], page[array]
    new_rank = np.ones(len(r), bool)
    new_rank[1:] = r[1:] != r[:-1]
    new_page = new_rank.copy()
    new_page[1:] |= p[1:] != p[:-1]
    group = np.cumsum(new_rank) - 1
    return array, group, np.bincount(group, new_page).astype(np.int64)


def _covering(array: np.ndarray, spread: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """For each token the most widespread run that covers it, from the ``spread`` of the runs at ``array``."""
    pages = np.zeros(len(page), np.int64)
    pages[array] = spread
    out = pages.copy()
    for k in range(1, min(length, len(page))):  # a repeat covers all its tokens
        np.maximum(out[k:], np.where(page[k:] == page[:-k], pages[:-k], 0), out=out[k:])
    return out


def repeats(tokens: np.ndarray, page: np.ndarray, length: int = REPEAT) -> np.ndarray:
    """For each token, in how many pages the most widespread repeat that covers it stands."""
    array, group, spread = _runs(tokens, page, length)
    return _covering(array, spread[group], page, length)


class _Pages:
    """The distinct token streams of a part, one after the other; rows with equal blocks are one page."""

    def __init__(self, table: pa.Table):
        squeezed, seen = table.column("squeezed"), {}
        self.of = [seen.setdefault(s, len(seen)) for s in table.column("stream").to_pylist()]  # the page of each row
        expand = zstandard.ZstdDecompressor().decompress
        self.texts: list[list[str]] = []
        for row, page in enumerate(self.of):
            if page == len(self.texts):
                text = expand(squeezed[row].as_py()).decode("utf-8", "surrogatepass")
                self.texts.append(text.split("\n") if text else [])
        words = [b.encode("utf-8", "surrogatepass").split() for own in self.texts for b in own]
        self.sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1  # a border stands before each block
        total = int(self.sizes.sum())
        self.tokens = np.full(total, mix(np.array([5], np.uint64))[0], np.uint64)
        self.first = np.cumsum(self.sizes) - self.sizes
        inner = np.ones(total, bool)
        inner[self.first] = False
        self.tokens[inner] = word_names([w for own in words for w in own])
        blocks = np.array([len(own) for own in self.texts], np.int64)
        self.block_at = np.cumsum(blocks) - blocks
        self.page = np.repeat(np.repeat(np.arange(len(blocks)), blocks), self.sizes)

    def mostly(self, tokens: np.ndarray) -> np.ndarray:
        """The blocks more than half of whose tokens are marked."""
        if not len(self.first):
            return np.zeros(0, bool)
        return 2 * np.add.reduceat(tokens.astype(np.int64), self.first) > self.sizes


def _kept(table: pa.Table, pages: _Pages, spread: np.ndarray, count: int) -> pa.Table:
    """The text of each row: ``spread`` of the pages' tokens in ``count`` distinct pages."""
    common = pages.mostly(spread >= _widespread(count))
    everywhere = pages.mostly((spread > ARTICLE_SHARE * count) & (count >= ARTICLE_PAGES))
    out = []
    for page, zone in zip(pages.of, table.column("zones").to_pylist()):
        has_main = MAIN in zone
        kept = []
        for at, (text, z) in enumerate(zip(pages.texts[page], zone), pages.block_at[page]):
            if (z == MAIN or not has_main) and not (everywhere if z == MAIN else common)[at]:
                kept.append(text)
        out.append("\n".join(kept))
    return pa.table(
        [*(table.column(n) for n in ("row", "page_id", "url")), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
        ["row", "page_id", "url", "text", "n_chars"],
    )


def _chosen(table: pa.Table) -> pa.Table:
    """The texts of a host that is one part."""
    pages = _Pages(table)
    return _kept(table, pages, repeats(pages.tokens, pages.page), len(pages.texts))


def _widespread(count):
    """So many pages of ``count`` make a repeat common: a number, or a column of numbers."""
    if isinstance(count, int):
        return max(REPEAT_PAGES, REPEAT_SHARE * count)
    return F.greatest(F.lit(float(REPEAT_PAGES)), F.lit(REPEAT_SHARE) * count)


def _named_runs(table: pa.Table) -> tuple[_Pages, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A part's pages, its runs, and the 64-bit name of each group of equal runs, which is the same in every part."""
    pages = _Pages(table)
    array, group, spread = _runs(pages.tokens, pages.page, REPEAT)
    start = array[np.searchsorted(group, np.arange(len(spread)))]
    name = np.full(len(start), 11, np.uint64)
    for k in range(REPEAT):
        name = mix(name * np.uint64(3) + pages.tokens[start + k])
    return pages, array, group, spread, name.view(np.int64)


def _run_rows(table: pa.Table, name: np.ndarray, spread: np.ndarray) -> pa.Table:
    host = table.column("host")[0].as_py() if table.num_rows else ""
    return pa.table([pa.array([host] * len(name), pa.string()), pa.array(name), pa.array(spread)], ["host", "run", "n"])


def _all_runs(table: pa.Table) -> pa.Table:
    """Every run of a part and the part's pages that hold it."""
    _, _, _, spread, name = _named_runs(table)
    return _run_rows(table, name, spread)


def _candidates(table: pa.Table) -> pa.Table:
    """The runs that can be common on the host: those are as frequent as that in one part at least."""
    pages, _, _, spread, name = _named_runs(table)
    count = table.column("pages")[0].as_py()
    can = spread * count >= _widespread(count) * len(pages.texts) - 1e-6
    return _run_rows(table, name[can], spread[can])


def _candidate_runs(table: pa.Table, candidates: pa.Table) -> pa.Table:
    """How many pages of a part hold each candidate of its host."""
    _, _, _, spread, name = _named_runs(table)
    asked = np.isin(name, candidates.column("run").to_numpy())
    return _run_rows(table, name[asked], spread[asked])


def _chosen_by_host(table: pa.Table, common: pa.Table) -> pa.Table:
    """The texts of a part by the common runs of the whole host."""
    pages, array, group, _, name = _named_runs(table)
    run, n = common.column("run").to_numpy(), common.column("n").to_numpy()
    spread = np.zeros(len(name), np.int64)
    if len(run):
        order = np.argsort(run)
        at = np.minimum(np.searchsorted(run, name, sorter=order), len(run) - 1)
        at = order[at]
        spread = np.where(run[at] == name, n[at], 0)
    count = table.column("pages")[0].as_py() if table.num_rows else 0
    return _kept(table, pages, _covering(array, spread[group], pages.page, REPEAT), count)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for whole in batches:
        for batch in slices(whole):
            found = [blocks_of(h.as_py()) for h in batch.column("html")]
            raw = ["\n".join(b for b, _ in page).encode("utf-8", "surrogatepass") for page in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    batch.column("host"),
                    pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                    pa.array(["".join(z for _, z in page) for page in found], pa.string()),
                    pa.array(list(map(len, raw)), pa.int64()),
                    pa.array(list(map(squeeze, raw)), pa.binary()),
                ],
                ["page_id", "url", "host", "stream", "zones", "size", "squeezed"],
            )


_PARSED = "page_id long, url string, host string, stream binary, zones string, size long, squeezed binary"
_RUNS = "host string, run long, n long"
_CHOSEN = "row long, page_id long, url string, text string, n_chars long"


def _texts(dealt: DataFrame, hosts: DataFrame) -> DataFrame:
    """The texts of pages that are dealt by host and part, by repeats counted over the whole host.

    Parts of many pages count candidates only: a run that stands in a share of a host's pages stands in
    that share of one part's pages at least. Parts of few pages, in which any run is a candidate, count all.
    """
    key = ["host", "part"]
    many = F.col("pages") * REPEAT_SHARE >= 2 * F.col("parts")
    done = dealt.where("parts = 1").groupBy(*key).applyInArrow(_chosen, _CHOSEN)

    def in_parts(runs: DataFrame) -> DataFrame:
        own = runs.join(hosts, "host").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        return own.select(*key, *(c for c in ("run", "n") if c in runs.columns)).groupBy(*key)

    for ample in (True, False):
        parts = dealt.where("parts > 1").where(many if ample else ~many).groupBy(*key)
        if ample:
            candidates = parts.applyInArrow(_candidates, _RUNS).select("host", "run").distinct()
            counted = parts.cogroup(in_parts(candidates)).applyInArrow(_candidate_runs, _RUNS)
        else:
            counted = parts.applyInArrow(_all_runs, _RUNS)
        common = counted.groupBy("host", "run").agg(F.sum("n").alias("n"))
        common = common.join(hosts, "host").where(F.col("n") >= _widespread(F.col("pages"))).select("host", "run", "n")
        done = done.unionByName(parts.cogroup(in_parts(common)).applyInArrow(_chosen_by_host, _CHOSEN))
    return done


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of each page, blocks joined by a line break.

    Pages of a host are compared: their token streams are put together, a suffix array finds the runs
    of at least :data:`REPEAT` tokens that stand in several pages, blocks that these cover for the most
    part are boilerplate, and the others are kept in page order. Where a page has an article or main
    element its text is taken from there, and only what most pages of the host repeat is removed from it.

    Rows of a host with equal blocks are one page: one of them is compared, and the others get its text by
    a join, for which they are worked out again instead of being kept. A host beyond :data:`PART_CHARS` is dealt into parts by a hash of the blocks, so no host is one task;
    the pages of a run are added up over its parts, so the texts do not depend on the dealing.
    Null html is empty and gives an empty text; a null url is a host of its own; repeated rows and
    null ids stay; an empty table gives no rows; other columns are not read.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
    )
    parsed = own.mapInArrow(_parsed, _PARSED).withColumn("row", F.monotonically_increasing_id())
    parsed = written(parsed, "pages")
    key = ["host", "stream", "zones"]
    classes = parsed.groupBy(*key).agg(F.min("row").alias("first"), F.count("*").alias("rows"), F.max("size").alias("size"))
    classes = written(classes, "page-classes")
    hosts = classes.groupBy("host", "stream").agg(F.max("size").alias("size")).groupBy("host").agg(
        F.count("*").alias("pages"), F.greatest(F.ceil(F.sum("size") / PART_CHARS), F.lit(1)).alias("parts")
    )
    hosts = written(hosts, "hosts")
    several = classes.where("rows > 1").select(*key, "first")
    copies = written(parsed.join(several, key).where("row <> first").select("row", "first", "page_id", "url"), "page-copies")
    copied = not copies.isEmpty()
    if copied:
        parsed = parsed.join(copies.select("row"), "row", "left_anti")
    dealt = parsed.join(hosts, "host").select(
        "host", F.pmod(F.xxhash64("stream"), "parts").alias("part"), "parts", "pages", "row", "page_id", "url", "stream", "zones",
        "squeezed",
    )
    texts = _texts(dealt, hosts)
    names = ["page_id", "url", "text", "n_chars"]
    if not copied:
        return texts.select(names)
    of_first = texts.select(F.col("row").alias("first"), "text", "n_chars")
    return texts.select(names).unionByName(copies.join(of_first, "first").select(names))
