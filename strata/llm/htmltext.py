"""Main text of web pages by host suffix matching (operator 10).

The token streams of a host's pages are compared with each other: a run of at least
``run`` words that occurs on other pages of the host is boilerplate, what is left are
the unique runs. The order of suffixes needed for that is one by their first ``run``
words, so suffixes are keyed by a hash of these and Spark groups equal ones; suffixes
are taken where a word's hash is the least of its neighbourhood, which picks the same
places in every copy of a run. Keys carry their host, and counts are added up before
they are shuffled: a host with a third of all pages is no group of its own.

Markup decides what words cannot: scripts, menus, forms and the like are no text, and
in a page with an ``article`` only the article is. Inside an article a repeated run
counts as boilerplate only if it is on most pages of the host; elsewhere two pages do.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold, window_least, word_hashes, written


@dataclass(frozen=True)
class Params:
    #: words of a repeated run, and of the neighbourhood that picks its places
    run: int = 8
    near: int = 6
    #: share of a block's words that repeated runs must cover
    covered: float = 0.6
    #: inside an article: least pages, and least share of the host's pages
    article_pages: int = 5
    article_share: float = 0.5
    #: a page without an article that would keep less than this share of its words is a copy of others
    copy_left: float = 0.2
    #: repeated runs that are sent to every task (16 bytes each); more are joined instead
    broadcast_rows: int = 2_000_000


# -- fixed values: element names and the words of class, id and role that mark no main text
_RAW = "script|style|noscript|template|textarea|iframe|object|svg|math|canvas|audio|video|select|title"
_NO_TEXT = set(_RAW.split("|")) | {"head", "nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "datalist", "header"}
_BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
_INLINE_DROPPED = {"img", "input", "wbr"}
_MARKED = set(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promoted banner nav navbar navigation menu "
    "masthead header footer sidebar aside rail cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion related "
    "recommended recommendations breadcrumb breadcrumbs pagination pager toolbar widget widgets copyright skip search "
    "contentinfo complementary".split()
)
#: words that may stand beside them in a name of such a part; any other word makes it a name of something else
_BESIDE = set(
    "area article articles bar block body bottom box btn button buttons card center col column container content count desktop "
    "element first fixed form global group holder icon icons id info inline inner item items large last layer left link links "
    "list main mobile module more outer page panel parts popular post posts primary region responsive right row secondary "
    "section sections site slot small sticky story stories strip tag text theme thread title tool tools top unit wide window "
    "wrap wrapper you".split()
)

# Attributes as browsers read them: a value without quotes ends at a blank or ``>``, quotes
# elsewhere are letters like others. A tag that never ends takes the rest of the page. All
# repeats are possessive, so a page is read once whatever is in it.
_ATTRS = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+)|[\"'=])*+"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{_RAW})\b{_ATTRS}(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)")


def host_of(url: str | None) -> str:
    """Lower-case host of a URL; empty where there is none."""
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else ""


@dataclass
class Block:
    text: str
    #: inside an ``article`` (or ``main``)
    article: bool
    main: bool
    #: markup says: no main text
    dropped: bool


def _marks(name: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """(dropped, article, main) of an opening tag."""
    low = name.lower()
    dropped = low in _NO_TEXT and not (low == "header" and in_article)
    article, main = low == "article", low == "main"
    if attrs and "=" in attrs or "hidden" in attrs:
        for key, value in _NAMES.findall(attrs):
            key, value = key.lower(), value.strip("\"' ")
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                dropped = True
            elif key == "itemprop":
                article |= value == "articleBody"
                dropped |= value == "comment"
            elif key == "role" and value in ("main", "article"):
                article |= value == "article"
                main |= value == "main"
            elif key in ("class", "id", "role") and low not in ("html", "body", "main"):
                for token in value.split():
                    words = [w.lower() for w in _PARTS.findall(token)]
                    said = [w for w in words if w in _MARKED and not (w == "header" and in_article)]
                    dropped |= bool(said) and all(w in _MARKED or w in _BESIDE or w.isdigit() for w in words)
    return dropped, article, main


#: elements that end where one of these begins
_ENDED_BY = {
    "p": {"p"}, "option": {"option"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"},
    "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "li": {"li", "p"},
}


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order: references decoded, white space in a block made one space."""
    out: list[Block] = []
    held: list[str] = []
    # open elements: name, state, block elements up to it; and by name where they stand
    stack: list[tuple[str, tuple[bool, bool, bool], int]] = []
    open_at: dict[str, list[int]] = {}
    nothing = (False, False, False)  # dropped, article, main
    state = nothing

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(Block(text, state[1], state[2], state[0]))

    def pop() -> None:
        open_at[stack.pop()[0]].pop()

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m.group("name")
        if name is None:
            raw = m.group("raw")
            if raw and raw.lower() == "title":
                flush()
            continue
        low = name.lower()
        block = low in _BLOCKS
        if block:
            flush()
        if m.group("close"):
            where = open_at.get(low)
            if where:
                if not block and stack[-1][2] > stack[where[-1]][2]:
                    continue  # an inline end tag closes no blocks
                flush()
                upto = where[-1]
                while len(stack) > upto:
                    pop()
                state = stack[-1][1] if stack else nothing
            continue
        attrs = m.group("attrs")
        if low in _VOID or attrs.endswith("/"):
            continue
        if block and low in _ENDED_BY:
            mine = _ENDED_BY[low]
            while stack and (stack[-1][0] in mine or stack[-1][0] not in _BLOCKS):
                pop()
            state = stack[-1][1] if stack else nothing
        elif block and stack and stack[-1][0] == "p":
            pop()
            state = stack[-1][1] if stack else nothing
        dropped, article, main = _marks(low, attrs, state[1])
        fresh = (state[0] or dropped, state[1] or article, state[2] or main)
        if fresh != state:
            flush()
        if block or fresh != state:
            open_at.setdefault(low, []).append(len(stack))
            stack.append((low, fresh, (stack[-1][2] if stack else 0) + block))
            state = fresh
    if at < len(page):
        held.append(page[at:])
    flush()
    return out


def _host_key(host: str) -> int:
    value = 0xCBF29CE484222325
    for b in host.encode("utf-8", "surrogatepass"):
        value = ((value ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return value


@dataclass
class Streams:
    """The word streams of several pages, and where runs begin in them."""

    pages: list[list[Block]]
    hosts: np.ndarray
    #: offsets of the blocks in the words of all pages, and of the pages in the blocks
    block_at: np.ndarray
    page_at: np.ndarray
    #: places, keys and pages of the picked suffixes
    places: np.ndarray
    keys: np.ndarray
    owner: np.ndarray
    host_keys: np.ndarray


def streams(urls: list[str | None], pages: list[str | None], p: Params) -> Streams:
    blocks = [blocks_of(x) if x else [] for x in pages]
    hosts = np.array([_host_key(host_of(u)) for u in urls], dtype=np.uint64)
    words, at, _ = word_hashes([b.text for own in blocks for b in own])
    page_at = np.cumsum([0, *map(len, blocks)])
    ends = at[page_at] if len(at) else np.zeros(len(page_at), np.int64)
    places = np.zeros(0, np.int64)
    if len(words) >= p.run:
        least = window_least(words, p.near) if len(words) >= p.near else words[:0]
        picked = np.zeros(len(words), dtype=bool)
        if len(least):
            padded = np.concatenate((np.zeros(p.near - 1, np.uint64), least, np.zeros(p.near - 1, np.uint64)))
            picked = ~window_least(~padded, p.near) == words
        picked[ends[:-1][ends[:-1] < len(words)]] = True  # each page's first word too
        places = np.flatnonzero(picked)
        owner = np.searchsorted(ends, places, side="right") - 1
        inside = places + p.run <= ends[owner + 1]
        places, owner = places[inside], owner[inside]
        key = np.zeros(len(places), dtype=np.uint64)
        for i in range(p.run):
            key = key * np.uint64(0x9E3779B97F4A7C15) + words[places + i]
        key = fold(key ^ hosts[owner])
    else:
        owner, key = places, np.zeros(0, np.uint64)
    return Streams(blocks, hosts, at, page_at, places, key, owner, fold(hosts + np.uint64(1)))


def main_text(s: Streams, page: int, on_pages: np.ndarray, host_pages: int, p: Params) -> str:
    """The page's unique runs. ``on_pages``: for each picked suffix of the page, the pages of its run.

    Where repeated runs cover most of a block it goes, but for long unique runs; from
    other blocks the covered words go. A page that would be left with next to nothing is a copy
    of others, not boilerplate: runs must then be on most of the host's pages to go.
    """
    own = s.pages[page]
    if not own:
        return ""
    lo, hi = s.page_at[page], s.page_at[page + 1]
    at = s.block_at[lo : hi + 1] - s.block_at[lo]
    mine = s.owner == page
    places = s.places[mine] - s.block_at[lo]
    words = np.diff(at)

    def kept(least: float) -> np.ndarray:
        """Words that stay when runs that so many pages have go."""
        edge = np.zeros(int(at[-1]) + 1, dtype=np.int64)
        begins = places[on_pages >= least]
        np.add.at(edge, begins, 1)
        np.add.at(edge, begins + p.run, -1)
        stays = np.cumsum(edge)[:-1] == 0
        if stays.all():
            return stays
        upto = np.concatenate(([0], np.cumsum(~stays)))
        full = np.flatnonzero(upto[at[1:]] - upto[at[:-1]] >= p.covered * np.maximum(words, 1))
        for b in full:
            # the ends of a run can be missed: what stays of a covered block is long
            part = stays[at[b] : at[b + 1]]
            cuts = np.flatnonzero(np.diff(np.concatenate(([0], part.view(np.int8), [0]))))
            for i, j in zip(cuts[::2], cuts[1::2]):
                if j - i < 2 * p.run:
                    part[i:j] = False
        return stays

    article, main = any(b.article and not b.dropped for b in own), any(b.main and not b.dropped for b in own)
    inside = np.array([not b.dropped and (b.article if article else b.main if main else True) for b in own])
    wanted = np.repeat(inside, words)
    most = max(p.article_pages, p.article_share * host_pages)
    stays = kept(most if article or main else 2) & wanted
    if not (article or main) and stays.sum() < p.copy_left * wanted.sum():
        stays = kept(most) & wanted
    if stays.sum() < (wanted.sum() / 2 if article or main else 1):
        stays = wanted  # copies of one text, not boilerplate in many
    out = []
    for b, i, j in zip(own, at[:-1], at[1:], strict=True):
        part = stays[i:j]
        if j > i and part.any():
            out.append(b.text if part.all() else " ".join([w for w, x in zip(b.text.split(" "), part.tolist(), strict=True) if x]))
    return " ".join(out)


def extract(pages: DataFrame, params: Params = Params(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page.

    A null or empty page has the text "". Pages without a host form a host of their own.
    Rows with the same id count as distinct pages and each gets its text. Whole pages
    are read, each in time that follows its length whatever its markup; a page's own
    repeats do not count, only other pages do. Pages with one text (copies, print
    versions) keep it. Runs of 13 words and more are always found; shorter ones, of 8 and
    more, if one of their suffixes is picked. Other columns are not read, so their
    names do not matter.
    """
    p = params
    spark = pages.sparkSession
    source = pages.select(pages[id_col].alias("key"), pages[url_col].alias("url"), pages[html_col].alias("html"))

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Streams]]:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            yield part, streams(part.column("url").to_pylist(), part.column("html").to_pylist(), p)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, s in parts(batch):
                both = np.unique(np.column_stack((s.owner.astype(np.uint64), s.keys)), axis=0)[:, 1] if len(s.keys) else s.keys
                keys, n = np.unique(np.concatenate((both, s.host_keys)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int32))], names=["run", "n"])

    repeated = written(
        source.mapInArrow(count, "run bigint, n int").groupBy("run").agg(F.sum("n").alias("n")).where("n > 1"), "html-runs"
    )
    kind = pages.schema[id_col].dataType.simpleString()
    shape = f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint"

    def texts(part: pa.RecordBatch, s: Streams, look: callable) -> pa.RecordBatch:
        on, hosts = look(s.keys), look(s.host_keys)
        out = [main_text(s, i, on[s.owner == i], int(hosts[i]), p) for i in range(part.num_rows)]
        return pa.RecordBatch.from_arrays(
            [part.column("key"), part.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], names=[id_col, url_col, "text", "n_chars"]
        )

    def finder(runs: np.ndarray, n: np.ndarray):
        def look(keys: np.ndarray) -> np.ndarray:
            if not len(runs):
                return np.ones(len(keys), dtype=np.int64)
            at = np.minimum(np.searchsorted(runs, keys), len(runs) - 1)
            return np.where(runs[at] == keys, n[at], 1)

        return look

    if repeated.count() <= p.broadcast_rows:
        table = repeated.toArrow()
        runs = table.column("run").to_numpy().view(np.uint64)
        order = np.argsort(runs)
        shared = spark.sparkContext.broadcast((runs[order], table.column("n").to_numpy()[order]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = finder(*shared.value)
            for batch in batches:
                for part, s in parts(batch):
                    yield texts(part, s, look)

        return source.mapInArrow(run, shape)

    # beyond the bound: each page gets its own repeated runs by joins; a run of a hot
    # host is split among tasks by the page
    def own_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in parts(batch):
                rows = part.column("row").to_numpy()
                owner = np.concatenate((s.owner, np.arange(part.num_rows)))
                keys = np.concatenate((s.keys, s.host_keys))
                yield pa.RecordBatch.from_arrays([pa.array(rows[owner]), pa.array(keys.view(np.int64))], names=["row", "run"])

    numbered = written(source.withColumn("row", F.monotonically_increasing_id()), "html-rows")
    mine = (
        numbered.mapInArrow(own_runs, "row bigint, run bigint").join(repeated, "run")
        .groupBy("row").agg(F.collect_list(F.struct("run", "n")).alias("runs"))
    )

    def with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, s in parts(batch):
                have = np.array(sorted({(r["run"] & 0xFFFFFFFFFFFFFFFF, r["n"]) for x in part.column("runs").to_pylist() for r in x or ()}), dtype=np.uint64).reshape(-1, 2)
                yield texts(part, s, finder(have[:, 0], have[:, 1].astype(np.int64)))

    return numbered.join(mine, "row", "left").select("key", "url", "html", "runs").mapInArrow(with_runs, shape)
