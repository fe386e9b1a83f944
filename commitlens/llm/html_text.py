"""Operator 2: main text of web pages.

Markup tells what stands in menus, headers, footers, adverts, comments and the
like, and which part a page declares as its main one, such as an article. The host
tells the rest: a suffix array over the token streams of its pages, chrome included,
finds the substrings of `MIN_TOKENS` tokens and more that a real share of the pages
repeat. A host of any size is dealt out in parts, each with a suffix array of its
own; what is frequent on the host is frequent in one of them, and is then counted
over all. On pages without a main part such tokens are removed and the runs between
them are kept. A block of a main part goes if all of it is repeated so by the host's
main texts and by what its pages mark as chrome as well.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.components import connected_components
from commitlens.llm.tokens import slices
from commitlens.scratch import stored

# Tokens of the shortest substring that counts as repeated; a power of two.
MIN_TOKENS = 8
# Share of a host's distinct pages, two at least, that hold what is boilerplate there.
MIN_SHARE = 0.5
# Smallest values of so many hashes stand for a page's pairs of tokens; pages that agree
# in this share of them are near copies. Bands of so many find those to compare.
SKETCH, NEAR, BAND = 64, 0.75, 4
# Tokens of a host's pages that one suffix array takes, about. Results never depend on it.
PART_TOKENS = 1 << 18

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is never shown, or is no text of the page.
_SILENT = set(
    "script style noscript template title iframe object svg math canvas audio video map datalist".split()
)
# What may stand in a head besides void elements; anything else ends it.
_IN_HEAD = set("title script style noscript template".split())
_CHROME = set("nav footer aside form dialog menu select button textarea".split())
_BLOCKS = set(
    "address article aside blockquote body caption center details dd dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table "
    "tbody tfoot thead tr ul".split()
)
# What a start tag closes, if that is the innermost block.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
# Words of a class, id or role that mark what is not main text.
_CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs footer masthead comment "
    "comments commentlist respond disqus share sharing social related recommended newsletter subscribe subscription "
    "popup modal overlay pagination pager widget widgets toolbar skip login signup search complementary contentinfo "
    "hidden".split()
)
# Whole class names that mark chrome within a main part too.
_CHROME_NAMES = _CHROME_WORDS | set(
    "comment-list comments-area comment-body comment-respond related-posts related-articles social-share share-buttons "
    "cookie-notice cookie-banner post-navigation site-footer newsletter-signup".split()
)
# Within a main part a compound name marks chrome if one word says so and all others are plain parts of pages.
_CHROME_HEADS = set(
    "ad ads advert adverts advertisement comment comments disqus share sharing sponsor sponsored promo cookie cookies "
    "newsletter subscribe".split()
)
_PAGE_PARTS = set(
    "area bar block body box buttons container content count entry form frame group header holder inner item items "
    "links list main outer panel placeholder post reader readers reply replies respond row section site slot social "
    "thread title unit user users visitor widget wrap wrapper".split()
)
# Their ids name places in the text.
_NAMED_PLACES = set("h1 h2 h3 h4 h5 h6 section article p a span".split())
_MAIN_WORDS = {"articlebody", "post-content", "entry-content", "article-content", "article-body", "post-body", "main-content"}
# But these say what a section is.
_COMMENT_IDS = set("comments comment-list commentlist reader-comments user-comments disqus_thread respond".split())
_WORDS = re.compile(r"[a-z]+")
_NAMES = re.compile(r"[^\s]+")


def _is_chrome_name(name: str) -> bool:
    """Is a whole or compound name, such as reader-comments or ad-slot but not related-work, that of chrome?"""
    words = set(_WORDS.findall(name))
    return name in _CHROME_NAMES or (not _CHROME_HEADS.isdisjoint(words) and words <= _CHROME_HEADS | _PAGE_PARTS)


class _Page(HTMLParser):
    """Blocks of text, each with the strength of the main part it stands in, 0 for none."""

    def __init__(self, chrome: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        # Whether text in chrome is text as well.
        self.chrome = chrome
        self.blocks: list[tuple[int, str]] = []
        self.text: list[str] = []
        # Blocks of text in chrome, where that is no text.
        self.beside: list[str] = []
        self.aside: list[str] = []
        # Open elements: tag, whether its text is chrome (1) or never shown (2), strength of the main part around.
        self.open: list[tuple[str, int, int]] = [("", 0, 0)]

    def _flush(self) -> None:
        words = " ".join("".join(self.text).split())
        self.text.clear()
        if words:
            self.blocks.append((self.open[-1][2], words))
        if self.aside:
            words = " ".join("".join(self.aside).split())
            self.aside.clear()
            if words:
                self.beside.append(words)

    def parse_comment(self, i: int, report: bool = True) -> int:
        # Pages are fed whole, so a comment without an end goes on to the page's end.
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def _end_head(self) -> None:
        """Leave a head whose end tag was left out."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == "head":
                del self.open[i:]
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            if tag == "hr":
                self._flush()
            elif tag in ("br", "img"):
                self.text.append(" ")
            return
        if self.open[-1][0] == "head" and tag not in _IN_HEAD:
            self._end_head()
        if tag in ("td", "th"):
            self.text.append(" ")
        if tag in _BLOCKS:
            self._flush()
            self._close_before(tag)
        _, drops, main = self.open[-1]
        strength = self._strength(tag, attrs)
        if tag in _SILENT:
            drops = 2
        elif not drops and not self.chrome:
            chrome = tag in _CHROME or (tag == "header" and not main) or self._is_chrome(tag, attrs, strength, main > 0)
            drops = int(chrome)
        self.open.append((tag, drops, main if drops else max(main, strength)))

    def _close_before(self, tag: str) -> None:
        """End the paragraph or item that `tag` ends without saying so."""
        closes = _CLOSES.get(tag, set()) | {"p"}
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name in closes:
                del self.open[i:]
                return
            if name in _BLOCKS:
                return

    @staticmethod
    def _is_chrome(tag: str, attrs: list[tuple[str, str | None]], strength: int, in_main: bool) -> bool:
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True
            if name == "id" and tag in _NAMED_PLACES:
                if tag in ("section", "article") and value.strip() in _COMMENT_IDS:
                    return True
                continue
            names = set(value.split())
            if name in ("class", "id", "role") and not strength and tag not in ("html", "body"):
                # Within the main part a word of a name, as in related-work, says nothing.
                found = any(map(_is_chrome_name, names)) if in_main else not _CHROME_NAMES.isdisjoint(names.union(_WORDS.findall(value)))
                if found:
                    return True
            elif name == "class" and tag == "article":
                if "related" in names or any(_is_chrome_name(n) and not _CHROME_HEADS.isdisjoint(_WORDS.findall(n)) for n in names):
                    return True
        return False

    @staticmethod
    def _strength(tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag == "article":
            return 3
        if tag == "main":
            return 2
        for name, value in attrs:
            value = (value or "").lower()
            if name == "role" and value in ("main", "article"):
                return 2
            if name in ("class", "id", "itemprop") and not _MAIN_WORDS.isdisjoint(_NAMES.findall(value)):
                return 1
        return 0

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                # An end without a start, such as a stray </div>, ends nothing.
                if tag in _BLOCKS:
                    self._flush()
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head":
            if not data.strip():
                return
            self._end_head()
        if not (drops := self.open[-1][1]):
            self.text.append(data)
        elif drops == 1:
            self.aside.append(data)


def page_parts(html: str | None) -> tuple[bool, list[str], list[str]]:
    """As `page_blocks`, and the blocks of chrome."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page._flush()
    main = [words for strength, words in page.blocks if strength]
    return bool(main), main or [words for _, words in page.blocks], page.beside


def page_blocks(html: str | None) -> tuple[bool, list[str]]:
    """Blocks of text without chrome; whether the page declares main parts, all of which they then are."""
    return page_parts(html)[:2]


def shown_blocks(html: str | None) -> list[str]:
    """All blocks of text, chrome included."""
    page = _Page(chrome=True)
    page.feed(html or "")
    page.close()
    page._flush()
    return [words for _, words in page.blocks]


def host_of(url: str | None) -> str:
    """Lower-cased host of an address; empty if it has none."""
    rest = (url or "").partition("://")[2] or (url or "").removeprefix("//")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


# --- Suffixes, on plain arrays ---------------------------------------------------


def _combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(tokens: list[str]) -> np.ndarray:
    """A hash of the first `MIN_TOKENS` tokens of each suffix that has as many.

    Made by doubling: each step joins two neighbours of half the length. A stream
    with fewer tokens is one window.
    """
    out = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)
    length = 1
    while length < MIN_TOKENS and len(out) > length:
        out, length = _combine(out[:-length], out[length:]), length * 2
    return out if length == MIN_TOKENS else out[:1]


def _stream(blocks: list[str]) -> list[str]:
    return [token for block in blocks for token in block.split()]


def suffix_array(streams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes of the streams, by prefix doubling.

    Returns the suffixes' places in the streams, written one after the other with an
    end of its own after each; the length of the prefix that each shares with the
    suffix before it; and the place at which each stream begins.
    """
    sizes = np.array([len(tokens) + 1 for tokens in streams], np.int64)
    begins = np.cumsum(sizes) - sizes
    ends = begins + sizes - 1
    n, words = int(sizes.sum()), {}
    rank = np.empty(n, np.int64)
    inner = np.ones(n, bool)
    inner[ends] = False
    rank[inner] = np.fromiter((words.setdefault(t, len(words)) for tokens in streams for t in tokens), np.int64, n - len(streams))
    # No two ends are equal, so no prefix that is shared goes over one.
    rank[ends] = len(words) + np.arange(len(streams))
    # A suffix's rank is the first slot of those with the same prefix; only slots that share one are sorted again.
    order = np.argsort(rank, kind="stable")
    key, slots, ranks, length = rank[order], np.arange(n), [], 1
    while True:
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0))
        ranks.append(rank.astype(np.int32))
        slots = slots[~(fresh & np.concatenate((fresh[1:], [True])))]
        if not len(slots):
            break
        # What shares so much with another goes on beyond it.
        at = order[slots]
        key = rank[at] * n + rank[at + length]
        again = np.argsort(key, kind="stable")
        order[slots], key, length = at[again], key[again], length * 2
    shared = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        step = np.zeros(n - 1, np.int64)
        step[inside] = (ranks[level][a[inside]] == ranks[level][b[inside]]) * (1 << level)
        a, b = a + step, b + step
        shared[1:] += step
    return order, shared, begins


def repeats_in(
    streams: list[list[str]], groups: list[int], sought: list[bool], least: float
) -> list[tuple[int, int]]:
    """Windows of the repeated substrings that sought streams of at least so many groups hold: hash, groups."""
    # A repeat of `MIN_TOKENS` tokens or more is a run of the suffix array whose neighbours share as much.
    order, shared, begins = suffix_array(streams)
    stream = np.searchsorted(begins, order, side="right") - 1
    sizes = np.array([len(tokens) for tokens in streams], np.int64)
    left = begins[stream] + sizes[stream] - order
    run = np.cumsum(shared < MIN_TOKENS)
    names, group = np.unique(np.array(groups, np.int64), return_inverse=True)
    counts = (left >= MIN_TOKENS) & np.array(sought, bool)[stream]
    pairs = np.unique(run[counts] * len(names) + group[stream[counts]])
    runs, held = np.unique(pairs // len(names), return_counts=True)
    frequent, held = runs[held >= least], held[held >= least]
    # The first suffix of a run stands for all of it.
    first = np.searchsorted(run, frequent)
    hashes: dict[int, np.ndarray] = {}
    found = []
    for s, at, n in zip(stream[first].tolist(), (order[first] - begins[stream[first]]).tolist(), held.tolist()):
        if s not in hashes:
            hashes[s] = window_hashes(streams[s]).view(np.int64)
        found.append((int(hashes[s][at]), n))
    # A stream with fewer tokens is one window.
    short: dict[int, set[int]] = {}
    for tokens, name, wanted in zip(streams, groups, sought):
        if wanted and 0 < len(tokens) < MIN_TOKENS:
            short.setdefault(int(window_hashes(tokens).view(np.int64)[0]), set()).add(name)
    return found + [(window, len(held_by)) for window, held_by in short.items() if len(held_by) >= least]


def _covered(tokens: list[str], repeated: set[int]) -> np.ndarray:
    """Which tokens stand in repeated windows."""
    covered = np.zeros(len(tokens), bool)
    marks = np.isin(window_hashes(tokens).view(np.int64), np.fromiter(repeated, np.int64, len(repeated)))
    for i in np.flatnonzero(marks).tolist():
        covered[i : i + MIN_TOKENS] = True
    return covered


def without_blocks(blocks: list[str], repeated: set[int]) -> tuple[list[str], int]:
    """Blocks, all if none were left, without those that repeated windows cover whole; tokens of those left out."""
    tokens = _stream(blocks)
    if not tokens or not repeated:
        return blocks, 0
    covered, kept, at = _covered(tokens, repeated), [], 0
    for block in blocks:
        size = len(block.split())
        if not covered[at : at + size].all():
            kept.append(block)
        at += size
    return (kept, len(tokens) - len(_stream(kept))) if kept else (blocks, 0)


def without_windows(blocks: list[str], repeated: set[int]) -> tuple[list[str], int]:
    """Blocks without the tokens of repeated windows, and how many those were."""
    tokens = _stream(blocks)
    if not tokens or not repeated:
        return blocks, 0
    covered, kept, at = _covered(tokens, repeated), [], 0
    for block in blocks:
        words = block.split()
        run = " ".join(w for w, c in zip(words, covered[at : at + len(words)]) if not c)
        at += len(words)
        if run:
            kept.append(run)
    return kept, int(covered.sum())


# --- Over the table --------------------------------------------------------------

_PARSED = "page_id long, url string, host string, declared boolean, blocks array<string>, beside array<string>, tokens long"
_STREAMS = "host string, page long, `group` long, size int, stream binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as blocks of text and blocks of chrome."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64()]
    for batch in batches:
        for part in slices(batch):
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in part.columns)):
                declared, blocks, beside = page_parts(html)
                # Words of a block stand one space apart.
                tokens = sum(block.count(" ") + 1 for block in blocks + beside)
                rows.append((page_id, url, host_of(url), declared, blocks, beside, tokens))
            if rows:
                names = ["page_id", "url", "host", "declared", "blocks", "beside", "tokens"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the pages that declare their main part, chrome included."""
    for batch in batches:
        for part in slices(batch):
            rows = [
                (host_of(url), shown_blocks(html))
                for url, html in zip(part.column("url").to_pylist(), part.column("html").to_pylist())
                if page_blocks(html)[0]
            ]
            hosts, blocks = zip(*rows) if rows else ((), ())
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(blocks, pa.list_(pa.string()))], ["host", "blocks"])


def _packed(blocks: list[str], beside: list[str]) -> tuple[int, bytes]:
    raw = (" ".join(_stream(blocks)) + "\n" + " ".join(_stream(beside))).encode()
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(size: int, stream: bytes) -> list[list[str]]:
    raw = pa.decompress(stream, decompressed_size=size, codec="zstd", asbytes=True)
    return [part.split(" ") if part else [] for part in raw.decode().split("\n")]


def _name(host: str, tokens: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join([host, *tokens])) >> 1


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token streams of pages, each a group of its own; copies that a task meets go on once."""
    seen: set[int] = set()
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    for batch in batches:
        for part in slices(batch):
            rows = []
            for host, blocks, beside in zip(*(part.column(c).to_pylist() for c in ("host", "blocks", "beside"))):
                tokens, chrome = _stream(blocks), _stream(beside)
                page = _name(host, [*tokens, "\n", *chrome])
                if (tokens or chrome) and page not in seen:
                    seen.add(page)
                    rows.append((host, page, page, *_packed(blocks, beside)))
            columns = zip(*rows) if rows else [()] * len(kinds)
            names = ["host", "page", "group", "size", "stream"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def sketch_of(tokens: list[str]) -> np.ndarray:
    """Smallest value of each of `SKETCH` hashes over the stream's pairs of tokens."""
    words = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)
    pairs = np.unique(_combine(words[:-1], words[1:]) if len(words) > 1 else words)
    seeds = [np.uint64(xxhash.xxh3_64_intdigest(str(i))) for i in range(SKETCH)]
    return np.array([_combine(pairs ^ seed, pairs).min() for seed in seeds], np.uint64).view(np.int64)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with tokens, each named by the hash of its host and stream, so that copies are one."""
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        for host, blocks in zip(batch.column("host").to_pylist(), batch.column("blocks").to_pylist()):
            if tokens := _stream(blocks):
                rows.append((host, _name(host, tokens), sketch_of(tokens).tolist(), len(tokens), *_packed(blocks, [])))
        columns = zip(*rows) if rows else [()] * len(kinds)
        names = ["host", "page", "sketch", "tokens", "size", "stream"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _grouped(pages: DataFrame) -> DataFrame:
    """Streams of `(host, blocks)`, near copies in one group, named by its smallest page."""
    named = stored(
        pages.select("host", "blocks")
        .mapInArrow(_named, "host string, page long, sketch array<long>, tokens long, size int, stream binary")
        .dropDuplicates(["page"])
    )
    cuts = F.sequence(F.lit(1), F.lit(SKETCH), F.lit(BAND))
    bands = F.transform(cuts, lambda at: F.xxhash64(at, F.slice("sketch", at, BAND)))
    banded = stored(named.select("host", "page", "sketch", F.explode(bands).alias("band")))
    # Each page is compared with one of its band: no group grows with its square.
    centres = stored(banded.groupBy("host", "band").agg(F.min(F.struct("page", "sketch")).alias("c")))
    same = F.aggregate(
        F.zip_with("sketch", "c.sketch", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b
    )
    links = banded.join(centres, ["host", "band"]).filter((F.col("page") > F.col("c.page")) & (same >= NEAR * SKETCH))
    roots = connected_components(links.select(F.col("page").alias("a"), F.col("c.page").alias("b")))
    return stored(
        named.join(roots, named["page"] == roots["node"], "left").select(
            "host", "page", F.coalesce("root", "page").alias("group"), "tokens", "size", "stream"
        )
    )


def _candidates(group: pa.Table) -> pa.Table:
    """Windows that are frequent in a part of a host, with the groups that hold them there.

    A row without a window says how many groups are named in the part, and how many at
    most hold a window that is not given.
    """
    pages = {row["page"]: row for row in group.to_pylist()}
    own = sum(page == row["group"] for page, row in pages.items())
    streams, groups, sought = [], [], []
    for row in pages.values():
        for tokens, text in zip(_unpacked(row["size"], row["stream"]), (True, False)):
            if tokens:
                streams.append(tokens)
                groups.append(row["group"])
                sought.append(text)
    first = next(iter(pages.values()))
    least = max(1, math.ceil(MIN_SHARE * own))
    if len(pages) > 1:
        found = repeats_in(streams, groups, sought, least)
    elif first["parts"] > 1:
        text = [window_hashes(tokens).view(np.int64) for tokens, wanted in zip(streams, sought) if wanted]
        found = [(window, 1) for window in np.unique(np.concatenate(text)).tolist()] if text else []
    else:
        found = []
    windows, held = zip((None, own), *found)
    return pa.table(
        {
            "host": pa.array([first["host"]] * len(windows), pa.string()),
            "window": pa.array(windows, pa.int64()),
            "held": pa.array(held, pa.int64()),
            "rest": pa.array([least - 1] * len(windows), pa.int64()),
        }
    )


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of its host's candidates each page holds, in its text or in its chrome."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    for batch in batches:
        for part in slices(batch):
            rows = []
            for host, group, size, stream, windows in zip(*(c.to_pylist() for c in part.columns)):
                for tokens, chrome in zip(_unpacked(size, stream), (False, True)):
                    if tokens:
                        own = np.unique(window_hashes(tokens).view(np.int64))
                        rows += [(host, w, group, chrome) for w in own[np.isin(own, windows)].tolist()]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "window", "group", "chrome"])


def repeats_of(streams: DataFrame, sizes: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """`(host, window, chrome)` that the texts of `MIN_SHARE` of a host's groups hold, two at least.

    `sizes` holds the host and tokens of each page, or of several at once.
    `chrome` says whether as many have it in their chrome too. No host has more
    windows than twice the tokens of its mean page.
    """
    parts = stored(sizes.groupBy("host").agg(F.ceil(F.sum("tokens") / part_tokens).alias("parts")))
    dealt = streams.join(parts, "host").withColumn("part", F.pmod("page", "parts"))
    found = stored(
        dealt.groupBy("host", "part").applyInArrow(_candidates, "host string, window long, held long, rest long")
    )
    hosts = stored(found.filter("window IS NULL").groupBy("host").agg(F.sum("held").alias("n"), F.sum("rest").alias("rest")))
    # As many groups as may hold a window: those counted in a part, elsewhere the most that none counted.
    most = F.col("more") + F.col("rest")
    sought = stored(
        found.filter("window IS NOT NULL")
        .groupBy("host", "window")
        .agg(F.sum(F.col("held") - F.col("rest")).alias("more"))
        .join(hosts, "host")
        .filter((most > 1) & (most >= MIN_SHARE * F.col("n")))
        .groupBy("host")
        .agg(F.collect_list("window").alias("windows"))
    )
    held = (
        streams.join(sought, "host")
        .select("host", "group", "size", "stream", "windows")
        .mapInArrow(_held, "host string, window long, `group` long, chrome boolean")
        .distinct()
        .groupBy("host", "window")
        .agg(F.count_if(~F.col("chrome")).alias("held"), F.count_if("chrome").alias("marked"))
        .join(hosts, "host")
    )
    least = F.greatest(F.lit(2), MIN_SHARE * F.col("n"))
    return stored(held.filter(F.col("held") >= least).select("host", "window", (F.col("marked") >= least).alias("chrome")))


def _by_host(repeats: DataFrame, name: str) -> DataFrame:
    return stored(repeats.groupBy("host").agg(F.collect_list("window").alias(name)))


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages without what their host repeats."""
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.bool_()]
    names = ["page_id", "url", "blocks", "n_boilerplate", "declared"]
    for batch in batches:
        for part in slices(batch):
            rows = []
            for page_id, url, declared, blocks, marked, repeated in zip(*(c.to_pylist() for c in part.columns)):
                kept, n = without_blocks(blocks, set(marked or ())) if declared else without_windows(blocks, set(repeated or ()))
                rows.append((page_id, url, kept, n, declared))
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def extract_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", part_tokens: int = PART_TOKENS
) -> DataFrame:
    """`(key, url, text, n_chars, declared, n_boilerplate)` of every page.

    `text` is the page's blocks joined by blank lines, in page order: those of its
    declared main part, or else all that is not chrome without the tokens that repeat
    on the host. Inside a block white space is one space. Of a declared main part,
    whole blocks go that half of the host's pages have in their texts and half mark as
    chrome, unless nothing were left; passages that articles share are text otherwise.
    `n_boilerplate` tokens went.

    A null html is an empty page and has an empty text. A page whose url has no host
    is a host of its own. Rows that repeat a page are rows each; they count as one page
    when repeats are sought, as do near copies where a page declares no main part.
    `part_tokens` bounds a suffix array, about; it never changes a result. An empty
    table gives no row; other columns are not read.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )
    own = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    # Parsed once, kept for all uses.
    parsed = stored(
        rows.mapInArrow(_parse, _PARSED).withColumn("host", F.when(F.col("host") == "", own).otherwise(F.col("host"))),
        compression="zstd",
    )
    streams = parsed.select("host", "blocks", "beside").mapInArrow(_streams, _STREAMS)
    marked = _by_host(repeats_of(streams, parsed, part_tokens).filter("chrome"), "marked")
    others = parsed.filter("NOT declared").select("host", "blocks")
    evidence = others
    if not others.isEmpty():
        # What declared pages show, chrome included, tells about the others of their host.
        beside = rows.mapInArrow(_show, "host string, blocks array<string>")
        evidence = evidence.unionByName(beside.join(stored(others.select("host").distinct()), "host", "leftsemi"))
    grouped = _grouped(evidence)
    repeated = _by_host(repeats_of(grouped, grouped, part_tokens), "repeated")
    text = F.array_join("blocks", "\n\n")
    return (
        parsed.join(marked, "host", "left")
        .join(repeated, "host", "left")
        .select("page_id", "url", "declared", "blocks", "marked", "repeated")
        .mapInArrow(_text, "page_id long, url string, blocks array<string>, n_boilerplate long, declared boolean")
        .select(
            F.col("page_id").alias(key),
            F.col("url").alias(url),
            text.alias("text"),
            F.length(text).cast("long").alias("n_chars"),
            "declared",
            "n_boilerplate",
        )
    )
