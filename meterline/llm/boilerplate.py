"""Main text of web pages: what is repeated across the pages of a host is boilerplate, what is unique is content.

The pages of a host are cut into blocks of text, and the blocks' words are put in one stream. A suffix array of the stream,
ordered by the first `least` words, brings equal runs together; words in a run that another page has too are
covered. Inside of an element that marks the article the markup prevails, as articles may quote one another or be copies;
inside of menus, footers, forms, comments and the like it prevails as well. All other blocks, also beside a marked article,
lose their covered words and keep the rest.

A host with many pages, or with more text than a suffix array takes, is dealt into shards of a bounded size. Its runs are
then compared over all of its pages, in two rounds dealt by hash into parts of the host: each shard asks for short fingerprints of
its runs, and for the hashes of those whose fingerprint another shard has too. What is asked for goes as packed gaps, what is
answered as one bit each. Pages are parsed once and shuffled once, as compressed blocks; all rounds go over that shuffle. How large a
host is, is counted in a fixed number of slots, so what is sent to the tasks has a fixed bound.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.url_model import host_of
from meterline.llm.words import GOLDEN, SECOND, hashes, mix, spans


@dataclass(frozen=True)
class Boilerplate:
    """Words of a run that counts as repeated, pages from which a host is dealt, slots to count hosts in, words of one suffix array."""

    least: int = 8
    pages: int = 64
    slots: int = 1 << 16
    most_words: int = 1 << 20

    @property
    def most_chars(self) -> int:
        """Characters of markup that are taken at a time."""
        return 6 * self.most_words


TAG = re.compile(r"<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.I)
TAG_NAME = re.compile(r"<(/?)([a-z][^\s/>]*)", re.I)
#: Elements whose content is no markup, and what ends it.
RAW = re.compile(r"<(script|style|noscript|template|textarea|iframe|svg|title)\b", re.I)
RAW_ENDS = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title")
}
MARKS = re.compile("[>\"']")
ATTRIBUTES = re.compile(
    r"(?<![a-z-])([a-z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I
)
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav footer aside form button select menu dialog head object canvas".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split()
)
#: Words of class and id that mark an element as no part of the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice gdpr popup modal "
    "overlay newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer "
    "comment comments disqus replies share sharing social related recommended widget login search toolbar pagination "
    "pager".split()
)
#: Hints that also hold for an element of an article that stands in no other: comments are often marked up as articles.
REMARKS = frozenset("comment comments disqus replies".split())
ARTICLE = frozenset("articlebody articlecontent entry-content post-content article-body main-content".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tr": frozenset(["tr", "td", "th"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
}
#: An end tag does not close elements beyond one of these.
FENCES = frozenset("article main section div table td body aside nav footer header form ul ol".split())

OUT, OPEN, ARTICLE_TEXT = -1, 0, 1


@dataclass
class _Page:
    """Blocks of a page and what the markup says of each: OUT, OPEN or ARTICLE_TEXT."""

    texts: list[str] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)


def _mark(name: str, attributes: str, outer: int) -> int:
    """What an element says of its text, given what stands around it."""
    if outer == OUT or name in CHROME:
        return OUT
    found = {}
    if attributes.strip(" /"):
        for key, a, b, c, flag in ATTRIBUTES.findall(attributes):
            found[(key or flag).lower()] = (a or b or c).lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in ROLES:
        return OUT
    if "display:none" in found.get("style", "").replace(" ", ""):
        return OUT
    names = f"{found.get('class', '')} {found.get('id', '')}"
    article = (
        name in ("article", "main")
        or found.get("role") in ("main", "article")
        or found.get("itemprop") == "articlebody"
        or bool(ARTICLE & set(names.split()))
    )
    # An outermost article may be named after its subject; one inside of another is often a remark or a teaser.
    hints = REMARKS if article and outer == OPEN else HINTS
    if name not in ("html", "body", "main") and names != " " and hints & set(re.split(r"[^a-z]+", names)):
        return OUT
    if name == "header":
        return outer if outer == ARTICLE_TEXT else OUT
    return ARTICLE_TEXT if article else outer


class _TagEnds:
    """Where tags end: at the first > outside of quotes. Found for all places at once, from the back, in linear time."""

    def __init__(self, page: str):
        self.at = [m.start() for m in MARKS.finditer(page)]
        self.ends = [-1] * (len(self.at) + 1)
        following = {"\"": -1, "'": -1}
        for i in range(len(self.at) - 1, -1, -1):
            mark = page[self.at[i]]
            if mark == ">":
                self.ends[i] = self.at[i]
            else:
                if following[mark] >= 0:
                    self.ends[i] = self.ends[following[mark] + 1]
                following[mark] = i

    def __call__(self, start: int) -> int:
        return self.ends[bisect_left(self.at, start)]


def tokens(page: str):
    """(text, name, closes, attributes) in page order: a run of text, or a tag's name and what stands in it.

    Comments, declarations and the content of scripts and the like are left out. Each takes time that grows with what it
    spans, also on pages of unclosed tags, quotes and comments: once a tag has no end, the ends of all are looked up.
    """
    ends, pos, n = None, 0, len(page)
    while pos < n:
        low = page.find("<", pos)
        if low != pos:
            low = n if low < 0 else low
            yield page[pos:low], None, False, ""
            pos = low
            continue
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            pos = n if end < 0 else end + 3
            continue
        if raw := RAW.match(page, low):
            if ends is None:
                tag = TAG.match(page, low)
                # An end that is one of the tag is one of the element too, unless quotes stand in the name.
                end = tag.end() - 1 if tag and tag.end(2) == raw.end(1) else None
                if end is None:
                    ends = _TagEnds(page)
            if ends is not None:
                end = ends(raw.end(1))
            if end >= 0:
                close = RAW_ENDS[raw[1].lower()].search(page, end + 1)
                pos = close.end() if close else n
                continue
        if name := TAG_NAME.match(page, low):
            tag = None
            if ends is None:
                tag = TAG.match(page, low)
                if tag:
                    end = tag.end() - 1
                else:
                    ends = _TagEnds(page)
            if ends is not None:
                end = ends(name.end())
            if end >= 0:
                yield "", name[2].lower(), bool(name[1]), page[name.end() : end]
                pos = end + 1
                continue
        if page[low + 1 : low + 2] in ("!", "?", "/") or name:
            end = page.find(">", low + 1)
            if end >= 0:
                pos = end + 1
                continue
            # No > is left: all that follows is text, but for comments.
            end = page.find("<!--", low + 1)
            end = n if end < 0 else end
            yield page[low:end], None, False, ""
            pos = end
            continue
        yield "<", None, False, ""
        pos = low + 1


class _Stack:
    """Open elements (name, mark), with the places of each name and of the fences."""

    def __init__(self):
        self.items = [("", OPEN)]
        self.places: dict[str, list[int]] = {}
        self.fences: list[int] = []

    @property
    def top(self):
        return self.items[-1]

    def push(self, name: str, mark: int):
        self.places.setdefault(name, []).append(len(self.items))
        if name in FENCES:
            self.fences.append(len(self.items))
        self.items.append((name, mark))

    def pop(self):
        name, _ = self.items.pop()
        self.places[name].pop()
        if name in FENCES:
            self.fences.pop()

    def closed_by(self, name: str) -> int:
        """Place of the element that an end tag closes, or 0."""
        places = self.places.get(name)
        if not places or (name not in FENCES and self.fences and self.fences[-1] > places[-1]):
            return 0
        return places[-1]


def parse(page: str) -> _Page:
    """Blocks of text in page order, white space as single spaces; markup that is not closed ends with its parent.

    Time grows with the page's length, also for broken markup.
    """
    out, stack, words = _Page(), _Stack(), []

    def end_block():
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            out.texts.append(text)
            out.marks.append(stack.top[1])
        words.clear()

    for raw, name, closes, attributes in tokens(page):
        if name is None:
            words.append(raw)
            continue
        if name in BLOCKS:
            end_block()
        if closes:
            if place := stack.closed_by(name):
                end_block()
                while len(stack.items) > place:
                    stack.pop()
        elif name not in VOID:
            if name in BLOCKS and stack.top[0] in ("p", "b", "i", "em", "strong", "h1", "h2", "h3", "h4", "h5", "h6"):
                while stack.top[0] in ("b", "i", "em", "strong") and len(stack.items) > 2:
                    stack.pop()
                if stack.top[0] == "p":
                    stack.pop()
            if stack.top[0] in CLOSED_BY.get(name, ()):
                stack.pop()
            if not attributes.rstrip().endswith("/"):
                mark = _mark(name, attributes, stack.top[1])
                if mark != stack.top[1]:
                    end_block()
                stack.push(name, mark)
    end_block()
    return out


def repeated_runs(word: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """For each word of the stream, whether it is in a run of `least` words that another page has too.

    The suffix array is built by doubling: ranks of one word, then of two, four and so on. Its order
    is cut off at `least` words (rounded down to a power of two), as longer runs are made of shorter ones.
    """
    n = len(word)
    covered = np.zeros(n, bool)
    if n < least:
        return covered
    _, rank = np.unique(word, return_inverse=True)
    alive = np.ones(n, bool)  # suffixes that reach far enough inside of their page
    width = 1
    while 2 * width <= least:
        follow = np.zeros(n, np.int64)
        follow[:-width] = rank[width:]
        inside = np.zeros(n, bool)
        inside[: n - 2 * width + 1] = page[2 * width - 1 :] == page[: n - 2 * width + 1]
        alive &= inside
        _, rank = np.unique(rank.astype(np.int64) * (int(rank.max()) + 1) + follow, return_inverse=True)
        width *= 2
    suffixes = np.flatnonzero(alive)
    if not len(suffixes):
        return covered
    suffixes = suffixes[np.argsort(rank[suffixes], kind="stable")]
    r, p = rank[suffixes], page[suffixes]
    begins = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
    several = np.minimum.reduceat(p, begins) != np.maximum.reduceat(p, begins)
    hit = suffixes[np.repeat(several, np.diff(np.append(begins, len(r))))]
    for k in range(width):
        covered[hit + k] = True
    return covered


@dataclass
class _Stream:
    """The words of some pages: where each begins and ends in `data`, its hash, its page, and the first of each block."""

    parsed: list[_Page]
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    page: np.ndarray
    word: np.ndarray

    def runs(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run inside a page; its words are the power of two of `repeated_runs`."""
        width = 1 << (least.bit_length() - 1)
        n = max(len(self.word) - width + 1, 0)
        rolled = np.zeros(n, np.uint64)
        for k in range(width if n else 0):
            rolled = mix(rolled * SECOND + self.word[k : n + k] + GOLDEN)
        at = np.flatnonzero(self.page[width - 1 :] == self.page[:n]) if n else np.zeros(0, np.int64)
        return at, rolled[at]


def _stream(parsed: list[_Page]) -> _Stream:
    encoded = [t.encode() for p in parsed for t in p.texts]
    offsets = np.concatenate(([0], np.cumsum([len(e) for e in encoded]))).astype(np.int64)
    data = np.frombuffer(b"".join(encoded), np.uint8)
    starts, ends, first = spans(data, offsets)
    page_of_block = np.repeat(np.arange(len(parsed)), [len(p.texts) for p in parsed])
    page = np.repeat(page_of_block, np.diff(first))
    return _Stream(parsed, data, starts, ends, first, page, hashes(data, starts, ends))


def extract(pages: list[str], how: Boilerplate) -> list[tuple[str, int]]:
    """Main text of each of all pages of one host, and how many of its blocks' words are repeated across pages."""
    stream = _stream([parse(p) for p in pages])
    return _kept(stream, repeated_runs(stream.word, stream.page, how.least))


def _kept(stream: _Stream, covered: np.ndarray) -> list[tuple[str, int]]:
    """The pages' texts without the covered words of open blocks, and how many words of each page are covered."""
    data, starts, ends, first = stream.data, stream.starts, stream.ends, stream.first
    total = np.concatenate(([0], np.cumsum(covered)))
    covered_of_block = total[first[1:]] - total[first[:-1]]
    out, at = [], 0
    for p in stream.parsed:
        kept = []
        for i, text in enumerate(p.texts, at):
            mark = p.marks[i - at]
            if mark == OPEN and covered_of_block[i]:
                own = np.arange(first[i], first[i + 1])[~covered[first[i] : first[i + 1]]]
                text = b" ".join(data[starts[w] : ends[w]].tobytes() for w in own).decode()
            if mark != OUT and text:
                kept.append(text)
        out.append(("\n".join(kept), int(covered_of_block[at : at + len(p.marks)].sum())))
        at += len(p.marks)
    return out


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the gaps between them: low bits as they are, the rest by counting (a Rice code)."""
    n = len(numbers)
    if not n:
        return b""
    gaps = np.diff(numbers, prepend=np.uint64(0))
    k = max(int(numbers[-1]) // n, 1).bit_length() - 1
    ones = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    counted = np.zeros(int(ones[-1]) + 1, np.uint8)
    counted[ones] = 1
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return n.to_bytes(4, "little") + bytes([k]) + np.packbits(low.ravel()).tobytes() + np.packbits(counted).tobytes()


def unpack_numbers(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    n, k = int.from_bytes(packed[:4], "little"), packed[4]
    bits, end = np.frombuffer(packed, np.uint8, offset=5), (n * k + 7) // 8
    low = np.unpackbits(bits[:end], count=n * k).reshape(n, k).astype(np.uint64)
    low = (low << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    ones = np.flatnonzero(np.unpackbits(bits[end:]))[:n]
    high = np.diff(ones, prepend=-1) - 1
    return np.cumsum((high.astype(np.uint64) << np.uint64(k)) + low, dtype=np.uint64)


def _pack_page(page: _Page) -> bytes:
    """A page's blocks, compressed. Blocks hold no line ends."""
    marks = bytes(m + 1 for m in page.marks)
    data = len(marks).to_bytes(4, "little") + marks + "\n".join(page.texts).encode()
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack_page(packed: bytes) -> _Page:
    data = pa.decompress(packed[4:], int.from_bytes(packed[:4], "little"), codec="zstd", asbytes=True)
    n = int.from_bytes(data[:4], "little")
    return _Page(data[4 + n :].decode().split("\n") if n else [], [m - 1 for m in data[4 : 4 + n]])


#: Bits of a fingerprint among the runs of a part, of which there are up to about 2^20: one in 64 is met by chance.
_PRINT = np.uint64(26)


class _Shard:
    """Runs of a shard, and what other shards of the host said of them.

    A run in two of the shard's pages is repeated. Of the others, fingerprints are asked for first and hashes where a
    fingerprint was met; answers are bits in the order of what was sent.
    """

    def __init__(self, table: pa.Table, how: Boilerplate):
        self.parts = table.column("parts")[0].as_py()
        self.stream = _stream([_unpack_page(p) for p in table.column("packed").to_pylist()])
        self.width = 1 << (how.least.bit_length() - 1)
        self.at, self.runs = self.stream.runs(how.least)
        page = self.stream.page[self.at]
        order = np.lexsort((page, self.runs))
        run, page = self.runs[order], page[order]
        new = np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.zeros(0, bool)
        begins = np.flatnonzero(new)
        self.distinct = run[begins]
        self.own = page[begins] != page[np.append(begins[1:], len(run)) - 1] if len(run) else np.zeros(0, bool)

    def prints(self):
        """(part, places of its runs in `distinct`, their fingerprints ascending and distinct, fingerprint of each run)."""
        part = self.distinct % np.uint64(self.parts)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for places in np.split(order, cuts) if len(order) else []:
            prints, at = np.unique(self.distinct[places] >> (np.uint64(64) - _PRINT), return_inverse=True)
            yield int(part[places[0]]), places, prints, at

    def met(self, told: pa.Table):
        """(part, bits, places of the runs whose fingerprint another shard has too, what was said of these hashes)."""
        said = {p: (m, f) for p, m, f in zip(*(told.column(c).to_pylist() for c in ("part", "met", "found")), strict=True)}
        for part, places, prints, at in self.prints():
            if part in said:
                bits, found = said[part]
                yield part, bits, places[_bits(bits, len(prints))[at]], found

    def covered(self, told: pa.Table) -> np.ndarray:
        repeated = self.own.copy()
        for _, _, places, found in self.met(told):
            repeated[places] |= _bits(found, len(places))
        covered = np.zeros(len(self.stream.word), bool)
        hit = self.at[repeated[np.searchsorted(self.distinct, self.runs)]] if len(self.runs) else self.at
        for k in range(self.width):
            covered[hit + k] = True
        return covered


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


_ASKED = pa.schema(
    [("host", pa.string()), ("shard", pa.int64()), ("part", pa.int64()), ("met", pa.binary()), ("asked", pa.binary())]
)
_TOLD = pa.schema([*[_ASKED.field(i) for i in range(4)], ("found", pa.binary())])
_ASKED_SHAPE = "host string, shard long, part long, met binary, asked binary"
_TOLD_SHAPE = "host string, shard long, part long, met binary, found binary"


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _group(table: pa.Table) -> tuple[str, int]:
    return table.column("host")[0].as_py(), table.column("shard")[0].as_py()


def _found_runs(dealt: DataFrame, how: Boilerplate) -> DataFrame:
    """What each shard is told of its runs: which fingerprints another shard of the host has, and which of their hashes.

    Both rounds go over the same shuffled pages.
    """

    def ask(table):
        group = _group(table)
        return _rows([(*group, p, None, pack_numbers(prints)) for p, _, prints, _ in _Shard(table, how).prints()], _ASKED)

    def ask_again(table, told):
        if not (table.num_rows and told.num_rows):
            return _rows([], _ASKED)
        group, shard = _group(table), _Shard(table, how)
        met = shard.met(told)
        return _rows([(*group, p, bits, pack_numbers(shard.distinct[places])) for p, bits, places, _ in met], _ASKED)

    def answer(table):
        asked = [unpack_numbers(a) for a in table.column("asked").to_pylist()]
        _, at, counts = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
        several = np.split(counts[at] > 1, np.cumsum([len(a) for a in asked])[:-1])
        names = zip(*(table.column(c).to_pylist() for c in ("host", "shard", "part", "met")), strict=True)
        return [(*n, np.packbits(s).tobytes()) for n, s in zip(names, several, strict=True) if s.any()]

    def answer_prints(table):
        return _rows([(*n[:3], bits, b"") for *n, bits in answer(table)], _TOLD)

    def answer_hashes(table):
        return _rows(answer(table), _TOLD)

    asked = dealt.groupBy("host", "shard").applyInArrow(ask, _ASKED_SHAPE)
    told = asked.groupBy("host", "part").applyInArrow(answer_prints, _TOLD_SHAPE)
    both = dealt.groupBy("host", "shard").cogroup(told.groupBy("host", "shard"))
    asked = both.applyInArrow(ask_again, _ASKED_SHAPE)
    return asked.groupBy("host", "part").applyInArrow(answer_hashes, _TOLD_SHAPE)


def main_text(
    pages: DataFrame, how: Boilerplate = Boilerplate(), key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """One row for each row of `pages`: key, url, text, n_chars (code points), n_repeated (words of the page in runs that other
    pages of its host have).

    A null or empty page has an empty text. Pages with a null URL or one without a host are pages of one host without a name.
    Rows that repeat are extracted each; copies of a page cover each other, which only speaks against text without article markup.
    Other columns are not read. An empty table gives no rows.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("host"), F.lit(how.slots)))
    sizes = rows.groupBy("slot").agg(F.count("*").alias("count"), F.sum(F.length("page")).alias("chars"))
    sizes = sizes.filter((F.col("count") > how.pages) | (F.col("chars") > how.most_chars))
    parts = F.greatest(F.ceil(F.col("chars") / how.most_chars), F.lit(1))
    # Each shard may ask each part: with small shards, what is sent beside the runs would outgrow them in a very large host.
    shards = F.greatest(F.least(F.ceil(F.col("count") / how.pages), 2 * parts), parts)
    sizes = sizes.select("slot", shards.alias("shards"), parts.alias("parts"))
    # At most `slots` rows of three numbers, whatever the number of pages.
    rows = rows.join(F.broadcast(sizes), "slot", "left")
    shard = F.pmod(F.xxhash64("key", "url", F.length("page")), F.coalesce("shards", F.lit(1)))
    rows = rows.select("key", "url", "page", "host", shard.alias("shard"), F.coalesce("parts", F.lit(0)).alias("parts"))
    key_kind = pages.schema[key].dataType.simpleString()

    def pack(batches):
        for batch in batches:
            packed = [_pack_page(parse(p or "")) for p in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "url", "packed", "host", "shard", "parts"])

    def packed(some: DataFrame) -> DataFrame:
        return some.mapInArrow(pack, f"key {key_kind}, url string, packed binary, host string, shard long, parts long")

    def texts(keys, urls, found) -> dict:
        counts = [[len(t) for t, _ in found], [n for _, n in found]]
        columns = [keys, urls, pa.array([t for t, _ in found], pa.string()), *(pa.array(c, pa.int64()) for c in counts)]
        return dict(zip([key, "url", "text", "n_chars", "n_repeated"], columns, strict=True))

    def run(batches):
        group, held = None, []

        def done():
            stream = _stream([_unpack_page(p) for _, _, p in held])
            found = _kept(stream, repeated_runs(stream.word, stream.page, how.least))
            keys, urls = pa.array([k for k, _, _ in held], key_type), pa.array([u for _, u, _ in held], url_type)
            return pa.RecordBatch.from_pydict(texts(keys, urls, found))

        for batch in batches:
            key_type, url_type = batch.column(0).type, batch.column(1).type
            for k, u, p, host in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and group != host:
                    yield done()
                    held = []
                group = host
                held.append((k, u, p))
        if held:
            yield done()

    def run_shard(table, told):
        shard = _Shard(table, how)
        return pa.table(texts(table.column("key"), table.column("url"), _kept(shard.stream, shard.covered(told))))

    shape = f"`{key}` {key_kind}, url string, text string, n_chars long, n_repeated long"
    small = packed(rows.filter("parts = 0")).repartition("host").sortWithinPartitions("host", "key")
    dealt = packed(rows.filter("parts > 0"))
    both = dealt.groupBy("host", "shard").cogroup(_found_runs(dealt, how).groupBy("host", "shard"))
    return small.mapInArrow(run, shape).unionByName(both.applyInArrow(run_shard, shape))
