"""Main text of web pages: differencing against the page with the nearest URL, and markup rules.

A page becomes lines, one per block, in page order. Text in elements that never are main text (menus, footers, forms
and the like) is left out piece by piece as it is read. So are elements whose class, id or role names such a thing, as long as
nothing speaks against it: ``article`` and ``main``, what holds them, and what holds most of a page without them stay whatever they are called,
since such words also say what a text is about or which switches its page has. Articles that have some size are the
text alone. Each page is then paired with the page of its host whose URL path shares the longest beginning with its own, their lines are
aligned by longest common subsequence, and the lines that the pair shares are deleted: they belong to the site, not to the page. This decides

* all lines of pages without ``article`` and ``main``, but for containers whose class or id says that they hold text, if the pair
  shares all of them;
* in articles, all lines of blocks whose names may or may not speak of the site ("notice", "search-history", "social" on a paragraph): they
  are the site's if they recur, and else text. Other lines in articles are protected, since hosts repeat whole articles.

A page without a neighbour keeps all these lines.

Two passes. The first sends on a hash and a length per line, not the lines. Pages of a host with equal lines become one,
at the smallest of their paths; these are numbered in the order of host and path, by prefix sums over sorted partitions, and dealt in blocks
of neighbouring numbers that overlap by NEAR, so that the result does not depend on the partitioning. A neighbour is sought among the NEAR
pages before and after; copies (of one path, and alike in all but NEARLY percent of their characters) are none. Where all of these are
copies, the next page of another path takes their place, however far it is. The second pass
reads the pages again and drops the lines whose verdict is to go; only pages that lose lines have a verdict.

Tags are read in time linear in the page; see :mod:`brindle.llm.line_lcs` for the alignment, whose memory is linear in the lines.

Cases: a null html has no text. A null or odd URL has an empty host and pairs like any other. Rows that repeat stay rows of
their own. A tag whose quote never ends is read up to its next ">"; one without ">" ends the page. An article that is called an advert or a
comment is one only if the page has another article. A page of very many lines,
or with one line very often, is held by one task as its lines. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import collections
import html
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.line_lcs import shared
from brindle.llm.work import BROADCAST_ROWS, materialize, numbered, slices

#: An attribute: its name, and its value in double quotes, in single quotes or bare.
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|((?![\"'])[^\s>]*+)))?+")
_TOKEN = re.compile(
    r"(?P<text>[^<]++|<(?![a-zA-Z/!?]))"
    r"|<(?P<close>/?+)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?+)*+)>"
    r"|<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*+>?"
    r"|<(?P<odd_close>/?+)(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+>",  # a quote in it never ends
    re.S,
)
#: Elements whose content is no markup; it is skipped up to the end tag.
RAW = frozenset(("script", "style", "title", "textarea", "iframe", "noframes", "noembed", "xmp"))
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section
    summary table tbody td tfoot th thead tr ul""".split()
)
#: An element of the first kind ends an open one of the second, unless one of the third stands between.
_CELLS = frozenset(("td", "th", "caption", "table", "template", "object"))
_ENDS_P = BLOCK - frozenset(("body", "br", "caption", "head", "html", "legend", "option", "tbody", "td", "tfoot", "th", "thead", "tr"))
_IMPLIED = {"li": (("li",), frozenset(("ul", "ol", "menu", "dir", "table"))), "option": (("option",), frozenset(("select",)))} | {
    x: (y, frozenset(z)) for names, y, z in ((("dt", "dd"), ("dt", "dd"), ("dl", "table")), (("td", "th"), ("td", "th"), ("tr", "table")), (("tr",), ("tr",), ("table",))) for x in names
}
#: Elements that are never main text; headers only outside articles.
NEVER = frozenset("nav footer aside head noscript template svg math button select datalist object dialog menu".split())
#: Words of class, id and role that name what is no main text.
NEVER_WORDS = frozenset(
    """ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar comment
    comments disqus reply replies share sharing social related recommended newsletter subscribe subscription signup login
    search pagination pager copyright footer complementary contentinfo alert alertdialog""".split()
)
#: Words that do so outside articles only.
OUTSIDE_WORDS = frozenset("header masthead topbar toolbar widget widgets".split())
#: Of the first, those that may as well say what a paragraph is about or in what tone it speaks.
TOPIC_WORDS = frozenset("notice notices alert banner promo promotion sponsor comment reply share sharing social related recommended search subscription advertising".split())
#: Words that may follow one of them in the name of a part of a page, as in "share-bar"; with any others, it may be about something else.
PART_WORDS = frozenset(
    """area bar block body box button buttons container content form group holder icon icons inner item items label link links list
    outer panel part post posts row section slot text thread top bottom left right title unit widget wrap wrapper""".split()
)
#: First words of names that say of what kind or in what layout an element is, and last ones that say what is switched on.
KIND_WORDS = frozenset("has no not with without category cat tag tags taxonomy type layout status format".split())
#: First words that say to what a part belongs; words of topics after them say what a post is about.
OWNER_WORDS = frozenset("post page entry article author site main".split())
SWITCH_WORDS = frozenset("open closed on off enabled disabled".split())
#: Elements that are a text's own parts. In an article, their ids are anchors, and names of several words speak of their looks.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre a abbr b cite code em font i mark q small span strong sub sup time u".split())
_WORDS = re.compile(r"[A-Za-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Containers whose class, id or role has one of these words hold main text, like an article.
CONTAINERS = frozenset(("div", "section", "td"))
CONTENT_WORDS = frozenset("article content entry post story main".split())
#: Kinds of elements: never text; article or main; a container by its words; a form, which is no text unless it holds an article or main;
#: none of these; named as no text; article or main so named; in an article, perhaps so named. TEXT, WRAPPED, UNDECIDED and SUSPECT mark lines.
EXCLUDED, TEXT, WRAPPED, FORM, UNDECIDED, NAMED, NAMED_TEXT, SUSPECT = range(8)
#: Articles of at least this part of a page's characters are its text alone.
ARTICLE_PART = 0.2
#: Open elements that are told apart; deeper ones count as their parents, as in browsers.
DEPTH = 512

#: Pages on either side among which a neighbour is sought.
NEAR = 4
#: Share (in percent) of characters in which pages of one path may differ and still be copies.
NEARLY = 5
#: Fewest numbers in a block, and lines in verdicts that are broadcast.
BLOCK_PAGES, BROADCAST_LINES = 64, 16_000_000


def _name_says(words: list[str], name: str, in_article: bool) -> int:
    """Whether a name of some words means NAMED, SUSPECT or neither (UNDECIDED)."""
    if not words or words[0] in KIND_WORDS or words[-1] in SWITCH_WORDS and len(words) > 1:
        return UNDECIDED
    several = len(words) > 1
    if several and words[0] in OWNER_WORDS:
        words = words[1:]
        if words[0] in TOPIC_WORDS:
            return UNDECIDED
    if not in_article and name not in ("article", "main"):
        return NAMED if any(w in NEVER_WORDS or w in OUTSIDE_WORDS for w in words) else UNDECIDED
    if words[0] not in NEVER_WORDS:
        return UNDECIDED
    if name in FLOW:
        return UNDECIDED if several else SUSPECT if words[0] in TOPIC_WORDS else NAMED
    return NAMED if all(w in NEVER_WORDS or w in PART_WORDS for w in words[1:]) else SUSPECT


def _kind(name: str, rest: str, in_article: bool) -> int:
    """What an element's name and attributes say of the text in it."""
    if name in NEVER or (name == "header" and not in_article):
        return EXCLUDED
    kind = TEXT if name in ("article", "main") else FORM if name == "form" else UNDECIDED
    if not rest or rest.isspace():
        return kind
    said = set()
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
            return EXCLUDED
        if key not in ("class", "id", "role") or name in ("html", "body") or (key == "id" and in_article and name in FLOW):
            continue
        for token in value.split():
            words = [w.lower() for w in _WORDS.findall(token)]
            said.add(_name_says(words, name, in_article))
            if kind == UNDECIDED and name in CONTAINERS and not CONTENT_WORDS.isdisjoint(words):
                kind = WRAPPED
    if kind == TEXT:
        return NAMED_TEXT if NAMED in said else TEXT
    if NAMED in said:
        return FORM if kind == FORM else NAMED if name in BLOCK else EXCLUDED
    return SUSPECT if SUSPECT in said and kind == UNDECIDED and name in BLOCK else kind


class _Open:
    """The open elements of a page, and how many of each kind there are."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.kinds = [0] * 8
        self.names: collections.Counter[str] = collections.Counter()
        self.deeper: collections.Counter[str] = collections.Counter()
        #: Numbers of the open elements that are named as no text, and of how many there have been.
        self.regions: list[int] = []
        self.n_regions = 0
        #: Whether an article or main has begun outside such elements.
        self.has_article = False

    def in_article(self) -> bool:
        return self.kinds[TEXT] + self.kinds[NAMED_TEXT] > 0

    def push(self, name: str, rest: str) -> None:
        if len(self.stack) >= DEPTH:
            self.deeper[name] += 1
            return
        kind = _kind(name, rest, self.in_article() or self.kinds[WRAPPED] > 0)
        if kind == TEXT:
            self.admit()
            self.has_article |= not self.regions
        elif kind in (NAMED, NAMED_TEXT):
            self.regions.append(self.n_regions)
            self.n_regions += 1
        self.stack.append((name, kind))
        self.kinds[kind] += 1
        self.names[name] += 1

    def admit(self) -> None:
        """An article or main begins: a form around it holds the page and not only fields, unless it is itself in an article. So does an element
        that is named as no text, unless an article came before it: then it may hold comments."""
        if self.in_article():
            return
        own = (FORM,) if self.has_article else (FORM, NAMED)
        if any(self.kinds[k] for k in own):
            self.stack = [(name, UNDECIDED if kind in own else kind) for name, kind in self.stack]
            for k in own:
                self.kinds[UNDECIDED] += self.kinds[k]
                self.kinds[k] = 0
            if NAMED in own:
                self.regions.clear()

    def cut(self, k: int) -> None:
        for name, kind in self.stack[k:]:
            self.kinds[kind] -= 1
            self.names[name] -= 1
            if kind in (NAMED, NAMED_TEXT):
                self.regions.pop()
        del self.stack[k:]

    def imply(self, names: tuple[str, ...], between: frozenset[str]) -> None:
        """End the innermost of ``names``, if it is open and none of ``between`` stands inside it."""
        if not any(self.names[n] for n in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                self.cut(k)
                return
            if self.stack[k][0] in between:
                return

    def close(self, name: str) -> None:
        """An end tag ends its element and all inside, but not through cells, nor through blocks if its own is none."""
        if self.deeper[name]:
            self.deeper[name] -= 1
            return
        if not self.names[name]:
            return
        table = name in _CELLS or name in ("tr", "tbody", "thead", "tfoot", "body", "html")
        for k in range(len(self.stack) - 1, -1, -1):
            own = self.stack[k][0]
            if own == name:
                self.cut(k)
                return
            if own in BLOCK and name not in BLOCK and name not in NEVER or own in _CELLS and not table:
                return

    def mark(self) -> int:
        if self.kinds[SUSPECT]:
            return SUSPECT
        return TEXT if self.in_article() else WRAPPED if self.kinds[WRAPPED] else UNDECIDED


def _candidates(lines: list[str], marks: list[int], regions: list[tuple[int, ...]]) -> tuple[list[str], list[int]]:
    """The lines that may be text: without those of elements that are named otherwise, and of articles alone if there are any of some size.

    Names are not believed of an article's whole text, nor, on a page without articles, of most of the page's."""
    in_article = [m in (TEXT, SUSPECT) for m in marks]
    if not any(m == TEXT and not r for m, r in zip(marks, regions)) and TEXT in marks:
        regions = [() if m == TEXT else r for m, r in zip(marks, regions)]
    if TEXT in marks:
        stay = [not r for r in regions]
    else:
        sizes: collections.Counter[int] = collections.Counter()
        for line, r in zip(lines, regions):
            for k in r:
                sizes[k] += len(line)
        total = sum(map(len, lines))
        stay = [all(2 * sizes[k] > total for k in r) for r in regions]
    whole = sum(len(x) for x, s in zip(lines, stay) if s)
    if TEXT in marks and sum(len(x) for x, s, own in zip(lines, stay, in_article) if s and own) >= ARTICLE_PART * whole:
        stay = [s and own for s, own in zip(stay, in_article)]
    return [x for x, s in zip(lines, stay) if s], [m for m, s in zip(marks, stay) if s]


def page_lines(source: str) -> tuple[list[str], list[int]]:
    """The lines of a page that may be text, and the mark of each."""
    lines: list[str] = []
    marks: list[int] = []
    regions: list[tuple[int, ...]] = []
    pieces: list[str] = []
    mark, region, state = UNDECIDED, (), _Open()

    def end_block() -> None:
        if pieces:
            line = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if line:
                lines.append(line)
                marks.append(mark)
                regions.append(region)

    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.match(source, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        if (text := m["text"]) is not None:
            if not (state.kinds[EXCLUDED] or state.kinds[FORM]):
                if not pieces:
                    mark, region = state.mark(), tuple(state.regions)
                pieces.append(text)
            continue
        name = m["name"] or m["odd"]
        if name is None:
            continue
        name, rest = name.lower(), m["rest"] or ""
        if m["close"] or m["odd_close"]:
            if name in BLOCK:
                end_block()
            state.close(name)
            continue
        if name in RAW:
            end = _RAW_END[name].search(source, at)
            stop = source.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else size
            continue
        if name in BLOCK:
            end_block()
        if name in _ENDS_P:
            state.imply(("p",), _CELLS)
        if name in _IMPLIED:
            state.imply(*_IMPLIED[name])
        if name not in VOID and not (rest.endswith("/") and name not in BLOCK):
            state.push(name, rest)
    end_block()
    return _candidates(lines, marks, regions)


class Page:
    """What the first pass knows of a page: a hash, a length and a mark for each line."""

    def __init__(self, row: dict):
        self.host, self.path = row["host"], row["path"]
        self.lines, self.sizes, self.marks = row["lines"], row["sizes"], row["marks"]
        self.row = row

    def copy_of(self, other: Page) -> bool:
        if self.path != other.path:
            return False
        total = sum(self.sizes) + sum(other.sizes)
        return 100 * (total - 2 * sum(self.sizes[i] for i in shared(self.lines, other.lines))) <= NEARLY * total


def neighbour(page: Page, before: Iterable[Page], after: Iterable[Page], others: Iterable[Page | None] = (None, None)) -> Page | None:
    """Of the pages before and after, nearest first, the one that shares more of the path; copies are passed over. Where all of a side are
    copies, the next page of another path stands for it: ``others``."""
    found = [next((p for p in side if p.host == page.host and not page.copy_of(p)), other) for side, other in zip((before, after), others)]
    return max((p for p in found if p), key=lambda p: len(os.path.commonprefix([page.path, p.path])), default=None)


def verdict(page: Page, other: Page | None) -> list[bool]:
    """Which lines of a page stay, given its neighbour."""
    if other is None or all(m == TEXT for m in page.marks):
        return [True] * len(page.marks)
    gone = shared(page.lines, other.lines)
    wrapped = {i for i, m in enumerate(page.marks) if m == WRAPPED}
    if wrapped <= gone:  # copied whole
        gone -= wrapped
    return [m == TEXT or i not in gone for i, m in enumerate(page.marks)]


def _own_key(lines: list[str], marks: list[int]) -> bytes:
    from xxhash import xxh3_128

    key = xxh3_128(bytes(marks))
    for line in lines:
        key.update(line.encode("utf-8", "surrogatepass") + b"\n")
    return key.digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_64_intdigest

    names = ["host", "path", "url", "content", "lines", "sizes", "marks"]
    kinds = [*[pa.string()] * 3, pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int8())]
    for batch in slices(batches, 256):
        rows = []
        for row in batch.to_pylist():
            lines, marks = page_lines(row["html"])
            hashes = [xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]
            rows.append((row["host"], row["path"], row["url"], _own_key(lines, marks), hashes, [len(x) for x in lines], marks))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _judge(size: int):
    """Rows sorted by block and number, after each block's pages of other paths: the verdicts of the block's own pages that lose lines. A few
    pages are held at once, and at most two for each path of many pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (Page(row) for batch in slices(batches, 256) for row in batch.to_pylist())
        out: list[tuple] = []
        for block, pages in itertools.groupby(rows, key=lambda p: p.row["block"]):
            others: dict[tuple[str, str], list[Page | None]] = {}
            page = next(pages, None)
            while page is not None and page.row["beside"] is not None:
                others.setdefault((page.host, page.row["beside"]), [None, None])[page.row["side"]] = page
                page = next(pages, None)
            pages = itertools.chain([page] if page else [], pages)
            window: collections.deque[Page] = collections.deque(itertools.islice(pages, NEAR + 1))
            before: collections.deque[Page] = collections.deque(maxlen=NEAR)
            while window:
                page = window.popleft()
                if page.row["number"] // size == block:
                    kept = verdict(page, neighbour(page, reversed(before), window, others.get((page.host, page.path), (None, None))))
                    if not all(kept):
                        out.append((page.host, page.row["content"], kept))
                before.append(page)
                window.extend(itertools.islice(pages, 1))
                if len(out) >= 500:
                    yield _verdicts(out)
                    out = []
        if out:
            yield _verdicts(out)

    return run


def _verdicts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.binary(), pa.list_(pa.bool_())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["v_host", "v_content", "stays"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        found = [page_lines(x) for x in batch.column("html").to_pylist()]
        columns = [batch.column(c) for c in ("page_id", "url", "host")]
        columns += [pa.array([_own_key(*x) for x in found], pa.binary()), pa.array([x for x, _ in found], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "content", "lines"])


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def _rows(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), _host(url).alias("host"), _path(url).alias("path"),
        F.coalesce("html", F.lit("")).alias("html"),
    )


def _others(ordered: DataFrame, columns: list[str], size: int) -> DataFrame:
    """For each path with more than NEAR pages, the host's pages before and after all of them, in every block that has some of them."""
    paths = ordered.groupBy("host", F.col("path").alias("beside")).agg(F.min("number").alias("low"), F.max("number").alias("high"))
    paths = paths.where(F.col("high") - F.col("low") >= NEAR)
    blocks = F.sequence(F.floor(F.col("low") / size), F.floor(F.col("high") / size)).alias("blocks")
    sides = F.explode(F.array(*(F.struct(F.lit(k).alias("side"), at.alias("number")) for k, at in enumerate((F.col("low") - 1, F.col("high") + 1))))).alias("at")
    wanted = paths.select("host", "beside", blocks, sides).select("host", "beside", "blocks", "at.side", "at.number")
    return ordered.select(*columns).join(wanted, ["host", "number"]).select(*columns, F.explode("blocks").alias("block"), "beside", "side")


def find_verdicts(pages: DataFrame) -> DataFrame:
    """(v_host, v_content, stays): for the lines of each distinct page that loses some, whether they stay; a written table."""
    spark = pages.sparkSession
    sketch = "host string, path string, url string, content binary, lines array<long>, sizes array<long>, marks array<byte>"
    rows = _rows(pages).select("host", "path", F.coalesce("url", F.lit("")).alias("url"), "html").mapInArrow(_sketch, sketch)
    place = F.min(F.struct("path", "url")).alias("place")
    one = rows.groupBy("host", "content").agg(place, *(F.any_value(c).alias(c) for c in ("lines", "sizes", "marks")))
    one = one.select("host", "content", F.col("place.path").alias("path"), F.col("place.url").alias("url"), "lines", "sizes", "marks")
    ordered, n = numbered(one, ["host", "path", "url", "content"], "pages")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(BLOCK_PAGES, -(-n // tasks))
    ends = F.array_distinct(F.array(*(F.floor((F.col("number") + d) / size) for d in (-NEAR, 0, NEAR))))
    columns = ["host", "path", "content", "lines", "sizes", "marks", "number"]
    nobody = [F.lit(None).cast("string").alias("beside"), F.lit(0).alias("side")]
    dealt = ordered.select(*columns, F.explode(ends).alias("block"), *nobody).where((F.col("block") >= 0) & (F.col("block") * size < n))
    dealt = dealt.unionByName(_others(ordered, columns, size)).repartitionByRange("block")
    dealt = dealt.sortWithinPartitions("block", F.col("beside").isNull(), "number")
    found = dealt.select(*columns, "block", "beside", "side").mapInArrow(_judge(size), "v_host string, v_content binary, stays array<boolean>")
    return materialize(found, "verdicts")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_differenced): the main text of every page, empty where there is none, and how many lines are gone because the
    nearest page has them too."""
    verdicts = find_verdicts(pages)
    n, n_lines = verdicts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("stays")), F.lit(0))).first()
    side = F.broadcast(verdicts) if n <= BROADCAST_ROWS and n_lines <= BROADCAST_LINES else verdicts
    read = _rows(pages).select("page_id", "url", "host", "html").mapInArrow(_read, "page_id long, url string, host string, content binary, lines array<string>")
    met = read.join(side, (F.col("host") == F.col("v_host")) & (F.col("content") == F.col("v_content")), "left")
    stay = F.when(F.col("stays").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: F.get("stays", i)))
    gone = (F.size("lines") - F.size("stay")).cast("long").alias("n_differenced")
    return met.withColumn("stay", stay).select("page_id", "url", F.array_join("stay", "\n").alias("text"), gone)
