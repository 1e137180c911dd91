"""Main text of web pages by deduction of templates from equivalence classes.

A page is cut into tokens: opening tags with their path, and blocks of text. Over the different pages
of one host, every token's occurrence vector (how often on which page) is condensed to a hash, by an
aggregate that is combined before the shuffle. Tokens with equal vectors form an equivalence class. A
class is valid if enough pages support it, if it joins a tag with text, and if its tokens stand in the
same order on a page. Valid classes nest in the page's elements and make up the host's template;
their texts (constant labels, notices, adverts) are template, everything else is a slot.

Of the slots those of the main content remain: blocks inside ``article`` or ``main`` (the whole body
if there is neither) and outside of elements that serve as menu, header, footer, sidebar, notice,
advert, form or comments by their tag, role, class or id. Names of ``html``, ``body`` and of what holds the
main content say nothing of that kind. Without an ``article``, blocks that are mostly links go too. Texts are decoded, white space inside a block becomes one space, blocks are joined by an
empty line.

A host needs ``LEAST_PAGES`` different pages for a class; on hosts with fewer the markup alone decides.
Pages of a host with equal main texts count once. Template texts go only where no ``article`` or ``main`` says what
the content is, and only labels do: texts of at most ``LABEL_CHARS``, in classes that are at most ``CLASS_SHARE`` of what the
markup keeps of the page. So near copies and headings that a host's articles share stay. Only hashes are
shuffled for the template. Templates of at most ``BROADCAST_TEXTS`` texts are broadcast; more of them meet
their pages by host, sorted so that a host's template comes once, before its pages. A host with more than a
thousandth of all pages is then dealt over as many parts as it has thousandths.

Cases: a null or empty html has an empty text. A null or odd url belongs to host ''. Comments, scripts and
other raw elements that never end run to the end of the page; unclosed elements end with their parent; a quote that
never ends is none; what looks like a tag and never ends is text. A page is read once from left to right, in time in
proportion to its length. Repeated rows give equal rows. Extra columns are ignored. Pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import SLICE_CHARS, cut, map_batches

LEAST_PAGES, LEAST_SHARE, BROADCAST_TEXTS = 10, 0.1, 100_000
#: Characters of a template text, and share of a page's text that one class may be, at most.
LABEL_CHARS, CLASS_SHARE = 200, 0.5

_NAME = re.compile(r"[a-zA-Z][\w:-]*")
_STOP = re.compile(r">|=\s*([\"'])")
_COMMENT_END = re.compile(r"--!?>")
_SPACE = re.compile(r"\s")
_ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[a-z]+")

#: Elements of the HTML standard by what they do to the text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body head html option td th tr tbody thead tfoot caption legend dd dt li".split())
_SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table select article section nav aside main div body html form footer header".split())
_DROPPED = frozenset("nav footer aside form menu dialog button select option fieldset legend label head search svg canvas object audio video".split())
_MAIN = frozenset("article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: Words in a class or id that say what an element is for.
_PURPOSE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social comment comments disqus reply replies respond "
    "related recommended recommendations widget pagination pager toolbar form search paywall".split()
)
#: Beginnings of compound words that say the same.
_PURPOSE_STEMS = tuple(
    "commentlist commentarea commentform commentbox commentbody commentsection commentthread advert adsby adslot adbanner "
    "adbox sidebar navbar navmenu topnav mainnav sitenav breadcrumb footer sitefooter pagefooter cookie newsletter sponsor "
    "sharebar sharebutton sociallinks relatedposts relatedarticles disqus".split()
)
#: Purposes of elements that hold articles of their own.
_HOLDERS = frozenset("comment comments disqus reply replies respond related recommended recommendations sponsored promo widget".split())
#: Words that make a compound class say something of the page ("no-sidebar", "comments-open").
_STATES = frozenset("has no with without open closed enabled disabled layout".split())
#: Raw elements end where their name follows "</", whatever stands inside.
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in _RAW}
#: Elements that an opening tag of the same kind closes, unless a container stands between.
_KINDS = tuple(dict.fromkeys(map(frozenset, [{"p"}, *_SAME.values()])))
_KIND = {kind: i for i, kind in enumerate(_KINDS)}
_KIND_NAMES = frozenset().union(*_KINDS)
_NONE = (0,) * len(_KINDS)


@dataclass
class Block:
    """A run of text: where it stands, what it says, and how much of it is linked.

    ``named``: the innermost element around it that a part of a compound name gives a purpose, by number.
    ``dropped``: 2 by tag, role or attribute, 1 only by a name.
    """

    path: int
    text: str
    linked: float
    main: bool
    dropped: int
    named: int = -1


class _Open(NamedTuple):
    """An open element.

    ``nearest``: for each kind of ``_KINDS`` the place on the stack of the nearest one without a container between.
    """

    name: str
    path: int
    main: bool
    dropped: int
    linked: bool
    named: int
    nearest: tuple[int, ...]


def _next_tag(source: str, at: int, lost: set[str]) -> tuple[int, int, str, str] | None:
    """Start, end, name ("/name" if closing, empty for comments and the like) and attributes of the next tag.

    Quotes count behind an equals sign. ``lost`` keeps the characters that don't come again, so that no search for
    them is repeated.
    """
    while ">" not in lost and (start := source.find("<", at)) >= 0:
        if source.startswith("<!--", start):
            end = _COMMENT_END.search(source, start + 4)
            return start, end.end() if end else len(source), "", ""
        closing = source.startswith("/", start + 1)
        name = _NAME.match(source, start + 1 + closing)
        if name is None and not source.startswith(("!", "?"), start + 1):
            at = start + 1
            continue
        place = name.end() if name else start + 2
        while (stop := _STOP.search(source, place)) is not None and (quote := stop[1]):
            place = stop.end()
            if quote not in lost:
                close = source.find(quote, place)
                if close < 0:
                    lost.add(quote)
                else:
                    place = close + 1
        if stop is None:
            if source.find(">", start) < 0:
                lost.add(">")
                break
            # The only ends stand in quotes: the first of them counts.
            end = source.find(">", start) + 1
        else:
            end = stop.end()
        if name is None:
            return start, end, "", ""
        return start, end, ("/" if closing else "") + name[0].lower(), source[name.end() : end - 1]
    return None


def _one_space(text: str) -> str:
    """White space as one space, trimmed; long texts a part at a time."""
    if len(text) <= SLICE_CHARS:
        return " ".join(text.split())
    parts, at = [], 0
    while at < len(text):
        space = _SPACE.search(text, min(at + SLICE_CHARS, len(text)))
        end = space.end() if space else len(text)
        parts.append(" ".join(text[at:end].split()))
        at = end
    return " ".join(filter(None, parts))


class _Page:
    """Tags (hash of their path) and blocks of one page in order."""

    def __init__(self, source: str):
        self.tags: list[tuple[int, int]] = []
        self.blocks: list[tuple[int, Block]] = []
        self.has_main = False
        self.stack = [_Open("", 0, False, 0, False, -1, _NONE)]
        self.open: dict[str, int] = {}
        # Elements with a purpose by a part of their name: the one around each, and whether a first heading is inside.
        self.around: list[int] = []
        self.titled: list[bool] = []
        self.held: list[str] = []
        self.plain = self.linked = 0
        self.order = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        lost: set[str] = set()
        while at < n:
            tag = _next_tag(source, at, lost)
            if tag is None:
                self._text(source[at:])
                break
            start, end, name, attributes = tag
            self._text(source[at:start])
            at = end
            if name.startswith("/"):
                self._close(name[1:])
            elif name:
                self._open(name, attributes)
                if name in _RAW:
                    stop = _RAW_END[name].search(source, at)
                    at = (source.find(">", stop.end()) if stop else -1) + 1 or n
                    self._cut(len(self.stack) - 1)
        self._flush()

    def _text(self, text: str) -> None:
        if text:
            self.held.append(text)
            if self.stack[-1].linked:
                self.linked += len(text)
            else:
                self.plain += len(text)

    def _flush(self) -> None:
        if self.held:
            text = _one_space(html.unescape("".join(self.held)))
            if text:
                own = self.stack[-1]
                linked = self.linked / max(1, self.linked + self.plain)
                self.blocks.append((self.order, Block(own.path, text, linked, own.main, own.dropped, own.named)))
                self.order += 1
            self.held, self.plain, self.linked = [], 0, 0

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self.held.append(" ")
            return
        if name in _BLOCK:
            self._flush()
            if name in _CLOSES_P:
                self._pop(_KIND[frozenset({"p"})])
            if name in _SAME:
                self._pop(_KIND[frozenset(_SAME[name])])
        above = self.stack[-1]
        main, dropped, named = above.main, above.dropped, above.named
        purpose, marks = _purpose(attributes) if attributes.strip(" /") else (frozenset(), "")
        path = xxhash.xxh64_intdigest(f"{above.path}>{name} {marks}")
        self.tags.append((self.order, path))
        self.order += 1
        if name in _VOID:
            return
        holds_main = name in _MAIN or "main" in purpose
        if name in ("html", "body") or (holds_main and not main):
            purpose = purpose - {"name", "part", "header", "header part"}
        elif holds_main:
            purpose = purpose - {"part"}
        if holds_main:
            named = -1  # what holds the main content is no furniture
        if name in _DROPPED or name in _RAW or "drop" in purpose or (name == "header" and not main):
            dropped = 2
        elif "name" in purpose or ("header" in purpose and not main):
            dropped = max(dropped, 1)
        elif "part" in purpose or ("header part" in purpose and not main):
            self.around.append(named)
            self.titled.append(False)
            named = len(self.around) - 1
        if name == "h1" and named >= 0:
            self.titled[named] = True
        inside = main or holds_main
        self.has_main |= inside and not main and not dropped
        nearest = _NONE if name in _SCOPE else above.nearest
        if name in _KIND_NAMES:
            nearest = tuple(len(self.stack) if name in kind else place for kind, place in zip(_KINDS, nearest, strict=True))
        self.stack.append(_Open(name, path, inside, dropped, above.linked or name == "a", named, nearest))
        self.open[name] = self.open.get(name, 0) + 1

    def main_blocks(self) -> list[Block]:
        """The blocks that the markup alone gives as main content.

        A purpose that is a part of a compound name does not count for an element that holds most of the
        text and a first heading, or most of the text when nothing else is left.
        """
        area = [b for _, b in self.blocks if b.main or not self.has_main]
        open_ = [b for b in area if not b.dropped]
        held = [0] * (len(self.around) + 1)  # the last for blocks inside none
        for block in open_:
            held[block.named] += len(block.text)
        titled = [*self.titled, False]
        for i in range(len(self.around) - 1, -1, -1):
            held[self.around[i]] += held[i]
            titled[self.around[i]] |= titled[i]
        half = sum(len(b.text) for b in open_) / 2
        most, first = [True] * len(held), [True] * len(held)
        for i, around in enumerate(self.around):
            most[i] = most[around] and held[i] > half
            first[i] = first[around] and most[i] and titled[i]
        kept = [b for b in open_ if first[b.named]]
        kept = kept or [b for b in open_ if most[b.named]]
        if not kept:
            kept = [b for b in area if b.main and b.dropped < 2 and b.named < 0]
        return kept if self.has_main else [b for b in kept if b.linked <= 0.5 or b.main]

    def _cut(self, size: int) -> None:
        """Close all elements from place ``size`` on."""
        for closed in self.stack[size:]:
            self.open[closed.name] -= 1
        del self.stack[size:]

    def _close(self, name: str) -> None:
        if name in _BLOCK:
            self._flush()
        if self.open.get(name):
            place = len(self.stack) - 1
            while self.stack[place].name != name:
                place -= 1
            self._cut(place)

    def _pop(self, kind: int) -> None:
        """Close the nearest open element of ``kind`` unless a container stands in between."""
        if place := self.stack[-1].nearest[kind]:
            self._cut(place)


def _purpose(attributes: str) -> tuple[set[str], str]:
    """What an element's attributes say about it, and class and id for its path."""
    out, marks = set(), []
    for found in _ATTRIBUTE.finditer(attributes):
        name = (found[1] or "").lower()
        if name == "hidden":
            out.add("drop")
        if name not in ("class", "id", "role", "itemprop", "style") or found[2] is None:
            continue
        value = found[2].strip("\"'").lower()
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                out.add("drop")
            continue
        words = _WORD.findall(value)
        if name == "role":
            out.update("drop" for w in words if w in _ROLES)
            out.update("main" for w in words if w == "main")
        elif name == "itemprop":
            out.update("main" for _ in range(value == "articlebody"))
        else:
            marks.append(f"{name}={' '.join(words)}")
            out.update(kind for token in value.split() for kind in _name_purpose(token))
    return out, " ".join(marks)


def _name_purpose(token: str) -> Iterator[str]:
    """name: the token itself says what the element is for; part: one word of a compound does."""
    words = _WORD.findall(token)
    if len(words) > 1 and not _STATES.isdisjoint(words):
        return
    for word in words:
        if word in _PURPOSE or word.startswith(_PURPOSE_STEMS):
            holder = word in _HOLDERS or word.startswith(("comment", "related", "disqus"))
            yield "name" if len(words) == 1 or holder else "part"
        if word in ("header", "siteheader", "pageheader"):
            yield "header" if len(words) == 1 else "header part"


def _text_token(block: Block) -> int:
    return xxhash.xxh64_intdigest(block.text, block.path)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def page_text(source: str | None, template: dict[int, tuple[int, int]] | None = None) -> str:
    """The main text; ``template`` gives class and place of the host's template texts."""
    if not source:
        return ""
    page = _Page(source)
    kept = page.main_blocks()
    if template and not page.has_main:
        fixed = _template_texts(page, kept, template)
        slots = [b for b in kept if len(b.text) > LABEL_CHARS or _text_token(b) not in fixed]
        kept = slots or kept
    return "\n\n".join(b.text for b in kept)


def _template_texts(page: _Page, kept: list[Block], template: dict[int, tuple[int, int]]) -> set[int]:
    """Tokens of the template on this page: classes in the template's order that are a small part of the text."""
    last: dict[int, int] = {}
    refused = set()
    found = [(t, *template[t]) for t in (_text_token(b) for _, b in page.blocks) if t in template]
    for _, number, place in found:
        if place < last.get(number, -1):
            refused.add(number)
        last[number] = place
    most = CLASS_SHARE * sum(len(b.text) for b in kept)
    taken: dict[int, int] = {}
    for block in kept:
        if (number := template.get(_text_token(block), (None,))[0]) is not None:
            taken[number] = taken.get(number, 0) + len(block.text)
    refused.update(number for number, size in taken.items() if size > most)
    return {t for t, number, _ in found if number not in refused}


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _tokens(rows: DataFrame) -> DataFrame:
    """host, page (digest of the main texts), token, kind (1: text), n, at: the tokens of each page (first place, count)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, pages, tokens, kinds, counts, places = [], [], [], [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = source.as_py()
            page = _Page(text)
            seen: dict[tuple[int, int], list[int]] = {}
            for at, path in page.tags:
                seen.setdefault((path, 0), [at, 0])[1] += 1
            for at, block in page.blocks:
                seen.setdefault((_text_token(block), 1), [at, 0])[1] += 1
            hosts.extend([host] * len(seen))
            own = "\n\n".join(b.text for b in page.main_blocks()) or text
            pages.extend([xxhash.xxh64_intdigest(own)] * len(seen))
            for (token, kind), (at, n) in seen.items():
                tokens.append(token)
                kinds.append(kind)
                counts.append(n)
                places.append(at)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()), pa.array(_signed(pages)), pa.array(_signed(tokens)),
                pa.array(kinds, pa.int32()), pa.array(counts, pa.int32()), pa.array(places, pa.int32()),
            ],
            ["host", "page", "token", "kind", "n", "at"],
        )

    source = rows.where("html <> ''").select("host", "html")
    return map_batches(source, run, "host string, page long, token long, kind int, n int, at int")


def templates(rows: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host, template (array of token, class, place): the texts of valid classes of each host.

    ``rows`` has host and html.
    """
    once = _tokens(rows).groupBy("host", "token", "kind", "page").agg(F.max("n").alias("n"), F.min("at").alias("at"))
    vectors = (
        once.groupBy("host", "token", "kind")
        .agg(
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
            F.count("*").alias("support"),
            F.avg("at").alias("at"),
        )
        .where(F.col("support") >= least_pages)
    )
    vectors = cut(vectors)
    # A page has one outermost tag at least, so the widest support bounds the host's pages from below.
    size = vectors.groupBy("host").agg(F.max("support").alias("pages"))
    classes = (
        vectors.groupBy("host", "vector", "support")
        .agg(F.min("kind").alias("low"), F.max("kind").alias("high"))
        .where("low = 0 and high = 1")
        .join(size, "host")
        .where(F.col("support") >= F.col("pages") * least_share)
        .select("host", "vector", "support")
    )
    texts = vectors.where("kind = 1").join(classes, ["host", "vector", "support"])
    place = F.struct("token", F.col("vector").alias("class"), F.col("at").alias("place"))
    return texts.groupBy("host").agg(F.collect_list(place).alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        _host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"),
    )
    known = cut(templates(rows.select("host", "html")))
    if (known.agg(F.sum(F.size("template"))).first()[0] or 0) <= BROADCAST_TEXTS:
        few = {r.host: [tuple(t) for t in r.template] for r in known.toLocalIterator()}
        given = rows.sparkSession.sparkContext.broadcast(few)
        rows = rows.select("page_id", "url", "host", F.lit(None).cast(known.schema["template"].dataType).alias("template"), "html")
    else:
        given = None
        rows = _beside_templates(rows, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, template = None, {}
        for batch in batches:
            places, texts = [], []
            for i, host in enumerate(batch.column("host").to_pylist()):
                head = batch.column("template")[i]
                if head.is_valid:  # the template of the pages that follow
                    now, template = host, _places([(t["token"], t["class"], t["place"]) for t in head.as_py()])
                    continue
                if host != now:
                    now, template = host, _places(given.value.get(host, []) if given else [])
                texts.append(page_text(batch.column("html")[i].as_py(), template))
                places.append(i)
            own = batch.take(pa.array(places, pa.int64()))
            columns = [own.column("page_id"), own.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def _beside_templates(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` by host, behind a row with the host's template. Parts of a large host have a row each."""
    counts = cut(rows.groupBy("host").agg(F.count("*").alias("n")))
    least = (counts.agg(F.sum("n")).first()[0] or 0) / 1000
    # Fewer than a thousand hosts are this large, whatever the number of hosts.
    large = F.broadcast(counts.where(F.col("n") > least).select("host", F.ceil(F.col("n") / least).cast("int").alias("parts")))
    pages = rows.join(large, "host", "left").withColumn("part", F.pmod(F.xxhash64("html", "url"), F.coalesce("parts", F.lit(1))))
    heads = known.join(large, "host", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), (F.coalesce("parts", F.lit(1)) - 1).cast("long")))
    )
    both = pages.drop("parts").unionByName(heads.drop("parts"), allowMissingColumns=True)
    both = both.repartition("host", "part").sortWithinPartitions("host", "part", F.col("template").isNull())
    return both.select("page_id", "url", "host", "template", "html")


def _places(template: list[tuple[int, int, float]]) -> dict[int, tuple[int, int]]:
    """Token -> class and rank of its place there, of (token, class, place)."""
    ordered = sorted(template, key=lambda t: (t[2], t[0]))
    return {token % (1 << 64): (number, rank) for rank, (token, number, _) in enumerate(ordered)}
