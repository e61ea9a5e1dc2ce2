"""Main text of web pages, by markup and by a host suffix array.

A page is divided into blocks, leaving out what markup names as no text of the page (scripts,
menus, headers, footers, sidebars, notices, adverts, forms, reader comments; within an article names
count only if they are plain or the element is made of links or a form; a form that is a frame around
the page's article or paragraphs is none). The token streams of all pages of a host are put together, their suffixes
are sorted by the first ``RUN`` tokens (prefix doubling), and equal neighbours from ``PAGES`` distinct
pages are boilerplate. Blocks that lie in such runs are repeated.

Repeated blocks go, and so does what lies around the page's articles (or main part) where most of the other
text is in them. What markup puts into such an article is checked last: it stays though it is
repeated, unless its element has a doubtful name.

Pages stay where they were parsed: a part is a row of pages of any hosts, stored once. A part sorts the suffixes of its
own pages, host by host, and how many distinct pages have a run is added up over the parts, so that nothing depends on the
dealing. What is shuffled is runs, never texts: first a few bits of each run's hash, which leave over the runs that may be
boilerplate, then the whole hashes of those.

Defined cases: a null html is empty and gives the empty text, as does a page without text; a null
url is a host of its own; rows repeated exactly count as one page of the host and each
give their text; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from itertools import chain as one_by_one

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import (
    WordHashes, among, chain, clear_shuffles, finish, map_batches, packed, packed_rising, parts_for, store, unpacked, unpacked_rising,
)
from prefdata.sources.buckets import Buckets, bucket_count, write_rows

RUN = 8  # tokens of a repeated run at least
PAGES = 3  # distinct pages that it is found on at least
COVERED = 0.7  # of a block's tokens, for it to go
PART_TOKENS = 1_000_000  # or TOKEN_CHARS times as many characters
TOKEN_CHARS = 16
SHARD_RUNS = 2_000_000  # runs that are counted in one task, about
SHORT_BITS = 27  # of a run's hash within its shard: other runs with the same bits are few

# Elements by what they hold, and words that name such parts in attributes.
NO_TEXT = frozenset(
    "head script style noscript template iframe svg math object embed canvas audio video map "
    "nav footer aside button select textarea dialog menu".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ENDS_P = BLOCK - {"html", "body"}
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split()
)
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer discussion footer header masthead menu modal nav navbar navigation newsletter "
    "notice notices notification pagination pager popup promo promoted promotion related replies "
    "respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
LAYOUT_WORDS = frozenset("has layout no with without".split())
# Within an article a name is taken for chrome as it stands only when nothing but these words is left of it.
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments cookie cookies footer "
    "header masthead navbar newsletter pager pagination popup promo share sharing sidebar signup sponsored subscribe".split()
)
STRONG_IDS = frozenset("ad ads advert comment comments footer sidebar".split())  # others may be anchors
NEUTRAL_WORDS = frozenset("area article block box container entry list post section slot unit wrap wrapper".split())
CONTROLS = frozenset("button form input select textarea".split())
LINKED = 0.5  # of a doubtful element's letters, for it to go
FORM_WORDS = 50  # of a doubtful element with controls at most, for it to go
FORM_PARAGRAPHS = 2  # of a form that holds more words, for it to be a frame around a page's text

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    # A quote opens a value only behind a sign of equality; in an unquoted value it is a letter.
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*|))*?)(?P<closed>>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_PIECES = re.compile(r"[a-z]+")
_ATTRIBUTE_WORDS = frozenset("comment comments newsletter reply respond search signup subscribe".split())  # of forms
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


_TEXT, _HEADER, _CHROME = 0, 1, 2  # what an open element holds; of an article's header headings count
_DOUBT = -1  # text unless it turns out to be links or a form


def _strong(key: str, word: str, words: frozenset = STRONG_WORDS) -> bool:
    """Whether a class or id, without what says nothing, is made of names of chrome alone."""
    parts = [p for p in _PIECES.findall(word) if p not in NEUTRAL_WORDS]
    strong = words & STRONG_IDS if key == "id" else words
    return CHROME_WORDS.issuperset(parts) and not strong.isdisjoint(parts)


def _kind(name: str, attributes: str, in_article: bool) -> int:
    """What markup says of an element within text."""
    if name in NO_TEXT:
        return _CHROME
    if name == "form":  # a frame around the whole page, or a form
        return _CHROME if _ATTRIBUTE_WORDS.intersection(_PIECES.findall(attributes.lower())) else _DOUBT
    header = _HEADER if in_article else _CHROME
    if name == "header":
        return header
    if name in ("article", "main", "body", "html"):
        named = [(k.lower(), next((v for v in vs if v), "").lower()) for k, *vs in _ATTRIBUTE.findall(attributes)]
        words = [(k, w) for k, value in named if k in ("class", "id") for w in value.split()]
        remark = frozenset(["comment", "comments"])
        return _CHROME if name == "article" and any(_strong(k, w, remark) for k, w in words) else _TEXT
    kind = _TEXT
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "hidden" or (key == "role" and value in CHROME_ROLES):
            return _CHROME
        if key == "style" and "display:none" in value.replace(" ", ""):
            return _CHROME
        if key in ("class", "id") and name not in HEADINGS:
            for word in value.split():
                parts = _PIECES.findall(word)
                if parts and parts[0] not in LAYOUT_WORDS:
                    if parts[0] in CHROME_WORDS or parts[-1] in CHROME_WORDS:
                        # Code marks its comments by inline elements.
                        remark = name not in BLOCK and parts[0] == "comment"
                        heads = not {parts[0], parts[-1]}.isdisjoint(("header", "masthead"))
                        if in_article and (remark or heads or not _strong(key, word)):
                            kind = _DOUBT
                            continue
                        return _CHROME
    return kind


def blocks(html: str) -> tuple[list[str], bool]:
    """The page's blocks of text by markup alone, and whether they are those of a named article."""
    found = _found(html)
    return _chosen(found, [False] * len(found))


def _found(html: str) -> list[tuple[str, str, int, bool]]:
    """The page's blocks: part of the page, block, its letters outside links, whether its element's name is in doubt."""
    found: list[tuple[str, str, int, bool]] = []
    # Open element, what it lies in, part of the page, whether it is a link, and where it began if in doubt.
    stack: list[tuple[str, int, str, bool, tuple | None]] = []
    text: list[str] = []
    chrome, part = _TEXT, ""
    raw_end = None
    letters = linked = links = controls = own = 0  # so far; links: open now; own: the block's outside links
    paragraphs = mains = 0  # so far; mains: articles and main parts

    def flush():
        nonlocal own
        block = " ".join(unescape("".join(text)).split())
        text.clear()
        if block:
            found.append((part, block, own, False))
        own = 0

    def close() -> str:
        nonlocal chrome, part, links
        name, before, outer, link, doubt = stack.pop()
        if doubt and not chrome:
            flush()
        if doubt:
            begun, n, m, c, p, a = doubt
            few = sum(len(b.split()) for _, b, *_ in found[begun:]) <= FORM_WORDS
            gone = linked - m >= LINKED * max(letters - n, 1) or (controls > c and few)
            if name == "form":
                gone = mains == a and (gone or few or paragraphs - p < FORM_PARAGRAPHS)
            if gone:
                del found[begun:]
            elif mains == a:
                found[begun:] = [(q, b, size, True) for q, b, size, _ in found[begun:]]
        links -= link
        chrome, part = before, outer
        return name

    at = 0
    while at <= len(html):
        if raw_end:
            end = re.compile(rf"</{raw_end}(?=[\s/>])", re.I).search(html, at)
            if not end:
                break
            at, raw_end = end.start(), None
        tag = _TAG.search(html, at)
        if not chrome:
            text.append(html[at : tag.start() if tag else len(html)])
            n = sum(map(len, text[-1].split()))
            letters += n
            linked, own = (linked + n, own) if links else (linked, own + n)
        if not tag:
            break
        at = tag.end()
        if not tag["name"]:
            continue
        name = tag["name"].lower()
        if not tag["closed"]:
            break  # cut within a tag
        if tag["end"]:
            if name in BLOCK and not chrome:
                flush()
            elif name == "br" and not chrome:
                text.append(" ")
            if any(x[0] == name for x in stack):
                while stack:
                    if close() == name:
                        break
            continue
        controls += name in CONTROLS
        paragraphs += name == "p"
        if name in BLOCK or name == "br":
            if not chrome:
                flush() if name in BLOCK else text.append(" ")
            if name in ENDS_P and stack and stack[-1][0] == "p":
                close()
            if name in ("li", "td", "th", "tr", "dd", "dt") and stack and stack[-1][0] == name:
                close()
        if name == "body" and stack and any(x[0] == "head" for x in stack):
            stack.clear()
            chrome, part, links = _TEXT, "", 0
        if name in VOID or (tag["attributes"].endswith("/") and name not in BLOCK):
            continue
        link = name == "a" and "href" in tag["attributes"].lower()
        kind = _kind(name, tag["attributes"], bool(part)) if chrome != _CHROME else _CHROME
        doubt = (len(found), letters, linked, controls, paragraphs, mains) if kind == _DOUBT and name in BLOCK else None
        stack.append((name, chrome, part, link, doubt))
        links += link
        if chrome == _HEADER and name in HEADINGS:
            chrome = _TEXT
        elif chrome != _CHROME:
            chrome = max(chrome, kind)
            if chrome == _TEXT and not part.endswith("article"):
                if name == "article":
                    part, mains = f"{part} article".strip(), mains + 1
                elif name == "main" or _MAIN_ROLE.search(tag["attributes"]):
                    part, mains = "main", mains + 1
        if name in RAW:
            raw_end = name
    if not chrome:
        flush()
    while stack:
        close()
    return found


PARTS = ("", "main", "article", "main article")


def _chosen(found: list[tuple[str, str, int, bool]], repeated: list[bool]) -> tuple[list[str], bool]:
    """Of all articles, the main part and the whole page the first that holds as much as what lies around it.

    What lies around them counts and stays only if it isn't repeated on other pages of the host.
    """
    whole = [block for (_, block, _, _), again in zip(found, repeated) if not again]
    size = dict.fromkeys(PARTS, 0)
    for (part, _, n, _), again in zip(found, repeated):
        size[part] += 0 if again and not part else n
    articles = size["article"] + size["main article"]
    named = articles + size["main"]
    if not any(p for p, *_ in found) or named < size[""]:
        return whole, False
    own = [(p, b) for (p, b, _, doubt), again in zip(found, repeated) if p and not (doubt and again)]
    if any(p.endswith("article") for p, *_ in found) and articles >= size["main"]:
        return [b for p, b in own if p.endswith("article")], True
    return [b for _, b in own], True


def host_of(url: str | None) -> str:
    match = _HOST.match(url or "")
    return match[1].lower() if match else ""


def _parsed(pages: DataFrame) -> DataFrame:
    """Parts of about ``PART_TOKENS``: pages of a task one after another, their blocks the lines of one text."""

    def part(rows: list[tuple], tokens: int) -> dict:
        page_id, url, key, lines, marks = zip(*rows)
        return {
            "page_id": [list(page_id)],
            "url": [list(url)],
            "key": [list(key)],
            "text": ["\n".join(one_by_one(*lines))],
            "n_blocks": [[len(own) for own in lines]],
            "marks": [list(one_by_one(*marks))],
            "tokens": [tokens],
        }

    def run(batches):
        rows, tokens, room = [], 0, PART_TOKENS
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                found = _found(html or "")
                lines = [b for _, b, *_ in found]
                # Part of the page, doubt and letters of each block in a number.
                marks = [PARTS.index(p) * 2 + doubt + n * 8 for p, _, n, doubt in found]
                name = "\n".join([host_of(url), *lines, *map(str, marks)])
                rows.append((page_id, url, xxhash.xxh3_128_digest(name), lines, marks))
                n = sum(b.count(" ") + 1 for b in lines)
                tokens, room = tokens + n, room - 1 - max(n, sum(map(len, lines)) // TOKEN_CHARS)
                if room <= 0:
                    yield part(rows, tokens)
                    rows, tokens, room = [], 0, PART_TOKENS
        if rows:
            yield part(rows, tokens)

    return map_batches(
        pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"), "url", "html"),
        run,
        # Ids are texts here: pandas would make a double of a null's neighbours.
        "page_id array<string>, url array<string>, key array<binary>, text string, n_blocks array<int>, "
        "marks array<long>, tokens long",
    ).withColumn("part", F.monotonically_increasing_id())


def _marked(blocks: list[str], marks: list[int]) -> list[tuple[str, str, int, bool]]:
    return [(PARTS[m % 8 // 2], b, m // 8, bool(m % 2)) for b, m in zip(blocks, marks)]


def _stream(pages: list[list[str]], hosts: list[str] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all pages one after another, page of each token, block of each token.

    A token no page has stands between pages, so no run crosses them. With hosts equal words of two hosts are two tokens.
    """
    words = [text.split() for own in pages for text in own]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n_blocks = np.fromiter(map(len, pages), np.int64, len(pages))
    page_of_block = np.repeat(np.arange(len(pages)), n_blocks)
    block_in_page = np.arange(len(words)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    own = np.repeat(page_of_block, sizes)
    hashes = WordHashes().of(list(one_by_one(*words)))
    if hosts is not None:
        hashes = chain(WordHashes().of(hosts)[own], hashes)
    at = np.arange(len(own)) + own
    ends = np.cumsum(np.bincount(own, minlength=len(pages)) + 1) - 1
    tokens = np.zeros(len(own) + len(pages), np.uint64)
    page, block = np.zeros((2, len(tokens)), np.int64)
    tokens[at], page[at], block[at] = hashes, own, np.repeat(block_in_page, sizes)
    tokens[ends], page[ends], block[ends] = np.arange(len(pages)) * 2 + 1, -1 - np.arange(len(pages)), -1
    return tokens, page, block


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` tokens (a power of two); equal runs, equal ranks.

    Prefix doubling: the rank by 2k tokens is that of the pair of ranks k apart.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    k = 1
    while k < depth:
        behind = np.full(len(rank), -1, np.int64)
        behind[: max(0, len(rank) - k)] = rank[k:]
        rank = np.unique(rank * (len(rank) + 2) + behind + 1, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return rank


def _inside(page: np.ndarray, depth: int) -> np.ndarray:
    """Whether a whole run within a page begins at each token."""
    inside, whole = np.zeros(len(page), bool), max(0, len(page) - depth + 1)
    inside[:whole] = (page[:whole] >= 0) & (page[:whole] == page[depth - 1 :])
    return inside


def _names(tokens: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Hashes of the runs that begin at these tokens."""
    name = np.zeros(len(at), np.uint64)
    for k in range(depth):
        name = chain(name, tokens[at + k])
    return finish(name)


def runs(pages: list[list[str]], depth: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the run at each suffix, whole run within a page, page, block)."""
    tokens, page, block = _stream(pages)
    inside = _inside(page, depth)
    rank = suffix_ranks(tokens, depth)
    names = np.zeros(len(tokens), np.uint64)
    first = np.unique(rank, return_index=True)[1]
    whole = np.flatnonzero(inside[first])
    names[whole] = _names(tokens, first[whole], depth)
    return names[rank], inside, page, block


class _Part:
    """A row of ``_parsed``; a page that it has several times is one of its distinct pages."""

    def __init__(self, rows: pd.DataFrame):
        row = rows.iloc[0]
        self.part, self.page_id, self.url = int(row["part"]), row["page_id"], list(row["url"])
        edges = np.cumsum([0, *row["n_blocks"]])
        lines, marks = row["text"].split("\n") if edges[-1] else [], list(row["marks"])
        place: dict[bytes, int] = {}
        self.which = [place.setdefault(bytes(k), len(place)) for k in row["key"]]
        self.first = np.unique(self.which, return_index=True)[1]
        self.blocks = [lines[edges[i] : edges[i + 1]] for i in self.first]
        self.marks = [marks[edges[i] : edges[i + 1]] for i in self.first]
        self.tokens, self.page, self.block = _stream(self.blocks, [host_of(self.url[i]) for i in self.first])
        self.inside = np.flatnonzero(_inside(self.page, RUN))

    def teaches(self, said: pd.DataFrame) -> np.ndarray:
        """Which of the distinct pages are counted here; of the others a copy in another part is."""
        own = [p for p in said["pages"] if p is not None]
        return np.isin(self.first, own[0]) if own else np.zeros(len(self.first), bool)

    def names(self) -> np.ndarray:
        return _names(self.tokens, self.inside, RUN)


def _by_shard(part: int, runs: np.ndarray, pages: np.ndarray, shard: np.ndarray) -> pd.DataFrame:
    """A row for each shard that has some of the runs; they come in the order of shard and run."""
    asked, edges = np.unique(shard, return_index=True)
    ends = np.append(edges[1:], len(runs))
    out = [(int(k), part, packed_rising(runs[a:b]), packed(pages[a:b])) for k, a, b in zip(asked, edges, ends)]
    return pd.DataFrame(out, columns=["shard", "part", "runs", "pages"])


_ASKED = "shard int, part long, runs binary, pages binary"


def _shard_of(name: np.ndarray, shards: int) -> np.ndarray:
    return ((name >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _short(name: np.ndarray, shards: int) -> np.ndarray:
    """A run's shard and the last bits of its hash."""
    return _shard_of(name, shards) << SHORT_BITS | (name & np.uint64((1 << SHORT_BITS) - 1)).astype(np.int64)


def _ask_short(shards: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Of each run of a part the shard and a few bits, with how many pages have it, from the part's suffix array."""

    def run(rows: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return _by_shard(0, *np.zeros((3, 0), np.int64))
        part, n = _Part(rows), len(rows["key"].iloc[0])
        rank = suffix_ranks(part.tokens, RUN)[part.inside]
        # Each run of a page once; equal runs lie side by side.
        once, at = np.unique(rank * n + part.page[part.inside], return_index=True)
        begins = np.flatnonzero(np.diff(once // n, prepend=-1))
        teaches = part.teaches(said)[once % n].astype(np.int64)
        pages = np.add.reduceat(teaches, begins) if len(begins) else teaches
        short = _short(_names(part.tokens, part.inside[at[begins]], RUN), shards)
        order = np.argsort(short)
        begins = np.flatnonzero(np.diff(short[order], prepend=-1))
        pages = np.add.reduceat(pages[order], begins) if len(begins) else pages
        short = short[order][begins]
        own = short & ((1 << SHORT_BITS) - 1)
        return _by_shard(part.part, own.astype(np.uint32), np.minimum(pages, PAGES).astype(np.uint8), short >> SHORT_BITS)

    return run


def _ask_names(shards: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The whole hashes of the runs whose few bits are on enough pages, with how many of the part's pages have each."""

    def run(rows: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return _by_shard(0, *np.zeros((3, 0), np.int64))
        part = _Part(rows)
        names = part.names()
        asked = [(int(s) << SHORT_BITS) + unpacked_rising(r, np.uint32).astype(np.int64)
                 for s, r in zip(said["shard"], said["runs"]) if r is not None]
        some = np.flatnonzero(among(_short(names, shards), np.sort(np.concatenate([np.zeros(0, np.int64), *asked]))))
        name, page = names[some], part.page[part.inside[some]]
        shard = _shard_of(name, shards)
        order = np.lexsort((page, name, shard))
        name, page, shard = name[order], page[order], shard[order]
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        other = new.copy()
        other[1:] |= page[1:] != page[:-1]
        begins = np.flatnonzero(new)
        teaches = part.teaches(said)[page] & other
        pages = np.add.reduceat(teaches.astype(np.int64), begins) if len(begins) else np.zeros(0, np.int64)
        return _by_shard(part.part, name[begins], np.minimum(pages, PAGES).astype(np.uint8), shard[begins])

    return run


def _often(kind: type) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Which of its runs are on enough pages of all parts, for each part that has runs in this shard."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = [unpacked_rising(r, kind) for r in rows["runs"]]
        names, which = np.unique(np.concatenate(own), return_inverse=True)
        pages = np.concatenate([unpacked(p, np.uint8) for p in rows["pages"]])
        often = np.bincount(which, weights=pages, minlength=len(names)) >= PAGES
        hit = np.split(often[which], np.cumsum([len(r) for r in own])[:-1])
        found = rows[["shard", "part"]].assign(runs=[packed_rising(r[h]) for r, h in zip(own, hit)])
        return found[[bool(h.any()) for h in hit]]

    return run


def repeated(part: _Part, boilerplate: np.ndarray) -> list[list[bool]]:
    """Whether each block of the part's distinct pages is covered by boilerplate runs (rising hashes)."""
    hit = np.zeros(len(part.tokens), bool)
    hit[part.inside] = among(part.names(), boilerplate)
    covered = np.zeros(len(hit), bool)
    for k in range(RUN):
        covered[k:] |= hit[: max(0, len(hit) - k)]
    first = np.cumsum([0] + [len(own) for own in part.blocks])
    text = part.page >= 0
    at = first[part.page[text]] + part.block[text]
    size = np.bincount(at, minlength=first[-1])
    again = np.bincount(at, weights=covered[text], minlength=first[-1]) >= COVERED * np.maximum(size, 1)
    return [again[a:b].tolist() for a, b in zip(first, first[1:])]


def _clean(rows: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"page_id": [], "url": [], "text": [], "n_repeated": []})
    part = _Part(rows)
    known = np.sort(np.concatenate([np.zeros(0, np.uint64), *(unpacked_rising(r, np.uint64) for r in said["runs"])]))
    again = repeated(part, known)
    texts = ["\n\n".join(_chosen(_marked(b, m), g)[0]) for b, m, g in zip(part.blocks, part.marks, again)]
    return pd.DataFrame({
        "page_id": pd.array([None if i is None else int(i) for i in part.page_id], dtype="Int64"),
        "url": part.url,
        "text": [texts[i] for i in part.which],
        "n_repeated": [sum(again[i]) for i in part.which],
    })


def _counted(parts: Buckets, said: DataFrame, ask: Callable, kind: type) -> DataFrame:
    """(shard, part, runs): the runs of each part that are on enough pages; ``ask`` chooses those that are counted."""
    asked = parts.read().groupBy("part").cogroup(said.groupBy("part")).applyInPandas(ask, _ASKED)
    return store(asked.groupBy("shard").applyInPandas(_often(kind), "shard int, part long, runs binary"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_repeated) of every row; n_repeated: blocks that other pages of the host have too.

    Every distinct page of a host counts once, however often it is there.
    """
    spark = pages.sparkSession
    parts = write_rows(_parsed(pages), "part", 2 * bucket_count(spark))
    shards = parts_for(parts.read().agg(F.sum("tokens")).first()[0] or 0, SHARD_RUNS)
    keys = parts.read_files().select("part", F.posexplode("key").alias("at", "key"))
    firsts = keys.groupBy("key").agg(F.min(F.struct("part", "at")).alias("first")).groupBy("first.part")
    none = F.lit(None)
    counts_here = store(firsts.agg(F.collect_list("first.at").alias("pages"))).select(
        "part", none.cast("int").alias("shard"), none.cast("binary").alias("runs"), "pages"
    )
    short = _counted(parts, counts_here, _ask_short(shards), np.uint32)
    clear_shuffles(spark)
    asked = short.withColumn("pages", none.cast("array<int>"))
    known = _counted(parts, counts_here.unionByName(asked), _ask_names(shards), np.uint64)
    clear_shuffles(spark)
    found = parts.read().groupBy("part").cogroup(known.groupBy("part")).applyInPandas(
        _clean, "page_id long, url string, text string, n_repeated long"
    )
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


def op8_html(pages: DataFrame) -> DataFrame:
    return extract(pages)
