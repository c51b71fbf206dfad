"""Main text of HTML pages: markup marks regions, and a suffix array per host finds repeated boilerplate.

1. A page is read into blocks of text. Elements that hold no article text (menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles, reader comments: by element, role, class or id) are left out. Where the page marks its
   article (``article``, else ``main``, else a class or id that says so), only that region is read, and its blocks are
   *marked*; on other pages all remaining blocks are *open*.
2. The token streams of a host's pages are concatenated, and those of the texts left out, and a suffix array is built by
   prefix doubling, up to the first ``RUN`` tokens, which is all that is compared: suffixes of equal rank share a substring
   of ``RUN`` tokens, and the union of such substrings that start on two or more pages with different text is what longer
   repeats cover as well.
3. Of open blocks, covered tokens are boilerplate and go; unique runs stay. A page that is almost whole in long runs
   of one other page, and of no third, is a copy rather than boilerplate and stays. Of marked blocks, what is on most of the host's pages (pages with
   different text that have it in or outside of their blocks, added up) is its template and goes; what fewer quote is text.

Spark deals pages to tasks by host, small hosts packed together. A host of more than ``PACK_BYTES`` of HTML has its
distinct texts dealt to chunks of about that size, in one shuffle. A chunk sends the anchors of its windows of ``RUN`` tokens,
the least hash of the grams in each, about a quarter of the places, as gaps of their leading bits. Equal windows have equal
anchors, so only windows whose anchor another chunk has need leave their chunk; they meet by a 128-bit hash, and a repeat counts
wherever on the host its places are. Pages are shuffled with their text, as page_id and url once the text is sent; of a text
with more than ``COPIES`` pages they are joined to its result.

Defined results: a null html is an empty one; a page without text gets the empty text; a null url is a host of its own;
rows that repeat are read alike, and equal pages don't make each other's text boilerplate; unclosed elements end with the
element around them; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import cached_property
from hashlib import blake2b
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tickforge.llm.common import HOT_KEYS, join_counted, staged, table  # noqa: F401 (a test sets HOT_KEYS here)
from tickforge.operators.positions import positioned

RUN, COPY_SHARE, PACK_BYTES = 12, 0.9, 8_000_000
#: Tokens of a run that is long, for copies.
LONG = 48
#: Tasks that the packs are dealt to at most; two a pack below that, so that few tasks get several packs.
MOST_TASKS = 100_000
#: Marked text goes only if it is on most pages of its host, and on so many: fewer don't tell a template from a quote.
LEAST_PAGES = 4
#: Tokens of the grams that anchor windows: equal windows have the same least gram.
ANCHOR = 6
#: Places that are hashed at a time, so that they stay in a core's cache.
BLOCK = 1 << 14
#: Split hosts are broadcast up to this many.
MOST_HOSTS = 500_000
#: Low bits of a chunk's number, for the place in its host.
CHUNK_BITS = 24
#: Texts that a task remembers having sent.
MEMO = 200_000
#: Pages with one text that go to its chunk at most; those of a text with more are joined to its result.
COPIES = 10_000
#: Chunks whose anchors meet in one task, on average.
BUCKET_CHUNKS = 16
#: What a row tells a chunk: shared anchors, a text outside and its pages, the host's number of texts, a window of other chunks.
ANCHORS, ASIDE, TOTAL, WINDOW = range(4)

#: HTML's elements. Raw text ends at its own end tag only; void elements have no end tag.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text runs on in the line around them; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr img".split())
#: Hidden elements, which break no line either.
HIDDEN = frozenset("script style noscript template title noframes noembed".split())
#: Elements that end an open one of the same line here when they begin, up to the element that holds them.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
#: Elements, roles and words of class names or ids that mark what is no article text.
DROPPED = frozenset("nav header footer aside form menu dialog template svg math canvas object audio video button select "
                    "option datalist head".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription paywall sidebar sidebars rail widget "
    "widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus "
    "replies respond share sharing social related recommended recommendations toolbar login signup search copyright legal "
    "pagination pager skip".split())
ARTICLE_NAMES = frozenset("article content post entry story main".split())
_NEGATED = frozenset("has with no without not".split())

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
#: An attribute with its value, which is consumed whole: what looks like a name inside of it is none.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def _marks(element: str, attributes: str) -> tuple[bool, int]:
    """(is no article text, the kind of article region it may be: 0 none) by the element's name and attributes."""
    if element in DROPPED:
        return True, 0
    values: dict[str, str] = {}
    for name, *value in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), "".join(value).lower())
    role = values.get("role", "").strip()
    dropped = "hidden" in values or values.get("aria-hidden", "").strip() == "true" or role in DROPPED_ROLES
    named, comment = False, False
    for name in ("class", "id"):
        for word in values.get(name, "").split():
            comment |= "comment" in word
            parts = set(re.split(r"[^a-z0-9]+", word))
            if not _NEGATED & parts:
                dropped |= bool(DROPPED_NAMES & parts)
                named |= bool(ARTICLE_NAMES & parts)
    if element in ("html", "body", "main", "article") and not (element == "article" and comment):
        dropped = False
    return dropped, {"article": 1, "main": 2}.get(element, 2 if role in ("main", "article") else 4 if named else 0)


def _end_implied(stack: list, element: str) -> None:
    """End the open elements that the start of a block element ends: a paragraph, and an item of the same list or table."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == "p":
            del stack[i:]
            break
        if stack[i][0] not in INLINE:
            break
    ends, within = SIBLINGS.get(element, ((), ()))
    for i in range(len(stack) - 1, -1, -1):
        if not ends or stack[i][0] in within:
            break
        if stack[i][0] in ends:
            del stack[i:]
            break


def read_regions(html: str) -> tuple[list[str], bool, str]:
    """(blocks, whether the page marks them as its article, the text outside of them)."""
    # Regions that may be the article: article elements, then main ones, then named ones.
    blocks: list[tuple[str, int]] = []  # -1: left out
    line: list[str] = []
    aside: list[str] = []  # what is left out inside of the line
    stack: list[tuple[str, bool, int]] = []  # element, dropped, regions that it is in (bits)
    dropped, region = False, 0

    def close_block():
        for parts, of in ((line, region), (aside, -1)):
            if parts:
                text = " ".join("".join(parts).split())
                parts.clear()
                if text:
                    blocks.append((text, of))

    at, raw_end = 0, None
    length = len(html)
    while at < length:
        m = _MARKUP.search(html, at)
        (aside if dropped else line).append(unescape(html[at:m.start() if m else length]))
        if not m:
            break
        at = m.end()
        element = (m[2] or "").lower()
        if not element:
            continue
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == element:
                    if element not in INLINE and element not in HIDDEN:
                        close_block()
                    del stack[i:]
                    break
            else:
                if element not in INLINE:
                    if dropped:
                        aside.append(" ")
                    else:
                        close_block()
        else:
            if element not in INLINE and element not in HIDDEN:
                close_block()
                _end_implied(stack, element)
                dropped, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
            if element in RAW and not m[3].rstrip().endswith("/"):
                raw_end = re.compile(rf"</{re.escape(element)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = raw_end.end() if raw_end else length
                continue
            if element not in VOID:
                gone, bit = _marks(element, m[3])
                stack.append((element, dropped or gone, region | bit))
        dropped, region = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
    close_block()
    for bit in (1, 2, 4):
        if any(r > 0 and r & bit for _, r in blocks):
            own = [r > 0 and r & bit for _, r in blocks]
            break
    else:
        bit, own = 0, [r >= 0 for _, r in blocks]
    return [t for (t, _), o in zip(blocks, own) if o], bit > 0, " ".join(t for (t, _), o in zip(blocks, own) if not o)


def read_page(html: str) -> tuple[list[str], bool]:
    """(blocks, whether the page marks them as its article)."""
    return read_regions(html)[:2]


def _refined(rank: np.ndarray, active: np.ndarray, offset: int):
    """Ranks by (rank, rank ``offset`` further on) of the ``active`` suffixes, in suffix order, and where equal ones begin.

    Suffixes that are not active have no equal; each keeps a rank of its own.
    """
    n = len(rank)
    ahead = active + offset
    key = rank[active] * (2 * n + 2) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
    order = np.argsort(key)
    suffixes, key = active[order], key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    size = np.diff(np.append(begin, len(key)))
    new = np.arange(n, 2 * n)
    new[suffixes] = np.repeat(np.arange(len(begin)), size)
    return new, suffixes, begin, size


class Windows:
    """The substrings of ``run`` tokens (windows) of distinct texts and of texts outside, by a suffix array truncated there.

    Prefix doubling over the concatenated streams (each closed by a token that occurs once): the last doubling overlaps so
    that the length is ``run``, and suffixes without an equal so far are done and sorted no further. Equal windows are one
    class; of each class: ``pages`` (texts that have it), ``mix`` (their keys, xor), ``outside`` (pages whose text outside has it).
    """

    def __init__(self, texts: list[list[str]], outside: dict[str, int] | None = None, run: int = RUN):
        """outside: how many pages each text outside is on."""
        streams = [*texts, *map(_tokens, outside or ())]
        self.run = run
        self.keys = np.array([_key(" ".join(t)) for t in texts], np.int64)
        lengths = np.array([len(t) + 1 for t in streams], np.int64)
        numbered, self.number = _numbered(streams)
        closing = np.zeros(lengths.sum(), bool)
        closing[np.cumsum(lengths) - 1] = True
        tokens = np.full(len(closing), -1, np.int64)
        tokens[~closing] = numbered
        self.tokens = tokens.copy()
        tokens[closing] = len(self.number) + np.arange(len(streams))
        n, length = len(tokens), 1
        rank, active = tokens, np.flatnonzero(np.bincount(tokens)[tokens] > 1) if n else tokens
        while length < run and len(active):
            step = min(length, run - length)
            rank, suffixes, _, size = _refined(rank, active, step)
            length += step
            active = np.sort(suffixes[np.repeat(size > 1, size)])
        stream, end = np.repeat(np.arange(len(streams)), lengths), np.cumsum(lengths)
        whole = np.flatnonzero(end[stream] - 1 - np.arange(n) >= run) if n else active
        _, first, cls = np.unique(rank[whole], return_index=True, return_inverse=True)
        self.first = whole[first]
        count = len(first)
        in_class, in_stream = np.divmod(np.unique(cls * max(len(streams), 1) + stream[whole]), max(len(streams), 1))
        own = in_stream < len(texts)
        on = np.array([1] * len(texts) + list((outside or {}).values()), np.int64)
        self.pages = np.bincount(in_class[own], minlength=count)
        self.outside = np.bincount(in_class[~own], on[in_stream[~own]], minlength=count).astype(np.int64)
        self.mix = np.zeros(count, np.int64)
        c = in_class[own]
        if len(c):
            begin = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            self.mix[c[begin]] = np.bitwise_xor.reduceat(self.keys[in_stream[own]], begin)
        counts = np.maximum(lengths[:len(texts)] - run, 0)
        self.of = np.split(cls[:counts.sum()], np.cumsum(counts)[:-1]) if len(texts) else []

    @cached_property
    def digests(self) -> np.ndarray:
        return _digests(self.number)

    def hashes(self, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each class, which depend on its tokens and the salt only."""
        every = np.arange(len(self.first))
        return self.hash(0, every, salt), self.hash(1, every, salt)

    def hash(self, half: int, classes: np.ndarray, salt: int = 0) -> np.ndarray:
        """One of the two hashes of these classes."""
        return _window_hash(self.tokens, self.digests, half, self.first[classes], salt, self.run)

    def anchors(self, salt: int = 0) -> np.ndarray:
        """The anchor of each class."""
        return _anchors(self.tokens, self.digests, salt)[self.first] if len(self.first) else np.zeros(0, np.int64)


def _numbered(streams: list[list[str]]) -> tuple[np.ndarray, dict[str, int]]:
    """(the number of each token of the streams, one after the other; the numbers of the distinct tokens)."""
    number: dict[str, int] = {}
    last, of = 0, number.setdefault
    out = np.empty(sum(map(len, streams)), np.int64)
    for s in streams:
        out[last:last + len(s)] = [of(t, len(number)) for t in s]
        last += len(s)
    return out, number


def _digests(number: dict[str, int]) -> np.ndarray:
    """Two 64-bit halves of each token's digest, by the token's number; the last row is for the end of a stream."""
    digests = [xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in number]
    return np.concatenate([np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2), np.zeros((1, 2), np.uint64)])


def _mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``h`` with ``more`` mixed in, in place."""
    h ^= more
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _anchors(tokens: np.ndarray, halves: np.ndarray, salt: int, run: int = RUN) -> np.ndarray:
    """The anchor of the window of ``run`` tokens that begins at each place: the least hash of its grams."""
    n, wide = len(tokens), run - ANCHOR + 1
    digests = halves[np.concatenate([tokens, np.full(run, -1)]), 0]
    least = np.empty(n, np.uint64)
    for i in range(0, n, BLOCK):
        j = min(i + BLOCK, n)
        grams = np.full(j - i + wide - 1, salt + 1, np.uint64)
        for k in range(ANCHOR):
            _mixed(grams, digests[i + k:i + k + len(grams)])
        part = least[i:j]
        part[:] = grams[:j - i]
        for k in range(1, wide):
            np.minimum(part, grams[k:k + j - i], out=part)
    return least.view(np.int64)


def _window_hash(tokens: np.ndarray, halves: np.ndarray, half: int, at: np.ndarray, salt: int, run: int = RUN) -> np.ndarray:
    """One of two 64-bit hashes of the windows that begin ``at`` these places."""
    digests = halves[tokens, half]
    h = np.full(len(at), 2 * salt + half + 1, np.uint64)
    for i in range(0, len(at), BLOCK):
        part, places = h[i:i + BLOCK], at[i:i + BLOCK]
        for k in range(run):
            _mixed(part, digests[places + k])
    return h.view(np.int64)


def _key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _body(text: str) -> bytes:
    """A text as it is staged and shuffled. Equal texts have equal bodies."""
    return zlib.compress(text.encode("utf-8", "surrogatepass"), 1)


def _text(body: bytes | None) -> str | None:
    return None if body is None else zlib.decompress(body).decode("utf-8", "surrogatepass")


def _tokens(text: str) -> list[str]:
    return text.split(" ") if text else []


def _spread(begins: np.ndarray, length: int, run: int = RUN) -> np.ndarray:
    """Which of ``length`` tokens lie in a window that begins where ``begins`` holds."""
    edge = np.zeros(length + 1, np.int64)
    at = np.flatnonzero(begins)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + run, -1)
    return np.cumsum(edge)[:length] > 0


def repeated_tokens(streams: list[list[str]], run: int = RUN) -> list[np.ndarray]:
    """For each token stream, which tokens lie in a substring of ``run`` tokens that begins in two streams or more.

    Equal streams count as one.
    """
    place: dict[tuple, int] = {}
    same = [place.setdefault(tuple(s), len(place)) for s in streams]
    w = Windows([list(s) for s in place], run=run)
    return [_spread(w.pages[w.of[i]] > 1, len(s), run) for i, s in zip(same, streams)]


def _is_copy(pages: np.ndarray, other: np.ndarray, length: int) -> bool:
    """Whether long runs that one other text alone has, the same all along, make up ``COPY_SHARE`` of a text's ``length`` tokens."""
    edges = np.flatnonzero(np.concatenate([[True], (pages[1:] != pages[:-1]) | (other[1:] != other[:-1]), [True]])) if len(pages) else []
    least = min(LONG, length // 2)
    runs: dict[int, list] = {}
    for begin, end in zip(edges[:-1], edges[1:]):
        if pages[begin] == 2 and end - begin + RUN - 1 >= least:
            runs.setdefault(int(other[begin]), []).append(np.arange(begin, end))
    for at in runs.values():
        begins = np.zeros(len(pages), bool)
        begins[np.concatenate(at)] = True
        if _spread(begins, length).mean() >= COPY_SHARE:
            return True
    return False


def _decide(tokens: list[str], marked: bool, own: int, pages: np.ndarray, mix: np.ndarray, outside: np.ndarray, total: int):
    """(text, n_repeated) of a text by its windows' ``pages``, ``mix`` and ``outside``; the host has ``total`` distinct texts."""
    covered = _spread(pages > 1, len(tokens))
    if marked:
        often = ((pages + outside) * 2 > total) & (pages + outside >= LEAST_PAGES)
        gone = _spread((pages > 1) & often, len(tokens))
    elif _is_copy(pages, mix ^ own, len(tokens)):
        gone = np.zeros(len(tokens), bool)
    else:
        gone = covered
    return " ".join(t for t, g in zip(tokens, gone) if not g) if gone.any() else " ".join(tokens), int(covered.sum())


def _extract(rows: pa.Table) -> pa.Table:
    """The pages of whole hosts."""
    pages = [(*p[:3], _text(p[3]), p[4], _text(p[5]), p[6])
             for p in zip(*(rows.column(c).to_pylist() for c in ("host", "page_id", "url", "text", "marked", "outside", "aside")))]
    pages.sort(key=lambda p: (p[0], p[1] is None, p[1] or 0))
    out = []
    for _, part in groupby(pages, key=lambda p: p[0]):
        part = list(part)
        place: dict[str, int] = {}
        for p in part:
            place.setdefault(p[3], len(place))
        texts = [_tokens(t) for t in place]
        on = Counter(a for a, _ in {(p[6], p[3]) for p in part})
        asides = {p[6]: p[5] for p in part if p[5]}
        w = Windows(texts, {t: on[a] for a, t in sorted(asides.items())})
        found: dict[tuple, tuple] = {}
        for _, page_id, url, text, marked, *_ in part:
            if (text, marked) not in found:
                i = place[text]
                c = w.of[i]
                found[text, marked] = _decide(texts[i], marked, w.keys[i], w.pages[c], w.mix[c], w.outside[c], len(texts))
            text, repeated = found[text, marked]
            out.append((page_id, url, text, len(text), repeated))
    types = (rows.schema.field("page_id").type, rows.schema.field("url").type, pa.string(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                ["page_id", "url", "text", "n_chars", "n_repeated"])


def _parts(rows: pa.Table, side: pa.Table | None = None) -> tuple[int, int, int, list[list[str]], dict[str, int]]:
    """(host's number, its chunks, chunk, distinct texts, texts outside with their pages, which ``side`` knows) of a chunk."""
    parts = [(_text(t), role) for t, role in zip(rows.column("text").to_pylist(), rows.column("role").to_pylist())]
    on = {} if side is None else {a: n for kind, a, n in zip(*(side.column(c).to_pylist() for c in ("kind", "a", "outside"))) if kind == ASIDE}
    number, chunks, chunk = (rows.column(c)[0].as_py() for c in ("number", "chunks", "chunk"))
    return (number, chunks, chunk, [_tokens(t) for t in sorted({t for t, role in parts if role})],
            {t: on.get(_key(t), 0) for t in sorted({t for t, role in parts if not role})})


def _windows_of(streams: list[list[str]]) -> tuple[np.ndarray, dict[str, int], np.ndarray, np.ndarray]:
    """(numbered tokens, their numbers, the stream of each, whether a whole window begins there) of token streams."""
    tokens, number = _numbered(streams)
    lengths = np.array([len(s) for s in streams], np.int64)
    stream = np.repeat(np.arange(len(streams)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(tokens))
    return tokens, number, stream, left >= RUN


def _anchors_of(streams: list[list[str]], host: int) -> np.ndarray:
    """The distinct anchors of all windows of token streams."""
    tokens, number, _, whole = _windows_of(streams)
    return np.unique(_anchors(tokens, _digests(number), host)[whole]) if len(tokens) else np.zeros(0, np.int64)


def _bits(chunks: int) -> int:
    """Leading bits of an anchor that tell those of a host of so many chunks apart, but for one in a hundred or so."""
    return min(62, 27 + chunks.bit_length())


def _leading(anchors: np.ndarray, chunks: int) -> np.ndarray:
    return (anchors.view(np.uint64) >> np.uint64(64 - _bits(chunks))).astype(np.int64)


def _packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as their gaps, byte by byte of the gaps: about two bytes a number where many are sent at once."""
    return zlib.compress(np.diff(numbers, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 6)


def _unpacked(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(body), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def _chunk_anchors(rows: pa.Table) -> pa.Table:
    """number, bucket, chunk, body: a chunk's anchors, dealt to buckets by their size."""
    number, chunks, chunk, texts, outside = _parts(rows)
    found = np.unique(_leading(_anchors_of([*texts, *map(_tokens, outside)], number), chunks))
    buckets = -(-chunks // BUCKET_CHUNKS)
    edges = np.searchsorted(found, np.array([(k << _bits(chunks)) // buckets for k in range(buckets + 1)], np.int64))
    out = [(number, k, chunk, _packed(found[i:j])) for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
    return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                ["number", "bucket", "chunk", "body"])


def _shared_anchors(rows: pa.Table) -> pa.Table:
    """chunk, body: of a bucket's anchors, those that two chunks have, to each chunk that has them."""
    chunks = rows.column("chunk").to_pylist()
    lists = [_unpacked(b) for b in rows.column("body").to_pylist()]
    _, place, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = np.split(count[place] > 1, np.cumsum([len(x) for x in lists])[:-1])
    out = [(c, _packed(x[k])) for c, x, k in zip(chunks, lists, shared) if k.any()]
    return pa.Table.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["chunk", "body"])


def _chunk_windows(rows: pa.Table, side: pa.Table) -> pa.Table:
    """Each distinct window of a chunk whose anchor other chunks have: chunk, its hash (a, b), pages, mix, outside."""
    columns = (np.zeros(0, np.int64),) * 6
    lists = [_unpacked(b) for b in side.column("body").to_pylist() if b is not None]
    if rows.num_rows and lists:
        host, chunks, chunk, texts, outside = _parts(rows, side)
        tokens, number, stream, whole = _windows_of([*texts, *map(_tokens, outside)])
        halves = _digests(number)
        at = np.flatnonzero(whole & np.isin(_leading(_anchors(tokens, halves, host), chunks), np.concatenate(lists)))
        a, b = (_window_hash(tokens, halves, half, at, host) for half in (0, 1))
        order = np.lexsort((stream[at], b, a))
        a, b, stream = a[order], b[order], stream[at][order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        once = fresh.copy()
        once[1:] |= stream[1:] != stream[:-1]
        if len(a):
            cls = (np.cumsum(fresh) - 1)[once]
            stream, a, b = stream[once], a[fresh], b[fresh]
            own = stream < len(texts)
            keys = np.array([_key(" ".join(t)) for t in texts] + [0] * len(outside), np.int64)
            on = np.array([0] * len(texts) + list(outside.values()), np.int64)
            begin = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
            columns = (np.full(len(a), chunk), a, b, np.add.reduceat(own.astype(np.int64), begin),
                       np.bitwise_xor.reduceat(keys[stream], begin), np.add.reduceat(on[stream], begin))
    return pa.Table.from_arrays([pa.array(c) for c in columns], ["chunk", "a", "b", "pages", "mix", "outside"])


def _chunk_texts(rows: pa.Table, side: pa.Table) -> pa.Table:
    """The pages of a chunk's texts, and key, text, n_repeated of texts whose pages are elsewhere.

    Windows that other chunks share count as the whole host says, others here.
    """
    out = []
    if rows.num_rows:
        host, _, _, texts, outside = _parts(rows, side)
        kinds = side.column("kind").to_numpy()
        total = int(side.column("pages").to_numpy()[kinds == TOTAL][0])
        place = {" ".join(t): i for i, t in enumerate(texts)}
        w = Windows(texts, outside)
        pages, mix, on = w.pages.astype(np.int64), w.mix.copy(), w.outside.copy()
        known = side.filter(pa.array(kinds == WINDOW)).sort_by("a")
        if known.num_rows and len(pages):
            a, b, of_pages, of_mix, of_outside = (known.column(c).to_numpy() for c in ("a", "b", "pages", "mix", "outside"))
            own = w.hash(0, np.arange(len(pages)), host)
            at = np.minimum(np.searchsorted(a, own), len(a) - 1)
            hit = np.flatnonzero(a[at] == own)
            hit = hit[b[at[hit]] == w.hash(1, hit, host)]
            pages[hit], mix[hit], on[hit] = of_pages[at[hit]], of_mix[at[hit]], of_outside[at[hit]]
        for key, text, role, heavy, ids in zip(*(rows.column(c).to_pylist() for c in ("key", "text", "role", "heavy", "ids"))):
            if role:
                i = place[_text(text)]
                c = w.of[i]
                result, covered = _decide(texts[i], role == 1, w.keys[i], pages[c], mix[c], on[c], total)
                out += [(None, r["page_id"], r["url"], result, len(result), covered) for r in ids]
                if heavy:
                    out.append((key, None, None, result, len(result), covered))
    of = rows.schema.field("ids").type.value_type
    types = (pa.binary(), of.field("page_id").type, of.field("url").type, pa.string(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                ["key", "page_id", "url", "text", "n_chars", "n_repeated"])


def _read_split(pages: DataFrame, light: bool = False) -> DataFrame:
    """Rows of pages of split hosts (number, chunks, page_id, url, html).

    One per page: number, chunks, chunk, role (1: marked, 2: open), key, page_id, url, text (null where the task has sent it
    before), and one per text outside, with role 0 and no page. ``light``: number, chunks, own, aside, key of each page, no texts.
    """
    kind = dict(pages.dtypes)["page_id"]
    if light:
        schema = "number long, chunks long, own long, aside long, key binary"
    else:
        schema = f"number long, chunks long, chunk long, role int, key binary, page_id {kind}, url string, text binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            of_type = {"key": pa.binary(), "text": pa.binary(), "role": pa.int32(), "page_id": batch.column("page_id").type, "url": pa.string()}
            rows = []
            for number, chunks, page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("number", "chunks", "page_id", "url", "html"))):
                blocks, marked, outside = read_regions(html or "")
                role, text = 1 if marked else 2, " ".join(blocks)
                if light:
                    rows.append((number, chunks, _key(text), _key(outside) if outside else None, _name(number, role, text)))
                    continue
                for role, text, page in ((role, text, (page_id, url)), (0, outside, (None, None))):
                    name = _name(number, role, text)
                    sent = name in seen
                    if not sent and len(seen) < MEMO:
                        seen.add(name)
                    if role or (text and not sent):
                        rows.append((number, chunks, (number << CHUNK_BITS) + _key(text) % chunks, role, name, *page, None if sent else _body(text)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], of_type.get(n, pa.int64())) for i, n in enumerate(names)], names)

    return pages.select("number", "chunks", "page_id", "url", "html").mapInArrow(run, schema)


def _name(number: int, role: int, text: str) -> bytes:
    return blake2b(f"{number} {role} {text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _read(pages: DataFrame) -> DataFrame:
    """host, page_id, url, text, marked, aside (a number of the text outside), outside (null where the task has sent it before)."""
    def run(batches):
        seen: set[tuple] = set()
        for batch in batches:
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                blocks, marked, outside = read_regions(html or "")
                aside = _key(outside)
                if (host, aside) in seen:
                    outside = None
                elif len(seen) < MEMO:
                    seen.add((host, aside))
                rows.append((_body(" ".join(blocks)), marked, aside, _body(outside) if outside else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("page_id"), batch.column("url"),
                 *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.bool_(), pa.int64(), pa.binary())))],
                ["host", "page_id", "url", "text", "marked", "aside", "outside"])

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("host", "page_id", "url", "html").mapInArrow(
        run, f"host string, page_id {kind}, url string, text binary, marked boolean, aside long, outside binary")


def _checked(hosts: DataFrame, count: int) -> DataFrame:
    """A row per split host, broadcast only while they are few."""
    return F.broadcast(hosts) if count <= MOST_HOSTS else hosts


def _split_hosts(pages: DataFrame, tasks: int) -> DataFrame:
    """The pages of split hosts (with number, chunks): distinct texts are dealt to chunks, windows meet by hash.

    Pages are read twice: first for counts only, then texts are shuffled once, and that exchange serves all three steps.
    """
    kind = dict(pages.dtypes)["page_id"]
    counts = staged(_read_split(pages, light=True).groupBy("number", "chunks", "own", "aside", "key").agg(F.count(F.lit(1)).alias("n")), "counts")
    heavy = staged(counts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > COPIES), "heavy")
    many = heavy.count()
    chunk = lambda text: F.shiftleft("number", CHUNK_BITS) + F.pmod(text, F.col("chunks"))
    null = F.lit(None).cast("long")
    on = (counts.filter(F.col("aside").isNotNull()).select("number", "chunks", "own", "aside").distinct().groupBy("number", "chunks", "aside")
          .agg(F.count(F.lit(1)).alias("outside")).select(chunk("aside").alias("chunk"), F.lit(ASIDE).alias("kind"), F.col("aside").alias("a"), "outside"))
    totals = (counts.select("number", "chunks", "own").distinct().groupBy("number", "chunks").agg(F.count(F.lit(1)).alias("pages"))
              .withColumn("text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
              .select(chunk("text").alias("chunk"), F.lit(TOTAL).alias("kind"), "pages"))
    read = _read_split(pages)
    if many:
        read = read.join(_checked(heavy.select("key", F.lit(True).alias("heavy")), many), "key", "left").withColumn("heavy", F.col("heavy").isNotNull())
    else:
        read = read.withColumn("heavy", F.lit(False))
    # Pages of a text go with it, unless they are so many that they would burden its chunk.
    page = F.when(~F.col("heavy") & (F.col("role") > 0), F.struct("page_id", "url"))
    texts = (read.withColumn("page", page).filter(F.col("page").isNotNull() | F.col("text").isNotNull())
             .select("chunk", "number", "chunks", "role", "key", "heavy", "text", "page").repartition(tasks, "chunk")
             .groupBy("chunk", "number", "chunks", "role", "key", "heavy")
             .agg(F.first("text", ignorenulls=True).alias("text"), F.collect_list("page").alias("ids")))
    shared = (texts.groupBy("chunk").applyInArrow(_chunk_anchors, "number long, bucket long, chunk long, body binary")
              .groupBy("number", "bucket").applyInArrow(_shared_anchors, "chunk long, body binary"))
    side = shared.select("chunk", F.lit(ANCHORS).alias("kind"), null.alias("a"), null.alias("outside"), "body").unionByName(
        on.withColumn("body", F.lit(None).cast("binary")))
    windows = texts.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        _chunk_windows, "chunk long, a long, b long, pages long, mix long, outside long")
    repeated = (windows.groupBy("a", "b")
                .agg(F.sum("pages").alias("pages"), F.bit_xor("mix").alias("mix"), F.sum("outside").alias("outside"), F.count(F.lit(1)).alias("n"),
                     F.collect_list(F.when(F.col("pages") > 0, F.col("chunk"))).alias("chunks"))
                .filter((F.col("pages") > 1) & (F.col("n") > 1)).withColumn("chunk", F.explode("chunks"))
                .select("chunk", F.lit(WINDOW).alias("kind"), "a", "b", "pages", "mix", "outside"))
    side = repeated.unionByName(on, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True)
    done = texts.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        _chunk_texts, f"key binary, page_id {kind}, url string, text string, n_chars long, n_repeated long")
    columns = ["page_id", "url", "text", "n_chars", "n_repeated"]
    if not many:
        return done.select(columns)
    done = staged(done, "texts")
    ids = read.filter(F.col("heavy") & (F.col("role") > 0)).select("key", "page_id", "url")
    results = done.filter(F.col("key").isNotNull()).select("key", "text", "n_chars", "n_repeated").join(heavy, "key")
    rows = heavy.agg(F.sum("n")).first()[0]
    return done.filter(F.col("key").isNull()).select(columns).unionByName(join_counted(ids, results, "key", rows).select(columns))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_repeated (tokens in runs that repeat on the host)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    sizes = staged(pages.groupBy("host").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("bytes")), "hosts")
    large = sizes.filter(F.col("bytes") > PACK_BYTES).select("host", F.ceil(F.col("bytes") / PACK_BYTES).cast("long").alias("chunks"))
    large = staged(positioned(large, "host").withColumnRenamed("position", "number"), "large")
    count = large.count()
    total = sizes.filter(F.col("bytes") <= PACK_BYTES).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    packs = max(1, math.ceil(total / PACK_BYTES))
    kind = dict(pages.dtypes)["page_id"]
    small = pages.join(_checked(large.select("host"), count), "host", "left_anti") if count else pages
    read = _read(small).withColumn("pack", F.pmod(F.xxhash64("host"), F.lit(packs)))
    out = read.repartition(min(2 * packs, MOST_TASKS), "pack").groupBy("pack").applyInArrow(
        _extract, f"page_id {kind}, url string, text string, n_chars long, n_repeated long")
    if not count:
        return out
    tasks = min(2 * large.agg(F.sum("chunks")).first()[0], MOST_TASKS)
    return out.unionByName(_split_hosts(pages.join(_checked(large, count), "host"), tasks))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages``: page_id, url, text, n_chars, n_repeated."""
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
