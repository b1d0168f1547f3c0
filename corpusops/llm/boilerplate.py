"""Main text of web pages: markup roles per block, and the passages that pages of one host share, wherever these pages lie."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W

PREFIX_DOUBLINGS = 3  # suffixes are sorted by their first 8 tokens, the shortest passage that counts as shared
PASSAGE = 1 << PREFIX_DOUBLINGS
GRAM = 5  # the least hash of this many tokens stands for a passage in the first exchange
PAGES = 256
BLOCK_BYTES = 8 << 20
HEAVY_SHARE = 1000  # a block of pages holds about a thousandth of all pages at most

# Element names of HTML.
BLOCKS = set("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
CHROME = set("nav menu header footer aside form dialog head button select".split())
SILENT = "script|style|noscript|template|textarea|svg|iframe|object|canvas|math"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
_NAME = (
    r"ads?|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|banner|nav[a-z]*|menu[a-z]*|breadcrumbs?|header|masthead|footer|sidebar|side|aside|widget[a-z]*|related|recommend[a-z]*|share|sharing|social|comments?|disqus|reply|replies|respond"
    r"|cookie[a-z]*|consent|gdpr|notice|newsletter|subscri[a-z]*|signup|login|popup|modal|pagination|pager"
)
# what a compound of such names may have besides; other words (no-sidebar, has-comments) say something about another element
_AFFIX = r"site|page|main|top|bottom|global|primary|secondary|post|box|bar|block|unit|slot|area|section|wrap|wrapper|container|links?|list|items?|buttons?|icons?|form|posts?|\d+"
NAMED = re.compile(rf"(?:^|\s)(?:(?:{_AFFIX})[_-])*(?:{_NAME})(?:[_-]+(?:{_NAME}|{_AFFIX}))*(?:$|\s)", re.IGNORECASE)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})\b[^>]*>(?:.*?</(?P=silent)\s*>|.*\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements whose end tag may be left out: the start tags that end them, and the elements in which such a start tag does not.
_CELLS = set("td th tr tbody thead tfoot".split())
_OMITTED = {
    "p": (BLOCKS - set("br body html head title legend caption option".split()), set()),
    "li": ({"li"}, set("ul ol menu".split())),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": (_CELLS - {"td", "th"}, {"table"}),
    "td": (_CELLS, {"table"}),
    "th": (_CELLS, {"table"}),
    "option": ({"option", "optgroup"}, set()),
}
# Their end tags end what is still open inside them.
_HOLDERS = (BLOCKS | CHROME) - set(_OMITTED) - VOID - {"html", "body"}

ARTICLE, PLAIN, MARKED = 2, 1, 0


def _is_chrome(name: str, attributes: str, in_article: bool) -> bool:
    if name in CHROME and not (in_article and name == "header"):
        return True
    if name in ("body", "html", "article", "main") or not attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "role" and value.lower() in ROLES) or (key in ("class", "id") and NAMED.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(role, text) of the blocks of a page, in order: inside an article or main element, inside marked boilerplate, or plain.

    Elements whose end tag may be left out end where HTML ends them, others with an element around them or with the page. Scripts, styles and comments are no text; character references are decoded; white space inside
    a block becomes one space.
    """
    out: list[tuple[int, str]] = []
    held: list[str] = []
    article, chrome = 0, ""
    around: Counter[str] = Counter()  # open elements outside the marked one, and inside it
    inside: Counter[str] = Counter()

    def ends(name: str, closes: bool) -> bool:
        """Whether a tag inside the marked element ends it."""
        starts, apart = _OMITTED.get(chrome, (set(), set()))
        nested = any(inside[n] for n in apart)
        if not closes:
            return name in starts and not nested
        if name == chrome:
            return not (nested if chrome in _OMITTED else inside[name])
        if chrome in _OMITTED and name in starts and name in _CELLS:
            return not nested
        return name in _HOLDERS and not inside[name] and around[name] > 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append((MARKED if chrome else ARTICLE if article else PLAIN, text))
        held.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        closes = bool(m["close"] or m["close2"])
        if name in BLOCKS or name in CHROME:
            flush()
        if chrome:
            if not ends(name, closes):
                if name not in VOID:
                    inside[name] = max(inside[name] + (-1 if closes else 1), 0)
                continue
            flush()
            own, chrome = closes and name == chrome, ""
            inside.clear()
            if own:
                continue
        attributes = m["attributes"] or ""
        if closes:
            around[name] = max(around[name] - 1, 0)
            if name in ("article", "main") and article:
                article -= 1
        elif name not in VOID and _is_chrome(name, attributes, article > 0):
            flush()
            chrome = name
        elif name not in VOID:
            around[name] += 1
            article += name in ("article", "main")
    held.append(page[at:])
    flush()
    return out


def shared_tokens(pages: list[list[str]], doublings: int = PREFIX_DOUBLINGS) -> list[np.ndarray]:
    """For each page's tokens, which lie in a passage of 2**doublings tokens or more that also starts on another page.

    The pages are put after each other with an end mark of its own for each, and all suffixes are sorted by prefix doubling. In the sorted
    order the suffixes with one prefix are neighbours; as positions rise inside such a run, its first and last one tell whether pages differ.
    """
    number: dict[str, int] = {}
    ids, page = [], []
    for p, tokens in enumerate(pages):
        ids.append(np.array([number.setdefault(t, len(number)) for t in tokens] + [-1 - p], np.int64))
        page.append(np.full(len(tokens) + 1, p))
    rank, owner = np.unique(np.concatenate(ids), return_inverse=True)[1].astype(np.int64), np.concatenate(page)
    size = 1
    for _ in range(doublings):
        ahead = np.full(len(rank), -1, np.int64)
        ahead[: len(rank) - size] = rank[size:]
        rank = np.unique(rank * (int(rank.max()) + 2) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        size *= 2
    suffixes = np.argsort(rank, kind="stable")
    run = np.flatnonzero(np.concatenate([[True], rank[suffixes][1:] != rank[suffixes][:-1]]))
    last = np.append(run[1:], len(suffixes)) - 1
    differs = owner[suffixes[run]] != owner[suffixes[last]]
    starts = suffixes[np.repeat(differs, last - run + 1)]
    change = np.zeros(len(rank) + size + 1, np.int32)
    change[starts] += 1
    np.subtract.at(change, starts + size, 1)
    covered = np.cumsum(change)[: len(rank)] > 0
    ends = np.cumsum([len(i) for i in ids])
    return [covered[e - len(i) : e - 1] for e, i in zip(ends, ids, strict=True)]


def _main_text(roles: list[int], texts: list[str], mask: np.ndarray) -> str:
    """Article blocks stay, whoever else has the text. Marked blocks go. Plain blocks of a page without an article stay unless half of
    their tokens or more lie in shared passages.
    """
    total = np.concatenate([[0], np.cumsum(mask)])
    ends = np.cumsum([0, *(t.count(" ") + 1 for t in texts)])
    share = (total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.diff(ends), 1)
    has_article = ARTICLE in roles
    return "\n".join(text for role, text, s in zip(roles, texts, share, strict=True) if role == ARTICLE or (role == PLAIN and not has_article and s < 0.5))


def main_texts(pages: list[str]) -> list[tuple[str, int, int]]:
    """(main text, tokens, tokens shared with other pages) of pages of one host, by suffix sorting in one place."""
    found = [blocks(p) for p in pages]
    shared = shared_tokens([[t for _, b in f for t in b.split(" ")] for f in found])
    return [(_main_text([r for r, _ in f], [b for _, b in f], mask), len(mask), int(mask.sum())) for f, mask in zip(found, shared, strict=True)]


# --- passages shared across a host, by exchange of hashes between blocks of pages ---------------

_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.int64()), ("times", pa.int64()), ("roles", pa.string()), ("text", pa.string())])
_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_shared", pa.int64())])
_SENT = "part long, block long, data binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, data): pages as their blocks, one a line. The pages of a batch that go to one block of pages are packed and compressed together.

    Equal rows of a batch become one, so that a group of them does not fill one block of pages.
    """
    for batch in batches:
        rows: dict[tuple, int] = {}
        for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "block", "html")), strict=True):
            rows[row] = rows.get(row, 0) + 1
        out: dict[int, list[tuple]] = {}
        for (page_id, url, host, block, page), times in rows.items():
            found = blocks(page or "")
            out.setdefault(block, []).append((page_id, url, host, times, "".join(str(r) for r, _ in found), "\n".join(b for _, b in found)))
        packed = [_packed(pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(_PARSED)], schema=_PARSED)) for found in out.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(packed, pa.binary())], names=["block", "data"])


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _PARSED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _passages(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of the pages in the tokens; starts of passages, their pages, their hashes; places of the grams that stand for them, hashes of all grams).

    Hashes hold the host, so equal ones are passages of one host.
    """
    hashes, at = W.hash_words(*W.text_bytes(part.column("text")))
    page = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts = np.flatnonzero(np.arange(len(hashes)) + PASSAGE <= at[1:][page]) if len(hashes) else np.zeros(0, np.int64)
    host = W.mix(np.asarray(part.column("host"), np.int64).view(W.U))
    whole = W.mix(W.rolling(hashes, PASSAGE)[starts] ^ host[page[starts]])
    grams = W.rolling(hashes, GRAM)
    grams = W.mix(grams ^ host[page[: len(grams)]])
    chosen, least = starts.copy(), grams[starts]
    for i in range(1, PASSAGE - GRAM + 1):
        value = grams[starts + i]
        less = value < least
        chosen[less], least[less] = starts[less] + i, value[less]
    return at, starts, page[starts], whole, chosen, grams


def _on_pages(values: np.ndarray, pages: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Each value once per page that has it, twice if the page is there several times."""
    order = np.lexsort((pages, values))
    values, pages = values[order], pages[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (pages[1:] != pages[:-1])
    values, pages = values[first], pages[first]
    return np.concatenate([values, values[times[pages] > 1]])


def _at_most_twice(found: list[np.ndarray]) -> np.ndarray:
    values = np.sort(np.concatenate([np.zeros(0, W.U), *found]))
    keep = np.ones(len(values), bool)
    keep[2:] = values[2:] != values[:-2]
    return values[keep]


def _addressed(block: int, values: np.ndarray, parts: int, kind: type) -> pa.Table:
    """One row per part that gets some of the values. The part comes from the upper half of a value; `kind` uint32 sends the lower half alone."""
    to = ((values >> W.U(32)) % W.U(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    values, to = values[order].astype(kind), to[order]
    cut = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)] if len(to) else [0]
    return pa.table({"part": pa.array(to[cut[:-1]], pa.int64()), "block": pa.array([block] * (len(cut) - 1), pa.int64()), "data": pa.array([values[a:b].tobytes() for a, b in pairwise(cut)], pa.binary())})


def _sent_twice(addressed: DataFrame, kind: type) -> DataFrame:
    """(part, block, data): of the values that each block sent, those sent twice by all blocks together."""

    def run(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x.as_buffer(), kind) for x in table.column("data")]
        every = np.sort(np.concatenate([np.zeros(0, kind), *sent]))
        twice = every[1:][every[1:] == every[:-1]]
        data = [np.unique(s[W.member(s, twice)]).tobytes() for s in sent]
        return pa.table({"part": table.column("part"), "block": table.column("block"), "data": pa.array(data, pa.binary())}).filter(pa.array([len(d) > 0 for d in data], pa.bool_()))

    return addressed.groupBy("part").applyInArrow(run, _SENT)


def _known(values: np.ndarray, back: pa.Table, parts: int, kind: type) -> np.ndarray:
    """Which values are among those that came back."""
    out = np.zeros(len(values), bool)
    to = ((values >> W.U(32)) % W.U(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    bounds = {p: np.sort(np.frombuffer(d.as_buffer(), kind)) for p, d in zip(back.column("part").to_pylist(), back.column("data"), strict=True)}
    for p, among in bounds.items():
        here = order[np.searchsorted(to[order], p) : np.searchsorted(to[order], p, "right")]
        out[here] = W.member(values[here].astype(kind), among)
    return out


def _slices(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The packed pages of a block in runs of bounded size."""
    for data in table.column("data"):
        for batch in pa.ipc.open_stream(data.as_buffer()):
            yield from W.slices(batch)


def _send_grams(parts: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        found = []
        for part in _slices(table):
            _, _, page, _, chosen, grams = _passages(part)
            found.append(_at_most_twice([_on_pages(grams[chosen], page, np.asarray(part.column("times"), np.int64))]))
        return _addressed(table.column("block")[0].as_py(), _at_most_twice(found), parts, np.uint32)

    return run


def _send_passages(parts: int) -> Callable:
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        found = []
        for part in _slices(table):
            _, _, page, whole, chosen, grams = _passages(part)
            open_ = _known(grams[chosen], back, parts, np.uint32)
            found.append(_at_most_twice([_on_pages(whole[open_], page[open_], np.asarray(part.column("times"), np.int64))]))
        return _addressed(table.column("block")[0].as_py() if len(table) else 0, _at_most_twice(found), parts, np.uint64)

    return run


def _judge(parts: int) -> Callable:
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        out = []
        for part in _slices(table):
            at, starts, _, whole, _, _ = _passages(part)
            shared = starts[_known(whole, back, parts, np.uint64)]
            change = np.zeros(int(at[-1]) + PASSAGE + 1, np.int32)
            change[shared] += 1
            np.subtract.at(change, shared + PASSAGE, 1)
            mask = np.cumsum(change)[: int(at[-1])] > 0
            rows = []
            for i, (page_id, url, times, roles, text) in enumerate(zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "times", "roles", "text")), strict=True)):
                own = mask[at[i] : at[i + 1]]
                main = _main_text([int(r) for r in roles], text.split("\n") if roles else [], own)
                rows += [(page_id, url, main, len(main), len(own), int(own.sum()))] * times
            out.append(pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA))
        return pa.Table.from_batches(out, schema=_SCHEMA)

    return run


def extracted(pages: DataFrame, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars, n_tokens, n_shared) for every row of `pages` (page_id, url, html; other columns are not read).

    A passage of 8 tokens is shared if two pages of the host have it, whatever the size of the host and wherever the pages lie.

    1. Pages are parsed, and their blocks of text dealt into blocks of pages by the hash of the row, one shuffle that all passes use again.
    2. Of each passage the least hash of 5 neighbouring tokens is sent, half of its bits, once per block of pages (twice if two pages
       have it); those sent twice come back. 3. Passages whose hash came back are verified: hashes of all 8 tokens are exchanged the
       same way. 4. What comes back is shared.

    A block of pages has about `BLOCK_BYTES` and 1/`heavy_share` of all pages at most (512 at least), so memory is bounded and no host
    meets in one task. Null html is empty and gives an empty text; pages without url are one host; repeated rows share all their
    passages; an empty table gives an empty one.
    """
    name = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).alias("bytes")).first()
    parts = max(total.bytes // BLOCK_BYTES, total.n // max(total.n // heavy_share, 2 * PAGES)) + 1
    block = F.pmod(F.xxhash64("page_id", "url", F.crc32(F.coalesce("html", F.lit("")).cast("binary"))), F.lit(parts))
    rows = rows.select("page_id", "url", "html", F.xxhash64(name).alias("host"), block.cast("long").alias("block"))
    dealt = rows.mapInArrow(_parse, "block long, data binary")
    grams = _sent_twice(dealt.groupBy("block").applyInArrow(_send_grams(parts), _SENT), np.uint32)
    passages = dealt.groupBy("block").cogroup(grams.groupBy("block")).applyInArrow(_send_passages(parts), _SENT)
    shared = _sent_twice(passages, np.uint64)
    judged = dealt.groupBy("block").cogroup(shared.groupBy("block"))
    return judged.applyInArrow(_judge(parts), "page_id long, url string, text string, n_chars long, n_tokens long, n_shared long")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
