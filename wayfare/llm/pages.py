"""Main text of web pages: page structure, and differencing against the page with the nearest URL.

Every page is cut into text lines (the text of a block, its white space made single). Pages are ordered by host and
path; each is paired with the neighbour of its host whose path it shares most of, both are aligned by a longest common
subsequence of their lines, and lines in common are marked as shared.

Differencing alone cannot give the main text: copies of a page share all of it, and menus and footers may differ from
page to page. So shared lines are deleted only outside an ``article`` or ``main`` element, and what stands in menus,
forms, adverts, notices, reader comments and the like never counts. Where there is such an element, its
lines are the main text. Where there is none, the main text is what is left after differencing; if all of it
is shared, the pair are copies and nothing is deleted.

Defined results: a null or empty page has an empty text; without a URL, pages form a host of their own; the order
of pages of one path is by id, then by a hash of the page, and repeated rows get equal texts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.packing import packed, unpacker
from wayfare.llm.running import Stored

# Elements by their part in a page.
RAW = frozenset("script style noscript template iframe textarea svg math canvas object audio video title".split())
BOILERPLATE = frozenset("head nav aside form button select dialog menu".split())
PAGE_ENDS = frozenset("header footer".split())
MAIN = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset(
    "ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "popup modal overlay sidebar side menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead "
    "comment comments reply replies respond disqus discussion share sharing social related recommended newsletter subscribe signup login "
    "search widget".split()
)
#: before a name of the list, these say that an element has such a part, not that it is one
OF_THE_WHOLE = frozenset("no has with without hide show".split())
READERS = frozenset("comment comments reply replies respond disqus discussion".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

INSIDE, OUTSIDE, DROPPED = 0, 1, 2

#: pages of one block when neighbours are looked up
_BLOCK_ROWS = 2_000

#: an alignment keeps a bit for each pair of lines up to this many, else it is divided
_PAIRS = 1 << 28


def lines(page: str) -> tuple[list[str], list[int]]:
    """Text lines of a page and where each stands: inside the main element, outside, or in what never counts."""
    found: list[str] = []
    kinds: list[int] = []
    held: list[str] = []
    main = 0
    dropping, depth, readers = "", 0, False
    at = 0

    def close() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                found.append(text)
                kinds.append(DROPPED if dropping else INSIDE if main else OUTSIDE)

    while at < len(page):
        match = _TAG.search(page, at)
        if match is None:
            held.append(page[at:])
            break
        if match.start() > at:
            held.append(page[at : match.start()])
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        ending = bool(match[1])
        if name == "br":
            held.append(" ")
        if name in BLOCK or name in BOILERPLATE:
            close()
        if ending:
            if dropping:
                if name == dropping:
                    depth -= 1
                    if not depth:
                        close()
                        dropping = ""
            elif name in MAIN:
                close()
                main = max(0, main - 1)
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if name in VOID or match[3].endswith("/"):
            continue
        words = _names(match[3]) if match[3] and "=" in match[3] else set()
        # a main element is that, whatever its classes, unless readers wrote it
        named = bool(words & (READERS if name in MAIN else NAMES))
        if dropping:
            if name in MAIN and not named and not readers:
                # an element left open does not swallow the main text
                close()
                dropping, depth, main = "", 0, 1
            elif name == dropping:
                depth += 1
        elif name in BOILERPLATE or named and name not in ("body", "html") or name in PAGE_ENDS and not main:
            close()
            dropping, depth, readers = name, 1, bool(words & READERS)
        elif name in MAIN:
            close()
            main += 1
    close()
    return found, kinds


def _names(attributes: str) -> set[str]:
    """Words of the class, id and role of an element."""
    words: set[str] = set()
    for value in _NAMED.findall(attributes):
        for token in "".join(value).lower().split():
            parts = re.split(r"[^a-z0-9]+", token)
            if parts[0] not in OF_THE_WHOLE:
                words.update(parts)
    return words


def main_text(page: str, deleted: frozenset[int] = frozenset()) -> str:
    found, kinds = lines(page)
    wanted = INSIDE if INSIDE in kinds else OUTSIDE
    kept = [line for i, (line, kind) in enumerate(zip(found, kinds)) if kind == wanted and (kind == INSIDE or i not in deleted)]
    return "\n".join(kept)


def _row_bits(a: list[int], b: list[int]) -> Iterator[int]:
    """After each line of a, bits of b: a zero where the common subsequence with that part of a gets longer."""
    places: dict[int, int] = {}
    for i, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        same = row & places.get(line, 0)
        row = (row + same | row - same) & full
        yield row


def _lengths(row: int, size: int) -> np.ndarray:
    """Length of the common subsequence with each prefix of b."""
    data = np.frombuffer(row.to_bytes(size // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(data, bitorder="little")[:size].astype(np.int64))])


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in both."""
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    if len(a) * len(b) > _PAIRS:
        # the best cut of b for the middle of a
        middle, last = len(a) // 2, 0
        for last in _row_bits(a[:middle], b):
            pass
        head = _lengths(last, len(b))
        for last in _row_bits(a[:middle - 1 : -1], b[::-1]):
            pass
        cut = int(np.argmax(head + _lengths(last, len(b))[::-1]))
        rest = aligned(a[middle:], b[cut:])
        return aligned(a[:middle], b[:cut]) + [(i + middle, j + cut) for i, j in rest]
    rows = [(1 << len(b)) - 1, *_row_bits(a, b)]
    pairs = []
    i, j = len(a), len(b)
    while i and j:
        bit = 1 << j - 1
        if rows[i] & bit:
            j -= 1  # no gain at b[j - 1]
        elif not rows[i - 1] & bit:
            i -= 1  # gained without a[i - 1] already
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def _place(url: str) -> tuple[str, str]:
    try:
        parts = urlsplit(url)
        return (parts.hostname or "").lower(), parts.path.rstrip("/")
    except ValueError:
        return "", url


def _outlines(keyed: DataFrame) -> DataFrame:
    """Per page its host, path, and hashes of its lines outside the main element with their numbers."""

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = lambda line: xxhash.xxh64_intdigest(line) - (1 << 63)
        for batch in batches:
            hosts, paths, codes, numbers = [], [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("page").to_pylist()):
                host, path = _place(url)
                found, kinds = lines(page)
                outside = [i for i, kind in enumerate(kinds) if kind != INSIDE]
                hosts.append(host)
                paths.append(path)
                codes.append([hashed(found[i]) for i in outside])
                # numbers of lines that could be main text are positive, others negative
                numbers.append([i + 1 if kinds[i] == OUTSIDE and INSIDE not in kinds else -i - 1 for i in outside])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("mark"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                    pa.array(codes, pa.list_(pa.int64())), pa.array(numbers, pa.list_(pa.int32())),
                ],
                ["id", "mark", "host", "path", "codes", "numbers"],
            )

    kind = keyed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, mark long, host string, path string, codes array<long>, numbers array<int>"
    return keyed.mapInArrow(outline, schema)


def shared_lines(keyed: DataFrame) -> DataFrame:
    """(id, mark, deleted): numbers of the lines that a page shares with its nearest page, where there are any."""
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "id", "mark"]
    sorted_ = _outlines(keyed).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # stored with its places, since the bounds of ranges are sampled
    placed = Stored(
        sorted_.withColumn("place", F.monotonically_increasing_id()).select(
            "*", F.shiftright("place", 33).alias("part"), F.expr("place & 8589934591").alias("nth")
        ).drop("place"),
        "pages",
    )
    parts = placed.rows.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = placed.rows.join(parts, "part").withColumn("place", F.col("before") + F.col("nth")).drop("part", "nth", "before")
    # the first and last row of a block also stand in for a neighbour in the next one
    block, within = F.floor(F.col("place") / _BLOCK_ROWS), F.col("place") % _BLOCK_ROWS
    blocks = F.when(within == 0, F.array(block, block - 1)).when(within == _BLOCK_ROWS - 1, F.array(block, block + 1))
    dealt = (
        numbered.withColumn("home", block)
        .withColumn("block", F.explode(F.coalesce(blocks, F.array(block))))
        .withColumn("guest", F.col("block") != F.col("home"))
        .drop("home")
        .repartition(partitions, "block")
        .sortWithinPartitions("block", "place")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window: list[dict] = []

        def judged() -> list[tuple]:
            """The middle page of the window against the nearer of its neighbours."""
            page = window[-2]
            if page["guest"]:
                return []
            near = [
                other
                for other in (window[-3] if len(window) > 2 else None, window[-1])
                if other and other["block"] == page["block"] and other["host"] == page["host"]
            ]
            if not near:
                return []
            other = max(near, key=lambda o: _common(o["path"], page["path"]))
            shared = {page["numbers"][i] for i, _ in aligned(page["codes"], other["codes"])}
            own = {n for n in page["numbers"] if n > 0}
            gone = sorted(n - 1 for n in shared if n > 0)
            return [(page["id"], page["mark"], gone)] if gone and len(gone) < len(own) else []

        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            rows = []
            for page in batch.to_pylist():
                window = [*window[-2:], page]
                if len(window) > 1:
                    rows += judged()
            yield _deleted(rows, kind)
        if window:
            window = [*window[-2:], {"block": None, "host": None}]
            yield _deleted(judged(), kind)

    kind = keyed.schema["id"].dataType.simpleString()
    found = dealt.mapInArrow(compare, f"id {kind}, mark long, deleted array<int>")
    return found.groupBy("id", "mark").agg(F.min("deleted").alias("deleted"))


def _deleted(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, marks, gone = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array(marks, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], ["id", "mark", "deleted"]
    )


def _common(a: str, b: str) -> int:
    """How much of the path two pages share, in characters."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return same


def extracted(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, ``text``) of each page."""
    url, page = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(html_col), F.lit(""))
    mark = F.xxhash64(url, page).alias("mark")
    found = shared_lines(df.select(F.col(id_col).alias("id"), mark, url.alias("url"), page.alias("page")))
    pages = df.select(F.col(id_col).alias("id"), mark, F.col(url_col).alias("url"), packed(page).alias("page"))
    same = pages["id"].eqNullSafe(found["id"]) & (pages["mark"] == found["mark"])
    joined = pages.join(found, same, "left").select(pages["id"], "url", "page", "deleted")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unpacker()
        for batch in batches:
            texts = [
                main_text(unpack(page).decode(), frozenset(deleted or ()))
                for page, deleted in zip(batch.column("page").to_pylist(), batch.column("deleted").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
            )

    kind = pages.schema["id"].dataType.simpleString()
    result = joined.mapInArrow(extract, f"id {kind}, url string, text string")
    return result.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
