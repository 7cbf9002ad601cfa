"""Main text of web pages by nearest-URL page differencing.

Every page is parsed into blocks of text, each with its place in the markup. Within a host, pages are
ordered by URL path; a page is compared with the nearest pages on either side (longest common path
first), their blocks are aligned by longest common subsequence, and blocks that both hold are
template and deleted. Headings, paragraphs, list items and the like inside an explicit article are
content by markup, and are kept even if a copied page holds them too; everything else that carries
the page's text stands or falls by the comparison. Blocks inside elements that cannot be main text
(navigation, forms, scripts, ...) take no part.

Only block hashes are ordered and compared. The order is a range partitioning by (host, path), so a
host may hold any share of the pages; ranks come from the stored partitions' sizes, and pages meet
in blocks of ``BLOCK`` consecutive ranks with a margin on either side.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldline.llm.common import checkpoint, row_id

BLOCK = 2000
REACH = 2
#: A neighbour that shares this much of a page's text is a copy, not a page of the same template.
COPY_SHARE = 0.9

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:\s++|/|=|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+){0,1000}+)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp noembed noframes".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody tfoot thead tr ul".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre caption figcaption td th tr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT = frozenset("nav header footer aside form menu dialog button select head search".split())
_CLOSES_P = _BLOCKS - frozenset("body html head option optgroup".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus discussion footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promos promotion related replies reply respond share sharing sidebar sidebars signup social sponsor "
    "sponsored subscribe subscription teaser toolbar topbar widget".split())
_HINT_STARTS = ("comments", "commentl", "commentb", "sidebar", "advert", "sponsor", "breadcrumb", "cookie", "newsletter", "subscri", "pagin")
_FRAME = frozenset(["header", "footer", "masthead"])

ARTICLE, MAIN, PLAIN, CUT = 3, 2, 1, 0
_SPACE = re.compile(r"\s+")


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    if raw and raw.strip(" /"):
        for m in _ATTRIBUTE.finditer(raw):
            found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return found


def parse(page: str | None) -> list[tuple[str, int, bool]]:
    """Blocks of a page in order: (text, region, prose).

    ``region`` is ARTICLE, MAIN or PLAIN for what may be main text, by the innermost such element; blocks
    that cannot be are left out. ``prose``: inside a paragraph, heading, list item, table row or the like.
    """
    if not page:
        return []
    out: list[tuple[str, int, bool]] = []
    words: list[str] = []
    # Tag, and what held before it: region, prose, and the region whose header this is (0: none).
    stack: list[tuple[str, int, bool, int]] = []
    region, prose, frame = PLAIN, False, 0

    def flush():
        if words:
            text = _SPACE.sub(" ", entities.unescape("".join(words))).strip()
            if text and region != CUT:
                out.append((text, region, prose))
            words.clear()

    def close(tag: str, fences: frozenset = frozenset()) -> bool:
        nonlocal region, prose, frame
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                flush()
                _, region, prose, frame = stack[i]
                del stack[i:]
                return True
            if stack[i][0] in fences:
                return False
        return False

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            words.append(page[at:])
            break
        if m.start() > at:
            words.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in _BLOCKS:
                if not close(tag):
                    flush()
            elif tag in ("td", "th"):
                words.append(" ")
            else:
                close(tag, _BLOCKS)  # an inline element that set a region of its own, if any
            continue
        if tag in ("br", "td", "th", "img", "wbr"):
            if tag != "wbr":
                words.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if not m[3].rstrip().endswith("/"):
                at = end.end() if end else len(page)
            continue
        if tag in _CLOSES_P:
            close("p", _BLOCKS - {"p"})
        if tag in ("li", "dt", "dd", "tr", "option"):
            close(tag, frozenset(["ul", "ol", "dl", "table", "menu", "dir"]))
        attributes = _attributes(m[3])
        new, in_frame = region, frame
        tokens = set(re.split(r"[\s_\-:.]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())) - {""}
        role = attributes.get("role", "").lower()
        if region != CUT:
            if tag == "article" or role == "article" or attributes.get("itemprop", "").lower() == "articlebody":
                new = ARTICLE
            elif tag == "main" or role == "main":
                new = max(region, MAIN)
            hints = {t for t in tokens if t in _HINTS or t.startswith(_HINT_STARTS)}
            if tag in ("html", "body", "main") or tag in _HEADINGS:
                hints = set()
            elif tag == "article":
                hints -= _FRAME
            hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            if tag in _OUT or role in _OUT_ROLES or hints or hidden:
                own_header = region > PLAIN and (tag == "header" or hints == {"header"})
                new, in_frame = CUT, region if own_header else 0
        elif frame and tag in _HEADINGS:
            new, in_frame = frame, 0  # the header of the article (or main part) holds its title
        opens_block = tag in _BLOCKS
        if opens_block or new != region:
            flush()
            stack.append((tag, region, prose, frame))
            region, frame = new, in_frame
            prose = prose or tag in _PROSE
    flush()
    return out


def candidates(blocks: list[tuple[str, int, bool]]) -> list[tuple[str, bool]]:
    """(text, protected) of the blocks in the page's best region: an article, else main, else all."""
    best = max((r for _, r, _ in blocks), default=PLAIN)
    return [(t, best == ARTICLE and prose) for t, r, prose in blocks if r >= best]


def lcs_matches(a: list, b: list) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``, by bit-parallel dynamic programming."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    ends = [*range(low), *range(len(a) - high, len(a))]
    common = set(a[low:len(a) - high]) & set(b[low:len(b) - high])
    x = [i for i in range(low, len(a) - high) if a[i] in common]
    y = [j for j in range(low, len(b) - high) if b[j] in common]
    if not x:
        return ends
    masks: dict = {}
    for j, k in enumerate(y):
        masks[b[k]] = masks.get(b[k], 0) | 1 << j
    full = (1 << len(y)) - 1
    s, rows = full, []
    for i in x:
        u = s & masks[a[i]]
        s = (s + u | s - u) & full
        rows.append(s)
    found, i, j = [], len(x) - 1, len(y) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            found.append(x[i])
            i, j = i - 1, j - 1
    return sorted(ends + found)


def url_key(url: str | None) -> tuple[str, str] | None:
    """(host, path) of a URL; None without a host. Query and fragment don't count, nor does a trailing slash."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]+)([^?#\s]*)", url or "")
    if not m:
        return None
    return m[1].lower().rpartition("@")[2], m[2].rstrip("/")


def _key_batches(batches):
    for batch in batches:
        rows = []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            key, own = url_key(url), candidates(parse(page))
            # A settled page has nothing to decide, but as a neighbour it may decide on others.
            settled = key is None or all(p for _, p in own)
            hashes = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in own]
            rows.append((*(key or (None, None)), hashes, [len(t) for t, _ in own], [p for _, p in own], settled))
        host, path, hashes, size, kept, settled = map(list, zip(*rows)) if rows else ([],) * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("hash"), pa.array(host, pa.string()), pa.array(path, pa.string()),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(size, pa.list_(pa.int32())),
             pa.array(kept, pa.list_(pa.bool_())), pa.array(settled, pa.bool_())],
            ["row", "hash", "host", "path", "lines", "sizes", "protected", "settled"],
        )


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def template_blocks(page: tuple, neighbours: list[tuple]) -> list[int]:
    """Places of a page's blocks that the nearest page of its template shares.

    ``page``: (lines, sizes, protected). Neighbours, nearest first: lines. A neighbour that shares
    COPY_SHARE of the page's text is passed over.
    """
    lines, sizes, protected = page
    for other in neighbours:
        shared = lcs_matches(lines, other)
        if sum(sizes[i] for i in shared) < COPY_SHARE * sum(sizes):
            return [i for i in shared if not protected[i]]
    return []


def _compare(reach: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", ignore_index=True)
        rows = list(pdf[["row", "hash", "host", "path", "lines", "sizes", "protected", "settled", "home"]].itertuples(index=False))
        out = []
        for i, r in enumerate(rows):
            if not r.home or r.settled:
                continue
            near = [j for j in range(max(0, i - reach), min(len(rows), i + reach + 1)) if j != i and rows[j].host == r.host]
            near.sort(key=lambda j: (-common_prefix(r.path, rows[j].path), abs(j - i), j))
            drop = template_blocks((list(r.lines), list(r.sizes), list(r.protected)), [list(rows[j].lines) for j in near])
            if drop:
                out.append((r.row, r.hash, drop))
        return pd.DataFrame(out, columns=["row", "hash", "drop"])

    return run


def template_decisions(pages: DataFrame, block: int = BLOCK, reach: int = REACH) -> DataFrame:
    """(row, hash, drop): the candidate blocks to delete, for pages where any is."""
    base = pages.select(row_id("page_id", "url", "html").alias("row"), F.xxhash64("url", "html").alias("hash"),
                        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = ("row long, hash long, host string, path string, lines array<long>, sizes array<int>, "
              "protected array<boolean>, settled boolean")
    keyed = base.mapInArrow(_key_batches, schema).where("host is not null")
    order = keyed.repartitionByRange("host", "path", "row", "hash").sortWithinPartitions("host", "path", "row", "hash")
    stored = checkpoint(order.withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33).cast("int"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    stored = stored.withColumn("__part", part)
    # One number per partition reaches the driver, and as many go back out.
    starts, total = [], 0
    for r in sorted(stored.groupBy("__part").count().collect()):
        starts.append((r[0], total))
        total += r[1]
    offsets = pages.sparkSession.createDataFrame(starts, "__part int, __start long")
    ranked = stored.join(F.broadcast(offsets), "__part").withColumn("rank", F.col("__start") + place)
    lowest = F.floor((F.col("rank") - reach) / F.lit(float(block))).cast("long")
    highest = F.floor((F.col("rank") + reach) / F.lit(float(block))).cast("long")
    home = F.floor(F.col("rank") / F.lit(float(block))).cast("long")
    dealt = ranked.withColumn("block", F.explode(F.sequence(lowest, highest))).withColumn("home", F.col("block") == home)
    return dealt.drop("__at", "__part", "__start").groupBy("block").applyInPandas(_compare(reach), "row long, hash long, drop array<int>")


def _text_batches(batches):
    for batch in batches:
        texts = []
        for page, drop in zip(batch.column("__html").to_pylist(), batch.column("__drop").to_pylist()):
            gone = set(drop or ())
            texts.append("\n".join(t for i, (t, _) in enumerate(candidates(parse(page))) if i not in gone))
        keep = [i for i, n in enumerate(batch.schema.names) if n not in ("__html", "__drop")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(texts, pa.string())], [batch.schema.names[i] for i in keep] + ["__text"]
        )


def extract_text(pages: DataFrame, block: int = BLOCK, reach: int = REACH) -> DataFrame:
    """``pages`` (page_id, url, html, ...) with ``text`` and ``n_chars`` (code points) for ``html``.

    Further columns stay (those named text or n_chars are replaced). A null or empty page has the empty
    text. A page without a host in its URL is compared with none. Equal rows get equal texts; rows that
    repeat a page_id are pages of their own. An empty table gives an empty result.
    """
    drops = template_decisions(pages, block, reach).dropDuplicates(["row", "hash"])
    drops = drops.select(F.col("row").alias("__row"), F.col("hash").alias("__hash"), F.col("drop").alias("__drop"))
    keyed = pages.drop("text", "n_chars").withColumn("__row", row_id("page_id", "url", "html")).withColumn("__hash", F.xxhash64("url", "html"))
    joined = keyed.withColumn("__html", F.col("html").cast("string")).drop("html").join(drops, ["__row", "__hash"], "left")
    joined = joined.drop("__row", "__hash")
    schema = T.StructType([f for f in joined.schema.fields if f.name not in ("__html", "__drop")] + [T.StructField("__text", T.StringType())])
    out = joined.mapInArrow(_text_batches, schema)
    return out.withColumn("text", F.col("__text")).drop("__text").withColumn("n_chars", F.length("text").cast("long"))
