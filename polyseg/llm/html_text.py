"""Main text of HTML pages by equivalence-class template deduction.

Pages of a host share a template.  A page is cut into tokens: tags with their path and class,
and text nodes with their path.  A token's occurrence vector over the host's pages (how often
it stands in each) is kept as a linear sketch, ``sum over pages of count * mix(page)`` modulo
2^64 with its support, so it is one mergeable aggregate and no host's pages ever meet in one
task; tokens of a host with equal sketches form an equivalence class.  A class is valid if it
is large and frequent enough (``MIN_SIZE`` tokens, on at least ``MIN_SHARE`` of the host's pages
and ``MIN_PAGES`` of them, and on as many different pages: a bitmap of page hashes tells copies
from pages).  Valid classes nest by the places their tokens stand at: a token counts only if the
element around it is in a valid class too, up to the root.  The tokens of nested classes are the
template, and what stands between them are the slots.  Text nodes of the template are never
extracted; inside an article, only text on ``FIXED_SHARE`` of the host's pages is template, so
that a group of near copies keeps its text.

A slot is content by the template elements (tag tokens of valid classes) it nests in: the page's
article or main elements if these hold at least half of the slots' text, else the innermost
template container that holds ``CONTENT_SHARE`` of it.  A check by tag and class follows:
navigation, headers and footers of the page, side bars, notices, adverts, forms, scripts,
styles, hidden parts and reader comments are never extracted and don't count.

Templates go to the tasks by broadcast where all of them together are small (``BROADCAST``
tokens); beyond that they are joined to salted pages.  Pages are never gathered by host.

Defined cases: null html is empty and gives the empty text; pages without a usable url share
the host ''; hosts with fewer than ``MIN_PAGES`` pages have no template and are read by the
position rules alone; repeated pages are ordinary rows; unclosed elements end with their
parent; from the first tag that never closes on, quotes don't hide a ``>`` any more, and what
follows the last ``>`` is text; an empty table gives no rows.  Reading takes time and memory in
proportion to the page, however deep it nests.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import kept, small_batches, table

MIN_PAGES, MIN_SHARE, MIN_SIZE = 3, 0.5, 2
FIXED_SHARE, CONTENT_SHARE = 0.9, 0.9
BROADCAST, SALTS = 1_000_000, 16
#: Elements that may hold all of a page's content.
CONTAINERS = frozenset("article body center div html main section table tbody td".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>|[^<]+|<", re.S)
#: The same without regard to quotes, for pages with a tag that never closes.
LOOSE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>|[^<]+|<", re.S)
STARTS = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title select object math".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROP = frozenset("head nav footer aside form button dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar alertdialog".split())
#: Words of class and id values that mark what isn't the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs header footer masthead sidebar aside side rail widget cookie cookies consent notice notification alert gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion related recommended pagination pager form search".split()
)
#: Of these, the ones that are never spared for an article inside: readers write articles too.
COMMENTS = frozenset("comment comments reply replies respond disqus discussion".split())
#: Inside an article, headers belong to it.
IN_ARTICLE = frozenset(["header", "masthead", "banner"])


def _dropped(tag: str, attributes: str, in_article: bool, spare: bool = False) -> bool:
    if tag in DROP or tag == "header" and not in_article:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id"):
            marks = (COMMENTS if spare and not in_article else MARKS).intersection(re.split(r"[^a-z0-9]+", value))
            if marks - IN_ARTICLE if in_article else marks:
                return tag not in ("body", "html", "main")
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) >> 1


class Parse:
    """Events (kind, tag or text, place, dropped, articles open, container) of a page; kind: 1 opens, 2 closes, 0 text.

    A place is the hash of the block elements around; containers are numbered in page order, with the one around each
    and the hash of its tag token.
    """

    def __init__(self, page: str, spare: bool = False):
        self.events: list[tuple[int, str, int, bool, int, int]] = []
        self.around, self.token = [-1], [0]
        stack: list[tuple[str, bool, int, int, int]] = []  # tag, dropped, articles, place, container
        open_: dict[str, int] = {}
        at, end, last, pattern = 0, len(page), page.rfind(">"), TOKEN
        while at < end:
            dropped, articles, place, box = stack[-1][1:] if stack else (False, 0, 0, 0)
            if at > last:
                self.events.append((0, page[at:], place, dropped, articles, box))
                break
            m = pattern.match(page, at)
            if pattern is TOKEN and m.end() == at + 1 and STARTS.match(page, at):
                pattern = LOOSE  # no end of this tag is in sight: quotes are stray from here on
                continue
            at = m.end()
            closes, tag, attributes = m.group(1, 2, 3)
            if tag is None:
                text = m.group()
                if text[:4] != "<!--" and text[:2] not in ("<!", "<?"):
                    self.events.append((0, text, place, dropped, articles, box))
                continue
            tag = tag.lower()
            if closes:
                if open_.get(tag):
                    while (gone := stack.pop()[0]) != tag:
                        open_[gone] -= 1
                    open_[tag] -= 1
                self.events.append((2, tag, stack[-1][3] if stack else 0, dropped, articles, box))
                continue
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
                stack.pop()
                open_[tag] -= 1
                dropped, articles, place, box = stack[-1][1:] if stack else (False, 0, 0, 0)
            kinds = ",".join(sorted("".join(x[1:]) for x in ATTRIBUTE.findall(attributes) if x[0].lower() == "class")) if attributes else ""
            self.events.append((1, f"{tag}[{kinds}]", place, dropped, articles, box))
            if tag in VOID or attributes.rstrip().endswith("/"):
                continue
            if tag in RAW:
                found = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = found.end() if found else end
                continue
            gone = dropped or _dropped(tag, attributes, articles > 0, spare)
            if tag in CONTAINERS:
                self.around.append(box)
                self.token.append(_hash(f"1 {place} {tag}[{kinds}]"))
                box = len(self.token) - 1
            # an inline element left open must not colour what follows: only block elements make places
            stack.append((tag, gone, articles + (tag in ("article", "main") and not gone), _hash(f"3 {place} {tag}") if tag in BLOCK else place, box))
            open_[tag] = open_.get(tag, 0) + 1


    def has_article(self) -> bool:
        return any(kind == 0 and articles and not dropped and not what.isspace() for kind, what, _, dropped, articles, _ in self.events)


def read(page: str) -> Parse:
    """The page's events; where class or id marks hide every article, they don't hold for what is around articles."""
    parse = Parse(page)
    if not parse.has_article() and re.search(r"<(?:article|main)\b", page, re.I):
        spared = Parse(page, spare=True)
        return spared if spared.has_article() else parse
    return parse


def template_tokens(page: str) -> dict[tuple[int, int], tuple[int, bool]]:
    """Occurrences of each token of a page with its place, and whether it is text inside an article.

    Tokens are tags with their classes, text nodes, and the places that elements make.
    """
    out: dict[tuple[int, int], tuple[int, bool]] = {}
    for kind, what, place, _, articles, _ in read(page).events:
        what = " ".join(what.split()) if kind == 0 else what
        if not what:
            continue
        own = [_hash(f"{kind} {place} {what}")]
        if kind == 1 and (tag := what.partition("[")[0]) in BLOCK:
            own.append(_hash(f"3 {place} {tag}"))
        for h in own:
            out[h, place] = out.get((h, place), (0,))[0] + 1, kind == 0 and articles > 0
    return out


def nested(tokens: list[int], places: list[int]) -> list[int]:
    """The tokens whose places are tokens too, up to the root (place 0)."""
    kept = set(tokens)
    while True:
        good = {t for t, p in zip(tokens, places, strict=True) if t in kept and (p == 0 or p in kept)}
        if len(good) == len(kept):
            return sorted(kept)
        kept = good


def _content(parse: Parse, slots: list[tuple[int, int, int]], template: frozenset | set) -> int | None:
    """The container whose slots are content (0: all); None: the articles, or all without any."""
    total, own = sum(n for n, _, _ in slots), sum(n for n, articles, _ in slots if articles)
    if not template or 2 * own >= total:
        return None
    held = [0] * len(parse.around)
    for n, _, box in slots:
        held[box] += n
    for box in range(len(held) - 1, 0, -1):
        held[parse.around[box]] += held[box]
    # of nested containers with nearly all text the innermost one comes last in page order
    return max((box for box in range(1, len(held)) if held[box] >= CONTENT_SHARE * total and parse.token[box] in template), default=0)


def main_text(page: str, template: frozenset | set) -> str:
    """Text of the slots that hold the article."""
    parse, blocks = read(page), [[]]
    for kind, what, place, dropped, articles, box in parse.events:
        if kind:
            if what.partition("[")[0] in BLOCK and blocks[-1]:
                blocks.append([])
            continue
        if dropped or template and _hash(f"0 {place} {' '.join(what.split())}") in template:
            continue
        blocks[-1].append((what, articles, box))
    slots = [(len("".join(what.split())), articles, box) for parts in blocks for what, articles, box in parts]
    place = _content(parse, slots, template)
    any_article = any(n and articles for n, articles, _ in slots)
    if place is None:
        kept = [parts for parts in blocks if not any_article or any(articles for _, articles, _ in parts)]
    else:
        inside = [place == 0] * len(parse.around)
        for box in range(1, len(inside)):
            inside[box] = inside[box] or box == place or inside[parse.around[box]]
        kept = [[x for x in parts if inside[x[2]]] for parts in blocks]
    texts = (" ".join(entities.unescape("".join(what for what, _, _ in parts)).split()) for parts in kept if parts)
    return " ".join(x for x in texts if x)


def _token_rows(batches):
    for b in batches:
        sums: dict[tuple[int, int, int], list[int]] = {}
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            page = _hash(html) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
            page ^= page >> 29
            for (h, place), (n, in_article) in template_tokens(html).items():
                s = sums.setdefault((host, h, place), [0, 0, 0, 0])
                s[0] += 1
                s[1] = s[1] + n * page & 0xFFFFFFFFFFFFFFFF
                s[2] |= 1 << (page & 63)
                s[3] |= in_article
        if sums:
            host, token, place = zip(*sums, strict=True)
            pages, sketch, seen, in_article = zip(*sums.values(), strict=True)
            wide = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            columns = [*(pa.array(x, pa.int64()) for x in (host, token, place)), pa.array([bool(x) for x in in_article]), pa.array(pages, pa.int64()), wide(sketch), wide(seen)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "token", "place", "in_article", "pages", "sketch", "seen"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): tokens of the valid, nested equivalence classes of pages(host, html)."""
    size = pages.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    vector = pages.mapInArrow(_token_rows, "host long, token long, place long, in_article boolean, pages long, sketch long, seen long").groupBy("host", "token", "place").agg(
        F.sum("pages").alias("pages"),
        F.max("in_article").alias("in_article"),
        F.bit_count(F.bit_or("seen")).alias("different"),
        # addition modulo 2^64 that doesn't overflow: the halves apart
        F.sum(F.expr("sketch & 4294967295L")).alias("low"),
        F.sum(F.expr("shiftrightunsigned(sketch, 32)")).alias("high"),
    )
    share = F.when(F.col("in_article"), FIXED_SHARE).otherwise(MIN_SHARE)
    vector = vector.where(f"pages >= {MIN_PAGES} and different >= {MIN_PAGES}").join(size, "host").where(F.col("pages") >= share * F.col("n"))
    low, high = F.expr("low % 4294967296L"), F.expr("(high + low div 4294967296L) % 4294967296L")
    classes = vector.groupBy("host", "pages", low.alias("s0"), high.alias("s1")).agg(F.collect_list(F.struct("token", "place")).alias("tokens"))
    classes = classes.where(F.size("tokens") >= MIN_SIZE)
    nest = F.arrow_udf(lambda t, p: pa.array([nested(a, b) for a, b in zip(t.to_pylist(), p.to_pylist(), strict=True)], pa.list_(pa.int64())), "array<long>")
    per = classes.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("ts"))
    return per.select("host", nest(F.col("ts.token"), F.col("ts.place")).alias("template"))


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Add the main text to every row of ``pages``; a column of its name gives way."""
    spark = pages.sparkSession
    small_batches(spark)
    host = F.xxhash64(F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)))
    html = F.coalesce(F.col(html_col), F.lit(""))
    known = kept(templates(pages.select(host.alias("host"), html.alias("html"))))
    if (known.agg(F.sum(F.size("template"))).first()[0] or 0) <= BROADCAST:
        got = known.toArrow()
        shared = spark.sparkContext.broadcast(dict(zip(got.column("host").to_pylist(), (np.array(x, np.int64) for x in got.column("template").to_pylist()), strict=True)))

        def by_host(html: pa.Array, hosts: pa.Array) -> pa.Array:
            own = hosts.to_pylist()
            sets = {h: frozenset(shared.value[h].tolist()) if h in shared.value else frozenset() for h in set(own)}
            return pa.array([main_text(page, sets[h]) for page, h in zip(html.to_pylist(), own, strict=True)], pa.string())

        return pages.withColumn(out_col, F.arrow_udf(by_host, "string")(html, host))

    def by_template(html: pa.Array, template: pa.Array) -> pa.Array:
        return pa.array([main_text(page, frozenset(t or ())) for page, t in zip(html.to_pylist(), template.to_pylist(), strict=True)], pa.string())

    names = pages.columns
    keyed = pages.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), host.alias("host"), html.alias("html"), F.pmod(F.xxhash64(html), F.lit(SALTS)).cast("long").alias("salt"))
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = keyed.join(spread, ["host", "salt"], "left")
    return joined.select(*(F.col("row").getField(c).alias(c) for c in names if c != out_col), F.arrow_udf(by_template, "string")(F.col("html"), F.col("template")).alias(out_col))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
