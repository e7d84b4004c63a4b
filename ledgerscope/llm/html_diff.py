"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path; each is paired with the neighbour whose
path is nearest (longest common path, ties to the earlier one). The text lines
(blocks) of the two are aligned by longest common subsequence, and aligned
lines, the template that both pages were poured into, are deleted.

Mark-up decides what differencing cannot: lines inside navigation, headers,
footers, sidebars, adverts, notices, forms, scripts and reader comments are
never main text; where a page marks its main text (``article``, else ``main``),
only lines inside count and its prose (paragraphs, headings, lists, quotations)
is exempt from deletion, since articles may quote the same passage.

Where aligned lines make up half of a page's text or more, what is not aligned
tells a template from a copy. A neighbour is a copy if either page has less than
``FEW`` of its text to itself; its lines prove nothing, and the neighbour on the
other side stands in, unless it is a copy too. Otherwise both pages were poured
into one template, and if the other side holds no copy, a line goes only where
that page has it as well.

Only line hashes travel to the neighbour search: host and path order come from
range partitions, so one host with a third of all pages is spread over many
tasks. Texts move once, to meet their page's deletions.

Defined cases: null or empty html gives empty text; a null url is a host of its
own; equal URLs are ordered by page_id, then by content; repeated rows get the
same result; extra columns are ignored; truncated mark-up is read to its end.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import running, stage

# Element names of HTML.
DROPPED = frozenset("script style noscript template svg math iframe object head title nav header footer aside form "
                    "button select textarea dialog menu fieldset datalist canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var wbr acronym".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt td th figcaption".split())
STARTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())  # where furniture without an end tag ends
# Class, id and role names of page furniture: one of these, or a compound of these and words of place.
FURNITURE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside widget ad ads "
    "advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup social share sharing related recommended "
    "comment comments reply replies respond disqus form search login pagination pager toolbar skip".split())
PLACES = frozenset("site page global main primary secondary top bottom left right side inner outer bar box block area section "
                   "container wrapper wrap list item items slot unit panel link links content body text row col icon icons button buttons btn "
                   "trail post posts article articles stories user reader x".split())
FEW = 0.05
# Inside an article only these count, and never on its prose.
IN_ARTICLE = frozenset("comment comments reply replies ad ads advert adverts advertisement promo promotion related teaser sponsored "
                       "newsletter share sharing social".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|title|iframe)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|<[a-zA-Z/!][^<>]*\Z", re.S | re.I)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[-_]+|[0-9]+")


def _names(token: str, names: frozenset) -> bool:
    words = [w for w in _SPLIT.split(token) if w]
    return any(w in names for w in words) and all(w in names or w in PLACES for w in words)


def _furniture(tag: str, attrs: str, article: bool) -> bool:
    if tag in DROPPED:
        return True
    if not attrs or tag in ("html", "body", "main") or article and tag in PROSE:
        return False
    names = IN_ARTICLE if article or tag == "article" else FURNITURE
    return any(_names(t, names) for m in _ATTR.finditer(attrs) for t in (m[1] or m[2] or m[3] or "").lower().split())


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside the marked main text, prose) of the blocks outside page furniture, in order."""
    if not page:
        return []
    out: list[tuple[str, int, bool]] = []
    buf: list[str] = []
    skip, depth, article, main, prose, open_ended = "", 0, 0, 0, False, False

    def never_closed(name):
        return page.find("</" + name, at) < 0 and page.find("</" + name.upper(), at) < 0

    def close():
        if buf:
            text = " ".join(_html.unescape("".join(buf)).split())
            buf.clear()
            if text:
                out.append((text, 2 if article else 1 if main else 0, prose))

    at = 0
    for m in _TOKEN.finditer(page):
        if not skip and m.start() > at:
            buf.append(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag, end = tag.lower(), m[2] == "/"
        if skip:
            if not end and (tag in ("article", "main") and skip not in ("article", "main") or open_ended and tag in STARTS):
                skip, depth = "", 0  # furniture that was never closed ends where the main text begins
            elif tag == skip:
                depth += -1 if end else 1
                if not depth:
                    skip = ""
                continue
            else:
                continue
        if tag in INLINE and tag != "img":
            if not end and m[4] and tag in ("span", "a") and _furniture(tag, m[4], article > 0):
                skip, depth, open_ended = tag, 1, never_closed(tag)
            continue
        if tag == "br":
            buf.append(" ")
            continue
        close()
        if end:
            article -= tag == "article" and article > 0
            main -= tag == "main" and main > 0
            prose = False if tag in PROSE else prose
        elif tag not in VOID and not m[4].endswith("/") and _furniture(tag, m[4], article > 0):
            skip, depth, open_ended = tag, 1, never_closed(tag)
        else:
            article += tag == "article"
            main += tag == "main"
            prose = tag in PROSE or (prose and tag not in ("article", "main", "section", "div", "body"))
    if not skip and at < len(page):
        buf.append(page[at:])
    close()
    # Main text beside articles that are shorter than it: these are teasers.
    size = [sum(len(t) for t, inside, p in out if inside == k and (p or k == 2)) for k in range(3)]
    level = 2 if size[2] and size[2] >= size[1] else max((b[1] for b in out if b[1] < 2), default=0)
    return [(t, bool(level), p) for t, inside, p in out if inside == level]


def aligned(a: list, b: list) -> list[int]:
    """Indices of ``a`` in a longest common subsequence with ``b`` (bit-parallel rows)."""
    common = set(a) & set(b)
    own = [i for i, x in enumerate(a) if x in common]
    other = [x for x in b if x in common]
    masks: dict = {}
    for j, x in enumerate(other):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    v, rows = full, [full]
    for i in own:
        u = v & masks[a[i]]
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    found, i, j = [], len(own), len(other)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            found.append(own[i - 1])
            i, j = i - 1, j - 1
    return found[::-1]


_LINES = T.StructType([T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.IntegerType())),
                       T.StructField("open", T.ArrayType(T.BooleanType()))])


@F.pandas_udf(_LINES)
def _lines(pages: pd.Series) -> pd.DataFrame:
    import xxhash

    rows = []
    for p in pages:
        b = blocks(p)
        rows.append(([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _, _ in b],
                     [len(t) for t, _, _ in b], [not (inside and prose) for _, inside, prose in b]))
    return pd.DataFrame(rows, columns=_LINES.names)


def template_of(lines: list, sizes: list, near: tuple | None, other: tuple | None) -> list[int]:
    """Indices of the template among ``lines``; a neighbour is (lines, sizes), the nearest one first."""
    total = sum(sizes)

    def compare(page):
        """Aligned lines, whether they make up half of the text, whether the page is a copy."""
        if page is None:
            return [], False, True
        found = aligned(lines, page[0])
        shared = sum(sizes[i] for i in found)
        most = 2 * shared >= total
        return found, most, most and (total - shared < FEW * total or sum(page[1]) - shared < FEW * sum(page[1]) or not shared)
    found, most, copy = compare(near)
    if not most:
        return found
    second, most, copied = compare(other)
    if copy:
        return [] if copied else second
    return found if copied else sorted(set(found) & set(second))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _deletions(hashes: pd.Series, sizes: pd.Series, open_: pd.Series, near: pd.Series, near_sizes: pd.Series,
               other: pd.Series, other_sizes: pd.Series) -> pd.Series:
    out = []
    for h, s, o, n, ns, m, ms in zip(hashes, sizes, open_, near, near_sizes, other, other_sizes):
        pages = [None if x is None else (list(x), [int(k) for k in xs]) for x, xs in ((n, ns), (m, ms))]
        out.append([i for i in template_of(list(h), [int(k) for k in s], *pages) if o[i]])
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for p, g in zip(pages, gone):
        drop = set() if g is None else set(np.asarray(g).tolist())
        out.append(" ".join(t for i, (t, _, _) in enumerate(blocks(p)) if i not in drop))
    return pd.Series(out)


def _near(path, other):
    """How many leading path segments two paths share."""
    a, b = F.split(path, "/"), F.split(other, "/")
    same = F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z: z["x"].eqNullSafe(z["y"]))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same))


def template_lines(pages: DataFrame) -> DataFrame:
    """(__id, __ph, gone): per distinct page the indices of its template lines; pages without any are left out."""
    lines = _lines(F.col("html"))
    url = F.coalesce(F.col("url"), F.lit(""))
    keyed = pages.select("__id", "__ph", F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
                         F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
                         lines.alias("l")).select("__id", "__ph", "host", "path", "l.*")
    order = [F.col(c) for c in ("host", "path", "__id", "__ph")]
    ranked = stage(running(keyed, order, {"at": F.lit(1).cast("long")}), "ranked")
    some = ranked.select("at", "host", "path", "hashes", "sizes")

    def beside(step, name):
        return some.select((F.col("at") + step).alias("at"), F.col("host").alias(f"{name}_host"),
                           F.col("path").alias(f"{name}_path"), F.struct("hashes", "sizes").alias(name))
    both = ranked.join(beside(1, "before"), "at", "left").join(beside(-1, "after"), "at", "left")
    back = F.when(F.col("before_host") == F.col("host"), _near(F.col("path"), F.col("before_path"))).otherwise(-1)
    ahead = F.when(F.col("after_host") == F.col("host"), _near(F.col("path"), F.col("after_path"))).otherwise(-1)
    first = (back >= 0) & (back >= ahead)
    chosen = (both.withColumn("near", F.when(first, F.col("before")).when(ahead >= 0, F.col("after")))
              .withColumn("other", F.when(first & (ahead >= 0), F.col("after")).when(~first & (back >= 0), F.col("before"))))
    marked = chosen.select("__id", "__ph", _deletions(
        "hashes", "sizes", "open", "near.hashes", "near.sizes", "other.hashes", "other.sizes").alias("gone")).filter(F.size("gone") > 0)
    return marked.groupBy("__id", "__ph").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    keyed = pages.select("page_id", "url", "html", F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("__id"),
                         F.xxhash64("url", "html").alias("__ph"))
    gone = stage(template_lines(keyed), "template")
    return (keyed.join(gone, ["__id", "__ph"], "left")
            .select("page_id", "url", _main_text("html", "gone").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
