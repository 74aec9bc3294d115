"""Main text of web pages by equivalence-class template deduction.

1. Every page becomes a sequence of tokens: a tag with its path from the root
   (names, and the class or id words of containers), and the white-space
   normalised text of a text run with its path.
2. The occurrence vector of a token is its count on every distinct page content
   of the host (copies of a page count once, whatever their url). It is kept as
   sums over contents (contents, and a hash of content and count), so vectors are
   aggregated map-side and never collected, whatever the number of pages of a
   host. Tokens of a host with equal vectors form a class.
3. A class is valid if it occurs on at least ``support`` contents and has a token
   that is a tag: its texts are boilerplate, hence no data. The class of the page
   itself (tokens that occur once on every content) is the template's skeleton.
   Its tags nest by their paths; the text runs below a tag, added up over the
   host, are that tag's mass. The deepest skeleton container that holds more than half of the
   host's mass is the data slot: such containers lie inside one another, so it is unique.
4. A page's text is what its host's slot holds, less boilerplate and furniture
   (navigation, headers, footers, sidebars, notices, adverts, forms, comments, by element and by
   the words of class, id and role). Inside an article or main element only whole
   words count, and words that also name chapters (legal, related, ...) do not.
   A word of an element around the page's article never hides the article. If the
   page has article or main elements, the slot's text inside them is taken; a
   page without its host's slot goes by these elements alone, or by all that is no
   furniture. Slots are joined in page order.

Hosts with fewer distinct pages than ``support`` have no deduced template and use the
slot rules alone. Templates (a row per host with any) are broadcast only if
they are few, else joined.

Defined results: NULL or empty html, or a page without main text, gives an
empty text and n_chars 0; a NULL url counts as one unnamed host; rows that
repeat a page are pages of their own; an empty table gives no rows; further
columns of the input are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import stored

SUPPORT = 5
BROADCAST_HOSTS = 50_000
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                     r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?:\s|^)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp svg".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr math mi mn mo mrow msup msub mfrac msqrt mtext".split())
_FURNITURE = frozenset("head nav header footer aside form menu dialog button fieldset object applet video audio canvas "
                       "select".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
_FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header footer masthead sidebar aside ad ads advert adverts "
    "advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal newsletter subscribe subscription signup login share sharing social related recommended comment "
    "comments disqus replies reply feedback widget toolbar pagination pager copyright legal disclaimer".split())
_CHAPTER_WORDS = frozenset("related promotion banner reply widget copyright legal disclaimer".split())
_MODIFIERS = frozenset("has no with without is not hide show".split())
_PARTS = frozenset("bar list box block slot links form thread widget panel item items button buttons menu".split())
_CONTAINERS = frozenset("body div section article main td center".split())
_MAIN = frozenset(["article", "main"])
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                      "pre section table ul".split())
_SELF_CLOSING = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
                 "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
                 "option": frozenset(["option"])}
_LIST_SCOPE = frozenset("ul ol dl table body html article main div section nav".split())


def _labels(attributes: str) -> tuple[list[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name in ("class", "id", "role"):
            words += value.split()
    return words, hidden


def _named_furniture(label: str, in_main: bool) -> bool:
    """Whether a class, id or role word names furniture: the word itself or, outside
    main content, a compound that ends in it or says what part of it this is."""
    if in_main:
        return label in _FURNITURE_WORDS and label not in _CHAPTER_WORDS or label in _FURNITURE_ROLES - _CHAPTER_WORDS
    if label in _FURNITURE_WORDS or label in _FURNITURE_ROLES:
        return True
    first, *rest = [w for w in re.split(r"[-_:]+", label) if w] or [""]
    return bool(rest) and first not in _MODIFIERS and (rest[-1] in _FURNITURE_WORDS or first in _FURNITURE_WORDS and rest[0] in _PARTS)


def _furniture(name: str, labels: list[str], hidden: bool, in_main: bool) -> int:
    """2 by element or if hidden, 1 by a word, else 0."""
    if hidden or name in _FURNITURE:
        return 2
    if name in ("html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
        return 0
    return int(any(_named_furniture(label, in_main) for label in labels))


def runs(page: str) -> Iterator[tuple[str, str | None, int, int, bool]]:
    """The page in order: (path, text, furniture, main, starts a block); text is
    None for a tag. ``main`` is 2 inside article or main, 1 if a word of an element around it
    names furniture (its own content starts afresh as no furniture), else 0."""
    stack: list[tuple[str, str, int, int]] = [("", "", 0, 0)]
    at, block = 0, True
    size = len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            yield stack[-1][1], text, stack[-1][2], stack[-1][3], block
            block = False
        if not m:
            return
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            block = True
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if name in _VOID:
            continue
        if name in _CLOSES_P:
            k = max((i for i, s in enumerate(stack) if s[0] == "p"), default=0)
            if k and not any(s[0] in ("table", "td", "button") for s in stack[k:]):
                del stack[k:]
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in _SELF_CLOSING.get(name, ()):
                del stack[k:]
                break
            if stack[k][0] in _LIST_SCOPE:
                break
        labels, hidden = _labels(m[3])
        _, path, furniture, main = stack[-1]
        if name in _MAIN and not main and furniture < 2:
            main, furniture = 2 - furniture, 0
        furniture = max(furniture, _furniture(name, labels, hidden, main > 0))
        if name not in _INLINE:
            path = f"{path}/{name}" + "".join("." + x.replace("/", "|") for x in labels)
        yield path, None, furniture, main, True
        if m[3].endswith("/") and name not in _INLINE and name in ("path", "use"):
            continue
        stack.append((name, path, furniture, main))


def _key(path: str, text: str | None) -> int:
    raw = path if text is None else f"{path}\0{text}"
    return xxhash.xxh3_64_intdigest(raw.encode("utf-8", "surrogatepass")) - (1 << 63)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".")[0]


ROOT = _key("", None) | 1


def tokens(page: str) -> dict[int, tuple[int, int, int]]:
    """A page's tokens: key -> (count, mass, depth); the lowest bit of a key is 1 for
    tags (by path) and 0 for text runs (by path and text); ROOT is the page itself.
    Mass is the text below a container that can be a slot, else 0."""
    count: Counter = Counter({ROOT: 1})
    mass: Counter = Counter()
    slots = {"": ROOT}
    for path, text, furniture, main, _ in runs(page):
        if text is None:
            key = _key(path, None) | 1
            count[key] += 1
            if not furniture and _name(path) in _CONTAINERS and (not main or _name(path) in _MAIN and main == 2):
                slots[path] = key
            continue
        text = " ".join(entities.unescape(text).split())
        if text:
            count[_key(path, text) & ~1] += 1
            if not furniture and main != 1:
                mass[path] += len(text)
    for path in list(mass):
        while path and (path := path.rsplit("/", 1)[0]) not in mass:
            mass[path] = 0
    for path in sorted(mass, key=lambda p: -p.count("/")):
        if path:
            mass[path.rsplit("/", 1)[0]] += mass[path]
    of = {key: (mass[path], path.count("/")) for path, key in slots.items()}
    return {key: (n, *of.get(key, (0, 0))) for key, n in count.items()}


def main_text(page: str, template: frozenset[int] = frozenset(), slot: int | None = None) -> str:
    """Text of ``page`` in the host's ``slot``, or by elements alone without one;
    ``template`` holds the keys of the host's boilerplate texts."""
    parts: list[tuple[int, bool, str, bool]] = []
    inside = {"": slot == ROOT}
    for path, text, furniture, main, block in runs(page):
        if text is None:
            if path not in inside:
                inside[path] = slot is not None and (_key(path, None) | 1 == slot or inside.get(path.rsplit("/", 1)[0], False))
        else:
            text = entities.unescape(text)
            data = not furniture and (not template or main or (_key(path, " ".join(text.split())) & ~1) not in template)
            parts.append((main if data else -1, inside.get(path, False), text, block))

    def chosen(keep) -> str:
        out, gap = [], False
        for main, within, text, block in parts:
            gap |= block
            if main >= 0 and keep(main, within):
                out.append((" " if gap else "") + text)
                gap = False
        return " ".join("".join(out).split())

    article, plain = chosen(lambda main, _: main == 2), chosen(lambda main, _: main == 0)
    if article:
        return chosen(lambda main, within: main == 2 and within) or article
    hidden = chosen(lambda main, _: main == 1)
    if len(hidden) > len(plain):
        return hidden
    return chosen(lambda main, within: main == 0 and within) or plain


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(host, texts array<long>, slot long): keys of the texts of valid classes and
    of the container that is the data slot (NULL: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, keys, values = [], [], ([], [], [])
            for page in batch.column("html").to_pylist():
                of = sorted(tokens(page or "").items())
                keys.append(np.array([k for k, _ in of], np.int64))
                for i, out in enumerate(values):
                    out.append(np.array([v[i] for _, v in of], np.int64))
                contents.append(xxhash.xxh3_64_intdigest(keys[-1].tobytes() + values[0][-1].tobytes()) - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(contents, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (keys, *values))],
                ["host", "content", "tokens", "counts", "mass", "depth"])

    # copies of a page count once, else their texts would look like a template's
    distinct = (pages.select("host", "html").mapInArrow(
        run, "host string, content long, tokens array<long>, counts array<long>, mass array<long>, depth array<long>")
        .dropDuplicates(["host", "content"]))
    vectors = (distinct.select("host", "content", F.explode(F.arrays_zip("tokens", "counts", "mass", "depth")).alias("t"))
               .groupBy("host", F.col("t.tokens").alias("token"))
               .agg(F.count("*").alias("pages"),     # 40 bits of each hash: sums stay in 64
                    F.sum(F.shiftrightunsigned(F.xxhash64("content", "t.counts"), 24)).alias("vector"),
                    F.sum("t.mass").alias("mass"), F.max("t.depth").alias("depth"))
               .where(F.col("pages") >= support))
    is_tag = F.col("token").bitwiseAND(F.lit(1)) == 1
    # a class's tokens all lie on the same pages, so its lists are no longer than a page
    classes = vectors.groupBy("host", "pages", "vector").agg(
        F.max(is_tag).alias("valid"), F.collect_set(F.when(~is_tag, F.col("token"))).alias("texts"),
        F.max(F.when(F.col("token") == ROOT, F.col("mass"))).alias("total"),
        F.collect_list(F.when(is_tag & (F.col("mass") > 0), F.struct("depth", "token", "mass"))).alias("nested"))
    slot = F.array_max(F.filter("nested", lambda t: 2 * t["mass"] > F.col("total")))["token"]
    return (classes.where(F.col("valid") & ((F.size("texts") > 0) | F.col("total").isNotNull()))
            .groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("texts"), F.max(slot).alias("slot")))


def extract(pages: DataFrame, support: int = SUPPORT) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    base = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    found = stored(templates(base, support), "templates")
    few = found.count() <= BROADCAST_HOSTS and (found.agg(F.sum(F.size("texts"))).first()[0] or 0) <= 20 * BROADCAST_HOSTS
    joined = base.join(F.broadcast(found) if few else found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(p or "", frozenset(t or ()), slot) for p, t, slot in
                    zip(*(batch.column(c).to_pylist() for c in ("html", "texts", "slot")))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                              pa.array([len(t) for t in text], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "texts", "slot").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
