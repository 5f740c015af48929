"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each with the path of tags from the root to it. Parts
that are never article text (navigation, headers, footers, asides, forms, scripts,
notices, adverts, comments of readers ...) go by their tags and class words. Names never
speak against html, body, main and article, nor against a container with most of the
page's text or punctuation (unless its whole name says so and an article element holds
text beside it). Where only part of a name is on the list, the container goes if its
ratio is low against the rest of the page. For every
path the length and the punctuation of its nodes are added up; a path's ratio is its
text per node, weighted by punctuation. The ratios are smoothed along the page, fused
with the path's share of the page's text, and the paths above a threshold mark content.
The container that holds the marked nodes is the article: short paragraphs and headings
in it stay, whatever their own ratio.

Defined cases: null, empty and text-free pages give an empty text; unclosed and stray
tags are tolerated; pages of any length are read whole; repeated rows give equal rows;
null identifiers are kept; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

from pyspark.sql import DataFrame

from arealis.llm.common import documents

# tags whose content is not markup
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp")
# tags that never hold article text
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "object", "canvas", "label", *RAW}
# words of class, id and role that say the same
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising advertorial banner promo promotion sponsor sponsored sidebar side notice notices notification alert cookie cookies consent gdpr newsletter subscribe subscription signup login share sharing social related recommended comment comments reply replies disqus breadcrumb breadcrumbs menu nav navbar navigation footer header masthead popup modal overlay widget pagination pager toolbar skip contentinfo complementary search".split()
)
# words that add nothing to a name
NEUTRAL = set("area block bottom box bar container content inner item left list main outer page panel right section site top wrap wrapper".split())
WHOLE = {"html", "body", "main", "article"}  # no name counts for these
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
# an opening tag of these ends an open one of the same set's row
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")
THRESHOLD = 0.15
PART = 0.5  # of the page's ratio, for a container with part of a name on the list
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


def named(tag: str, attributes: str) -> int:
    """2 if a whole name of the element is on the list, 1 if the first or last word of one."""
    best = 0
    if tag in WHOLE:
        return best
    for found in _NAMES.findall(attributes) if "=" in attributes else ():
        for name in "".join(found).split():
            words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
            if words and (words[0] in OUTSIDE_WORDS or words[-1] in OUTSIDE_WORDS):
                if all(w in OUTSIDE_WORDS or w in NEUTRAL for w in words):
                    return 2
                best = 1
    return best


def weighed(found: list[tuple[tuple[str, ...], str, tuple[tuple[int, int], ...]]]) -> list[tuple[tuple[str, ...], str]]:
    """The blocks without those of containers whose names speak against them."""
    totals: dict[tuple[int, int], list[int]] = {}
    page, free = [0, 0, 0], [0, 0, 0]
    for _, text, held in found:
        size = len(text), len(PUNCTUATION.findall(text)), len(text) ** 2
        for total in (page, *(totals.setdefault(h, [0, 0, 0]) for h in held), *(() if held else (free,))):
            for i in range(3):
                total[i] += size[i]
    if not totals:
        return [(path, text) for path, text, _ in found]
    article = any(not held and ("article" in path or "main" in path) for path, _, held in found)

    def ratio(total):
        """As in content(), of the block that a character of the container is in on average."""
        block = total[2] / total[0] if total[0] else 0.0
        return block * math.log1p(1 + total[1] / total[0] * block) if total[0] else 0.0

    gone = set()
    for at, total in totals.items():
        most = 2 * total[0] > page[0] or 2 * total[1] > page[1]
        if at[1] == 2 and (article or not most) or at[1] == 1 and not most and ratio(total) < PART * ratio(free):
            gone.add(at)
    return [(path, text) for path, text, held in found if not gone.intersection(held)]


def blocks(page: str) -> list[tuple[tuple[str, ...], str]]:
    """The page's blocks in order: container path and text."""
    # tag, whether it or one above is outside, containers around with a name on the list
    path: list[tuple[str, bool, tuple[tuple[int, int], ...]]] = []
    found = []
    parts: list[str] = []

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text and not (path and path[-1][1]):
            found.append((tuple(t for t, *_ in path if t not in INLINE), text, path[-1][2] if path else ()))

    def shut(at: int):
        flush()
        del path[at:]

    at = 0
    for token in _TOKEN.finditer(page):
        parts.append(page[at : token.start()])
        at = token.end()
        raw, closing, tag, attributes = token.groups()
        if raw or not tag:
            continue
        tag = tag.lower()
        if tag in INLINE and not (not closing and named(tag, attributes) == 2):
            if tag == "br":
                parts.append(" ")
                continue
            if tag not in ("a", "span"):
                continue
            # an outside inline element takes its text with it
            if closing:
                where = next((i for i in range(len(path) - 1, -1, -1) if path[i][0] == tag), None)
                if where is not None and all(t in INLINE for t, *_ in path[where:]) and path[where][1] and not (where and path[where - 1][1]):
                    parts.clear()
                    del path[where:]
            continue
        if tag in VOID:
            flush()
            continue
        if closing:
            where = next((i for i in range(len(path) - 1, -1, -1) if path[i][0] == tag), None)
            if where is not None:
                shut(where)
            elif tag == "p":
                flush()
            continue
        flush()
        ended = CLOSES.get(tag, {"p"} if tag not in INLINE else set())
        for i in range(len(path) - 1, -1, -1):
            if path[i][0] in ended or path[i][0] == "p" and tag not in INLINE:
                shut(i)
                break
            if path[i][0] in ("ul", "ol", "dl", "table", "article", "section", "div", "main", "body", "html", "td", "th"):
                break
        if tag in ("body", "html") and any(t == tag for t, *_ in path):
            continue
        gone, held = path[-1][1:] if path else (False, ())
        name = named(tag, attributes)
        path.append((tag, gone or tag in OUTSIDE or tag in INLINE, held + ((token.start(), name),) if name else held))
    parts.append(page[at:])
    flush()
    return weighed(found)


def content(found: list[tuple[tuple[str, ...], str]]) -> list[str]:
    """The texts of the article among a page's blocks."""
    if not found:
        return []
    totals: dict[tuple[str, ...], list[float]] = {}
    for path, text in found:
        total = totals.setdefault(path, [0, 0, 0])
        total[0] += len(text)
        total[1] += len(PUNCTUATION.findall(text))
        total[2] += 1
    whole = sum(t[0] for t in totals.values())
    ratio = {path: n / k * math.log1p(1 + p / k) for path, (n, p, k) in totals.items()}
    raw = [ratio[path] for path, _ in found]
    kernel = (0.25, 0.5, 0.25)
    smooth = [sum(w * raw[min(max(i + d, 0), len(raw) - 1)] for d, w in zip((-1, 0, 1), kernel, strict=True)) for i in range(len(raw))]
    fused: dict[tuple[str, ...], float] = {}
    for (path, _), value in zip(found, smooth, strict=True):
        fused[path] = fused.get(path, 0.0) + value / totals[path][2]
    fused = {path: value * math.sqrt(totals[path][0] / whole) for path, value in fused.items()}
    least = THRESHOLD * max(fused.values())
    marked = [path for path, value in fused.items() if value >= least]
    # the container that the marked paths share, leaf tags apart
    roots = [path[:-1] for path in marked]
    root = roots[0]
    for other in roots[1:]:
        n = next((i for i, (a, b) in enumerate(zip(root, other)) if a != b), min(len(root), len(other)))
        root = root[:n]
    named = next((i for i, tag in enumerate(root) if tag in ("article", "main")), None)
    if named is not None:
        root = root[: named + 1]
    return [text for path, text in found if path[: len(root)] == root]


def main_text(page: str | None) -> str:
    return "\n".join(content(blocks(page))) if page else ""


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            text = [main_text(value.as_py()) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(pages[key].cast("long"), pages[url], pages[page]).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages"))


# every page of the tables is an article element of headings and paragraphs
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS h FROM pages),
b AS (SELECT page_id, url, unnest(regexp_split_to_array(regexp_replace(h, '<br>|</?b>', ' ', 'g'), '<[^>]*>')) AS t, generate_subscripts(regexp_split_to_array(regexp_replace(h, '<br>|</?b>', ' ', 'g'), '<[^>]*>'), 1) AS i FROM a),
c AS (SELECT page_id, url, i, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS t FROM b),
d AS (SELECT page_id, url, coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '') AS text FROM c GROUP BY ALL)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
