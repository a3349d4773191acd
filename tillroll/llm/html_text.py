"""Main text of web pages as the maximum-scoring run of tokens.

A page is a row of tokens: runs of text and tags. Words score positive and tags
negative, with weights counted on pages whose own markup says where the article is; on
such a page words outside its mark score negative. One scan finds the run with the
largest sum. The run is then widened to what it is part of: the whole marked article,
or the blocks at its ends. What stands in menus, adverts, comments and the like never
scores and never comes out, even inside that run.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices_by_bytes

SAMPLE_ROWS = 4_096  # pages that the weights are counted on, in expectation at most
LEAST_OUTSIDE = 1_000  # words outside articles and boilerplate, below which tags in boilerplate count as outside
MOST_FEATURES = 4_096  # names of elements that weights are kept for

# Elements by what they do to the text.
_TO_THE_END = "script|style"  # without an end tag, what follows is theirs
_RAW = "noscript|template|iframe|svg|object|canvas|audio|video|title|select|textarea|button"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
_BOXES = frozenset("article aside details dialog div dl fieldset figure footer form header main menu nav ol section span table ul".split())
_BOILERPLATE_TAGS = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "aside", "form": "form",
    "dialog": "notice", "fieldset": "form",
}
_BOILERPLATE_NAMES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar pagination pager tabs",
    "header": "header masthead topbar",
    "footer": "footer copyright colophon",
    "aside": "sidebar aside widget related recommended trending popular",
    "notice": "cookie cookies notice consent gdpr popup modal alert newsletter subscribe subscription overlay paywall",
    "advert": "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion",
    "form": "form login signup search searchbox",
    "comment": "comment comments commentlist reply replies respond responses feedback disqus discussion",
    "share": "share sharing social",
}
_CONTENT_NAMES = frozenset("article post entry content story title headline".split())
_MODIFIERS = frozenset("with has no without".split())  # `with-sidebar` says what stands beside the element
_MARKS = ("article", "main")
# Names that an article's own parts have too; there the id of a part or heading does not decide by them.
_SUBJECTS = frozenset("discussion related search copyright alert notice feedback responses promotion login tabs widget".split())
_PARTS = frozenset("section h1 h2 h3 h4 h5 h6".split())
_ROLES = {"navigation": "menu", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "form", "dialog": "notice", "alert": "notice", "alertdialog": "notice"}

_KIND_OF = {name: kind for kind, names in _BOILERPLATE_NAMES.items() for name in names.split()}
_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<code>{_TO_THE_END})(?=[\s/>])[^>]*>.*?(?:</(?P=code)\s*>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?P<held>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)


@functools.cache
def _end_of(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE)


_named = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_hidden = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_part = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")
_word = re.compile(r"\w+")


def _kind(tag: str, attrs: str, in_article: bool) -> tuple[str | None, bool]:
    """What kind of boilerplate the element is, if it is any, and whether by more than its names."""
    if tag == "header" and in_article:
        return None, False  # holds the article's own headings
    if tag in _BOILERPLATE_TAGS:
        return _BOILERPLATE_TAGS[tag], tag not in ("form", "fieldset", "dialog")
    if not attrs or tag in ("body", "html", "main"):
        return None, False
    if _hidden.search(attrs):
        return "hidden", True
    for name, a, b, c in _named.findall(attrs):
        value = a or b or c
        if name.lower() == "role" and value.strip().lower() in _ROLES:
            return _ROLES[value.strip().lower()], True
        parts = [part.lower() for one in value.split() if (cut := _part.split(one))[0].lower() not in _MODIFIERS for part in cut]
        if tag == "article" and not _CONTENT_NAMES.isdisjoint(parts) and "comment" not in parts:
            continue  # its classes are its topics
        own_part = in_article and tag in _PARTS and name.lower() == "id"
        for part in parts:
            if own_part and part in _SUBJECTS:
                continue
            kind = _KIND_OF.get(part)
            if kind and not (kind == "header" and (in_article or not _CONTENT_NAMES.isdisjoint(parts))):
                return kind, kind == "comment"
    return None, False


class Token(NamedTuple):
    feature: str  # `word`, `link word`, `tag NAME`, `end NAME`, or `box KIND` for the start of boilerplate
    text: str
    box: int  # the innermost boilerplate it stands in, -1 for none
    marked: bool  # in an explicit article


class Box(NamedTuple):
    kind: str
    outer: int  # the box around it, -1 for none
    sure: bool  # the element or its role says so, not its names


def tokens(page: str) -> tuple[list[Token], list[Box]]:
    """The page's tokens in order, and its boilerplate elements.

    Unclosed elements end with their parent; an end tag without a start is a tag like
    another. Boilerplate that nothing closes any more ends where an article starts.
    Elements whose content is no text are left out up to their end tag; those that close
    themselves, or that nothing closes, have none.
    """
    row: list[Token] = []
    boxes: list[Box] = []
    stack: list[tuple[str, int]] = []  # element, its box or that around it
    box = -1
    articles = links = 0
    unclosed: set[str] = set()  # elements that no end tag is left for
    at = 0

    def closes(name: str) -> bool:
        """Is an end tag of this name still to come?"""
        if name not in unclosed and not _end_of(name).search(page, at):
            unclosed.add(name)
        return name not in unclosed

    def cut(depth: int) -> None:
        nonlocal articles, box
        articles -= sum(t in _MARKS for t, _ in stack[depth:])
        del stack[depth:]
        box = stack[-1][1] if stack else -1

    while at < len(page):
        m = _token.match(page, at)
        at = m.end()
        if m["raw"]:
            name = m["raw"].lower()
            if not m["held"].endswith("/") and closes(name):
                at = _end_of(name).search(page, at).end()
            continue
        text = m["text"]
        if text is not None:
            row.append(Token("link word" if links else "word", text, box, articles > 0))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag == "a":
            links = 0 if m["close"] else 1
        if m["close"]:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == tag), None)
            inside = box
            if depth is not None:
                cut(depth)
                links = 0
            row.append(Token(f"end {tag}", "", inside, articles > 0))
            continue
        if tag in _BLOCKS and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            cut(len(stack) - 1)
        if tag in _MARKS and box >= 0:
            open_ = next((d for d, (t, b) in enumerate(stack) if b >= 0), None)
            if open_ is not None and not closes(stack[open_][0]):
                cut(open_)
        kind, sure = _kind(tag, m["attrs"], articles > 0)
        around = box
        if kind:
            boxes.append(Box(kind, box, sure))
        row.append(Token(f"box {kind}" if kind else f"tag {tag}", "", around, articles > 0))
        if (tag in _BOXES or (kind and tag in _BLOCKS)) and not m["attrs"].endswith("/"):
            box = len(boxes) - 1 if kind else box
            stack.append((tag, box))
            articles += tag in _MARKS
    return row, boxes


def _n_words(text: str) -> int:
    return len(_word.findall(text))


def boilerplate(row: list[Token], boxes: list[Box]) -> list[bool]:
    """Which boxes really are boilerplate, with all that is inside such a one.

    A form, or an element that is one by its names, is none if it holds the only article
    of the page, or more than half of the words of a page that marks no article. Words of
    links are no evidence.
    """
    words = [0] * len(boxes)
    marks = [False] * len(boxes)
    total, outside_marked = 0, False
    for feature, text, box, marked in row:
        if feature != "word":
            continue
        n = _n_words(text)
        total += n
        outside_marked |= box < 0 and marked and n > 0
        while box >= 0:
            words[box] += n
            marks[box] |= marked and n > 0
            box = boxes[box].outer
    real: list[bool] = []
    for i, (_, outer, sure) in enumerate(boxes):
        holds = not sure and not outside_marked and (marks[i] if any(marks) else 2 * words[i] > total)
        real.append((outer >= 0 and real[outer]) or not holds)
    return real


def _scored(row: list[Token], real: list[bool]) -> Iterator[tuple[str, int, bool]]:
    """Feature, count and whether it stands in boilerplate, for each token; on marked pages words know their side."""
    has_mark = any(t.marked and t.text and (t.box < 0 or not real[t.box]) and _word.search(t.text) for t in row)
    for feature, text, box, marked in row:
        if text and has_mark:
            feature = f"marked {feature}" if marked else f"unmarked {feature}"
        yield feature, _n_words(text) if text else 1, box >= 0 and real[box]


def count_features(pages: list[str | None]) -> Counter[tuple[str, str]]:
    """How often each feature stands `in` articles, `out`side, and in `box`es, over pages that mark their article."""
    total: Counter[tuple[str, str]] = Counter()
    for page in pages:
        row, boxes = tokens(page or "")
        scored = list(_scored(row, boilerplate(row, boxes)))
        if not any(f.startswith("marked") for f, _, _ in scored):
            continue
        for token, (feature, n, boxed) in zip(row, scored):
            side = "box" if boxed else "in" if token.marked else "out"
            total[feature.removeprefix("marked ").removeprefix("unmarked "), side] += n
    return total


def fit_weights(pages: DataFrame, rows: int = SAMPLE_ROWS, page_id: str = "page_id", page: str = "html") -> dict[str, float]:
    """Log-odds of each feature between article and rest, words held above and tags below zero.

    A feature's odds are how often it stands in an article against how often outside.
    Counted on about `rows` pages chosen by the hash of their identifier; the driver gets
    one row per element name, at most MOST_FEATURES. Without marked pages every feature
    has its default, see `weight`.
    """
    share = min(1.0, rows / max(pages.count(), 1))
    place = F.pmod(F.xxhash64(page_id, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "html"):
            found = count_features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in found], pa.string()), pa.array([s for _, s in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["feature", "side", "n"],
            )

    sums = [F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0)).alias(side) for side in ("in", "out", "box")]
    got = (
        pages.filter(place < share)
        .select(F.col(page).alias("html"))
        .mapInArrow(counted, "feature string, side string, n long")
        .groupBy("feature")
        .agg(*sums)
        .orderBy(F.desc(F.col("in") + F.col("out") + F.col("box")), "feature")
        .limit(MOST_FEATURES)
        .collect()
    )
    if not got:
        return {}
    with_boxes = sum(r["out"] for r in got if "word" in r["feature"]) < LEAST_OUTSIDE
    weights = {}
    for r in got:
        # Words in boilerplate never score, but its tags say what tags of unnamed boilerplate look like.
        outside = r["out"] + (r["box"] if with_boxes and "word" not in r["feature"] else 0)
        odds = math.log((r["in"] + 1) / (outside + 1))
        if "word" in r["feature"]:
            weights[r["feature"]] = min(max(odds, 0.25), 2.0)
        elif not r["feature"].startswith("box"):
            weights[r["feature"]] = min(max(odds, -3.0), -0.05)
    return weights


def weight(feature: str, weights: dict[str, float]) -> float:
    """A feature's weight; on a page that marks its article, words outside it count against a run."""
    if feature.startswith("unmarked"):
        return -1.0
    feature = feature.removeprefix("marked ")
    default = {"word": 1.0, "link word": 0.5}.get(feature, -2.0 if feature.startswith("box") else -0.25)
    return weights.get(feature, default)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the first run with the largest sum; empty if none is above zero."""
    best, best_from, best_to = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_from, best_to = total, begin, i + 1
    return best_from, best_to


def _is_edge(token: Token) -> bool:
    """Does a block begin or end here?"""
    return not token.text and (token.feature.startswith("box") or token.feature.split(" ", 1)[1] in _BLOCKS)


def _blocks_of(run: list[Token]) -> list[str]:
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if block:
            blocks.append(block)

    for token in run:
        if token.text:
            parts.append(token.text)
        elif token.feature == "tag br":
            parts.append(" ")
        elif _is_edge(token):
            flush()
    flush()
    return blocks


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best run, in page order, joined by a line break; empty if nothing scores.

    Where the page marks its article, and the run touches it, all that is marked comes
    out, several articles one after another; else the run is widened to whole blocks.
    """
    row, boxes = tokens(page or "")
    real = boilerplate(row, boxes)
    scored = list(_scored(row, real))
    start, end = best_run([0.0 if boxed else n * weight(feature, weights) for feature, n, boxed in scored])
    if start == end:
        return ""
    if any(f.startswith("marked") for f, _, _ in scored[start:end]):
        chosen = [i for i, token in enumerate(row) if token.marked or not token.text]
    else:
        while start > 0 and not _is_edge(row[start - 1]):
            start -= 1
        while end < len(row) and not _is_edge(row[end]):
            end += 1
        chosen = list(range(start, end))
    # Boilerplate keeps its tags, which end the blocks around it, and loses its text.
    return "\n".join(_blocks_of([row[i] for i in chosen if not (row[i].text and scored[i][2])]))


def extract_pages(pages: DataFrame, weights: dict[str, float], page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """A row per input row: `page_id, url, text, n_chars`.

    A null or empty page, and one without any words outside boilerplate, has the
    empty text. Repeated rows stay repeated; null identifiers and addresses stay null.
    """
    frame = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_bytes(batches, "html"):
            texts = [extract(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    return frame.mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
