"""HTML extraction by the maximum-scoring contiguous region.

A page is a sequence of tags and blocks of words. Words of running text score positive; tags, and words inside menus,
forms and other parts that are named as such, score zero or less. One linear scan finds the contiguous region with the
largest sum; the blocks of running text inside it are the result. The weights are logarithms of how much more often a
kind of token stands inside the main text than outside, counted on labelled pages: pages of a bounded sample whose
document is known, so that each block of the page is found in the document's text or not.

What counts as a part beside the text: elements that by their name, role, or class or id words are menus, headers and
footers of the page, sidebars, notices, adverts, forms, comments and the like; where a page has an ``article`` or
``main``, also everything outside it. Inside the region such parts are left out. A name with ``has-``, ``no-``, ``-open``
and the like tells a state and names no part. What an outer element's class or id says is only a first guess: a ``main``
ends it, an ``article`` too where such articles hold more running text (words outside links) than the rest of the page, and
each class or id word has a weight of its own, so that a word whose blocks are found in the documents counts as running text.

Defined results: null, empty and wordless pages give an empty text; broken markup is read as far as it goes, unclosed
elements end with their parent; equal sums take the first region; repeated rows give equal rows; empty tables none. White
space inside a block becomes one space, ``br`` too. Other columns than those named are not read.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import broadcast_if_small, table, written
from beaconlake.llm.url_filters import path_of

SAMPLE_PAGES = 1_000
WORD_RANGE, TAG_RANGE = (0.1, 2.0), (-0.5, -0.01)
BESIDE_SCORE = -0.001
LEAST_WORDS = 5  # a shorter block stands in many documents by chance

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frame "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noframes noscript ol optgroup option p pre search section "
    "select summary table tbody td template textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BESIDE_TAGS = frozenset(
    "nav footer aside form script style head title noscript template iframe object svg select button textarea menu dialog search "
    "canvas audio video noembed noframes frameset datalist optgroup option".split()
)
BESIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer masthead comment comments disqus reply replies respond cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations widget toolbar pagination pager copyright disclaimer search form hidden".split()
)
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())

# A quote begins a value only after an equals sign; elsewhere, and inside a value without quotes, it is a character like
# others. A value whose quote never ends, ends with its tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*+(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|$)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
# Words that a class or id adds to the name of a part, as in share-buttons; with any other word it names something else,
# as share-price does.
PART_WORDS = frozenset(
    "area banner bar block body bottom box button buttons center column container content desktop entry first float global group "
    "header holder icon icons inner item items js layout left link links list main mini mobile module outer page panel post posts "
    "primary right row secondary section site slot small social sticky story the third top unit wrap wrapper".split()
)
# Elements that are counted by their name; others are one kind, so that the kinds are a fixed list.
KNOWN_TAGS = BLOCKS | VOID | RAW | BESIDE_TAGS | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark math meter nobr output picture progress q rp rt "
    "ruby s samp slot small span strike strong sub sup time tt u var".split()
)
UNKNOWN_TAG = "other"
PIECES = re.compile(r"[a-z]+")
# First or last piece of a name that tells a state, such as has-sidebar or menu-open.
STATE_FIRST = frozenset("has with without no not".split())
STATE_LAST = frozenset("open opened closed active inactive enabled disabled visible expanded collapsed on off".split())


def _named(value: str) -> str:
    """The first word of ``BESIDE_WORDS`` in a class or id that names the element itself.

    All of the name must be such words or ``PART_WORDS``.
    """
    for name in value.split():
        pieces = PIECES.findall(name)
        if pieces and pieces[0] not in STATE_FIRST and (len(pieces) == 1 or pieces[-1] not in STATE_LAST):
            if all(piece in BESIDE_WORDS or piece in PART_WORDS for piece in pieces):
                for piece in pieces:
                    if piece in BESIDE_WORDS:
                        return piece
    return ""


def _beside(name: str, attributes: str, in_main: bool) -> bool | str:
    """True for a part beside the text, or the class or id word that says so; False or '' for none."""
    if name in BESIDE_TAGS or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        # The page itself and its main part are never beside the text; an article may be a comment.
        if name != "article" or not attributes:
            return False
    word = ""
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id"):
            word = word or _named(value)
        if key == "role" and value.strip() in BESIDE_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return word


class Token:
    """A tag (``tag``) or a block of words (``text``); ``beside``: True or a class or id word in parts beside the text."""

    __slots__ = ("tag", "text", "n_words", "n_linked", "beside", "in_main")

    def __init__(self, tag: str | None, text: str, beside: bool | str, in_main: bool, n_linked: int = 0):
        self.tag, self.text, self.beside, self.in_main, self.n_linked = tag, text, beside, in_main, n_linked
        self.n_words = len(text.split(" ")) if text else 0


def tokens(page: str | None) -> list[Token]:
    """The tags and blocks of a page in order; a block never crosses the tag of a block element."""
    out, inner = _read(page or "", ("main",))
    if inner:
        opened, _ = _read(page or "", ("main", "article"))
        # A box of teasers holds articles too, but less running text than the page has outside it; a list of links is none.
        outside = sum(t.n_words - t.n_linked for t in out if not t.beside)
        inside = sum(t.n_words - t.n_linked for t, closed in zip(opened, out) if not t.beside and closed.beside)
        return opened if inside > outside else out
    return out


def _read(page: str, ends: tuple[str, ...]) -> tuple[list[Token], bool]:
    """(tokens, whether there is an article inside a part beside the text); ``ends`` end what a class or id word began."""
    inner = False
    out: list[Token] = []
    stack: list[tuple[str, bool | str, bool]] = []  # name, beside, in the main part
    opened: Counter = Counter()  # names on the stack: one that is not there is not looked for
    pieces: list[str] = []
    linked = 0  # words of the block that stand in links
    state = (False, False)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html_module.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append(Token(None, text, *state, linked))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        pieces.append(text)
        if opened["a"]:
            linked += len(text.split())

    def cut(depth: int) -> None:
        opened.subtract(entry[0] for entry in stack[depth:])
        del stack[depth:]

    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            break
        match = TOKEN.match(page, start)
        if match is None:
            add(page[at:start + 1])
            at = start + 1
            continue
        if start > at:
            add(page[at:start])
        at = match.end()
        if match[2] is None:
            continue
        name, closing = match[2].lower(), bool(match[1])
        if name in BLOCKS or name in RAW:
            flush()
        elif name == "br":
            pieces.append(" ")
        out_of = state
        if closing:
            for depth in range(len(stack) - 1, -1, -1) if opened[name] > 0 else ():
                if stack[depth][0] == name:
                    # What stands in a part that ends here, ends with it.
                    if any(s[1:] != (stack[depth - 1][1:] if depth else (False, False)) for s in stack[depth:]):
                        flush()
                    cut(depth)
                    break
            state = stack[-1][1:] if stack else (False, False)
        else:
            if name in BLOCKS:
                depth = _open_paragraph(stack, opened, name)
                if depth is not None:
                    cut(depth)
                state = stack[-1][1:] if stack else (False, False)
                out_of = state
            if name not in VOID and not match[3].rstrip().endswith("/"):
                own = _beside(name, match[3], state[1])
                inner = inner or name == "article" and isinstance(state[0], str) and state[0] != "" and not own
                # What names a part, ends a class or id word further out; True is never ended.
                beside = own if state[0] is False or own is True or state[0] == "" or name in ends and state[0] is not True else state[0]
                new = (beside, state[1] or name in ("article", "main") and not beside)
                if new != state:
                    flush()
                stack.append((name, *new))
                opened[name] += 1
                state = new
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.start() if end else len(page)
        out.append(Token(name if name in KNOWN_TAGS else UNKNOWN_TAG, "", out_of[0] or state[0], out_of[1] and state[1]))
    if at < len(page):
        add(page[at:])
    flush()
    return out, inner


def _open_paragraph(stack: list[tuple[str, bool | str, bool]], opened: Counter, name: str) -> int | None:
    """Where the paragraph lies on the stack that a block ends, or the item of the same list that a list item ends."""
    if opened["p"] > 0 or name == "li" and opened["li"] > 0:
        for depth in range(len(stack) - 1, -1, -1):
            open_name = stack[depth][0]
            if open_name == "p" or open_name == name == "li":
                return depth
            if open_name in BLOCKS:
                return None
    return None


def kinds(page: list[Token]) -> list[str]:
    """The kind of each token: ``text``, ``beside``, the tag's name, or ``beside:`` and the class or id word of a block."""
    has_main = any(t.n_words and t.in_main and not t.beside for t in page)
    return [
        f"beside:{t.beside}" if t.n_words and t.beside and t.beside is not True
        else "beside" if t.beside or (t.n_words and has_main and not t.in_main) else t.tag or "text"
        for t in page
    ]


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous region with the largest sum; empty when none is above zero."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, value in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, region = total, (start, i + 1)
    return region


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a page."""
    parts = tokens(page)
    of_kind = kinds(parts)
    other = weights.get("", TAG_RANGE[0])
    # A block whose class or id word has a weight above zero is running text; one below need not split the region.
    running = {k for k in of_kind if k == "text" or k.startswith("beside:") and weights.get(k, 0) > 0}
    scores = [
        t.n_words * weights[k] if k in running else BESIDE_SCORE if k.startswith("beside") else weights.get(k, other)
        for t, k in zip(parts, of_kind)
    ]
    start, end = best_region(scores)
    return "\n".join(t.text for t, k in zip(parts[start:end], of_kind[start:end]) if k in running)


def count_kinds(page: str | None, document: str | None) -> dict[str, tuple[int, int]]:
    """Per kind, tokens (or words) inside the main text and outside: the region from the first to the last block in the document.

    Blocks with a class or id word are inside if they stand in the document themselves.
    """
    parts = tokens(page)
    known = " ".join((document or "").split())
    of_kind = kinds(parts)
    found = [i for i, t in enumerate(parts) if t.n_words and t.text in known]
    named = {i for i in found if of_kind[i].startswith("beside:") and parts[i].n_words >= LEAST_WORDS}
    inside = [i for i in found if of_kind[i] == "text"] or sorted(named)
    out: dict[str, tuple[int, int]] = {}
    if inside:
        for i, (t, k) in enumerate(zip(parts, of_kind)):
            a, b = out.get(k, (0, 0))
            n = t.n_words or 1
            is_inside = i in named if k.startswith("beside:") else inside[0] <= i <= inside[-1]
            out[k] = (a + n, b) if is_inside else (a, b + n)
    return out


def learn_weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log ratios of shares inside and outside, kept in ``WORD_RANGE`` for words and ``TAG_RANGE`` for tags; '' is any other tag."""
    inside, outside = (sum(c[i] for c in counts.values()) + len(counts) + 1 for i in (0, 1))
    weights = {"text": 1.0, "": TAG_RANGE[0]}
    for kind, (a, b) in counts.items():
        value = float(np.log((a + 1) / inside) - np.log((b + 1) / outside))
        if kind.startswith("beside:"):
            weights[kind] = min(value, WORD_RANGE[1])
        elif kind != "beside":
            weights[kind] = float(np.clip(value, *(WORD_RANGE if kind == "text" else TAG_RANGE)))
    return weights


# ---- Spark ----

def labelled_sample(pages: DataFrame, docs: DataFrame, rows: int = SAMPLE_PAGES) -> DataFrame:
    """(html, text): at most ``rows`` pages (smallest hash of their id) with the document whose id ends their path."""
    number = F.expr("try_cast(number as bigint)")
    numbered = pages.select("page_id", "html", F.regexp_extract(path_of(F.col("url")), r"/(\d+)(\.\w+)?/?$", 1).alias("number"))
    numbered = numbered.select("page_id", number.alias("doc_id")).where("doc_id is not null and page_id is not null")
    chosen = numbered.orderBy(F.xxhash64("page_id"), "page_id", "doc_id").limit(rows)
    texts = docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    known = written(chosen.join(texts, "doc_id").select("page_id", "text"), "html-sample")
    return pages.select("page_id", "html").join(broadcast_if_small(known), "page_id").select("html", "text")


def train(pages: DataFrame, docs: DataFrame, rows: int = SAMPLE_PAGES) -> dict[str, float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [count_kinds(h.as_py(), d.as_py()).items() for h, d in zip(batch.column("html"), batch.column("text"))]
            rows = [(k, a, b) for k, (a, b) in chain.from_iterable(found)]
            if rows:
                kind, a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])

    counted = labelled_sample(pages, docs, rows).mapInArrow(run, "kind string, a long, b long")
    sums = counted.groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # One row per known tag and class or id word.
    return learn_weights({r.kind: (r.a, r.b) for r in sums.collect()})


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(page_id, url, text) of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), weights) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")


def op5_html_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, with weights learnt from pages whose document is known."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = train(pages, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return extract_pages(pages, weights).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
