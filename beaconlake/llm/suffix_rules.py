"""Quality rules by repetition inside a document, from its suffix array.

The suffix array of a document's words is built by prefix doubling: ranks of words, then of 2, 4, 8... words, with only
positions sorted again that still share their rank. The ranks of every step are kept, so the longest common prefix of
suffixes that stand next to each other comes from descending through them. Such a prefix of length n at suffix i is an
occurrence of a repeated substring; the largest over both neighbours is the longest repeated substring that begins at i.
The LCP intervals of at least ``min_repeat`` words are the maximal repeated substrings, and the union of all their
occurrences is the union of [i, i + n) over the suffixes i: the words of a document that are covered.

Many documents are handled in one array: a word's number counts within its document, so no prefix crosses documents.

Defined results: null, empty and wordless texts have no words, fail the base rule and are not kept; a document of one word
repeats nothing; repeated rows are judged alike; an empty table gives no rows. Texts are read whole; a document longer
than a batch is a batch of its own. Other columns of the input are kept by ``judge_repetition``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beaconlake.llm.common import table

BATCH_WORDS = 200_000
WINDOW = 5
MIN_REPEAT = 10
# A covered word also lies in a window found twice, so a covered share decides only below the base rule's 20 percent.
# The longest repeat in documents labelled good is 13 words (sf0.1).
MAX_COVERED = 0.1
MAX_LONGEST = 40
SYMBOLS = b"#*$%&|<>"

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_covered_words long, longest_repeat long, kept boolean"
)


def ranks(first: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4... numbers of each suffix, until all differ. ``first`` must end suffixes apart.

    Rank = number of suffixes that are smaller, so a rank stays right while ties are split.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    step, out = 1, []
    rank = np.empty(n, np.int64)
    keys = first[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.empty(0, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    out.append(rank)
    sizes = np.diff(np.r_[starts, n])
    tied = order[np.repeat(sizes > 1, sizes)]  # positions that share their rank, by rank
    while len(tied):
        behind = tied + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        head = rank[tied]
        by = np.lexsort((second, head))
        tied, head, second = tied[by], head[by], second[by]
        new_head = np.r_[True, head[1:] != head[:-1]]
        new = new_head | np.r_[True, second[1:] != second[:-1]]
        at = np.arange(len(tied))
        of_head, of_new = np.maximum.accumulate(np.where(new_head, at, 0)), np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[tied] = head + (of_new - of_head)
        out.append(rank)
        step *= 2
        group = np.flatnonzero(new)
        sizes = np.diff(np.r_[group, len(tied)])
        tied = tied[np.repeat(sizes > 1, sizes)]
    return out


def neighbour_prefixes(first: np.ndarray) -> np.ndarray:
    """Per suffix, the longest prefix that it shares with a neighbour in the suffix array."""
    n = len(first)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    levels = ranks(first)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    above, below = suffixes[:-1], suffixes[1:]
    pair = np.flatnonzero(levels[0][above] == levels[0][below])
    above, below = above[pair], below[pair]
    a, b, length = above.copy(), below.copy(), np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = 1 << k
        length[same] += step
        a[same] += step
        b[same] += step
    np.maximum.at(best, above, length)
    np.maximum.at(best, below, length)
    return best


def _covered(length: np.ndarray, starts: np.ndarray, ends: np.ndarray, of_doc: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Words per document in the union of [i, i + length[i]) over the chosen positions."""
    n = len(length)
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(chosen)
    np.add.at(change, at, 1)
    np.add.at(change, at + length[at], -1)
    inside = np.cumsum(change[:-1]) > 0
    return np.bincount(of_doc[inside], minlength=len(starts))


def repetition(texts: list[list[bytes]], window: int = WINDOW, min_repeat: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words in windows found twice or more, covered words, longest repeat) for documents given as lists of words."""
    counts = np.array([len(t) for t in texts], np.int64)
    of_doc = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    if not len(of_doc):
        zero = np.zeros(len(texts), np.int64)
        return zero, zero.copy(), zero.copy()
    codes = pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)
    # Each document is followed by an end of its own: suffixes of equal documents end apart.
    width = int(codes.max()) + 2
    place = np.arange(len(codes)) + of_doc
    first = np.empty(len(codes) + len(texts), np.int64)
    first[place] = of_doc * width + codes + 1
    first[ends + np.arange(len(texts))] = np.arange(len(texts)) * width
    length = neighbour_prefixes(first)[place]
    in_windows = _covered(np.full(len(codes), window), starts, ends, of_doc, length >= window)
    covered = _covered(length, starts, ends, of_doc, length >= min_repeat)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, of_doc, length)
    return in_windows, covered, longest


def _lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def judge(
    texts: list[str | None], window: int = WINDOW, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> dict[str, np.ndarray]:
    """The columns of ``COLUMNS`` for a list of texts."""
    texts = [t or "" for t in texts]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]
    n_words = np.array([len(w) for w in split], np.int64)
    blanks = np.array([len(t) - len(t.translate(_NO_SPACE)) for t in texts], np.int64)
    chars = np.array([len(t) for t in texts], np.int64) - blanks
    symbols = np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], np.int64)
    dup_lines = np.array([_lines(t) for t in texts], np.int64)
    repeats, covered, longest = repetition(split, window, min_repeat)
    base_failed = (n_words < 10) | (100 * repeats > 20 * n_words)
    kept = ~base_failed & (covered <= max_covered * n_words) & (longest <= max_longest)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return dict(zip(names, (n_words, chars, symbols, dup_lines, repeats, base_failed, covered, longest, kept)))


_NO_SPACE = dict.fromkeys([0x20, *range(0x09, 0x0E)])


def _batches(texts: pa.Array, batch_words: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``batch_words`` words (taken as six bytes); a longer text stands alone."""
    start, held = 0, 0
    for i, size in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if held and held + size > 6 * batch_words:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def judge_repetition(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` (with ``text``) and the columns of ``COLUMNS``; options as for ``judge``."""
    added = T.StructType.fromDDL(COLUMNS)
    own = [f for f in docs.schema.fields if f.name not in added.names]
    schema = T.StructType([*own, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            text = batch.column("text")
            for start, end in _batches(text, BATCH_WORDS):
                found = judge(text.slice(start, end - start).to_pylist(), **limits)
                kept = [batch.column(f.name).slice(start, end - start) for f in own]
                yield pa.RecordBatch.from_arrays(kept + [pa.array(x) for x in found.values()], [f.name for f in own] + list(found))

    return docs.mapInArrow(run, schema)


def op2_suffix_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol, line and repetition counts of every document, and whether it is kept."""
    judged = judge_repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")
