"""Near-duplicate detection by b-bit MinHash, with links confirmed on full shingle sets.

1. Each text becomes a set of 64-bit shingle hashes, a 128-bit name of that set, and 128 minima. Of each minimum only four
   bits are kept, packed into 64 bytes; 32 bands of four minima give bucket keys. Texts with equal sets are one node.
2. Nodes that share a bucket are candidates. Their similarity is estimated from the packed bits: the count of equal
   four-bit groups, corrected for chance agreement (one in sixteen). Candidates far below the threshold (five standard
   deviations) are left out. Of the rest only a spanning forest per bucket is kept: it says which nodes belong together.
3. The components of those forests are families: every link lies within one. Families get their full shingle sets once;
   pairs of a family that pass the estimate and are not yet connected are confirmed by exact intersection. Again a
   spanning forest of the confirmed links is kept, whose components are the result.

Work within a bucket or family is done in square blocks, so a group of any size is spread over tasks, pairs stay inside
numpy, and what is emitted grows with the nodes and not with the pairs. Nothing is capped. At the threshold a link is
missed with a probability of about one in a million (bands and estimate together); a missed link matters only if no other
path connects its ends.

Defined results: null, empty and wordless texts have no shingles, are linked with nothing and name their own component;
texts of fewer words than a shingle are one shingle and link with equal texts only; repeated rows share a component;
rows without an id take part, but name a component only if nobody else can (then it is null), and are kept unless a row
with an id is in their component. Empty tables give no rows. Texts are read whole; other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.llm.common import broadcast_if_small, table, written
from beaconlake.operators.identity import components

SHINGLE_WORDS = 5
THRESHOLD = 80  # percent
MINIMA, BITS, BAND = 128, 4, 4
MARGIN_SD = 5.0
BATCH_WORDS = 100_000
BLOCK_NODES = 512
BLOCK_SHINGLES = 2_000_000
TASK_NODES = 4096

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(0, 2**63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 2**64, MINIMA, np.uint64)
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---- texts to sets and signatures ----

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): distinct shingle hashes of each text, sorted within it; text i holds hashes[ends[i-1]:ends[i]]."""
    split = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    flat = np.empty(total, dtype=object)
    flat[:] = [w for ws in split for w in ws]
    codes, distinct = pd.factorize(flat)
    word = pd.util.hash_array(distinct, categorize=False).astype(np.uint64)[codes]
    starts = np.cumsum(counts) - counts
    # The hash of the window that begins at each word, for windows that fit; shorter texts have one of their own length.
    hashes = np.zeros(total, np.uint64)
    padded = np.r_[word, np.zeros(size, np.uint64)]
    for j in range(size):
        hashes = _mix(hashes * _M3 + padded[j:j + total] + np.uint64(j + 1))
    shingles = np.where(counts >= size, counts - size + 1, 0)
    doc = np.repeat(np.arange(len(texts)), shingles)
    at = np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles) + np.repeat(starts, shingles)
    hashes = hashes[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            value = counts[d:d + 1].astype(np.uint64)
            for k in range(starts[d], starts[d] + counts[d]):
                value = _mix(value * _M3 + word[k:k + 1])
            own[i] = value[0]
        doc, hashes = np.r_[doc, short], np.r_[hashes, own]
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])] if len(doc) else np.empty(0, bool)
    return hashes[new], np.cumsum(np.bincount(doc[new], minlength=len(texts)))


def set_names(hashes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """16 bytes that stand for each set: sums of two mixed forms of its hashes."""
    sums = []
    for salt in (_M1, _M3):
        running = np.r_[np.uint64(0), np.cumsum(_mix(hashes ^ salt), dtype=np.uint64)]
        sums.append(running[ends] - running[np.r_[0, ends[:-1]]])
    both = np.stack([_mix(sums[0] + np.diff(np.r_[0, ends]).astype(np.uint64)), _mix(sums[1])], axis=1).astype(">u8")
    return [row.tobytes() for row in both]


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The minima (rows, MINIMA) of sets; rows of empty sets are all ones."""
    sizes = np.diff(np.r_[0, ends])
    out = np.full((len(ends), MINIMA), np.uint64(0xFFFFFFFFFFFFFFFF))
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (ends - sizes)[full]
        for j in range(MINIMA):
            out[full, j] = np.minimum.reduceat(hashes * FACTORS[j] + SHIFTS[j], starts)
    return out


def packed_bits(minima: np.ndarray) -> np.ndarray:
    """The kept bits of each minimum, two minima to a byte."""
    low = ((minima >> np.uint64(20)) & np.uint64(15)).astype(np.uint8)
    return low[:, 0::2] << 4 | low[:, 1::2]


def band_keys(minima: np.ndarray) -> np.ndarray:
    """(rows, bands) keys of buckets; the band's number is part of the key."""
    bands = minima.reshape(len(minima), -1, BAND)
    key = np.zeros(bands.shape[:2], np.uint64)
    for j in range(BAND):
        key = _mix(key * _M3 + bands[:, :, j])
    return _mix(key + np.arange(bands.shape[1], dtype=np.uint64)).view(np.int64)


def estimate(bits: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of each row of ``bits`` with each of ``others``: equal groups, corrected for chance."""
    a, b = np.ascontiguousarray(bits).view(np.uint64), np.ascontiguousarray(others).view(np.uint64)
    equal = np.zeros((len(a), len(b)), np.int32)
    for j in range(a.shape[1]):
        x = a[:, j, None] ^ b[None, :, j]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        equal += 16 - np.bitwise_count(x & np.uint64(0x1111111111111111)).astype(np.int32)
    chance = 1 / 2**BITS
    return (equal / MINIMA - chance) / (1 - chance)


def least_estimate(threshold: int) -> float:
    """The estimate below which a pair is left out: five standard deviations under the threshold."""
    t, chance = threshold / 100, 1 / 2**BITS
    p = t + (1 - t) * chance
    return t - MARGIN_SD * math.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


class Forest:
    """Union-find over row numbers; ``join`` says whether two trees were joined."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def close_pairs(bits: np.ndarray, left: range, right: range, least: float, forest: Forest) -> Iterator[tuple[int, int]]:
    """Pairs (i of ``left``, j of ``right``, i < j) of rows whose estimate reaches ``least`` and that are not yet connected."""
    for start in range(left.start, left.stop, 128):
        stop = min(start + 128, left.stop)
        close = estimate(bits[start:stop], bits[right.start:right.stop]) >= least
        for i in range(start, stop):
            for j in np.flatnonzero(close[i - start]) + right.start:
                if i < j and forest.find(i) != forest.find(int(j)):
                    yield i, int(j)


# ---- Spark ----

NODE = "node binary, n_shingles long"
PAIR = "larger binary, smaller binary"


def _rows(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t.as_buffer() or b"") if t.is_valid else 0
        if held and held + size > 6 * BATCH_WORDS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` (with ``text``) without the text, and node, n_shingles, bits, bands."""
    own = [f for f in docs.schema.fields if f.name != "text"]
    added = T.StructType.fromDDL(NODE + ", bits binary, bands array<long>")
    schema = T.StructType([*own, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, end in _rows(texts):
                hashes, ends = shingle_sets(texts.slice(start, end - start).to_pylist(), size)
                minima = signatures(hashes, ends)
                bands = band_keys(minima)
                offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * bands.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name).slice(start, end - start) for f in own] + [
                        pa.array(set_names(hashes, ends), pa.binary()), pa.array(np.diff(np.r_[0, ends]), pa.int64()),
                        pa.array([row.tobytes() for row in packed_bits(minima)], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                    ], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def full_sets(texts: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(node, shingles) of ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for start, end in _rows(column):
                hashes, ends = shingle_sets(column.slice(start, end - start).to_pylist(), size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(set_names(hashes, ends), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(hashes.view(np.int64))),
                ], ["node", "shingles"])

    return texts.select("text").mapInArrow(run, "node binary, shingles array<long>")


def _in_blocks(rows: DataFrame, group: str, sizes: DataFrame, weight: str) -> DataFrame:
    """Adds (block, square): groups of up to a block's members and ``weight`` are one square, larger ones several.

    A row of a large group goes to every square that its block is a side of; the square (i, j) compares block i with
    block j. ``sizes`` has (group, members, weight).
    """
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_NODES), F.ceil(F.col(weight) / BLOCK_SHINGLES)).cast("int")
    sized = rows.join(sizes.select(group, blocks.alias("_blocks")), group)
    block = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j")),
    )
    return sized.withColumn("block", block).withColumn("square", F.explode(others)).drop("_blocks")


def _forests(rows: DataFrame, group: str, threshold: int, exact: bool, tasks: int) -> DataFrame:
    """Spanning forests (larger, smaller) of the close pairs in each group's squares; exact ones are confirmed on sets.

    ``rows`` has the group, square, node and bits, and n_shingles and shingles when ``exact``.
    """
    least = least_estimate(threshold)
    columns = [group, "block", "square.i", "square.j", "node", "bits"] + (["shingles"] if exact else [])

    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        few, many = sorted((len(a), len(b)))
        if 100 * few < threshold * many:
            return False
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= threshold * (len(a) + len(b) - shared)

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pairs = []
        for (_, i, j), part in frame.groupby([group, "i", "j"], sort=False):
            if len(part) < 2:
                continue
            part = part.sort_values("block", kind="stable")
            nodes = part["node"].to_list()
            bits = np.frombuffer(b"".join(part["bits"]), np.uint8).reshape(len(nodes), -1)
            sets = part["shingles"].to_list() if exact else None
            forest = Forest(len(nodes))
            # A square on the diagonal compares a block with itself, any other one two blocks.
            n_left = int((part["block"] == i).sum())
            left, right = range(n_left), range(len(nodes)) if i == j else range(n_left, len(nodes))
            for a, b in close_pairs(bits, left, right, least, forest):
                if (not exact or similar(sets[a], sets[b])) and forest.join(a, b):
                    pairs.append((max(nodes[a], nodes[b]), min(nodes[a], nodes[b])))
        return pd.DataFrame(pairs, columns=["larger", "smaller"])

    # Squares of one group are tasks of their own; small groups share tasks by hash.
    task = F.pmod(F.xxhash64(group, "square"), F.lit(tasks))
    return rows.select(task.alias("task"), *columns).groupBy("task").applyInPandas(run, PAIR)


def link(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents with node and n_shingles, (node, component) of nodes that are linked with others).

    ``threshold`` is the percentage of shared shingles from which two texts are linked.
    """
    prints = written(fingerprints(docs.withColumn("text_key", F.xxhash64("text")), size), "dedup-prints")
    filled = prints.where("n_shingles > 0")
    # One row per node: the kept bits and bands are equal in all its texts; the text to read again is the smallest key's.
    nodes = filled.groupBy("node").agg(
        F.min("n_shingles").alias("n_shingles"), F.min("bits").alias("bits"), F.min("bands").alias("bands"), F.min("text_key").alias("text_key")
    )
    nodes = written(nodes, "dedup-nodes")

    # Candidates: nodes that share a bucket.
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").withColumn("weight", F.lit(0))
    shared = written(shared, "dedup-buckets")
    n_members = shared.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    spread = _in_blocks(nodes.select("node", "bits", F.explode("bands").alias("bucket")), "bucket", broadcast_if_small(shared), "weight")
    close = written(_forests(spread, "bucket", threshold, False, 1 + n_members // TASK_NODES).distinct(), "dedup-candidates")

    # Families: components of candidates, then exact confirmation.
    families = written(components(close).withColumnRenamed("profile_id", "family"), "dedup-families")
    members = nodes.select("node", "bits", "n_shingles", "text_key").join(broadcast_if_small(families), "node")
    members = written(members, "dedup-members")
    keys = broadcast_if_small(members.select("text_key").distinct())
    texts = docs.select("text", F.xxhash64("text").alias("text_key")).join(keys, "text_key", "left_semi")
    sets = full_sets(texts.groupBy("text_key").agg(F.first("text").alias("text")), size).groupBy("node").agg(F.first("shingles").alias("shingles"))
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("weight"))
    spread = _in_blocks(members.select("node", "bits", "family"), "family", sizes, "weight").join(sets, "node")
    n_members, weight = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    tasks = 1 + max(n_members // TASK_NODES, weight // BLOCK_SHINGLES)
    links = written(_forests(spread, "family", threshold, True, tasks).distinct(), "dedup-links")
    linked = written(components(links).withColumnRenamed("profile_id", "component"), "dedup-components")
    return prints, linked


def _names(prints: DataFrame, linked: DataFrame, name: Column) -> DataFrame:
    """(node, named): the smallest ``name`` in the node's component. Names meet per node first, so no large group is gathered."""
    per_node = prints.where("n_shingles > 0").groupBy("node").agg(F.min(name).alias("named"))
    per_node = written(per_node.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")), "dedup-named")
    least = per_node.groupBy("component").agg(F.min("named").alias("named"))
    return written(per_node.select("node", "component").join(least, "component").select("node", "named"), "dedup-ids")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text); the id that names a component is kept."""
    prints, linked = link(docs.select("doc_id", "text"), threshold, size)
    named = broadcast_if_small(_names(prints, linked, F.col("doc_id")).withColumnRenamed("named", "component_id"))
    filled = prints.where("n_shingles > 0").select("doc_id", "n_shingles", "node").join(named, "node", "left")
    empty = prints.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    both = filled.select("doc_id", "n_shingles", "component_id").unionByName(empty)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` (with doc_id, text) with one row of each group of near copies; rows without shingles all stay.

    The row with the smallest id stays; of rows with that id, or of rows that all have none, the first as read. Rows are
    numbered once, in a written copy, so their numbers hold when a task is run again.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "dedup-rows")
    prints, linked = link(rows.select("doc_id", "_row", "text"), threshold, size)
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
    stays = _names(prints, linked, name).select(F.col("named._row").alias("_row")).distinct()
    goes = prints.where("n_shingles > 0").select("_row").join(stays, "_row", "left_anti")
    # What goes is the shorter list.
    return rows.join(broadcast_if_small(written(goes, "dedup-goes")), "_row", "left_anti").drop("_row")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of at least 85 percent shared shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=85)
