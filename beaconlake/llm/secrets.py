"""Secret scans through a ledger of blobs: every distinct text is scanned once per version of a rule.

A history has a row per path and version with its text. The SHA-256 of a text is its blob's name, so copies of a text,
under other paths or in later versions, are one blob. The ledger is a folder with a part per run; a part has a row per
blob it scanned with the rule versions used and what they found. A run reads the names only, leaves out the pairs of blob
and rule version that the ledger knows, scans the text of one owner (path and version) of every blob left, adds a part,
and joins the ledger's findings back to all paths. A rule's version is a digest of its definition: a changed rule is a new
pair for every blob, an unchanged one is never run twice on a text.

Only DataFrame functions are used. A text's matches come from ``regexp_extract_all`` and the pieces between them from
``split``; the running sum of both lengths in a window per blob and rule gives their places in code points. Patterns have
no unbounded part that a failing match would read again from every start, so a long text takes time in proportion.

Large groups: names meet in aggregations, which combine first. Texts move only to find the owners among them, and not at
all while the list of owners is small enough to broadcast. Findings go to their paths by broadcast, or beyond that limit
by a join that leaves the rows of blobs with very many paths where they are.

Defined cases: a null text is empty; an empty text has no findings. Null paths and versions are values like others.
Repeated rows each get their findings and are one blob. Other columns of the history are not read. An empty history gives
no rows and adds nothing to the ledger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from beaconlake.llm.common import is_small, table, written
from beaconlake.operators.skew import heavy_keys, lookup_join
from beaconlake.session import run_path

FOUND = "array<struct<rule:string,version:string,start:int,end:int>>"
LEDGER = f"blob binary, versions array<string>, found {FOUND}"

#: Rows of one blob that may meet in one task.
MAX_COPIES = 100_000


class Rule(NamedTuple):
    """A kind of secret: a pattern, literal texts of which one must occur (none: always tried), and a least length of a
    group of the pattern (0: the whole match). Matches that are too short are dropped after matching."""

    name: str
    pattern: str
    needles: tuple[str, ...] = ()
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        definition = "\0".join([self.name, self.pattern, str(self.group), str(self.least)])
        return hashlib.sha256(definition.encode()).hexdigest()[:16]


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(word) for word in ("password", "passwd", "secret", "token", "api_?key"))

#: Rules of the contract. Runs of characters are greedy, so a least length inside the pattern finds the same matches as
#: one that is tested afterwards; the value of an assignment may hold another assignment, so its length is tested.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", (), 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", ("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)

#: Forms of keys and tokens as their issuers document them.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", ("PRIVATE KEY-----",)),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", ("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}", ("AIza",)),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", ("k_live_",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,512}\.eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}", ("eyJ",)),
    Rule("url", r"://[^\x00-\x20/:@]{1,256}:[^\x00-\x20/@]{1,256}@", ("://",)),
)
RULES = BASE + MORE


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def entries(history: DataFrame) -> DataFrame:
    """(path, version, blob) of every row of a history (path, version, text)."""
    return history.select("path", "version", _blob(F.col("text")).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(named: DataFrame, known: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, path, version, todo): an owner of every blob with rule versions that ``known`` has not tried on it.

    ``todo`` has a bit per rule: the list is what a broadcast carries, so its rows are small.
    """
    seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("versions"))).alias("seen"))
    owners = named.groupBy("blob").agg(F.min(F.struct("path", "version")).alias("owner"))
    seen_before = F.coalesce("seen", F.array().cast("array<string>"))
    bits = [
        F.when(F.array_contains(seen_before, rule.version), F.lit(0)).otherwise(F.lit(1 << no)).cast("bigint")
        for no, rule in enumerate(rules)
    ]
    todo = reduce(lambda a, b: a + b, bits)
    return owners.join(seen, "blob", "left").select("blob", "owner.*", todo.alias("todo")).where("todo > 0")


def _to_try(no: int) -> Column:
    return F.getbit("todo", F.lit(no)) == 1


def scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rule, version, start, end) of the matches in ``texts`` (blob, text, todo), in code points, end exclusive."""

    def found(no: int, rule: Rule) -> Column:
        tried = _to_try(no)
        if rule.needles:
            tried = tried & F.greatest(*[F.contains("text", F.lit(needle)) for needle in rule.needles], F.lit(False))
        return F.struct(
            F.lit(no).alias("no"), F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"),
            F.when(tried, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias("texts"),
        )

    # Texts go on only with the rules that matched, so few are split.
    hits = F.filter(F.array(*[found(no, rule) for no, rule in enumerate(rules)]), lambda hit: F.size(hit["texts"]) > 0)
    hit = texts.select("blob", "text", F.inline(hits))

    def per_rule(value) -> Column:
        cases = F.when(F.col("no") == 0, value(rules[0]))
        for no, rule in enumerate(rules[1:], 1):
            cases = cases.when(F.col("no") == no, value(rule))
        return cases

    gaps = F.transform(per_rule(lambda rule: F.split("text", rule.pattern, -1)), F.char_length)
    # One gap more than matches: the text's end.
    pairs = F.arrays_zip(F.col("texts").alias("match"), gaps.alias("gap"))
    each = hit.select("blob", "no", "rule", "version", F.posexplode(pairs).alias("i", "pair")).where("pair.match is not null")
    long_enough = per_rule(
        lambda rule: F.char_length(F.regexp_extract("pair.match", rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
    )
    # An owner that stands in the history twice is scanned twice; its matches are one.
    once = each.select(
        "blob", "rule", "version", "i", F.col("pair.gap").alias("gap"), F.char_length("pair.match").alias("length"),
        long_enough.alias("kept"),
    ).groupBy("blob", "rule", "version", "i").agg(
        F.min("gap").alias("gap"), F.min("length").alias("length"), F.min("kept").alias("kept")
    )
    up_to_here = Window.partitionBy("blob", "rule", "version").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(up_to_here).cast("int"))
    return placed.where("kept").select("blob", "rule", "version", (F.col("end") - F.col("length")).alias("start"), "end")


def update_ledger(history: DataFrame, named: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger at path ``ledger`` does not know of a history, and add it. ``named`` are its entries."""
    todo = written(unseen(named, read_ledger(history.sparkSession, ledger), rules), "secrets-todo")
    keys = ["blob", "path", "version"]
    small = is_small(todo)
    heavy = None if small else heavy_keys(named, keys, MAX_COPIES)
    owned = _looked_up(
        history.select("path", "version", F.coalesce("text", F.lit("")).alias("text"), _blob(F.col("text")).alias("blob")),
        todo, keys, "inner", small, heavy,
    )
    spans = scan(owned.select("blob", "text", "todo"), rules)
    found = spans.groupBy("blob").agg(F.collect_list(F.struct("rule", "version", "start", "end")).alias("found"))
    versions = F.array_compact(F.array(*[F.when(_to_try(no), F.lit(rule.version)) for no, rule in enumerate(rules)]))
    part = todo.join(found, "blob", "left").select(
        "blob", versions.alias("versions"), F.coalesce("found", F.array().cast(FOUND)).alias("found")
    )
    part.write.mode("append").parquet(ledger)


def _looked_up(big: DataFrame, small: DataFrame, keys: list[str], how: str, fits: bool, heavy: DataFrame | None) -> DataFrame:
    """``big`` joined with a lookup of one row per key: by broadcast if it ``fits``, else with heavy keys kept in place."""
    if not fits:
        return lookup_join(big, small, keys, how, True, MAX_COPIES, heavy, False)
    lookup = F.broadcast(small.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in small.columns]))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return big.join(lookup, same, how).drop(*[f"_{key}" for key in keys])


def scan_history(history: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(path, version, blob, spans) per row of ``history`` (path, version, text), after bringing the ledger up to date.

    ``spans`` has a struct (start, no, rule, end) per match, sorted; ``no`` is the rule's place in ``rules``.
    """
    named = written(entries(history), "secrets-entries")
    update_ledger(history, named, ledger, rules)
    order = F.create_map(*[part for no, rule in enumerate(rules) for part in (F.lit(rule.version), F.lit(no))])
    known = read_ledger(history.sparkSession, ledger).where(F.size("found") > 0).select("blob", F.inline("found"))
    current = known.where(F.col("version").isin([rule.version for rule in rules])).withColumn("no", order[F.col("version")])
    # Two runs at a time may both have scanned a blob.
    spans = current.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", "no", "rule", "end"))).alias("spans"))
    spans = written(spans, "secrets-spans")
    small = is_small(spans)
    heavy = None if small else heavy_keys(named, ["blob"], MAX_COPIES)
    joined = _looked_up(named, spans, ["blob"], "left", small, heavy)
    nothing = F.array().cast(spans.schema["spans"].dataType)
    return joined.withColumn("spans", F.coalesce("spans", nothing))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and places of the secrets in every document; a document is a path with one version."""
    documents = table(spark, sf_dir, "documents")
    history = documents.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text")
    scanned = scan_history(history, run_path(spark, "secrets-ledger"))

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("bigint").alias(f"n_{name}")

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["no"] < len(BASE))
    return scanned.select(
        F.col("path").alias("doc_id"), *[count(rule.name) for rule in BASE],
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
