"""Nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables: every query and stage."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from beaconlake.llm import decontamination, html_regions, licenses, near_dedup, ranking_classifier, suffix_rules, warc_zip

NAMES = sorted(n for n in entry.queries() if n == "pipeline" or n[:2] == "op" and n[2].isdigit())
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, items string, node int"
PAGES = "page_id long, url string, html string, host string, text_key string"
BENCHMARK = "item_id long, text string, window string"
LABELS = "doc_id long, quality int, toxic int, score double"
EMBEDDINGS = "vec_id long, embedding array<float>, label int, cluster string, point int"
CONVERSATIONS = "conv_id long, turn long, role string, text string, key string, depth int"


def prose(seed, n):
    random_ = random.Random(seed)
    return " ".join("".join(random_.choices("abcdefghij", k=5)) for _ in range(n))


LONG = prose(1, 30_000)


def write(spark, path, documents, pages, benchmark, labels, embeddings, conversations):
    for name, rows, schema in (
        ("documents", documents, DOCS), ("pages", pages, PAGES), ("benchmark", benchmark, BENCHMARK), ("labels", labels, LABELS),
        ("embeddings", embeddings, EMBEDDINGS), ("conversations", conversations, CONVERSATIONS),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def doc(doc_id, text, source="s"):
    return doc_id, text, "en", source, None, "kept?", "score?", "items?", 1


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    item = prose(2, 20)
    documents = [
        doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, LONG), doc(5, prose(3, 50)), doc(5, prose(3, 50)), doc(None, prose(3, 50)),
        doc(None, None), doc(None, prose(4, 40), None), doc(6, prose(5, 30) + " " + item), doc(7, "one"), doc(8, "one"), doc(9, "ONE two"),
        doc(10, "!! ## $$"), doc(11, "\U0001f600 café ÉA"), doc(5, prose(6, 50), None), doc(12, "This " * 400),
    ]
    pages = [
        (1, None, None, "h", "k"), (2, "no scheme", "", "h", "k"), (3, "http://A.Example.NET/en/5?q", "<p>x", None, None), (None, "http://x.org", "<p>x", "", ""),
        (4, "http://a.example.com/de/6#f", "<article><p>" + LONG + "</p></article>", "h", "k"), (4, "http://a.example.com/de/6#f", "<p>x", "h", "k"),
        (5, "://", "<!-- open", "h", "k"), (6, "http://h/fr/7.html", "<div class='ad'>a</div><a b='", "h", "k"),
    ]
    benchmark = [(1, None, "w"), (2, "", "w"), (3, item, "w"), (4, item, "w"), (None, item, "w"), (5, "one", "w")]
    labels = [(None, 1, 0, 0.0), (5, None, 0, 0.0), (5, 1, 0, 0.0), (5, 0, 0, 0.0), (6, 1, 0, 0.0), (4, 1, 0, 0.0), (12, 0, 0, 0.0), (99, 0, None, 0.0)]
    def vector(vec_id, *values, size=64):
        return vec_id, [*values, *[0.0] * (size - len(values))], 0, "cluster?", 1

    embeddings = [
        vector(1), vector(1), vector(2, -0.001), vector(3, 1e30, -1e30), vector(None, 2.5), vector(None, 2.5), vector(4, size=63),
        vector(5, size=65), vector(6, float("nan")), vector(7, float("inf")), vector(8, None), (9, None, 0, "", 0), (10, [], 0, "", 0),
    ]
    # The first turns of a conversation are those of the one whose id is a multiple of five below it.
    conversations = [
        (5, 1, "user", "a", "key?", 7), (5, None, "user", "first", "key?", 7), (5, 2, None, None, "key?", 7), (5, 2, "", "", "key?", 7),
        (6, 1, "user", "b", "key?", 7), (-7, 1, "user", LONG, "key?", 7), (None, 1, "user", "lost", "key?", 7), (11, 0, "user", "c", "key?", 7),
    ]
    return write(spark, tmp_path_factory.mktemp("odd"), documents, pages, benchmark, labels, embeddings, conversations)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [], [], [], [])


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    rows = entry.queries()[name](spark, odd).collect()
    if name not in ("pipeline", "op13_prefix_trie"):
        assert len(rows) == {"op5_html_regions": 8, "op7_warc_zip": 8, "op10_url_filters": 8, "op11_centroids": 6}.get(name, 17)
    if name == "op11_centroids":
        # As many centroids as vectors, so each is its own or an equal one's.
        assert sorted((r.vec_id, r.distance) for r in rows if r.vec_id) == [(1, 0), (1, 0), (2, 0), (3, 0)]
        assert len({r.cluster for r in rows if r.vec_id in (1, 2)}) == 2 and {r.inertia for r in rows} == {0}
    if name == "op12_secret_scan":
        assert {(r.n_assign, r.n_access, r.n_hex, r.spans) for r in rows} == {(0, 0, 0, "")}
    if name == "op13_prefix_trie":
        # Conversation 5 is its own base; 6 keeps its turns after as many as it takes; 11 and -7 have no base.
        root = [r for r in rows if r.depth == 0]
        assert len(root) == 1 and (root[0].conv_id, root[0].parent_conv_id, root[0].n_convs) == (-7, None, 4)
        assert {r.depth for r in rows if r.conv_id == 5} == {1, 2, 3, 4}
    if name == "op2_suffix_rules":
        by_id = {r.doc_id: r for r in rows}
        assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0 and not by_id[1].kept
        assert by_id[4].kept and by_id[4].n_words == 30_000
        assert by_id[12].base_failed and by_id[12].longest_repeat == 399
    if name == "op6_decontamination":
        by_id = {r.doc_id: r for r in rows}
        assert (by_id[6].n_words, by_id[6].n_hit, by_id[6].n_items, by_id[6].contaminated) == (50, 20, 3, True)
        assert (by_id[7].n_hit, by_id[7].n_items) == (1, 1) and by_id[9].n_hit == 1
    if name == "op7_warc_zip":
        found = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str)
        assert (1, 0, "response", None) in found and (2, 0, "revisit", 1) in found
        assert (3, 4, "response", None) in found and (4, 4, "revisit", 3) in found and (None, 4, "revisit", 3) in found
    if name == "op8_near_dedup":
        copies = [(r.doc_id, r.component_id, r.kept) for r in rows if r.n_shingles == 46]
        assert sorted(copies, key=str) == sorted([(5, 5, True)] * 3 + [(6, 6, True), (None, 5, False)], key=str)
        assert {r.doc_id: r.component_id for r in rows}[8] == 7
        assert {(r.doc_id, r.component_id) for r in rows if r.n_shingles == 0} >= {(1, 1), (2, 2), (3, 3), (None, None)}
    if name == "op10_url_filters":
        by_id = {r.page_id: r for r in rows}
        assert (by_id[1].host, by_id[1].path, by_id[1].rule) == ("", "", None)
        assert (by_id[3].host, by_id[3].rule, by_id[3].verdict) == ("a.example.net", "example.net/en/", "allow")
        assert (by_id[4].rule, by_id[4].verdict) == ("example.com/de/", "block") and by_id[None].path == ""


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert entry.queries()[name](spark, empty).count() == 0


def test_stages_keep_the_columns_and_whole_groups(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, odd).columns == list(corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.near_duplicates(spark, docs, odd)
    assert sorted(str(r.doc_id) for r in kept.collect() if r.text == prose(3, 50)) == ["5"]
    assert kept.where("text is null or trim(text) = ''").count() == 3


def test_a_family_whose_copies_differ_more_and_more(spark):
    """Blocks of a large bucket and of a large family, against all pairs."""
    random_ = random.Random(8)
    base = prose(9, 150).split()
    texts = []
    for i in range(120):
        words = list(base)
        for at in random_.sample(range(150), i % 12):
            words[at] = f"w{i}x{at}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[k:k + 5]) for k in range(146)} for t in texts]
    parent = list(range(120))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    saved = near_dedup.BLOCK_NODES
    near_dedup.BLOCK_NODES = 16
    try:
        found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows, 85).collect()}
    finally:
        near_dedup.BLOCK_NODES = saved
    assert found == {i: find(i) for i in range(120)}


def test_zip64_and_ranges():
    members = [("a", b"x" * 10), (warc_zip.WARC_MEMBER, b"0123456789"), ("empty", b"")]
    for wide in (False, True):
        reader = warc_zip.ZipReader(warc_zip.Bytes(warc_zip.zip_stored(members, wide)))
        assert {n: reader.read(n) for n in reader.members} == dict(members)
        assert reader.read(warc_zip.WARC_MEMBER, 3, 4) == b"3456"
    import io
    import zipfile

    with zipfile.ZipFile(io.BytesIO(warc_zip.zip_stored(members, True))) as archive:
        assert archive.testzip() is None and archive.read("a") == b"x" * 10
    with pytest.raises(ValueError):
        warc_zip.ZipReader(warc_zip.Bytes(b"not an archive"))


def test_page_parts():
    weights = {"text": 1.0, "": -0.5, "p": -0.01}
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><nav><a>Home</a></nav><div class='cookie-notice'>We use</div>"
        "<main><h1>Big  &amp; small</h1><p>First<br>line <b>bold</b><p>Second<aside>Side</aside><form>Mail</form><script>var x='<p>no</p>'</script>"
        "<div id=comments><p>Nice post</p></div><p>Third</main><footer>Foot</footer>"
    )
    assert html_regions.extract(page, weights) == "Big & small\nFirst line bold\nSecond\nThird"
    assert html_regions.extract(None, weights) == html_regions.extract("<nav>only</nav>", weights) == ""


def test_helpers_on_nothing(spark):
    assert suffix_rules.judge([])["kept"].tolist() == []
    assert near_dedup.shingle_sets([None, "", "a"])[1].tolist() == [0, 0, 1]
    model = ranking_classifier.fit(ranking_classifier.np.zeros((0, 13)), ranking_classifier.np.zeros(0))
    assert model.score(ranking_classifier.np.zeros((2, 13))).tolist() == [0.5, 0.5]
    with pytest.raises(ValueError):
        licenses.scan_licenses(spark.range(1).selectExpr("cast(id as string) as text"), min_dice=0)
    assert decontamination.contamination(
        spark.range(1).selectExpr("'a b' as text", "id as n_hit"), spark.createDataFrame([], "item_id long, text string")
    ).first().n_hit == 0
