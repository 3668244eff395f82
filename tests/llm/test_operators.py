"""Small tests of the corpus operators: edge cases and brute force."""

import itertools
import zlib

import numpy as np
import pytest

from martkit.llm import bagminhash, digest_index, license_scan, line_runs, mixing, phrase_index, token_count, token_store, warc_derive

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, size string"
LONG = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn"


def docs(spark, *texts):
    rows = [(i, t, "en", None if i % 3 == 0 else f"s{i % 3}", 0, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_empty_tables(spark, tokenizer):
    none = docs(spark, "x").limit(0)
    assert digest_index.exact_dedup(spark, none).count() == 0
    assert mixing.mix(spark, none).count() == 0
    assert phrase_index.decontaminate(spark, none, spark.createDataFrame([(1, "a b")], "item_id int, text string")).count() == 0
    assert line_runs.dedup_lines(spark, none).count() == 0
    assert token_store.tokens_of(spark, none, tokenizer).count() == 0
    assert bagminhash.near_duplicates(spark, none).count() == 0


def test_exact_dedup_keeps_the_longest_then_the_smallest(spark):
    out = {r.doc_id: r for r in digest_index.exact_dedup(spark, docs(spark, "a b", "ab", "a  b", None, "", "c"), 3).collect()}
    assert [out[i].keep_id for i in range(6)] == [2, 2, 2, 3, 3, 5] and out[0].group_size == 3
    assert sorted(i for i in out if out[i].kept) == [2, 3, 5]


def test_mixing_ranks_no_whole_source(spark, monkeypatch):
    ranked, cut = [], mixing._cut
    monkeypatch.setattr(mixing, "_cut", lambda rows, left: ranked.append(rows) or cut(rows, left))
    one = spark.createDataFrame([(i, "a b", "s") for i in range(50)], "doc_id bigint, text string, source string")
    assert {r.copies for r in mixing.mix(spark, one).collect()} == {1} and ranked[0].count() == 0
    # equal rows (null ids) are cut as one row with a count: 3 rows of 2 words fit in 7
    equal = spark.createDataFrame(
        [(None, "s", 2, 0.5, 7.0, 0)] * 40, "doc_id bigint, source string, size bigint, rank01 double, left double, serial int")
    out = cut(equal, "left")
    assert sorted(r.within for r in out.collect()) == [False] * 37 + [True] * 3
    last = out._jdf.queryExecution().optimizedPlan().toString().split("Window [")
    assert any("count(1)" in x for x in last[1:]) and out.count() == 40


@pytest.mark.parametrize("copies", [1, 2])
def test_mixing_closes_with_one_row_of_equal_ones(spark, copies):
    ids = [None] * 400 if copies == 1 else [i // 2 for i in range(400)]
    rows = [(i, "a b c", "s") for i in ids] + [(900, "w " * 340, "t")]
    out = mixing.mix(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)).collect()
    assert len(out) == 401 and {r.target for r in out if r.source == "s"} == {1100.0}
    assert sum(r.taken for r in out if r.source == "s") == 1101


def test_windows_of_an_item_without_id_are_hit(spark):
    item = " ".join(f"w{k}" for k in range(13))
    texts = docs(spark, f"x {item} y", item, "nothing of it", None, item + " " + "z " * 260)
    items = spark.createDataFrame(
        [(None, item), (None, item), (7, None), (8, "of it"), (8, "of it")], "item_id int, text string")
    out = {r.doc_id: r for r in phrase_index.decontaminate(spark, texts, items).collect()}
    assert [out[i].n_hit for i in range(5)] == [13, 13, 2, 0, 13] and [out[i]["items"] for i in range(4)] == [[], [], ["8"], []]
    # a twentieth of the words, and less
    assert [out[i].contaminated for i in range(5)] == [True, True, True, False, False]
    parts = phrase_index.search(spark, phrase_index.build_index(spark, texts), phrase_index.item_windows(items), block_windows=1)
    assert sorted(len(r.starts) for r in parts.collect()) == [1, 1, 1, 1]


def test_near_duplicates_with_null_and_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in "abc")
    rows = [(None, a), (None, a), (None, a + " end"), (1, b), (1, c), (2, b + " end"), (3, c + " end"), (9, "own words"), (None, None), (9, "own words")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = sorted(((r.doc_id, r.class_id, r.kept) for r in bagminhash.near_duplicates(spark, frame).collect()), key=str)
    named = [x for x in out if x[0] is not None]
    assert named == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (9, 9, True), (9, 9, True)]
    assert [x[1] for x in out if x[0] is None] == [None] * 4 and sum(x[2] for x in out if x[0] is None) in (2, 3)


def test_near_dedup_stage_keeps_one_row_of_each_class(spark, scratch):
    import corpus_pipeline

    a, b = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    rows = [(None, a, "p"), (None, a, "p"), (None, a + " end", "p"), (5, b, "p"), (5, b, "q"), (6, b + " end", "p"), (7, "alone", "p")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, t0 string")
    out = corpus_pipeline.near_dedup(spark, frame, scratch)
    assert out.columns == frame.columns
    assert sorted((str(r.doc_id), (r.text or "").split()[0]) for r in out.collect()) == [("5", "b0"), ("7", "alone"), ("None", "a0")]


def test_digest_index_reopens_with_its_own_buckets(spark, scratch):
    rows = digest_index.text_digests(docs(spark, *[f"text {i}" for i in range(300)]))
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("8", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            index = digest_index.DigestIndex(spark, scratch)
            index.add(rows)
            assert index.buckets == 8 and index.entries().count() == 300 and index.decide(rows).count() == 300
            spark.sql(f"DROP TABLE {index.name}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    with pytest.raises(ValueError, match="8 buckets"):
        digest_index.DigestIndex(spark, scratch, 4)


def test_line_runs_compact_and_count(spark):
    texts = [f"{LONG}\nown {i}" for i in range(7)] + [None, ""]
    out = {r.doc_id: r for r in line_runs.dedup_lines(spark, docs(spark, *texts)).collect()}
    assert [out[i].n_dropped for i in range(9)] == [1] * 6 + [0] * 3 and out[7].n_lines == 1
    assert out[6].kept_text == texts[6] and out[0].kept_text == "own 0"


def test_lines_of_null_and_repeated_ids(spark):
    rows = [(None, LONG)] * 3 + [(7, LONG)] * 6 + [(i, LONG + f"\nown {i}") for i in range(3)] + [(8, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    four = line_runs.dedup_lines(spark, frame, min_docs=4).collect()  # ids 0, 1, 2 and 7
    assert sorted((str(r.doc_id), r.n_dropped) for r in four) == (
        [("0", 1), ("1", 1), ("2", 1)] + [("7", 0)] * 6 + [("8", 0)] * 2 + [("None", 1)] * 3)
    assert sum(r.n_dropped for r in line_runs.dedup_lines(spark, frame, min_docs=5).collect()) == 0


@pytest.mark.parametrize("keep_held", [False, True])
def test_the_anti_join_decides_what_a_run_holds(spark, monkeypatch, keep_held):
    if keep_held:  # without the anti-join lines lie in several runs and are counted again
        monkeypatch.setattr(line_runs.LineRuns, "_unheld", lambda self, batch, tables: batch)
    texts = [f"{LONG}\nown {i}" for i in range(40)]
    out = line_runs.dedup_lines(spark, docs(spark, *texts), min_docs=41).collect()
    assert sum(r.n_dropped for r in out) == (39 if keep_held else 0)


def test_runs_are_compacted_and_add_up(spark, scratch):
    runs = line_runs.LineRuns(spark, scratch, fan_out=3, buckets=4)
    want = {}
    for k in range(8):
        pairs = [(100 * k + i, bytes([j])) for i in range(5) for j in range(i + k)]
        for i, key in pairs:
            want.setdefault(key, set()).add(i)
        runs.add(spark.createDataFrame(pairs, "doc_id bigint, key binary"))
    got = {bytes(r.key): (r.n_docs, r.holder) for r in runs.totals().collect()}
    assert got == {k: (len(v), max(v)) for k, v in want.items()} and runs.totals().count() == len(want)
    assert [len(x) for x in runs.levels] == [2, 2]
    runs.close()


def test_token_store_round_trip_and_counts(spark, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    texts = ["Hello <|endoftext|> don't", None, "", "日本 ½ _x", LONG * 40, LONG]
    df = docs(spark, *texts)
    stored = {r.doc_id: r for r in token_store.tokens_of(spark, df, tokenizer).collect()}
    counted = {r.doc_id: r.n_tokens for r in token_count.count_tokens(spark, df, tokenizer).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert counted[i] == len(ids) and stored[i].n_tokens == len(ids) + 1 and stored[i].start == start
        assert stored[i].ids_crc32 == zlib.crc32(np.array([*ids, 1], "<u4").tobytes())
        start += len(ids) + 1


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for n in range(60):
        w = list(base)
        for k in rng.integers(0, len(w), n % 7):
            w[k] = f"x{n}_{k}"
        texts.append(" ".join(w))
    texts += [texts[0], None, "", "a b", "a b", "!!"]
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark, docs(spark, *texts)).collect()}
    bags = [bagminhash.shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if bagminhash.overlap(bags[a], bags[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert [got[i] for i in range(len(texts))] == [find(i) for i in range(len(texts))]


def test_signature_agreement_is_the_weighted_similarity():
    a = (np.arange(1, 40, dtype=np.uint64) * 7919, np.array([1, 2, 5] * 13))
    b = (np.arange(1, 40, dtype=np.uint64) * 7919, np.array([1, 3, 2] * 13))
    same = np.mean(bagminhash.signature(*a, 2000) == bagminhash.signature(*b, 2000))
    assert abs(same - bagminhash.overlap(a, b)) < 0.05


def test_proximity_needs_slop(spark):
    index = phrase_index.build_index(spark, docs(spark, "red big apple pie", "red apple pie"))
    phrase = spark.createDataFrame([(1, [b"red", b"apple"])], "query bigint, words array<binary>")
    found = [phrase_index.search(spark, index, phrase, slop).select("segment", "place").count() for slop in (0, 1)]
    assert found == [1, 2]


def test_license_scan_finds_each_notice():
    known = [license_scan.Template(k, v, 0.8) for k, v in license_scan.TEMPLATES.items()]
    text = f"{LONG}\nReleased under the MIT License.\n{LONG}\nLicensed under CC BY-NC 4.0."
    assert [f[0] for f in license_scan.scan(text * 2, known)] == ["MIT", "CC-BY-NC-4.0"] * 2
    assert license_scan.scan(None, known) == [] and license_scan.scan(LONG * 50, known) == []


def test_warc_round_trip():
    headers, block = warc_derive.response(1, "http://a/b", "<title>T</title><p>x &amp; y<script>z</script>")
    made = list(warc_derive.derive(headers, block))
    back = list(warc_derive.unpack(b"".join(warc_derive.pack(h, d) for _, h, d in made)))
    assert back == [(h, d) for _, h, d in made] and b"x & y" in back[1][1] and b"z" not in back[1][1]
    assert {dict(h)["WARC-Refers-To"] for h, _ in back} == {dict(headers)["WARC-Record-ID"]}


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body><p>kept words</p></body></html>", "kept words"),
    ("<head><meta charset=utf-8><title>T</title><style>s</style><p>kept</p><script>z</script> more", "kept\nmore"),
    ("<html><head><!-- c --><title>T</title>\n</head><body>kept", "kept"),
    ("<head><title>T</title>plain words <b>kept</b>", "plain words kept"),
    ("<p>a<svg width='1'/>b</p><svg><text>no</text></svg>c", "a b\nc"),
    ("<p>a<svg>b</p><noscript>c <template>d", "a b\nc d"),
    ("<header>kept</header><p>a<script>b</p>", "kept\na"), ("a<style>b", "a"), ("a<!-- b", "a"), ("", ""),
])
def test_plain_text_keeps_what_an_open_head_or_svg_does_not_hold(page, text):
    assert warc_derive.plain_text(page) == text


def test_warc_reader_takes_records_longer_than_its_reads_and_refuses_cut_files():
    noise = np.random.default_rng(3).integers(0, 256, 3 * warc_derive.READ_BYTES, np.uint8).tobytes()
    made = [([("WARC-Type", "conversion"), ("Content-Length", str(len(d)))], d) for d in (b"", noise, b"x", noise[:100])]
    data = b"".join(warc_derive.pack(h, d) for h, d in made)
    assert list(warc_derive.unpack(data)) == made and list(warc_derive.unpack(b"")) == []
    with pytest.raises(ValueError):
        list(warc_derive.unpack(data[:-20]))


@pytest.mark.parametrize("links", [
    [], [(2, 1)], [(k + 1, k) for k in range(40)], [(99, k) for k in range(30)] + [(99, 98), (7, 3)],
    [((k * 37) % 101, (k * 53 + 11) % 101) for k in range(70)]])
def test_components_label_every_id_with_the_smallest(spark, links):
    links = sorted({(max(a, b), min(a, b)) for a, b in links if a != b})
    want = {x: x for pair in links for x in pair}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    found = bagminhash.components(spark, spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r["id"]: r["label"] for r in found.collect()} == want
