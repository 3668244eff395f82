"""Global BPE against the tokenizer library; the filter audit against brute force."""

import itertools
import random
import re

import numpy as np
import public_tokenizers as known
import pytest

from martkit.llm import global_bpe, term_matrix, wordblocks

COLUMNS = "doc_id bigint, text string, lang string, source string, block string, word string, ids string, code string, fails string, n string"
PATH = known.path("byte_bpe_50k.tiktoken")
ODD = "aé 1½ \n\t\x1c\x85\xa0'slvertdm_-.!日Ж ٠AZ#ǅ ﻿👍"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "b", "w", "i", "c", "f", "n") for i, t, lang in rows], COLUMNS)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=known.PATTERN, mergeable_ranks=global_bpe.load_ranks(PATH), special_tokens={})


@pytest.fixture(params=[term_matrix.BLOCK_BYTES, 50])
def block_bytes(request, monkeypatch):
    """One block per task, and many."""
    monkeypatch.setattr(term_matrix, "BLOCK_BYTES", request.param)


def odd_texts(n):
    r = random.Random(3)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(n)]


# ------------------------------------------------------------------------- encoding


def test_pre_tokens_and_merges_equal_the_library(library):
    split, ranks = global_bpe.PreTokens(known.PATTERN), global_bpe.load_ranks(PATH)
    texts = odd_texts(3000) + ["", "don't we'll I'M", "a" * 3000, "ab" * 700, " " * 500 + "x", "<|endoftext|>", "x\n\n  y"]
    texts += [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in itertools.chain(range(0x3000), range(0xF900, 0x10000), range(0x1F000, 0x1F700))]
    for t in texts:
        assert [i for w in split.of(t) for i in global_bpe.merge(w.encode(), ranks)] == library.encode_ordinary(t), t


def test_both_ways_of_merging_agree():
    ranks, r = global_bpe.load_ranks(PATH), random.Random(1)
    for _ in range(300):
        word = bytes(r.choice(b" etaoinshr\xc3\xa9") for _ in range(r.randint(2, 60)))
        assert global_bpe._merge_short(word, ranks) == global_bpe._merge_long(word, ranks)


def test_tokens_of_a_table(spark, library, monkeypatch):
    rows = [(i, t, "en") for i, t in enumerate(odd_texts(60))]
    rows += [(100, None, None), (101, "", ""), (None, "the cat", "x"), (102, "the " * 30_000, "en"), (103, "a" * 40_000, "en")]
    rows += [(3, rows[3][1], "en")] * 5 + [(3, "another text", "en")]
    for size in (global_bpe.BLOCK_BYTES, 50):
        monkeypatch.setattr(global_bpe, "BLOCK_BYTES", size)
        tokens = global_bpe.encode(spark, docs(spark, rows).repartition(3), PATH, known.PATTERN)
        got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in global_bpe.decode(spark, tokens, global_bpe.token_table(spark, PATH)).collect())
        want = sorted((str(i), np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows)
        assert got == want


def test_empty_table_has_no_tokens(spark):
    tokens = global_bpe.encode(spark, docs(spark, [(1, "x", "")]).limit(0), PATH, known.PATTERN)
    assert global_bpe.decode(spark, tokens, global_bpe.token_table(spark, PATH)).count() == 0


@pytest.mark.parametrize("bound", [global_bpe.TABLE_BYTES, 0])
def test_decoding_by_broadcast_and_by_shuffle(spark, bound):
    table = global_bpe.token_table(spark, PATH)
    ids = lambda *x: np.array(x, "<u4").tobytes()
    rows = [(1, ids(31373, 995), "kept"), (1, ids(31373, 995), "kept"), (None, ids(), "x"), (2, None, None), (3, ids(*[262] * 3000), "y")]
    tokens = spark.createDataFrame(rows, "doc_id bigint, ids binary, at string")
    got = sorted((str(r.doc_id), r["at"] or "", None if r.decoded is None else bytes(r.decoded)) for r in global_bpe.decode(spark, tokens, table, bound).collect())
    assert got == [("1", "kept", b"hello world")] * 2 + [("2", "", None), ("3", "y", b" the" * 3000), ("None", "x", b"")]
    bad = spark.createDataFrame([(1, ids(50256))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="not in the token-byte table"):
        global_bpe.decode(spark, bad, table, bound).collect()


# ------------------------------------------------------------------------ filter audit


def fails_of(rows):
    """Failed filters of each row, from the definition."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        upper = sum("A" <= c <= "Z" for c in text)
        copied = any(i is not None and doc_id is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text),
            any(c in "#$%&*|" for c in text), copied)) if bad))
    return out


def audit_of(rows, labels):
    """Expected rows by walking every document through every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = fails_of(rows)
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        removed_of = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                left = [(i, f) for i, f in mine if not before & set(f)]
                hit = [(i, f) for i, f in left if letter in f]
                removed_of[letter] += len(hit)
                out[part, "".join(order), step] = [
                    len(left) - len(hit), len(hit), sum(letter in f for _, f in mine) - len(hit),
                    sum(f == letter for _, f in mine), sum(i in good for i, _ in hit), sum(i in toxic for i, _ in hit)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_of[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def corpus():
    r = random.Random(9)
    words = [f"w{k}" for k in range(400)] + ["Żó", "\x1c", "a\x85b", "é"]
    texts = [" ".join(r.choice(words[:r.choice([20, 400])]) for _ in range(r.choice([3, 199, 200, 260]))) for _ in range(60)]
    texts = [t + r.choice(["", " # ", " ABCDEFGHIJKLMNOPQRSTUVW" * 4, "\n|\tX"]) for t in texts]
    rows = [(i, t, r.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += [(200 + i, texts[r.randint(0, 9)], "en") for i in range(30)] + [(300 + i, texts[0], "de") for i in range(40)]
    rows += [(400, None, "en"), (401, "", "fr"), (402, " \n\t ", "fr"), (None, texts[1], "en"), (None, texts[1], "en")]
    rows += [(5, texts[5], "en"), (5, texts[6], "en"), (403, "word " * 60_000 + "#", "en"), (404, "z" * 300_000, "en")]
    return rows


def test_audit_equals_walking_all_orders(spark, block_bytes):
    rows = corpus()
    labels = [(i, (i or 0) % 2, (i or 0) % 3 == 0) for i, _, _ in rows if i is None or i % 4] + [(5, 1, 1), (5, 0, None), (None, 1, 1), (6, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    table = spark.createDataFrame([(*x, "f", "p") for x in labels], "doc_id int, quality int, toxic int, fails string, part string")
    found = term_matrix.audit(spark, docs(spark, rows).repartition(4), table).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == audit_of(rows, labels)
    assert len(found) == 600 * len({r.part for r in found})


def test_term_matrix_holds_every_count(spark, block_bytes):
    rows = [(1, "b a b", "x"), (2, None, "x"), (3, "a  c\n c c", "x"), (4, "", "x"), (5, "a" * 100, "x"), (None, "a", "x")]
    frame = docs(spark, rows).coalesce(1)
    known_words = sorted({w for _, t, _ in rows for w in (t or "").split()})
    seen, columns = {}, {}
    for s in term_matrix.term_matrix(spark, frame).collect():
        starts, counts = wordblocks.unpack(s.starts), wordblocks.unpack(s.counts)
        column = np.frombuffer(s.columns, "<i8")
        for k, (i, digest) in enumerate(zip(s.doc_ids, s.digests)):
            cells = dict(zip(column[starts[k]:starts[k + 1]].tolist(), counts[starts[k]:starts[k + 1]].tolist()))
            seen[i] = cells
    assert seen[2] == seen[4] == {} and sorted(seen[1].values()) == [1, 2] and sorted(seen[3].values()) == [1, 3]
    assert set(seen[None]) == set(seen[1]) & set(seen[3]) and len(seen[5]) == 1
    assert {c for cells in seen.values() for c in cells} == set(range(len(known_words)))


def test_empty_audit(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert term_matrix.audit(spark, docs(spark, [(1, "x", "")]).limit(0), labels).count() == 0
    alone = term_matrix.audit(spark, docs(spark, [(1, None, None)]), labels).collect()
    assert {r.part for r in alone} == {""} and len(alone) == 600
    assert sum(r.removed for r in alone) == 120 and {r.shapley for r in alone if r.filter_order[r.step - 1] == "A"} == {120}


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 255, 256, 65_535, 65_536, 2**32 - 1]):
        assert wordblocks.unpack(wordblocks.pack(np.array(values, np.int64))).tolist() == values
    source, codes = np.arange(10), np.array([2, 0, 2, 1])
    out = wordblocks.gather(codes, np.array([0, 3, 5]), np.array([3, 0, 2]), source)
    assert out.tolist() == [5, 6, 0, 1, 2, 5, 6] and not len(wordblocks.gather(codes[:0], codes, codes, source))


def test_workers_release_memory_and_results_go_in_small_batches(monkeypatch):
    import pyarrow as pa

    from martkit.llm import common, global_bpe
    from martkit.llm.wordblocks import pack

    ended = []
    monkeypatch.setattr(common, "release", lambda: ended.append(True))
    assert list(common.released(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and ended == [True]
    whole = pa.RecordBatch.from_arrays([pa.array([b"x" * 1000] * 5000, pa.binary())], ["ids"])
    parts = list(common.slices([whole, whole.slice(0, 0)]))
    assert pa.Table.from_batches(parts).column(0).combine_chunks() == whole.column(0)
    assert max(p.nbytes for p in parts) <= 1.1 * common.SLICE_BYTES
    # words 0, 1 and 2 have the ids 7, 8 9 and none; documents of two, none, three and four words
    monkeypatch.setattr(global_bpe, "BATCH_WORDS", 3)
    block = pa.table({
        "doc_ids": pa.array([[4, None, 5, 4]], pa.list_(pa.int64())), "sizes": pa.array([[2, 0, 3, 4]], pa.list_(pa.int32())),
        "codes": pa.array([pack(np.array([0, 1, 2, 1, 1, 0, 0, 0, 2]))], pa.binary())})
    given = pa.table({
        "codes": [pack(np.array([0, 2])), pack(np.array([1]))], "sizes": [pack(np.array([1, 0])), pack(np.array([2]))],
        "ids": [pack(np.array([7])), pack(np.array([8, 9]))]})
    found = global_bpe._reassemble(block, given)
    ids = [np.frombuffer(x, "<u4").tolist() for x in found.column("ids").to_pylist()]
    assert ids == [[7, 8, 9], [], [8, 9, 8, 9], [7, 7, 7]] and found.column("doc_id").to_pylist() == [4, None, 5, 4]
    assert [b.num_rows for b in found.to_batches()] == [2, 1, 1]
