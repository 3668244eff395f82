"""Site posteriors against a plain recomputation; the classifier on small corpora."""

import random
from collections import defaultdict

import pytest

from martkit.llm import site_quality as q

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, p_low string, kept string, host string"
GOOD = "the river ran past quiet fields while people walked home and talked about harvest weather children school bread".split()
BAD = "grubble snark blort vexx zang murk".split()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, 0, "p", "k", "h") for i, t, lang, src in rows], COLUMNS)


def plain_rates(rows):
    """Posterior bad rates of (host, path), head by head, without Spark."""
    out = {}
    for k, head in enumerate(q.HEADS):
        paths = defaultdict(lambda: [0, 0.0])
        hosts = defaultdict(lambda: [0, 0.0])
        for host, path, *bad in rows:
            for group, key in ((paths, (host, path)), (hosts, host)):
                group[key][0] += 1
                group[key][1] += bad[k]
        n = len(rows)
        rate = sum(r[2 + k] for r in rows) / n

        def strength(groups, mean):
            seen = sum(c * (b / c - mean(g)) ** 2 for g, (c, b) in groups.items()) / n
            chance = sum(mean(g) * (1 - mean(g)) for g in groups) / n
            spread = sum(c * mean(g) * (1 - mean(g)) for g, (c, _) in groups.items()) / n
            return q.STRONGEST if seen <= chance else min(q.STRONGEST, max(q.WEAKEST, spread / (seen - chance) - 1))

        s = strength(hosts, lambda _: rate)
        of_host = {g: (b + s * rate) / (c + s) for g, (c, b) in hosts.items()}
        s = strength(paths, lambda g: of_host[g[0]])
        for g, (c, b) in paths.items():
            out[g, head] = (b + s * of_host[g[0]]) / (c + s)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_site_rates_equal_a_plain_recomputation(spark, seed):
    r = random.Random(seed)
    rows = []
    for host in (None, "a", "b", "c"):
        for path in (None, "x", "y"):
            bad = r.random()
            rows += [(host, path, float(r.random() < bad), r.random() * bad) for _ in range(r.choice([1, 5, 60]))]
    frame = spark.createDataFrame(rows, "host string, path string, low double, toxic double").repartition(4)
    sites, rate = q.site_rates(frame)
    want = plain_rates(rows)
    found = {((x.s_host, x.s_path), h): x[f"path_{h}"] for x in sites.collect() for h in q.HEADS}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert rate["low"] == pytest.approx(sum(x[2] for x in rows) / len(rows))


def corpus(n=300):
    r = random.Random(4)
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        words = [r.choice(BAD if bad and r.random() < 0.3 else GOOD) for _ in range(r.randint(30, 80))]
        rows.append((i, " ".join(words), "en" if i % 2 else None, f"s{i % 7}" if i % 11 else None))
    return rows


def test_bad_documents_are_rejected_and_odd_rows_have_a_result(spark):
    rows = corpus() + [(900, None, "en", "s1"), (901, "", None, None), (902, " \n ", "en", "s2"), (None, "river bread", "en", "s1"),
                       (4, "repeated id", "en", "s3"), (903, "river fields " * 20_000, "en", "s4")]
    labels = [(i, int(i % 5 != 0), int(i % 5 == 0)) for i in range(0, 240)] + [(3, None, None), (3, 1, 0), (None, 0, 1), (7777, 0, 1)]
    known = spark.createDataFrame([(*x, "t", "k") for x in labels], "doc_id int, quality int, toxic int, text string, kept string")
    out = q.classify(spark, docs(spark, rows).repartition(3), known).collect()
    assert len(out) == len(rows) and all(0 <= r.p_toxic <= 1 and r.kept is not None for r in out)
    unseen = {r.doc_id: r.kept for r in out if r.doc_id is not None and 240 <= r.doc_id < 300}
    assert all(kept == (i % 5 != 0) for i, kept in unseen.items())
    assert all(r.kept for r in out if r.doc_id == 903)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_without_two_classes_nothing_is_rejected(spark, labels):
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = q.classify(spark, docs(spark, corpus(30)), known).collect()
    assert len(out) == 30 and all(r.kept for r in out)


def test_empty_table_is_classified(spark):
    known = spark.createDataFrame([(1, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert q.classify(spark, docs(spark, corpus(1)).limit(0), known).count() == 0
