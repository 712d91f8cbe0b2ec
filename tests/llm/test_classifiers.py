import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import labelled, quality, toxicity

INSULTS = ["blockhead", "numbskull", "dunderpate"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    syllables = "ka lo mi tu re sa no pe di ga ve zu".split()

    def words(n):
        return ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)]

    rows = []
    for i in range(600):
        w, toxic, good = words(rnd.randint(20, 120)), i % 6 == 0, i % 5 != 1
        if toxic:
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(INSULTS)
        if not good:
            w = [x + rnd.choice(["###", "%%%"]) for x in w] if i % 2 else [x for x in w for _ in (0, 1)]
        rows.append((i, " ".join(w), int(good), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, texts):
    odd = [(None, "no id"), (9001, None), (9002, ""), (9003, "x"), (9003, "x"), (9004, "lo " * 80_000)]
    docs = [(i, t) for i, t, _, _ in texts] + odd
    docs = spark.createDataFrame([(*r, 0.1, True) for r in docs], "doc_id long, text string, score double, held_out boolean")
    marks = [(i, q, t) for i, _, q, t in texts] + [(None, 1, 1), (9001, None, None), (0, 1, 1), (123456, 0, 0)]
    return docs.repartition(3), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize(
    "run,column,threshold", [(quality.classify, 2, 0.3), (toxicity.score_toxicity, 3, 0.5)], ids=["quality", "toxicity"]
)
def test_held_out_accuracy(tables, texts, run, column, threshold):
    got = run(*tables).collect()
    assert len(got) == len(texts) + 6
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == held(r.doc_id) for r in got)
    truth = {r[0]: r[column] for r in texts}
    scores = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in scores]) >= 0.95
    twice = [r.score for r in got if r.doc_id == 9003]
    assert twice[0] == twice[1]


def test_learning_reads_no_held_out_row(tables):
    docs, labels = tables
    picked = labelled.sample(docs, labels, "toxic", {0: 50, 1: 20}).collect()
    assert len(picked) == 70 and not any(held(r.doc_id) for r in picked)
    flipped = labels.withColumn("quality", F.when(labelled.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id or 0, r.score) for r in quality.classify(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_insults_with_gaps_and_inserted_characters(texts):
    toxic = [t.encode() for _, t, _, x in texts if x]
    clean = [t.encode() for _, t, _, x in texts if not x]
    machine = toxicity.fit(toxic, clean, 1 / 6)
    base = "kalo mitu resano pedi gave zuka lomi " * 2

    def score(word):
        raw = " ".join([base, word, base, word, base, word, base]).encode()
        return machine.score(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]

    plain = score("kalomitu")
    for said in ("blockhead", "BLOCKHEAD", "blo-ckhead", "blockxhead", "b l o c k h e a d", "n.u.m.b.s.k.u.l.l", "numbskvull"):
        assert score(said) > 0.5 > plain


def test_subsequences_tolerate_gaps():
    plain, gapped = toxicity.subsequences(b"insult"), toxicity.subsequences(b"inXsult")
    other = toxicity.subsequences(b"thread")

    def kernel(a, b):
        return sum(v * b.get(c, 0) for c, v in a.items())

    assert kernel(plain, gapped) > 0.4 * kernel(plain, plain) > kernel(plain, other)


@pytest.mark.parametrize("run", [quality.classify, toxicity.score_toxicity])
def test_without_labels_or_documents(tables, empty_docs, run):
    docs, labels = tables
    none = labels.where("doc_id = -5")
    assert len({r.score for r in run(docs, none).collect()}) == 1
    assert run(empty_docs, labels).collect() == [] == run(empty_docs, none).collect()


def test_keep_good_keeps_rows_as_they_are(tables, texts):
    docs, labels = tables
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    accepted = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == accepted


def brute_map(text):
    """Every choice of four folded characters within SPAN, one by one."""
    symbols, out = toxicity._symbols(text).tolist(), {}
    for places in combinations(range(len(symbols)), 4):
        reach = places[3] - places[0]
        if reach < toxicity.SPAN:
            key = tuple(symbols[p] for p in places)
            out[key] = out.get(key, 0.0) + toxicity.DECAY ** (reach - 3)
    return out


def test_kernel_against_brute_force():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"abcABC1 -xyz") for _ in range(rnd.randint(0, 16))) for _ in range(40)] + [b"blockhead", b"b-l-o-c-k"]
    maps = [brute_map(t) for t in texts]
    code = lambda key: key[0] << 15 | key[1] << 10 | key[2] << 5 | key[3]
    for t, m in zip(texts, maps):
        got = toxicity.subsequences(t)
        assert got.keys() == {code(k) for k in m}
        assert all(got[code(k)] == pytest.approx(v) for k, v in m.items())
    table = toxicity._matrix(texts, [toxicity.subsequences(t) for t in texts])
    for i, a in enumerate(maps):
        for j, b in enumerate(maps):
            assert table[i, j] == pytest.approx(sum(v * b.get(k, 0.0) for k, v in a.items()), rel=1e-4, abs=1e-4)


def test_ranking_minimises_the_pairwise_logistic_loss():
    rng = np.random.default_rng(5)
    y = (rng.random(200) < 0.7).astype(int)
    x = rng.normal(size=(200, quality.FEATURES)) + 0.8 * y[:, None] * (np.arange(quality.FEATURES) % 3 == 0)
    model = quality.fit(x, y, 0.3)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    bad = np.repeat(np.flatnonzero(y == 0), quality.PAIRS)
    good = np.random.default_rng(7).choice(np.flatnonzero(y == 1), len(bad))

    def loss(w):
        total = 0.0
        for g, b in zip(good, bad):  # a good document should score above a bad one
            total += np.log1p(np.exp(-(z[g] - z[b]) @ w))
        return total / len(bad) + 1e-3 / 2 * (w @ w)

    least = loss(model.weights)
    for k in range(quality.FEATURES):
        step = np.zeros(quality.FEATURES)
        step[k] = 1e-3
        assert abs(loss(model.weights + step) - loss(model.weights - step)) / 2e-3 < 1e-5
        assert loss(model.weights + 50 * step) > least < loss(model.weights - 50 * step)


def test_every_labelled_document_counts(spark, tables):
    docs, labels = tables
    rows = quality._labelled(quality.id_and_text(docs), quality._featured(quality.id_and_text(docs)), labels).collect()
    known = {r.doc_id for r in labels.collect() if r.doc_id is not None and r.quality is not None and not held(r.doc_id)}
    assert sorted(r.doc_id for r in rows) == sorted(known - {123456})
    for y in ([0, 1, 1, 1], [1, 0, 0], [0] + [1] * 40, [0, 0]):
        good, bad = quality.pairs(np.array(y))
        assert len(good) == len(bad) and ({*good, *bad} == set(range(len(y))) or len(set(y)) == 1)


def test_learning_has_no_limit_per_class(spark, texts):
    # more bad documents of one sort than any sample held: they decide what bad means
    docs = [(i, t) for i, t, *_ in texts] + [(10_000 + i, f"fine words {i} here @@@ @@@") for i in range(9000)]
    marks = [(i, q) for i, _, q, _ in texts] + [(10_000 + i, 0) for i in range(9000)]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    rows = quality._labelled(quality.id_and_text(docs), quality._featured(quality.id_and_text(docs)), labels)
    blocks, sizes = quality._blocks(rows)
    assert sizes[0] > 6000 and blocks.selectExpr("sum(size(y))").first()[0] == sum(sizes.values())
    model = quality.train(docs, labels)
    x = np.array([r.x for r in rows.collect()])
    assert np.allclose(model.mean, x.mean(0), atol=1e-9) and np.allclose(model.scale, np.maximum(x.std(0), 1e-3), atol=1e-6)


def test_crossing_is_the_quantile_of_a_plain_sort(spark):
    rng = np.random.default_rng(3)
    for raw, y in ((rng.normal(size=500), rng.random(500) < 0.8), (np.round(rng.normal(size=300), 1), rng.random(300) < 0.5)):
        y, share = y.astype(int), 0.25
        sizes = {0: int((y == 0).sum()), 1: int((y == 1).sum())}
        weight, order = np.where(y == 0, share / sizes[0], (1 - share) / sizes[1]), np.argsort(raw, kind="stable")
        at = int(np.searchsorted(np.cumsum(weight[order]), share))
        scores = spark.createDataFrame(list(zip(raw.tolist(), y.tolist())), "raw double, y int")
        got, plain = quality._crossing(scores, sizes, share), raw[order]
        assert abs(got - plain[max(0, at - 1) : at + 2].mean()) < 1e-9 or got == plain[at]
