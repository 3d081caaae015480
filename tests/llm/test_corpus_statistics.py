"""Filter audit, resampling and the hidden Markov model against plain versions, on awkward rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from brindle.llm import audit, common, hmm, resample

SCHEMA = "doc_id long, text string, lang string, mask string, part string, n string, row string"


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "é", "ß", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    long, base = words(rng, 5000), words(rng, 220)
    texts = [None, "", " \t\n", base, base, base, "SHOUT " * 250, base + " a|b", "one Two", "a\x1cb\x85c d e f", long, long + "#", base.upper(), "x" * 5000, "ab " * 300]
    out = [(None if i == 5 else i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts)]
    out += [(4, base, "en"), (3, base, None), (20, "", "fr"), (10, long, "de"), (None, None, None)]
    out += [(100 + i, base if i % 3 else words(rng, rng.randint(1, 260)), "en") for i in range(90)]
    return [(*r, "x", "x", "x", "x") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_mask(i, text, rows):
    text = text or ""
    w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", text) if x]
    caps = sum("A" <= c <= "Z" for c in text)
    copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t in rows)
    return (len(w) < 200) | (100 * len(set(w)) < 50 * len(w)) << 1 | (100 * caps > 3 * len(text)) << 2 | any(c in "#$%&*|" for c in text) << 3 | copy << 4


@pytest.mark.parametrize("partitions", ["4", "40"])  # forty: the copies' text goes over many ranges
def test_audit_masks(spark, docs, rows, empty, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = Counter((r.doc_id, r.part, r.mask) for r in audit.masks(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    both = [r[:2] for r in rows]
    assert got == Counter((i, part or "", plain_mask(i, t, both)) for i, t, part, *_ in rows)
    assert audit.masks(empty).count() == 0


def test_audit_clashing_fingerprints(spark, docs, rows, monkeypatch):
    """Different texts of one fingerprint are told apart, within a range and over its end."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(audit.F, "xxhash64", lambda c: F.length(c).cast("long") % 2)
    both = [r[:2] for r in rows]
    assert Counter((r.doc_id, r.mask) for r in audit.masks(docs).collect()) == Counter((i, plain_mask(i, t, both)) for i, t in both)


def test_audit_report(spark, docs, rows, empty):
    rng = random.Random(2)
    labels = [(r[0], rng.randint(0, 1), rng.choice([0, 1, None])) for r in rows if r[0] is not None and r[0] % 2] + [(7, 1, 1), (7, 1, 1), (None, 1, 1), (999, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS mask", "'x' AS good")
    got = {(r.part, r.filter_order, r.step): r for r in audit.report(docs, frame).collect()}
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    masks = [(r[0], r[2] or "", plain_mask(r[0], r[1], [x[:2] for x in rows])) for r in rows]
    parts = {p for _, p, _ in masks}
    assert len(got) == 600 * len(parts)
    for part in parts:
        mine = [(i, m) for i, p, m in masks if p == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone, stay = [x for x in left if x[1] & bit], [x for x in left if not x[1] & bit]
                r = got[part, order, step]
                assert (r.kept, r.removed, r.redundant, r.unique_fails) == (len(stay), len(gone), sum(1 for _, m in mine if m & bit) - len(gone), sum(1 for _, m in mine if m == bit))
                assert (r.good_lost, r.toxic_lost) == (sum(i in good and i is not None for i, _ in gone), sum(i in toxic and i is not None for i, _ in gone))
                shapley[letter] += len(gone)
                left = stay
        assert all(r.shapley == shapley[r.filter] for (p, _, _), r in got.items() if p == part)
    assert audit.report(empty, frame).count() == 0 and audit.report(docs, frame.limit(0)).count() == len(got)
    # counters of two shares of the corpus add up
    masked = audit.masks(docs)
    halves = audit.counters(masked.where("mask % 2 = 0"), frame).unionAll(audit.counters(masked.where("mask % 2 = 1"), frame))
    assert Counter(map(tuple, audit.orders(halves).collect())) == Counter(tuple(r) for r in got.values())


# Resampling


def plain_features(text):
    import re

    w = re.findall(resample.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % resample.BUCKETS for n in (1, 2, 3) for i in range(len(w) - n + 1))


@pytest.mark.parametrize("size", [resample.PIECE, 40, 1])
def test_resample_pieces(rows, size):
    """Texts in pieces have the same counts as whole ones."""
    texts = [r[1] if r[1] is None else r[1][:1500] for r in rows][:40]
    con = resample.connect()
    for text, (n, buckets, counts) in zip(texts, resample.counted(con, texts, size)):
        assert (n, dict(zip(buckets.tolist(), counts.tolist()))) == plain_features(text)
    con.close()


def test_resample(spark, docs, rows, empty):
    import hashlib

    target = spark.createDataFrame([(1, words(random.Random(3), 300)), (2, None), (3, "")], "item_id long, text string")
    got = resample.resample(docs, target, percent=30).collect()
    mine = [(i, *plain_features(t)) for i, t, *_ in rows]
    s, t = sum((f for _, _, f in mine), Counter()), sum((plain_features(x[0])[1] for x in target.select("text").collect()), Counter())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in s}
    want, able = [], []
    for i, n, f in mine:
        weight = sum(gain[b] * k for b, k in f.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append((i, f.total(), weight, score))
        if n >= resample.LEAST_WORDS:
            able.append((-score, i is None, i or 0))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 30 * len(able) // 100 + 1))
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn] == sorted(able)[: len(drawn)]
    assert resample.resample(empty, target).count() == 0
    none = resample.resample(docs, target.limit(0)).collect()
    assert len(none) == len(rows)


# The model


def plain_likelihood(model, classes):
    """The sum over all ways through the states."""
    total = 0.0
    for way in itertools.product(range(len(model.start)), repeat=len(classes)):
        p = model.start[way[0]] * model.emit[way[0], classes[0]]
        for a, b, c in zip(way, way[1:], classes[1:]):
            p *= model.move[a, b] * model.emit[b, c]
        total += p
    return total


def plain_expected(model, sequences):
    states = len(model.start)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    for seq in sequences:
        ways = []
        for way in itertools.product(range(states), repeat=len(seq)):
            p = model.start[way[0]] * model.emit[way[0], seq[0]]
            for a, b, c in zip(way, way[1:], seq[1:]):
                p *= model.move[a, b] * model.emit[b, c]
            ways.append((way, p))
        total = sum(p for _, p in ways)
        for way, p in ways:
            start[way[0]] += p / total
            for a, b in zip(way, way[1:]):
                move[a, b] += p / total
            for a, c in zip(way, seq):
                emit[a, c] += p / total
    return start, move, emit


def test_hmm_recursions():
    rng = np.random.default_rng(5)
    emit = rng.random((3, hmm.CLASSES + 1))
    model = hmm.Model(np.array([0.5, 0.3, 0.2]), np.array([[0.8, 0.1, 0.1], [0.3, 0.4, 0.3], [0.05, 0.05, 0.9]]), emit / emit.sum(1, keepdims=True), np.zeros(hmm.CLASSES + 1), np.zeros(hmm.CLASSES + 1))
    sequences = [rng.integers(0, 5, n) for n in (6, 1, 4, 4, 2)]
    flat, lengths = np.concatenate(sequences), np.array([len(s) for s in sequences])
    starts = np.cumsum(lengths) - lengths
    logs, sums = np.zeros(5), [0.0, 0.0, 0.0]
    for some in hmm.groups(lengths, at_once=7):
        places, alive = hmm.by_time(starts[some], lengths[some])
        logs[some] = hmm.forward(model, flat[places], alive)[0]
        sums = [a + b for a, b in zip(sums, hmm.expected(model, flat[places], alive))]
    assert np.allclose(10**logs, [plain_likelihood(model, s) for s in sequences])
    assert all(np.allclose(a, b) for a, b in zip(sums, plain_expected(model, sequences)))
    # no scale vanishes on a long sequence
    long = np.tile(np.arange(5), 20_000)
    places, alive = hmm.by_time(np.array([0]), np.array([len(long)]))
    assert np.isfinite(hmm.forward(model, long[places], alive)[0]).all()


def plain_tokens(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("size", [hmm.BLOCK, 3000])
def test_hmm_scores(docs, rows, size):
    cut = hmm.blocks(docs, size=size)
    known = hmm.vocabulary(cut)
    model = hmm.fit(cut, known, states=3, rounds=2)
    got = hmm.scored(cut, known, model).collect()
    seen = Counter(w for i, t, *_ in rows if not held(i) for w in plain_tokens(t))
    n, v = seen.total(), len(seen)
    assert {(r["word"].decode(), r["n"]) for r in known.collect()} == set(seen.items())
    want, scores = Counter(), {}
    in_class, distinct = Counter(), Counter()
    for w, c in seen.items():
        in_class[hmm.class_of(w)] += c
        distinct[hmm.class_of(w)] += 1
    for i, t, *_ in rows:
        tokens = plain_tokens(t)
        want[i, held(i), len(tokens), sum(seen[w] > 0 for w in tokens), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens), 6)] += 1
        # forward by hand, unscaled parts in logs
        a, total = model.start, 0.0
        for k, w in enumerate(tokens):
            c = hmm.class_of(w)
            a = (a if k == 0 else a @ model.move) * model.emit[:, c]
            total += math.log10(a.sum()) + (math.log10((seen[w] + 1) / (in_class[c] + distinct[c] + 1)) if w else 0.0)
            a = a / a.sum()
        scores[i, t] = total
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sorted(round(r.score, 5) for r in got) == sorted(round(scores[i, t], 5) for i, t, *_ in rows)
    assert np.isclose(model.emit.sum(1), 1).all() and np.isclose(model.move.sum(1), 1).all() and np.isclose(model.start.sum(), 1)


def test_hmm_learns(spark):
    """Two vocabularies that take turns: training raises the likelihood of held-out texts, and beats the base."""
    rng = random.Random(6)
    kinds = [["alpha", "beta", "gamma", "delta", "eps"], ["one", "two", "three", "four", "five"]]
    rows = [(i, " ".join(rng.choice(kinds[(i + k // 15) % 2]) for k in range(60))) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = hmm.blocks(frame)
    known = hmm.vocabulary(cut)
    totals = []
    for rounds in (0, 1, 6):
        got = hmm.scored(cut, known, hmm.fit(cut, known, states=4, rounds=rounds)).where("held_out").collect()
        totals.append(sum(r.score for r in got))
    assert totals[0] < totals[1] < totals[2]
    assert totals[2] > sum(r.base_score for r in got) + 0.1 * sum(r.n_tokens for r in got)


def test_hmm_edges(spark, empty):
    assert hmm.score(empty).count() == 0
    out = next(i for i in range(100) if held(i))
    got = hmm.score(spark.createDataFrame([(out, "some words"), (out, None)], "doc_id long, text string")).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in got)
    one = hmm.score(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].train_tokens == 1 and one[0].n_known == 1


def test_staged_options(spark):
    assert common.staged(spark.range(3), "options", {"parquet.page.size.row.check.min": "1"}).count() == 3
