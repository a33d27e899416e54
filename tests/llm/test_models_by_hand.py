"""The learned models against plain versions of the same steps, one number at a time."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import language, pseudonyms, quality, textkit, toxicity

from .helpers import collected, docs, prose

MASK = (1 << 64) - 1


def mixed(x: int) -> int:
    return int(textkit.mix(np.array([x & MASK], np.uint64))[0])


def word_hash(word: str, separators=textkit.SPACE, fold=textkit.LOWER) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(textkit.Words(data, np.array([0, len(data)]), separators, fold).hash[0])


def labelled_rows(spark, n=90):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        w = prose(i, 25, 60).split()
        if i % 3 == 0:
            w[r.randrange(25)] = "Vile"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0), int(i % 3 == 0)))
    return rows, labels, docs(spark, [*rows, (None, None), (700, ""), (701, "é " * 9)]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def plain_toxic_features(text, s):
    words = [word_hash(w) for w in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", text or "")]
    out = {h & (s.dims - 1) for h in words}
    for gap in s.skips:
        out |= {mixed(a * 0x9E3779B97F4A7C15 + b * (2 * gap + 1)) & (s.dims - 1) for a, b in zip(words, words[gap:], strict=False)}
    return sorted(out)


def test_toxicity_equals_a_plain_ftrl(spark):
    s = toxicity.Settings(dims=1 << 12, epochs=2, l1=0.5)
    rows, labels, table, ratings = labelled_rows(spark)
    got = collected(toxicity.score(table, toxicity.fit(table, ratings, F.col("doc_id") < 60, s)))
    ids = sorted(range(60), key=lambda i: (mixed(i), i))
    truth = {i: y for i, _, y in labels}
    ones = sum(truth[i] for i in ids)
    z, n = [0.0] * s.dims, [0.0] * s.dims
    bias, nb = math.log((ones / 60) / (1 - ones / 60)), 1.0

    def weight(k):
        return 0.0 if abs(z[k]) <= s.l1 else (math.copysign(s.l1, z[k]) - z[k]) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    features = {i: plain_toxic_features(t, s) for i, t in [*rows, (None, None), (700, ""), (701, "é " * 9)]}
    for _ in range(s.epochs):
        for i in ids:
            w = {k: weight(k) for k in features[i]}
            g = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - truth[i]
            for k, x in w.items():
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / s.alpha * x
                n[k] += g * g
            nb += g * g
            bias -= s.alpha * g / math.sqrt(nb)
    for i, at in features.items():
        want = 1 / (1 + math.exp(-(sum(weight(k) for k in at) + bias)))
        assert got[i].score == pytest.approx(want, abs=1e-4)


def plain_quality_features(text, dims):
    counts: dict[int, int] = {}
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    hashes = [word_hash(w) for w in words]
    shape = lambda w: re.sub(r"(.)\1+", r"\1", "".join("a" if "a" <= c <= "z" or ord(c) > 127 else "A" if "A" <= c <= "Z" else "0" if c.isdigit() else c for c in w))
    for h in [*hashes, *(mixed(word_hash(shape(w), fold=textkit.AS_IS) + 1) for w in words), *(0x5DEECE66D for a, b in zip(hashes, hashes[1:], strict=False) if a == b)]:
        counts[h & (dims - 1)] = counts.get(h & (dims - 1), 0) + 1
    total = sum(counts.values())
    return {k: math.sqrt(c / total) for k, c in sorted(counts.items())}


def test_quality_equals_a_plain_ordinal_regression(spark):
    s = quality.Settings(dims=1 << 10, epochs=2, batch=7)
    rows, _, table, _ = labelled_rows(spark)
    grades = {i: i % 3 for i in range(60)}
    model = quality.fit(table, spark.createDataFrame(list(grades.items()), "doc_id long, quality int"), F.lit(True), s)
    ids = sorted(grades, key=lambda i: (mixed(i), i))
    features = {i: plain_quality_features(t, s.dims) for i, t in rows}
    logistic = lambda x: 1 / (1 + math.exp(-x))
    share = [sum(grades[i] <= k for i in ids) / 60 for k in (0, 1)]
    start = [math.log(p / (1 - p)) for p in share]
    raw = [start[0], math.log(max(start[1] - start[0], 1e-2))]
    w, gw, gr = [0.0] * s.dims, [1e-8] * s.dims, [1e-8] * 2
    rng = np.random.default_rng(7)
    for _ in range(s.epochs):
        order = rng.permutation(60)
        for lo in range(0, 60, s.batch):
            own = [ids[j] for j in order[lo : lo + s.batch]]
            theta = [raw[0], raw[0] + math.exp(raw[1])]
            grad: dict[int, float] = {}
            dtheta = [0.0, 0.0]
            for i in own:
                m = sum(v * w[k] for k, v in features[i].items())
                full = [0.0, *(logistic(t - m) for t in theta), 1.0]
                up, down = full[grades[i] + 1], full[grades[i]]
                p = max(up - down, 1e-9)
                dup, ddown = up * (1 - up) / p, down * (1 - down) / p
                for k, v in features[i].items():
                    grad[k] = grad.get(k, 0.0) + v * (dup - ddown)
                if grades[i] < 2:
                    dtheta[grades[i]] -= dup
                if grades[i] > 0:
                    dtheta[grades[i] - 1] += ddown
            dense = sum(len(features[i]) for i in own) > s.dims // 4
            for k in range(s.dims) if dense else sorted(grad):
                g = grad.get(k, 0.0) / len(own) + s.l2 * w[k]
                gw[k] += g * g
                w[k] -= s.rate * g / math.sqrt(gw[k])
            for j, d in enumerate((dtheta[0] + dtheta[1], dtheta[1] * math.exp(raw[1]))):
                d /= len(own)
                gr[j] += d * d
                raw[j] -= s.rate * d / math.sqrt(gr[j])
    theta = [raw[0], raw[0] + math.exp(raw[1])]
    got = collected(quality.rate(table, model, s))
    for i, _ in rows:
        m = sum(v * w[k] for k, v in features[i].items())
        c = [logistic(t - m) for t in theta]
        assert got[i].expected_grade == pytest.approx((c[1] - c[0]) + 2 * (1 - c[1]), abs=1e-4)
        assert got[i].tail_probability == pytest.approx(1 - c[1], abs=1e-4)


def plain_words(text, dims):
    """Places of the trigrams of each word: its letters with a space on both sides, in bytes."""
    out = []
    for run in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode()):
        b = b" " + bytes(c + 32 if 65 <= c <= 90 else c for c in run) + b" "
        codes = [b[i - 1] << 16 | b[i] << 8 | b[i + 1] for i in range(1, len(b) - 1)]
        out.append([(c * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - (dims.bit_length() - 1)) for c in codes])
    return out


def test_language_equals_a_plain_mixture(spark):
    s = language.Settings(dims=1 << 9)
    vocabulary = {"de": "der und ding mit haus wasser ueber", "en": "the and thing with house water over", "fr": "le et chose avec maison eau dessus"}
    r = random.Random(2)
    known = [(i, " ".join(r.choice(vocabulary[lang].split()) for _ in range(12)), lang) for i in range(60) for lang in [list(vocabulary)[i % 3]]]
    texts = [" ".join(r.choice(vocabulary[r.choice(pair)].split()) for _ in range(14)) for pair in [("de", "en"), ("en", "fr"), ("de", "de"), ("fr", "de"), ("en", "en")] * 4]
    got = collected(language.identify(docs(spark, list(enumerate(texts))), language.fit(docs(spark, known), F.lit(True), s), s))
    names = sorted(vocabulary)
    counts = {n: [s.smoothing] * s.dims for n in names}
    for _, t, lang in known:
        for word in plain_words(t, s.dims):
            for k in word:
                counts[lang][k] += 1
    logs = {n: [math.log(x / sum(c)) for x in c] for n, c in counts.items()}
    for i, t in enumerate(texts):
        words = [{n: sum(logs[n][k] for k in word) for n in names} for word in plain_words(t, s.dims)]

        def em(allowed, words=words):
            share = {n: 1 / len(allowed) for n in allowed}
            for k in range(s.rounds + 1):
                total = [sum(share[n] * math.exp(w[n]) for n in allowed) for w in words]
                if k == s.rounds:
                    return share, sum(map(math.log, total))
                share = {n: sum(share[n] * math.exp(w[n]) / x for w, x in zip(words, total, strict=True)) / len(words) for n in allowed}

        rank = sorted(names, key=lambda n, full=em(names)[0]: -full[n])
        single = {n: sum(w[n] for w in words) for n in names}
        top = max(names, key=lambda n: single[n])
        best, chosen = single[top], {top: 1.0}
        for k in range(2, len(names) + 1):
            share, like = em(rank[:k])
            like -= (k - 1) * 0.5 * math.log(max(2, len(words)))
            if like > best:
                best, chosen = like, share
        assert set(got[i].shares) == set(chosen) and all(got[i].shares[n] == pytest.approx(x, abs=1e-3) for n, x in chosen.items())
        assert got[i].lang_pred == max(chosen, key=lambda n: chosen[n])


def test_no_documents_give_no_rows(spark):
    none = docs(spark, [])
    rows, _, table, ratings = labelled_rows(spark)
    assert language.identify(none, language.fit(none, F.lit(True))).count() == 0
    assert quality.rate(none, quality.fit(none, ratings, F.lit(True))).count() == 0
    assert toxicity.drop_toxic(none, toxicity.fit(none, ratings, F.lit(True))).count() == 0
    assert pseudonyms.pseudonymise(none, "k").count() == 0


def test_training_counts_an_id_once_and_bounds_its_bytes(spark):
    rows, labels, _, ratings = labelled_rows(spark)
    again = docs(spark, rows + [(i, t + " zzz") for i, t in rows] * 3)
    one, two = (toxicity.fit(d, ratings, F.lit(True), toxicity.Settings(dims=1 << 12, l1=0.5)) for d in (docs(spark, rows), again))
    assert one.intercept == two.intercept and (one.places == two.places).all() and np.allclose(one.values, two.values)
    few = toxicity.Settings(train_bytes=1500)
    sample, ones, zeros = toxicity._sample(docs(spark, [*rows[:-1], (89, "w " * 5000)]), ratings, F.lit(True), few)
    got = sample.collect()
    assert 0 < sum(len(r.text) for r in got) <= 1500 and (ones, zeros) == (30, 60) and 89 not in {r.doc_id for r in got}


def test_very_long_and_repeated_texts(spark):
    long = "10.0.255.1 " + "word and more " * 80_000 + "4111111111111111"
    got = pseudonyms.pseudonymise(docs(spark, [(1, long), (2, "10.0.255.1"), (2, "10.0.255.1"), (3, "")]), "k").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 4 and by[1].text.split()[0] == by[2].text and not by[1].text.endswith("4111111111111111") and by[3].text == ""
