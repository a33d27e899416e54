from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import automaton, decontaminate, graph, near_dedup, secrets

from .helpers import LOW, collected, docs, prose, space_words


def shingles(text):
    w = space_words((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                label[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))], sets


def near_rows():
    r = random.Random(3)
    base = prose(1, 200).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 60):  # copies of a template that are closer to it than to each other
        w = list(base)
        for _ in range(3):
            w[r.randrange(len(w))] = f"x{k}{r.random()}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, prose(50 + k, 80)) for k in range(20)]
    rows += [(200 + k, prose(7, 90)) for k in range(30)]  # exact copies
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one two"), (304, "One  TWO"), (305, "one"), (None, "one two"), (None, prose(7, 90)), (200, prose(99, 70)), (200, prose(7, 90))]
    chain = prose(11, 300).split()
    for k in range(8):  # each links to the next only
        rows.append((400 + k, " ".join(chain[k * 12 : k * 12 + 150])))
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows()
    want, sets = brute_components(rows)
    got = near_dedup.near_duplicates(docs(spark, rows)).collect()
    key = lambda i, n, c: (i is None, i or 0, n, c is None, c or 0)
    assert sorted(key(r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(key(r[0], len(s), c) for r, s, c in zip(rows, sets, want, strict=True))
    assert all(r.kept == (r.component_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    only = near_dedup.near_duplicates(docs(spark, [(1, None), (2, "")])).collect()
    assert [(r.component_id, r.kept, r.n_shingles) for r in sorted(only)] == [(1, True, 0), (2, True, 0)]


def test_one_document_of_each_group_stays(spark):
    rows = near_rows()
    want, _ = brute_components(rows)
    kept = near_dedup.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    named = [i for i in ids if i is not None]
    assert sorted(named) == sorted({c for c, r in zip(want, rows, strict=True) if c is not None and c == r[0]})


def test_estimate_follows_the_similarity(spark):
    plan = near_dedup.Plan()
    a = prose(1, 400).split()
    texts = [" ".join(a), " ".join(a[:360] + prose(2, 40).split()), prose(3, 400)]
    rows = near_dedup.signed(docs(spark, list(enumerate(texts))), plan).select("doc_id", "sig")
    both = rows.alias("a").join(rows.alias("b"), F.col("a.doc_id") < F.col("b.doc_id")).select(F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j"), near_dedup.estimate(F.col("a.sig"), F.col("b.sig"), plan).alias("e"))
    for r in both.collect():
        p, q = shingles(texts[r.i]), shingles(texts[r.j])
        assert abs(r.e - len(p & q) / len(p | q)) < 0.19


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(5, 5), (7, 6), (200, None)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}


PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def base_spans(text):
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m))
    return found, ",".join(f"{PATTERNS[k][0]}:{a}:{e}" for a, k, e in found)


def secret_texts():
    r = random.Random(5)
    bits = ["password", "PASSWD", "Secret", "token", "apikey", "api_key", "API__KEY", "=", ":", "==", " ", "  ", '"', "'", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "deadbeefdeadbeef", "0123456789abcdef", "abc", "é", "ß", "\n", ".", ",", "-", "x" * 12, "short", "_", "/", "+", "𝒳"]
    return ["".join(r.choice(bits) for _ in range(r.randrange(1, 60))) for _ in range(800)]


def test_secrets_match_regexes(spark):
    texts = [*secret_texts(), None, "", "token=" + "a" * 200_000, "f" * 100_000, "api_key: secret: abcdefghijklmnop"]
    got = collected(secrets.digest(secrets.find_secrets(docs(spark, list(enumerate(texts))))))
    for i, t in enumerate(texts):
        spans, told = base_spans(t)
        r = got[i]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")] == ([x for x in told.split(",") if x]), t[:200]
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))


def test_further_rules_and_redaction(spark):
    key = "ghp_" + "Ab1" * 12
    rows = [(1, f"see {key} and password = hunter2hunter2 here"), (2, "nothing"), (3, None), (4, "-----BEGIN RSA PRIVATE KEY-----")]
    out = collected(secrets.redact_secrets(docs(spark, rows)))
    assert out[1].text == "see [SECRET] and [SECRET] here" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "nothing" and out[3].text is None and out[4].text == "[SECRET]"
    assert secrets.find_secrets(docs(spark, [])).count() == 0


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "[a-c]{2,4}x?", "ab{2}|a+", r"\x20*[:=]", "x{3,}y"])
def test_automaton_agrees_with_regex(pattern):
    d, r = automaton.build([(pattern, False)], anywhere=False), random.Random(1)
    for _ in range(400):
        text = "".join(r.choice("abcdxy :=") for _ in range(r.randrange(0, 7)))
        state = 0
        for c in text.encode():
            state = d.next[state, d.classes[c]]
        assert bool(d.kinds[state]) == bool(re.fullmatch(pattern, text)), text


def test_automaton_is_minimal():
    assert len(automaton.build([("(a|b)*abb", False)], anywhere=False).next) == 5  # four live states and the dead one


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_hits(rows, items):
    windows = {}
    for i, t in items:
        w = bench_words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, found = bench_words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (s := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= s
        ids = [str(x) for x in found if x is not None]
        out.append((i, len(w), len(hit), len(ids), decontaminate.item_digest(ids), bool(hit)))
    return out


def leak_tables():
    items = [(k, prose(900 + k, 25)) for k in range(12)] + [(50, "only three words"), (51, ""), (52, None), (None, prose(990, 12)), (0, prose(900, 25)), (53, "éü ß")]
    rows = [(k, prose(k, 300)) for k in range(20)]
    for k in range(12):
        w, p = prose(300 + k, 100).split(), prose(900 + k, 25).split()
        rows.append((100 + k, " ".join(w[:40] + p[k : k + 9 + k] + w[40:]).upper() if k % 2 else ", ".join(w[:5] + p + p[:15] + w[5:])))
    rows += [(200, None), (201, ""), (202, "Only-three words!"), (203, "a"), (204, prose(990, 12)), (204, prose(990, 12)), (205, "x éü, ß y"), (None, prose(901, 25)), (206, " ".join(prose(905, 25) for _ in range(3000)))]
    return rows, items


def test_contamination_matches_brute_force(spark):
    rows, items = leak_tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(map(key, brute_hits(rows, items)))
    whole = None
    for block_words, together in ((1 << 20, 8), (20, 100), (20, 2), (20, 1)):
        found = decontaminate.contamination(docs(spark, rows), bench, block_words=block_words, together=together)
        assert sorted(map(key, map(tuple, decontaminate.digest(found).drop("longest_match").collect()))) == want
        whole = whole or sorted(map(str, found.collect()))
        assert sorted(map(str, found.collect())) == whole


def test_longest_match_and_places(spark):
    item = prose(1, 40)
    text = "before " + " ".join(item.split()[3:33]) + " after"
    got = decontaminate.contamination(docs(spark, [(1, text)]), spark.createDataFrame([(9, item)], "item_id long, text string")).first()
    assert (got.n_hit, got["items"], got.longest, got.item_at, got.doc_at) == (30, ["9"], [30], [3], [1])


def test_clean_documents_stay(spark):
    rows, items = leak_tables()
    kept = decontaminate.drop_contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, *_, hit in brute_hits(rows, items) if not hit)
    passes = decontaminate.drop_contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_words=20, together=1)
    assert sorted(str(r.doc_id) for r in passes.collect()) == sorted(str(r.doc_id) for r in kept.collect()) and kept.columns == docs(spark, []).columns
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs(spark, []), nothing).count() == 0
    assert decontaminate.drop_contaminated(docs(spark, rows), nothing).count() == len(rows)


def test_suffix_array_orders_suffixes():
    r = np.random.default_rng(0)
    words = r.integers(1, 5, 300).astype(np.uint64)
    order = decontaminate.SuffixArray(words, 16).order
    keys = [tuple(words[i : i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))


@pytest.mark.parametrize("text", ["eyJ" * 340_000, "password " * 110_000, "eyJaaaaaaaa." * 80_000, "AKIA" * 250_000, "-----BEGIN " * 90_000], ids=["eyJ", "password", "dots", "AKIA", "BEGIN"])
def test_secret_scan_is_linear(text):
    began = time.perf_counter()
    secrets.scan(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), secrets.RULES)
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize("seed", range(4))
def test_starts_are_those_of_a_regex(seed):
    r = random.Random(seed)
    parts = ["eyJ", "abcdefgh1", ".", "eyJhbGciOiJI.eyJzdWIiOiIx.", "signature_0123456789", " ", "-", "é", "secret=", "abc123abc123z", "AKIA", "0123456789abcdef"]
    jwt = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.([A-Za-z0-9_-]+)")
    for _ in range(150):
        text = "".join(r.choice(parts) for _ in range(30))
        found = secrets.scan(*one_row(text), secrets.RULES).get(0, [])
        want = [(m.start(), m.end()) for m in jwt.finditer(text) if len(m[1]) >= 16]
        assert [(a, e) for a, k, e in found if secrets.RULES[k].kind == "jwt"] == want, text
        assert [x for x in found if x[1] < 3] == base_spans(text)[0]


def one_row(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])
