from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import language, pseudonyms, quality, quality_rules, textkit, token_counts, toxicity
from voxelloom.llm.queries import VOCABULARY

from .helpers import collected, docs, prose, space_words

EDGE = [(9001, None), (9002, ""), (9003, " \n"), (9004, "x " * 60_000), (9005, "é́𝒳 ∞"), (9005, "é́𝒳 ∞"), (None, "some words here")]


def toxic_tables(spark):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        w = prose(i, 60, 2000).split()
        if bad:
            for _ in range(3):
                w[r.randrange(60)] = r.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad), int(bad)))
    labels += [(5, None, None), (None, 1, 1), (77_777, 1, 1), (0, 0, 1)]
    return docs(spark, rows + EDGE), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_generalises(spark):
    table, labels = toxic_tables(spark)
    w = toxicity.fit(table, labels, ~toxicity.held_out())
    assert 0 < len(w.places) < 5000  # sparse
    got = toxicity.score(table, w).withColumn("h", toxicity.held_out()).collect()
    assert len(got) == 900 + len(EDGE) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.h and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 100 and sum((r.score >= 0.5) == (r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)
    kept = toxicity.drop_toxic(table, w)
    assert kept.columns == table.columns and kept.count() == sum(r.score < 0.5 for r in got)


def test_toxicity_without_labels(spark):
    table, labels = toxic_tables(spark)
    w = toxicity.fit(table, labels.filter("false"), F.lit(True))
    assert all(r.score == 0 for r in toxicity.score(table, w).collect())
    assert toxicity.score(docs(spark, []), w).count() == 0


def test_ordinal_regression_on_five_grades(spark):
    r = random.Random(4)
    rows, ratings = [], []
    for i in range(1500):
        g = i % 5
        rows.append((i, " ".join(r.choice(["good", "fine"]) if r.random() < g / 4 else r.choice(["bad", "poor"]) for _ in range(60))))
        ratings.append((i, g))
    table, labels = docs(spark, rows + EDGE), spark.createDataFrame([*ratings, (3, None), (None, 4)], "doc_id long, quality int")
    m = quality.fit(table, labels, ~quality.held_out())
    assert m.grades == [0, 1, 2, 3, 4] and (np.diff(m.thresholds) > 0).all()
    got = [x for x in quality.rate(table, m, cut=3).withColumn("h", quality.held_out()).collect() if x.doc_id is not None and x.doc_id < 1500 and x.h]
    error = np.mean([abs(x.expected_grade - x.doc_id % 5) for x in got])
    assert error < 0.6 and np.mean([(x.tail_probability >= 0.5) == (x.doc_id % 5 >= 3) for x in got]) > 0.85
    assert quality.rate(table, m).count() == 1500 + len(EDGE)


def test_quality_without_ratings(spark):
    table = docs(spark, EDGE)
    m = quality.fit(table, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert {(x.expected_grade, x.tail_probability) for x in quality.rate(table, m).collect()} == {(0.0, 1.0)}


WORDS = {"en": "the and thing with house water over under that this", "de": "der und ding mit haus wasser ueber unter dass dieses", "fr": "le et chose avec maison eau dessus dessous que cette"}


def language_rows():
    r = random.Random(1)
    rows = []
    for i in range(600):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(r.choice(WORDS[lang].split()) for _ in range(40)), lang))
    return rows


def test_language_and_mixtures(spark):
    table = docs(spark, [*language_rows(), (700, "und " * 3, None), (701, "12 34 !?", "en"), *[(i, t, None) for i, t in EDGE]])
    m = language.fit(table, ~language.held_out())
    assert m.names == ["de", "en", "fr"]
    half = " ".join(WORDS["en"].split() * 6 + WORDS["de"].split() * 3)
    got = language.identify(docs(spark, [*language_rows(), (800, half), (701, "12 34 !?"), *EDGE]), m).collect()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == lang for i, _, lang in language_rows())
    assert by[800].lang_pred == "en" and set(by[800].shares) == {"de", "en"} and abs(by[800].score - 2 / 3) < 0.1
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (701, 9001, 9002, 9003))
    assert by[9005].lang_pred != "und" and all(0 <= r.score <= 1 for r in got) and len(got) == 602 + len(EDGE)


def test_language_without_training(spark):
    m = language.fit(docs(spark, [(1, "text", None)]), F.lit(True))
    assert {r.lang_pred for r in language.identify(docs(spark, [(1, "text")]), m).collect()} == {"und"}


def test_token_counts_match_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    v = token_counts.load_vocabulary(VOCABULARY)
    t = tokenizers.Tokenizer(tokenizers.models.Unigram(v.pieces, 0, True))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace()
    r = random.Random(8)
    letters = "abcdefghij  \n\tééß漢字𝒳▁.,0123<>"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(0, 80))) for _ in range(400)] + [" lead", "two  spaces", "trail ", "▁mark", "The quick brown fox", "<0x0A> <unk>", prose(1, 500)]
    got = collected(token_counts.count_tokens(docs(spark, list(enumerate(texts)) + [(9001, None), (9002, "")]), v))
    for i, text in enumerate(texts):
        assert got[i].n_tokens == len(t.encode(text, add_special_tokens=False).ids), repr(text)
    assert got[9001].n_tokens == got[9002].n_tokens == 0


def test_token_ties_and_unknowns():
    v = token_counts.Vocabulary([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0)], False)
    c = token_counts.Counter(v)
    assert c.text("ab") == 2  # the longer piece comes first and a tie doesn't replace it
    assert c.text("axyb") == 4 and c.text("xx") == 2  # unknown neighbours are one
    assert token_counts.Counter(token_counts.Vocabulary(v.pieces, True)).text("é") == 3


KEY = "a test key"
PRIVATE = [
    (1, "card 4111 1111 1111 1111, same 4111111111111111; bad 4111111111111112"), (2, "born 1990-02-28 and 28.02.1990, not 1990-02-31 or 0000-01-01"), (3, "host 10.0.255.1 not 10.0.256.1"), (4, "call +1 (017) 555-7713 now"),
    (5, "ssn 123-45-6789 not 000-12-3456"), (6, "mail a.b@c.example.org twice A.B@c.example.org"), (7, None), (8, ""), (9, "plain text 12 345"), (10, "9999-12-31 0001-01-01"), (11, "card 4111111111111111"), (None, "10.0.255.1"),
]


def test_pseudonyms_keep_format_and_link(spark):
    got = collected(pseudonyms.pseudonymise(docs(spark, PRIVATE), KEY))
    a, b = got[1].text, got[11].text
    parts = a.removeprefix("card ").split(", same ")
    assert got[1].n_card == 2 and parts[0].replace(" ", "") == parts[1].split(";")[0] == b.removeprefix("card ") != "4111111111111111"
    assert [len(x) for x in parts[0].split(" ")] == [4] * 4 and a.endswith("bad 4111111111111112")
    digits = [int(c) for c in b.removeprefix("card ")][::-1]
    assert (sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])) % 10 == 0
    assert got[2].n_date == 2 and got[2].text.endswith("not 1990-02-31 or 0000-01-01") and "1990-02-28" not in got[2].text
    assert got[3].n_ip == 1 and got[3].text.split()[1] == got[None].text and got[3].text.endswith("10.0.256.1")
    assert got[4].n_phone == 1 and got[4].text != PRIVATE[3][1] and got[4].text[5:8] == "+1 "
    assert got[5].n_ssn == 1 and got[5].text.endswith("000-12-3456") and "123-45-6789" not in got[5].text
    mails = [w for w in got[6].text.split() if "@" in w]
    assert mails[0] == mails[1] and mails[0].endswith("@pseudonym.invalid")
    assert got[7].text is None and got[8].text == "" and got[9].text == PRIVATE[8][1]


def test_pseudonyms_round_trip(spark):
    hidden = pseudonyms.pseudonymise(docs(spark, PRIVATE), KEY).select("doc_id", "text")
    back = collected(pseudonyms.restore(hidden, KEY))
    assert all(back[i].text == t for i, t in PRIVATE if i != 6)


def test_permutations_are_one_to_one(spark):
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert d.select(pseudonyms.permute_digits(F.col("d"), KEY, "t").alias("p")).distinct().count() == 1000
    assert spark.range(2059).select(pseudonyms.permute_pair(F.col("id"), F.lit(29), F.lit(71), KEY, "t").alias("p")).filter("p between 0 and 2058").distinct().count() == 2059


def brute_rules(text):
    w, runs = space_words(text), {}
    for k in range(len(w) - 2):
        runs.setdefault(tuple(w[k : k + 3]), []).append(k)
    repeat = {j for ks in runs.values() if len(ks) > 1 for k in ks for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat)


def spelt(seed, n):
    return prose(seed, n).translate(str.maketrans("0123456789", "abcdefghij"))


def test_quality_rules_match_brute_force(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b", "c", "d", "é𝒳"]) for _ in range(r.randrange(0, 90))) for _ in range(60)] + ["\n".join(r.choice(["x y", "x y ", "", "z"]) for _ in range(30)) for _ in range(20)]
    texts += [None, "", "\n\n", "a", "a b", "a b c", "a a a a", "# $ % | <b>", prose(1, 20_000, 50), spelt(2, 300), spelt(3, 100).upper(), " ".join(f"{w}***" for w in spelt(4, 100).split())]
    got = collected(quality_rules.judge(docs(spark, list(enumerate(texts)))))
    for i, t in enumerate(texts):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == brute_rules(t), repr(t)[:100]
        failed = g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words
        assert g.base_failed == failed and not (failed and g.kept)
    n = len(texts)
    assert got[n - 3].kept and not got[n - 2].kept and not got[n - 1].kept
    assert quality_rules.judge(docs(spark, [])).count() == 0


def test_rule_order_changes_no_verdict(spark):
    table = docs(spark, [(i, prose(i, 120) if i % 3 else prose(i, 120).upper() + " |" * 80) for i in range(60)])
    each = quality_rules.rules()
    one = collected(quality_rules.judge(table, each))
    two = quality_rules.counted(table).withColumn("base_failed", quality_rules.base_failed())
    for order in (each, each[::-1]):
        kept = collected(two.select("doc_id", F.when(F.col("base_failed"), False).otherwise(quality_rules.cascade(order).isNull()).alias("kept")))
        assert all(one[i].kept == kept[i].kept for i in one)
    ranked = quality_rules.measure(quality_rules.counted(table).persist(), each)
    assert len(ranked) == len(each) and all(cost > 0 and 0 <= share <= 1 for _, share, cost in ranked)


def test_native_operators_run_no_python(spark):
    for df in (pseudonyms.pseudonymise(docs(spark, PRIVATE), KEY), quality_rules.judge(docs(spark, PRIVATE))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_word_hashes_depend_on_the_word_only():
    texts = ["alpha beta", "beta\talpha", "", "ALPHA", "x" * 3_000_000 + " beta"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    w = textkit.Words(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    assert w.counts.tolist() == [2, 2, 0, 1, 2]
    assert w.hash[0] == w.hash[3] == w.hash[4] and w.hash[1] == w.hash[2] == w.hash[6] and len(set(w.hash.tolist())) == 3


def test_rare_language_is_learned_from_a_large_table(spark):
    s = language.Settings(train_docs=60, least_docs=10)
    rows = [(i, t, lang) for i, t, lang in language_rows() if lang != "fr"] + [(None, WORDS["fr"], "fr")] * 2
    m = language.fit(docs(spark, rows), F.lit(True), s)
    assert m.names == ["de", "en", "fr"]
    assert language._bound([2, 200, 200], s) == 29 and language._bound([5, 5], s) >= 5 and language._bound([9] * 20, s) == 10
    got = collected(language.identify(docs(spark, [(1, WORDS["fr"]), (2, WORDS["en"])]), m))
    assert (got[1].lang_pred, got[2].lang_pred) == ("fr", "en")


def test_pseudonyms_beside_marks(spark):
    texts = ["10.0.0.1-10.0.0.99", "id_4111111111111111", "x-123-45-6789", "v.2020-01-02", "a%+49 30 1234567", "1.10.0.0.1.5", "b4111111111111111", "a.b-c@x.org"]
    got = collected(pseudonyms.pseudonymise(docs(spark, list(enumerate(texts))), KEY))
    found = [tuple(got[i][f"n_{k}"] for k in ("ip", "card", "ssn", "date", "phone", "email")) for i in range(8)]
    assert found == [(2, 0, 0, 0, 0, 0), (0, 1, 0, 0, 0, 0), (0, 0, 1, 0, 0, 0), (0, 0, 0, 1, 0, 0), (0, 0, 0, 0, 1, 0), (0,) * 6, (0,) * 6, (0, 0, 0, 0, 0, 1)]
    assert all(t not in got[i].text for i, t in enumerate(["10.0.0.99", "4111111111111111", "123-45-6789", "2020-01-02", "1234567"]))
    back = collected(pseudonyms.restore(docs(spark, [(i, got[i].text) for i in range(7)]), KEY))
    assert all(back[i].text == texts[i] for i in range(7))
