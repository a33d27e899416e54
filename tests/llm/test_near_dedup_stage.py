from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxelloom.llm import near_dedup

from .helpers import docs, prose
from .test_pairs_and_scans import brute_components, near_rows, shingles


def groups_at(rows, percent):
    """The group of each row by brute force."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def test_stage_drops_copies_from_similarity_80(spark):
    r = random.Random(4)
    rows = []
    for k in range(25):
        w = prose(600 + k, 200).split()
        rows.append((10 * k, " ".join(w)))
        for j in range(1, 5):  # j changed words at least ten apart break 5 shingles each: similarity 0.95 down to 0.82
            c = list(w)
            for at in r.sample(range(10, 190, 10), j):
                c[at] = f"x{k}{j}{at}"
            rows.append((10 * k + j, " ".join(c)))
    for k in range(40):  # pairs that lie between 0.80 and 0.85, and just under 0.80
        w = prose(700 + k, 200).split()
        c = list(w)
        for at in range(10, 10 * (5 if k % 2 else 4), 10):
            c[at] = f"y{k}{at}"
        c[190:] = prose(800 + k, 4 + k % 3).split()
        rows += [(1000 + 2 * k, " ".join(w)), (1001 + 2 * k, " ".join(c))]
    least = {}
    for (i, _), g in zip(rows, groups_at(rows, 80), strict=True):
        least[g] = min(i, least.get(g, i))
    assert len(set(groups_at(rows, 85))) > len(least)
    got = corpus_pipeline.drop_near_duplicates(spark, docs(spark, rows), "")
    assert sorted(x.doc_id for x in got.collect()) == sorted(least.values())


def test_rows_that_share_an_id_are_decided_one_by_one(spark):
    a, b, c, d = (prose(900 + k, 60) for k in range(4))
    rows = [(2, a), (5, a), (5, b), (7, c), (7, d), (7, d), (8, d), (9, b), (9, None), (9, ""), (10, "")]
    kept = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark, rows), "").collect())
    assert kept == sorted([(2, a), (5, b), (7, c), (7, d), (9, ""), (9, ""), (10, "")])
    once = sorted((r.doc_id, r.text or "") for r in near_dedup.drop_near_duplicates(docs(spark, rows)).collect())
    assert once[:2] == [(2, a), (5, b)] and [i for i, _ in once] == [2, 5, 7, 9, 10]


def shared_passage(n=40, tail=25):
    """Texts that share a passage of 100 words and link only where their ends are alike."""
    passage = prose(31, 100)
    rows = [(k, passage + " " + prose(5000 + k, tail)) for k in range(n)]
    for k in range(6):  # some link across: one word of the end changed
        w = rows[k][1].split()
        w[112] = f"z{k}"
        rows.append((n + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("few,hot", [(1, 3), (8, 10)])
def test_large_buckets_and_hot_keys_lose_no_link(spark, few, hot):
    rows = near_rows() + [(2000 + i, t) for i, t in shared_passage()]
    want, _ = brute_components(rows)
    plan = near_dedup.Plan(few=few, hot_rows=hot)
    got = near_dedup.near_duplicates(docs(spark, rows), plan).collect()
    key = lambda i, n, c: (i is None, i or 0, n, c is None, c or 0)
    assert sorted(key(r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(key(i, len(shingles(t)), c) for (i, t), c in zip(rows, want, strict=True))


def test_rare_shingles_meet_every_link_and_no_shared_passage(spark):
    rows = shared_passage()
    plan = near_dedup.Plan()
    table = docs(spark, rows)
    classes = near_dedup.signed(table, plan).select("cls", F.col("doc_id").alias("first_id"), F.col("n_shingles").alias("n"), "sig", "bits")
    pairs = near_dedup._rare(table, classes.cache(), classes.select("cls", F.col("cls").alias("label"), "sig"), plan)
    ids = {bytes(r.cls): r.first_id for r in classes.collect()}
    got = {tuple(sorted((ids[bytes(r.a)], ids[bytes(r.b)]))) for r in pairs.collect()}
    sets = {i: shingles(t) for i, t in rows}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert links and links <= got and len(got) < 2 * len(links)


def test_columns_of_any_name_pass_the_stage(spark):
    a, b = prose(41, 60), prose(42, 60)
    names = ["_id", "row", "_p", "_w", "_m", "_cls", "cls", "label", "kept", "w", "again"]
    table = docs(spark, [(1, a), (2, a), (3, b), (3, a), (None, a)]).select("doc_id", "text", *(F.lit(n).alias(n) for n in names))
    out = corpus_pipeline.drop_near_duplicates(spark, table, "")
    assert out.columns == table.columns and sorted((r.doc_id or 0, r.text, r["_w"]) for r in out.collect()) == sorted([(1, a, "_w"), (3, b, "_w"), (0, a, "_w")])


def test_copies_only_move_their_own_texts(spark):
    rows = [(i, prose(2000 + i, 40)) for i in range(300)] + [(1000 + i, prose(2000 + i, 40)) for i in range(5)]
    plan = near_dedup.Plan()
    clear, held = near_dedup._sieved(docs(spark, rows), spark.createDataFrame([(1000 + i,) for i in range(5)], "doc_id long"), plan)
    assert held.count() + clear.count() == len(rows) and {1000, 1004} <= {r[0] for r in held.select("_id").collect()} and held.count() < 30


def test_no_join_moves_texts_before_the_sieve(spark):
    rows = [(i, prose(2000 + i, 40)) for i in range(50)]
    named = spark.createDataFrame([(7,)], "doc_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = near_dedup._sieved(docs(spark, rows), named, near_dedup.Plan())[1]
        plan = held.join(named, held["_id"] == named["doc_id"], "left_anti")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.index("shiftright")
