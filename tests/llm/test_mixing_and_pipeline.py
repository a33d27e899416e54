from __future__ import annotations

import random
from collections import Counter

import numpy as np

from voxelloom.llm import mixing

from .helpers import collected, docs, prose, space_words


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest, w = total - sum(2 * sizes[s] for s in full), sum(weight[s] for s in names if s not in full)
        new = {s for s in names if s not in full and rest * weight[s] / w > 2 * sizes[s]}
        if not new:
            return {s: 2 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        full |= new


def mix_rows():
    r = random.Random(6)
    sources = ["b", "a", "Z", "é", None, "hot", "hot", "hot", ""]
    rows = [(i, prose(i, r.randrange(0, 200)), None, sources[i % 9]) for i in range(500)]
    return rows + [(7, None, None, "a"), (7, "", None, "a"), (None, "one two three", None, None), (11, rows[11][1], None, rows[11][3]), (900, "word " * 5000, None, "huge")]


def test_targets_and_taken(spark):
    rows = mix_rows()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(space_words(text))
    got = mixing.mixture(docs(spark, rows)).collect()
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(d.words for d in r.draws)
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mixture(docs(spark, rows).repartition(7)).collect()
    key = lambda r: str((r.doc_id, r.source, r["size"], r.taken, r.draws))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_of_nothing(spark):
    assert mixing.mixture(docs(spark, [])).count() == 0
    blank = mixing.mixture(docs(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [(r["size"], r.taken, r.target) for r in blank] == [(0, 0, 0.0)] * 2


def test_tree_splits_exactly():
    quotas = np.array([1000, 3, 0, 517, 80])
    for shards in (1, 2, 7, 64):
        split = mixing.split_tree(quotas, shards, 5)
        assert (split.sum(axis=0) == quotas).all() and (split >= 0).all()
        assert split.sum(axis=1).max() - split.sum(axis=1).min() <= 1
    # on average a shard holds its share of each source
    mean = np.mean([mixing.split_tree(quotas, 4, s) for s in range(300)], axis=0)
    assert np.abs(mean - quotas / 4).max() < 3


def test_mixed_rows_hold_the_draws(spark):
    rows = mix_rows() + [(11, mix_rows()[11][1], None, mix_rows()[11][3])] * 3
    recipe = mixing.Recipe(shard_words=5000)
    table = docs(spark, rows)
    plan, out = mixing.mixture(table, recipe), mixing.mixed(table, recipe).collect()
    want = Counter()
    for r in plan.collect():
        for d in r.draws:
            want[r.doc_id, d.shard, d.words] += 1
    assert Counter((r.doc_id, r.mix_shard, r.mix_words) for r in out) == want
    assert all(len(space_words(r.text)) == r.mix_words for r in out) and len({r.mix_shard for r in out}) > 5


def test_pipeline_keeps_what_is_clean(spark, tmp_path):
    import corpus_pipeline

    from .test_pairs_and_scans import brute_components, brute_hits

    r = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        w = prose(i, 80, 3000).split()
        bad = i % 5 == 1
        if bad:
            for _ in range(4):
                w[r.randrange(80)] = r.choice(["vile", "nasty", "rotten"])
        rows.append((i, " ".join(w), "en", f"s{i % 4}"))
        labels.append((i, 1, int(bad)))
    bench = [(k, prose(5000 + k, 30, 3000)) for k in range(5)]
    rows += [(500, prose(2, 80, 3000), "en", "s0"), (501, prose(5001, 30, 3000) + " tail words", "en", "s1"), (502, "password = hunter2hunter2 " + prose(77, 60, 3000), "en", "s2"), (503, None, None, None), (504, "", "en", "s3")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    state = {"toxicity": None}
    for name, stage in corpus_pipeline.STAGES:
        before = {x.doc_id: x.text for x in table.collect()}
        stage(spark, table, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
        after = {x.doc_id: x.text for x in table.collect()}
        if name != "mixing":
            assert table.columns == docs(spark, []).columns
        if name == "toxicity":
            gone = set(before) - set(after)
            assert gone <= {i for i in range(400) if i % 5 == 1} and len(gone) >= 76
        elif name == "near_dedup":
            pairs = [(i, t) for i, t in before.items()]
            want, _ = brute_components(pairs)
            assert set(after) == {i for (i, _), c in zip(pairs, want, strict=True) if c == i} and 500 not in after
        elif name == "decontamination":
            assert set(after) == {i for i, *_, hit in brute_hits(list(before.items()), bench) if not hit} and 501 not in after
        elif name == "secrets":
            assert set(after) == set(before) and after[502].startswith("[SECRET]")
        state[name] = len(after)
    final = {x.doc_id for x in table.collect()}
    assert final <= set(before) and 501 not in final
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == table.count()


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


def test_draws_collected(spark):
    got = collected(mixing.mixture(docs(spark, [(1, "a b c d", None, "s"), (2, "a b", None, "t")])))
    assert got[1].taken + got[2].taken == 9


def test_mixing_stage_cuts_no_text(spark):
    import corpus_pipeline

    rows = [r for r in mix_rows() if r[0] not in (7, 11, None)]
    texts, sizes, taken = {r[0]: r[1] for r in rows}, Counter(), Counter()
    longest = Counter()
    for _, text, _, source in rows:
        n = len(space_words(text))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    for r in corpus_pipeline.mix_sources(spark, docs(spark, rows), "").collect():
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text) and r.mix_words == len(space_words(r.text))
        taken[r.source] += r.mix_words
    want = brute_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1 for s in sizes)
    plan = mixing.mixture(docs(spark, rows), corpus_pipeline.WHOLE).collect()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in plan) and sum(r.taken for r in plan) == sum(taken.values())


def test_repeated_rows_at_the_limit_are_drawn_alike(spark):
    rows = [(5, "a b c d e", None, "s")] * 7 + [(6, prose(6, 40), None, "t")] * 2 + [(None, "x y z", None, "u")] * 30
    for recipe in (mixing.Recipe(), mixing.Recipe(whole_documents=True), mixing.Recipe(block_bits=1)):
        plan, out = mixing.mixture(docs(spark, rows), recipe).collect(), mixing.mixed(docs(spark, rows), recipe).collect()
        assert len(plan) == len(rows) and len({r.taken for r in plan if r.doc_id == 5}) == 1
        assert Counter((r.doc_id, d.shard, d.words) for r in plan for d in r.draws) == Counter((r.doc_id, r.mix_shard, r.mix_words) for r in out)


def test_more_shards_than_leaves(spark):
    rows = mix_rows()
    few, many = (mixing.mixture(docs(spark, rows), mixing.Recipe(shard_words=500, most_leaves=n)).collect() for n in (4, 8192))
    assert sorted((r.doc_id or 0, r.taken) for r in few) == sorted((r.doc_id or 0, r.taken) for r in many)
    assert max(d.shard for r in few for d in r.draws) > 40


def test_mixed_passes_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    names = ["left", "whole", "draws", "end", "block_words", "_id", "_size", "_draw", "row", "size", "h", "block", "parts", "target", "_s", "extra"]
    table = docs(spark, [(i, prose(i, 20), None, "s") for i in range(9)]).select("doc_id", "text", "source", *(F.lit(n).alias(n) for n in names))
    out = mixing.mixed(table)
    assert out.columns == [*table.columns, "mix_shard", "mix_place", "mix_words"] and out.filter("left = 'left' and `_id` = '_id' and size = 'size'").count() == out.count() > 9
    again = mixing.mixed(out)
    assert again.columns == out.columns and again.count() > 0
