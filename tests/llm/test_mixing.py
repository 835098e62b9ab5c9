from __future__ import annotations

import random
from collections import defaultdict

import pytest
from larder.llm import mixing


def test_one_round_keeps_every_block_in_its_window():
    rng = random.Random(1)
    for shares in ([1], [3, 2], [50, 1, 1, 1, 1], [rng.randint(1, 60) for _ in range(25)]):
        length = sum(shares)
        plan = mixing.round_of(shares)
        assert sorted(slot for _, _, slot in plan) == list(range(length))
        assert sorted((i, k) for i, k, _ in plan) == [(i, k) for i, n in enumerate(shares) for k in range(n)]
        done = [0] * len(shares)
        for i, k, slot in plan:
            assert k * length // shares[i] <= slot < -(-(k + 1) * length // shares[i])
            done[i] += 1
            for j, n in enumerate(shares):
                assert abs(done[j] - (slot + 1) * n / length) < 1


def test_ticks_are_in_proportion_and_positive():
    assert mixing.ticks([1, 1, 2], 100) == [25, 25, 50]
    found = mixing.ticks([1e-9, 1, 1], 10)
    assert min(found) >= 1 and mixing.ticks([], 10) == []
    with pytest.raises(ValueError):
        mixing.ticks([0, 1])


def test_exact_weights_of_many_and_of_tiny_sources_are_kept():
    for weights in ([0.99999, 0.00001], [10_000.0] + [1.0] * 20_000):
        shares = mixing.ticks(weights)
        for w, n in zip(weights, shares):
            assert abs(n / sum(shares) - w / sum(weights)) < 1e-9
        blocks = [min(40_000, n) if i == 0 else 3 for i, n in enumerate(shares)]
        done = 0
        for i, k, release, slot, deadline in mixing.plan_of(shares, blocks):
            assert release <= slot < deadline
            done += i == 0
            if done < blocks[0]:
                assert abs(done - (slot + 1) * weights[0] / sum(weights)) < 1


def test_the_targets_of_a_table_are_the_weights(spark):
    rows = [(i, "a" * 100, "hot") for i in range(300)] + [(1000 + i, "a" * 10, f"s{i}") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"hot": 10_000.0} | {f"s{i}": 1.0 for i in range(20_000)}
    hot = mixing.mixed(docs, weights, block_chars=100).where("source = 'hot'").orderBy("slot").collect()
    assert abs(hot[0].source_ticks / hot[0].round_ticks - 1 / 3) < 1e-9
    assert all(abs(r.block + 1 - (r.slot + 1) / 3) < 1 for r in hot)


def test_more_sources_than_the_driver_holds_are_planned(spark):
    docs = spark.range(100_500).selectExpr("id AS doc_id", "'ab' AS text", "concat('s', id) AS source")
    assert mixing.mixed(docs).select("slot").distinct().count() == 100_500


def source_table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        source = "big" if i % 3 == 0 else ["x", "y", None, ""][i % 4]
        rows.append((i, rng.choice([None, "", "a" * rng.randint(1, 400)]), source, i))
    return spark.createDataFrame(rows + rows[:5], "doc_id long, text string, source string, slot int")


def test_every_row_has_one_place_and_prefixes_hold_the_targets(spark):
    docs = source_table(spark)
    weights = {"big": 1, "x": 2, "y": 2, None: 1, "": 4}
    got = mixing.mixed(docs, weights, block_chars=500, resolution=100).collect()
    assert len(got) == docs.count()
    assert sorted((r.doc_id, str(r.source)) for r in got) == sorted((r.doc_id, str(r.source)) for r in docs.collect())
    slots, offsets = defaultdict(set), defaultdict(int)
    for r in got:
        assert r.release <= r.slot < r.deadline
        slots[r.slot].add((r.source, r.block))
    assert all(len(s) == 1 for s in slots.values())
    for source in weights:
        own = sorted((r for r in got if r.source == source), key=lambda r: (r.offset, r.slot))
        at = 0
        for n, r in enumerate(sorted(own, key=lambda r: (r.offset, r.chars))):
            assert r.offset == at and r.block == at // 500
            at += r.chars
    # Up to the slot in which the first source ends, all of them are within a block.
    taken = defaultdict(set)
    last = min(max(r.slot for r in got if r.source == s) for s in weights)
    shares = {r.source: r.source_ticks / r.round_ticks for r in got}
    holders = {slot: next(iter(s))[0] for slot, s in slots.items()}
    for slot in range(last):
        if slot in holders:
            taken[holders[slot]].add(slot)
        for s in weights:
            assert abs(len(taken[s]) - (slot + 1) * shares[s]) < 1
    del offsets


def test_order_is_the_same_twice_and_all_columns_stay(spark):
    docs = source_table(spark)
    a, b = (mixing.in_mix_order(docs, block_chars=500) for _ in range(2))
    assert a.columns == docs.columns
    first = a.collect()
    assert [r.doc_id for r in first] == [r.doc_id for r in b.collect()]
    assert sorted(map(str, first)) == sorted(map(str, docs.collect()))


def test_empty_table_and_missing_weight(spark):
    docs = source_table(spark)
    assert mixing.mixed(docs.limit(0)).collect() == []
    assert mixing.in_mix_order(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"big": 1})
