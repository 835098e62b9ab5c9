from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from larder.llm import simhash
from larder.llm.components import components


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, near):
    """Least node reachable, by following all links."""
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(found[a], found[b])
            if found[a] != low or found[b] != low:
                found[a] = found[b] = low
                changed = True
    return found


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ſ", "K", "x y"]
    bases = [rng.choices(vocabulary, k=rng.randint(1, 200)) for _ in range(40)]
    texts = [None, "", " \n", "\x85", "one", "One", "two words", "A b c d"]
    for words in bases:
        texts.append(" ".join(words))
        for _ in range(3):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append("\n".join(copy))
    docs = spark.createDataFrame([(i * 7 % 1009, t) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = roots(prints, near)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints}


def near_values(seed=2, groups=6, size=60):
    rng = random.Random(seed)
    values = {0, (1 << 64) - 1}
    for _ in range(groups):
        at = rng.getrandbits(64)
        for _ in range(size):
            values.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        hub = rng.getrandbits(64)
        values |= {hub ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(20, 28)}
    return sorted(v - (1 << 64) if v >> 63 else v for v in values)


def test_every_link_is_kept_at_any_bucket_size(spark):
    values = near_values()
    unsigned = np.array(values, np.int64).view(np.uint64)
    near = [(values[i], values[j]) for i in range(len(values)) for j in range(i)
            if int(unsigned[i] ^ unsigned[j]).bit_count() <= 3]
    want = roots(values, near)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    for bucket in (1, 3, simhash.BUCKET):
        found = {r.node: r.root for r in components(simhash.links(nodes, bucket)).collect()}
        assert {v: found.get(v, v) for v in values} == want


def test_levels_cover_all_bits_and_end_bounded():
    level = [tuple(range(64))]
    for _ in range(3):
        level = [left for bits in level[:1] for _, left in simhash._masks(bits)]
        assert len(level) == 20
    assert max(map(len, level)) <= 9


def test_components_of_random_links(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5000, 5000 + i) for i in range(300)] + [(7, 7), (1, 2), (1, 2)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    want = roots(nodes, [(a, b) for a, b in edges if a != b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(want.items())


def test_keep_one_of_each_group_with_ties_nulls_and_clashes(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(5, long, "a"), (3, long + " ", "b"), (3, long, "c"), (None, long, "d"), (None, "apart from all of them", "e"),
            (None, "apart from all of them", "f"), (9, None, "g"), (8, "", "h"), (7, "quite another text here", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got, key=str) == sorted([3, None, 8, 7], key=str)
    empty = spark.createDataFrame([], docs.schema)
    assert simhash.keep_one(empty).collect() == [] == simhash.near_duplicates(empty).collect()


def test_unrelated_texts_that_share_an_id_are_all_kept(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in ("north", "south", "east"))
    rows = [(1, a), (1, b), (1, b + " "), (2, a), (3, c), (3, a), (3, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text.strip()) for r in simhash.keep_one(docs).collect())
    assert got == sorted([(1, a), (1, b), (3, c)])
