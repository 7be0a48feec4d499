import random
from collections import Counter

import pytest

from brezza.llm import packing, queries


def check(rows, capacity, documents):
    """Parts cover each document once and in order, containers hold no more than they can, and only what exceeds them is cut."""
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert Counter(r.doc_id for r in rows if r.part == 0) == Counter(k for k, _ in documents)
    fill = Counter()
    for r in rows:
        if r.container is not None:
            fill[r.container] += r.tokens
    assert not fill or max(fill.values()) <= capacity
    for k, size in documents:
        parts = [r for r in by[k]]
        size = max(size or 0, 0)
        repeats = sum(1 for d, _ in documents if d == k)
        assert sum(r.tokens for r in parts) == sum(max(s or 0, 0) for d, s in documents if d == k)
        if repeats == 1:
            assert len(parts) == max(1, -(-size // capacity))
            at = 0
            for r in sorted(parts, key=lambda r: r.part):
                assert r.start == at
                at += r.tokens
        if size == 0 and repeats == 1:
            assert parts[0].container is None
    return len(fill)


def packed(spark, documents, capacity, **columns):
    df = spark.createDataFrame(documents, "doc_id bigint, tokens bigint")
    return packing.pack(df, "doc_id", "tokens", capacity).collect()


def test_nulls_zero_long_and_repeated(spark):
    documents = [(1, 5), (2, None), (3, 0), (4, 100), (5, 37), (6, 10), (7, 20), (None, 3), (8, -4), (9, 10), (9, 10)]
    rows = packed(spark, documents, 10)
    # 100 fills ten, 37 three with 7 left, 20 two, the three 10s one each; 5, 7 and 3 need two more.
    assert check(rows, 10, documents) == 20
    assert packed(spark, [], 10) == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame(documents, "doc_id bigint, tokens bigint"), "doc_id", "tokens", 0)


def test_little_room_is_left(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 200)
    chance = random.Random(4)
    documents = [(k, int(chance.paretovariate(0.9) * 40)) for k in range(3000)]
    rows = packed(spark, documents, 2048)
    used = check(rows, 2048, documents)
    fewest = sum(s // 2048 for _, s in documents) + -(-sum(s % 2048 for _, s in documents) // 2048)
    assert used <= fewest * 1.01 + 1


def test_one_document_holds_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 100)
    documents = [(1, 700)] * 500 + [(k, 600) for k in range(2, 1000)]
    df = spark.createDataFrame(documents, "doc_id bigint, tokens bigint")
    rows = packing.pack(df, "doc_id", "tokens", 2000).collect()
    fill = Counter()
    for r in rows:
        fill[r.container] += r.tokens
    assert len(rows) == len(documents) and max(fill.values()) <= 2000
    assert len(fill) <= sum(s for _, s in documents) / 2000 * 1.06


def hard(n, seed, kind):
    """Sizes between a quarter and a half of the capacity, or triples that fill containers exactly."""
    chance = random.Random(seed)
    if kind == "quarter to half":
        return [chance.randrange(512, 1024) for _ in range(n)]
    sizes = []
    while len(sizes) < n:
        a, b = chance.randrange(532, 778), chance.randrange(532, 778)
        sizes += [a, b, 2048 - a - b]
    return sizes


def test_evolution_beats_or_equals_best_fit():
    chance = random.Random(7)
    for n in (1, 2, 40, 300):
        sizes = [chance.randrange(200, 900) for _ in range(n)]
        plain = packing.best_fit(sizes, sorted(range(n), key=lambda i: -sizes[i]), 1000)
        best = packing.evolve(sizes, 1000, 3)[0]
        assert sorted(i for b in best for i in b) == list(range(n))
        assert all(sum(sizes[i] for i in b) <= 1000 for b in best)
        assert len(best) <= len(plain)


@pytest.mark.parametrize("kind", ["quarter to half", "triples"])
@pytest.mark.parametrize("island", range(packing.ISLANDS))
def test_each_island_gains_over_best_fit_with_the_settings_of_the_query(kind, island):
    sizes = hard(600, 5, kind)
    plain = packing.best_fit(sizes, sorted(range(600), key=lambda i: -sizes[i]), 2048)
    assert len(packing.evolve(sizes, 2048, 5, island=island)[0]) < len(plain) * 0.97


@pytest.mark.parametrize("kind", ["quarter to half", "triples"])
def test_the_operator_gains_over_best_fit(spark, kind):
    """With the query's own settings, shards and all, against best fit of all items at once."""
    sizes = hard(3000, 6, kind)
    plain = packing.best_fit(sizes, sorted(range(3000), key=lambda i: -sizes[i]), 2048)
    documents = list(enumerate(sizes))
    used = check(packed(spark, documents, 2048), 2048, documents)
    assert used < len(plain) * 0.97, (used, len(plain), -(-sum(sizes) // 2048))


def test_containers_do_not_depend_on_partitions(spark):
    chance = random.Random(2)
    documents = [(k, chance.randrange(1, 3000)) for k in range(2500)] + [(7, 300)] * 3
    results = []
    for partitions in (1, 7):
        chance.shuffle(documents)
        df = spark.createDataFrame(documents, "doc_id bigint, tokens bigint").repartition(partitions)
        results.append(sorted((r.container or "", r.doc_id, r.part, r.tokens) for r in packing.pack(df, "doc_id", "tokens").collect()))
    assert results[0] == results[1]


def test_invariants_tell_a_bad_packing(spark):
    sized = spark.createDataFrame([(1, 10), (2, 25), (3, None), (4, 5)], "doc_id bigint, tokens bigint")
    rows = [(1, 0, 0, 10, "a"), (2, 0, 0, 25, "b"), (3, 0, 0, 0, None), (4, 0, 0, 4, "a")]
    bad = spark.createDataFrame(rows, "doc_id bigint, part int, start bigint, tokens bigint, container string")
    got = {r.doc_id: (r.kept, r.fits, r.unsplit) for r in packing.invariants(bad, sized, "doc_id", "tokens", 12).collect()}
    assert got == {1: (True, False, True), 2: (True, False, False), 3: (True, True, True), 4: (False, False, True)}


def test_crossover_keeps_every_item_once():
    chance = random.Random(3)
    sizes = [chance.randrange(1, 700) for _ in range(100)]
    order = list(range(100))
    parents = []
    for _ in range(2):
        chance.shuffle(order)
        parents.append(packing.best_fit(sizes, order, 1000))
    for _ in range(50):
        child = packing.crossover(sizes, *parents, 1000, chance)
        assert sorted(i for b in child for i in b) == list(range(100))
        assert all(sum(sizes[i] for i in b) <= 1000 for b in child)
        parents = [child, parents[0]]


def test_corpus(spark, small):
    rows = queries.p8_packed(spark, small).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.doc_id] += r.tokens
    ids = {r.doc_id: len(r.ids) for r in queries.p7_ids(spark, small).collect()}
    assert dict(sizes) == ids
    check(rows, 2048, list(ids.items()))
