"""The search of buckets by count vectors against all pairs."""

from itertools import combinations

import numpy as np

from tallymart.llm import components, count_vector_join
from tallymart.session import write_through


def _sets(draw):
    base = draw.integers(1, 1 << 60, 90).astype(np.uint64)
    return [np.unique(np.append(base[draw.random(90) > 0.1 * (at % 4)], draw.integers(1, 1 << 60, at % 9).astype(np.uint64))) for at in range(40)]


def test_pairs_of_points_hold_every_link():
    draw, sizes = np.random.default_rng(2), count_vector_join.Sizes(80)
    sets = _sets(draw)
    size, every = np.array([len(one) for one in sets]), np.arange(len(sets))
    points = np.array([np.frombuffer(count_vector_join.count_vector(one, 64), "<u4") for one in sets]).astype("u1")
    classes = draw.integers(0, 20, len(sets))
    found = count_vector_join.near_pairs(every, every, classes, points, size, sizes)
    found = {(min(a, b), max(a, b)) for a, b in found.tolist()}
    linked, expected = set(), set()
    for a, b in combinations(range(len(sets)), 2):
        if classes[a] != classes[b]:
            shared = len(np.intersect1d(sets[a], sets[b]))
            if shared >= sizes.overlap(int(size[a]), int(size[b])):
                linked.add((a, b))
            if np.minimum(points[a], points[b]).sum() >= sizes.overlap(int(size[a]), int(size[b])):
                expected.add((a, b))
    expected = {(a, b) for a, b in expected if min(size[a], size[b]) * 5 >= max(size[a], size[b]) * 4}
    assert linked and linked <= found == expected
    buckets = [every[at : at + count] for count in (2, 7, 16) for at in range(0, 40 - count, 3)]
    inside = {(a, b) for bucket in buckets for a, b in combinations(bucket.tolist(), 2)} & expected
    leaf = count_vector_join.leaf_pairs(buckets, classes, points, size, sizes, every)
    assert {(min(a, b), max(a, b)) for a, b in leaf.tolist()} == inside
    assert len(leaf) == len(inside)


def test_crowded_buckets_give_the_same_classes(spark, monkeypatch):
    draw = np.random.default_rng(4)
    words = [f"w{at}" for at in range(200)]
    rows = []
    for doc in range(60):
        text = list(words)
        for at in draw.integers(0, 200, doc % 14):
            text[at] = f"x{draw.integers(1 << 30)}"
        rows.append((doc, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def classes():
        found = count_vector_join.near_duplicates(docs, size=3, percent=80).select("id", "n_shingles", "component_id")
        return sorted(map(tuple, found.collect()))

    expected = classes()
    monkeypatch.setattr(count_vector_join, "CROWD", -1)
    assert classes() == expected


def test_families_keep_few_pairs_and_lose_no_link():
    draw, sizes = np.random.default_rng(3), count_vector_join.Sizes(80)
    sets = _sets(draw)
    size, every = np.array([len(one) for one in sets]), np.arange(len(sets))
    points = np.array([np.frombuffer(count_vector_join.count_vector(one, 64), "<u4") for one in sets]).astype("u1")
    classes, family = every % 25, every.copy()
    found = count_vector_join.near_pairs(every, every, classes, points, size, sizes)
    kept = count_vector_join.near_pairs(every, every, classes, points, size, sizes, family)
    assert len(kept) < len(sets) < len(found)
    assert all(family[a] == family[b] for a, b in found.tolist())
    merged = classes.copy()
    links = count_vector_join.linked_pairs(every, every, merged, sets, 64, sizes)
    assert len(links) < len(sets)
    for a, b in combinations(range(len(sets)), 2):
        if len(np.intersect1d(sets[a], sets[b])) >= sizes.overlap(int(size[a]), int(size[b])):
            assert merged[a] == merged[b]
    for a, b in links.tolist():
        assert len(np.intersect1d(sets[a], sets[b])) >= sizes.overlap(int(size[a]), int(size[b]))


def test_a_group_of_near_copies_writes_rows_in_proportion_to_its_size(spark, monkeypatch):
    written = []

    def counted(df, label="stage"):
        out = write_through(df, label)
        if label in ("near", "edges", "families"):  # what the searches find
            written.append(out.count())
        return out

    monkeypatch.setattr(count_vector_join, "write_through", counted)
    monkeypatch.setattr(components, "write_through", counted)
    draw, count, rows = np.random.default_rng(5), 120, []
    for doc in range(count):  # all share most words, most pairs are a little too far apart to link
        text = [f"w{at}" for at in range(200)]
        for at in draw.choice(200, 4, replace=False):
            text[at] = f"x{doc}_{at}"
        rows.append((doc, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert count_vector_join.near_duplicates(docs, size=3, percent=80).count() == count
    assert count // 2 < max(written) < 2 * count


def test_blocks_of_a_large_group_give_the_same_classes(spark, monkeypatch):
    draw, rows = np.random.default_rng(6), []
    for doc in range(70):
        text = [f"w{at}" for at in range(150)]
        for at in draw.integers(0, 150, doc % 9):
            text[at] = f"x{draw.integers(1 << 30)}"
        rows.append((doc, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def classes():
        found = count_vector_join.near_duplicates(docs, size=3, percent=80).select("id", "n_shingles", "component_id")
        return sorted(map(tuple, found.collect()))

    expected = classes()
    for name, value in (("BLOCK", 16), ("KIN", 8), ("LOT", 40), ("TEXTS", 10)):
        monkeypatch.setattr(count_vector_join, name, value)
    assert classes() == expected
