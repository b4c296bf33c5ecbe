"""Grouping and duplicates against plain versions of their definitions."""

import random
from datetime import datetime, timedelta

from quillmesh.operators import duplicates, similarity


def plain_groups(pairs, source, threshold):
    sims = {frozenset((a, b)): s for s, a, b in pairs}
    groups = [[i] for i in sorted(source)]
    for s, a, b in sorted((p for p in pairs if p[0] >= threshold), reverse=True):
        x, y = (next(g for g in groups if i in g) for i in (a, b))
        if x is y or {source[i] for i in x} & {source[i] for i in y}:
            continue
        if sum(sims.get(frozenset((i, j)), 0) for i in x for j in y) / (len(x) * len(y)) >= threshold:
            groups.remove(y)
            x += y
    return {i: min(g) for g in groups for i in g}


def test_grouping_is_that_of_the_definition():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(2, 12)
        source = {i: f"s{rng.randint(0, 6)}" for i in range(n)}
        pairs = [(round(rng.random() * 0.5, 2), a, b) for a in range(n) for b in range(a + 1, n) if source[a] != source[b] and rng.random() < 0.7]
        assert similarity.grouped(pairs, source, 0.18) == plain_groups(pairs, source, 0.18)


def test_stories_on_tables(spark):
    docs = spark.createDataFrame([("s", 1, i, f"src{i % 3}", False) for i in range(6)] + [("t", 1, 9, "x", False)], "segment string, window_end int, item_id long, source_key string, recurring boolean")
    pairs = spark.createDataFrame([("s", 1, 0, 1, 0.9), ("s", 1, 1, 2, 0.5), ("s", 1, 0, 2, 0.1), ("s", 1, 3, 4, 0.17)], "segment string, window_end int, a long, b long, s double")
    got = {r["item_id"]: r["story"] for r in similarity.stories(pairs, docs).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 9: 9}
    close = {r["item_id"]: r["similarity"] for r in similarity.closeness(similarity.stories(pairs, docs), pairs).collect()}
    assert close == {0: 0.9, 1: 0.9, 2: 0.5, 3: 1.0, 4: 1.0, 5: 1.0, 9: 1.0}


def test_large_numbers_stay_exact(spark):
    big = 2**62
    docs = spark.createDataFrame([("s", 1, big + i, f"src{i}", False) for i in range(3)], "segment string, window_end int, item_id long, source_key string, recurring boolean")
    pairs = spark.createDataFrame([("s", 1, big, big + 1, 0.9)], "segment string, window_end int, a long, b long, s double")
    assert {r["item_id"]: r["story"] for r in similarity.stories(pairs, docs).collect()} == {big: big, big + 1: big, big + 2: big + 2}


def test_names_count_a_quarter(spark):
    docs = spark.createDataFrame([("s", 1, 1, "a", ["x", "y"], False), ("s", 1, 2, "b", ["y", "z"], False), ("s", 1, 3, "c", [], False), ("s", 1, 4, "d", ["z"], True)], "segment string, window_end int, item_id long, source_key string, names array<string>, recurring boolean")
    vectors = spark.createDataFrame([("s", 1, 1, "t", 0.6), ("s", 1, 1, "u", 0.8), ("s", 1, 2, "t", 1.0), ("s", 1, 3, "u", 1.0), ("s", 1, 4, "t", 1.0)], "segment string, window_end int, item_id long, token string, w double")
    got = {(r["a"], r["b"]): round(r["s"], 6) for r in similarity.similar(vectors, docs).collect()}
    assert got == {(1, 2): round(0.75 * 0.6 + 0.25 / 3, 6), (1, 3): 0.8}


def test_duplicates_are_those_of_the_definition(spark):
    rng = random.Random(2)
    start = datetime(2026, 1, 1)
    rows = [(f"m{i:03}", f"s{rng.randint(0, 3)}@x", rng.choice(["A b", "a  B", "C"]), rng.choice([None, start + timedelta(minutes=rng.randint(0, 2000))]) if i % 9 == 0 else start + timedelta(minutes=rng.randint(0, 2000)), rng.choice([100, 105, 120, None, 0]), rng.choice(["real", "unmatched"])) for i in range(300)]
    want, groups = {}, {}
    for r in rows:
        groups.setdefault((r[1], " ".join(r[2].split()).lower()), []).append(r)
    for own in groups.values():
        canon = []
        for r in sorted(own, key=lambda r: (r[5] == "unmatched", r[3] or datetime.max, r[0])):
            w = r[4] or 0
            of = next((c for c in canon if r[3] and c[3] and abs(r[3] - c[3]) <= timedelta(hours=3) and (not max(w, c[4] or 0) or abs(w - (c[4] or 0)) / max(w, c[4] or 0) <= 0.10)), None)
            if of:
                want[r[0]] = of[0]
            else:
                canon.append(r)
    messages = spark.createDataFrame(rows, "gmail_id string, sender_email string, subject string, sent_date timestamp, word_count int, segment string")
    assert {r["gmail_id"]: r["duplicate_of"] for r in duplicates.duplicates(messages).collect()} == want
