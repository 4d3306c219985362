import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import ngram_join
from riskloom.llm.components import connected_components
from riskloom.llm.ngram_join import JaccardRule, bitmap, jaccard_components, rare_gram_pairs, tile_keys
from tests.llm import brute
from tests.llm.conftest import EDGE


def near_copies(seed, n, most_changes):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, most_changes)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 12, 40, 90, 400]))
        rows.append((1000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 60)])
def test_matches_brute_force(documents_of, n, percent):
    rows = near_copies(n, 150, 3)
    out = jaccard_components(documents_of(rows), JaccardRule(words=n, percent=percent)).collect()
    want = brute.components(rows, n, percent)
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    sizes = {i: len(brute.grams(brute.blanks(brute.low(t)), n)) for i, t in rows}
    assert {r["doc_id"]: r["n_shingles"] for r in out} == sizes


def test_shuffled_fallback_gives_the_same(documents_of):
    rows = near_copies(9, 80, 2)
    rule = JaccardRule(small_rows=0)
    out = jaccard_components(documents_of(rows), rule).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == brute.components(rows)


def shared_passage(seed, n, own, shared=120):
    """Texts that share a long passage and are else unlike, some with a near copy."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(shared)]
    rows = []
    for i in range(n):
        if i % 10 == 9:
            words = rows[-1][1].split()
            words[rng.randrange(len(words))] = "changed"
        else:
            words = passage + [f"w{rng.randrange(10**6)}" for _ in range(own)]
        rows.append((1000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("crowd,small_rows", [(1, 1_000_000), (8, 0), (32, 1_000_000)])
def test_crowded_tiles_lose_no_link(documents_of, crowd, small_rows):
    rule = JaccardRule(crowd=crowd, small_rows=small_rows)
    rows = near_copies(21, 80, 3) + shared_passage(22, 120, 30)
    # Rows of one id with unlike texts, in the middle of the crowd.
    rows += [(1000, rows[-1][1] + " end"), (1001, rows[3][1])]
    out = jaccard_components(documents_of(rows), rule).collect()
    got = {(r["doc_id"], r["component_id"]) for r in out}
    assert got == set(brute.components(rows).items())


def test_a_shared_passage_does_not_pair_all_texts(documents_of, spark):
    rule, counts = JaccardRule(), []
    for n in (100, 400):
        rows = shared_passage(23, n, 30)
        sets = {i: brute.grams(brute.blanks(brute.low(t)), rule.words) for i, t in rows}
        full = [-1] * len(bitmap(np.zeros(1, np.uint64)))
        members = spark.createDataFrame(
            [(i, i, len(s), full) for i, s in sets.items()],
            "node long, component long, n long, brief array<long>",
        )
        found = {tuple(r) for r in rare_gram_pairs(documents_of(rows), members, rule).collect()}
        linked = {(i, i + 1) for i in sets if i + 1 in sets and (i + 1) % 10 == 9}
        assert linked <= found
        counts.append(len(found))
    assert counts[1] <= 6 * counts[0] <= 6 * 100


def test_texts_with_few_crowded_tiles_stay_out_of_the_crowd(documents_of, monkeypatch):
    """Their links show in other tiles, so their n-grams need not be put in order."""
    rule, sizes = JaccardRule(words=3, percent=80), []

    def counted(docs, members, rule):
        sizes.append(members.count())
        return rare_gram_pairs(docs, members, rule)

    monkeypatch.setattr(ngram_join, "rare_gram_pairs", counted)
    rows = shared_passage(24, 300, 180, shared=60)
    out = jaccard_components(documents_of(rows), rule).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == brute.components(rows, 3, 80)
    assert sizes == [0]


@pytest.mark.parametrize("crowd,own,n,percent", [(1, 10, 3, 80), (2, 40, 5, 80), (1, 90, 3, 90)])
def test_leaving_crowded_tiles_loses_no_link(documents_of, crowd, own, n, percent):
    """Neighbours in a chain of near copies, at the bound and below, amid a shared passage."""
    rng = random.Random(own)
    rows = []
    for i in range(90):
        if i % 6:
            words = rows[-1][1].split()
            for _ in range(rng.randint(1, len(words) * 20 // 100 // 8)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        else:
            words = [f"p{k}" for k in range(60)] + [f"w{rng.randrange(10**6)}" for _ in range(own)]
        rows.append((i, " ".join(words)))
    rows += [(7, rows[20][1] + " end"), (8, "a b c d e")]
    out = jaccard_components(documents_of(rows), JaccardRule(words=n, percent=percent, crowd=crowd))
    got = {(r["doc_id"], r["component_id"]) for r in out.collect()}
    assert got == set(brute.components(rows, n, percent).items())


def test_edge_rows(edge):
    out = jaccard_components(edge).collect()
    assert len(out) == len(EDGE)
    want = brute.components([(i, t) for i, t, _ in EDGE])
    assert all(r["component_id"] == want.get(r["doc_id"]) for r in out)
    assert sum(r["n_shingles"] == 0 for r in out) == 4
    assert jaccard_components(edge.where("false")).count() == 0


def test_rows_of_one_id_link_together(documents_of):
    a, b = "one two three four five six", "some quite other words in here"
    rows = [(5, a), (5, b), (3, b), (9, a)]
    out = jaccard_components(documents_of(rows)).collect()
    assert {r["component_id"] for r in out} == {3}


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(1)
    for percent in (90, 80, 50):
        rule = JaccardRule(percent=percent)
        edges = rule.bands()
        for size in [*range(1, 60), 300, 1000]:
            x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            most = (100 - percent) * size // 100
            for gone in {0, most}:
                y = x[gone:]
                assert 100 * len(y) >= percent * size
                assert set(tile_keys(x, rule, edges)) & set(tile_keys(y, rule, edges))


def test_linked_sets_share_the_sure_number_of_tiles():
    rng = np.random.default_rng(2)
    for percent in (90, 80, 50):
        rule = JaccardRule(percent=percent)
        edges = rule.bands()
        for size in [*range(1, 60), 145, 300, 460, 1000]:
            x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            most = (100 - percent) * size // 100
            swapped = size * (100 - percent) // (100 + percent)
            fresh = rng.integers(0, 1 << 63, swapped, dtype=np.uint64)
            for y in (x[most:], x[: size - most // 2], np.concatenate([x[swapped:], fresh])):
                common = len(np.intersect1d(x, y))
                assert 100 * common >= percent * (len(x) + len(y) - common)
                (a, of_a), (b, of_b) = (ngram_join.sure_tiles(z, rule, edges) for z in (x, y))
                met = [sum(k & 1 == bit for k in set(a) & set(b)) for bit in (0, 1)]
                # In the band of the larger set both show themselves.
                bit = int(np.searchsorted(edges, max(len(x), len(y)), "right") - 1) & 1
                assert met[bit] >= max(of_a[bit], of_b[bit]) >= 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(20, 50)] + [(7, 7), (2, None)]
    random.Random(3).shuffle(edges)
    out = connected_components(spark.createDataFrame(edges, "u long, v long"))
    rows = {r["node"]: r["component"] for r in out.collect()}
    assert rows == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in [7, *range(20, 50)]}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_group_of_near_copies_is_not_expanded(documents_of):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[: i + 1], f"x{i}", *words[i + 1 :]])) for i in range(150)]
    out = jaccard_components(documents_of(rows))
    assert out.agg(F.max("component_id")).first()[0] == 0
