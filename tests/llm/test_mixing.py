import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm.mixing import mix_order, mix_sources
from tests.llm import brute
from tests.llm.conftest import EDGE


def check(df, rows):
    out = [r.asDict() for r in mix_sources(df).collect()]
    assert len(out) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.blanks(text))
    targets = brute.targets(sizes)
    for source, target in targets.items():
        own = [r for r in out if r["source"] == source]
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert all(r["target"] == pytest.approx(target) for r in own)
        piece = -(-max(r["size"] for r in own) // 1024)
        assert abs(target - sum(r["taken"] for r in own)) <= piece + 1
    assert sum(r["taken"] for r in out) == sum(sizes.values())  # the whole budget
    for r in out:
        assert sum(s["words"] for s in r["served"]) == r["taken"]
        assert not r["served"] or r["served"][0]["finish"] <= r["finish"]
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    return out


def test_edge_rows(edge):
    check(edge, EDGE)


def test_capped_sources_pass_their_excess_on(documents_of):
    words = lambda n: " ".join(["w"] * n)
    rows = [(i, words(3 + i % 5), s) for i, s in enumerate("a" * 40 + "b" * 3 + "c" * 2 + "d" * 30)]
    rows.append((99, words(50), None))
    out = check(documents_of(rows), rows)
    again = {r["doc_id"]: r["taken"] for r in mix_sources(documents_of(rows[::-1])).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in out}


def test_one_hot_source(documents_of):
    rows = [(i, "some words " * (1 + i % 7), "hot" if i % 3 else f"s{i % 20}") for i in range(300)]
    check(documents_of(rows), rows)


def plain_mix(rows, laps=3, pieces=1024):
    """Fair queueing one serving after the other: (finish, source, id, words) up to the budget."""
    key = lambda i: hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
    sized = [(s, key(i), i, len(brute.blanks(t))) for i, t, s in rows]
    sizes = {}
    for s, _, _, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    targets, queue = brute.targets(sizes), []
    for source, target in targets.items():
        at = 0
        for _ in range(laps):
            for _, _, i, n in sorted((x for x in sized if x[0] == source), key=lambda x: x[1]):
                step = n if at + n <= target else -(-n // pieces)
                for done in range(step, n + step, step) if n and at < target else ():
                    words = min(done, n) - (done - step)
                    queue.append(((at + min(done, n)) / target, source is None, source or "", i, words))
                at += n
    left, out = sum(sizes.values()), []
    for finish, _, source, i, words in sorted(queue, key=lambda x: x[:3]):
        if left > 0:
            out.append((finish, source, i, min(words, left)))
            left -= words
    return out


def test_order_equals_plain_fair_queueing(documents_of):
    words = lambda n: " ".join(["w"] * n)
    rows = [(i, words(i * 7 % 23), s) for i, s in enumerate("aaaaaaabbcdddddddddd" * 3)]
    rows += [(100, words(1500), "b"), (101, words(2100), None), (102, words(4), "e"), (103, None, "e")]
    out = mix_order(mix_sources(documents_of(rows))).collect()
    got = [(r["served_at"], r["source"] or "", r["doc_id"], r["words"]) for r in out]
    assert sorted(got) == sorted(plain_mix(rows))
    times = [r["served_at"] for r in out]
    assert times == sorted(times)
    again = [i for _, source, i, _ in got if source == "e"]
    assert again.count(102) == 3  # a document that is taken three times is listed three times


def test_no_rows_and_no_words(edge, documents_of):
    assert mix_sources(edge.where("false")).count() == 0
    none = mix_sources(documents_of([(1, None, "a"), (2, "", None)]))
    assert none.agg(F.sum("taken"), F.max("target")).first() == (0, 0.0)


def test_own_columns(edge):
    out = mix_sources(edge)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.first()["pos"] == "own pos"
