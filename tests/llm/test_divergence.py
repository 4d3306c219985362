import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import riskloom.llm.divergence as divergence
from riskloom.llm.divergence import AuditRule, audit_sources, terms_of
from tests.llm.brute import low
from tests.llm.conftest import LONG

KIND = "doc_id long, text string, lang string, source string"


def brute(rows, rule):
    """rows: (text, lang, source)."""
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t))
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = terms(text)
        docs[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= rule.min_docs]
        groups = sorted(s for g, s in counts if g == lang)

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + rule.scale * (n[t] + 1) // (total + len(kept)) for t in kept}

        by = {s: shares(counts[lang, s]) for s in groups}
        whole = shares(sum((counts[lang, s] for s in groups), Counter()))
        for s, p in by.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in by.items() if o != s]
            marks = [
                ((p[t] - whole[t]) ** 2 // whole[t], t)
                for t in kept
                if counts[lang, s][t] and p[t] > whole[t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", marks, rule.top_terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def audited(spark, rows, rule):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], KIND)
    df = df.withColumns({c: F.lit(f"own {c}") for c in ("term", "gid", "p", "value", "N", "item")})
    return sorted(tuple(r) for r in audit_sources(df, rule).collect())


def rows_of(seed, n=120):
    import random

    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["Über", "ärger", "日本", "\U0001f600x"]
    out = []
    for _ in range(n):
        source = rng.choice(["hot", "hot", "a", "b", "c", None])
        own = words[:10] if source == "a" else words
        out.append((" ".join(rng.choices(own, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), source))
    return out


EDGE = [
    (None, "en", "a"), ("", "en", None), ("same Same SAME", "en", "b"), ("same", "en", "b"), ("same", "en", "c"),
    ("same", "en", "c"), ("1 2 3 !", None, None), (LONG, "de", "x"), (LONG, "de", "x"), (LONG, "de", "y"),
    (None, None, None), ("allein", "fr", "only"), ("no kept terms", "es", "p"), ("other words", "es", "q"),
]


@pytest.mark.parametrize("rule", [AuditRule(), AuditRule(min_docs=2, scale=1000, top_terms=3, block=2, salts=3)])
@pytest.mark.parametrize("rows", [EDGE, rows_of(1), rows_of(2)], ids=["edge", "one", "two"])
def test_equals_brute_force(spark, rows, rule):
    assert audited(spark, rows, rule) == brute(rows, rule)


def test_small_chunks_and_cells(spark, monkeypatch):
    """The same sums where a task must cut its index and hand out cells early."""
    rows, rule = rows_of(3), AuditRule()
    monkeypatch.setattr(divergence, "_ROWS", 7)
    monkeypatch.setattr(divergence, "_CELLS", 2)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], KIND)
    postings = []
    for block in divergence.scatter(_postings(df, rule)):
        postings += block.to_pylist()
    monkeypatch.undo()
    again = []
    for block in divergence.scatter(_postings(df, rule)):
        again += block.to_pylist()

    def sums(cells):
        found = Counter()
        for c in cells:
            found[c["lang"], c["g"], c["h"]] += c["value"]
        return {k: v for k, v in found.items() if v}

    assert len(postings) > len(again) and sums(postings) == sums(again)


def _postings(df, rule):
    rows = (
        divergence.term_counts(df)
        .where("n > 0")
        .selectExpr(
            "lang", "term", "0 as block", "cast(abs(hash(source)) % 5 as int) as gid", "n * 1000 as p",
            "10L as p0", "5L as peers", "true as own",
        )
        .orderBy("lang", "term", "block", "gid")
    )
    return [b for b in rows.toArrow().to_batches(max_chunksize=5)]


def test_no_rows(spark):
    assert audited(spark, [], AuditRule()) == []


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Some words, étranges 123 and more " * 40).encode()
    whole = [t for part in terms_of(text) for t in part]
    monkeypatch.setattr(divergence, "_PIECE", 11)
    assert [t for part in terms_of(text) for t in part] == whole
    assert list(terms_of(b"x" * 100)) == [[b"x" * 100]] and list(terms_of(b"")) == []
