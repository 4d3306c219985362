from riskloom.llm.quality import quality_rules
from tests.llm import brute
from tests.llm.conftest import EDGE

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = [
    (20, "a b c d e f a b c d e", None),
    (21, "a b c d e a b c d e a b c d e f g h i j k l m n o p", None),
    (22, "x x x x x x x x x x x x", None),
    (23, "same line\nsame line\n\n\nsame line \nother | # $", None),
    (24, "one two three four five", None),
]


def test_counts_match_brute_force(documents_of):
    rows = EDGE + EXTRA
    got = [tuple(r[c] for c in ("doc_id", *COUNTS)) for r in quality_rules(documents_of(rows)).collect()]
    want = [(i, *brute.quality_counts(t)) for i, t, _ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_verdict(documents_of):
    prose = "A clean line of prose with quite a few plain words in it."
    more = "Another sentence follows it, which says a few things that the first one does not."
    menu = "Home | News | Sport | Weather | About | Contact | Help | Login"
    noisy = " ".join(f"word{i}###" for i in range(30))
    rows = [
        (1, prose),
        (2, f"{prose}\n{menu}\n{more}"),
        (3, f"{menu} | More | Items | Here | Again\nshort text"),
        (4, noisy),
        (5, f"{prose}\nPlease enable JavaScript"),
        (6, "too few words"),
        (7, None),
        (8, "SHOUT!! IT!! OUT!! LOUD!! AND!! CLEAR!! FOR!! ALL!! OF!! US!!"),
    ]
    out = {r["doc_id"]: r for r in quality_rules(documents_of(rows)).collect()}
    assert {i for i, r in out.items() if r["kept"]} == {1, 2, 5}
    assert {i for i, r in out.items() if r["base_failed"]} == {6, 7}
    assert out[1]["text"] == out[5]["text"] == prose
    assert out[2]["text"] == f"{prose}\n{more}"
    assert out[7]["text"] is None and out[7]["lost_share"] == 0


def test_prose_may_name_furniture_and_ask(documents_of):
    prose = "The committee read the new privacy policy twice before any of its members went home."
    long = [" ".join(f"Item{i} stands beside thing{i}." for i in part) for part in (range(200), range(200, 400))]
    talk = "Why?\nBecause it rained all night and the road was gone.\nNo!\nYes, said the old man to them."
    rows = [
        (1, f"{long[0]} {prose} {long[1]}"),
        (2, f"{prose}\nIt had grown late, and the terms of use had to wait until the next morning came."),
        (3, talk),
        (4, f"{prose}\nAccept all cookies\nPrivacy Policy"),
        (5, f"{prose}\nBack to top - See our Privacy Policy - Terms of Use - Log in"),
        (6, f"{prose}\nBuy now!!! Win???"),
    ]
    out = {r["doc_id"]: r for r in quality_rules(documents_of(rows)).collect()}
    assert all(r["kept"] for r in out.values())
    whole = dict(rows)
    assert {i for i, r in out.items() if r["text"] == whole[i]} == {1, 2, 3}
    assert {i for i, r in out.items() if r["text"] == prose} == {4, 5, 6}


def test_empty_table_and_own_columns(edge):
    assert quality_rules(edge.where("false")).count() == 0
    out = quality_rules(edge)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.first()["key"] == "own key"
