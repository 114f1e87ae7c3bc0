from __future__ import annotations

import math
import random
import re

import pytest

from rankweave.llm import quality
from rankweave.llm.quality import CHARACTER_CLASSES, COMMON_WORDS, judge_quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def classes(text):
    solid = "".join(WORD.findall(text))
    letters = sum(c.isascii() and c.islower() or not c.isascii() for c in solid)
    upper, digit = (sum(c.isascii() and f(c) for c in solid) for f in (str.isupper, str.isdigit))
    sentence = sum(c in ".,;:!?'\"()-" for c in solid)
    return [letters, len(solid.encode()) - len(solid), upper, digit, len(text) - len(solid), sentence, len(solid) - letters - upper - digit - sentence]


def jsd(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    return sum(x * math.log2(2 * x / (x + y)) for a, b in ((p, q), (q, p)) for x, y in zip(a, b) if x) / 2


def texts():
    rng = random.Random(3)
    vocabulary = "the of and house Tree river, stone; été größe don't 12 $5 a|b über".split()
    found = [None, "", " \t\n ", "one", "a b", "the the the the", "x\n\nx\n x\nx\x0b\n"]
    found += [rng.choice(" \n\t\r  ").join(rng.choice(vocabulary) for _ in range(n)) for n in (49, 50, 51, 120, 700)]
    found += ["\n".join(["a line that repeats itself"] * 30), "%%% ### " * 80, "ABC DEF! " * 5 + " ".join(f"W{i}" for i in range(300))]
    return found + ["word" * 20_000 + " the", " ".join(f"w{i}" for i in range(200)) + " the of and" * 30, "\U0001f600 é " * 60]


def test_counts_equal_a_plain_count(documents):
    known = texts()
    found = judge_quality(documents([(i, t) for i, t in enumerate(known)] + [(None, "a b")], extra=True)).collect()
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found}
    assert got == {i: base(t) for i, t in [*enumerate(known), (None, "a b")]}
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_divergences(documents):
    letters = "abcdefghijklmnopqrstuvwxyz"
    prose = "the river and the stone of a house in it for that is was on with trees. "
    normal = [prose + " ".join(f"wo{a}{b}" for b in letters for a in letters[i % 20 : i % 20 + 3]) for i in range(40)]
    odd = " ".join(f"#{i}%{i}" for i in range(200))
    known = [*normal, odd]
    got = {r["doc_id"]: r for r in judge_quality(documents(list(enumerate(known)))).collect()}
    shares = [[c / sum(classes(t)) for c in classes(t)] for t in known]
    typical = [sorted(math.floor(10_000 * s + 0.5) for s in bin)[(len(known) - 1) // 2] for bin in zip(*shares)]
    assert len(typical) == len(CHARACTER_CLASSES)
    for i, text in enumerate(known):
        assert got[i]["class_distance"] == pytest.approx(jsd(classes(text), typical))
    assert got[0]["kept"] and not got[40]["kept"], (got[0], got[40])


def test_only_listed_languages_are_judged_by_words(documents):
    letters = "abcdefghijklmnopqrstuvwxyz"
    odd = " ".join(f"q{a}{b}z" for a in letters for b in letters[:6])
    plain = ["the of and to in a is that " * 3 + " ".join(f"{a}{b}{c}d" for b in letters for c in "xyz") for a in letters]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(p, "en") for p in plain] + [(odd, "en"), (odd, "xx"), (odd, None)])]
    got = {r["doc_id"]: r["kept"] for r in judge_quality(documents(rows), max_word_divergence=0.05).collect()}
    assert got[0] and not got[26] and got[27] and got[28]


def test_constants_and_empty(documents):
    assert all(len(words) == len(set(words)) == quality.N_COMMON for words in COMMON_WORDS.values())
    assert judge_quality(documents([])).collect() == []


def test_no_python_in_the_plan(documents):
    plan = judge_quality(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(i, alphabet=LETTERS, words=120):
    rng = random.Random(i)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9))) for _ in range(words))


def test_copies_and_long_texts_do_not_set_the_reference(documents):
    table = " ".join(f"{7919 * i}.{i}" for i in range(400))
    long = " ".join(f"{104729 * i}" for i in range(20_000))
    rows = [(i, prose(i)) for i in range(40)] + [(100 + i, table) for i in range(60)] + [(200, long)]
    rows += [(300 + i, f"{i}% " * 300) for i in range(60)]  # fail the base rules
    got = {r["doc_id"]: r["kept"] for r in judge_quality(documents(rows), max_word_divergence=1.0).collect()}
    assert all(got[i] for i in range(40))
    assert not any(kept for i, kept in got.items() if i >= 100)


def test_each_language_has_its_own_reference(documents):
    signs = "".join(map(chr, range(0x4E00, 0x4E40)))
    odd = " ".join(f"#{i}%{i}" for i in range(200))
    rows = [(i, prose(i), "it") for i in range(15)] + [(100 + i, prose(i, signs, 150), "zh") for i in range(15)]
    rows += [(200, odd, "it"), (201, odd, "fi"), (202, odd, None), (203, prose(50, "xyz"), None)]
    got = {r["doc_id"]: r["kept"] for r in judge_quality(documents(rows)).collect()}
    # One text is too few for a reference of its own, and so is no language.
    assert {i for i, kept in got.items() if not kept} == {200}


def test_the_query_keeps_clean_documents_next_to_as_much_junk(spark, tmp_path):
    """The registered query, with tables of numbers that have as many characters as all else, and its SQL."""
    import duckdb

    from rankweave.llm.queries import ORACLES, QUERIES

    clean = [(i, prose(i), "en" if i % 3 else "it", "s", 1) for i in range(200)]
    size = sum(len(text) for _, text, *_ in clean)
    junk = [(1000 + i, (" ".join(f"{7919 * k + i}.{k}" for k in range(9000)))[: size // 49], "en", "s", 1) for i in range(49)]
    copies = [(2000 + i, " ".join(f"#{k}%{k}" for k in range(200)), "en", "s", 1) for i in range(80)]
    rows = [*clean, *junk, *copies, (3000, None, None, None, None), (3001, prose(1), None, "s", 1), (3002, prose(2, "xyz"), "fi", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r.asDict() for r in QUERIES["op6_quality"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        wanted = db.sql(ORACLES["op6_quality"]).to_arrow_table().to_pylist()
    assert found == {row["doc_id"]: row for row in wanted}
    judged = [found[i] for i, *_ in clean if not found[i]["base_failed"] and i % 3 == 0]
    assert judged and all(r["kept"] for r in judged)
    assert not any(found[i]["kept"] for i, *_ in [*junk, *copies])
