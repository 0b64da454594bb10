"""Repeated lines against brute force."""

import hashlib
import random

from helpers import HARD, documents

from twinloom.llm import line_dedup, queries

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def report_by_hand(rows, min_chars=10, min_docs=2):
    cut = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    count, smallest = {}, {}
    for i, lines in cut:
        for key in {key_of(line) for line in lines}:
            count[key] = count.get(key, 0) + 1
            known = smallest.get(key, i)
            smallest[key] = min((x for x in (known, i) if x is not None), default=None)
    found = []
    for i, lines in cut:
        kept = [
            line for line in lines
            if len(key_of(line)) < min_chars or count[key_of(line)] < min_docs or smallest[key_of(line)] == i
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        found.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(found, key=repr)


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=repr)


def mixed_rows(seed, n):
    rng = random.Random(seed)
    lines = [
        "a line of its own", "A Line of its OWN ", "\t a line of its own\r", "short", "", " ", "exactly 10",
        "only nine", "ÀÉ with accents", "àé with accents", " a line of its own", "𝒳𝒳𝒳𝒳𝒳 wide",
    ]
    return [
        (rng.choice([None, *range(n)]), "\n".join(rng.choice([*lines, f"line number {rng.randrange(40)}"]) for _ in range(rng.randrange(9))))
        for _ in range(n)
    ]


def test_repeated_lines_of_hard_rows(spark):
    rows = HARD + [
        (20, "one long enough line\n\n"), (21, "\nOne LONG enough line"), (None, "one long enough line"),
        (22, "one long enough line\none long enough line"), (22, "other\none long enough line"),
        (23, "\n" * 5000 + "x" * 50_000), (24, "x" * 50_000),
        (25, "\n".join(f"numbered line {k % 30_000}" for k in range(60_000))), (26, "\n".join(f"numbered line {k}" for k in range(30_000))),
    ]
    assert rows_of(line_dedup.line_report(documents(spark, rows).repartition(5))) == report_by_hand(rows)


def test_lines_against_brute_force(spark):
    for seed in range(4):
        rows = mixed_rows(seed, 120)
        for bounds in ((10, 2), (5, 4), (0, 3)):
            assert rows_of(line_dedup.line_report(documents(spark, rows), *bounds)) == report_by_hand(rows, *bounds)


def test_a_line_of_every_document_is_dealt_to_many_groups(spark):
    rows = [(k, f"the line that all documents hold\nown line number {k}") for k in range(3000)]
    assert rows_of(line_dedup.line_report(documents(spark, rows).repartition(6))) == report_by_hand(rows)
    repeated = line_dedup.repeated_lines(line_dedup._rows(documents(spark, rows)), 10, 2)
    heavy = line_dedup.sizing.heavy_keys(repeated, ["hash"])
    assert [r._salts for r in heavy.collect()] == [1000]


def test_an_empty_table(spark):
    assert line_dedup.line_report(documents(spark, [])).collect() == []


def test_rows_keep_their_columns(spark):
    rows = [(2, "first line here\nsecond line here"), (1, "second line here\nthird"), (3, None), (4, "first line here")]
    docs = documents(spark, rows)
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: (r.text, r.kept) for r in kept.collect()} == {
        2: ("first line here", "x"), 1: ("second line here\nthird", "x"), 3: ("", "x"), 4: ("", "x"),
    }


def test_the_plan_has_no_python(spark, sf_dir):
    plan = queries.op12_line_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
