"""The manifest against trees built by hand."""

import hashlib
import zlib

import pytest
from helpers import HARD, SCHEMA, CLASHING, documents
from pyspark.sql import functions as F

from twinloom.llm import manifest, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def runs_above(levels, at):
    for level in levels[:-1]:
        start = at // 16 * 16
        yield level[start:start + 16], at - start
        at //= 16


def by_hand(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda r: (first(r[0]), leaf(r)))
        trees[source] = levels_of([leaf(r) for r in groups[source]])
    top = levels_of([trees[s][-1][0] for s in sources])
    found = []
    for number, source in enumerate(sources):
        for at, row in enumerate(groups[source]):
            runs = [*runs_above(trees[source], at), *runs_above(top, number)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf((*row[:4], lower(row[4]))) if changed else leaf(row)
            for run, place in runs:
                node = h(*run[:place], node, *run[place + 1:])
            proof = h(*[x for run, place in runs for k, x in enumerate(run) if k != place])
            root = top[-1][0]
            found.append((row[0], leaf(row), trees[source][-1][0], root, proof, node, node == root))
    return sorted(found, key=repr)


def rows_of(found):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.select(*names).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r[:2], r[4], r[2], r[3], *["x"] * len(CLASHING)) for r in rows],
                                 "doc_id long, source string, text string, lang string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in CLASHING))


def proven(docs):
    return manifest.manifest(docs, queries.held_out())


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (1, 1), (256, 257, 3), (4097, 1, 20), (9000, 4096)])
def test_sizes_at_the_edges_of_runs_and_blocks(spark, sizes):
    rows = [
        (k * 7 % n * 3, f"s{s}", "en" if k % 3 else None, k, f"Text {k} of {s}")
        for s, n in enumerate(sizes) for k in range(n)
    ]
    assert rows_of(proven(table(spark, rows).repartition(5))) == by_hand(rows)


def test_many_sources(spark):
    rows = [(k, f"source {k % 300}é", "de", None, "A" * (k % 5)) for k in range(700)]
    rows += [(k, None, None, k, None) for k in range(40)] + [(k, "", "", 0, "") for k in range(20)]
    assert rows_of(proven(table(spark, rows))) == by_hand(rows)


def test_hard_rows_ties_and_repeats(spark):
    rows = [(i, None, None, None, t) for i, t in HARD]
    rows += [(5, "s", "en", 1, "Same")] * 20 + [(5, "s", "en", 1, "Other"), (None, "s", "en", 2, "No id")] * 2
    rows += [(2**62 + 1, "s", "en", 1, "Large ID"), (-3, "s", None, None, None)]
    assert rows_of(proven(table(spark, rows))) == by_hand(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = [(k, f"s{k % 2}", None, k, f"T{k}") for k in range(1500)]
    whole = by_hand(rows)
    monkeypatch.setattr(manifest, "HEIGHT", 1)
    monkeypatch.setattr(manifest, "SPAN", 16)
    assert rows_of(proven(table(spark, rows))) == whole


def test_an_empty_table(spark):
    assert proven(documents(spark, [])).collect() == []
    assert set(c.name for c in SCHEMA) >= {"doc_id", "text"}


def test_the_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*manifest.FIELDS).collect()]
    found = rows_of(queries.op13_manifest(spark, sf_dir))
    assert found == by_hand(rows)
    changed = [r for r in found if not r[-1]]
    assert 0 < len(changed) < len(found) / 4


def test_no_proof_fits_another_text(spark):
    rows = [(k, "s", None, None, f"Text {k}") for k in range(50)]
    found = manifest.manifest(table(spark, rows), F.lit(True))
    assert not any(r.verified for r in found.collect())
    assert all(r.verified for r in manifest.manifest(table(spark, rows)).collect())
