"""Exact and near duplicates against brute force."""

import hashlib
import random

from helpers import HARD, documents, prose
from pyspark.sql import functions as F

from twinloom.llm import exact_dedup, near_dedup, stages
from twinloom.llm.components import connected
from twinloom.llm.near_dedup import NearConfig, least_matches
from twinloom.llm.sketch import TextCodes, shingle_hashes, shingle_set


def exact_by_hand(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    found = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc_id, keep, len(ids), doc_id == keep, digest))
    return sorted(found, key=repr)


def test_exact_duplicates_of_hard_rows(spark):
    rows = HARD + [(100 + k, "hot") for k in range(300)]
    found = exact_dedup.exact_duplicates(documents(spark, rows).repartition(7))
    assert sorted(map(tuple, found.collect()), key=repr) == exact_by_hand(rows)


def test_one_row_stays_for_each_text(spark):
    docs = documents(spark, HARD)
    kept = stages.exact_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in HARD})


def test_texts_of_one_digest_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "text_digest", lambda text: F.unhex(F.lpad(F.hex(F.length(text)), 4, "0")))
    rows = [(1, "ab"), (2, "cd"), (3, "ab"), (4, "x"), (5, "cd")]
    found = exact_dedup.exact_duplicates(documents(spark, rows)).select("doc_id", "keep_id", "group_size")
    assert sorted(map(tuple, found.collect())) == [(1, 3, 2), (2, 5, 2), (3, 3, 2), (4, 4, 1), (5, 5, 2)]


def test_exact_plan_has_no_python(spark):
    plan = exact_dedup.text_groups(
        documents(spark, HARD).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", exact_dedup.text_digest(F.col("text")))
    )._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def near_by_hand(rows, width, percent=80):
    codes = TextCodes()
    sets = [(i, shingle_set(codes.words(t)[1], width)) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            if a is not None and b is not None and one and two:
                both = len(one & two)
                if 100 * both >= percent * (len(one) + len(two) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return sorted(
        ((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr
    )


def copies_of(base: list[str], count: int, most: float, seed: int, start: int) -> list[tuple[int, str]]:
    """Copies with up to a share of words replaced: some reach the threshold, some do not."""
    rng = random.Random(seed)
    found = []
    for k in range(count):
        words = list(base)
        for at in rng.sample(range(len(words)), int(rng.uniform(0, most) * len(words))):
            words[at] = f"w{rng.randrange(10**9)}"
        found.append((start + k, " ".join(words)))
    return found


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    rows = HARD + copies_of(prose(5, 120).split(), 70, 0.13, 6, 1000)
    rows += copies_of(prose(7, 40).split(), 25, 0.2, 8, 3000)
    rows += [(5000 + k, prose(9, 50) + " " + prose(100 + k, 60)) for k in range(25)]  # a shared passage
    chain = prose(11, 60).split()
    for k in range(12):  # each like the next, the ends unlike
        chain = chain[2:] + [f"c{k}", f"d{k}"]
        rows.append((7000 + k, " ".join(chain)))
    rng.shuffle(rows)
    for width in (2, 5):
        found = near_dedup.near_duplicates(documents(spark, rows).repartition(5), NearConfig(width=width))
        assert sorted(map(tuple, found.collect()), key=repr) == near_by_hand(rows, width)


def test_no_documents(spark):
    none = documents(spark, []).limit(0)
    assert exact_dedup.exact_duplicates(none).collect() == []
    assert near_dedup.near_duplicates(none).collect() == []


def test_words_are_split_and_lowered_in_ascii_only():
    codes = TextCodes()
    text = " Ab c\x0bDÉ\x1cx\r\n\fY "
    assert codes.words(text)[1] == "ab c dÉ\x1cx y".encode()
    words, plain = codes.words(prose(1, 5000))
    assert len(shingle_hashes(words, 2)) == len(shingle_set(plain, 2))


def test_components_of_links(spark):
    path = [(k, k + 1) for k in range(1, 40)]
    star = [(100, k) for k in range(101, 160)]
    links = spark.createDataFrame([*path, *star, (205, 203)], "a long, b long")
    found = {r.id: r.component for r in connected(links).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 203: 203, 205: 203}
    assert connected(links.limit(0)).collect() == []


def test_pairs_are_given_up_only_below_the_chosen_chance():
    assert least_matches(32, 0.8, 1e-7) < least_matches(32, 0.8, 1e-3) < 26
    assert least_matches(10, 0.5, 0.0) == 0


def test_mixed_passages_in_one_large_group_meet_in_blocks(spark, monkeypatch):
    """Texts made of the same passages in different mixes: hardly any shingle is rare, and no star links them all."""
    rng = random.Random(11)
    passages = [prose(200 + k, 12) for k in range(14)]
    rows = []
    for k in range(500):
        chosen = sorted(rng.sample(range(14), rng.choice([9, 10, 11, 12])))
        rows.append((k, " ".join(passages[c] for c in chosen)))
    config = NearConfig(width=2, rare=4, block=64)
    made = []
    paired = near_dedup._paired
    monkeypatch.setattr(near_dedup, "_paired", lambda *a: made.append(paired(*a)) or made[-1])
    found = near_dedup.near_duplicates(documents(spark, rows), config)
    assert sorted(map(tuple, found.collect()), key=repr) == near_by_hand(rows, 2)
    assert sum(df.count() for df in made) < 10 * len(rows)
