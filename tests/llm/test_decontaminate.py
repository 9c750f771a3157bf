from __future__ import annotations

import random

import pytest

from adinsight.llm import decontaminate as D
from adinsight.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose


def slow_tiles(item, text, shortest):
    """Greedy string tiling by its definition: all matches anew in each round."""
    a, b, out = list(item), list(text), []
    used_a, used_b = [False] * len(a), [False] * len(b)
    while True:
        longest, found = shortest, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > longest:
                    longest, found = n, [(i, j)]
                elif n == longest:
                    found.append((i, j))
        for i, j in found:
            if not any(used_a[i:i + longest]) and not any(used_b[j:j + longest]):
                used_a[i:i + longest] = used_b[j:j + longest] = [True] * longest
                out.append((i, j, longest))
        if not found:
            return out


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_the_definition(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice([2, 4, 12]))]
    item = [rng.choice(words) for _ in range(rng.randint(0, 25))]
    text = [rng.choice(words) for _ in range(rng.randint(0, 40))]
    if item and rng.random() < 0.7:
        k = rng.randrange(len(item))
        text[5:5] = item[k:] + ["-"] + item[:k]
    assert D.tiles(item, text, 3) == slow_tiles(item, text, 3)


def brute(docs, items, least=D.MIN_COVERAGE):
    out = set()
    for d in docs:
        w = D.plain_words(d.text)
        for i in items:
            b = D.plain_words(i.text)
            if b and i.item_id is not None:
                c = sum(x[2] for x in D.tiles(b, w, min(D.SEED, len(b)))) / len(b)
                if c >= least - 1e-9:
                    out.add((d.doc_id, i.item_id, round(c, 9)))
    return out


def found(docs, benchmark):
    return {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in D.leaks(docs, benchmark).collect()}


def test_whole_part_reordered_and_changed_passages(spark):
    item = prose(50, 40).split()
    cases = {
        1: item, 2: item[20:] + ["between"] + item[:20],       # reordered
        3: item[:30], 4: item[:20], 5: [w.upper() + "!" for w in item],  # part, too small a part, marks and case
        6: sum(([*item[k:k + 9], "changed"] for k in range(0, 40, 10)), []), 7: item[::-1], 8: [],
        9: prose(51, 3000).split() + item + prose(52, 3000).split(), 10: item * 30}
    rows = [(k, " ".join(prose(60 + k, 30).split() + w + prose(80 + k, 30).split())) for k, w in cases.items()]
    docs = spark.createDataFrame([*rows, rows[0], (11, None), (12, ""), (None, " ".join(item))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (None, " ".join(item)), (4, "")],
                                  "item_id long, text string")
    got = D.leaks(docs, bench).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 5, 6, 9, 10, None} and sum(r.doc_id == 1 for r in got) == 2
    assert found(docs, bench) == brute(docs.collect(), bench.collect())
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 7, 8, 11, 12]


def test_equals_brute_force_on_documents(spark):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    assert found(docs, bench) == brute(docs.collect(), bench.collect())


def test_items_of_repeated_lines(spark):
    line, long = prose(90, 7), prose(91, 12)
    items = [(1, " ".join([line] * 10)), (2, "same " * 70), (3, " ".join([long] * 20)), (4, " ".join([line] * 8))]
    around = lambda k, t: " ".join([prose(92 + k, 20), t, prose(99 + k, 20)])
    docs = spark.createDataFrame([*((k, around(k, t)) for k, t in items), (5, around(5, line)), (6, around(6, "same " * 30))],
                                 "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = found(docs, bench)
    assert {(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)} <= got
    assert got == brute(docs.collect(), bench.collect())


def test_short_items_are_found_whole(spark):
    items = [(1, "Three short words"), (2, "alone"), (3, "four words in all"), (4, "..."), (1, "another three words")]
    docs = spark.createDataFrame([(1, "three, short WORDS"), (2, "three words short"), (3, prose(1, 50) + " four words in all " + prose(2, 50)),
                                  (4, "Alone!"), (5, "another three words"), (6, "words in all"), (7, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string")
    assert found(docs, bench) == {(1, 1, 1.0), (3, 3, 1.0), (4, 2, 1.0), (5, 1, 1.0)} == brute(docs.collect(), bench.collect())


def test_a_prompt_that_all_items_share_joins_none_of_them(spark):
    prompt = prose(300, 12)
    items = [(k, f"{prompt} {prose(301 + k, 25)}") for k in range(60)]
    docs = [(k, f"{prompt} {prose(500 + k, 80)}") for k in range(40)] + [(100 + k, f"{prose(600, 9)} {items[k][1]}") for k in range(0, 60, 9)]
    # Items that are copies but for a few words join by what they share, and are all found.
    items += [(900 + k, f"{prose(700, 30)} {prose(701 + k, 6)}") for k in range(20)]
    docs += [(990, prose(700, 30))]
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = found(docs, bench)
    assert got == brute(docs.collect(), bench.collect())
    assert {d for d, _, _ in got} == {*range(100, 160, 9), 990} and sum(d == 990 for d, _, _ in got) == 20


def test_tiling_repetitive_texts_is_quick():
    import time
    start = time.monotonic()
    assert D.tiles(["a"] * 70, ["a"] * 100_000) == [(0, 0, 70)]
    both = D.tiles(["a", "b"] * 30 + ["c"] * 30, ["b", "a"] * 40_000 + ["c"] * 9)
    assert sum(n for _, _, n in both) == 60 + 9 and time.monotonic() - start < 5


def test_the_registered_query(spark):
    from adinsight.llm.queries import op2_benchmark_decontamination
    got = op2_benchmark_decontamination(spark, SF_SMALL).collect()
    want = brute(table(spark, SF_SMALL, "documents").collect(), table(spark, SF_SMALL, "benchmark").collect())
    assert got and all(r.contaminated and r.n_tiles > 0 for r in got)
    assert {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in got} == want


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    want = found(docs, bench)
    monkeypatch.setattr(D, "MIN_BITMAP_BITS", 15)  # the smallest block of the bitmap
    monkeypatch.setattr(D, "MAX_BITMAP_BITS", 15)
    assert found(docs, bench) == want


def test_edges_and_empty_tables(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, prose(4, 80))], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(no_docs, bench).collect() == [] and D.leaks(edge_docs, none).collect() == []
    assert D.decontaminate(edge_docs, none).count() == edge_docs.count()
    kept = D.decontaminate(edge_docs, bench)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 1
