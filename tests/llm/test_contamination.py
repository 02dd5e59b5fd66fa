import random

from settleflow.llm.contamination import contained_items


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words_of(text)
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def by_brute_force(docs, items, percent=75):
    best = {}
    for i, text in docs:
        have = shingles(text)
        for k, item in items:
            want = shingles(item)
            if i is not None and want and 100 * len(want & have) >= percent * len(want):
                best[i, k] = max(best.get((i, k), (0, 0)), (len(want & have) / len(want), len(want & have)))
    return {(i, k, shared, share) for (i, k), (share, shared) in best.items()}


def test_items_inside_documents(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    line = lambda n: [word() for _ in range(n)]
    items = [(k, " ".join(line(n))) for k, n in enumerate([5, 9, 15, 24, 33, 57, 130, 20, 20])]
    items += [(20, None), (21, ""), (22, "only three words"), (23, items[3][1].upper()), (None, items[4][1])]
    docs = []
    for i in range(160):
        w = line(rng.choice([0, 10, 100, 900]))
        k = rng.randrange(9)
        inner = items[k][1].split()
        if i % 4 == 1:  # edited: about a tenth of the words
            inner = [x if rng.random() > 0.03 else word() for x in inner]
        if i % 4 == 2:  # most or not enough of it
            inner = inner[: int(len(inner) * rng.choice([0.5, 0.85, 0.95]))]
        at = rng.randrange(len(w) + 1)
        docs.append((i, " ".join(w[:at] + (inner if i % 4 < 3 else []) + w[at:])))
    docs += [(500, None), (501, ""), (502, "Only three\twords"), (503, "only three words more"), (None, items[2][1]), (7, items[5][1]), (7, items[6][1])]
    docs += [(600, " ".join(line(30_000)) + " " + items[2][1])] + [(700 + i, items[7][1]) for i in range(40)]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, N_ITEM int").repartition(3)
    bench = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"], r["n_shared"], r["containment"]) for r in contained_items(table, bench).collect()}
    expected = {x for x in by_brute_force(docs, items) if x[1] is not None}
    assert got == expected and len(expected) > 100
    assert contained_items(table.limit(0), bench).count() == 0
    assert contained_items(table, bench.limit(0)).count() == 0


def test_regular_words_are_not_taken_for_equal(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 10))
    two = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"{one} b c d e"), (2, f"{two} b c d e")], "doc_id long, text string")
    items = spark.createDataFrame([(7, f"{one} b c d e")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in contained_items(docs, items).collect()] == [(1, 7)]
