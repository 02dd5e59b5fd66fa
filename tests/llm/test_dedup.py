import hashlib
import random
from collections import Counter, defaultdict

from settleflow.llm.exact import exact_copies
from settleflow.llm.graph import components
from settleflow.llm.minhash import near_copies
from settleflow.llm.substring import remove_repeats

SCHEMA = "doc_id long, text string, kept string, KEEP_ID int, component_id string, n_words int"


def table(spark, rows):
    """Documents with further columns named like those of the results."""
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return (text or "").encode().split()


def test_exact_copies(spark):
    rows = [
        (1, "Same Text"), (5, "same text"), (3, "SAME TEXT"), (4, "other"), (6, None), (7, ""), (8, "É"), (9, "é"),
        (10, "x" * 300_000), (11, "X" * 300_000), (12, "twice"), (12, "twice"), (None, "no id"), (None, "lone"), (13, "no id"),
    ]
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    expected = []
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids) if ids else None
        digest = hashlib.sha256(lower(t).encode()).hexdigest()
        expected.append((i, keep, len(groups[lower(t)]), i == keep, digest))
    got = [tuple(r) for r in exact_copies(table(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    least = {r["doc_id"]: r["keep_id"] for r in exact_copies(table(spark, rows[:5]), keep="min").collect()}
    assert least == {1: 1, 3: 1, 5: 1, 4: 4, 6: 6}
    assert exact_copies(table(spark, [])).count() == 0


def test_texts_with_one_hash_are_compared_by_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "md5", lambda c: F.lit("00" * 16))  # every text collides
    rows = [(i, t) for i, t in enumerate("a b a c b a".split())]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_copies(table(spark, rows)).collect()}
    assert got == {0: (5, 3), 2: (5, 3), 5: (5, 3), 1: (4, 2), 4: (4, 2), 3: (3, 1)}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 4), (4, None)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_by_brute_force(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = words_of(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_copies_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    add = lambda t: rows.append((1000 - len(rows) * 7 % 1000, t))
    for _ in range(12):  # chains of edits, where ends are linked through what lies between
        base = [word() for _ in range(rng.randrange(30, 90))]
        for _ in range(6):
            add(" ".join(base))
            base = list(base)
            base[rng.randrange(len(base))] = word()
    passage = [word() for _ in range(60)]
    for size in range(0, 60, 2):  # one passage in many texts, most of them not similar
        add(" ".join([word() for _ in range(size)] + passage))
    add(" ".join(passage).upper())
    for text in ("one two", "ONE two", "one  two\n", "é", "É", None, "", "  \n", "word " * 400, "word " * 300):
        add(text)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_copies(table(spark, rows)).collect()}
    assert got == near_by_brute_force(rows)


def test_a_frequent_shingle_in_parts(spark, monkeypatch):
    """Many texts that share a passage, with groups of copies of any size: parts and classes of sizes lose no link."""
    from settleflow.llm import minhash

    monkeypatch.setattr(minhash, "CHUNK", 3)
    monkeypatch.setattr(minhash, "TRIES", 2)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(25):
        own = [word() for _ in range(rng.randrange(4, 30))]
        for _ in range(rng.randrange(1, 6)):
            edited = [w if rng.random() > 0.03 else word() for w in own]
            rows.append((len(rows), " ".join(edited + passage[: rng.choice([36, 40])])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_copies(table(spark, rows)).collect()}
    assert got == near_by_brute_force(rows)


def test_near_copies_without_ids_or_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (None, text), (2, text), (1, text), (1, text), (1, "quite another text with seven words")]
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_copies(table(spark, rows)).collect())
    assert got == {(None, None, True): 2, (2, 1, False): 1, (1, 1, True): 3}
    assert near_copies(table(spark, [])).count() == 0


def repeats_by_brute_force(rows, length):
    seen = Counter()
    for _, t in rows:
        w = words_of(t)
        seen.update(tuple(w[j : j + length]) for j in range(len(w) - length + 1))
    out = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for j in range(len(w) - length + 1):
            if seen[tuple(w[j : j + length])] > 1:
                gone.update(range(j, j + length))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=repr)


def test_repeats_match_brute_force(spark, monkeypatch):
    from settleflow.llm import substring

    monkeypatch.setattr(substring, "PIECE", 3000)  # many pieces
    monkeypatch.setattr(substring, "WORDS_PER_RANGE", 400)  # many ranges
    rng = random.Random(5)
    word = lambda: rng.choice("aeiou") + rng.choice("bcdfg") + rng.choice("é-X.")
    line = lambda n: [word() for _ in range(n)]
    shared = [line(n) for n in (34, 35, 36, 50, 90)]
    rows = []
    for i in range(60):
        parts = line(rng.randrange(0, 60)) + rng.choice(shared)[rng.randrange(3) :] + line(rng.randrange(0, 40))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(100, "same " * 200), (101, "same " * 34), (102, None), (103, ""), (104, " \t "), (None, "x y"), (105, "a b " * 35)]
    rows += [rows[3], rows[3]]
    for length in (35, 70):
        got = sorted((tuple(r) for r in remove_repeats(table(spark, rows), length).collect()), key=repr)
        assert got == repeats_by_brute_force(rows, length)


def test_repeats_of_texts_without_any(spark):
    got = remove_repeats(table(spark, [(1, "a b c"), (2, None)]), 35).collect()
    assert sorted(tuple(r) for r in got) == [(1, 3, 0, "a b c"), (2, 0, 0, "")]
    assert remove_repeats(table(spark, []), 35).count() == 0


def thue_morse(rounds):
    order = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << rounds))
    return order, order.translate(str.maketrans("ab", "ba"))


def test_regular_words_are_not_taken_for_equal(spark):
    a, b = thue_morse(10)
    rows = [(1, f"{a} one two three four"), (2, f"{b} one two three four")]
    assert {r["doc_id"]: r["component_id"] for r in near_copies(table(spark, rows)).collect()} == {1: 1, 2: 2}
    fill = " ".join(f"w{i}" for i in range(34))
    got = remove_repeats(table(spark, [(1, f"{a} {fill}"), (2, f"{b} {fill}")]), 35).collect()
    assert [r["n_removed"] for r in got] == [0, 0]
    order = [" ".join(["one", "two"][c == "b"] for c in word) for word in thue_morse(11)]
    got = remove_repeats(table(spark, [(1, order[0]), (2, order[1])]), 2048).collect()
    assert [r["n_removed"] for r in got] == [0, 0]


def test_repeats_and_near_copies_in_texts_of_several_megabytes(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    long = [word() for _ in range(500_000)]
    passage = [word() for _ in range(60)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:400_000] + ["x"] + long[400_000:])), (3, " ".join(passage)), (4, "x" * 3_000_000)]
    rows += [(5, " ".join([word() for _ in range(300_000)] + passage + [word()])), (6, "x" * 2_999_999)]
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in near_copies(table(spark, rows)).collect()}
    assert {i: c for i, (c, _) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}
    removed = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in remove_repeats(table(spark, rows)).collect()}
    assert removed == {1: (500_000, 500_000), 2: (500_001, 500_000), 3: (60, 60), 4: (1, 0), 5: (300_061, 60), 6: (1, 0)}
