import os
import zlib
from pathlib import Path

import duckdb
import pytest
from settleflow.llm.queries import BLOCK, ORACLES, QUERIES, SHARES
from settleflow.llm.mixing import period

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def plain(value):
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(plain(row[n]) for n in order) for row in df.collect())
    assert got == sorted(tuple(plain(row[names.index(n)]) for n in order) for row in result.fetchall())


def test_the_entry_point_offers_all_queries():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(oracle_sql())


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_pipeline_stage_by_stage(spark):
    tables = {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark", "labels")}
    docs = tables["documents"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    kept = {r["doc_id"]: r for r in docs.collect()}
    items = [shingles(r["text"]) for r in tables["benchmark"].collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        after = {r["doc_id"]: r for r in out.collect()}
        assert all(kept[i] == row for i, row in after.items())
        if name == "quality":
            scores = QUERIES["op3_quality"](spark, SMALL).collect()
            expected = {r["doc_id"] for r in scores if r["score"] >= 0.3}
            truth = {r["doc_id"]: r["quality"] for r in tables["labels"].collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
            assert all(i in after for i, q in truth.items() if q)
        elif name == "exact_dedup":
            last = {}
            for i, r in sorted(kept.items()):
                last["".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")] = i
            expected = set(last.values())
        elif name == "near_dedup":
            sets = {i: shingles(r["text"]) for i, r in kept.items()}
            root = {i: i for i in sets}

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            ids = sorted(sets)
            for n, a in enumerate(ids):
                for b in ids[n + 1 :]:
                    both = len(sets[a] & sets[b])
                    if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        low, high = sorted((find(a), find(b)))
                        root[high] = low
            expected = {i for i in ids if find(i) == i}
        else:
            expected = {i for i, r in kept.items() if not any(s and 100 * len(s & shingles(r["text"])) >= 75 * len(s) for s in items)}
        assert set(after) == expected, name
        docs, kept = out, after
    mixed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in mixed} == set(kept)
    order = period(SHARES)
    assert all(order[r["slot"] % len(order)] == r["source"] for r in mixed if r["slot"] is not None)
    assert len({r["position"] for r in mixed if r["slot"] is not None}) == sum(r["slot"] is not None for r in mixed)
    assert all(r["position"] // BLOCK == r["slot"] for r in mixed if r["slot"] is not None)


def test_stages_carry_further_columns_and_null_rows(spark):
    rows = [
        (1, "some text here", "en", "src0", 14, "a", 1), (2, None, None, None, None, None, None), (3, "", "en", "src1", 0, "b", 2),
        (None, "no id at all", "en", "src2", 12, "c", 3), (4, "Some Text Here", "en", "src9", 14, "d", 4),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, Component_Id int")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        ids = {r["doc_id"] for r in out.collect()}
        assert ids == {"exact_dedup": {3, 4, None}, "near_dedup": {1, 2, 3, None}, "decontamination": {1, 2, 3, 4, None}}[name]
    assert {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SMALL).collect()} <= {1, 2, 3, 4, None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_every_row_is_judged_by_its_own_text(spark):
    """Null and repeated ids, in every stage: a row goes for its text, not for its id."""
    tables = {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark", "labels")}
    scores = QUERIES["op3_quality"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in tables["documents"].collect()}
    bad = texts[min(r["doc_id"] for r in scores if r["score"] < 0.2 and texts[r["doc_id"]])]
    good_id = min(r["doc_id"] for r in scores if r["score"] > 0.8)
    more = spark.createDataFrame([(None, bad, None, None, 0), (good_id, bad, "en", "src1", 0), (None, texts[good_id], None, None, 0)], tables["documents"].schema)
    kept = corpus_pipeline.quality(spark, tables["documents"].unionByName(more), SMALL).collect()
    assert bad not in {r["text"] for r in kept}
    assert sorted((r["doc_id"] for r in kept if r["text"] == texts[good_id]), key=str) == sorted([good_id, None], key=str)

    item = next(r["text"] for r in tables["benchmark"].collect() if r["text"] and len(r["text"].split()) > 8)
    same = "these are the very same eight words here"
    near = " ".join(f"w{i}" for i in range(40))
    rows = [
        (5, same), (None, same), (7, "seven"), (7, same), (7, same.upper()), (None, "no id"), (None, "no id"),
        (9, near), (9, near + " x"), (None, near), (None, "lone"), (1, f"a {item} b"), (1, "clean"), (None, item),
    ]
    docs = spark.createDataFrame([(i, t, "en", "src0", 0, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, n int")
    left = lambda stage: {r["n"] for r in stage(spark, docs, SMALL).collect()}
    exact = left(corpus_pipeline.exact_dedup)
    assert len(exact & {0, 1, 3, 4}) == 1 and exact & {0, 1, 3, 4} <= {3, 4}  # one row of the largest id
    assert len(exact & {5, 6}) == 1 and exact & {7, 9} == {7} and {2, 8, 10, 11, 12, 13} <= exact
    close = left(corpus_pipeline.near_dedup)
    assert close & {0, 1, 3, 4} == {0} and len(close & {5, 6}) == 1 and len(close & {7, 8, 9}) == 1 and close & {9} == set()
    assert left(corpus_pipeline.decontamination) == set(range(14)) - {11, 13}
    assert corpus_pipeline.mixing(spark, docs, SMALL).count() == 14
