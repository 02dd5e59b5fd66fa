"""Near duplicates by min-max hashing, banding and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleflow.llm.graph import components
from settleflow.llm.tables import written
from settleflow.llm.words import Texts, hashed, lists, mixed, pieces, sequence_keys, shingles

SHINGLE = 5
#: Permutations, each giving its minimum and its maximum, and rows of a band. A pair with a similarity of
#: 0.75 shares none of the 32 bands with a probability of (1 - 0.75**4)**32, about 5 in a million.
PERMUTATIONS, ROWS = 64, 4
#: Followers in a shingle that a set is tried on before the rest is compared in full.
TRIES = 24
#: Rows of a shingle that are ordered together to find followers, about; a frequent shingle has several such parts.
CHUNK = 128


def permutations(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of hash functions on 64-bit values."""
    rng = np.random.default_rng(seed)
    return (
        rng.integers(0, 1 << 63, count, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1),
        rng.integers(0, 1 << 63, count, dtype=np.int64).view(np.uint64),
    )


def band_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Band keys of every non-empty set, one row each.

    A permutation is evaluated once and gives two signature values, its minimum and its maximum. A band
    is made of the minima or of the maxima of ``ROWS`` different permutations, never of both of one.
    """
    factor, offset = permutations(PERMUTATIONS)
    start = bounds[:-1][np.diff(bounds) > 0]
    half = PERMUTATIONS // ROWS
    keys = np.zeros((len(start), 2 * half), np.uint64)
    for i in range(PERMUTATIONS):
        y = values * factor[i]
        y += offset[i]
        for side, reduce in enumerate((np.minimum, np.maximum)):
            band = side * half + i // ROWS
            keys[:, band] = mixed(keys[:, band] ^ reduce.reduceat(y, start))
    return mixed(keys + np.arange(2 * half, dtype=np.uint64))


def _sketches(docs: DataFrame) -> DataFrame:
    """``_id``, ``_key``, ``_n``, ``_bands`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(1), 1 << 18):
                words, bounds = hashed(texts, lower=True)
                values, of = shingles(words, bounds, SHINGLE)
                size = np.diff(of)
                keys = band_keys(values, of) if len(values) else np.zeros((0, 2 * PERMUTATIONS // ROWS), np.uint64)
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, keys.shape[1], 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(size)),
                        sequence_keys(texts, lower=True),
                        pa.array(size.astype(np.int64)),
                        lists(keys.ravel(), ends),
                    ],
                    ["_id", "_key", "_n", "_bands"],
                )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, _key binary, _n long, _bands array<long>")


def _sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, Texts]]:
    for texts in pieces(column, 1 << 18):
        words, bounds = hashed(texts, lower=True)
        yield *shingles(words, bounds, SHINGLE), texts


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u``, ``v``, ``_text_u``, ``_text_v`` whose full sets are similar enough."""

    def all_sets(column: pa.Array) -> list[np.ndarray]:
        return [values[of[i] : of[i + 1]] for values, of, _ in _sets(column) for i in range(len(of) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                good = []
                for a, b in zip(all_sets(part.column(2)), all_sets(part.column(3))):
                    short, long = sorted((len(a), len(b)))
                    both = len(np.intersect1d(a, b, assume_unique=True)) if 100 * short >= percent * long else 0
                    good.append(short > 0 and 100 * both >= percent * (short + long - both))
                yield part.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    kind = pairs.schema["u"].dataType.simpleString()
    return pairs.select("u", "v", "_text_u", "_text_v").mapInArrow(run, f"u {kind}, v {kind}")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links among the written pairs; ``texts`` has ``_id`` and ``_text`` of all their ends."""
    left = texts.select(F.col("_id").alias("_iu"), F.col("_text").alias("_text_u"))
    right = texts.select(F.col("_id").alias("_iv"), F.col("_text").alias("_text_v"))
    joined = pairs.join(left, F.col("u") == F.col("_iu")).join(right, F.col("v") == F.col("_iv"))
    return written(_similar(joined, percent), "near-links")


def _prefix_rows(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``_token``, ``_id``, ``_comp``, ``_n``, ``_at``: the rarest shingles of each set with their rank, enough that any
    two sets which are similar enough share one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, of, piece in _sets(batch.column(2)):
                size = np.diff(of)
                row = pa.array(np.repeat(np.arange(len(size)), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(size)).take(row),
                        batch.column(1).slice(piece.first, len(size)).take(row),
                        pa.array(np.repeat(size, size).astype(np.int64)),
                        pa.array(values.view(np.int64)),
                    ],
                    ["_id", "_comp", "_n", "_token"],
                )

    kind = members.schema["_id"].dataType.simpleString()
    joined = members.join(texts.withColumnRenamed("_id", "_of"), F.col("_id") == F.col("_of"))
    tokens = written(
        joined.select("_id", "_comp", "_text").mapInArrow(run, f"_id {kind}, _comp {kind}, _n long, _token long"), "near-tokens"
    )
    common = written(
        tokens.groupBy("_token").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1").withColumnRenamed("_token", "_t"), "near-common", narrow=True
    )
    ranked = tokens.join(common, F.col("_token") == F.col("_t"), "left").select(
        "_id", "_comp", "_n", F.struct(F.coalesce("_df", F.lit(1)).alias("df"), F.col("_token").alias("token")).alias("_r")
    )
    keep = (F.col("_n") - F.ceil(F.col("_n") * percent / 100) + 1).cast("int")
    prefix = ranked.groupBy("_id", "_comp", "_n").agg(F.sort_array(F.collect_list("_r")).alias("_all"))
    return (
        prefix.select("_id", "_comp", "_n", F.posexplode(F.slice("_all", F.lit(1), keep)).alias("_at", "_r"))
        .where("_r.df > 1")
        .select(F.col("_r.token").alias("_token"), "_id", "_comp", "_n", "_at")
    )


def _shared(rows: DataFrame) -> DataFrame:
    """Prefix rows whose shingle several components have, with the most frequent of these in ``_main`` and all its rows in ``_rows``."""
    main = written(
        rows.groupBy("_token", "_comp").agg(F.count(F.lit(1)).alias("_c")).groupBy("_token")
        .agg(F.max_by("_comp", F.struct("_c", "_comp")).alias("_main"), F.count(F.lit(1)).alias("_comps"), F.sum("_c").alias("_rows"))
        .where("_comps > 1").select(F.col("_token").alias("_t"), "_main", "_rows"),
        "near-main", narrow=True,
    )
    return written(rows.join(main, F.col("_token") == F.col("_t")).drop("_t"), "near-shared")


def _close(one: Column, two: Column, percent: int) -> Column:
    """Different components, and sets that could overlap enough after a shingle at ``_at`` of both (ranked alike)."""
    most = F.least(one["_n"] - one["_at"], two["_n"] - two["_at"])
    return ((100 + percent) * most >= percent * (one["_n"] + two["_n"])) & (one["_comp"] != two["_comp"])


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    pairs = pairs.select(F.least("_one._id", "_two._id").alias("u"), F.greatest("_one._id", "_two._id").alias("v")).distinct()
    return written(pairs.join(tested, ["u", "v"], "left_anti"), "near-rest", narrow=True)


def _neighbours(shared: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Pairs of each row with the ``TRIES`` rows that follow it in its shingle, ordered by a hash of both.

    A frequent shingle is dealt into parts of about ``CHUNK`` rows, so that no task orders all of it; a second round with
    other parts joins what the first leaves in different ones.
    """
    row = F.struct("_id", "_comp", "_n", "_at")
    parts = F.ceil(F.col("_rows") / CHUNK)
    found = []
    for turn in (0, 1):
        dealt = shared.withColumn("_part", F.pmod(F.xxhash64("_id", "_token", F.lit(turn)), parts))
        order = Window.partitionBy("_token", "_part").orderBy(F.xxhash64(F.lit(turn), "_token", "_id"), "_id")
        ahead = F.array(*[F.lead(row, i).over(order) for i in range(1, TRIES + 1)])
        rows = (dealt.where(parts > 1) if turn else dealt).select(row.alias("_one"), ahead.alias("_ahead"))
        near = F.filter("_ahead", lambda x: x.isNotNull() & _close(F.col("_one"), x, percent))
        found.append(rows.select("_one", F.explode(near).alias("_two")))
    return _untested(found[0].unionByName(found[1]), tested)


def _crossing(shared: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows outside the most frequent component of their shingle with all rows of other components.

    Sets of sizes too different to be similar do not meet: sizes lie in classes, of which neighbours alone can be similar.
    """
    row = F.struct("_id", "_comp", "_n", "_at")
    size = F.floor(F.log("_n") / F.log(F.lit(100.5 / percent))).cast("int")
    near = F.explode(F.array(size - 1, size, size + 1)).alias("_size")
    some = shared.where("_comp <> _main").select("_token", row.alias("_one"), near)
    pairs = some.join(shared.select("_token", row.alias("_two"), size.alias("_size")), ["_token", "_size"])
    return _untested(pairs.where(_close(F.col("_one"), F.col("_two"), percent)), tested)


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links."""
    stars = found.select(F.col("id").alias("u"), F.col("component").alias("v"))
    return written(components(stars.unionByName(links)), "near-found", narrow=True)


def _finished(found: DataFrame, members: DataFrame, texts: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Components after all links between ``members`` (``_id``, ``_comp``) of different ones, found exactly.

    Prefix filtering: only sets that share one of their rarest shingles can be similar enough, which a common
    passage is not. First each member tries the few that follow it in a shuffled order of every such shingle, which
    joins large groups of near copies by a number of pairs in proportion to the members. What is left apart is
    compared in full: the members outside the most frequent component of a shingle meet all its members of others.
    """
    rows = written(_prefix_rows(members, texts, percent), "near-prefix")
    shared = _shared(rows)
    links = _confirmed(_neighbours(shared, tested, percent), texts, percent)
    if not links.isEmpty():
        found = _joined(found, links)
        now = found.withColumnsRenamed({"id": "_of", "component": "_now"})
        rows = rows.join(now, F.col("_id") == F.col("_of"), "left").withColumn("_comp", F.coalesce("_now", "_comp"))
        shared = _shared(written(rows.select("_token", "_id", "_comp", "_n", "_at"), "near-prefix"))
    more = _confirmed(_crossing(shared, tested, percent), texts, percent)
    return found if more.isEmpty() else _joined(found, more)


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every document.

    A-Z lower-cased, words are runs without space and 0x09-0x0D; a set is the distinct shingles of five words. Sets with
    ``100 * intersection >= percent * union`` are linked.

    1. One pass over the texts gives 32 band keys and a 128-bit key of the word sequence. Equal sequences
       become one node, the smallest id, by a minimum summed inside map tasks.
    2. In every bucket of a band each node is paired with the smallest one (linear in the bucket, however
       large) and the pairs are confirmed on the full sets. Links give components.
    3. A bucket of three or more may hold nodes of different components that were not compared yet. Their links are found
       exactly by prefix filtering, so no link between candidates is lost and no bucket is capped.
    4. Components again, and every document finds its own by the key of its words.

    Null, empty and blank texts have no shingles and are linked with nothing; fewer than five words are one shingle.
    Rows with a null id are not linked and have a null component; rows that repeat an id are one
    node. An empty table gives an empty result; other columns are ignored.
    """
    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    sketch = written(_sketches(texts), "near-sketch")
    usable = sketch.where("_key IS NOT NULL AND _id IS NOT NULL")
    nodes = written(usable.groupBy("_key").agg(F.min("_id").alias("_rep")), "near-nodes", narrow=True)
    reps = usable.join(nodes.select(F.col("_rep")), F.col("_id") == F.col("_rep"), "left_semi")
    rows = reps.select("_id", F.explode("_bands").alias("_band")).distinct()
    centers = (
        rows.groupBy("_band").agg(F.min("_id").alias("_center"), F.count(F.lit(1)).alias("_size"))
        .where("_size > 1").withColumnRenamed("_band", "_b")
    )
    members = written(rows.join(written(centers, "near-centers", narrow=True), F.col("_band") == F.col("_b")).drop("_b"), "near-members")
    pairs = written(
        members.where("_id <> _center").select(F.col("_center").alias("u"), F.col("_id").alias("v")).distinct(), "near-pairs", narrow=True
    )
    ends = written(pairs.select(F.explode(F.array("u", "v")).alias("_end")).distinct(), "near-ends", narrow=True)
    needed = written(texts.join(ends, F.col("_id") == F.col("_end"), "left_semi"), "near-texts")
    links = _confirmed(pairs, needed, percent)
    found = written(components(links), "near-found", narrow=True)
    known = members.where("_size > 2").join(found, F.col("_id") == F.col("id"), "left").select(
        "_band", "_id", F.coalesce("component", "_id").alias("_comp")
    )
    split = known.groupBy("_band").agg(F.min("_comp").alias("_low"), F.max("_comp").alias("_high")).where("_low <> _high")
    open_bands = written(split.select(F.col("_band").alias("_b")), "near-open", narrow=True)
    if not open_bands.isEmpty():
        left = written(known.join(open_bands, F.col("_band") == F.col("_b")).select("_id", "_comp").distinct(), "near-left", narrow=True)
        found = _finished(found, left, needed, pairs, percent)
    of_key = written(
        nodes.join(found, F.col("_rep") == F.col("id"), "left").select(
            F.col("_key").alias("_k"), F.coalesce("component", "_rep").alias("_component")
        ),
        "near-of-key", narrow=True,
    )
    slim = sketch.select("_id", "_key", "_n")
    linked = slim.where("_key IS NOT NULL AND _id IS NOT NULL").join(of_key, F.col("_key") == F.col("_k"))
    alone = slim.where("_key IS NULL OR _id IS NULL").withColumn("_component", F.col("_id"))
    return linked.select(*alone.columns).unionByName(alone).select(
        F.col("_id").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
    )
