"""Divergence between sources of a language: term counts compared in the cells of a three-dimensional cube."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleflow.llm.tables import filled, written
from settleflow.llm.terms import LETTERS, terms_of
from settleflow.llm.words import pieces

#: Groups of a block and terms of a block, about (blocks are chosen by hash): a cell holds two blocks of groups over one of terms.
GROUPS, TERMS = 64, 2048
#: Bits of a group's number that count inside its block.
BLOCK_BITS = 32
#: Fixed values of the shares: parts in a whole, and what is added to every count.
WHOLE, ADDED = 1_000_000_000, 5


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(WHOLE * (count + ADDED) / (total + ADDED * terms)), exact for counts of any size; 0 without terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = F.lit(WHOLE).cast("decimal(10,0)") * (wide(count) + F.lit(ADDED))
    below = F.nullif(wide(total) + F.lit(ADDED) * wide(terms), F.lit(0))
    return F.coalesce(F.lit(1) + F.call_function("div", above, below), F.lit(0).cast("long"))


def term_counts(docs: DataFrame) -> DataFrame:
    """``_lang``, ``_source``, ``_term``, ``_n`` (occurrences), ``_df`` (documents) of every term of every group.

    Counts are summed per piece of text, per task and then by group and term, so neither a hot source nor a
    frequent term gathers its occurrences anywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(2), 1 << 23):
                count = len(texts.offsets) - 1
                terms, bounds = terms_of(texts, LETTERS)
                if not len(terms):
                    continue
                coded = terms.dictionary_encode()
                wide = np.int64(len(coded.dictionary))
                code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                lang, source = (batch.column(i).slice(texts.first, count).dictionary_encode().indices.to_numpy() for i in (0, 1))
                _, first, group = np.unique(lang.astype(np.int64) * count + source, return_index=True, return_inverse=True)
                row = np.repeat(np.arange(count), np.diff(bounds))
                in_doc, occurrences = np.unique(row * wide + code, return_counts=True)
                key, place = np.unique(group[in_doc // wide] * wide + in_doc % wide, return_inverse=True)
                of = pa.array(texts.first + first[key // wide])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(of),
                        batch.column(1).take(of),
                        pc.cast(coded.dictionary.take(pa.array(key % wide)), pa.large_string()).cast(pa.string()),
                        pa.array(np.bincount(place, weights=occurrences).astype(np.int64)),
                        pa.array(np.bincount(place).astype(np.int64)),
                    ],
                    ["_lang", "_source", "_term", "_n", "_df"],
                )

    kind = "_lang string, _source string, _term string, _n long, _df long"
    return (
        docs.select("_lang", "_source", "_text")
        .mapInArrow(run, kind)
        .groupBy("_lang", "_source", "_term")
        .agg(F.sum("_n").alias("_n"), F.sum("_df").alias("_df"))
    )


def partial_divergences(group: np.ndarray, term: np.ndarray, share: np.ndarray, lower: int, upper: int) -> Iterator[tuple]:
    """Of the groups in blocks ``lower`` and ``upper``, each pair once: a group, others, sums of differences over the cell's terms.

    An entry with term -1 tells of a group and the share of a term it does not have; the one with group -2 has the number of terms.
    """
    terms = int(term[group == -2].sum())
    here = (term == -1) & (group >= 0)
    groups, base = group[here], share[here]
    order = np.argsort(groups)
    groups, base = groups[order], base[order]
    dense = np.repeat(base[:, None], terms, axis=1)
    seen = (term >= 0) & (group >= 0)
    dense[np.searchsorted(groups, group[seen]), term[seen]] = share[seen]
    one = np.flatnonzero(groups >> BLOCK_BITS == lower)
    two = np.flatnonzero(groups >> BLOCK_BITS == upper)
    for at in one:
        other = two[two > at]
        if len(other):
            yield groups[at], groups[other], np.abs(dense[other] - dense[at]).sum(axis=1)


def _cell(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    lower, upper = key[1].as_py(), key[2].as_py()
    column = lambda name: rows[name].to_numpy()
    one, two, part = [], [], []
    for group, others, sums in partial_divergences(column("_g"), column("_t"), column("_p"), lower, upper):
        one.append(np.full(len(others), group))
        two.append(others)
        part.append(sums)
    joined = lambda parts: pa.array(np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64))
    a = joined(one)
    lang = pa.array([key[0].as_py()] * len(a), pa.string())
    return pa.table([lang, a, joined(two), joined(part)], names=["_lang", "_a", "_b", "_part"])


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30, top: int = 50
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how the sources of a language differ in their terms.

    A term (a run of letters, A-Z lower-cased; bytes are compared) counts for a language if at least ``least`` of its
    documents have it. Part ``pair`` has, for every source, each other source of the language with the sum of the
    differences of their smoothed shares over all those terms; part ``term`` the ``top`` terms a source has more of
    than its language.

    1. One pass over the texts counts occurrences and documents per group and term; what follows reads those counts only.
    2. Pairs are compared in a cube: groups (sources of a language) lie in blocks of ``GROUPS`` along two axes, terms in blocks of
       about ``TERMS`` along the third. A cell (group block, group block, term block) is one task's work: the slices of its two
       group blocks over its term block are sent to it (each slice to as many cells as there are group blocks), and it sums
       the differences of every pair. No cell depends on how frequent a source or a term is.
    3. Partial sums of a pair are added up along the term axis.

    Shares are whole numbers computed in decimals, sums are 64-bit integers: nothing is rounded. Null text, lang and source are
    the empty string, which is a language or source like any other. A group without a term has a row in every pair; a
    language of one source has no pairs; without kept terms all values are 0. Equal values rank by item. Repeated rows
    count each time. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(*[filled(F.col(c)).alias(n) for c, n in ((lang, "_lang"), (source, "_source"), (text, "_text"))])
    counts = written(term_counts(rows), "audit-counts")
    in_lang = counts.groupBy("_lang", "_term").agg(F.sum("_n").alias("_all"), F.sum("_df").alias("_docs"))
    kept = written(in_lang.where(F.col("_docs") >= least).select("_lang", "_term", "_all"), "audit-terms")
    langs = written(kept.groupBy("_lang").agg(F.count(F.lit(1)).alias("_terms"), F.sum("_all").alias("_total")), "audit-langs")
    blocks = F.ceil(F.coalesce("_terms", F.lit(1)) / TERMS).cast("long")

    # Terms numbered inside their block: a block is chosen by hash, so it has about TERMS terms.
    sized = kept.join(langs, "_lang").withColumn("_block", F.pmod(F.xxhash64("_term"), blocks)).repartition("_lang", "_block")
    inside = Window.partitionBy("_lang", "_block").orderBy("_term")
    numbered = written(
        sized.select(
            "_lang", "_term", "_block", "_terms", (F.row_number().over(inside) - 1).cast("long").alias("_t"),
            share(F.col("_all"), F.col("_total"), F.col("_terms")).alias("_q"),
        ),
        "audit-numbered",
    )
    held = written(counts.join(numbered, ["_lang", "_term"]).select("_lang", "_source", "_term", "_n", "_block", "_t", "_q"), "audit-held")

    # Groups, numbered inside their block in the same way: the number of a group says its block.
    sums = held.groupBy("_lang", "_source").agg(F.sum("_n").alias("_sum"))
    sources = written(rows.select("_lang", "_source").distinct(), "audit-sources")
    spread = sources.groupBy("_lang").agg(F.ceil(F.count(F.lit(1)) / GROUPS).cast("long").alias("_wide"))
    every = sources.join(spread, "_lang").join(sums, ["_lang", "_source"], "left").join(langs, "_lang", "left")
    every = every.withColumn("_own", F.pmod(F.xxhash64("_source"), F.col("_wide")))
    inside = Window.partitionBy("_lang", "_own").orderBy("_source")
    groups = written(
        every.select(
            "_lang", "_source", "_wide", F.coalesce("_sum", F.lit(0)).alias("_sum"), F.coalesce("_terms", F.lit(0)).alias("_terms"), blocks.alias("_blocks"),
            (F.shiftleft("_own", BLOCK_BITS) + F.row_number().over(inside) - 1).alias("_g"),
        ),
        "audit-groups",
    )

    found = held.join(groups.select("_lang", "_source", "_g", "_wide", "_sum", "_terms"), ["_lang", "_source"])
    found = found.withColumn("_p", share(F.col("_n"), F.col("_sum"), F.col("_terms")))
    none = share(F.lit(0), F.col("_sum"), F.col("_terms"))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block")
    exists = groups.select("_lang", every_block, "_g", "_wide", F.lit(-1).cast("long").alias("_t"), none.alias("_p"))
    slices = found.select("_lang", "_block", "_g", "_wide", "_t", "_p").unionByName(exists)
    own, axis = F.shiftright("_g", BLOCK_BITS), F.sequence(F.lit(0).cast("long"), F.col("_wide") - 1)
    cell = lambda other: F.struct(F.least(own, other).alias("_i"), F.greatest(own, other).alias("_j"))
    sent = slices.select("_lang", "_block", "_g", "_t", "_p", F.explode(F.transform(axis, cell)).alias("_to")).select(
        "_lang", "_to._i", "_to._j", "_block", "_g", "_t", "_p"
    )
    sizes = numbered.groupBy("_lang", "_block").agg(F.count(F.lit(1)).alias("_t")).join(spread, "_lang")
    corner = F.transform(axis, lambda i: F.transform(F.sequence(i, F.col("_wide") - 1), lambda j: F.struct(i.alias("_i"), j.alias("_j"))))
    marks = sizes.select("_lang", "_block", "_t", F.explode(F.flatten(corner)).alias("_to")).select(
        "_lang", "_to._i", "_to._j", "_block", F.lit(-2).cast("long").alias("_g"), "_t", F.lit(0).cast("long").alias("_p")
    )
    cells = sent.unionByName(marks).groupBy("_lang", "_i", "_j", "_block")
    partial = cells.applyInArrow(_cell, "_lang string, _a long, _b long, _part long")
    pairs = partial.groupBy("_lang", "_a", "_b").agg(F.sum("_part").alias("value"))
    both = pairs.select("_lang", F.explode(F.array(F.struct(F.col("_a").alias("_x"), F.col("_b").alias("_y")), F.struct(F.col("_b").alias("_x"), F.col("_a").alias("_y")))).alias("_pair"), "value")
    name = lambda key, out: groups.select("_lang", F.col("_g").alias(key), F.col("_source").alias(out))
    named = both.select("_lang", "_pair.*", "value").join(name("_x", "source"), ["_lang", "_x"]).join(name("_y", "item"), ["_lang", "_y"])
    of_pairs = named.select("_lang", "source", F.lit("pair").alias("part"), "item", "value")
    of_terms = found.where("_n > 0 AND _p > _q").select(
        "_lang", F.col("_source").alias("source"), F.lit("term").alias("part"), F.col("_term").alias("item"), (F.col("_p") - F.col("_q")).alias("value")
    )
    by = Window.partitionBy("_lang", "source").orderBy(F.desc("value"), "item")
    ranked = of_pairs.withColumn("rank", F.row_number().over(by)).unionByName(
        of_terms.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    )
    return ranked.select(F.col("_lang").alias("lang"), "source", "part", "item", "value", "rank")
