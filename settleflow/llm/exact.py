"""Exact duplicates by 128-bit content hash, with the bytes compared inside every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import filled, lower_ascii, written


def exact_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest
    (``keep="max"``) or smallest id stays.

    1. Rows are counted by the md5 of their text; only hashes that occur again go on.
    2. The texts of those rows are grouped by hash *and bytes*. The counts are summed inside every
       map task first, so a group that holds a third of all rows is a few rows in the shuffle; texts
       that merely collide end up in different groups.
    3. Rows find their group by hash and bytes. Both sides are read from written tables and every
       group is one row, so adaptive execution can split a hot hash.

    Null text is the empty text, and empty texts are copies of each other. Rows that repeat an id
    are one document: they stay or go together. A row without an id stays only if no row of its
    group has an id. An empty table gives an empty result. Other columns are not looked at.
    """
    texts = docs.select(F.col(id).alias("_id"), lower_ascii(filled(F.col(text))).alias("_text")).select(
        "_id", "_text", F.unhex(F.md5("_text")).alias("_hash"), F.unhex(F.sha2("_text", 256)).alias("_sha")
    )
    prints = written(texts.select("_id", "_hash", "_sha"), "exact-prints")
    again = written(
        prints.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash"), "exact-again"
    )
    members = written(texts.join(again, "_hash", "left_semi"), "exact-members")
    winner = F.max("_id") if keep == "max" else F.min("_id")
    groups = written(
        members.groupBy("_hash", "_text").agg(winner.alias("_keep"), F.count(F.lit(1)).alias("_n")), "exact-groups"
    )
    alone = prints.join(again, "_hash", "left_anti").select(
        "_id", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_n"), "_sha"
    )
    grouped = members.join(groups, ["_hash", "_text"]).select("_id", "_keep", "_n", "_sha")
    return alone.unionByName(grouped).select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
