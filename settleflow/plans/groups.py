"""Routing of input files to groups, and steps run for all groups at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.functions import text
from settleflow.operators.dedup import cap_per_group
from settleflow.operators.joins import lookup_join, unmatched
from settleflow.sources.tables import GROUP, read_mapping

# How a file name shows its class, the number of groups, and the files of one
# class that one group takes per run.
SETTLEMENT_ENDINGS = (".txt", ".ST")
ACTIVITY_MARK = "ACTIV"
GROUPS = 20
FILES_PER_RUN = 15


def file_class(path: Column, name: Column, st_dir: str, ac_dir: str) -> Column:
    """``ST`` or ``AC`` by folder and name, NULL for any other file."""
    folder = F.concat(F.lit("/"), F.regexp_replace(path, r"[^/]*$", ""))
    in_st = folder.endswith(f"/{st_dir.strip('/')}/")
    in_ac = folder.endswith(f"/{ac_dir.strip('/')}/")
    ends = F.lit(False)
    for ending in SETTLEMENT_ENDINGS:
        ends = ends | name.endswith(ending)
    return F.when(in_st & ends, "ST").when(in_ac & F.upper(name).contains(ACTIVITY_MARK), "AC")


def route_files(
    manifest: DataFrame,
    mapping: DataFrame | None,
    st_dir: str = "ST",
    ac_dir: str = "AC",
    k: int = FILES_PER_RUN,
    strict: bool = True,
    groups: int = GROUPS,
    taken: DataFrame | None = None,
) -> DataFrame:
    """Give every group its next ``k`` files per class: ``grp, class, position, routed_name, path, name``.

    ``manifest`` has ``path, name``; ``mapping`` has ``network_id, grp_number``. A file goes to the
    group of the network id in its name; no id or an unknown one leaves it out, an id with several groups ends
    the job. Without a mapping a strict run fails, any other run gives all files to each group. All groups are
    routed in one pass.

    Files beyond ``k`` wait for a later run: give it the results of the runs so far as ``taken``
    (``grp, path``), and it goes on with the files after them.
    """
    kind = file_class(F.col("path"), F.col("name"), st_dir, ac_dir)
    files = manifest.select("path", "name", kind.alias("class")).filter(F.col("class").isNotNull())
    if mapping is None or mapping.isEmpty():
        if strict:
            raise ValueError("no network-to-group mapping: files cannot be told apart by group")
        # Every run gives each group the same files: cut them down first, then give them to all groups.
        if taken is not None:
            files = unmatched(files, taken, ["path"])
        first = cap_per_group(files, ["class"], ["name", "path"], k, rank="position")
        numbers = F.sequence(F.lit(1), F.lit(groups)).cast("array<string>")
        routed = first.withColumn(GROUP, F.explode(numbers))
    else:
        known = files.withColumn("network_id", text.network_id(F.col("name")))
        one_group = read_mapping(mapping.sparkSession, mapping, "network_id", "grp_number")
        mapped = lookup_join(known, one_group, [("network_id", "network_id")], "inner", name="map").withColumn(
            GROUP, F.col("map_grp_number")
        )
        if taken is not None:
            mapped = unmatched(mapped, taken, [GROUP, "path"])
        routed = cap_per_group(mapped, [GROUP, "class"], ["name", "path"], k, rank="position")
    named = F.concat(F.col("position").cast("string"), F.lit("."), F.col("name"))
    return routed.select(GROUP, "class", "position", named.alias("routed_name"), "path", "name")


def run_groups(
    df: DataFrame, step: Callable[[DataFrame, list[str]], DataFrame], keys: Sequence[str] = ()
) -> DataFrame:
    """Run a keyed step for every group in one job: the group is the first key, not a loop."""
    if GROUP not in df.columns:
        raise ValueError(f"the flow needs a {GROUP} column")
    return step(df, [GROUP, *keys])
