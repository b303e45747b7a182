"""Texts and links for the top removed item of each block, taken from the raw dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean_text, normalise_link_id
from ..functions.text import REMOVED, is_placeholder
from ..schemas import EXTRA_FIELDS
from ..session import materialise
from .narrow import rows_with_ids
from .slim import unusable_files

# Bodies stored before this time were fetched while they were still
# available; a stored row without a time counts as newer than any.
ARCHIVED_BEFORE = 1609257600
UNKNOWN_TIME = 12345678901


def archived(existing: DataFrame, item_type: str) -> Column:
    """Whether a stored row is final, so its id need not be looked up again."""
    if item_type == "posts":
        return F.lit(True)
    created = F.coalesce("created_utc", F.lit(UNKNOWN_TIME))
    return (created < ARCHIVED_BEFORE) | F.coalesce(F.col("body") != REMOVED, F.lit(True))


def check_fields(existing: DataFrame, item_type: str) -> None:
    """A stored table with other fields than wanted must be moved away first."""
    stored = sorted(c for c in existing.columns if c not in ("id", "score"))
    wanted = sorted(EXTRA_FIELDS[item_type])
    if stored != wanted:
        raise ValueError(f"stored {item_type} have fields {stored}, wanted {wanted}")


def ids_to_lookup(
    blocks: DataFrame,
    item_type: str,
    existing: DataFrame | None = None,
    inaccessible: DataFrame | None = None,
    comments: DataFrame | None = None,
    compat: bool = False,
) -> DataFrame:
    """Distinct ids to fetch: the blocks' top items and, for posts, the parents of the
    stored comments; without final rows and without ids known to be inaccessible.

    ``compat`` applies the inaccessible list only when final rows exist.
    """
    ids = blocks.select(F.col("id_of_max_pos_removed_item").alias("id"))
    if item_type == "posts" and comments is not None:
        ids = ids.unionByName(comments.select(F.col("link_id").alias("id")))
    ids = ids.where("id IS NOT NULL AND id <> ''").distinct()
    final = None if existing is None else existing.where(archived(existing, item_type)).select("id")
    if inaccessible is not None and not (compat and (final is None or final.isEmpty())):
        ids = ids.join(inaccessible.select("id"), "id", "left_anti")
    return ids if final is None else ids.join(final, "id", "left_anti")


def stored_versions(classified: DataFrame, item_type: str) -> DataFrame:
    """Enrichment fields of classified lines, as stored in the dump, with their position."""
    usable = classified.where((F.col("type") == item_type) & (F.col("outcome") == "keep"))
    if item_type == "posts":
        # A rejected file contributes no text either; at most one name per file.
        usable = usable.join(F.broadcast(unusable_files(classified)), "file", "left_anti")
    return usable.select("id", *EXTRA_FIELDS[item_type], "pos")


def normalise_fields(versions: DataFrame, item_type: str) -> DataFrame:
    """Cleaned texts, bare parent ids, integer numbers."""
    rules = {
        "body": clean_text,
        "title": clean_text,
        "link_id": normalise_link_id,
        "created_utc": lambda c: c.cast("long"),
        "num_comments": lambda c: c.try_cast("long"),
    }
    return versions.select("id", *(rules[f](F.col(f)).alias(f) for f in EXTRA_FIELDS[item_type]), "pos")


def resolve_versions(versions: DataFrame) -> DataFrame:
    """One row per id. With bodies: the first version that still has its text, or the
    last one when none has. Without bodies: the last version.

    The rank filter cuts each id's copies before the shuffle.
    """
    pos = F.col("pos")
    if "body" in versions.columns:
        gone = F.coalesce(is_placeholder(F.col("body"), REMOVED), F.lit(False))
        order = [gone, F.when(~gone, pos).asc_nulls_last(), F.when(gone, pos).desc_nulls_last()]
    else:
        order = [pos.desc()]
    window = Window.partitionBy("id").orderBy(*order)
    return versions.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "pos")


def lookup(ids: DataFrame, versions: DataFrame, item_type: str) -> DataFrame:
    """Fields of the wanted ids. The dump is reduced to likely ids before any text is
    cleaned or shuffled; each id's copies are resolved where they are read, so a hot id
    sends one text per task to the exact join."""
    likely = rows_with_ids(versions, ids, exact=False)
    return resolve_versions(normalise_fields(likely, item_type)).join(ids.select("id"), "id", "left_semi")


def ids_not_found(ids: DataFrame, found: DataFrame) -> DataFrame:
    return ids.select("id").join(found.select("id"), "id", "left_anti")


def extend_inaccessible(inaccessible: DataFrame, not_found: DataFrame) -> DataFrame:
    return inaccessible.select("id").union(not_found.select("id")).distinct()


def merge_lookups(found: DataFrame, existing: DataFrame, item_type: str) -> DataFrame:
    """New rows and stored rows. A comment stored without its text takes what the new
    lookup gives, field by field, and keeps the stored value where that is missing."""
    fields = EXTRA_FIELDS[item_type]
    found, existing = found.select("id", *fields), existing.select("id", *fields)
    if item_type == "posts":
        return found.unionByName(existing)
    final = archived(existing, item_type)
    again = existing.where(~final)
    merged = (
        found.alias("new")
        .join(again.alias("old"), "id", "full_outer")
        .select("id", *(F.coalesce(f"new.{f}", f"old.{f}").alias(f) for f in fields))
    )
    return merged.unionByName(existing.where(final))


def attach_score(rows: DataFrame, blocks: DataFrame, item_type: str) -> DataFrame:
    """Score of the item in the block table; unknown for rows that are no top item."""
    scores = blocks.select(
        F.col("id_of_max_pos_removed_item").alias("id"), F.col("score_of_max_pos_removed_item").alias("score")
    )
    return rows.join(scores, "id", "left").select("id", *EXTRA_FIELDS[item_type], "score")


def enrich(
    blocks: DataFrame,
    versions: DataFrame,
    item_type: str,
    existing: DataFrame | None = None,
    inaccessible: DataFrame | None = None,
    comments: DataFrame | None = None,
    compat: bool = False,
    older: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(enriched table, ids that were not found).

    ``older`` holds versions of earlier builds and the ids these builds looked up in them.
    Only ids that are new and not among ``versions`` are looked up there, which is rare:
    without such an id the older texts are not read at all.
    """
    if existing is not None:
        check_fields(existing, item_type)
    ids = materialise(ids_to_lookup(blocks, item_type, existing, inaccessible, comments, compat))
    found = lookup(ids, versions, item_type)
    if older is not None:
        earlier, asked = older
        found = materialise(found)
        rest = materialise(ids_not_found(ids, found).join(asked.select("id"), "id", "left_anti"))
        if not rest.isEmpty():
            found = found.unionByName(lookup(rest, earlier, item_type))
    rows = found if existing is None else merge_lookups(found, existing, item_type)
    return attach_score(rows, blocks, item_type), ids_not_found(ids, found)
