"""Specification documents.

Long form in: ``spec_rows(page_id, pos, label, info, alt, colours)`` from the
page tokeniser.  Values are normalised with built-ins, labels are joined to
the dictionary (a fixed 142-row table, always broadcast), and each page's entries
are assembled into a two-level map written as JSON text with sorted keys.

Scale notes: the only shuffle is that of one aggregation by page, which collects a
page's entries on the map side first; the two levels of its map are made inside the row.
A page's entries come from one body, so every group is bounded by a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.data.spec_labels import MARK_ABSENT, MARK_PRESENT
from tidemark.functions.text import colour_entry, drop_last_char, joined_or_fallback

# Fixed value: the label whose cell holds a colour list.
COLOUR_LABEL = "车身颜色"


def colour_list(colours: Column | str) -> Column:
    """H12 + D4: 'title:style[-7:]' entries joined by ',' in page order."""
    c = F.col(colours) if isinstance(colours, str) else colours
    return F.coalesce(
        F.array_join(F.transform(c, lambda x: colour_entry(x["title"], x["style"])), ","),
        F.lit(""))


def cell_text(label: Column, info: Column, alt: Column, colours: Column,
              colour_label: str = COLOUR_LABEL) -> Column:
    """Colour cell, else the info spans, else the fallback divs."""
    return F.when(label == F.lit(colour_label), colour_list(colours)).otherwise(
        joined_or_fallback(info, alt))


def normalise_marker(text: Column) -> tuple[Column, Column]:
    """The whole text '●' -> flag (stored as integer 1), '-' -> '',
    anything else unchanged.  Returns (value, is_flag)."""
    is_flag = F.coalesce(text == F.lit(MARK_PRESENT), F.lit(False))
    value = F.when(is_flag, F.lit(None).cast("string")).when(
        text == F.lit(MARK_ABSENT), F.lit("")).otherwise(text)
    return value, is_flag


def spec_values(rows: DataFrame, dictionary: DataFrame, page: str = "page_id",
                raw_labels: bool = True) -> DataFrame:
    """C4 (+ H13, H17, H11): label rows -> (page, pos, grp, item, value, is_flag).

    ``raw_labels``: labels still carry their last character (the colon) and
    are cut here; rows whose cut label is empty are skipped.  The join is an
    inner equi join on the exact label, 1:N (one label may feed two keys).
    """
    label = drop_last_char("label") if raw_labels else F.col("label")
    prepared = rows.select(page, "pos", label.alias("label"), "info", "alt", "colours")
    prepared = prepared.filter(F.col("label") != F.lit(""))
    text = cell_text(F.col("label"), F.col("info"), F.col("alt"), F.col("colours"))
    value, is_flag = normalise_marker(text)
    normalised = prepared.select(page, "pos", "label", value.alias("value"),
                                 is_flag.alias("is_flag"))
    # the dictionary is a fixed small table (142 rows), but made from rows it has no size the
    # planner knows: without the hint the pages' rows are broadcast, or dealt by a few labels
    joined = normalised.join(F.broadcast(dictionary), "label", "inner")
    return joined.select(page, "pos", "grp", "item", "value", "is_flag")


def _document(entries: Column) -> Column:
    """The two-level map of entries in order of (grp, item, pos): the last of each (grp, item)."""
    def of_item(x, i):
        then = F.get(entries, i + 1)
        return ~(then["grp"].eqNullSafe(x["grp"]) & then["item"].eqNullSafe(x["item"]))

    last = F.filter(entries, of_item)
    groups = F.array_distinct(F.transform(last, lambda x: x["grp"]))

    def items(g):
        mine = F.filter(last, lambda x: (x["grp"] == g) & x["item"].isNotNull())
        return F.map_from_entries(F.transform(mine, lambda x: F.struct(
            x["item"].alias("key"),
            F.when(x["is_flag"], F.lit(1).cast("variant")).otherwise(x["value"].cast("variant")).alias("value"))))

    return F.map_from_entries(F.transform(groups, lambda g: F.struct(g.alias("key"), items(g).alias("value"))))


def assemble_documents(values: DataFrame, pages: DataFrame | None = None,
                       page: str = "page_id", content: str = "content") -> DataFrame:
    """D3 + H15: one JSON document per page; last value per (grp, item) wins;
    keys sorted; the flag is the integer 1.  Pages listed in ``pages`` with no
    matching entry get '{}'."""
    v = values.select(page, "pos", "grp", "item", "value", "is_flag")
    if pages is not None:
        # one marker row per listed page (duplicates fall into the same empty
        # group, so no distinct -- and no extra shuffle -- is needed)
        marker = pages.select(
            page, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("grp"),
            F.lit(None).cast("string").alias("item"), F.lit(None).cast("string").alias("value"),
            F.lit(None).cast("boolean").alias("is_flag"))
        v = v.unionByName(marker)
    # one list of entries per page, combined before the shuffle
    e = F.struct("grp", "item", "pos", "value", "is_flag")
    docs = v.groupBy(page).agg(F.array_sort(F.collect_list(F.when(F.col("grp").isNotNull(), e))).alias("_e"))
    return docs.select(page, F.to_json(_document(F.col("_e"))).alias(content))
