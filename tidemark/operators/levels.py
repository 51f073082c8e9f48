"""Level (segment) assignment.

Two branches: search pages list the cars of a level; cars still without a
level are classified from a headline text.  The union is written with
first-write-wins on (car, level).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.data.spec_labels import LEVEL_SYNONYMS
from tidemark.functions.paging import page_count
from tidemark.functions.text import head_before, remap
from tidemark.operators.extract import non_empty
from tidemark.operators.sinks import insert_if_absent

# Fixed value: the headline is cut at this character ("No. n in ...").
RANK_SEPARATOR = "第"


def unassigned(cars: DataFrame, links: DataFrame, car_key: str = "third_id",
               link_key: str = "car_third_id", name: str = "en_name") -> DataFrame:
    """C1 + B10: cars with a non-blank name and no link (anti join).  The
    linked ids are deduplicated map-side first; the anti join reuses that
    partitioning, so a car with many links costs no extra shuffle."""
    linked = links.select(F.col(link_key).alias("_linked")).distinct()
    named = cars.filter(F.rtrim(F.col(name)) > F.lit(""))
    return named.join(linked, named[car_key] == F.col("_linked"), "left_anti")


def level_names(headlines: DataFrame, text: str = "headline",
                synonyms: dict[str, str] | None = None,
                sep: str = RANK_SEPARATOR) -> DataFrame:
    """H7 + H8: the text before the rank separator, remapped by synonyms."""
    syn = LEVEL_SYNONYMS if synonyms is None else synonyms
    return (headlines.filter(non_empty(text))
                     .withColumn("level_name", remap(head_before(text, sep), syn)))


def first_level_per_name(levels: DataFrame) -> DataFrame:
    """One level per name, the one with the smallest id."""
    pick = F.min_by(F.struct("level_id", "parent_level_id"), "id")
    return (levels.groupBy("level_name").agg(pick.alias("_l"))
                  .select("level_name", F.col("_l.level_id").alias("level_id"),
                          F.col("_l.parent_level_id").alias("parent_level_id")))


def expand_parents(matched: DataFrame, keep: list[str]) -> DataFrame:
    """(car, level) and, when the level has a parent, (car, parent)."""
    ids = F.filter(F.array(F.col("level_id"),
                           F.when(F.col("parent_level_id") != 0, F.col("parent_level_id"))),
                   lambda x: x.isNotNull())
    return matched.select(*keep, F.posexplode(ids).alias("link_pos", "level_id"))


def classify(headlines: DataFrame, levels: DataFrame, car_key: str = "car_third_id",
             text: str = "headline", synonyms: dict[str, str] | None = None) -> DataFrame:
    """Headline -> level name -> matching level (exact, case-sensitive) ->
    links incl. the parent; no match gives no row."""
    names = level_names(headlines, text, synonyms)
    matched = names.join(first_level_per_name(levels), "level_name", "inner")
    keep = [c for c in headlines.columns if c != text]
    return expand_parents(matched, keep)


def assign_levels(search_links: DataFrame, cars: DataFrame, headlines: DataFrame,
                  levels: DataFrame, existing: DataFrame | None = None,
                  car_key: str = "third_id", synonyms: dict[str, str] | None = None,
                  candidates: DataFrame | None = None) -> DataFrame:
    """Links to add to car2level (car_third_id, level_id, branch, ...).

    ``search_links`` (car_third_id, level_id, capture_seq, pos) come first;
    candidates for the text branch are cars with no link in ``existing``
    UNION the search links, since the search branch commits first; who has found
    them already passes them as ``candidates`` (car_third_id).
    ``headlines`` is (car_third_id, capture_seq, headline).
    """
    search = search_links.select("car_third_id", F.col("level_id").cast("int").alias("level_id"),
                                 F.lit(0).alias("branch"), "capture_seq", "pos")
    if candidates is None:
        linked = search.select("car_third_id")
        if existing is not None:
            linked = linked.unionByName(existing.select("car_third_id"))
        candidates = unassigned(cars, linked, car_key=car_key).select(F.col(car_key).alias("car_third_id"))
    texts = headlines.join(candidates, "car_third_id", "left_semi")
    by_text = classify(texts, levels, synonyms=synonyms).select(
        "car_third_id", F.col("level_id").cast("int").alias("level_id"), F.lit(1).alias("branch"),
        "capture_seq", F.col("link_pos").alias("pos"))
    union = search.unionByName(by_text)
    return insert_if_absent(existing, union, ["car_third_id", "level_id"],
                            ["branch", "capture_seq", "pos"])


def reported_totals(search_rows: DataFrame, level: str = "level_id", page: str = "page",
                    count: str = "reported_count", page_size: int = 100,
                    seq: str | None = None) -> DataFrame:
    """D1 + H9: per level the ``Count`` reported on its first page and the
    page count; a level whose first page reports nothing counts 0.  Of several
    captures of that page, the first by ``seq`` counts."""
    by = F.struct(F.col(page), F.col(seq)) if seq else F.col(page)
    first = search_rows.groupBy(level).agg(F.min_by(count, by).alias("_c"))
    c = F.coalesce(F.col("_c"), F.lit(0))
    return first.select(level, c.alias(count), page_count(c, page_size).alias("n_pages"))


def grand_total(totals: DataFrame, count: str = "reported_count",
                added: DataFrame | None = None):
    """D1 + D2: sum of reported counts plus the rows the text branch added,
    as a scalar subquery column."""
    reported = totals.agg(F.coalesce(F.sum(count), F.lit(0)).cast("long")).scalar()
    if added is None:
        return reported
    return reported + added.agg(F.count(F.lit(1)).cast("long")).scalar()
