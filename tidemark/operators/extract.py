"""Entity extraction from capture bodies.

Everything is a built-in expression over the body column, so extraction is a
narrow stage: no shuffle, no Python.  The body is scanned once per capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructField, StructType

from tidemark.functions.json import json_object_text, parse_lenient
from tidemark.functions.regex import regex_matches
from tidemark.config import DEFAULT_SITE, SiteTemplates
from tidemark.functions.urls import from_template

# Record pattern of the brand script and the JSON field names
# of the list and search responses.
BRAND_PATTERN = r'type:\"(.*?)\",id:(.*?),name:\"(.*?)\",url:\"(.*?)\",cur'
BRAND_GROUPS = {"brand_type": 1, "third_id": 2, "name": 3, "brand_path": 4}
CAR_FIELDS = ["id", "name", "showName", "urlSpell", "pid", "goid", "goname", "csSale"]
VERSION_FIELDS = ["id", "name", "pid", "referprice", "salestate", "goname", "tt"]
SEARCH_SCHEMA = "Count string, ResList array<struct<SerialId: string>>"


def string_struct(fields: list[str]) -> StructType:
    """All fields read as text; typing happens at the sink."""
    return StructType([StructField(f, StringType(), True) for f in fields])


def extract_matches(df: DataFrame, body: str, pattern: str, groups: dict[str, int],
                    pos: str = "pos", drop_body: bool = True) -> DataFrame:
    """H2: one row per regex match with its position and named groups."""
    m = regex_matches(body, pattern, groups)
    keep = [c for c in df.columns if not (drop_body and c == body)]
    out = df.select(*keep, F.posexplode(m).alias(pos, "_m"))
    return out.select(*keep, pos, *[F.col("_m")[g].alias(g) for g in groups])


def dict_entries(m: Column) -> Column:
    """Entries of a parsed JSON object with dict semantics: a repeated key
    keeps the position of its first occurrence and the value of its last
    (``from_json`` keeps every occurrence)."""
    return _dict_order(F.map_entries(m))


def _dict_order(e: Column) -> Column:
    """``dict_entries`` over an array of (key, value) entries.  Objects without
    a repeated key (the normal case, checked with a hash-based distinct) are
    passed through; of the rest the keys are sorted with their positions, so that
    equal ones are neighbours."""
    unique = F.size(F.array_distinct(F.transform(e, lambda x: x["key"]))) == F.size(e)
    keys = F.array_sort(F.transform(e, lambda x, i: F.struct(x["key"].alias("key"), i.alias("pos"))))

    def ends(s: Column) -> Column:
        firsts = F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["key"] != x["key"]))
        lasts = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (F.get(s, i + 1)["key"] != x["key"]))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["pos"].alias("first"), b["pos"].alias("last")))

    # an array of one binds the sorted keys to a name: they are sorted once
    spans = F.array_sort(F.get(F.transform(F.array(keys), ends), 0))
    deduped = F.transform(spans, lambda p: F.struct(
        F.get(e, p["first"])["key"].alias("key"), F.get(e, p["last"])["value"].alias("value")))
    return F.when(unique, e).otherwise(deduped)


def explode_json_map(df: DataFrame, body: str, value_schema: DataType,
                     pos: str = "pos", key: str = "key", value: str = "value",
                     drop_body: bool = True, outer: bool = False) -> DataFrame:
    """H3-H5: JSONP text -> object with dynamic keys -> one row per entry,
    in the order of the text.  A body that does not parse gives no rows (see
    ``unparsable``); with ``outer`` every body also keeps one row when it has
    no entries (``pos`` NULL) and a ``parsed_ok`` flag, so entity rows and
    parse failures come out of one scan."""
    parsed = parse_lenient(json_object_text(body), MapType(StringType(), value_schema))
    keep = [c for c in df.columns if not (drop_body and c == body)]
    # parse once into a column; the dedup lambdas then read that column
    # (an expensive expression referenced several times is not inlined)
    tmp = df.select(*keep, F.map_entries(parsed).alias("_m"))
    gen = F.posexplode_outer if outer else F.posexplode
    extra = [F.col("_m").isNotNull().alias("parsed_ok")] if outer else []
    out = tmp.select(*keep, *extra, gen(_dict_order(F.col("_m"))).alias(pos, "_e"))
    return out.select(*keep, *(["parsed_ok"] if outer else []), pos,
                      F.col("_e.key").alias(key), F.col("_e.value").alias(value))


def explode_json_array(df: DataFrame, body: str, schema: DataType | str, array_field: str,
                       pos: str = "pos", element: str = "element",
                       keep_fields: list[str] | None = None,
                       drop_body: bool = True, outer: bool = False) -> DataFrame:
    """H6: strict-shaped JSON object -> its array field, one row per element;
    other top-level fields listed in ``keep_fields`` are carried; ``outer``
    keeps a document with an empty array as one row with a NULL element, and a
    body that does not parse as one with ``parsed_ok`` false."""
    keep = [c for c in df.columns if not (drop_body and c == body)]
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType(full.fields + [StructField("_bad", StringType())])
    parsed = F.from_json(F.col(body), full, {"columnNameOfCorruptRecord": "_bad"})
    tmp = df.select(*keep, parsed.alias("_doc"))
    ok = F.col("_doc").isNotNull() & F.col("_doc")["_bad"].isNull()
    if not outer:
        tmp = tmp.filter(ok)
    extra = [F.when(ok, F.col("_doc")[f]).alias(f) for f in (keep_fields or [])]
    gen = F.posexplode_outer if outer else F.posexplode
    return tmp.select(*keep, *([ok.alias("parsed_ok")] if outer else []), *extra,
                      gen(F.when(ok, F.col("_doc")[array_field])).alias(pos, element))


def unparsable(df: DataFrame, body: str, schema: DataType, reason: str = "unparsable") -> DataFrame:
    """Captures whose JSON does not parse (no '{', truncated, wrong shape)."""
    parsed = parse_lenient(json_object_text(body), schema)
    return df.filter(parsed.isNull()).withColumn("reason", F.lit(reason))


def non_empty(c: Column | str) -> Column:
    """B11 guard: not NULL and not ''."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & (col != F.lit(""))


# ----------------------------------------------------------------- entities

def brand_rows(seed_captures: DataFrame, body: str = "body",
               site: SiteTemplates = DEFAULT_SITE) -> DataFrame:
    """B1: brands from the seed script; priority 10000 - (pos + 1)."""
    m = extract_matches(seed_captures, body, BRAND_PATTERN, BRAND_GROUPS)
    return m.select(
        "*",
        from_template(site.brand_logo, "third_id").alias("remote_logo"),
        (F.lit(10000) - F.col("pos") - 1).alias("priority"))


def car_rows(car_list_captures: DataFrame, body: str = "body", outer: bool = False) -> DataFrame:
    """B2: cars from a brand's list; JSON names renamed to column names."""
    m = explode_json_map(car_list_captures, body, string_struct(CAR_FIELDS), outer=outer)
    v = F.col("value")
    keep = [c for c in m.columns if c not in ("key", "value")]
    return m.select(
        *keep,
        v["id"].alias("third_id"), v["name"].alias("name"),
        v["showName"].alias("show_name"), v["urlSpell"].alias("en_name"),
        v["pid"].alias("brand_third_id"), v["goid"].alias("factory_third_id"),
        v["goname"].alias("factory_name"), v["csSale"].alias("sale_state_raw"),
        (F.lit(9000) - F.col("pos") - 1).alias("priority"))


def version_rows(version_list_captures: DataFrame, body: str = "body",
                 outer: bool = False) -> DataFrame:
    """Versions (trims) of a car; ``goname`` is the model year here."""
    m = explode_json_map(version_list_captures, body, string_struct(VERSION_FIELDS), outer=outer)
    v = F.col("value")
    keep = [c for c in m.columns if c not in ("key", "value")]
    return m.select(
        *keep,
        v["pid"].alias("car_third_id"), v["id"].alias("third_id"), v["name"].alias("name"),
        v["referprice"].alias("refer_price"), v["salestate"].alias("sale_state"),
        v["goname"].alias("year_type"), v["tt"].alias("tt"))


def search_rows(search_captures: DataFrame, body: str = "body") -> DataFrame:
    """Level search page -> (Count, SerialId) rows, typed with try_cast;
    a page with an empty list gives one row with a NULL car (its Count still
    counts), one that does not parse or has no Count a row with ``parsed_ok``
    false.  ``car_ref`` is the car's id as text."""
    m = explode_json_array(search_captures, body, SEARCH_SCHEMA, "ResList",
                           element="_row", keep_fields=["Count"], outer=True)
    keep = [c for c in m.columns if c not in ("Count", "_row", "parsed_ok")]
    return m.select(*keep, (F.col("parsed_ok") & F.col("Count").isNotNull()).alias("parsed_ok"),
                    F.expr("try_cast(Count AS INT)").alias("reported_count"),
                    F.col("_row.SerialId").alias("car_ref"),
                    F.expr("try_cast(_row.SerialId AS INT)").alias("car_third_id"))
