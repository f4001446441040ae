"""Landed web pages: embedded values, links, breadcrumbs, and nodes of embedded JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varzea.shared import checkpointed


def cards(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("n_links"),
        F.expr(r"try_cast(regexp_extract(html, 'track\\((\\d+)\\)', 1) AS BIGINT)").alias("island"),
    )


def breadcrumb(pages: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """The texts of the navigation block in order, without those in `drop`."""
    block = F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1)
    items = F.regexp_extract_all(block, F.lit(">([^<>]+)<"), F.lit(1))
    if drop:
        items = F.filter(items, lambda x: ~x.isin(drop))
    return pages.select("page_id", F.array_join(items, " > ").alias("breadcrumb"))


def json_island(pages: DataFrame, marker: str) -> DataFrame:
    """(page_id, body): the URL-decoded string literal that follows the marker in a script."""
    literal = F.regexp_extract("html", rf'(?s)<script[^>]*>[^<]*{marker}[^"<]*"([^"]*)"', 1)
    return pages.select("page_id", F.try_url_decode(F.nullif(literal, F.lit(""))).alias("body")).filter("body IS NOT NULL")


#: levels of a JSON text that are opened between two checkpoints
LEVELS = 8


def _children(v: Column) -> Column:
    """The objects and arrays directly in a variant; a string that holds JSON is opened, other scalars fall out."""
    inside = lambda x: F.coalesce(F.map_values(F.try_variant_get(x, "$", "map<string,variant>")), F.try_variant_get(x, "$", "array<variant>"))
    text = lambda x: F.try_variant_get(x, "$", "string")
    opened = lambda x: F.when(inside(x).isNotNull(), x).when(text(x).rlike(r"^\s*[{\[]"), F.try_parse_json(text(x)))
    return F.filter(F.transform(inside(v), opened), lambda x: x.isNotNull())


def find_nodes(rows: DataFrame, row_id: str, body: str, is_node: Callable[[Column], Column], limit: int = 40) -> DataFrame:
    """(row_id, node) of every object in a JSON text for which `is_node` holds, as a variant; strings that hold JSON are opened.

    One level of all documents at a time, `limit` levels at most: a level gives its nodes, which later levels pass on, and the objects
    and arrays in it; scalars are no rows. LEVELS levels are one pass, then rows are checkpointed. Rows are dealt over all tasks first,
    as a small file of pages would be opened by one. A text that is no JSON has no nodes."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    entry = lambda v, found: F.struct(v.alias("v"), F.lit(found).alias("found"))
    v, none = F.col("v"), F.array().cast("array<struct<v:variant,found:boolean>>")
    own = F.when(is_node(v), F.array(entry(v, True))).otherwise(none)
    inner = F.coalesce(F.transform(_children(v), lambda x: entry(x, False)), none)
    level = rows.select(F.col(row_id).alias("_row"), body).repartition(tasks).select("_row", F.try_parse_json(body).alias("v"), F.lit(False).alias("found")).filter("v IS NOT NULL")
    for depth in range(limit + 1):
        level = level.select("_row", F.explode(F.when(F.col("found"), F.array(entry(v, True))).otherwise(F.concat(own, inner))).alias("_one")).select("_row", "_one.v", "_one.found")
        if depth % LEVELS == LEVELS - 1:
            level = checkpointed(level)
            if level.filter("NOT found").isEmpty():
                break
    return level.filter("found").select(F.col("_row").alias(row_id), v.alias("node"))


def has_key(key: str) -> Callable[[Column], Column]:
    return lambda v: F.try_variant_get(v, f"$.{key}", "variant").isNotNull()


# Fixed value: the type name of a listing's cards.
CARD_TYPE = "WebPresentation_SingleFlexCardSection"


def flex_cards(rows: DataFrame, row_id: str, body: str) -> DataFrame:
    """(row_id, name, location_id, rating, review_count, category) of the cards in a listing's JSON; a card without an id that is a
    number is passed over, what else is missing is empty or 0."""
    typed = lambda v: F.try_variant_get(v, "$.__typename", "string") == CARD_TYPE
    n = find_nodes(rows, row_id, body, typed)
    get = lambda path, kind: F.try_variant_get("node", f"$.singleFlexCardContent.{path}", kind)
    cards = n.select(
        row_id, F.coalesce(get("cardTitle.text", "string"), F.lit("")).alias("name"), get("cardLink.webRoute.typedParams.detailId", "string").try_cast("bigint").alias("location_id"),
        F.coalesce(get("bubbleRating.rating", "double"), F.lit(0.0)).alias("rating"), F.coalesce(get("bubbleRating.reviewCount", "int"), F.lit(0)).alias("review_count"),
        F.coalesce(get("primaryInfo.text", "string"), F.lit("")).alias("category"),
    )
    return cards.filter("location_id IS NOT NULL")
