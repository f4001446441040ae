"""Queries of entity resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from varzea.functions.scalars import cosine, fold_key, token_jaccard
from varzea.operators import neighbours, resolve
from varzea.plans.bindings import LOCATED_SQL, PLACES_SQL, RAW_SQL, located, places, raw_rows, table
from varzea.plans.registry import query

_KM = "2 * 6371.0 * atan2(sqrt({a}), sqrt(1 - {a}))".format(
    a="(pow(sin(radians(place_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(place_lat)) * pow(sin(radians(place_lng - lng) / 2), 2))"
)


@query("SELECT o.o_orderkey AS o_orderkey, l.l_linenumber AS l_linenumber FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def working_with_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per working row and canonical version, also without a version."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber")


@query("SELECT c_custkey, s_suppkey FROM customer LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey")
def first_canonical_of_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each candidate one canonical record of its territory, the least id."""
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_suppkey").alias("s_suppkey"))
    return table(spark, sf_dir, "customer").join(s, "c_nationkey", "left").select("c_custkey", "s_suppkey")


@query("SELECT c_nationkey AS place, max(c_custkey) AS rio, arg_max(c_name, c_custkey) AS ref FROM customer GROUP BY 1")
def last_of_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.max("c_custkey").alias("rio"), F.max_by("c_name", "c_custkey").alias("ref"))


@query(f"SELECT id, CASE WHEN id > m THEN m END AS duplicate_of FROM (SELECT id, min(id) OVER (PARTITION BY content_hash, uf, entity_type) AS m FROM ({RAW_SQL}))")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.exact_duplicates(raw_rows(spark, sf_dir), ["content_hash", "uf", "entity_type"], "id").select("id", "duplicate_of")


_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda x: CAST(x[1] AS DOUBLE) * CAST(x[2] AS DOUBLE)))"
_SIM = f"{_DOT.format(a='a.embedding', b='b.embedding')} / (sqrt({_DOT.format(a='a.embedding', b='a.embedding')}) * sqrt({_DOT.format(a='b.embedding', b='b.embedding')}))"


@query(
    f"SELECT a, b, CAST(floor(similarity * 1000000 + 0.5) AS BIGINT) AS similarity_e6 FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS r FROM (SELECT a.vec_id AS a, b.vec_id AS b, {_SIM} AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE similarity > 0.3) WHERE r <= 10"
)
def knn_in_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    found = resolve.knn_in_block(e, ["label"], "vec_id", "embedding", 10, 0.3)
    return found.select("a", "b", F.floor(F.col("similarity") * 1000000 + 0.5).alias("similarity_e6"))


@query(f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN {_SIM} > 0.999999 THEN 1 ELSE 0 END) AS BIGINT) AS same FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id")
def cosine_with_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(cosine(F.col("embedding"), F.col("embedding")).alias("s")).agg(F.count("*").alias("n"), F.count_if(F.col("s") > 0.999999).alias("same"))


@query("SELECT c_custkey, n_nationkey AS place_code FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE n_name || '?' END AS typed FROM customer JOIN (SELECT n_nationkey AS k, n_name, n_regionkey FROM nation) ON k = c_nationkey) c LEFT JOIN (SELECT n_nationkey, n_name AS pn, n_regionkey AS pr FROM nation) p ON lower(pn) = lower(typed) AND pr = n_regionkey")
def exact_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed names, half of them wrong, looked up within their region."""
    p = places(spark, sf_dir)
    c = table(spark, sf_dir, "customer").join(p, F.col("c_nationkey") == F.col("place_code"))
    typed = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("place_name")).otherwise(F.concat("place_name", F.lit("?"))).alias("typed"), F.col("place_region").alias("region"))
    return resolve.exact_place(typed, p, "typed", "region").select("c_custkey", F.col("place_code").cast("int").alias("place_code"))


@query()
def fuzzy_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelt nation names, best match of the region at 88 or more (token-sort Indel ratio: no SQL)."""
    p = places(spark, sf_dir)
    c = table(spark, sf_dir, "customer").join(p, F.col("c_nationkey") == F.col("place_code"))
    typed = c.select("c_custkey", F.concat(F.initcap("place_name"), F.lit("s")).alias("typed"), F.col("place_region").alias("region"))
    return resolve.fuzzy_place(typed, p, "c_custkey", "typed", "region")


def misspelt(name: Column, key: Column) -> Column:
    """Words turned round, a letter left out or doubled, or the name as it is."""
    words = F.split(name, " ")
    turned = F.array_join(F.reverse(words), " ")
    return F.when(key % 4 == 0, turned).when(key % 4 == 1, F.concat(F.substring(name, 1, 3), F.substring(name, 5, 200))).when(key % 4 == 2, F.concat(F.upper(name), F.substring(name, -1, 1))).otherwise(name)


@query()
def fuzzy_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District hints, some misspelt, looked up among their municipality's districts (a brand's parts) at 88 or more (no SQL)."""
    p = table(spark, sf_dir, "part")
    districts = p.select(F.col("p_partkey").alias("place_code"), F.col("p_name").alias("place_name"), F.col("p_brand").alias("place_region"))
    hints = p.select("p_partkey", misspelt(F.col("p_name"), F.col("p_partkey")).alias("hint"), "p_brand")
    return resolve.fuzzy_place(hints, districts, "p_partkey", "hint", "p_brand").select("p_partkey", "place_code", "ratio")


@query()
def place_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best search result of a brand's for misspelt and shortened names, 85 or more by the token-set ratio (no SQL)."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    short = F.array_join(F.slice(F.split("p_name", " "), 1, 3), " ")
    rows = p.select(k.alias("id"), "p_brand", F.when(k % 5 == 0, short).otherwise(misspelt(F.col("p_name"), k)).alias("name"))
    results = p.filter("p_partkey % 3 <> 0").select("p_brand", k.alias("position"), F.col("p_name").alias("other"))
    return resolve.best_match(rows, results, "p_brand", "id", "name", "other").select("id", "position", "ratio")


@query()
def knn_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to ten neighbours of a label by a k-means index (approximate: recall is measured against knn_in_block in a test). Queries
    are the rows whose id is divisible by 50, against all rows."""
    e = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_by_cells(e, ["label"], "vec_id", "embedding", 10, 0.2, asking=F.col("vec_id") % 50 == 0).select("label", "a", "b", "rank")


@query(
    f"SELECT id, place_code, floor(km * 1000 + 0.5) / 1000 AS km FROM (SELECT id, place_code, {_KM} AS km FROM ({LOCATED_SQL}) CROSS JOIN ({PLACES_SQL})) WHERE km <= 120 QUALIFY row_number() OVER (PARTITION BY id ORDER BY km, place_code) = 1"
)
def nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.nearest_place(located(spark, sf_dir), places(spark, sf_dir), "id", 120.0)
    return found.select("id", "place_code", (F.floor(F.col("km") * 1000 + 0.5) / 1000).alias("km"))


@query(
    f"""WITH near AS (SELECT id, place_code FROM (SELECT id, place_code, {_KM} AS km FROM ({LOCATED_SQL}) CROSS JOIN ({PLACES_SQL})) WHERE km <= 60 QUALIFY row_number() OVER (PARTITION BY id ORDER BY km, place_code) = 1)
SELECT l.id AS id, coalesce(CASE WHEN l.id % 3 = 0 THEN l.nation END, near.place_code, CASE WHEN l.id % 5 = 0 THEN l.nation END) AS place_code,
 CASE WHEN l.id % 3 = 0 THEN 'name' WHEN near.place_code IS NOT NULL THEN 'near' WHEN l.id % 5 = 0 THEN 'hint' END AS resolved_via FROM ({LOCATED_SQL}) l LEFT JOIN near ON near.id = l.id"""
)
def cascade_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, then the nearest seat within 60 km, then a hint."""
    rows, p = located(spark, sf_dir), places(spark, sf_dir)
    name = rows.filter("id % 3 = 0").select("id", F.col("nation").alias("place_code"))
    near = resolve.nearest_place(rows, p, "id", 60.0).select("id", "place_code")
    hint = rows.filter("id % 5 = 0").select("id", F.col("nation").alias("place_code"))
    return resolve.cascade(rows, "id", [("name", name), ("near", near), ("hint", hint)], "place_code").select("id", "place_code", "resolved_via")


@query(
    """SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN b.p_partkey IS NULL THEN 'added' WHEN a.p_partkey IS NULL THEN 'removed' WHEN lower(a.n) <> lower(b.n) THEN 'renamed' ELSE 'same' END AS status
FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN p_name || ' x' ELSE upper(p_name) END AS n FROM part WHERE p_partkey % 7 <> 0) a FULL JOIN (SELECT p_partkey, p_name AS n FROM part WHERE p_partkey % 5 <> 0) b ON a.p_partkey = b.p_partkey"""
)
def code_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("n"))
    new = p.filter("p_partkey % 7 <> 0").withColumn("n", F.when(F.col("p_partkey") % 11 == 0, F.concat("n", F.lit(" x"))).otherwise(F.upper("n")))
    return resolve.code_diff(new, p.filter("p_partkey % 5 <> 0"), "p_partkey", "n").select("p_partkey", "status")


@query("SELECT DISTINCT o_custkey AS parent FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def missing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("parent"))
    return resolve.missing_parents(children, table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("parent")), "parent")


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = CASE WHEN o_orderkey % 4 = 0 THEN 'bad' ELSE CAST(o_custkey AS VARCHAR) END")
def parent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents by a text id; an id that is no number finds nothing."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "bad").otherwise(F.col("o_custkey").cast("string")).alias("ref"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("ref"), "c_name")
    return o.join(c, "ref", "left").select("o_orderkey", "c_name")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def active_by_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest contact per key that has not opted out."""
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").withColumn("n", F.row_number().over(w)).filter("n = 1").select("o_custkey", "o_orderkey")


@query("SELECT doc_id, coalesce(quality, -1) AS category FROM documents LEFT JOIN labels USING (doc_id)")
def category_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("category"))


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS is_candidate FROM customer")
def membership_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_in", F.lit(True))
    return table(spark, sf_dir, "customer").join(ids, "c_custkey", "left").select("c_custkey", F.coalesce("_in", F.lit(False)).alias("is_candidate"))


@query("SELECT user_id AS ref, 'event' AS kind FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') UNION ALL SELECT c_custkey, 'poison' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def cards_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poison rows join the cards only if their reference is not there yet."""
    events = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").alias("ref")).distinct()
    poison = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ref")).join(events, "ref", "left_anti")
    return events.withColumn("kind", F.lit("event")).unionByName(poison.withColumn("kind", F.lit("poison")))


_TOKENS = "list_distinct(string_split_regex(lower(trim({x})), '\\s+'))"
_JACCARD = "floor(len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) * 10000 + 0.5) / 10000".format(a=_TOKENS.format(x="a.p_name"), b=_TOKENS.format(x="b.p_name"))


@query(f"SELECT a.p_partkey AS a, b.p_partkey AS b, {_JACCARD} AS similarity FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey")
def token_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within (brand, type, size) blocks."""
    similarity = lambda x, y: [token_jaccard(x["p_name"], y["p_name"]).alias("similarity")]
    return resolve.pairs_by_class(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"], ["p_name"], "p_partkey", similarity)


@query(
    """SELECT a.p_partkey AS a, b.p_partkey AS b, concat_ws(',', CASE WHEN a.p_brand = b.p_brand THEN 'brand' END, CASE WHEN a.p_size = b.p_size THEN 'size' END) AS matched, concat_ws(',', CASE WHEN a.p_brand <> b.p_brand THEN 'brand' END, CASE WHEN a.p_size <> b.p_size THEN 'size' END) AS diverged
FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey"""
)
def matched_and_diverged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields of a duplicate pair agree; scoring fields are left out."""
    fields = {"brand": "p_brand", "size": "p_size"}

    def compare(x: Column, y: Column) -> list[Column]:
        named = lambda holds: F.concat_ws(",", *(F.when(holds(x[c], y[c]), k) for k, c in fields.items()))
        return [named(lambda v, w: v == w).alias("matched"), named(lambda v, w: v != w).alias("diverged")]

    return resolve.pairs_by_class(table(spark, sf_dir, "part"), ["p_name", "p_type"], list(fields.values()), "p_partkey", compare)


@query("SELECT c_mktsegment AS folded, count(*) AS n FROM customer GROUP BY 1")
def folded_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that differ by case and blanks only fall together."""
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("x"))
    return c.groupBy(F.upper(fold_key(F.col("x"))).alias("folded")).agg(F.count("*").alias("n"))
