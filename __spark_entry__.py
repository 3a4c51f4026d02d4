"""Registered queries: each operator over the whole test tables, and the SQL to check it."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from minelark.functions.text import narrow_hash_parameters
from minelark.operators import baskets as B
from minelark.operators import clusters as C
from minelark.operators import links as L
from minelark.operators import neardup as N
from minelark.operators import similarity as S
from minelark.plans.lineage import new_path, settle
from minelark.plans.skew import spread
from minelark.sources import readers, sinks
from minelark.sources.views import load

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# friend suggestions


@query
def adjacency_parse(spark, sf_dir):
    lists = L.parse_adjacency(load(spark, sf_dir, "adjacency_lines"))
    rows = lists.select("user", F.size("friends").cast("long").alias("n_friends"), F.explode_outer("friends").alias("friend"))
    return rows.na.fill(-1, ["friend"])  # -1: a user without friends


@query
def common_neighbour_pairs(spark, sf_dir):
    return L.common_neighbour_pairs(settle(load(spark, sf_dir, "edges")))


@query
def common_neighbour_pairs_split(spark, sf_dir):
    """The same with groups of more than 20 cut into blocks."""
    return L.common_neighbour_pairs(settle(load(spark, sf_dir, "edges")), hot_rows=20)


@query
def friend_suggestions_topn(spark, sf_dir):
    return L.top_suggestions(settle(load(spark, sf_dir, "edges")), 10)


@query
def friend_suggestions_ranked(spark, sf_dir):
    """The same by counting every pair."""
    return L.ranked_suggestions(L.suggestions(common_neighbour_pairs(spark, sf_dir)), 10)


@query
def friend_suggestion_lines(spark, sf_dir):
    return L.suggestion_lines(friend_suggestions_topn(spark, sf_dir))


def suggested_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From text lines to scored suggestions."""
    edges = settle(L.friend_edges(L.parse_adjacency(load(spark, sf_dir, "friend_lines"))))
    return L.suggestions(L.common_neighbour_pairs(edges))


@query
def friend_suggestions_all(spark, sf_dir):
    return L.rank_all(suggested_from_lines(spark, sf_dir))


@query
def friend_suggestion_lines_all(spark, sf_dir):
    return L.suggestion_lines(L.rank_all(suggested_from_lines(spark, sf_dir)), ids_per_line=20, ranks_once=True)


# tables written as text, and read back by the readers


def staged(df: DataFrame, sep: str | None = None) -> str:
    """The path of a table written to the shared folder as lines, or with ``sep`` as a delimited table."""
    path = new_path(df.sparkSession)
    sinks.write_lines(df, path) if sep is None else sinks.write_table(df, path, sep)
    return path


@query
def adjacency_file(spark, sf_dir):
    lists = readers.read_adjacency(spark, staged(load(spark, sf_dir, "adjacency_lines")))
    rows = lists.select("user", F.size("friends").cast("long").alias("n_friends"), F.explode_outer("friends").alias("friend"))
    return rows.na.fill(-1, ["friend"])


@query
def conditions_file(spark, sf_dir):
    return readers.read_conditions(spark, staged(load(spark, sf_dir, "conditions"), ","))


@query
def inferred_table_file(spark, sf_dir):
    """A table whose types are found from its text: whole numbers, fractions, dates, truth values, text and nothing."""
    found = readers.read_table(spark, staged(load(spark, sf_dir, "mixed_types"), "|"), "|", types="infer")
    types = F.concat_ws(",", *[F.typeof(c) for c in found.columns]).alias("types")
    return found.select("*", types).withColumns({
        "shipped": F.date_format("shipped", "yyyy-MM-dd"), "reduced": F.col("reduced").cast("int").cast("bigint"),
    })


@query
def ratings_file(spark, sf_dir):
    ratings = load(spark, sf_dir, "ratings").withColumnsRenamed({"user_id": "userId", "item_id": "movieId"})
    return readers.read_ratings(spark, staged(ratings, ","))


@query
def movies_file(spark, sf_dir):
    return readers.read_movies(spark, staged(load(spark, sf_dir, "movies").withColumnRenamed("item_id", "movieId"), ","))


@query
def features_file(spark, sf_dir):
    """Features below further header rows, which have no numeric key."""
    table = feature_table(spark, sf_dir).withColumn("feature", F.col("feature").cast("string"))
    notes = spark.createDataFrame([("statistics",), ("number",), (None,)], "feature string")
    read = readers.read_features(spark, staged(notes.unionByName(table, allowMissingColumns=True), ","))
    names = [f"`f.{p}`" for p in range(64)]
    return read.select(F.col("feature").alias("id"), F.posexplode(F.array(*names)).alias("dim", "value")).withColumn(
        "value", F.round("value", 4)
    )


# baskets


@query
def baskets(spark, sf_dir):
    return B.baskets(load(spark, sf_dir, "conditions"), "PATIENT", "CODE")


@query
def item_support(spark, sf_dir):
    return B.item_support(baskets(spark, sf_dir))


def average_support(support: DataFrame) -> Column:
    return support.agg(F.ceil(F.avg("n"))).scalar()


def mined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Baskets, item support and the items with at least average support, stored for reuse."""
    rows = settle(baskets(spark, sf_dir))
    support = settle(B.item_support(rows))
    return rows, support, B.frequent_items(support, support.agg(F.ceil(F.avg("n"))).scalar())


def basket_count(rows: DataFrame) -> Column:
    return rows.agg(F.count_distinct("basket")).scalar()


@query
def frequent_items(spark, sf_dir):
    return mined(spark, sf_dir)[2]


@query
def infrequent_items(spark, sf_dir):
    return B.frequent_items(item_support(spark, sf_dir), 1000, keep="below")


@query
def frequent_pairs(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    return B.frequent_pairs(rows, items)


@query
def frequent_pairs_split(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    return B.frequent_pairs(rows, items, hot_rows=20)


@query
def frequent_triples_pruned(spark, sf_dir):
    """Triples held by two baskets, from pairs held by two: rarer ones are left out level by level."""
    rows, _, items = mined(spark, sf_dir)
    return B.frequent_itemsets(rows, items, 3, min_support=2).withColumnsRenamed({"i1": "i", "i2": "j", "i3": "z"})


@query
def ordered_pairs(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    return B.ordered_pairs(B.frequent_pairs(rows, items), items)


@query
def frequent_triples_top10(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    return B.frequent_triples(rows, items)


@query
def ordered_triples(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    triples = B.frequent_itemsets(rows, items, 3).withColumnsRenamed({"i1": "i", "i2": "j", "i3": "z"})
    return B.ordered_triples(triples, B.frequent_pairs(rows, items), items)


@query
def association_rules(spark, sf_dir):
    rows, support, items = mined(spark, sf_dir)
    rules = B.association_rules(B.frequent_pairs(rows, items), support, support, basket_count(rows), 0.05, 0.01)
    return rounded(rules, 6, "confidence", "interest")


@query
def association_rules_from_triples(spark, sf_dir):
    rows, support, items = mined(spark, sf_dir)
    triples, pairs = B.frequent_itemsets(rows, items, 3), B.frequent_pairs(rows, items)
    rules = B.association_rules(triples, pairs, support, basket_count(rows), 0.05, 0.05)
    return rounded(rules, 6, "confidence", "interest")


@query
def legacy_rule_scores(spark, sf_dir):
    rows, _, items = mined(spark, sf_dir)
    pairs = settle(B.ordered_pairs(B.frequent_pairs(rows, items), items))
    return rounded(B.legacy_rule_bounds(pairs), 6, "confidence")


@query
def code_description_dim(spark, sf_dir):
    return B.diagnosis_dim(load(spark, sf_dir, "conditions"))


# near-duplicate documents


@query
def document_parse(spark, sf_dir):
    parsed = N.parse_documents(load(spark, sf_dir, "document_lines"))
    return parsed.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


@query
def document_copies(spark, sf_dir):
    return N.document_copies(N.clean_documents(load(spark, sf_dir, "docs")))


def distinct_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.shingle_sets(N.distinct_documents(N.clean_documents(load(spark, sf_dir, "docs"))))


@query
def shingle_counts(spark, sf_dir):
    return distinct_sets(spark, sf_dir).select("doc_id", F.size("codes").cast("long").alias("n"))


@query
def minhash_signatures(spark, sf_dir):
    signatures = N.minhash(distinct_sets(spark, sf_dir))
    return signatures.select("doc_id", F.posexplode("signature").alias("seed", "value"))


@query
def minhash_narrow(spark, sf_dir):
    """The older hash, of a hundred values and one multiplier."""
    signatures = N.minhash(distinct_sets(spark, sf_dir), narrow_hash_parameters(100), 100)
    return signatures.select("doc_id", F.posexplode("signature").alias("seed", "value"))


@query
def minhash_given_hashes(spark, sf_dir):
    """Hashes given by the caller, by another prime."""
    signatures = N.minhash(distinct_sets(spark, sf_dir), oracles.GIVEN_HASHES, oracles.GIVEN_PRIME)
    return signatures.select("doc_id", F.posexplode("signature").alias("seed", "value"))


@query
def lsh_band_candidates(spark, sf_dir):
    return N.lsh_candidates(settle(N.band_keys(N.minhash(distinct_sets(spark, sf_dir)))))


@query
def lsh_bucket_members(spark, sf_dir):
    members = N.bucket_members(settle(N.band_keys(N.minhash(distinct_sets(spark, sf_dir)))))
    return members.select("band", "doc_id", "first_id", F.array_join(F.transform("key", lambda x: x.cast("string")), ",").alias("key"))


@query
def lsh_star_jaccard(spark, sf_dir):
    """One measured pair per member of a bucket."""
    return rounded(N.near_duplicate_stars(load(spark, sf_dir, "docs"))[0], 6, "jaccard")


@query
def lsh_candidates_of_some(spark, sf_dir):
    """All candidates of every twentieth document."""
    members = settle(N.bucket_members(N.banded_documents(load(spark, sf_dir, "docs"))))
    return N.candidates_of(members, load(spark, sf_dir, "docs").where("doc_id % 20 = 0"))


@query
def lsh_jaccard(spark, sf_dir):
    return rounded(N.near_duplicates(load(spark, sf_dir, "docs")), 6, "jaccard")


@query
def lsh_jaccard_lines(spark, sf_dir):
    return sinks.pair_lines(N.near_duplicates(load(spark, sf_dir, "docs")))


@query
def jaccard_all_pairs(spark, sf_dir):
    docs = N.clean_documents(load(spark, sf_dir, "docs"))
    marks = N.first_marks(docs)
    sets = N.shingle_sets(N.marked_documents(spread(docs), marks))
    return rounded(N.jaccard_join(sets, 0.5, texts=N.marked_documents(docs, marks)), 6, "jaccard")


# similarity


@query
def ratings_pivot(spark, sf_dir):
    return S.ratings_matrix(load(spark, sf_dir, "user_events"), "user_id", "item_id", oracles.EVENT_TYPES)


@query
def demeaned_matrix(spark, sf_dir):
    return rounded(S.demean_matrix(ratings_pivot(spark, sf_dir), "user_id"), 6, *oracles.EVENT_TYPES)


def stored_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(load(spark, sf_dir, "ratings"))


@query
def demeaned_ratings(spark, sf_dir):
    return rounded(S.demean(stored_ratings(spark, sf_dir)), 6, "mean", "centred")


@query
def similarity_to_item(spark, sf_dir):
    return rounded(S.similarity_to(stored_ratings(spark, sf_dir), 1), 6, "sim")


@query
def similarity_sign_counts(spark, sf_dir):
    return S.sign_counts(S.similarity_to(stored_ratings(spark, sf_dir), 1))


@query
def item_similarity(spark, sf_dir):
    return rounded(S.item_similarity(stored_ratings(spark, sf_dir)), 6, "sim")


@query
def item_similarity_split(spark, sf_dir):
    return rounded(S.item_similarity(stored_ratings(spark, sf_dir), hot_rows=20), 6, "sim")


@query
def user_similarity(spark, sf_dir):
    return rounded(S.user_similarity(stored_ratings(spark, sf_dir)), 4, "sim")


@query
def user_similarity_dimsum(spark, sf_dir):
    return rounded(S.sampled_user_similarity(stored_ratings(spark, sf_dir), 0.05), 4, "sim")


@query
def nearest_items(spark, sf_dir):
    return S.nearest_items(rounded(S.item_similarity(stored_ratings(spark, sf_dir)), 6, "sim"), 10)


@query
def predicted_ratings(spark, sf_dir):
    """For each rating, the same user's unrated cell of the next item."""
    ratings = stored_ratings(spark, sf_dir)
    wanted = ratings.select("user_id", (F.col("item_id") + 1).alias("item_id"))
    sims = rounded(S.item_similarity(ratings), 6, "sim")
    predicted = S.with_titles(S.predict(ratings, sims, wanted, 10), load(spark, sf_dir, "movies"))
    return rounded(predicted, 4, "predicted")


# clustering


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "vectors")
    return vectors.select(F.col("id").alias("feature"), *[F.col("features")[p].alias(f"f.{p}") for p in range(64)])


@query
def subset_semi_join(spark, sf_dir):
    small = C.subset_features(feature_table(spark, sf_dir), load(spark, sf_dir, "tracks"))
    return small.select(F.col("feature").alias("id"))


@query
def feature_slice(spark, sf_dir):
    vectors = C.feature_vectors(feature_table(spark, sf_dir), "f.3", "f.19")
    total = F.aggregate("features", F.lit(0.0), lambda t, x: t + x)
    return vectors.select("id", F.size("features").cast("long").alias("width"), F.round(total, 4).alias("total"))


@query
def l2_normalized(spark, sf_dir):
    scaled = C.l2_normalize(load(spark, sf_dir, "vectors"))
    return rounded(scaled.select("id", F.posexplode("features").alias("dim", "value")), 4, "value")


@query
def pairwise_distance(spark, sf_dir):
    vectors = load(spark, sf_dir, "vectors")
    first = vectors.groupBy("cluster").agg(F.min("id").alias("i"))
    pairs = vectors.join(first, "cluster").where("id > i").select("i", F.col("id").alias("j"))
    return rounded(C.pair_distance(vectors, pairs), 4, "d")


@query
def distance_extremes(spark, sf_dir):
    whole = load(spark, sf_dir, "vectors").withColumn("cluster", F.lit(0))
    extent = C.diameters(whole).join(C.min_distances(whole), "cluster").drop("cluster")
    return rounded(extent, 4, "diameter", "min_distance")


@query
def cluster_extent(spark, sf_dir):
    extent = C.cluster_extent(load(spark, sf_dir, "vectors"))
    return rounded(extent, 4, "diameter", "min_distance", "radius", "density")


@query
def centroids(spark, sf_dir):
    middles = C.centroids(load(spark, sf_dir, "vectors"))
    return rounded(middles.select("cluster", F.posexplode("centroid").alias("dim", "value")), 4, "value")


@query
def inter_cluster_distance(spark, sf_dir):
    return rounded(C.inter_cluster_distance(load(spark, sf_dir, "vectors")), 4, "mean_distance", "relative")


@query
def ward_merges(spark, sf_dir):
    return rounded(C.ward_merges(load(spark, sf_dir, "vectors")).drop("round"), 4, "height")


@query
def ward_merges_by_rounds(spark, sf_dir):
    """The same with cells of 64 and only the last 64 clusters in one task: the ring search does all before."""
    merges = C.ward_merges(load(spark, sf_dir, "vectors"), cell_rows=64, last_clusters=64)
    return rounded(merges.drop("round"), 4, "height")


@query
def ward_cut_k6(spark, sf_dir):
    vectors = load(spark, sf_dir, "vectors")
    return C.cut_tree(vectors, C.ward_merges(vectors), k=6)


@query
def cluster_summary(spark, sf_dir):
    return rounded(C.cluster_summary(load(spark, sf_dir, "vectors")), 4, "first_feature", "last_feature")


try:  # the operators for training text can be taken out of the library; nothing else needs them
    from minelark.llm.oracles import ORACLES as TEXT_SQL
    from minelark.llm.queries import QUERIES as TEXT_QUERIES

    import corpus_pipeline

    TEXT_QUERIES = {**TEXT_QUERIES, "pipeline": corpus_pipeline.run}
except ImportError:
    TEXT_QUERIES, TEXT_SQL = {}, {}


def entry(spark: SparkSession) -> DataFrame:
    """The best ten friend suggestions per user at the smallest scale."""
    return friend_suggestions_topn(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**_QUERIES, **TEXT_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**oracles.oracle_sql(), **TEXT_SQL}
