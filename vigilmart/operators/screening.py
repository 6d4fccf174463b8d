"""Watchlist screening of current customers by name: exact after normalizing, and fuzzy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.functions.columns import match_name
from vigilmart.sources.workspace import by_rows, settle

GRAM = 3
COMPARED = 8  # keys whose join costs about as much as the comparison of one pair


def _listed_names(watchlist: DataFrame) -> DataFrame:
    return watchlist.select(match_name(F.col("name")).alias("listed_name"), "list_source").distinct()


def _named_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.where("is_current").select(
        "customer_id", "full_name", match_name(F.col("full_name")).alias("match_name")
    )


def sanctions_hits(dim_customer: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Current customers whose normalized name equals a listed one."""
    customers = _named_customers(dim_customer)
    listed = _listed_names(watchlist)
    return (
        customers.join(listed, customers["match_name"] == listed["listed_name"])
        .select("customer_id", "full_name", "list_source")
        .distinct()
    )


def _deletions(names: DataFrame, column: str, distance: int) -> DataFrame:
    """All texts left after deleting up to ``distance`` characters, with where they were.

    Of a run of one character the first is deleted, as all leave the same text; the gaps tell
    for each deleted character between which places of the rest it may have stood.
    """
    gap = "array<struct<low: int, high: int>>"
    ring = names.select(column, F.col(column).alias("_rest"), F.lit(1).alias("_from"), F.array().cast(gap).alias("_gaps"))
    every = ring
    rest, place = F.col("_rest"), F.col("_place")
    char, after = F.substring(rest, place, F.lit(1)), F.substring(rest, place, F.length(rest))
    run = F.length(after) - F.length(F.ltrim(after, char))
    stood = F.array(F.struct((place - 1).alias("low"), (place + run - 2).alias("high")))
    for _ in range(distance):
        ring = (
            ring.where(F.col("_from") <= F.length(rest))
            .select("*", F.explode(F.sequence(F.col("_from"), F.length(rest))).alias("_place"))
            .where((place == F.col("_from")) | (char != F.substring(rest, place - 1, F.lit(1))))
            .select(
                column,
                F.concat(F.substring(rest, F.lit(1), place - 1), F.substring(rest, place + 1, F.length(rest))).alias("_rest"),
                place.alias("_from"),
                F.concat("_gaps", stood).alias("_gaps"),
            )
        )
        every = every.unionByName(ring)
    return every


def _n_variants(length: Column, distance: int) -> Column:
    """An upper bound of the number of deletion variants of a text."""
    total = ring = F.lit(1.0)
    for k in range(distance):
        ring = ring * F.greatest(length - k, F.lit(0)) / (k + 1)
        total = total + ring
    return total


def _grams(text: Column) -> Column:
    """The GRAM-character pieces of a text, each with its place."""
    pieces = F.transform(
        F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.struct(F.substring(text, i, GRAM).alias("gram"), i.alias("place"))
    )
    return F.when(F.length(text) >= GRAM, pieces)


def _rarest(names: DataFrame, column: str, frequency: DataFrame, n: int) -> DataFrame:
    """``gram`` and ``place`` of the n rarest pieces of each name, under one order of all pieces.

    Other places of the last of them are in too, so that pieces of one text never tell apart
    what is among the rarest and what is not.
    """
    pieces = names.select(column, F.inline(_grams(F.col(column))))
    weighed = pieces.join(by_rows(frequency), "gram", "left").select(
        column, F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("gram"), F.col("place")).alias("_g")
    )
    every = weighed.groupBy(column).agg(F.array_sort(F.collect_list("_g")).alias("_all"))
    last = F.element_at("_all", n)
    first = F.filter("_all", lambda g: F.struct(g["n"], g["gram"]) <= F.struct(last["n"], last["gram"]))
    return every.select(column, F.explode(first).alias("_g")).select(column, "_g.gram", "_g.place")


def _by_variants(names: DataFrame, column: str, distance: int) -> DataFrame:
    """Digests of what deletions leave of each name, and the gaps."""
    left = _deletions(names, column, distance)
    return left.select(column, F.xxhash64("_rest").alias("key"), F.col("_gaps").alias(f"{column}_gaps"))


def _may_be_near(one: Column, other: Column, distance: int) -> Column:
    """Whether names with one rest can be near: what is not deleted on both sides at one gap,
    as a replaced character is, costs an edit of its own."""
    both = F.filter(one, lambda g: F.exists(other, lambda h: (g["low"] <= h["high"]) & (h["low"] <= g["high"])))
    return F.size(one) + F.size(other) - distance <= F.size(both)


def candidate_names(names: DataFrame, listed: DataFrame, max_distance: int) -> DataFrame:
    """Pairs of distinct names that may be within ``max_distance`` edits; none is missed.

    Each listed name is in one of two indexes, and every name asks both.

    *Rare pieces.* An edit changes at most GRAM pieces, so of two near names one of the
    GRAM * max_distance + 1 rarest pieces of each is among those of the other, at most
    ``max_distance`` places away. How rare a piece is follows from the list.

    *Deletion variants.* Numbered names have no rare pieces: what tells them apart are a few
    digits in the midst of zeros. Near names share a text that both reach by ``max_distance``
    deletions at gaps that go together, and others hardly ever do.

    The pieces of the names are counted by place, which tells how many names a listed one would
    meet on its pieces. It goes to the variants where these cost less, or where it is too short
    to have enough pieces. What is read twice is written. Pieces, variants and names are sent to
    all tasks only where they are few, as their files are far smaller than they are.
    """
    rare = GRAM * max_distance + 1
    enough = GRAM + GRAM * max_distance  # length from which a name has that many pieces
    # Short names become many keys each, so they are dealt out although they are small; by a hash
    # of their own, as Spark leaves out a second shuffle by the column of a first.
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.where("match_name is not null").repartition(parts, F.xxhash64("match_name"))
    listed = settle(listed.where("listed_name is not null"), "listed")
    n_listed = listed.count()
    long = listed.where(F.length("listed_name") >= enough + max_distance)
    pieces = long.select(F.explode(_grams(F.col("listed_name"))["gram"]).alias("gram"))
    frequency = settle(pieces.groupBy("gram").agg(F.count("*").alias("_n")), "gram-counts")
    asked = settle(_rarest(names.where(F.length("match_name") >= enough), "match_name", frequency, rare), "name-pieces")
    reach = F.explode(F.sequence(F.col("place") - max_distance, F.col("place") + max_distance))
    held = settle(_rarest(long, "listed_name", frequency, rare).withColumn("place", reach), "list-pieces")
    n_held = held.count()
    met = by_rows(asked.groupBy("gram", "place").agg(F.count("*").alias("_met")), asked.count())
    cost = held.join(met, ["gram", "place"], "left").groupBy("listed_name").agg(F.coalesce(F.sum("_met"), F.lit(0)).alias("_cost"))
    cheap = F.col("_cost") * COMPARED <= _n_variants(F.length("listed_name"), max_distance)
    routes = listed.join(by_rows(cost, n_listed), "listed_name", "left").select("listed_name", F.coalesce(cheap, F.lit(False)).alias("_by_pieces"))
    routes = settle(routes, "list-routes")

    held = held.join(by_rows(routes.where("_by_pieces"), n_listed), "listed_name", "left_semi")
    on_pieces = asked.join(by_rows(held, n_held), ["gram", "place"]).select("match_name", "listed_name")

    by_variants = routes.where("not _by_pieces").select("listed_name").repartition(parts, "listed_name")
    length = F.length("listed_name")
    n_left = by_variants.agg(F.sum(_n_variants(length, max_distance))).first()[0] or 0
    lengths = by_variants.select(F.explode(F.sequence(length - max_distance, length + max_distance)).alias("_length")).distinct()
    near = names.join(lengths, F.length("match_name") == F.col("_length"), "left_semi")
    left = by_rows(_by_variants(by_variants, "listed_name", max_distance), n_left)
    on_variants = _by_variants(near, "match_name", max_distance).join(left, "key")
    on_variants = on_variants.where(_may_be_near(F.col("match_name_gaps"), F.col("listed_name_gaps"), max_distance))
    return on_pieces.unionByName(on_variants.select("match_name", "listed_name")).distinct()


def similar_names(names: DataFrame, listed: DataFrame, max_distance: int) -> DataFrame:
    """Pairs of distinct names within ``max_distance`` edits, with their distance."""
    return (
        candidate_names(names, listed, max_distance)
        .withColumn("distance", F.levenshtein("match_name", "listed_name", max_distance))
        .where("distance >= 0")
    )


def sanctions_fuzzy(
    dim_customer: DataFrame, watchlist: DataFrame, max_distance: int = 2
) -> DataFrame:
    """Current customers within ``max_distance`` edits of a listed name, with the distance.

    Names are compared once however many customers or list entries share them.
    """
    customers = _named_customers(dim_customer)
    listed = _listed_names(watchlist)
    pairs = similar_names(
        customers.select("match_name").distinct(),
        listed.select("listed_name").distinct(),
        max_distance,
    )
    found = (
        pairs.join(by_rows(listed, watchlist.count()), "listed_name")
        .groupBy("match_name", "list_source")
        .agg(F.min("distance").alias("distance"))
    )
    return (
        customers.join(by_rows(settle(found, "found")), "match_name")
        .groupBy("customer_id", "full_name", "list_source")
        .agg(F.min("distance").alias("distance"))
    )
