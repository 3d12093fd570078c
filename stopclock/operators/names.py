"""Route and stop names: what a rider says to what the catalog holds.

No step pairs queries with catalog rows one by one.  For every key a query could hit (a
short name, a word, a piece of a name) the catalog is first reduced to the one route
that would win there, so each join is one row to one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopclock.functions.text import strip, trigrams, words
from stopclock.operators.events import POSITION_COLUMNS, current_positions

# Fixed value: the rank of a route without a type in a tie.
NO_TYPE = 99

# Words that name no route; only used by the loose match.
STOP_WORDS = ("a", "an", "bus", "line", "on", "route", "streetcar", "subway", "the", "train", "tram")

ROUTE_COLUMNS = ("route_id", "route_short_name", "route_long_name", "route_type")


def _by_catalog_order() -> Column:
    """Sorts like the catalog listing: short name, unnamed ones last, then id."""
    return F.struct(
        F.col("route_short_name").isNull().alias("unnamed"), *[F.col(c) for c in ROUTE_COLUMNS[1:2]],
        F.col("route_id"), F.col("route_long_name"), F.col("route_type"),
    )


def _by_type_then_catalog() -> Column:
    return F.struct(
        F.coalesce("route_type", F.lit(NO_TYPE)).alias("type_rank"),
        _by_catalog_order().alias("route"),
    )


def resolve_routes(
    queries: DataFrame, routes: DataFrame, text_col: str = "route_text", loose: bool = False
) -> DataFrame:
    """Every query row with the route it names, or NULLs, and the ``tier`` that matched:

    1. the short name, case-blind (first in catalog order);
    2. a whole word of the long name (lowest type, then catalog order);
    3. a part of the long name (likewise).

    ``loose`` adds, between 2 and 3, a match of any word of the query that is no stop word.
    An empty query matches nothing.
    """
    found = _found(queries, routes, text_col, loose)
    return (
        queries.withColumn("q", _normal(text_col))
        .join(found, "q", "left")
        .select(
            *queries.columns, "tier", *[F.col(f"hit.{c}").alias(c) for c in ROUTE_COLUMNS]
        )
    )


def _normal(text_col: str) -> Column:
    return F.lower(strip(F.col(text_col)))


def _found(queries: DataFrame, routes: DataFrame, text_col: str, loose: bool) -> DataFrame:
    """One row per distinct query text: ``q``, ``tier`` and ``hit``, the route or NULL."""
    catalog = routes.select(*ROUTE_COLUMNS)
    asked = (
        queries.select(_normal(text_col).alias("q"))
        .filter(F.col("q") != "")
        .distinct()
    )
    # One table of keys: the route that each short name means, and the one of each word.
    name = F.lower("route_long_name")
    of_word = F.coalesce(words(name), F.array().cast("array<string>"))
    keys = F.concat(
        F.array(F.struct(F.lower("route_short_name").alias("q"), F.lit(True).alias("short"))),
        F.transform(of_word, lambda w: F.struct(w.alias("q"), F.lit(False).alias("short"))),
    )
    by_key = (
        catalog.select("*", F.inline(keys))
        .filter(F.col("q").isNotNull())
        .groupBy("q")
        .agg(
            F.min(F.when(F.col("short"), _by_catalog_order())).alias("hit_1"),
            F.min(F.when(~F.col("short"), _by_type_then_catalog())).alias("word"),
        )
    )
    names = (
        catalog.filter(F.col("route_long_name").isNotNull())
        .groupBy(name.alias("name"))
        .agg(F.min(_by_type_then_catalog()).alias("best"))
    )
    named = asked.join(by_key, "q", "left").select("q", "hit_1", F.col("word.route").alias("hit_2"))
    open_ = named.filter(F.col("hit_1").isNull() & F.col("hit_2").isNull()).select("q")
    if loose:
        tokens = open_.select("q", F.explode(words(F.col("q"))).alias("token")).filter(
            ~F.col("token").isin(*STOP_WORDS)
        )
        of_words = by_key.filter(F.col("word").isNotNull()).select(F.col("q").alias("token"), "word")
        by_token = (
            tokens.join(of_words, "token")
            .groupBy("q")
            .agg(F.min("word")["route"].alias("hit_2b"))
        )
        named = named.join(by_token, "q", "left")
        open_ = open_.join(by_token.select("q"), "q", "left_anti")
    named = named.join(_by_piece(open_, names), "q", "left")

    tiers = [("hit_1", "1"), ("hit_2", "2")]
    tiers += [("hit_2b", "2b")] if loose else []
    tiers += [("hit_3", "3")]
    tier = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(t)) for c, t in tiers])
    return named.select(
        "q", tier.alias("tier"), F.coalesce(*[F.col(c) for c, _ in tiers]).alias("hit")
    )


def _by_piece(open_: DataFrame, names: DataFrame) -> DataFrame:
    """Best route per query text that is a part of a name.

    Names are cut into all their pieces of the lengths that still open queries have, and
    the pieces meet the queries in an equi join.  The lengths are whole numbers no larger
    than the longest name, so their list is short whatever the number of queries.
    """
    longest = names.agg(F.max(F.length("name"))).scalar()
    lengths = (
        open_.select(F.length("q").alias("n"))
        .filter(F.col("n") <= longest)
        .agg(F.collect_set("n"))
        .scalar()
    )

    def pieces(n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.length("name") - n + 1),
            lambda i: F.substr(F.col("name"), i, n),
        )

    fitting = F.filter(F.col("lengths"), lambda n: n <= F.length("name"))
    cut = names.withColumn("lengths", lengths).select(
        F.explode(F.array_distinct(F.flatten(F.transform(fitting, pieces)))).alias("q"), "best"
    )
    return (
        cut.join(open_, "q", "left_semi")
        .groupBy("q")
        .agg(F.min("best")["route"].alias("hit_3"))
    )


def vehicles_on_route(
    queries: DataFrame,
    routes: DataFrame,
    positions: DataFrame,
    as_of: Column | datetime | str,
    text_col: str = "route_text",
    limit: int | None = 500,
    minutes: float = 5,
) -> DataFrame:
    """Per query: the route it names, how many vehicles are on it now, and which.

    An unknown route has ``matched`` false; a known one without vehicles counts 0.  The
    count is of all live vehicles; the list is a report of the first ``limit`` by id, which
    bounds what is gathered per route, and ``truncated`` tells whether it leaves some out.
    Without a limit the list has them all.
    """
    live = current_positions(positions, as_of, minutes, by=("route_id", "vehicle_id"))
    counts = live.groupBy("route_id").agg(F.count("*").alias("vehicle_count"))
    first = Window.partitionBy("route_id").orderBy("vehicle_id")
    listed = live
    if limit is not None:
        listed = live.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= limit)
    fleet = (
        listed.groupBy("route_id")
        .agg(F.sort_array(F.collect_list(F.struct(*POSITION_COLUMNS))).alias("vehicles"))
        .join(counts, "route_id")
        .withColumn("truncated", F.col("vehicle_count") > F.size("vehicles"))
    )
    # Routes meet vehicles once per distinct text; only the answers are spread over the
    # queries.
    found = _found(queries, routes, text_col, loose=False).select(
        "q", "tier", *[F.col(f"hit.{c}").alias(c) for c in ROUTE_COLUMNS]
    )
    answers = found.filter(F.col("route_id").isNotNull()).join(fleet, "route_id", "left")
    return (
        queries.withColumn("q", _normal(text_col))
        .join(answers, "q", "left")
        .withColumn("matched", F.col("route_id").isNotNull())
        .withColumn(
            "vehicle_count",
            F.when(F.col("matched"), F.coalesce("vehicle_count", F.lit(0).cast("long"))),
        )
        .select(
            *queries.columns,
            "matched",
            "tier",
            *ROUTE_COLUMNS,
            "vehicle_count",
            "vehicles",
            F.when(F.col("matched"), F.coalesce("truncated", F.lit(False))).alias("truncated"),
        )
    )


def fuzzy_names(
    queries: DataFrame,
    names: DataFrame,
    threshold: float = 0.3,
    query_col: str = "query",
    name_col: str = "name",
) -> DataFrame:
    """Pairs of distinct query and name whose trigram sets overlap by at least
    ``threshold`` (shared over union).

    Sets of ``size`` trigrams that similar share ``need = ceil(threshold * size)`` of them, so
    they share two of the ``size - need + 2`` rarest of each.  Texts meet under pairs of those,
    which are far rarer than single trigrams, however common these are; a pair of texts is
    looked at once, under the two rarest that both have.  Texts of so few trigrams that one in
    common may be enough meet each other under single ones.
    """
    met = name_candidates(queries, names, threshold, query_col, name_col)
    n_q, n_n = F.size("q_grams"), F.size("n_grams")
    shared = F.size(F.array_intersect("q_grams", "n_grams"))
    both = F.array_intersect("q_head", "n_head")
    first = F.when(_few("q_need", "n_need"), F.xxhash64(F.get(both, F.lit(0)))).otherwise(
        F.xxhash64(F.get(both, F.lit(0)), F.get(both, F.lit(1)))
    )
    return (
        met.filter((n_n >= n_q * threshold) & (n_q >= n_n * threshold))
        .filter(first == F.col("key"))
        .select("query", "name", (shared / (n_q + n_n - shared)).alias("similarity"))
        .filter(F.col("similarity") >= threshold)
    )


def name_candidates(
    queries: DataFrame,
    names: DataFrame,
    threshold: float,
    query_col: str = "query",
    name_col: str = "name",
) -> DataFrame:
    """Queries and names that meet under a key, with their trigrams; some more than once."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    q, n = _grams(queries, query_col), _grams(names, name_col)
    rarity = n.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    left = _rare_first(q, rarity, threshold).toDF("query", "q_grams", "q_need", "q_head")
    right = _rare_first(n, rarity, threshold).toDF("name", "n_grams", "n_need", "n_head")
    pairs = left.withColumn("key", F.explode(_pair_keys("q_head"))).join(
        right.withColumn("key", F.explode(_pair_keys("n_head"))), "key"
    )
    single = F.transform("q_head", lambda g: F.xxhash64(g)), F.transform("n_head", lambda g: F.xxhash64(g))
    few = left.filter("q_need < 2").withColumn("key", F.explode(single[0])).join(
        right.filter("n_need < 2").withColumn("key", F.explode(single[1])), "key"
    )
    return pairs.filter(~_few("q_need", "n_need")).unionByName(few)


def _few(*needs: str) -> Column:
    """Whether one trigram in common may be enough for both texts."""
    return F.greatest(*needs) < 2


def _pair_keys(head: str) -> Column:
    """A number for each two trigrams of a list, the earlier one first."""
    later = F.transform(
        head,
        lambda g, i: F.transform(F.slice(head, i + 2, F.size(head)), lambda h: F.xxhash64(g, h)),
    )
    return F.array_distinct(F.flatten(later))


def _grams(df: DataFrame, column: str) -> DataFrame:
    texts = df.select(F.col(column).alias("text")).filter(F.col("text").isNotNull()).distinct()
    return texts.withColumn("grams", trigrams(F.col("text"))).filter(F.size("grams") > 0)


def _rare_first(texts: DataFrame, rarity: DataFrame, threshold: float) -> DataFrame:
    """Text, its trigrams, and the rarest of them that a partner must share one of."""
    ranked = (
        texts.select("text", F.explode("grams").alias("gram"))
        .join(rarity, "gram", "left")
        .groupBy("text")
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))
            ).alias("ranked")
        )
        .select("text", F.col("ranked.gram").alias("grams"))
    )
    size = F.size("grams")
    # A hair below the product, so that rounding never shortens the list.
    need = F.ceil(size * threshold - 1e-9).cast("int")
    head = F.slice("grams", F.lit(1), F.least(size, size - need + 2))
    return ranked.select("text", "grams", need.alias("need"), head)


def list_routes(routes: DataFrame) -> DataFrame:
    """The route catalog by short name, unnamed routes last."""
    return routes.select(*ROUTE_COLUMNS).orderBy(
        F.col("route_short_name").asc_nulls_last(), "route_id"
    )


def agencies(agency: DataFrame, default: Sequence[str]) -> DataFrame:
    """Known agencies; the default one where the table is empty."""
    known = agency.select(
        "agency_id",
        F.col("agency_name").alias("name"),
        F.col("agency_timezone").alias("timezone"),
    )
    fallback = agency.sparkSession.createDataFrame(
        [tuple(default)], "agency_id string, name string, timezone string"
    )
    one = agency.limit(1).select(F.lit(1).alias("one"))
    return known.unionByName(fallback.join(one, F.lit(True), "left_anti"))
