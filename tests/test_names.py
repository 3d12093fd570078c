"""Route names to routes."""

import random

import pytest
from pyspark.sql import functions as F

from stopclock.operators.names import (
    _grams,
    _rare_first,
    agencies,
    fuzzy_names,
    list_routes,
    name_candidates,
    resolve_routes,
    vehicles_on_route,
)
from stopclock.schemas import DEFAULT_AGENCY

CATALOG = [
    ("r-504", "504", "504 King", 0),
    ("r-501", "501", "501 Queen", 0),
    ("r-12", "12", "12 Kingston Rd", 3),
    ("r-29", "29", "29 Dufferin", 3),
    ("r-line1", "1", "Line 1 Yonge-University", 1),
]
DDL = "route_id string, route_short_name string, route_long_name string, route_type int"


@pytest.fixture(scope="module")
def routes(spark):
    return spark.createDataFrame(CATALOG, DDL)


def ask(spark, routes, *texts, **options):
    queries = spark.createDataFrame(list(enumerate(texts)), "n int, route_text string")
    rows = resolve_routes(queries, routes, **options).orderBy("n").collect()
    assert len(rows) == len(texts)
    return [r.route_id for r in rows]


def test_what_riders_say(spark, routes):
    asked = ["504", "  504  ", "King", "king", "Kingston", "1", "Dufferin", "nonexistent-route-xyz"]
    expected = ["r-504", "r-504", "r-504", "r-504", "r-12", "r-line1", "r-29", None]
    assert ask(spark, routes, *asked) == expected


def test_pieces_and_nothing(spark, routes):
    assert ask(spark, routes, "uffer", "ueen", "", "   ", None) == ["r-29", "r-501", None, None, None]


def test_whole_phrase_needs_the_loose_match(spark, routes):
    assert ask(spark, routes, "the King streetcar") == [None]
    assert ask(spark, routes, "the King streetcar", "the bus", loose=True) == ["r-504", None]


def test_ties_go_by_type_then_catalog_order(spark):
    routes = spark.createDataFrame(
        [
            ("bus", "7", "Bathurst", 3),
            ("tram", "8", "Bathurst", 0),
            ("none", "1", "Bathurst", None),
            ("b", "9", "Spadina", 0),
            ("a", "10", "Spadina", 0),
            ("x2", "A1", "one", 3),
            ("x1", "a1", "two", 0),
            ("u", None, "Harbour", 3),
        ],
        DDL,
    )
    assert ask(spark, routes, "bathurst", "spadina", "a1", "arbou") == ["tram", "a", "x2", "u"]


def test_many_copies_of_one_name_and_one_query(spark):
    """A third of the catalog shares a word, and a third of the queries asks for it."""
    routes = spark.range(3000).selectExpr(
        "concat('r', id) route_id", "cast(id as string) route_short_name",
        "if(id % 3 = 0, 'Main Street', concat('Road ', id, 'x')) route_long_name",
        "cast(id % 4 as int) route_type",
    )
    queries = spark.range(3000).selectExpr(
        "id n", "if(id % 3 = 0, 'street', concat('Road ', id)) route_text"
    )
    rows = {r.n: r.route_id for r in resolve_routes(queries, routes).collect()}
    assert len(rows) == 3000
    assert {rows[n] for n in range(0, 3000, 3)} == {"r0"}
    assert rows[1001] == "r1001"


def test_list_routes_puts_unnamed_last(spark, routes):
    more = routes.unionByName(spark.createDataFrame([("z", None, "Z", 3)], DDL))
    assert [r.route_short_name for r in list_routes(more).collect()] == ["1", "12", "29", "501", "504", None]


def test_agencies_fall_back(spark):
    ddl = "agency_id string, agency_name string, agency_timezone string"
    empty = spark.createDataFrame([], ddl)
    assert [tuple(r) for r in agencies(empty, DEFAULT_AGENCY).collect()] == [DEFAULT_AGENCY]
    one = spark.createDataFrame([("a", "A", "UTC")], ddl)
    assert [tuple(r) for r in agencies(one, DEFAULT_AGENCY).collect()] == [("a", "A", "UTC")]


def test_vehicles_on_route(spark, routes):
    positions = spark.createDataFrame(
        [
            ("2026-04-14 11:59:00", "v1", "r-504"), ("2026-04-14 11:58:00", "v1", "r-504"),
            ("2026-04-14 11:57:00", "v2", "r-504"), ("2026-04-14 11:50:00", "v3", "r-504"),
            ("2026-04-14 11:59:00", None, "r-504"), ("2026-04-14 11:56:00", "v1", "r-12"),
        ],
        "received_at string, vehicle_id string, route_id string",
    ).selectExpr(
        "cast(received_at as timestamp) received_at", "vehicle_id", "route_id", "'t' trip_id",
        "0 direction_id", "43.0D latitude", "-79.0D longitude", "cast(null as float) bearing",
        "cast(null as float) speed_mps",
    )
    queries = spark.createDataFrame([("King",), ("Queen",), ("nowhere",), ("12",)], "route_text string")
    rows = {
        r.route_text: r
        for r in vehicles_on_route(queries, routes, positions, "2026-04-14T12:00:00Z").collect()
    }
    assert rows["King"].vehicle_count == 2
    assert [v.vehicle_id for v in rows["King"].vehicles] == ["v1", "v2"]
    assert (rows["Queen"].matched, rows["Queen"].vehicle_count) == (True, 0)
    assert (rows["nowhere"].matched, rows["nowhere"].vehicle_count) == (False, None)
    assert rows["12"].vehicle_count == 1
    capped = vehicles_on_route(queries, routes, positions, "2026-04-14T12:00:00Z", limit=1)
    king = {r.route_text: r for r in capped.collect()}["King"]
    # The count is of all vehicles; only the listed ones are bounded.
    assert (king.vehicle_count, [v.vehicle_id for v in king.vehicles], king.truncated) == (2, ["v1"], True)
    everything = vehicles_on_route(queries, routes, positions, "2026-04-14T12:00:00Z", limit=None)
    king = {r.route_text: r for r in everything.collect()}["King"]
    assert ([v.vehicle_id for v in king.vehicles], king.truncated) == (["v1", "v2"], False)


def _similarity(a: str, b: str) -> float:
    import re

    def grams(text):
        return {
            f"  {w} "[i : i + 3] for w in re.findall("[a-z0-9]+", text.lower()) for i in range(len(w) + 1)
        }

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("threshold", [0.2, 0.3, 0.5, 1.0])
def test_fuzzy_names_against_all_pairs(spark, threshold):
    names = ["Kingston Rd", "King", "King St", "Queen St", "Queens Quay", "Spadina", "Spadina Ave", "St Clair"]
    asked = ["kingstn", "quen st", "spadna", "st", "king st", "clair"]
    got = fuzzy_names(
        spark.createDataFrame([(a,) for a in asked], "query string"),
        spark.createDataFrame([(n,) for n in names], "name string"),
        threshold,
    ).collect()
    expected = {
        (a, n): _similarity(a, n) for a in asked for n in names if _similarity(a, n) >= threshold
    }
    assert {(r.query, r.name): r.similarity for r in got} == pytest.approx(expected)


def test_fuzzy_names_of_few_trigrams(spark):
    names = ["a", "b", "ab", "abc", "a b", "", "...", None]
    frames = (spark.createDataFrame([(n,) for n in names], f"{c} string") for c in ("query", "name"))
    got = fuzzy_names(*frames, threshold=0.2).collect()
    real = [n for n in names if n and n != "..."]
    expected = {(a, n): _similarity(a, n) for a in real for n in real if _similarity(a, n) >= 0.2}
    assert {(r.query, r.name): r.similarity for r in got} == pytest.approx(expected)
    assert len(got) == len(expected)


def test_fuzzy_names_meet_under_rare_pairs(spark):
    """Fewer candidates than under single trigrams, and the same pairs."""
    rnd = random.Random(3)
    syllables = [a + b + c for a in "bcdfghklmnprstvw" for b in "aeiou" for c in ("", "n", "r", "l", "s")]
    endings = ["street", "road", "avenue"]
    names = {f"{rnd.choice(syllables)}{rnd.choice(syllables)} {rnd.choice(endings)}" for _ in range(400)}
    asked = {n[1:-1] for n in names}
    left = spark.createDataFrame([(a,) for a in sorted(asked)], "query string")
    right = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    met = name_candidates(left, right, 0.5)
    grams = _grams(right, "name").select(F.explode("grams").alias("gram"))
    rarity = grams.groupBy("gram").agg(F.count("*").alias("n"))

    def singles(df, column):
        rows = _rare_first(_grams(df, column), rarity, 0.5).toDF(column, "grams", "need", "head")
        return rows.select(column, F.explode(F.slice("head", F.lit(1), F.size("grams") - F.col("need") + 1)).alias("g"))

    assert met.count() < singles(left, "query").join(singles(right, "name"), "g").count()
    expected = {(a, n) for a in asked for n in names if _similarity(a, n) >= 0.5}
    assert {(r.query, r.name) for r in fuzzy_names(left, right, 0.5).collect()} == expected
