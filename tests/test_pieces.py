"""Polls too large for one row."""

import json
import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from checks.landing import _polls, land_files
from stopclock import schemas as S
from stopclock.plans import tables
from stopclock.plans.buckets import read_buckets
from stopclock.sources import feeds as source
from stopclock.sources import pieces
from stopclock.sources.pieces import Cutter
from tests import feeds
from tests.test_streaming import ingest, land


def cut(data, piece_bytes=40, block=7):
    cutter = Cutter(piece_bytes)
    for i in range(0, len(data), block):
        cutter.feed(data[i : i + block])
    assert cutter.hash.hexdigest() == sha256(data).hexdigest()
    return [p for _, _, p in cutter.pieces()]


def entities(n):
    words = ["a", 'q"}],[{', "back\\", "\\\\\"", "é東", "entity", ""]
    return [{"id": str(i), "x": {"entity": [words[i % 7], i]}, "y": [words[i * 3 % 7], [], {}]} for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 100_000])
def test_pieces_have_all_entities_in_order(block):
    said = {"header": {"timestamp": "17", "entity": [1]}, "entity": entities(60), "after": {"entity": [2]}}
    for data in (json.dumps(said), json.dumps(said, indent=1), json.dumps(said, ensure_ascii=False) + "\n"):
        got = [json.loads(p) for p in cut(data.encode(), 200, block)]
        assert len(got) > 5 and [e for p in got for e in p["entity"]] == said["entity"]
        assert all({**p, "entity": 0} == {**said, "entity": 0} for p in got)


def test_what_is_no_list_of_entities_stays_whole():
    later = '{"header":{},"entity":[%s],"entity":[]}' % ",".join(["{}"] * 99)
    for text in (later, "<html>" * 99, json.dumps([{"entity": entities(9)}]), json.dumps({"entity": {"a": entities(9)}}), ""):
        assert cut(text.encode()) == [text.encode()]


def test_a_broken_message_has_a_broken_piece():
    good = json.dumps({"header": {}, "entity": entities(40)})
    for text in (good[:-30], good.replace("}, {", "},, {"), good[:-2] + ",]}", good.replace("}, {", "} {")):
        def fails(p):
            try:
                json.loads(p)
            except ValueError:
                return True

        assert any(map(fails, cut(text.encode())))


def small_pieces(monkeypatch):
    monkeypatch.setattr(source, "WHOLE_BYTES", 2000)
    monkeypatch.setattr(pieces, "WHOLE_BYTES", 2000)
    monkeypatch.setattr(pieces, "PIECE_BYTES", 500)


def vehicles(n, **more):
    return [{"id": str(i), "vehicle": {"vehicle": {"id": f"v{i}"}, "position": {"latitude": 1.0, "longitude": 2.0}, **more}} for i in range(n)]


def test_large_polls_land_as_whole_ones_do(spark, tmp_path, monkeypatch):
    small_pieces(monkeypatch)
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    large = feeds.message(*vehicles(200))
    bad = feeds.message(*vehicles(100), {"id": "x", "vehicle": {"position": {"latitude": "north"}}}, *vehicles(100))
    for poll, body in ((1_700_000_000, large), ("1700000000-b", large), (1_700_000_060, bad), (1_700_000_120, feeds.message(feeds.vehicle_full()))):
        land(landing, poll, body)
    rows = source.scan_feed_snapshots(spark, str(landing)).select("received_at", "payload_hash", "pieces", "length", F.size("entity").alias("n")).collect()
    digest = sha256(json.dumps(large).encode()).hexdigest()
    assert sum(r.n for r in rows if r.payload_hash == digest) == 400 and max(r.pieces for r in rows) > 10
    assert sum(r.length for r in rows) == sum(f.stat().st_size for f in landing.iterdir())
    for run in ("one", "two"):
        ingest(spark, tmp_path, "vehicle_positions", run)
        stored = tables.read_events(spark, root, S.VEHICLE_POSITIONS).collect()
        assert len(stored) == 201 and {r.raw_payload_hash for r in stored} >= {digest}
        (failure,) = tables.read_events(spark, root, S.FAILURES).collect()
        assert failure.error_class == "not_a_feed"
        assert tables.read_events(spark, root, S.LANDED_POLLS).count() == 3
        signatures = tables.read_keyed(spark, root, S.SIGNATURES, part="vehicle_positions").collect()
        assert sum(s.sample_count for s in signatures) == 2
    runs = tables.read_events(spark, root, S.RUNS).collect()
    assert {r.bytes_processed for r in runs} == {sum(f.stat().st_size for f in landing.iterdir())}


def test_the_later_of_two_alerts_wins_across_pieces(spark, tmp_path, monkeypatch):
    small_pieces(monkeypatch)
    others = [{**feeds.alert(f"text {i}"), "id": f"a{i}"} for i in range(50)]
    land(tmp_path / "landing", 1_700_000_000, feeds.message(feeds.alert("first"), *others, feeds.alert("last")))
    ingest(spark, tmp_path, "service_alerts")
    stored = {r.alert_id: r.header_text for r in read_buckets(spark, str(tmp_path / "tables"), S.SERVICE_ALERTS).collect()}
    assert len(stored) == 51 and stored["alert-001"] == "last"


def test_a_poll_is_written_by_the_line(spark):
    """No task holds a message, and its file is one message with its entities in order."""
    ids = list(range(3000))
    random.Random(1).shuffle(ids)
    rows = spark.createDataFrame([(86_400 * (19_000 + i % 3), (f"{i:04}", i)) for i in ids], "poll bigint, entity struct<id:string, v:int>")
    plan = _polls(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    folder = land_files(spark, _polls(rows.repartition(7)), "landing-lines")
    files = source.scan_feed_snapshots(spark, folder, pattern="part-*").select("path", "content").collect()
    assert len({f.path.split("/")[-2] for f in files}) == 3
    for f in files:
        said = json.loads(bytes(f.content))
        poll = int(said["header"]["timestamp"])
        assert said["entity"] == [{"id": f"{i:04}", "v": i} for i in range(3000) if 86_400 * (19_000 + i % 3) == poll]
