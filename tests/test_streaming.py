import json

import pytest

from martloom.ingest import payloads
from martloom.ingest.shop import orders_from_rest
from martloom.session import DISK_STATE
from martloom.sources import io
from martloom.sources.schemas import struct
from martloom.streaming import landing
from tests.conftest import T, rows

RUN = T("2024-07-01T00:00:00")


def forget_last_commit(checkpoint):
    """The batch is written but lost from the stream's log, as after a driver that died in between: it runs again."""
    commits = sorted((checkpoint / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)


def test_every_file_is_taken_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    doc = lambda i: json.dumps({"id": i, "created_at": "2024-06-30T00:00:00Z", "email": "a@x", "total_price": "1", "line_items": [{"id": f"{i}0", "quantity": 1, "price": "1"}]})
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        source = landing.landed(spark, str(inbox), payloads.ORDER)
        landing.append_stream(source, lambda df: orders_from_rest(df, RUN), out, checkpoint).awaitTermination()
        return rows(spark.read.parquet(out), "order_id")

    (inbox / "1.json").write_text(doc(1))
    assert run() == [("1",)]
    assert run() == [("1",)]
    (inbox / "2.json").write_text(doc(2))
    assert run() == [("1",), ("2",)]


STATE = struct("k S!, at T!, v I")


def sighting(k, at, v):
    return json.dumps({"k": k, "at": at, "v": v}) + "\n"


@pytest.fixture(params=["heap", "disk"])
def state_store(spark, request):
    if request.param == "disk":
        for k, v in DISK_STATE.items():
            spark.conf.set(k, v)
    yield request.param
    for k in DISK_STATE:
        spark.conf.unset(k)


def test_state_keeps_the_newest_row_and_survives_a_retry(spark, tmp_path, state_store):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "checkpoint")
    inbox.mkdir()

    def run():
        source = landing.landed(spark, str(inbox), STATE, files_per_batch=1)
        landing.latest_state_stream(source, lambda df: df, ["k"], "at", STATE, root, checkpoint).awaitTermination()
        return rows(landing.read_state(spark, root, STATE, ["k"]), "k", "v")

    assert rows(landing.read_state(spark, root, STATE, ["k"])) == []
    (inbox / "1.json").write_text(sighting("a", "2024-01-02T00:00:00", 1) + sighting("b", "2024-01-01T00:00:00", 2))
    (inbox / "2.json").write_text(sighting("a", "2024-01-01T00:00:00", 0) + sighting("c", "2024-01-01T00:00:00", 3))
    assert run() == [("a", 1), ("b", 2), ("c", 3)]
    forget_last_commit(tmp_path / "checkpoint")
    assert run() == [("a", 1), ("b", 2), ("c", 3)]
    # the state is found again by a new query over the same checkpoint, and goes on from there
    (inbox / "3.json").write_text(sighting("b", "2024-02-01T00:00:00", 9) + sighting("a", "2024-01-02T00:00:00", 7))
    assert run() == [("a", 7), ("b", 9), ("c", 3)]
    # equal stamps: the greater value, as latest_wins has it
    (inbox / "4.json").write_text(sighting("a", "2024-01-02T00:00:00", 6))
    assert run() == [("a", 7), ("b", 9), ("c", 3)]


def test_a_batch_writes_the_keys_it_touched(spark, tmp_path):
    inbox, root, checkpoint = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "checkpoint")
    inbox.mkdir()

    def run():
        source = landing.landed(spark, str(inbox), STATE)
        landing.latest_state_stream(source, lambda df: df, ["k"], "at", STATE, root, checkpoint).awaitTermination()

    (inbox / "1.json").write_text("".join(sighting(f"k{i}", "2024-01-01T00:00:00", i) for i in range(2_000)))
    run()
    (inbox / "2.json").write_text("".join(sighting(f"k{i}", "2024-01-02T00:00:00", -i) for i in range(20) for _ in range(5)))
    run()
    sizes = [io.read_version(spark, f"{root}/changes", STATE, v).count() for v in io.versions(spark, f"{root}/changes")]
    assert [n for n in sizes if n] == [2_000, 20]
    state = landing.read_state(spark, root, STATE, ["k"])
    assert state.count() == 2_000 and state.filter("v < 0").count() == 19

    # a compaction changes nothing, later batches count on top of it, and what it replaced goes with the next one
    before = rows(state)
    assert landing.compact_state(spark, root, STATE, ["k"]) == landing.compact_state(spark, root, STATE, ["k"])
    assert rows(landing.read_state(spark, root, STATE, ["k"])) == before
    (inbox / "3.json").write_text(sighting("k7", "2024-01-03T00:00:00", 7_000))
    run()
    assert ("k7", 7_000) in rows(landing.read_state(spark, root, STATE, ["k"]), "k", "v")
    last = landing.compact_state(spark, root, STATE, ["k"])
    assert io.versions(spark, f"{root}/base")[-1] == last and min(io.versions(spark, f"{root}/changes")) > io.versions(spark, f"{root}/base")[0]
    after = rows(landing.read_state(spark, root, STATE, ["k"]), "k", "v")
    assert len(after) == 2_000 and ("k7", 7_000) in after


def test_good_and_bad_documents_land_once(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    doc = lambda i: json.dumps({"id": str(i), "created_at": "2024-06-30T00:00:00Z", "email": "a@x", "total_price": "1", "line_items": [{"id": f"{i}0", "quantity": 1, "price": "1"}, {"id": f"{i}1", "quantity": 1, "price": "1"}]})
    shape = orders_from_rest(spark.createDataFrame([], payloads.ORDER), RUN).schema

    def run():
        texts = landing.landed_texts(spark, str(inbox), files_per_batch=1)
        landing.two_sided_stream(texts, payloads.ORDER, lambda df: orders_from_rest(df, RUN), out, checkpoint).awaitTermination()
        good, bad = (rows(landing.read_side(spark, out, s, t), *c) for s, t, c in (("rows", shape, ["line_item_id"]), ("rejected", landing.TEXTS, ["body"])))
        log = landing.read_side(spark, out, "log", landing.LOG)
        assert log.filter("landed <> accepted + rejected").isEmpty() and log.select("_version").distinct().count() == log.count()
        return good, bad, log.agg({"landed": "sum"}).first()[0]

    (inbox / "1.json").write_text(doc(1) + "\n\n" + doc(2)[:-3] + "\n")
    (inbox / "2.json").write_text('{"id": 3, "line_items": "none"}\n' + doc(4))
    first = run()
    assert first == ([("10",), ("11",), ("40",), ("41",)], [(doc(2)[:-3],), ('{"id": 3, "line_items": "none"}',)], 4)
    forget_last_commit(tmp_path / "checkpoint")
    assert run() == first
    # a batch that stopped before its line in the log does not count until it has run again
    last = io.versions(spark, f"{out}/log")[-1]
    io.remove(spark, io.version_path(f"{out}/log", last))
    assert landing.read_side(spark, out, "rows", shape).count() == 2
    forget_last_commit(tmp_path / "checkpoint")
    assert run() == first
    (inbox / "3.json").write_text(doc(5))
    good, bad, landed = run()
    assert len(good) == 6 and len(bad) == 2 and landed == 5


def test_copies_are_appended_once(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()

    def run(within="2 days"):
        source = landing.landed(spark, str(inbox), STATE)
        stream = landing.append_once_stream(source, lambda df: df, ["k", "at"], within, out, checkpoint)
        stream.awaitTermination()
        kept = max((p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"]), default=0)
        return rows(spark.read.schema(STATE).parquet(out), "k", "v"), kept

    old = "1999-01-01T00:00:00"  # the stamp of a row is no clock: none is too old
    (inbox / "1.json").write_text(sighting("a", old, 1) + sighting("b", old, 2) + sighting("b", old, 2))
    assert run()[0] == [("a", 1), ("b", 2)]
    (inbox / "2.json").write_text(sighting("b", old, 2) + sighting("c", "1990-01-01T00:00:00", 3) + sighting("b", "2024-01-01T00:00:00", 4))
    assert run()[0] == [("a", 1), ("b", 2), ("b", 4), ("c", 3)]
    forget_last_commit(tmp_path / "checkpoint")
    got, kept = run()
    assert got == [("a", 1), ("b", 2), ("b", 4), ("c", 3)] and kept <= 4


def test_what_was_seen_is_forgotten_in_time(spark, tmp_path):
    """Past `within` the state lets go of a key: it does not grow with all time, and a copy so late is appended again."""
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    kept = []
    for i in range(4):
        (inbox / f"{i}.json").write_text("".join(sighting(f"k{i}-{j}", "2024-01-01T00:00:00", j) for j in range(50)) + sighting("every", "2024-01-01T00:00:00", 0))
        source = landing.landed(spark, str(inbox), STATE)
        stream = landing.append_once_stream(source, lambda df: df, ["k"], "0 seconds", out, checkpoint)
        stream.awaitTermination()
        kept += [p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"]]
    landed = spark.read.schema(STATE).parquet(out)
    assert max(kept) <= 2 * 51 and landed.filter("k <> 'every'").count() == 200
    assert 1 < landed.filter("k = 'every'").count() <= 4


def test_landed_documents_take_less_than_a_quarter_of_their_text(spark, tmp_path, monkeypatch):
    """The documents that stream_append lands are compressed: they, not the rows, fill the disk."""
    from checks import ingest_queries
    from checks.queries import QUERIES
    from martloom.sources.given import Given

    small = "/root/testdata/sf0.001"
    monkeypatch.setattr(ingest_queries.io, "shared_dir", lambda _, name: f"{tmp_path}/{name}")
    appended = QUERIES["stream_append"](spark, small)
    text = ingest_queries.order_payloads(Given(spark, small)).selectExpr("sum(octet_length(body))").first()[0]
    landed = sum(f.stat().st_size for f in tmp_path.glob("stream/landed/part-*"))
    assert 0 < landed < text / 4
    assert appended.count() == QUERIES["ingest_orders_rest"](spark, small).count()
