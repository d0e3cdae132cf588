"""Streams over several files, out of order within the allowed delay, equal the batch forms."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import uid
from ledgerlens.operators import encoding
from ledgerlens.operators.median import past_history_median
from ledgerlens.operators.timeline import past_history_features, past_totals, second_totals
from ledgerlens.session import written
from ledgerlens.sources import events, files
from ledgerlens.streaming import history, scoring, windows
from ledgerlens.streaming.sinks import batch_writer, closing, late_rows, rocksdb, run_to_parquet


def messages(n=600):
    random.seed(5)
    rows = []
    for i in range(n):
        rows.append(
            {
                "TransactionID": i,
                "TransactionDT": 86400 + i * 20 + random.randint(0, 200),
                "TransactionAmt": round(random.random() * 100, 2) if i % 11 else None,
                "card1": 1 if random.random() < 0.4 else random.randint(2, 12),
                "addr1": 325,
            }
        )
    return rows


@pytest.fixture
def folder(tmp_path):
    """Six files in arrival order; times inside jitter by 200 seconds."""
    rows = messages()
    path = tmp_path / "topic"
    path.mkdir()
    for part in range(6):
        lines = [json.dumps(r) for r in rows[part * 100 : (part + 1) * 100]]
        (path / f"part-{part}.txt").write_text("\n".join([*lines, "{broken", "", "null"]) + "\n")
    return str(path)


def stream(spark, folder):
    return events.parse_event_json(events.read_message_files(spark, folder, files_per_trigger=1))


def test_bad_messages_are_marked(spark, folder):
    table = run_to_parquet(stream(spark, folder), "parsed")
    assert table.where("NOT _bad").count() == 600
    assert table.where("_bad").count() == 18


@pytest.mark.parametrize("block", [512, 2])
def test_past_features_equal_batch(spark, folder, block):
    good = events.good_events(stream(spark, folder))
    streamed = history.stream_past_features(good, uid(), delay="10 minutes", block=block)
    rows = spark.createDataFrame(messages(), events.TRANSACTION_SCHEMA)
    closed = max(r["TransactionDT"] for r in messages()) - 600
    batch = past_history_median(past_history_features(rows, {"uid": uid()}), uid()).withColumn("uid", uid())
    batch = batch.where(F.col("TransactionDT") <= closed)
    names = ["past_count", "past_mean", "past_std", "past_min", "past_max", "past_median"]
    expected = {(r["uid"], r["TransactionDT"]): [r[f"uid_{n}"] for n in names] for r in batch.collect()}
    last = past_totals(second_totals(rows, uid(), "TransactionDT", "TransactionAmt"))
    last = {(r["_key"], r["_t"]): r["past_last"] for r in last.collect()}
    got = {(r["uid"], r["TransactionDT"]): r for r in streamed.collect()}
    assert got.keys() == expected.keys() and len(got) == streamed.count()
    for key, values in expected.items():
        row = got[key]
        assert row["past_rows"] == values[0]
        for name, value in zip(names[1:], values[1:], strict=True):
            assert row[name] == (None if value is None else pytest.approx(value)), name
        assert row["seconds_since_previous"] == (None if last[key] is None else key[1] - last[key])


def test_past_features_read_no_other_state(spark, folder, tmp_path):
    """A batch's plan reads the source alone; the state of an entity is fetched by its key."""
    good = events.good_events(stream(spark, folder))
    with rocksdb(spark):
        plan = history.past_features(good, uid())
        query = plan.writeStream.format("memory").queryName("past").option("checkpointLocation", str(tmp_path / "c"))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        text = query._jsq.explainInternal(True)
        progress = [p for p in query.recentProgress if p["stateOperators"]]
    physical = text[text.index("== Physical Plan ==") :]
    assert "TransformWithState" in physical and physical.count("Scan") + physical.count("FileStreamSource") <= 2
    assert physical.count("Join") == 0 and len(progress) >= 6


def test_sorted_amounts():
    rng = random.Random(2)
    stored = {}
    firsts = sizes = ids = ()
    every = []
    for _ in range(60):
        amounts = history.SortedAmounts(firsts, sizes, ids, stored.__getitem__, block=3)
        for _ in range(rng.randrange(1, 12)):
            x, copies = float(rng.randrange(40)), rng.randrange(1, 4)
            amounts.add(x, copies)
            every = sorted(every + [x] * copies)
        assert amounts.median(len(every)) == (every[(len(every) - 1) // 2] + every[len(every) // 2]) / 2
        assert [amounts.at_rank(i) for i in range(len(every))] == every
        assert all(len(v) <= 6 for v, _ in amounts.held.values())
        stored |= {name: amounts.held[name] for name in amounts.changed}
        firsts, sizes, ids = amounts.firsts, amounts.sizes, amounts.ids
    fresh = history.SortedAmounts(firsts, sizes, ids, stored.__getitem__, block=3)
    fresh.median(len(every))
    assert len(fresh.held) <= 2 < len(fresh.ids)


def test_windows_equal_batch(spark, folder):
    good = events.good_events(stream(spark, folder)).withColumns(
        {"ts": F.timestamp_seconds("TransactionDT"), "status": F.lit("success")}
    )
    table = run_to_parquet(windows.request_rate(good, ["status"]), "rate").collect()
    counts = {}
    for r in messages():
        start = r["TransactionDT"] // 300 * 300
        counts[start] = counts.get(start, 0) + 1
    closed = max(r["TransactionDT"] for r in messages()) - 600
    expected = {s: n for s, n in counts.items() if s + 300 <= closed}
    assert sorted(r["requests"] for r in table) == sorted(expected.values()) and len(table) == len(expected)


def test_closing_brings_out_open_windows(spark, folder):
    good = events.good_events(stream(spark, folder)).withColumns(
        {"ts": F.timestamp_seconds("TransactionDT"), "status": F.lit("success")}
    )
    log, close = closing(good, "ts")
    table = run_to_parquet(windows.request_rate(log, ["status"], F.col("status") == "success"), "rate", close=close).collect()
    assert sum(r["requests"] for r in table) == 600
    past, close = closing(events.good_events(stream(spark, folder)), "TransactionDT")
    seconds = history.stream_past_features(past, uid(), close=close)
    assert seconds.count() == len({(r["card1"], r["TransactionDT"]) for r in messages()})


def test_a_later_run_continues(spark, tmp_path):
    """New files, another batch size: every id once, in each of the sinks."""
    rows, source = messages(), tmp_path / "source"
    source.mkdir()

    def add(part):
        (source / f"{part}.txt").write_text("\n".join(json.dumps(r) for r in rows[part * 100 : (part + 1) * 100]) + "\n")

    def run(size):
        text = events.read_message_files(spark, str(source), files_per_trigger=size)
        scored, _ = scoring.stream_score(
            text, lambda d: d.withColumn("uid_amt_deviation", F.lit(0.0)), scoring.deviation_scorer, 0.5, str(tmp_path / "scored")
        )
        parsed = events.parse_event_json(text)
        quality = scoring.stream_quality_counters(parsed, ["TransactionAmt"], str(tmp_path / "quality"))
        tiers = windows.stream_risk_tiers(
            events.good_events(parsed).withColumn("score", F.lit(0.9)), path=str(tmp_path / "tiers")
        )
        past = history.stream_past_features(events.good_events(parsed), uid(), path=str(tmp_path / "past"))
        return scored, quality, tiers, past

    for part in range(3):
        add(part)
    run(1)
    for part in range(3, 6):
        add(part)
    run(2)
    scored, quality, tiers, past = run(2)  # nothing new
    assert sorted(r["TransactionID"] for r in scored.collect()) == list(range(600))
    assert quality.where("check = 'rows'").agg(F.sum("violations")).first()[0] == 600
    assert [r["rows"] for r in tiers.collect()] == [600]
    assert past.count() == past.select("uid", "TransactionDT").distinct().count()
    with pytest.raises(ValueError, match="holds the output"):
        windows.stream_risk_tiers(spark.readStream.schema("score double").parquet(str(source)), path=str(tmp_path / "scored"), checkpoint=str(tmp_path / "new"))


def test_loose_messages_keep_their_data(spark):
    lines = [
        '{"TransactionID": 1, "TransactionDT": 5.0, "card1": "12", "card4": "visa", "device": {"os": "x"}}',
        '{"TransactionID": 2, "TransactionDT": 5.5}',
        '{"TransactionID": 3, "TransactionDT": 7, "card1": "no number", "TransactionAmt": 1}',
        "{}",
        "{broken",
    ]
    parsed = events.parse_event_json(spark.createDataFrame([(x,) for x in lines], "value string"), extra="rest").collect()
    assert [r["_bad"] for r in parsed] == [False, True, False, True, True]
    assert (parsed[0]["TransactionDT"], parsed[0]["card1"]) == (5, 12) and json.loads(parsed[0]["rest"]["device"]) == {"os": "x"}
    assert parsed[2]["card1"] is None and parsed[2]["rest"] == {"card1": "no number"} and parsed[2]["TransactionAmt"] == 1.0


def test_scoring_quarantines_and_replaces_replayed_batches(spark, folder):
    text = events.read_message_files(spark, folder, files_per_trigger=2)
    scored, bad = scoring.stream_score(text, lambda d: d.withColumn("uid_amt_deviation", F.lit(0.0)), scoring.deviation_scorer, 0.5)
    assert scored.count() == 600 and bad.count() == 18
    assert scored.agg(F.min("fraud_prediction")).first()[0] == 1


def test_replayed_batch_replaces_itself(spark, tmp_path):
    write = batch_writer(str(tmp_path / "out"))
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_quality_counters_per_batch(spark, folder):
    counters = scoring.stream_quality_counters(stream(spark, folder).select("TransactionAmt", "card4", "_bad"), ["TransactionAmt", "card4"])
    total = {(r["check"], r["column"]): r["n"] for r in counters.groupBy("check", "column").agg(F.sum("violations").alias("n")).collect()}
    assert total[("rows", "*")] == 618 and total[("schema_failures", "*")] == 18 and total[("null", "card4")] == 600
    assert counters.select("batch_id").distinct().count() == 6


def test_histogram_quantile(spark):
    row = spark.range(1).select(
        windows.histogram_quantile(0.5, [1.0, 2.0], [F.lit(2), F.lit(6)], F.lit(8)).alias("inside"),
        windows.histogram_quantile(0.99, [1.0, 2.0], [F.lit(2), F.lit(6)], F.lit(8)).alias("beyond"),
        windows.histogram_quantile(0.5, [1.0], [F.lit(0)], F.lit(0)).alias("empty"),
    ).first()
    assert tuple(row) == (1.5, 2.0, None)


def test_late_rows_are_counted(spark, tmp_path):
    path = tmp_path / "late"
    path.mkdir()
    import os

    for i, seconds in enumerate([0, 5000, 5001, 10]):  # the last file comes after the watermark passed it
        row = {"TransactionID": i, "TransactionDT": 86400 + seconds, "TransactionAmt": 1.0, "card1": 1, "addr1": 1}
        file = path / f"{i}.txt"
        file.write_text(json.dumps(row) + "\n")
        os.utime(file, (1_000_000 + i, 1_000_000 + i))
    good = events.good_events(stream(spark, str(path))).withColumns(
        {"ts": F.timestamp_seconds("TransactionDT"), "status": F.lit("success")}
    )
    report = {}
    run_to_parquet(windows.request_rate(good, ["status"]), "late-rate", report=report)
    assert report["late_rows"] == 1


def test_late_rows_have_a_table(spark, tmp_path):
    import os

    path, out = tmp_path / "late", str(tmp_path / "out")
    path.mkdir()
    for i, seconds in enumerate([0, 5000, 5001, 10, 20]):
        row = {"TransactionID": i, "TransactionDT": 86400 + seconds, "TransactionAmt": 1.0, "card1": 1, "addr1": 1}
        (path / f"{i}.txt").write_text(json.dumps(row) + "\n")
        os.utime(path / f"{i}.txt", (1_000_000 + i, 1_000_000 + i))
    good = events.good_events(stream(spark, str(path))).withColumns(
        {"ts": F.timestamp_seconds("TransactionDT"), "status": F.lit("success")}
    )
    run_to_parquet(windows.request_rate(good, ["status"]), "late-rate", out)
    assert late_rows(spark, f"{out}/_checkpoint").agg(F.sum("late_rows")).first()[0] == 2


def test_alert_windows_of_all_sizes_in_one_pass(spark, folder):
    good = events.good_events(stream(spark, folder)).withColumns(
        {
            "ts": F.timestamp_seconds("TransactionDT"),
            "status": F.when(F.col("TransactionID") % 7 == 0, "error").otherwise("success"),
            "fraud_prediction": (F.col("TransactionID") % 5 == 0).cast("int"),
        }
    )
    sizes = {"five": 300, "half": 1800}
    log, close = closing(good, "ts")
    with rocksdb(spark):
        table = run_to_parquet(windows.rolling_alert_rates(log, sizes, 300), "alerts", close=close).collect()
    got = {(r["size"], int(r["window_start"].timestamp())): (r["requests"], r["alerts"]) for r in table}
    expected = {}
    for r in messages():
        if r["TransactionID"] % 7:
            pane = r["TransactionDT"] // 300 * 300
            for name, seconds in sizes.items():
                for start in range(pane + 300 - seconds, pane + 300, 300):
                    n, a = expected.get((name, start), (0, 0))
                    expected[name, start] = (n + 1, a + (r["TransactionID"] % 5 == 0))
    assert {k: v for k, v in got.items()} == expected and len(table) == len(expected)
    for r in table:
        assert r["alert_rate"] == pytest.approx(r["alerts"] / r["requests"])
        assert r["window_end"].timestamp() - r["window_start"].timestamp() == sizes[r["size"]]


def test_topic_sink_has_a_checkpoint_and_keys(spark, folder):
    options = events.topic_options("a:9092,b:9092", "transactions", "/shared/c", acks="all", compression_type="zstd")
    assert options == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "topic": "transactions",
        "checkpointLocation": "/shared/c",
        "kafka.acks": "all",
        "kafka.compression.type": "zstd",
    }
    with pytest.raises(ValueError, match="checkpoint"):
        events.topic_options("a:9092", "transactions", "")
    good = events.good_events(stream(spark, folder))
    assert events.to_messages(good, "TransactionID").columns == ["key", "value"]
    writer = events.stream_to_topic(good, "a:9092", "transactions", "/shared/c", "TransactionID")
    assert hasattr(writer, "start")  # no broker and no connector here: the sink is built, not started


def test_bucketed_state_is_not_moved(spark):
    """A micro-batch is shuffled to the buckets of fitted statistics that are too large to broadcast."""
    rows = spark.createDataFrame(messages(), events.TRANSACTION_SCHEMA)
    stats = encoding.uid_stats_fit(rows.where("TransactionID < 300"))
    moved = encoding.uid_stats_apply(rows, written(stats, "stats"), 50.0, 10.0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lying = scoring.stream_static_enrich(rows, files.bucketed(stats, "uid"), 50.0, 10.0)
        plan = lying._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert sorted(map(str, lying.collect())) == sorted(map(str, moved.collect()))
