"""Sources, sinks, publication and the stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from routeledger.functions import text as T
from routeledger.plans import registry_text
from routeledger.sources import archives, sinks, tables
from routeledger.streaming import freshness


def read_folder(path):
    return b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_csv_is_deterministic(spark, tmp_path):
    df = spark.createDataFrame([(2, "b,c", None), (1, 'q"x', ""), (3, "改\n行", "z")], "k int, a string, b string")
    for i, n in enumerate((1, 7)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        sinks.write_csv(df.repartition(n), str(tmp_path / str(i)), ["k", "a", "b"], ["k"])
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    one = sorted((tmp_path / "0").glob("part-*"))
    body = b"".join(p.read_bytes() for p in one)
    assert body.startswith(b"k,a,b\n1,") and b"\r" not in body
    back = tables.read_csv_table(spark, str(tmp_path / "1"), ["k", "a", "b"])
    assert sorted(tuple(r) for r in back.collect()) == [
        ("1", 'q"x', ""), ("2", "b,c", ""), ("3", "改\n行", "z")]


def test_json_keeps_key_order_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a")], "z int, y int, x string")
    sinks.write_json(df, str(tmp_path / "j"), ["z", "y", "x"], ["z"])
    assert read_folder(tmp_path / "j") == b'{"z":1,"y":null,"x":"a"}\n'


def test_metric_records_become_rows(spark, tmp_path):
    triple = {"value": 3, "metric_status": "measured", "reason": None}
    (tmp_path / "m.json").write_text(json.dumps([{
        "feed_id": "f", "metrics": {"gtfs_route_id_count": triple},
        "scheduled_trip_count_by_date": {"2026-04-06": {**triple, "value": 0}}}]))
    got = tables.metric_records(tables.read_json_records(
        spark, str(tmp_path / "m.json"), tables.METRIC_RECORD_SCHEMA)).collect()
    assert {(r.metric_id, str(r.service_date), r.value) for r in got} == {
        ("gtfs_route_id_count", "None", 3), ("scheduled_trip_count_by_date", "2026-04-06", 0)}


def test_publication_is_gated(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    none = df.where("k < 0")
    assert sinks.publish(df, str(tmp_path / "ok"), none).count() == 3
    digest = sinks.table_digest(df.repartition(3).select("v", "k"))
    assert sinks.publish(df, str(tmp_path / "ok2"), none, digest).count() == 3
    with pytest.raises(sinks.PublishError, match="accepted"):
        sinks.publish(df.distinct(), str(tmp_path / "no"), none, digest)
    with pytest.raises(sinks.PublishError, match="contract"):
        sinks.publish(df, str(tmp_path / "bad"), df)
    assert not (tmp_path / "bad").exists()
    with pytest.raises(sinks.PublishError, match="forbidden"):
        sinks.publish(df.withColumnRenamed("v", "代表者の氏名"), str(tmp_path / "x"), none)


def test_fingerprints(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    r = archives.archive_fingerprints(spark, str(tmp_path)).first()
    assert r.n_bytes == 3 and r.sha256.startswith("ba7816bf")


def test_page_texts_to_operator(spark, tmp_path):
    form = ("自家用有償旅客運送者登録簿\n登 録 番 号 中山福第１号\n登録年月日及び\n"
            "令和6年4月24日～令和9年4月23日\n更新登録年月日\n名 称 特定非営利活動法人 まめ\n"
            "代表者の氏名 某 某\n住 所 萩市古町２丁目\n福 祉 有 償 運 送\n運送の種別\n○\n名 称 位 置\n"
            "路線又は\n萩市全域（離島を除く）\n運送の区域\n旅客の範囲")
    (tmp_path / "d1_p1.txt").write_text(form, encoding="utf-8")
    (tmp_path / "d1_p2.txt").write_text("続き\n阿武町① 起点 阿武町～終点\n路線又は\n運送の区域", encoding="utf-8")
    (tmp_path / "d1_p10.txt").write_text("付録: 提出状況", encoding="utf-8")
    pages = tables.read_page_texts(spark, str(tmp_path))
    states = registry_text.page_states(registry_text.page_fields(pages, "提出状況")).cache()
    assert registry_text.page_problems(states).count() == 0
    roster = spark.createDataFrame([("阿武町",), ("萩市",)], "municipality string")
    kinds = spark.createDataFrame([("d1", "NPO等")], "doc_id string, operator_type string")
    r = registry_text.registry_from_text(states, roster, kinds).first()
    assert (r.registration_no, r.authority_code, r.transport_type, r.org_name, r.page_count) == (
        "中山福第1号", "中山", "福祉有償運送", "特定非営利活動法人 まめ", 2)
    assert (r.valid_from, r.valid_to, r.registered_date) == ("2024-04-24", "2027-04-23", "")
    assert r.service_area_municipalities == "萩市;阿武町" and r.problem is None
    assert r.org_address == "萩市古町2丁目"
    texts = registry_text.redacted_pages(pages).where("page_no = 1").first()
    assert "某" not in texts.text and texts.problem is None


OBS = "source_id string, checked_at timestamp, status string"


def write_batch(spark, folder, name, data):
    rows = [(s, datetime(2024, 1, d, 12), st) for s, d, st in data]
    spark.createDataFrame(rows, OBS).coalesce(1).write.mode("append").parquet(str(folder / name))


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    first = [("a", 1, "unchanged"), ("a", 1, "unchanged"), ("b", 3, "changed"), ("a", 9, "changed")]
    second = [("b", 17, "unavailable"), ("c", 18, "changed")]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = spark.readStream.schema(OBS).parquet(str(source / "*"))
        freshness.run_available(spark, stream, out, state)
        return {(str(r.week_start), r.status, r.n) for r in freshness.current(spark, out).collect()}

    def batch(rows):
        table = spark.createDataFrame([(s, datetime(2024, 1, d, 12), st) for s, d, st in rows], OBS)
        return {(str(r.week_start), r.status, r.n) for r in freshness.weekly_counts(table).collect()}

    write_batch(spark, source, "1", first)
    assert run() == batch(first)
    write_batch(spark, source, "2", second)
    everything = run()
    assert everything == batch(first + second)
    write_batch(spark, source, "3", [("late", 2, "changed"), ("d", 30, "changed")])
    after = run()
    assert everything < after and after - everything == {("2024-01-29", "changed", 1)}


def test_clean_area_keeps_lines(spark):
    df = spark.createDataFrame([("路線又は\n a \n\nb 運送の区域",)], "t string")
    assert df.select(T.clean_area_lines(F.col("t"))).first()[0] == "a\nb"


def test_line_wise_inputs_give_the_same_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x, ""y"""\n2,\n', encoding="utf-8")
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n{"k": 2}\n', encoding="utf-8")
    (tmp_path / "b.json").write_text('[{"k": 1},\n {"k": 2}]\n', encoding="utf-8")
    read = lambda m: sorted(map(tuple, tables.read_csv_table(
        spark, str(tmp_path / "a.csv"), ["k", "v"], m).collect()))
    assert read(True) == read(False) == [("1", 'x, "y"'), ("2", "")]
    one = tables.read_json_records(spark, str(tmp_path / "a.jsonl"), "k int", lines=True)
    two = tables.read_json_records(spark, str(tmp_path / "b.json"), "k int")
    assert sorted(r.k for r in one.collect()) == sorted(r.k for r in two.collect()) == [1, 2]


def test_quoted_csv_is_read_in_splits(spark, tmp_path):
    """Cells with line ends, quotes, commas and blanks, a byte order mark, CRLF ends: as the whole-file reader has them."""
    import csv
    import random

    rng = random.Random(6)
    columns = ["id", "a", "b"]
    pieces = ["x", "long text " * 9, "\n", "\r\n", '"', '""', ",", "", " ", "é漢", "\n\n"]
    for name, end, mark in (("one.csv", "\n", ""), ("two.csv", "\r\n", "\ufeff")):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            f.write(mark)
            w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
            w.writerow(columns)
            for i in range(3000):
                w.writerow([f"{name}{i}", *["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in "ab"]])
            w.writerow([f"{name}-long", "line\n" * 20_000, ""])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        path = str(tmp_path / "*.csv")
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = sorted(tuple(r) for r in tables.read_quoted_csv(spark, path, columns).collect())
        with pytest.raises(Exception, match="header"):
            tables.read_quoted_csv(spark, path, ["id", "b", "a"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    want = []
    for name in ("one.csv", "two.csv"):
        with open(tmp_path / name, newline="", encoding="utf-8-sig") as f:
            want += [tuple(r) for r in list(csv.reader(f))[1:]]
    assert got == sorted(want)


@pytest.mark.parametrize("step", ["_stage", "_verify", "_point", "_commit"])
@pytest.mark.parametrize("after", [False, True])
def test_publication_that_stops_anywhere_leaves_the_old_version(spark, tmp_path, monkeypatch, step, after):
    path, none = str(tmp_path / "t"), spark.range(0)
    sinks.publish(spark.range(3), path, none)
    old = sinks.current_version(spark, path)
    real = getattr(sinks, step)

    def stop(*args):
        if after:
            real(*args)
        raise KeyboardInterrupt if step == "_point" else RuntimeError("stopped")

    monkeypatch.setattr(sinks, step, stop)
    with pytest.raises((RuntimeError, KeyboardInterrupt)):
        sinks.publish(spark.range(5), path, none)
    monkeypatch.undo()
    done = step == "_commit" and after
    assert sinks.published(spark, path).count() == (5 if done else 3)
    assert (sinks.current_version(spark, path) == old) != done
    assert sinks.publish(spark.range(7), path, none).count() == 7
