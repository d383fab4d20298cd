"""Sinks, publication, change logs and the router on real folders."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from panelgrain.plans import publish as PUB
from panelgrain.sources import sinks as S
from panelgrain.streaming import router as ST
from tests.conftest import ordered, rows


def files(path):
    return {os.path.join(r, f): os.path.getmtime(os.path.join(r, f)) for r, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, tmp_path, data="abc"):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, c, f"v{i}{c}") for c in data for i in range(4)], "k int, part string, v string")
    S.write_partitions(df, path, ["part"])
    return path


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = table(spark, tmp_path)
    before = files(path)
    new = spark.createDataFrame([(1, "b", "changed"), (9, "b", "added")], "k int, part string, v string")
    S.upsert(spark, new, path, ["k", "part"], ["part"])
    got = {(r.k, r.part): r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 13 and got[(1, "b")] == "changed" and got[(9, "b")] == "added" and got[(1, "a")] == "v1a"
    after = files(path)
    assert all(after.get(f) == t for f, t in before.items() if "part=b" not in f)
    S.upsert(spark, new, path, ["k", "part"], ["part"])
    assert spark.read.parquet(path).count() == 13


def files_by_key(spark, tmp_path, part="a b%"):
    """Two partitions of four files, each with five keys of its own."""
    path = str(tmp_path / "by key+1")
    df = spark.range(20).selectExpr("CAST(id AS INT) AS k", "CASE WHEN id = 3 THEN NULL ELSE 'v' || id END AS v")
    for p in (part, "c"):
        one = df.withColumn("part", F.lit(p)).repartitionById(4, F.floor(F.col("k") / 5).cast("int"))
        one.write.mode("append").partitionBy("part").parquet(path)
    return path


def test_upsert_rewrites_only_files_that_hold_a_match(spark, tmp_path):
    path = files_by_key(spark, tmp_path)
    before = files(path)
    assert len(before) == 8
    source = spark.createDataFrame([(6, "new", "a b%"), (8, None, "a b%"), (50, "added", "a b%"), (None, "no key", "c"), (1, "x", "n")], "k int, v string, part string")
    report = S.upsert(spark, source, path, ["k", "part"], ["part"])
    assert rows(report, "part", "rows", "matched") == [("a b%", 5, 2)]
    after = files(path)
    kept = {f for f, t in before.items() if after.get(f) == t}
    assert len(kept) == 7 and not os.path.exists(f"{path}/_upsert")
    got = {(r.k, r.part): r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 43 and got[(6, "a b%")] == "new" and got[(6, "c")] == "v6" and got[(8, "a b%")] is None
    assert got[(50, "a b%")] == "added" and got[(None, "c")] == "no key" and got[(1, "n")] == "x"


def test_upsert_without_match_or_rows_keeps_every_file(spark, tmp_path):
    path = files_by_key(spark, tmp_path)
    before = files(path)
    schema = "k int, v string, part string"
    assert S.upsert(spark, spark.createDataFrame([], schema), path, ["k", "part"], ["part"]).count() == 0
    assert files(path) == before
    assert S.upsert(spark, spark.createDataFrame([(7, "x", "z")], schema), path, ["k", "part"], ["part"]).count() == 0
    assert before.items() <= files(path).items() and spark.read.parquet(path).count() == 41


def test_upsert_of_a_table_without_partitions(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    S.upsert(spark, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "B"), (3, "c")]


def test_staged_copies_are_removed(spark, tmp_path):
    from panelgrain.session import shared_folder

    path, shared = table(spark, tmp_path), f"{shared_folder(spark)}/panelgrain"
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()  # a failed run of another session may have left some
    S.replace_run(spark, spark.createDataFrame([(7, "a", "x")], "k int, part string, v string"), path, ["part"], ["part"])
    assert not [f for f in set(os.listdir(shared)) - before if f.startswith("stage-")]


def test_upsert_keys_must_name_the_partition(spark, tmp_path):
    with pytest.raises(ValueError):
        S.upsert(spark, spark.range(1), "x", ["k"], ["part"])


def test_delete_empties_and_trims_partitions(spark, tmp_path):
    path = table(spark, tmp_path)
    listed = spark.createDataFrame([(i, "a") for i in range(4)] + [(0, "b")], "k int, part string")
    S.delete_rows(spark, path, listed, ["k", "part"], ["part"])
    assert rows(spark.read.parquet(path).groupBy("part").count()) == [("b", 3), ("c", 4)]
    assert not os.path.exists(f"{path}/part=a")


def test_replace_run_can_be_repeated(spark, tmp_path):
    path = table(spark, tmp_path)
    new = spark.createDataFrame([(7, "a", "x")], "k int, part string, v string")
    for _ in range(2):
        S.replace_run(spark, new, path, ["part"], ["part"])
    assert rows(spark.read.parquet(path).groupBy("part").count()) == [("a", 1), ("b", 4), ("c", 4)]


def test_sync_changes(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k int, v string").write.parquet(path)
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, "e")], "k int, v string")
    assert rows(S.sync(spark, new, path, ["k"])) == [(2, "U"), (3, "D"), (5, "I")]
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (4, None), (5, "e")]
    assert S.sync(spark, new, path, ["k"]).count() == 0


def test_sync_rewrites_only_partitions_that_differ(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "k int, v string, part string"
    before = [(k, None if k % 4 == 0 else f"v{k}", p) for k, p in enumerate(["a", "a", "b", "b", "c q%", "c q%", "d", None, None])]
    S.write_partitions(spark.createDataFrame(before, schema), path, ["part"])
    first = files(path)
    # b has a changed row, d is gone, e is new; the others are the same rows in another order.
    now = [(k, "new" if k == 2 else v, p) for k, v, p in before if p != "d"][::-1] + [(20, "x", "e")]
    assert rows(S.sync(spark, spark.createDataFrame(now, schema), path, ["k"])) == [(2, "U"), (20, "I"), (6, "D")]
    assert rows(spark.read.parquet(path), "k", "v", "part") == ordered(now)
    then = files(path)
    kept = {f for f, t in first.items() if then.get(f) == t}
    assert {f.split("part=")[1].split("/")[0] for f in first.keys() - kept} == {"b", "d"}
    assert {f.split("part=")[1].split("/")[0] for f in then.keys() - kept} == {"b", "e"}
    assert S.sync(spark, spark.createDataFrame(now, schema), path, ["k"]).count() == 0 and files(path) == then


def test_a_key_that_moves_to_another_partition(spark, tmp_path):
    path = str(tmp_path / "m")
    frame = lambda *r: spark.createDataFrame(r, "k int, v string, part string")
    S.write_partitions(frame((1, "x", "a"), (2, None, "a"), (3, "y", "b"), (4, "z", "c")), path, ["part"])
    assert rows(S.sync(spark, frame((1, "x", "b"), (2, None, "a"), (3, "y", "b"), (4, "z", "c")), path, ["k"])) == [(1, "U")]
    assert rows(spark.read.parquet(path), "k", "part") == [(1, "b"), (2, "a"), (3, "b"), (4, "c")]


def test_digests_see_where_nulls_stand(spark):
    one, two = (spark.createDataFrame([(1, a, b)], "p int, a string, b string") for a, b in ((None, "x"), ("x", None)))
    assert rows(S.differing_partitions(one, two, ["p"])) == [(1, False)]
    assert S.differing_partitions(one, one, ["p"]).count() == 0


def fact(spark, *data):
    return spark.createDataFrame(data, "source_id int, contract_id int, period_end date, product_key int, volume double")


DAY = datetime.date


def test_publication_replaces_only_delivered_partitions(spark, tmp_path):
    path = str(tmp_path / "fact_mth")
    PUB.publish_facts(spark, fact(spark, (3, 1, DAY(2020, 1, 31), 1, 1.0), (3, 1, DAY(2024, 1, 31), 1, 1.0), (3, 2, DAY(2020, 1, 31), 1, 1.0)), path)
    before = files(path)
    PUB.publish_facts(spark, fact(spark, (3, 1, DAY(2024, 1, 31), 2, 5.0)), path, spark.createDataFrame([(3, 1, "2023-01-01")], "source_id int, contract_id int, keep_from string"))
    got = rows(spark.read.parquet(path), "contract_id", "period_end", "product_key")
    assert got == [(1, DAY(2024, 1, 31), 2), (2, DAY(2020, 1, 31), 1)]
    after = files(path)
    assert all(after.get(f) == t for f, t in before.items() if "part_contract_id=2" in f)
    assert rows(PUB.purge(spark, path, 3, 2), "part_contract_id", "rows") == [(2, 1)]
    assert spark.read.parquet(path).count() == 1


def test_commit_log(spark, tmp_path):
    path = str(tmp_path / "log.json")
    with open(path, "w") as out:
        out.write('{"add":{"partitionValues":{"b":"2","a":"1"},"modificationTime":1000}}\n')
        out.write('{"add":{"partitionValues":{"a":"1","b":"2"},"modificationTime":3000}}\n')
        out.write('{"remove":{"partitionValues":{"a":"1","b":"2"},"deletionTimestamp":2000}}\n')
        out.write('{"remove":{"partitionValues":{"a":"9"},"deletionTimestamp":500}}\n{"commitInfo":{}}\n')
    log = PUB.log_of_commits(spark.read.schema(PUB.COMMIT_SCHEMA).json(path))
    got = [([(p.name, p.value) for p in r.partitions], r.ms) for r in log.select("partitions", F.unix_millis("changed_at").alias("ms")).orderBy("ms").collect()]
    assert got == [([("a", "9")], 500), ([("a", "1"), ("b", "2")], 3000)]


def test_log_sources_in_order(spark):
    published = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    at = F.lit("2024-01-01").cast("timestamp")
    assert PUB.partition_log(7, at, ["k"], published=published).count() == 1
    feed = published.withColumns({"version": F.lit(1), "changed_at": at})
    assert PUB.partition_log(7, at, ["k"], changes=feed).columns == ["run_id", "partitions", "changed_at"]
    with pytest.raises(ValueError):
        PUB.partition_log(7, at, ["absent"], published=published)
    with pytest.raises(ValueError):
        PUB.partition_log(7, at, ["k"])


CONTRACTS = [(1, 11, "abc%", 2), (2, 12, "ab_x%.zip", 3), (3, 13, "zz%", 1)]


def test_router(spark):
    contracts = spark.createDataFrame(CONTRACTS, "contract_id int, job_id int, file_pattern string, status int")
    arriving = spark.createDataFrame([("ABC1.zip", 1), ("abcx1.zip", 1 << 31), ("zz.zip", 1), ("abdx.ZIP", 1 << 40)], "name string, size long")
    got = rows(ST.route(arriving, contracts), "name", "matches", "contract_id", "size_class", "decision")
    assert got == [("ABC1.zip", 1, 1, "Small", "accepted"), ("abcx1.zip", 2, None, None, "rejected"), ("abdx.ZIP", 1, 2, "Large", "accepted"), ("zz.zip", 0, None, None, "rejected")]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    contracts = spark.createDataFrame(CONTRACTS, "contract_id int, job_id int, file_pattern string, status int")
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    first = spark.createDataFrame([("ABC1.zip", 1), ("zz.zip", 1)], "name string, size long")
    second = spark.createDataFrame([("abdx.zip", 5)], "name string, size long")
    for part in (first, second):
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("name string, size long").parquet(inbox)
        ST.route_stream(stream, contracts, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(ST.route(first.unionByName(second), contracts))


def test_upsert_refuses_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "u")
    S.write_partitions(spark.createDataFrame([(1, "a", "x")], "k int, part string, v string"), path, ["part"])
    twice = spark.createDataFrame([(1, "a", "y"), (1, "a", "z")], "k int, part string, v string")
    with pytest.raises(ValueError, match="more than once"):
        S.upsert(spark, twice, path, ["k", "part"], ["part"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "x")]


def test_special_characters_in_paths(spark, tmp_path):
    path = str(tmp_path / "a b % +")
    frame = spark.createDataFrame([(1, "p q%"), (2, "r+s"), (3, "t=u")], "k int, part string")
    S.write_partitions(frame, path, ["part"])
    assert rows(S.drop_partitions(spark, path, F.col("part") == "p q%", ["part"])) == [("p q%", 1)]
    assert rows(spark.read.parquet(path), "k") == [(2,), (3,)]
    S.sync(spark, frame.where("k = 3"), path, ["k"])
    assert S.partition_columns(spark, path) == ["part"] and rows(spark.read.parquet(path), "k", "part") == [(3, "t=u")]


def test_router_reads_escapes_and_leading_wildcards(spark):
    contracts = spark.createDataFrame([(1, 11, r"a\%b%", 2), (2, 12, "%.zip", 2), (3, 13, "%mid%", 2), (4, 14, r"x\_y", 2)], "contract_id int, job_id int, file_pattern string, status int")
    arriving = spark.createDataFrame([("a%b1", 1), ("axb1", 1), ("one.ZIP", 1), ("a mid", 1), ("x_y", 1), ("xzy", 1)], "name string, size long")
    got = rows(ST.route(arriving, contracts), "name", "matches", "contract_id")
    assert got == [("a mid", 1, 3), ("a%b1", 1, 1), ("axb1", 0, None), ("one.ZIP", 1, 2), ("x_y", 1, 4), ("xzy", 0, None)]


@pytest.mark.parametrize("broken", ["before the list", "before moving", "while moving", "while removing"])
def test_an_upsert_that_broke_off_is_finished_by_the_next(spark, tmp_path, monkeypatch, broken):
    path = files_by_key(spark, tmp_path)
    source = spark.createDataFrame([(k, "new", p) for k in (1, 6) for p in ("a b%", "c")], "k int, v string, part string")
    real_move, real_remove, calls = S._move, S._remove_folders, []
    monkeypatch.setattr(S, "scratch_path", lambda spark, label: str(tmp_path / label))  # what a failure leaves goes with the test

    def move(spark, a, b):
        calls.append(b)
        if broken == "before the list" or (broken == "before moving" and len(calls) == 2) or (broken == "while moving" and len(calls) == 3):
            raise OSError("lost")
        real_move(spark, a, b)

    def remove(spark, folders):
        folders = list(folders)
        if broken == "while removing" and folders and folders[0].endswith(".parquet"):
            real_remove(spark, folders[:1])
            raise OSError("lost")
        real_remove(spark, folders)

    monkeypatch.setattr(S, "_move", move)
    monkeypatch.setattr(S, "_remove_folders", remove)
    with pytest.raises(OSError):
        S.upsert(spark, source, path, ["k", "part"], ["part"])
    assert spark.read.parquet(path).select("k", "part").distinct().count() == 40  # no row is missing meanwhile
    monkeypatch.undo()
    S.upsert(spark, source, path, ["k", "part"], ["part"])
    got = spark.read.parquet(path)
    assert got.count() == 40 and got.where("v = 'new'").count() == 4 and not os.path.exists(f"{path}/_upsert")


def routed_arrivals(spark, base, files=(), contracts=()):
    """Let files and contract rows arrive and run the stream over what is there."""
    kinds = {"files": "name string, size long, arrived_at timestamp", "rules": "contract_id int, job_id int, file_pattern string, status int, changed_at timestamp"}
    for name, data in (("files", files), ("rules", contracts)):
        if data or not os.path.exists(f"{base}/{name}"):
            spark.createDataFrame(data, kinds[name]).write.mode("append").parquet(f"{base}/{name}")
    streams = [spark.readStream.schema(kind).parquet(f"{base}/{name}") for name, kind in kinds.items()]
    ST.route_arrivals(*streams, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    accepted = rows(ST.accepted_files(spark, f"{base}/out").drop("batch_id"), "name", "size", "contract_id")
    return accepted, rows(ST.waiting_files(spark, f"{base}/out"), "name", "size", "matches")


def day(n, hour=0):
    return datetime.datetime(2024, 1, n, hour)


def test_files_wait_for_their_contract_and_are_routed_once(spark, tmp_path):
    base = str(tmp_path)
    one, two = (1, 11, "a%", 2, day(1)), (2, 12, "b%", 3, day(1))
    assert routed_arrivals(spark, base, [("A.zip", 1, day(1)), ("b.zip", 2, day(1))], [one]) == ([("A.zip", 1, 1)], [("b.zip", 2, 0)])
    # Announced again: the accepted file and the waiting one, with other sizes; both are the same files.
    assert routed_arrivals(spark, base, [("A.zip", 5, day(2)), ("b.zip", 6, day(2)), ("c.zip", 3, day(2))]) == ([("A.zip", 1, 1)], [("b.zip", 2, 0), ("c.zip", 3, 0)])
    # The contract comes alone, without any file.
    assert routed_arrivals(spark, base, [], [two]) == ([("A.zip", 1, 1), ("b.zip", 2, 2)], [("c.zip", 3, 0)])
    # Two contracts match c; closing one lets it go. A file accepted before keeps its decision.
    assert routed_arrivals(spark, base, [], [(3, 13, "c%", 2, day(2)), (4, 14, "%.zip", 2, day(2))])[1] == [("c.zip", 3, 2)]
    assert routed_arrivals(spark, base, [], [(4, 14, "%.zip", 9, day(3))]) == ([("A.zip", 1, 1), ("b.zip", 2, 2), ("c.zip", 3, 3)], [])
    # Nothing new, then the same name long after the delay: a delivery of its own.
    assert routed_arrivals(spark, base)[1] == []
    routed_arrivals(spark, base, [("z", 1, day(28))])
    assert ("A.zip", 9, 1) in routed_arrivals(spark, base, [("A.zip", 9, day(28))])[0]


def test_arrivals_of_nothing(spark, tmp_path):
    assert routed_arrivals(spark, str(tmp_path), [(None, 1, day(1))], [(None, None, None, None, None)]) == ([], [(None, 1, 0)])


def delivered(spark, *data):
    return spark.createDataFrame(data, "contract_id int, market_key int, product_key int, period_id int, period_end date, volume double, value double")


def test_run_logs_from_one_scan(spark, tmp_path):
    base, on = str(tmp_path / "logs"), datetime.date(2024, 1, 31)
    measures = spark.createDataFrame([("m1", "volume"), ("m2", "value"), ("m3", "absent")], "measure_id string, column string")
    facts = delivered(spark, (1, 5, 7, 1, on, 1.0, None), (1, 5, 8, 1, on, 2.0, None), (2, None, 8, 1, None, None, None))
    logged = PUB.run_log_rows(facts, PUB.RUN_LOGS, measures, 3)
    plan = logged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("Expand") == 1 and plan.count("Aggregate") == 1
    for _ in range(2):
        PUB.append_logs(spark, logged, base, 3)
        get = lambda k: rows(PUB.read_log(spark, base, k))
        assert get("periods") == ordered([(3, 1, on), (3, 1, None)]) and get("partitions") == ordered([(3, 1, on), (3, 2, None)])
        assert get("markets") == ordered([(3, 5), (3, None)]) and get("products") == [(3, 7), (3, 8)]
        assert get("measures") == [(3, "m1", "N"), (3, "m2", "Y"), (3, "m3", "Y")]
    PUB.append_logs(spark, PUB.run_log_rows(facts.where("product_key = 7"), PUB.RUN_LOGS, measures.limit(0), 4), base, 4)
    assert get("products") == [(3, 7), (3, 8), (4, 7)] and len(get("measures")) == 3
    PUB.append_logs(spark, PUB.run_log_rows(facts.limit(0), PUB.RUN_LOGS, measures, 5), base, 5)
    assert len(get("products")) == 3 and [r for r in get("measures") if r[0] == 5] == [(5, "m1", "Y"), (5, "m2", "Y"), (5, "m3", "Y")]


def test_run_logs_need_keys_of_their_own(spark):
    measures = spark.createDataFrame([], "measure_id int, column string")
    with pytest.raises(ValueError, match="same key columns"):
        PUB.run_log_rows(delivered(spark), {"a": ("market_key",), "b": ("market_key",)}, measures, 1)
