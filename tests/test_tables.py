from __future__ import annotations

import gzip
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from peernet.operators import ledger as runs
from peernet.schemas import SCHEMAS
from peernet.sources.export import export_csv, performance_rows, should_export, undersampled_rows
from peernet.sources.loaders import freshness, load, load_country_codes, scan_feed
from peernet.sources.tables import Tables
from tests.util import at, feed, plan_of, rows


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, f"file:{tmp_path}")


def test_replace_reads_itself(spark, tables):
    first = tables.replace(spark.range(10).select("id", (F.col("id") % 3).alias("k")), "t", cluster_by="k")
    second = tables.replace(first.where("k = 1"), "t")
    assert rows(second, "id") == [(1,), (4,), (7,)]
    assert tables.replace(tables.read_replaced("t").limit(1), "t").count() == 1
    assert tables.read_replaced("missing") is None


def test_half_written_version_is_not_read(spark, tables):
    tables.replace(spark.range(3), "t")
    spark.range(9).write.parquet(tables.path("t") + "/v000002")
    Path((tables.path("t") + "/v000002/_SUCCESS").removeprefix("file:")).unlink()
    assert tables.read_replaced("t").count() == 3


def test_append(spark, tables):
    assert tables.read("t", "id bigint").count() == 0
    tables.append(spark.range(3), "t", cluster_by="id")
    tables.append(spark.range(3), "t")
    assert rows(tables.read("t"), "id") == [(0,), (0,), (1,), (1,), (2,), (2,)]


def test_folded_rows_are_upserted(spark, tables):
    """Rows of one day move folded, and replace rows by key on dates that have some; copies and null keys stay."""
    moved = []

    def unfold(folded):
        moved.append(folded.count())
        hours = F.sequence("t", "until", F.expr("interval 1 hour"))
        others = [c for c in folded.columns if c == "_date"]
        return folded.withColumn("_t", F.explode(hours)).select("k", F.col("_t").alias("t"), "v", *others)

    def put(*data):
        folded = spark.createDataFrame([(k, at(t), at(u), v) for k, t, u, v in data], "k string, t timestamp_ntz, until timestamp_ntz, v int")
        tables.upsert(folded, "t", ["k", "t"], "t", unfold=unfold)

    put(("b", "00:00", "23:00", 1), ("a", "00:00", "23:00", 1), ("a", "00:00", "23:00", 1), (None, "03:00", "03:00", 1))
    assert tables.read("t").count() == 73 and max(moved) == 4
    put(("a", "22:00", "23:00", 2), ("a", "24:00", "26:00", 2), (None, "03:00", "04:00", 2), ("c", "01:00", "01:00", 2))
    found = tables.read("t")
    expected = [("b", at(f"{h}:00"), 1) for h in range(24)] + [("a", at(f"{h}:00"), 1) for h in range(22)] * 2
    expected += [("a", at(f"{h}:00"), 2) for h in range(22, 27)]
    expected += [(None, at("03:00"), 2), (None, at("04:00"), 2), ("c", at("01:00"), 2)]
    assert rows(found, "k", "t", "v") == sorted(expected, key=repr)
    assert tables.bounds("t", "t") == (str(at("00:00")), str(at("26:00")))
    with pytest.raises(ValueError):
        tables.upsert(found, "t", ["k"], "t", unfold=unfold)


def test_upsert_moves_rows_between_dates(spark, tables):
    def batch(*data):
        return spark.createDataFrame(list(data), "k string, t timestamp_ntz, v int")

    day = 86400
    tables.upsert(batch(("a", at(0), 1), ("b", at(day), 1), ("c", at(2 * day), 1), (None, at(0), 1)), "t", ["k"], "t")
    before = set(tables.read("t").where("k = 'c'").inputFiles())
    tables.upsert(batch(("a", at(day), 2), ("d", at(day), 2), (None, at(0), 3)), "t", ["k"], "t")
    found = tables.read("t")
    assert rows(found, "k", "t", "v") == sorted(
        [("a", at(day), 2), ("b", at(day), 1), ("c", at(2 * day), 1), ("d", at(day), 2), (None, at(0), 3)], key=repr
    )
    assert set(found.where("k = 'c'").inputFiles()) & before  # the untouched day keeps its file
    tables.upsert(batch((None, at(day), 4)), "t", ["k"], "t")
    assert rows(tables.read("t").where("k is null"), "t", "v") == [(at(day), 4)]


def test_upsert_survives_an_empty_start_and_leaves_no_staging(spark, tables, tmp_path):
    empty = spark.createDataFrame([], "k string, t timestamp_ntz, v int")
    tables.upsert(empty, "t", ["k"], "t")
    assert tables.read("t").count() == 0
    tables.upsert(empty, "t", ["k"], "t")
    rows_of = lambda *data: spark.createDataFrame(list(data), empty.schema)
    tables.upsert(rows_of(("a", at(0), 1)), "t", ["k"], "t")
    tables.upsert(empty, "t", ["k"], "t")
    assert rows(tables.read("t"), "k", "v") == [("a", 1)]
    tables.upsert(rows_of(("a", at(86400), 2)), "t", ["k"], "t")
    assert rows(tables.read("t"), "k", "t", "v") == [("a", at(86400), 2)]
    assert not list(Path(f"{tmp_path}/_staging").glob("*"))
    assert len(list(Path(f"{tmp_path}/t").glob("_v=*"))) <= 2
    # A write that no manifest names is not seen.
    rows_of(("z", at(0), 9)).write.parquet(f"file:{tmp_path}/t/_v=zzz/_date=2024-01-10")
    assert rows(tables.read("t"), "k") == [("a",)]


def test_upsert_by_a_dated_key_reads_the_touched_dates(spark, tables):
    day = 86400
    batch = lambda *data: spark.createDataFrame(list(data), "k string, t timestamp_ntz, v int")
    tables.upsert(batch(*[("a", at(i * day), i) for i in range(5)]), "t", ["k", "t"], "t")
    files = {i: set(tables.read("t").where(F.col("v") == i).inputFiles()) for i in range(5)}
    tables.upsert(batch(("a", at(2 * day), 7)), "t", ["k", "t"], "t")
    after = set(tables.read("t").inputFiles())
    kept = [i for i in range(5) if {f for f in files[i] if f"_date=2024-01-{10 + i}" in f} <= after]
    assert kept == [0, 1, 3, 4]


def test_upsert_opens_only_the_dates_that_hold_a_key(spark, tables, tmp_path):
    """The files of all other dates are overwritten with rubbish: whoever opens one fails."""
    day = 86400
    batch = lambda *data: spark.createDataFrame(list(data), "k string, t timestamp_ntz, v int")
    # A batch a day, the NULL key on the first.
    for i in range(6):
        keys = [f"k{i}-{j}" for j in range(50)] + ([None] if i == 0 else [])
        tables.upsert(batch(*[(k, at(i * day), i) for k in keys]), "t", ["k"], "t", note=f"run {i}")
    files = {i: {f for f in tables.read("t").inputFiles() if f"_date=2024-01-{10 + i}" in f} for i in range(6)}
    assert all(files.values())
    for i in (1, 2, 4, 5):
        for f in files[i]:
            path = Path(f.removeprefix("file://").removeprefix("file:"))
            path.write_bytes(b"rubbish")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    wanted = batch(("k3-7", at(0), 0), (None, at(0), 0), ("new", at(0), 0))
    held = tables.read_holding("t", wanted, ["k"])
    assert {f.split("_date=")[1].split("/")[0] for f in held.inputFiles()} == {"2024-01-10", "2024-01-13"}
    tables.upsert(batch(("k3-7", at(day * 7), 70), (None, at(day * 7), 71), ("new", at(day * 7), 72)), "t", ["k"], "t")
    left = [f"_date=2024-01-{10 + i}" for i in (0, 3, 7)]
    found = spark.read.parquet(*[f for f in tables.read("t").inputFiles() if any(d in f for d in left)])
    assert rows(found.where("v >= 70"), "k", "v") == sorted([("k3-7", 70), (None, 71), ("new", 72)], key=repr)
    assert found.count() == 50 + 49 + 3
    kept = set(tables.read("t").inputFiles())
    assert all(files[i] <= kept for i in (1, 2, 4, 5)) and not (files[0] | files[3]) & kept
    assert rows(tables.read_newest("t"), "v") == [(70,), (71,), (72,)]
    assert tables.note("t") == "run 5" and tables.note("none") is None
    assert tables.read_newest("none") is None and tables.read_holding("none", wanted, ["k"]) is None


def test_upsert_reads_dates_without_prints(spark, tables, tmp_path):
    """A manifest that names no prints, as older ones, is read in full, once."""
    import json

    batch = lambda *data: spark.createDataFrame(list(data), "k bigint, t timestamp_ntz, v int")
    tables.upsert(batch((1, at(0), 1), (2, at(86400), 1)), "t", ["k"], "t")
    (path,) = Path(f"{tmp_path}/t/_manifest").glob("*.json")
    manifest = json.loads(path.read_text())
    assert manifest.pop("prints")
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    path.write_text(json.dumps(manifest))
    narrow = spark.createDataFrame([(2, at(0), 5)], "k int, t timestamp_ntz, v int")
    tables.upsert(narrow.withColumn("k", F.col("k").cast("bigint")), "t", ["k"], "t")
    assert rows(tables.read("t"), "k", "t", "v") == [(1, at(0), 1), (2, at(0), 5)]
    assert tables.read_holding("t", narrow, ["k"]).count() == 2  # key types are made equal before prints are
    assert tables.read_holding("t", narrow.where("false"), ["k"]).count() == 0


def test_bounds_come_from_the_manifest(spark, tables, tmp_path):
    import json

    schema = "k string, t timestamp_ntz, u timestamp, v int"
    batch = lambda *data: spark.createDataFrame(list(data), schema)
    day = 86400
    assert tables.bounds("t", "t") == (None, None)
    tables.upsert(batch(("a", at(0.25), None, 1), ("b", at(day), None, 1), ("n", None, None, 1)), "t", ["k"], "t")
    assert tables.bounds("t", "u") == (None, None)
    tables.upsert(batch(("b", at(2 * day + 0.5), at(7), 2), ("c", at(2 * day + 0.25), at(8), 2)), "t", ["k"], "t")
    expected = {"t": ("2024-01-10 00:00:00.25", "2024-01-12 00:00:00.5"), "u": ("2024-01-10 00:00:07", "2024-01-10 00:00:08")}
    assert {c: tables.bounds("t", c) for c in expected} == expected
    plain = tables.read("t").agg(F.min("t").cast("string"), F.max("t").cast("string")).first()
    assert tuple(plain) == expected["t"]
    newest = sorted(Path(f"{tmp_path}/t/_manifest").glob("*.json"))[-1]
    manifest = json.loads(newest.read_text())
    del manifest["bounds"]
    newest.with_name(f".{newest.name}.crc").unlink(missing_ok=True)
    newest.write_text(json.dumps(manifest))
    assert {c: tables.bounds("t", c) for c in expected} == expected  # an older manifest: the rows are read
    for f in tables.read("t").inputFiles():
        Path(f.removeprefix("file://").removeprefix("file:")).write_bytes(b"rubbish")
    tables.upsert(batch(("z", at(9 * day), at(9), 3)), "new", ["k"], "t")
    for f in tables.read("new").inputFiles():
        Path(f.removeprefix("file://").removeprefix("file:")).write_bytes(b"rubbish")
    assert tables.bounds("new", "t")[1] == "2024-01-19 00:00:00"


def test_key_prints_are_compact(spark, tables, tmp_path):
    data = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit("2024-01-10").cast("timestamp_ntz").alias("t")
    )
    tables.upsert(data, "t", ["k"], "t")
    size = lambda kind: sum(f.stat().st_size for f in Path(f"{tmp_path}/t").glob(f"{kind}=*/*/*.parquet"))
    assert 0 < size("_k") < 8 * 200_000 < size("_v") / 5


def test_clustered_files_have_narrow_ranges(spark, tables):
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("k"))
    tables.replace(df, "t", cluster_by="k")
    spans = tables.read_replaced("t").groupBy(F.input_file_name()).agg((F.max("k") - F.min("k")).alias("w")).collect()
    assert sum(r.w for r in spans) <= 4000


def test_load_and_pushdown(spark, tmp_path):
    data = feed(spark, [(1, "n", "p", "peer_set_add", []), (90000, "n", "p", "new_hash", ["0x00"])])
    data.write.partitionBy("msg_type").parquet(f"{tmp_path}/network_feed")
    scan = scan_feed(load(spark, str(tmp_path), "network_feed"), ("new_hash",), "2024-01-10 12:00:00")
    plan = plan_of(scan.select("node_id"))
    assert "PartitionFilters: [isnotnull(msg_type" in plan or "PartitionFilters: [(msg_type" in plan
    assert "GreaterThan(msg_timestamp" in plan and "msg_data" not in plan
    assert rows(scan, "msg_data") == [(["0x00"],)]


def test_country_codes(spark, tmp_path):
    text = 'country_code,country_name,region\nNA,Namibia,Africa\nAQ,Antarctica,\nBQ,"Bonaire, Saba",Americas\n'
    (tmp_path / "c.csv").write_text(text + "CI,Côte d'Ivoire,Africa\n", encoding="utf-8")
    assert rows(load_country_codes(spark, f"{tmp_path}/c.csv")) == [
        ("AQ", "Antarctica", None), ("BQ", "Bonaire, Saba", "Americas"),
        ("CI", "Côte d'Ivoire", "Africa"), ("NA", "Namibia", "Africa"),
    ]


@pytest.mark.parametrize(
    ("newest", "status"), [("2024-01-30 23:00:00", "pass"), ("2024-01-30 22:59:59", "error"), (None, "error")]
)
def test_freshness(spark, cfg, newest, status):
    table = spark.createDataFrame([(newest,)], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert freshness(table, "x", "t", cfg).first()["status"] == status


def test_export_text(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "x,y"), (3, 'q"q', "z")], "id int, a string, b string")
    target = export_csv(df.orderBy("id"), f"{tmp_path}/out/t.csv.gz", one_file=True)
    assert gzip.decompress(Path(target).read_bytes()).decode() == (
        'id,a,b\n1,,a\n2,"","x,y"\n3,"q\\"q",z\n'
    )
    export_csv(df.where("id = 1"), target, one_file=True)
    assert gzip.decompress(Path(target).read_bytes()).decode() == "id,a,b\n1,,a\n"
    parts = export_csv(df.repartition(3), f"{tmp_path}/out/parts")
    parts = export_csv(df.repartition(2), parts)
    assert len(list(Path(parts).glob("part-*.csv.gz"))) == 2
    assert spark.read.csv(parts, header=True).count() == 3
    assert sorted(p.name for p in Path(f"{tmp_path}/out").iterdir() if not p.name.startswith(".")) == ["parts", "t.csv.gz"]


def test_export_guards(cfg):
    assert should_export(cfg, "export")
    assert not should_export(replace(cfg, environment="dev"), "export")
    assert not should_export(replace(cfg, full_refresh=True), "export")
    assert should_export(replace(cfg, full_refresh=True), "export_FULL_REFRESH")


def test_export_projections(spark, cfg):
    table = spark.sql(
        "select 'r' peer_region, 'e' enode, 1 hash_ct, cast(t as timestamp_ntz) updated_at "
        "from values ('2024-01-31 00:00:00'), ('2024-01-30 00:00:00') v(t)"
    )
    assert rows(undersampled_rows(table, cfg)) == [("r", "e", 1)]
    from peernet.sources.export import PERFORMANCE_COLUMNS

    wide = spark.sql(
        "select " + ", ".join(f"'v' {c}" for c in PERFORMANCE_COLUMNS[:-1]) + ", 'x' peer_subdivision, "
        "cast(t as timestamp_ntz) last_seen_at from values ('2023-12-31 00:00:00'), ('2023-12-30 23:59:59') v(t)"
    )
    kept = performance_rows(wide, cfg)
    assert kept.count() == 1 and len(kept.columns) == 23 and "peer_subdivision" not in kept.columns


LEDGER = [("2024-01-01", "ethereum", "T", True, 1, 10), ("2024-01-02", "ethereum", "T", True, 11, 30)]


def ledger(spark, data):
    text = "t string, blockchain string, incremental_table string, run_completed boolean, a bigint, b bigint"
    return spark.createDataFrame(data, text).select(
        F.col("t").cast("timestamp_ntz").alias("run_timestamp"), "blockchain", "incremental_table", "run_completed",
        F.col("a").alias("run_start_blk_number"), F.col("b").alias("run_stop_blk_number"),
    )


def source(spark, *blocks):
    data = [(n, at(60 * n)) for n in blocks]
    return spark.createDataFrame(data, "blk_number bigint, inserted_at timestamp_ntz")


def test_plan_run(spark, cfg):
    models = runs.incremental_models(spark, ["t", "new"], ("ethereum",))
    # The table all chains' sources reached counts; rows inserted at or after the run start do not.
    late = spark.sql("select 99L blk_number, timestamp_ntz '2024-01-31 00:00:00' inserted_at")
    sources = {"ethereum": [source(spark, 40, 50).unionByName(late), source(spark, 45)]}
    planned = runs.plan_run(ledger(spark, LEDGER), models, sources, cfg)
    assert rows(planned, "incremental_table", "run_start_blk_number", "run_stop_blk_number", "run_completed") == [
        ("NEW", 1, 45, False), ("T", 31, 45, False),
    ]
    refresh = runs.plan_run(ledger(spark, LEDGER), models, sources, replace(cfg, full_refresh=True))
    assert rows(refresh, "incremental_table", "run_start_blk_number", "run_stop_blk_number") == [
        ("NEW", 1, 0), ("T", 1, 30),
    ]


def test_unfinished_run_does_not_move_the_start(spark, cfg):
    data = [*LEDGER, ("2024-01-03", "ethereum", "T", False, 31, 45)]
    models = runs.incremental_models(spark, ["T"], ("ethereum",))
    planned = runs.plan_run(ledger(spark, data), models, {"ethereum": [source(spark, 60)]}, cfg)
    assert rows(planned, "run_start_blk_number") == [(31,)]
    with pytest.raises(runs.IncompleteRunError):
        runs.assert_no_running(ledger(spark, data), ["t"])
    assert rows(runs.incomplete_runs(ledger(spark, data), ["t"])) == [("ethereum", "T", 3)]
    runs.assert_no_running(ledger(spark, data), ["other"])
    runs.assert_no_running(ledger(spark, LEDGER), ["t"])


def test_mark_and_ranges(spark, cfg):
    now = "2024-01-31 00:00:00"
    data = [*LEDGER, (now, "ethereum", "T", False, 31, 45), (now, "ethereum", "U", False, 5, 60)]
    marked = runs.mark_completed(ledger(spark, data), "t", cfg).where(F.col("run_timestamp") == cfg.run_stamp)
    assert rows(marked, "incremental_table", "run_completed") == [("T", True), ("U", False)]
    coarse = runs.run_block_range(ledger(spark, data), now)
    assert rows(coarse) == [("ethereum", 5, 60)]
    own = runs.table_block_range(ledger(spark, data), now, "t")
    blocks = spark.createDataFrame(
        [("ethereum", 30), ("ethereum", 31), ("ethereum", 45), ("polygon", 40)], "blockchain string, blk_number bigint"
    )
    inside = runs.in_block_ranges(blocks, own, ("ethereum", "polygon"))
    assert rows(inside) == [("ethereum", 31), ("ethereum", 45)]
    assert runs.in_block_ranges(blocks, own.where("false"), ("ethereum",)).count() == 0


def test_ledger_schema(spark):
    assert ledger(spark, LEDGER).schema.simpleString() == spark.createDataFrame([], SCHEMAS["run_ledger"]).schema.simpleString()


def test_bad_duration_fails(spark, cfg):
    from peernet.operators.sessions import sessionize

    data = feed(spark, [(1, "n", "p", "peer_set_add", []), (2, "n", "p", "peer_set_remove", ["r", "x", "soon"])])
    with pytest.raises(PySparkException):
        sessionize(data, cfg, cfg.initial_bound).collect()
