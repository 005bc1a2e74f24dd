import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from caselight.operators.quality import DataQualityError
from caselight.plans import ingest as ingest_plan, marts, monitoring
from caselight.plans.ingest import Warehouse, build_models, load_batch, run_load, task_runs
from caselight.plans.reports import run_summary
from caselight.plans.staging import stage_reports
from caselight.schemas import FRESHNESS_DDL, LANDING_COLUMNS, LANDING_DDL, RAW_COLUMNS, REPORT_DDL
from caselight.sources import landing, paged, reports, tables, windows
from caselight.streaming import checks, ingest, jobs, ladder
from tests.helpers import rows

WINDOW = "receiptdate:[20060401 TO 20070401]"


# --- documents -------------------------------------------------------------------------------------------------------

def test_flatten_edge_documents(spark, tmp_path):
    documents = [
        {"safetyreportid": "1", "patient": {"drug": [], "reaction": []}, "primarysource": {}},
        {"safetyreportid": "2"},
        {"safetyreportid": "3", "serious": 1, "patient": {
            "patientonsetage": 41, "drug": [{"medicinalproduct": "x"}, {"medicinalproduct": "y"}],
            "reaction": [{"reactionmeddrapt": "r", "reactionoutcome": "2"}]}, "primarysource": {"reportercountry": "PE"}},
        {"safetyreportid": "4", "patient": None, "unknown": {"a": 1}},
    ]
    path = tmp_path / "docs.json"
    path.write_text("\n".join(map(json.dumps, documents)))
    flat = reports.flatten(reports.read_documents(spark, str(path)), "2024-03-01")
    assert flat.columns == LANDING_COLUMNS
    assert rows(flat, "report_id", "serious", "patient_age", "drug_name", "reaction", "outcome", "country") == [
        ("1", None, None, None, None, None, None), ("2", None, None, None, None, None, None),
        ("3", "1", "41", "x", "r", "2", "PE"), ("4", None, None, None, None, None, None)]
    page = json.dumps({"meta": {"results": {"total": 4}}, "results": documents})
    pages = spark.createDataFrame([(page,), (json.dumps({"results": []}),)], "page string")
    assert rows(reports.flatten(reports.explode_pages(pages), "2024-03-01")) == rows(flat)
    assert [r[0] for r in pages.select(reports.page_total(F.col("page"))).collect()] == [4, 0]


# --- windows and pages -----------------------------------------------------------------------------------------------

def test_windows_go_back_and_split():
    assert windows.years_back("receiptdate:[20250401 TO 20260401]") == "receiptdate:[20240401 TO 20250401]"
    assert windows.steps_back("receiptdate:[20050401 TO 20060401]") == 1
    assert windows.halves("receiptdate:[20240228 TO 20240302]") == [
        "receiptdate:[20240228 TO 20240229]", "receiptdate:[20240301 TO 20240302]"]
    for wrong in ("something else", "receiptdate:[20240228 TO 20240228]"):
        with pytest.raises(ValueError):
            windows.halves(wrong)


def test_windows_and_pages(spark):
    back = windows.windows_back(spark, WINDOW)
    assert [r["date_range"] for r in back.orderBy("position").collect()] == [
        WINDOW, windows.years_back(WINDOW), windows.years_back(WINDOW, 2)]
    totals = spark.createDataFrame([("a", 0), ("b", 100), ("c", 101)], "date_range string, total bigint")
    assert {r[0]: r[1:] for r in windows.page_plan(totals).groupBy("date_range").agg(F.count("skip"), F.max("skip")).collect()} == {
        "b": (1, 0), "c": (2, 100)}
    with pytest.raises(Exception, match="more rows than the service serves"):
        windows.page_plan(spark.createDataFrame([("d", 25_001)], "date_range string, total bigint")).collect()


def test_windows_are_cut_until_they_fit(spark):
    days = [("w", dt.date(2024, 1, 1) + dt.timedelta(days=i), 700 + i) for i in range(90)] + [("s", dt.date(2023, 1, 5), 9)]
    daily = spark.createDataFrame(days, "date_range string, day date, total bigint")
    fitted = windows.fit_windows(daily)
    got = {r["date_range"]: r["total"] for r in fitted.collect()}
    assert got.pop("s") == 9 and len(got) >= 3 and max(got.values()) <= 25_000
    assert sum(got.values()) == sum(d[2] for d in days[:-1])
    assert windows.page_plan(fitted).count() == sum(-(-n // 100) for n in [*got.values(), 9])
    with pytest.raises(Exception, match="on day 2024-01-01"):
        windows.fit_windows(spark.createDataFrame([("w", dt.date(2024, 1, 1), 25_001)], "date_range string, day date, total bigint")).collect()


def make_service(path, per_day, cap=25_000, gap=None):
    """A service of ``per_day`` reports on each day of some years, kept in a file so that it can grow; it refuses to go on
    beyond the cap, as the real one does."""
    def fetch(date_range, skip, limit, options):
        import datetime, json, os

        if not os.path.exists(options["folder"]):
            raise RuntimeError("down")
        with open(options["folder"], encoding="utf-8") as file:
            years = json.load(file)
        if skip + limit > int(options.get("cap", 25_000)):
            raise RuntimeError(f"refused: {skip} + {limit}")
        first, last = (datetime.datetime.strptime(d, "%Y%m%d").date() for d in
                       (date_range[13:21], date_range[25:33]))
        span = (last - first).days + 1
        rate = years.get(str(first.year), 0)
        total = span * rate
        rows = range(skip, min(skip + limit, total))
        if gap_at is not None and gap_at in rows:
            return None
        results = [{"safetyreportid": f"{first + datetime.timedelta(days=i // rate)}-{i % rate}"} for i in rows]
        return json.dumps({"meta": {"results": {"total": total}}, "results": results}) if results else None

    gap_at = gap
    path.write_text(json.dumps(per_day))
    return fetch


YEAR = "receiptdate:[20060101 TO 20061231]"


def read_pages(spark, path, **options):
    return spark.read.format("paged_reports").options(folder=str(path), date_range=YEAR, **options).load()


def ids(pages):
    found = [r["safetyreportid"] for r in reports.explode_pages(pages).select("safetyreportid").collect()]
    assert len(found) == len(set(found))
    return found


def test_paged_batch(spark, tmp_path):
    path = tmp_path / "service.json"
    paged.register(spark, make_service(path, {"2006": 4, "2005": 1}))
    assert len(ids(read_pages(spark, path))) == 1460
    assert len(ids(read_pages(spark, path, max_rows=1000))) == 1000
    rest = read_pages(spark, path, skip=955, pages_per_task=2)
    assert rest.rdd.getNumPartitions() == 3 and len(ids(rest)) == 505
    assert len(ids(read_pages(spark, path, skip=1460))) == 365
    assert read_pages(spark, path, skip=1460, earliest_year=2006).count() == 0


def test_large_windows_are_split_and_read_whole(spark, tmp_path):
    path = tmp_path / "service.json"
    paged.register(spark, make_service(path, {"2006": 165}))
    assert len(ids(read_pages(spark, path, pages_per_task=100))) == 60_225
    assert len(ids(read_pages(spark, path, pages_per_task=100, skip=24_950))) == 60_225 - 24_950
    paged.register(spark, make_service(path, {"2006": 25_001}))
    with pytest.raises(Exception, match="one day and cannot be split"):
        read_pages(spark, path).collect()


def test_a_missing_page_fails_the_read(spark, tmp_path):
    path = tmp_path / "service.json"
    paged.register(spark, make_service(path, {"2006": 2}, gap=350))
    with pytest.raises(Exception, match="rows at skip=300"):
        read_pages(spark, path).collect()


def test_paged_offsets_replay_and_follow_growth(tmp_path):
    path = tmp_path / "service.json"
    fetch = make_service(path, {"2006": 1, "2005": 2})
    reader = paged.PagedStreamReader({"folder": str(path), "date_range": YEAR, "skip": "100"}, fetch)
    end = json.loads(json.dumps(reader.latestOffset()))
    plan = lambda start, end: [(p.date_range[13:17], p.start, p.end) for p in reader.partitions(start, end)]
    assert plan(reader.initialOffset(), end) == [("2006", 100, 365), ("2005", 0, 730)]
    path.write_text(json.dumps({"2006": 2, "2005": 2}))
    assert plan(reader.initialOffset(), end) == [("2006", 100, 365), ("2005", 0, 730)]
    later = json.loads(json.dumps(reader.latestOffset()))
    assert plan(end, later) == [("2006", 365, 730)]
    assert plan(later, later) == [("2006", 0, 0)]


def test_paged_stream_resumes_at_its_cursor(spark, tmp_path):
    path, out, checkpoint = tmp_path / "service.json", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    paged.register(spark, make_service(path, {"2006": 1}))
    options = {"folder": str(path), "date_range": YEAR, "skip": "100"}

    def run():
        documents = reports.flatten(ingest.page_stream(spark, options), "2024-03-01")
        jobs.start_table(documents, out, checkpoint).awaitTermination()
        return spark.read.schema(LANDING_DDL).parquet(out).count()

    assert run() == 265
    assert run() == 265
    path.write_text(json.dumps({"2006": 1, "2005": 1}))
    assert run() == 630


# --- landing files ---------------------------------------------------------------------------------------------------

def landing_batch(spark, *values):
    data = [tuple(v.get(name) for name in LANDING_COLUMNS) for v in values]
    return spark.createDataFrame(data, LANDING_DDL)


def test_landing_keeps_text_as_it_is(spark, tmp_path):
    path = str(tmp_path / "landing")
    tricky = [{"report_id": "1", "drug_name": 'say "x", y', "reaction": "a\nb", "serious": "01", "country": ""},
              {"report_id": "2", "drug_name": None, "reaction": "back\\slash", "serious": "1.0", "country": " PE "}]
    assert landing.write_landing(landing_batch(spark, *tricky), path, "2024-03-01", "0001") == 2
    back = landing.read_batch(spark, path, "2024-03-01", "0001")
    columns = ["report_id", "drug_name", "reaction", "serious", "country", "load_date"]
    assert rows(back, *columns) == [("1", 'say "x", y', "a\nb", "01", None, "2024-03-01"),
                                    ("2", None, "back\\slash", "1.0", " PE ", "2024-03-01")]


def test_landing_batches_of_one_day_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "landing")
    for day, batch in (("2024-02-28", "0009"), ("2024-02-29", "0001"), ("2024-02-29", "0002")):
        landing.write_landing(landing_batch(spark, {"report_id": day + batch}), path, day, batch)
    assert landing.latest_batch(spark, path) == ("2024-02-29", "0002")
    assert landing.read_landing(spark, path).count() == 3
    assert "report_id" in landing.header(spark, landing.batch_path(path, "2024-02-29", "0001"))


def test_missing_landing_file_lists_what_exists(spark, tmp_path):
    path = str(tmp_path / "landing")
    with pytest.raises(FileNotFoundError, match="nothing has landed"):
        landing.read_batch(spark, path, "2024-02-29", "0001")
    with pytest.raises(landing.LandingError):
        landing.latest_batch(spark, path)
    landing.write_landing(landing_batch(spark, {"report_id": "1"}), path, "2024-02-28", "0001")
    with pytest.raises(FileNotFoundError, match="there are: .*load_date=2024-02-28"):
        landing.read_batch(spark, path, "2024-02-29", "0001")


# --- stored tables ---------------------------------------------------------------------------------------------------

def test_keyed_table(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=4)
    assert not table.exists(spark)
    table.upsert(spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v")), [F.desc("v")])
    changed = spark.createDataFrame([("5", 1), ("5", 2), ("new", 3), (None, 9)], "id string, v int")

    def state():
        found = {r["id"]: r["v"] for r in table.read(spark).collect()}
        return len(found), found["5"], found.get("new")

    assert state() == (100, 0, None)
    for _ in range(3):  # a repeated batch, rows without key included, changes nothing
        table.upsert(changed, [F.desc("v")])
        assert state() == (101, 2, 3)
    table.write(changed.where("v = 1"))
    assert rows(table.read(spark)) == [("5", 1)]


def files_of(spark, path):
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").collect()
    return {r["path"]: r["length"] for r in found if "part-" in r["path"]}


def test_keyed_table_leaves_other_buckets_alone(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=8)
    table.write(spark.range(200).withColumn("v", F.lit(0)))
    before = files_of(spark, f"{table.path}/data")
    table.upsert(spark.range(1).withColumn("v", F.lit(1)), [F.desc("v")])
    after = files_of(spark, f"{table.path}/data")
    assert before.items() <= after.items() and len(after) == len(before) + 1  # nothing overwritten, one bucket written
    assert table.read(spark).where("v = 1").count() == 1


def test_keyed_table_buckets_grow_with_the_table(spark, tmp_path):
    """Buckets are cut in two where they grow; what one load writes stays bounded by the buckets it touches."""
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=2, leaf_rows=50)
    expected = {}
    for step in range(6):
        batch = [(f"{(step * 67 + i) % 500}", step) for i in range(90)]
        table.upsert(spark.createDataFrame(batch, "id string, v int"), [F.desc("v")])
        expected |= dict(batch)
        version, leaves = table._current(spark)
        assert version == step + 1 and sum(n for _, n in leaves.values()) == len(expected)
        assert rows(table.read(spark)) == sorted(expected.items())
        assert sum(2.0 ** (1 - leaf.bit_length()) for leaf in leaves) == 1.0  # every hash has one bucket
    assert max(n for _, n in leaves.values()) <= 50 and len(leaves) >= len(expected) // 50
    table.upsert(spark.createDataFrame([("new", 1)], "id string, v int"), [F.desc("v")])
    written = spark.read.parquet(f"{table.path}/data/load=7").count()
    assert written <= 51 and table.read(spark).count() == len(expected) + 1


def test_keyed_table_survives_a_load_that_dies(spark, tmp_path, monkeypatch):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=4)
    table.write(spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int"))
    batch = spark.createDataFrame([("a", 2), ("c", 2)], "id string, v int")
    reader = table.read(spark)

    def dies(*args):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(tables.KeyedTable, "_publish", dies)  # all data files are there, the map is not
        with pytest.raises(RuntimeError):
            table.upsert(batch, [F.desc("v")])
    assert rows(table.read(spark)) == [("a", 1), ("b", 1)]
    table.upsert(batch, [F.desc("v")])
    assert rows(table.read(spark)) == [("a", 2), ("b", 1), ("c", 2)]
    assert rows(reader) == [("a", 1), ("b", 1)]  # an earlier reader goes on with what it began with


def test_keyed_table_cleaning(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=1)
    for v in range(5):
        table.upsert(spark.createDataFrame([("a", v), (f"k{v}", v)], "id string, v int"), [F.desc("v")])
    assert table.clean(spark, keep=2) == 6  # three folders and three maps
    assert table.read(spark).count() == 6 and len(files_of(spark, f"{table.path}/data")) == 2
    assert table.clean(spark, keep=2) == 0


def test_a_key_that_comes_again_in_a_later_batch_is_reported(spark, tmp_path):
    seen = tables.KeyedTable(str(tmp_path / "seen"), ("id",), buckets=4)
    batches = [["a", "b", None, None], ["b", "c", "c"], ["d"], ["a", "d"]]
    expected = [[], [("b", 1, 0), ("c", 2, 1)], [], [("a", 1, 0), ("d", 1, 2)]]
    for number, (keys, found) in enumerate(zip(batches, expected)):
        batch = spark.createDataFrame([(k,) for k in keys], "id string")
        for _ in range(2):  # handed over again after a failure: the same answer
            assert rows(checks.repeated_keys(batch, number, seen), "id", "n_rows", "first_batch") == found
            checks.remember_keys(batch, number, seen)
    assert rows(seen.read(spark)) == [("a", 0), ("b", 0), ("c", 1), ("d", 2)]


def test_a_profile_reads_new_buckets_only(spark, tmp_path, monkeypatch):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=8)
    read = []
    original = tables.KeyedTable.stored
    monkeypatch.setattr(tables.KeyedTable, "stored", lambda self, spark, leaves: read.append(len(leaves)) or original(self, spark, leaves))

    def profile(columns=("v", "w")):
        found = monitoring.profile(spark, table, columns, str(tmp_path / "p"), "at")
        return {r["column_name"]: (r["total_rows"], r["null_rows"], r["null_pct"], r["newest"]) for r in found.collect()}

    day = lambda n: dt.datetime(2024, 1, n)
    batch = lambda keys, v, n: spark.createDataFrame([(k, v, day(n)) for k in keys], "id bigint, v int, at timestamp_ntz")
    with pytest.raises(FileNotFoundError):
        profile()
    table.write(batch(range(200), None, 1))
    assert table.count(spark) == 200
    assert profile() == {"v": (200, 200, 100.0, day(1)), "w": (200, 200, 100.0, day(1))} and read == [8]
    assert profile()["v"][0] == 200 and read == [8]  # nothing new, nothing read
    table.upsert(batch([3], 7, 2), [F.desc("v")])
    assert profile() == {"v": (200, 199, 99.5, day(2)), "w": (200, 200, 100.0, day(2))} and read == [8, 1]
    assert profile(("id", "v"))["id"] == (200, 0, 0.0, day(2)) and read == [8, 1, 8]  # a column not asked for before
    table.write(batch([], 1, 1))
    assert profile() == {"v": (0, 0, 0.0, None), "w": (0, 0, 0.0, None)} and read == [8, 1, 8]


def test_empty_keyed_table(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ("id",), buckets=2)
    assert table.clean(spark) == 0
    table.write(spark.createDataFrame([], "id string, v int"))
    assert table.exists(spark) and table.read(spark).columns == ["id", "v"] and table.read(spark).count() == 0
    table.upsert(spark.createDataFrame([("a", 1)], "id string, v int"), [F.desc("v")])
    assert rows(table.read(spark)) == [("a", 1)]


def test_keyed_table_keeps_columns_of_either_side(spark, tmp_path):
    table = tables.KeyedTable(str(tmp_path / "t"), ("k",), buckets=4)
    table.write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"))
    table.upsert(spark.createDataFrame([("b", 2, "x"), ("c", 3, "y")], "k string, v int, extra string"), [F.desc("v")])
    table.upsert(spark.createDataFrame([("d", 4)], "k string, v int"), [F.desc("v")])
    assert rows(table.read(spark), "k", "v", "extra") == [("a", 1, None), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, None)]


def test_snapshot_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "backup")
    assert tables.snapshot_once(spark.range(3), path).count() == 3
    assert tables.snapshot_once(spark.range(5), path).count() == 3


def test_log_columns_may_be_added_later(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_log(spark, path, "a int, b int").count() == 0
    tables.append(spark.createDataFrame([(1,)], "a int"), path)
    tables.append(spark.createDataFrame([(2, 3)], "a int, b int"), path)
    assert rows(tables.read_log(spark, path, "a int, b int")) == [(1, None), (2, 3)]


def test_load_batch_logs_and_skips_empty_batches(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "w"))
    batch = landing_batch(spark, {"report_id": "1", "patient_age": "NaN", "load_date": "2024-03-01", "serious": "1.0"})
    order = [F.desc("received_date")]
    assert load_batch(warehouse, batch.limit(0), order, "2024-03-01 01:00:00") == 0
    assert not warehouse.raw.exists(spark)
    assert load_batch(warehouse, batch, order, "2024-03-01 02:00:00", used_cache=True, clean_codes=True) == 1
    row = warehouse.raw.read(spark).first()
    assert (row["patient_age"], row["serious"], row["loaded_at"]) == (None, "1", dt.datetime(2024, 3, 1, 2))
    log = tables.read_log(spark, warehouse.path("monitoring", "freshness_checks"), FRESHNESS_DDL).first()
    assert (log["data_source"], log["is_stale"]) == ("cached", True)


def clock_from(start):
    moments = iter(start + dt.timedelta(minutes=i) for i in range(1000))
    return lambda: next(moments)


def document_frame(spark, *documents):
    lines = spark.createDataFrame([(json.dumps(d),) for d in documents], "json string")
    return reports.parse_documents(lines)


def full_document(key, **fields):
    return {"safetyreportid": key, "receiptdate": "20240101", "serious": "1", "patient": {
        "patientsex": "1", "drug": [{"medicinalproduct": "x"}], "reaction": [{"reactionmeddrapt": "r"}]}} | fields


def test_run_load_logs_each_task(spark, tmp_path):
    warehouse, path = Warehouse(str(tmp_path / "w")), str(tmp_path / "landing")
    clock = clock_from(dt.datetime(2024, 3, 1))

    def load(run_id, documents):
        return run_load(spark, warehouse, documents, path, "2024-03-01", ("d", run_id), clock)

    def states(run_id):
        found = task_runs(warehouse, spark).where(F.col("run_id") == run_id)
        return {r["task_id"]: (r["status"], r["rows_processed"]) for r in found.collect()}

    def down():
        raise paged.SourceUnavailable("no route to host")

    with pytest.raises(landing.LandingError):
        load("r0", down)
    assert states("r0") == {"extract_reports": ("failed", None)}
    load("r1", lambda: document_frame(spark, full_document("a"), full_document("b")))
    assert states("r1") == {"extract_reports": ("success", 2), "validate_schema": ("success", None),
                            "load_reports": ("success", 2), "build_models": ("success", None)}
    assert load("r2", down).used_cache
    assert states("r2")["load_reports"] == ("success", 2) and warehouse.raw.read(spark).count() == 2
    log = tables.read_log(spark, warehouse.path("monitoring", "freshness_checks"), FRESHNESS_DDL)
    assert sorted(r["data_source"] for r in log.collect()) == ["cached", "live"]
    assert load("r3", lambda: document_frame(spark, full_document("a")).limit(0)).rows == 0
    assert states("r3") == {"extract_reports": ("success", 0)}
    with pytest.raises(DataQualityError, match="drug_name: not_null failed for 1"):
        load("r4", lambda: document_frame(spark, full_document("c", patient={"reaction": [{"reactionmeddrapt": "r"}]})))
    assert states("r4")["build_models"] == ("failed", None)
    error = task_runs(warehouse, spark).where("run_id = 'r4' and status = 'failed'").first()["error_message"]
    assert "not_null failed for 1" in error
    summary = run_summary(task_runs(warehouse, spark)).first()
    assert (summary["total_runs"], summary["success_rate"]) == (5, 60.0)
    assert ingest.first_cursor(spark, warehouse, WINDOW) == {"date_range": WINDOW, "skip": "3"}


def mart_rows(warehouse, spark):
    return [rows(spark.read.parquet(warehouse.path("mart", name))) for name in ("drug_reactions", "serious_events")]


def rebuilt(warehouse, spark):
    groups = marts.report_groups(stage_reports(warehouse.raw.read(spark)))
    return [rows(marts.drug_reactions_from_groups(groups)), rows(marts.serious_events_from_groups(groups))]


def test_marts_follow_the_loads(spark, tmp_path, monkeypatch):
    """After every load the marts equal a full rebuild, though only the replaced buckets of the raw table are read."""
    warehouse = Warehouse(str(tmp_path / "w"), buckets=16)
    rng = random.Random(4)
    order = [F.desc_nulls_last("received_date")]
    read, looked_up = [], []
    original, newest = marts.changed_groups, marts.with_newest

    def changed(groups, removed, added):
        read.append([len(df.inputFiles()) if df is not None else 0 for df in (removed, added)])
        return original(groups, removed, added)

    monkeypatch.setattr(marts, "changed_groups", changed)
    monkeypatch.setattr(marts, "with_newest", lambda *args: looked_up.append(1) or newest(*args))

    def load(step, keys, day):
        batch = landing_batch(spark, *[{
            "report_id": str(k), "serious": rng.choice(["1", "2", ""]), "serious_death": rng.choice(["1", None]),
            "patient_age": rng.choice(["40", "7.5", "x", None]), "drug_name": rng.choice(["a", "B ", "c"]),
            "reaction": rng.choice(["r", "s"]), "outcome": rng.choice(["1", "2", None]), "received_date": day(k), "patient_sex": "1",
            "load_date": "2024-03-01"} for k in keys])
        load_batch(warehouse, batch, order, f"2024-03-0{step + 1} 01:00:00", batch_id=str(step))
        build_models(warehouse, spark)
        assert mart_rows(warehouse, spark) == rebuilt(warehouse, spark)

    load(0, range(300), lambda k: f"2024{k % 12 + 1:02d}01")
    assert read == []  # nothing to follow yet
    load(1, [5, 900], lambda k: "20250101")  # one replaced, one new, both newer
    assert len(read) == 1 and max(read[0]) <= 2 and not looked_up
    load(2, range(0, 300, 2), lambda k: "20200101")  # the newest rows of groups are replaced by older ones
    assert looked_up
    build_models(warehouse, spark)  # nothing new: nothing read
    assert len(read) == 2
    warehouse.raw.upsert(warehouse.raw.read(spark).limit(3).withColumn("drug_name", F.lit("d")), order)
    warehouse.raw.upsert(warehouse.raw.read(spark).limit(3).withColumn("drug_name", F.lit("e")), order)
    build_models(warehouse, spark)  # two loads at once
    assert mart_rows(warehouse, spark) == rebuilt(warehouse, spark) and len(read) == 3
    warehouse.raw.upsert(warehouse.raw.read(spark).limit(3).withColumn("drug_name", F.lit("f")), order)
    warehouse.raw.clean(spark, keep=1)
    build_models(warehouse, spark)  # the version that was grouped is gone: all is grouped anew
    assert mart_rows(warehouse, spark) == rebuilt(warehouse, spark) and len(read) == 3


def test_a_load_may_begin_with_a_drill(spark, tmp_path):
    warehouse, path = Warehouse(str(tmp_path / "w"), buckets=4), str(tmp_path / "landing")
    clock = clock_from(dt.datetime(2024, 3, 1))

    def load(run_id, drill="none", n=1):
        documents = lambda: document_frame(spark, *[full_document(f"{run_id}-{i}") for i in range(n)])
        return run_load(spark, warehouse, documents, path, "2024-03-01", ("d", run_id), clock, drill=drill)

    def tasks(run_id):
        return {r["task_id"] for r in task_runs(warehouse, spark).where(F.col("run_id") == run_id).collect()}

    load("r0", "volume_anomaly", n=20)  # nothing stored yet, nothing to damage
    assert warehouse.raw.read(spark).count() == 20 and "run_drill" in tasks("r0")
    load("r1", "volume_anomaly")
    assert warehouse.raw.read(spark).count() == 8 + 1
    with pytest.raises(DataQualityError, match="drug_name: not_null failed for 9"):
        load("r2", "schema_drift")
    assert "medication_name" in warehouse.raw.read(spark).columns and warehouse.raw.read(spark).where("drug_name IS NULL").count() == 9
    ingest_plan.restore_raw(warehouse, spark)
    assert warehouse.raw.read(spark).columns == RAW_COLUMNS and warehouse.raw.read(spark).count() == 20
    load("r3", "unheard_of")
    assert warehouse.raw.read(spark).count() == 21
    load("r4")
    assert "run_drill" in tasks("r3") and "run_drill" not in tasks("r4")


def test_only_a_source_that_is_down_lets_a_load_use_old_data(spark, tmp_path):
    warehouse, path = Warehouse(str(tmp_path / "w"), buckets=4), str(tmp_path / "landing")
    clock = clock_from(dt.datetime(2024, 3, 1))
    load = lambda run_id, documents: run_load(spark, warehouse, documents, path, "2024-03-01", ("d", run_id), clock)

    def down():
        raise paged.SourceUnavailable("no route to host")

    broken_line = full_document("b", patient={"patientsex": "1", "drug": [{"medicinalproduct": 'a\nb"c,d'}],
                                              "reaction": [{"reactionmeddrapt": "r\r\ns"}]})
    assert load("r1", lambda: document_frame(spark, full_document("a"), broken_line)).rows == 2
    batch = landing.read_batch(spark, path, "2024-03-01", "r1")
    assert {r["drug_name"] for r in batch.collect()} == {"x", 'a\nb"c,d'}
    with pytest.raises(Exception, match="safetyreportid"):
        load("r2", lambda: spark.createDataFrame([("x",)], "other string"))
    with pytest.raises(OSError):
        load("r3", lambda: (_ for _ in ()).throw(OSError("disk full")))
    assert load("r4", lambda: document_frame(spark, full_document("a")).limit(0)).rows == 0
    again = load("r5", down)
    assert (again.used_cache, again.batch_id, again.rows) == (True, "r1", 2)
    assert [r["batch_id"] for r in landing.batches(spark, path).collect()] == ["r1"]


def test_a_paged_load_keeps_its_cursor(spark, tmp_path):
    warehouse, service = Warehouse(str(tmp_path / "w"), buckets=4), tmp_path / "service.json"
    inner, unavailable = make_service(service, {"2006": 1, "2005": 1}), paged.SourceUnavailable

    def fetch(date_range, skip, limit, options):
        import json, os

        if not os.path.exists(options["folder"] + ".up"):
            raise unavailable("down")
        page = inner(date_range, skip, limit, options)
        if not page:
            return None
        envelope = json.loads(page)
        for r in envelope["results"]:
            r |= {"receiptdate": "20060101", "serious": "1", "patient": {
                "patientsex": "1", "drug": [{"medicinalproduct": "x"}], "reaction": [{"reactionmeddrapt": "r"}]}}
        return json.dumps(envelope)

    clock = clock_from(dt.datetime(2024, 3, 1))
    options = {"folder": str(service), "date_range": YEAR, "max_rows": "200", "earliest_year": "2005"}
    load = lambda run: ingest_plan.run_paged_load(spark, warehouse, fetch, options, str(tmp_path / "l"), "2024-03-01", ("d", run), clock)
    (tmp_path / "service.json.up").write_text("")
    assert [load(f"r{i}").rows for i in range(3)] == [200, 165, 200]
    (tmp_path / "service.json.up").unlink()
    assert load("r3").used_cache
    (tmp_path / "service.json.up").write_text("")
    assert [load(f"s{i}").rows for i in range(2)] == [165, 0]
    assert warehouse.raw.read(spark).count() == 730


# --- streams ---------------------------------------------------------------------------------------------------------

def test_stream_ingest_replays_without_effect(spark, tmp_path):
    source, warehouse = tmp_path / "docs", Warehouse(str(tmp_path / "w"))
    os.makedirs(source)

    def drop(name, *documents):
        (source / name).write_text("\n".join(json.dumps(d) for d in documents))

    def run(checkpoint):
        documents = ingest.document_stream(spark, str(source))
        ingest.start_ingest(documents, warehouse, "2024-03-01", "2024-03-01 00:00:00", str(tmp_path / checkpoint)).awaitTermination()
        return rows(warehouse.raw.read(spark), "report_id", "serious")

    drop("1.json", {"safetyreportid": "a", "serious": "1", "receiptdate": "20240101"}, {"safetyreportid": "b", "serious": "2"})
    assert run("c1") == [("a", "1"), ("b", "2")]
    drop("2.json", {"safetyreportid": "a", "serious": "2", "receiptdate": "20240102"})
    assert run("c1") == [("a", "2"), ("b", "2")]
    assert run("c2") == [("a", "2"), ("b", "2")]  # everything once more from an empty checkpoint


def test_ladder_timers(spark, tmp_path):
    ddl = ("incident_id string, severity string, status string, created_at timestamp_ntz, "
           "escalation_email_sent_at timestamp_ntz, dag_paused_at timestamp_ntz, proposed_sql string")
    start = dt.datetime(2024, 3, 1)
    minute = lambda m: start + dt.timedelta(minutes=m)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.STATE_PROVIDER)

    def feed(*data):
        data = [(*row, "DELETE FROM raw.case_reports") if len(row) == 6 else row for row in data]
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = ladder.escalations(spark.readStream.schema(ddl).parquet(source))
        jobs.start_table(stream, out, checkpoint).awaitTermination()
        got = spark.read.schema(stream.schema).parquet(out)
        return {(r["incident_id"], r["action"]) for r in got.collect()}

    first = feed(("p1", "P1", "pending", minute(0), None, None), ("p0", "P0", "pending", minute(0), None, None),
                 ("p2", "P2", "pending", minute(0), None, None), ("stopped", "P1", "pending", minute(0), None, None),
                 ("mailed", "P0", "pending", minute(0), minute(0), None))
    assert first == set()
    assert feed(("stopped", "P1", "approved", minute(10), None, None)) == set()
    assert feed((None, None, "heartbeat", minute(29), None, None)) == set()
    assert feed((None, None, "heartbeat", minute(30), None, None)) == {("p1", "auto_apply"), ("p0", "send_mail")}
    assert feed(("p0", "P0", "rejected", minute(45), None, None)) == {("p1", "auto_apply"), ("p0", "send_mail")}
    assert feed((None, None, "heartbeat", minute(99), None, None)) == {
        ("p1", "auto_apply"), ("p0", "send_mail"), ("mailed", "pause_dag")}
    # A rejection that arrives before its request, in one batch and in two; a request far behind the clock.
    early = feed(("turned", "P1", "rejected", minute(105), None, None), ("turned", "P1", "pending", minute(100), None, None),
                 ("late", "P1", "pending", minute(2), None, None), ("gone", "P1", "rejected", minute(104), None, None))
    assert early == {("p1", "auto_apply"), ("p0", "send_mail"), ("mailed", "pause_dag"), ("late", "auto_apply")}
    feed(("gone", "P1", "pending", minute(103), None, None), ("again", "P1", "pending", minute(103), None, None, None))
    assert feed((None, None, "heartbeat", minute(300), None, None)) - early == {("again", "auto_apply")}
    steps = {r["incident_id"]: r["step"] for r in spark.read.parquet(out).where("action = 'auto_apply'").collect()}
    assert steps == {"p1": "refuse", "late": "refuse", "again": "retry"}


def test_documents_schema_is_fixed(spark):
    assert spark.createDataFrame([], REPORT_DDL).columns[0] == "safetyreportid"
