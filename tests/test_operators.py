import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselight.bindings import catalog, inputs
from caselight.operators import (
    approvals, changes, drills, incidents, lineage, monitors, quality, repair, runlog, selection, similarity,
)
from caselight.plans import reports
from caselight.schemas import APPROVAL_DDL, BASELINE_DDL, RAW_COLUMNS, RAW_DDL
from tests.helpers import rows

NOW = "2024-03-01 12:00:00"


def at(minutes):
    return dt.datetime(2024, 3, 1, 12) - dt.timedelta(minutes=minutes)


# --- changes ---------------------------------------------------------------------------------------------------------

def batch_of(spark, data):
    return spark.createDataFrame(data, "id string, v int, o int")


def test_upsert_last_wins_and_repeats_without_effect(spark):
    target = batch_of(spark, [("a", 1, 0), ("b", 2, 0), (None, 9, 0)])
    batch = batch_of(spark, [("b", 3, 1), ("b", 4, 2), ("c", 5, 1), (None, 6, 1), (None, 7, 1)])
    once = changes.upsert(target, batch, ["id"], [F.desc("o")])
    assert rows(once, "id", "v") == sorted(
        [("a", 1), ("b", 4), ("c", 5), (None, 9), (None, 6), (None, 7)], key=repr)
    keyed = batch.where("id is not null")
    twice = changes.upsert(changes.upsert(target, keyed, ["id"], [F.desc("o")]), keyed, ["id"], [F.desc("o")])
    assert rows(twice) == rows(changes.upsert(target, keyed, ["id"], [F.desc("o")]))


def test_upsert_stamps_the_batch(spark):
    target = spark.createDataFrame([("a", at(9))], "id string, loaded_at timestamp_ntz")
    batch = spark.createDataFrame([("b",)], "id string")
    got = changes.upsert(target, batch, ["id"], [F.desc("id")], loaded_at=NOW)
    assert rows(got) == [("a", at(9)), ("b", at(0))]


def test_hot_key_keeps_one_row_per_task(spark):
    """A key with nearly all rows is cut down before the shuffle."""
    number = F.col("id").cast("int")
    hot = spark.range(0, 5000, 1, 4).select(
        F.when(number != 7, "hot").otherwise("cold").alias("id"), number.alias("v"), number.alias("o"))
    got = changes.dedupe_batch(hot, ["id"], [F.desc("o")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows(got, "id", "v") == [("cold", 7), ("hot", 4999)]


def test_upsert_columns_keeps_the_rest(spark):
    target = spark.createDataFrame([("a", "old", "approved"), ("b", "old", "pending")], "id string, note string, status string")
    batch = spark.createDataFrame([("a", "new", 1), ("a", None, 2), ("c", "new", 1)], "id string, note string, o int")
    got = changes.upsert_columns(target, batch, ["id"], ["note"], [F.desc("o")], {"status": F.lit("pending")})
    assert rows(got) == sorted([("a", None, "approved"), ("b", "old", "pending"), ("c", "new", "pending")], key=repr)


def test_update_delete_replace(spark):
    target = batch_of(spark, [("a", 1, 0), ("b", 2, 0), (None, 3, 0)])
    hits = spark.createDataFrame([("a", 10), ("z", 11)], "id string, n int")
    assert rows(changes.update_where(target, hits, ["id"], {"v": "n"}), "id", "v") == sorted([("a", 10), ("b", 2), (None, 3)], key=repr)
    assert rows(changes.delete_keys(target, hits, ["id"]), "id", "v") == sorted([("b", 2), (None, 3)], key=repr)
    fresh = batch_of(spark, [("a", 7, 1), ("a", 8, 1)])
    assert rows(changes.replace_slice(target, fresh, ["id"]), "id", "v") == sorted([("a", 7), ("a", 8), ("b", 2), (None, 3)], key=repr)


def test_missing_columns_are_added_once(spark):
    df = batch_of(spark, [("a", 1, 0)])
    wider = changes.add_missing_columns(df, {"v": "int", "extra": "string"})
    assert wider.columns == ["id", "v", "o", "extra"]
    assert changes.add_missing_columns(wider, {"extra": "string"}).columns == wider.columns


def test_run_log_folds_to_the_newest_finish(spark):
    key = spark.createDataFrame([("d", "r", "t"), ("d", "r", "u")], "dag_id string, run_id string, task_id string")
    done = key.where("task_id = 't'").select("*", F.lit("failed").alias("status"), F.lit(5).alias("rows_processed"), F.lit("boom").alias("error_message"))
    retried = runlog.start_events(key.where("task_id = 't'"), at(2))
    events = runlog.start_events(key, at(10)).unionByName(runlog.finish_events(done, at(10), at(5)))
    assert rows(runlog.fold(events.unionByName(retried)), "task_id", "status") == [("t", "failed"), ("t", "running"), ("u", "running")]
    got = {r["task_id"]: r for r in runlog.fold(events).collect()}
    assert (got["t"]["status"], got["t"]["rows_processed"], got["t"]["finished_at"]) == ("failed", 5, at(5))
    assert (got["u"]["status"], got["u"]["finished_at"], got["u"]["started_at"]) == ("running", None, at(10))


# --- quality ---------------------------------------------------------------------------------------------------------

def test_rules_and_gate(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "3"), (None, None), ("b", "2")], "id string, sex string")
    rules = [quality.not_null("id"), quality.unique("id"), quality.accepted_values("sex", ["1", "2"]), quality.max_length("id", 0)]
    report = quality.run_rules(df, rules, "t")
    assert {r["rule"]: r["failures"] for r in report.collect()} == {"not_null": 1, "unique": 1, "accepted_values": 1, "max_length": 3}
    with pytest.raises(quality.DataQualityError, match="t.id: not_null failed for 1"):
        quality.gate(report)
    quality.gate(quality.run_rules(df, rules, "t", exclude=[r.name for r in rules[:2]] + ["accepted_values_sex"]).where("rule = 'x'"))


def test_rules_pass_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id string, sex string")
    quality.gate(quality.run_rules(df, [quality.not_null("id"), quality.unique("id")], "t"))
    assert quality.null_rates(df, ["id"]).first()["null_pct"] == 0.0


def test_required_columns(spark):
    df = spark.createDataFrame([], "report_id string, serious string")
    with pytest.raises(quality.MissingColumnsError, match="Missing columns: \\['country', 'drug_name'"):
        quality.require_columns(df, ["report_id", "drug_name", "country"])


def test_quarantine_splits(spark):
    df = spark.createDataFrame([("a", "20240101"), ("b", "20241345"), (None, ""), ("d", None)], "id string, day string")
    good, bad = quality.quarantine(df, [quality.not_null("id"), quality.valid_day("day")])
    assert rows(good, "id") == [("a",), ("d",)]
    assert {(r["id"], tuple(r["failed_rules"])) for r in bad.collect()} == {("b", ("valid_day_day",)), (None, ("not_null_id",))}


# --- monitors --------------------------------------------------------------------------------------------------------

def baseline(spark, *data):
    return spark.createDataFrame([("raw", t, scope, n, at(m)) for t, scope, n, m in data], BASELINE_DDL)


def test_count_levels(spark):
    counts = spark.createDataFrame(
        [("raw", t, n) for t, n in [("ok", 130), ("warn", 150), ("crit", 151), ("zero", 5), ("none", 0), ("new", 3)]],
        "schema_name string, table_name string, current_count bigint")
    base = baseline(spark, *[(t, "table", 100, 5) for t in ("ok", "warn", "crit")], ("zero", "table", 0, 5), ("none", "table", 0, 5),
                    ("ok", "table", 1, 50), ("ok", "batch", 1, 1))
    checks = monitors.count_check(counts, base)
    assert {r["table_name"]: r["severity"] for r in checks.collect()} == {
        "ok": None, "warn": "warning", "crit": "critical", "zero": "critical", "none": None, "new": None}
    assert rows(monitors.first_baselines(checks, NOW), "table_name", "baseline_count") == [("new", 3)]
    message = monitors.count_alerts(checks, NOW).where("table_name = 'warn'").first()
    assert message["message"] == "raw.warn row count deviated 50.0% from baseline (150 vs 100)"
    assert monitors.count_check(counts, base, scope=None).where("table_name = 'ok'").first()["severity"] == "critical"


def test_freshness_of_empty_and_old_tables(spark):
    stats = monitors.table_stats({
        "empty": spark.createDataFrame([], "loaded_at timestamp_ntz"),
        "old": spark.createDataFrame([(at(24 * 60 + 1),)], "loaded_at timestamp_ntz"),
        "edge": spark.createDataFrame([(at(24 * 60),)], "loaded_at timestamp_ntz"),
    }, "raw")
    checks = monitors.freshness_check(stats, NOW)
    assert {r["table_name"]: r["is_stale"] for r in checks.collect()} == {"empty": True, "old": True, "edge": False}
    levels = monitors.freshness_level(checks)
    assert {r["table_name"]: r["level"] for r in levels.collect()} == {"empty": "error", "old": "pass", "edge": "pass"}


def snapshot(spark, *columns, table="t"):
    return spark.createDataFrame([("raw", table, *c) for c in columns],
                                 "schema_name string, table_name string, column_name string, data_type string, is_nullable string")


def test_schema_diff(spark):
    live = snapshot(spark, ("a", "int", "YES"), ("b", "int", "NO"), ("x", "int", "YES"), ("y", "int", "YES"))
    before = snapshot(spark, ("a", "int", "YES"), ("b", "int", "YES"), ("c", "int", "YES"))
    diff = monitors.schema_diff(live, before).first()
    assert (diff["added"], diff["removed"], diff["changed_types"], diff["has_drift"]) == (["x", "y"], ["c"], ["b"], True)
    first = monitors.schema_diff(live, before.limit(0)).first()
    assert (first["has_prior_snapshot"], first["added"], first["has_drift"]) == (False, [], False)


def test_one_broken_check_does_not_stop_the_others(spark):
    table = spark.createDataFrame([(at(1),)], "loaded_at timestamp_ntz")
    broken = spark.createDataFrame([], "nonsense string")
    found = monitors.run_checks({"t": table}, "raw", broken, broken, NOW)
    assert set(found) == {"alerts", "freshness"} and found["freshness"].count() == 1


# --- drills ----------------------------------------------------------------------------------------------------------

def brute_selection(keys, seed, size):
    ranked = sorted(keys, key=lambda k: hashlib.md5(f"{k}|{seed}".encode()).hexdigest())
    return set(ranked[:size])


@pytest.mark.parametrize("n,fraction,rounding,minimum,size", [
    (1000, 0.6, "ceil", 0, 600), (1001, 0.6, "ceil", 0, 601), (1001, 0.6, "floor", 0, 600), (7, 0.05, "floor", 1, 1),
    (1, 0.6, "ceil", 0, 1), (0, 0.6, "ceil", 1, 0), (5, 0.0, "ceil", 0, 0), (9, 1.0, "ceil", 0, 9),
])
def test_selection_is_exact(spark, n, fraction, rounding, minimum, size):
    df = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("id"))
    hit = selection.select_fraction(df, ["id"], fraction, 3, rounding, minimum)
    assert {r[0] for r in df.where(hit).collect()} == brute_selection([f"k{i}" for i in range(n)], 3, size)


def test_several_selections_take_two_passes(spark, monkeypatch):
    """Each row is read twice, however many cuts there are; a third pass is the answer's own."""
    monkeypatch.setattr(selection, "CELL", 2)  # cells of a dozen rows: the cuts fall inside them
    monkeypatch.setattr(selection, "GROUP", 1)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    keys = [f"k{i}" for i in range(3000)]
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("id")).mapInArrow(counted, "id string")
    cuts = [selection.Cut(0.6, 3), selection.Cut(0.1, 4, "floor", 1), selection.Cut(0.0, 5), selection.Cut(1.0, 6), selection.Cut(0.05, 3)]
    hits = selection.select_fractions(df, ["id"], cuts)
    assert read.value == 2 * len(keys)
    found = df.select("id", *[hit.alias(f"h{i}") for i, hit in enumerate(hits)]).collect()
    for i, cut in enumerate(cuts):
        size = selection.wanted_rows(len(keys), cut.fraction, cut.rounding, cut.minimum)
        assert {r["id"] for r in found if r[f"h{i}"]} == brute_selection(keys, cut.seed, size)


def test_equal_digests_are_selected_together(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3, "id string")
    for fraction in (0.1, 0.5, 0.9):
        hit = selection.select_fraction(df, ["id"], fraction, 1)
        assert df.where(hit).count() in (3, 6, 9)


def test_drills_at_once_are_those_one_by_one(spark):
    raw = raw_table(spark, 300)
    key = ["report_id"]
    both = drills.run_drills(["volume_anomaly", "data_quality"], raw, key, NOW, seed=2)
    after = drills.run_drill("data_quality", raw, key, NOW, seed=2)
    expected = after.where(~selection.select_fraction(raw, key, drills.DROP_FRACTION, 2))
    assert rows(both, "report_id", "drug_name", "serious") == rows(expected, "report_id", "drug_name", "serious")
    assert both.count() == 120


def test_selection_skips_rows_without_key(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "id string")
    assert df.where(~selection.select_fraction(df, ["id"], 1.0, 0)).count() == 1


def raw_table(spark, n=200):
    fields = {name: F.lit("1") for name in RAW_COLUMNS}
    fields |= {"report_id": F.col("id").cast("string"), "patient_age": F.lit(4).cast("decimal(10,2)"),
               "loaded_at": F.lit(NOW).cast("timestamp_ntz"), "load_date": F.lit("2024-03-01").cast("date")}
    table = spark.range(n).select(*[fields[name].alias(name) for name in RAW_COLUMNS])
    return spark.createDataFrame(table.collect(), RAW_DDL)


def test_drill_loop(spark):
    """Clean tables are silent, each drill wakes its detector, restoring silences it again."""
    raw = raw_table(spark)
    base = baseline(spark, ("case_reports", "table", 200, 60))
    previous = monitors.schema_rows(raw, "raw", "case_reports").withColumn("snapshotted_at", F.lit(NOW).cast("timestamp_ntz"))
    rules = [quality.not_null("drug_name"), quality.accepted_values("serious", ["1", "2"])]

    def alarms(df):
        found = monitors.run_checks({"case_reports": df}, "raw", base, previous, NOW)["alerts"]
        kinds = {r["alert_type"] for r in found.collect()}
        if "drug_name" in df.columns and quality.run_rules(df, rules, "t").where("not passed").count():
            kinds.add("rules")
        return kinds

    assert raw.schema.simpleString() == spark.createDataFrame([], RAW_DDL).schema.simpleString()
    assert alarms(raw) == set()
    expected = {"volume_anomaly": {"row_count_deviation"}, "data_quality": {"rules"}, "schema_drift": {"schema_drift"},
                "freshness_failure": {"freshness_violation"}, "none": set(), "unheard_of": set()}
    for scenario, kinds in expected.items():
        damaged = drills.run_drill(scenario, raw, ["report_id"], NOW, seed=5)
        assert alarms(damaged) == kinds, scenario
        assert alarms(drills.restore(raw)) == set()
    assert rows(drills.restore(raw)) == rows(raw)


def test_rename_and_repair(spark):
    raw = raw_table(spark, 3)
    for broken in (drills.rename(raw), drills.move(raw)):
        fixed, note = repair.apply_safe_rename(broken)
        assert sorted(fixed.columns) == sorted(RAW_COLUMNS) and "back to 'drug_name'" in note
    assert repair.apply_safe_rename(raw)[1] is None
    assert repair.apply_safe_rename(drills.rename(raw).drop("country"))[1] is None
    assert drills.rename(drills.rename(raw)).columns == drills.rename(raw).columns


# --- lineage and similarity ------------------------------------------------------------------------------------------

def test_reachability_in_a_cyclic_graph(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (90, 2))] + [(0, 0), (70, 71)]
    children = {}
    for a, b in pairs:
        children.setdefault(a, set()).add(b)
    expected = set()
    for root in (0, 5, 70, 99):
        queue = list(children.get(root, ()))
        while queue:
            node = queue.pop()
            if (root, node) not in expected:
                expected.add((root, node))
                queue += children.get(node, ())
    edges = spark.createDataFrame(pairs, "parent bigint, child bigint")
    roots = spark.createDataFrame([(0,), (5,), (70,), (99,)], "root bigint")
    assert set(rows(lineage.downstream(edges, roots), "root", "node")) == expected


def closure(pairs):
    """What each parent reaches."""
    children, found = {}, {}
    for parent, child in pairs:
        children.setdefault(parent, set()).add(child)
    for root in children:
        seen, queue = set(), list(children[root])
        while queue:
            node = queue.pop()
            if node not in seen:
                seen.add(node)
                queue += children.get(node, ())
        found[root] = seen
    return found


def graph(seed, n, edges):
    """Edges with cycles, loops, repeats and a long chain; nodes are texts."""
    rng = np.random.default_rng(seed)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (edges, 2))] + [(i, i + 1) for i in range(n, n + 9)] + [(0, 0), (3, 3)]
    return [(f"n{a:04d}", f"n{b:04d}") for a, b in pairs + pairs[:5]]


@pytest.mark.parametrize("seed, n, edges", [(1, 40, 30), (2, 200, 210), (3, 150, 400)])
def test_classes_of_a_cyclic_graph(spark, seed, n, edges):
    pairs = graph(seed, n, edges)
    reached = closure(pairs)
    same = {}
    for root, nodes in reached.items():
        same.setdefault(frozenset(nodes), []).append(root)
    expected = sorted((root, min(roots), len(roots), len(nodes)) for nodes, roots in same.items() for root in roots)
    df = spark.createDataFrame([*pairs, (None, "x"), ("x", None)], "parent string, child string").repartition(3)
    found = lineage.Reach.of(df)
    assert rows(found.classes(), "node", "class_id", "class_size", "n_reached") == expected
    bits = {(r["number"], r["block"]) for r in found.blocks.collect()}
    assert len(bits) == found.blocks.count() <= len(reached) * (len({x for p in pairs for x in p}) // 64 + 1)


def test_impact_counts(spark):
    pairs = graph(5, 60, 70)
    reached = closure(pairs)
    names = sorted({x for p in pairs for x in p})
    nodes = [(x, "model" if i % 3 else "seed", x, ["Select DRUG, a_b", "", None, "drug_name"][i % 4], "a_B from x") for i, x in enumerate(names)]
    code = {x: (raw or compiled).lower() for x, kind, _, raw, compiled in nodes if kind == "model"}
    changes = [(x, [None, "drug", "A_b", "drug_name", "b from", "not there at all, and longer than any code", ""][i % 7]) for i, x in enumerate(names)]
    expected = sorted([(root, c, sum(x in code for x in reached[root]), sum(bool(c) and c.lower() in code.get(x, "") for x in reached[root]))
                       for root, c in changes if root in reached], key=repr)
    found = lineage.Reach.of(spark.createDataFrame(pairs, "parent string, child string")).impact(
        spark.createDataFrame(nodes, "unique_id string, resource_type string, name string, raw_code string, compiled_code string"),
        spark.createDataFrame(changes, "root string, column_name string"))
    assert rows(found, "root", "column_name", "n_models", "n_referencing") == expected


def test_reach_of_nothing(spark):
    none = spark.createDataFrame([], "parent string, child string")
    assert lineage.Reach.of(none).classes().count() == 0


def test_lineage_starts_from_every_source(spark, sf):
    reached = closure(inputs.lineage_edges(spark, sf).collect())
    found = rows(catalog.QUERIES["lineage_all_sources"](spark, sf), "root", "n_reached")
    assert found == sorted((root, len(nodes)) for root, nodes in reached.items())
    sources = {r["unique_id"] for r in inputs.lineage_sources(spark, sf).collect()}
    assert len(sources) > 10
    assert rows(catalog.QUERIES["lineage_downstream"](spark, sf), "root", "node") == sorted(
        ((root, node) for root in sources for node in reached[root]), key=repr)


def test_lineage_downstream_follows_every_event_of_the_tables(spark, sf):
    reached = closure(inputs.lineage_edges(spark, sf).collect())
    roots = {(r["event_id"] - 1) // 2 for r in inputs.table(spark, sf, "events").collect() if r["event_id"] > 0}
    assert {1, 5, 6} | {r["unique_id"] for r in inputs.lineage_sources(spark, sf).collect()} <= roots
    assert rows(catalog.QUERIES["lineage_downstream"](spark, sf), "root", "node") == sorted(
        ((root, node) for root in roots for node in reached[root]), key=repr)


def test_lineage_lists_every_pair(spark, sf):
    reached = closure(inputs.lineage_edges(spark, sf).collect())
    assert rows(catalog.QUERIES["lineage_all_sources"](spark, sf), "root", "node") == sorted(
        ((root, node) for root, nodes in reached.items() for node in nodes), key=repr)


def test_pairs_of_a_messy_graph(spark):
    pairs = graph(3, 150, 200)
    found = lineage.Reach.of(spark.createDataFrame([*pairs, (None, "x")], "parent string, child string").repartition(3))
    assert rows(found.pairs(), "root", "node") == sorted(
        ((root, node) for root, nodes in closure(pairs).items() for node in nodes), key=repr)


def test_impact_lists_every_model(spark):
    pairs = graph(5, 150, 170)
    reached = closure(pairs)
    names = sorted({x for p in pairs for x in p})
    nodes = [(x, "model" if i % 3 else "seed", f"m{x}", ["Select DRUG, a_b", "", None, "drug_name"][i % 4], "a_B from x") for i, x in enumerate(names)]
    code = {x: (raw or compiled).lower() for x, kind, _, raw, compiled in nodes if kind == "model"}
    changes = [(x, [None, "drug", "A_b", "drug_name", "b from", "not there at all", ""][i % 7]) for i, x in enumerate(names)] + [(names[0], "from")]
    expected = sorted([(root, f"m{x}", c, c is not None and c.lower() in code[x])
                       for root, c in changes for x in reached.get(root, ()) if x in code], key=repr)
    edges = spark.createDataFrame(pairs, "parent string, child string")
    nodes = spark.createDataFrame(nodes, "unique_id string, resource_type string, name string, raw_code string, compiled_code string")
    changes = spark.createDataFrame(changes, "root string, column_name string")
    columns = "root", "name", "column_name", "references_column"
    assert rows(lineage.Reach.of(edges).impacted(nodes, changes), *columns) == expected
    assert rows(lineage.impacted_models(edges, nodes, changes), *columns) == expected


def test_impacted_all_sources_lists_every_model(spark, sf):
    reached = closure(inputs.lineage_edges(spark, sf).collect())
    found = rows(catalog.QUERIES["impacted_all_sources"](spark, sf), "root", "name")
    assert found == sorted(((root, f"model_{node}") for root, nodes in reached.items() for node in nodes if node % 3), key=repr)


@pytest.mark.parametrize("block_rows", [50, 4096])
@pytest.mark.parametrize("ordered", [False, True])
def test_nearest_matches_brute_force(spark, block_rows, ordered):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(50, 6)).round(1)
    vectors[10] = vectors[20] = vectors[30]  # ties
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, i, [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "query_id bigint, incident_id bigint, vector array<double>")
    got = similarity.nearest(df, df, 3, order="incident_id" if ordered else None, block_rows=block_rows)
    result = {(r["query_id"], r["rank"]): r["match_id"] for r in got.collect()}
    scores = np.round(vectors @ vectors.T, 12)
    expected = {}
    for i in range(50):
        pool = [j for j in range(50) if not ordered or j < i]
        for rank, j in enumerate(sorted(pool, key=lambda j: (-scores[i, j], j))[:3], 1):
            expected[(i, rank)] = j
    close = [k for k in expected if expected[k] != result.get(k)
             and abs(scores[k[0], expected[k]] - scores[k[0], result[k]]) > 1e-9]
    assert set(result) == set(expected) and not close


def test_nearest_with_sides_of_different_size(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(40, 5))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    few, many = df.where("id < 3"), df.where("id >= 3")
    for queries, corpus in ((few, many), (many, few)):
        got = similarity.nearest(queries, corpus, 2, query_key="id", corpus_key="id", block_rows=40)
        q_ids, c_ids = [sorted(r["id"] for r in side.collect()) for side in (queries, corpus)]
        expected = {(q, rank, sorted(c_ids, key=lambda c: -vectors[q] @ vectors[c])[rank - 1]) for q in q_ids for rank in (1, 2)}
        assert set(rows(got, "query_id", "rank", "match_id")) == expected


def clustered(n, copies, seed=3):
    """n unit vectors around n / 10 centres, of which ``copies`` are one and the same vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, 32))
    vectors = centres[rng.integers(0, len(centres), n)] + 0.35 * rng.normal(size=(n, 32))
    vectors[rng.permutation(n)[:copies]] = centres[0]
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@pytest.mark.parametrize("task_rows", [similarity.TASK_ROWS, 2000])
def test_nearest_recall_beyond_one_block(spark, task_rows, monkeypatch):
    """Every 50th row asks all rows, text ids, a third of all vectors equal, blocks far smaller than the table."""
    monkeypatch.setattr(similarity, "TASK_ROWS", task_rows)
    vectors = clustered(12_000, 4000)
    df = spark.createDataFrame([(f"INC-{i:06d}", i, [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "incident_id string, n bigint, vector array<double>").repartition(4)
    queries = df.where("n % 50 = 0").withColumnRenamed("incident_id", "query_id")
    got = similarity.nearest(queries, df, 5, block_rows=256).collect()
    scores = np.round(vectors[::50] @ vectors.T, 9)
    fifth = np.sort(scores, axis=1)[:, -5]
    asked = {(r["query_id"], r["rank"]): r["match_id"] for r in got}
    assert len(asked) == len(got) == 5 * len(scores)
    good = sum(scores[int(q[4:]) // 50, int(m[4:])] >= fifth[int(q[4:]) // 50] for (q, _), m in asked.items())
    assert good / len(got) >= 0.9
    for r in got:  # scores are exact
        assert abs(r["score"] - vectors[int(r["query_id"][4:])] @ vectors[int(r["match_id"][4:])]) < 1e-9


def test_nearest_moves_each_vector_once_per_table(spark, monkeypatch):
    df = spark.createDataFrame([(i, i, [float(i), 1.0]) for i in range(100)], "query_id bigint, incident_id bigint, vector array<double>")
    plan = lambda: similarity.nearest(df, df, 1)._jdf.queryExecution().executedPlan().toString()
    small = plan()
    monkeypatch.setattr(similarity, "TASK_ROWS", 10)
    large = plan()
    for text in (small, large):
        assert text.count("Exchange") == 2 and "Join" not in text and "collect_list" not in text
    assert "rangepartitioning(table" in large


def test_nearest_without_vectors(spark):
    none = spark.createDataFrame([(1, 1, None)], "query_id bigint, incident_id bigint, vector array<double>")
    some = spark.createDataFrame([(2, 2, [1.0])], "query_id bigint, incident_id bigint, vector array<double>")
    assert similarity.nearest(none, none, 3).count() == 0
    assert rows(similarity.nearest(none.union(some), some, 3), "query_id", "match_id") == [(2, 2)]


def test_reuse_threshold_is_inclusive(spark):
    memory = spark.createDataFrame(
        [(1, [1.0, 0.0], True), (2, [0.0, 1.0], False)], "incident_id bigint, vector array<double>, has_sql_fix boolean")
    queries = spark.createDataFrame([(7, [0.85, 0.0]), (8, [0.849, 0.0]), (9, [0.0, 1.0])], "query_id bigint, vector array<double>")
    assert rows(similarity.reusable_fixes(queries, memory), "query_id", "match_id") == [(7, 1)]


# --- triage ----------------------------------------------------------------------------------------------------------

def test_routing_table(spark):
    rename = "ALTER TABLE raw.case_reports RENAME COLUMN a TO b"
    update = "UPDATE raw.case_reports SET a = 1"
    cases = [
        ("P0", update, True, "escalated", False, ["pause", "notify", "request_approval"], 0),
        ("P3", update, True, "auto_approved", False, ["log"], None),
        ("P1", None, False, "auto_approved", False, ["retry", "notify"], None),
        ("P2", None, False, "auto_approved", False, ["retry"], None),
        ("P1", "DELETE FROM raw.case_reports", False, "escalated", False, ["notify"], None),
        ("P2", "DELETE FROM raw.case_reports", False, "escalated", False, ["notify"], None),
        ("P1", rename, True, "auto_approved", True, ["apply_rename", "retry", "notify"], None),
        ("P2", rename, True, "auto_approved", True, ["apply_rename", "retry"], None),
        ("P1", rename, False, "auto_approved", False, ["retry"], None),
        ("P1", update, False, "pending", False, ["request_approval"], 30),
        ("P2", update, False, "pending", False, ["request_approval"], 0),
    ]
    df = spark.createDataFrame(
        [(i, "d", "r", "t", "x", c[0], (("s"), "why", "low", c[1]), c[2], "live rename" if c[2] else None) for i, c in enumerate(cases)],
        "incident_id int, dag_id string, run_id string, task_id string, error_type string, severity string, "
        "fix struct<source: string, description: string, risk_level: string, sql: string>, rename_valid boolean, "
        "rename_sql string")
    routed = incidents.route(df)
    got = [(r["approval_status"], r["fix_executed"], r["actions"], r["timeout_minutes"]) for r in routed.orderBy("incident_id").collect()]
    assert got == [c[3:] for c in cases]
    assert rows(incidents.approval_requests(routed), "incident_id") == [(0,), (10,), (9,)]
    steps = incidents.actions(routed)
    assert steps.count() == sum(len(c[5]) for c in cases)
    assert {r["detail"] for r in steps.where("action = 'apply_rename'").collect()} == {"live rename"}


def approvals_table(spark, *data):
    full = [(i, "d", "r", "t", None, None, sev, None, status, at(age), None, None, mail, pause) for i, sev, status, age, mail, pause in data]
    return spark.createDataFrame(full, APPROVAL_DDL)


LADDER = [
    ("p1-early", "P1", "pending", 29, None, None), ("p1-due", "P1", "pending", 30, None, None),
    ("p1-done", "P1", "approved", 99, None, None), ("p0-30", "P0", "pending", 30, None, None),
    ("p0-60", "P0", "pending", 60, None, None), ("p0-mailed", "P0", "pending", 60, at(9), None),
    ("p0-both", "P0", "pending", 99, at(9), at(1)), ("p2", "P2", "pending", 999, None, None), ("odd", None, "pending", 999, None, None),
]


def test_escalation_ladder(spark):
    table = approvals_table(spark, *LADDER)
    assert rows(approvals.ladder(table, NOW), "incident_id", "action") == [
        ("p0-30", "send_mail"), ("p0-60", "pause_dag"), ("p0-60", "send_mail"), ("p0-mailed", "pause_dag"), ("p1-due", "auto_apply")]
    after = approvals.climb(table, NOW)
    assert after.where("status = 'auto_approved' and resolved_by = 'escalation_timeout'").count() == 1
    assert approvals.ladder(after, NOW).isEmpty()


def test_refused_timeouts_do_not_count_as_healed(spark):
    table = approvals_table(spark, ("bad", "P1", "pending", 30, None, None), ("good", "P1", "pending", 30, None, None),
                            ("blank", "P1", "pending", 30, None, None), ("seen", "P1", "approved", 30, None, None))
    sql = F.when(F.col("incident_id").isin("bad", "seen"), "DELETE FROM raw.case_reports /* /* */ WHERE 1=1 -- */").when(
        F.col("incident_id") == "good", "UPDATE raw.case_reports SET a = 1").otherwise("")
    after = approvals.climb(table.withColumn("proposed_sql", sql), NOW)
    assert rows(after, "incident_id", "status") == [
        ("bad", "refused"), ("blank", "auto_approved"), ("good", "auto_approved"), ("seen", "approved")]
    assert after.select(incidents.approved(F.col("status")).alias("a"), "incident_id").where("a").count() == 3


def test_decisions_and_status(spark):
    table = approvals_table(spark, ("a", "P1", "pending", 5, None, None), ("b", "P0", "pending", 5, None, None))
    clicks = spark.createDataFrame([("a", "reject", "x", 1), ("a", "approve", None, 2)], "incident_id string, action string, username string, n int")
    decided = approvals.decide(table, clicks, [F.desc("n")], NOW)
    assert rows(decided, "incident_id", "status", "resolved_by") == [("a", "approved", "unknown"), ("b", "pending", None)]
    wanted = spark.createDataFrame([("a",), ("zz",)], "incident_id string")
    assert rows(approvals.status_of(wanted, decided), "incident_id", "status") == [("a", "approved"), ("zz", "unknown")]


def test_reports_over_empty_tables(spark):
    runs = spark.createDataFrame([], "run_id string, status string, started_at timestamp_ntz")
    assert tuple(reports.run_summary(runs).first()) == (0, None, None)
    incidents_table = spark.createDataFrame([], "fix_result string, approved boolean")
    assert tuple(reports.incident_summary(incidents_table).first()) == (0, 0, 0, None)


def test_rank_filter_order_makes_no_difference(spark):
    from pyspark.sql import Window

    from caselight.plans.marts import serious_events

    rng = np.random.default_rng(3)
    data = [(f"d{a}", str(b), bool(c), True, None, None) for a, b, c in rng.integers(0, 4, (400, 3)) for _ in range(int(c) + 1)]
    staged = spark.createDataFrame(data, "drug_name string, outcome string, is_fatal boolean, is_serious boolean, patient_age decimal(10,2), received_date date")
    counted = staged.groupBy("drug_name", "outcome").count()
    ranked = counted.withColumn("rank", F.rank().over(Window.partitionBy("drug_name").orderBy(F.desc("count"))))
    assert rows(serious_events(staged, 40), "drug_name", "outcome", "severity_rank") == rows(ranked.where("count > 40"), "drug_name", "outcome", "rank")


def test_marts_from_groups_equal_marts_from_reports(spark, sf):
    from caselight.bindings import inputs
    from caselight.plans import marts
    from caselight.plans.staging import stage_reports

    staged = stage_reports(inputs.raw_reports(spark, sf))
    groups = marts.report_groups(staged)
    assert rows(marts.drug_reactions_from_groups(groups)) == rows(marts.drug_reactions(staged))
    assert rows(marts.serious_events_from_groups(groups)) == rows(marts.serious_events(staged))
