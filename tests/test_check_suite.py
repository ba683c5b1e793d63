"""The fused check suite: the same answers as each check alone, every table read once."""

import random
import re

from ledgerflow.operators.quality import Check, failing_rows, run_checks
from ledgerflow.plans import contracts

KEYS = [Check("u_a", "t", "unique", ("a",)), Check("u_b", "t", "unique", ("b",), severity="warn"), Check("ab", "t", "unique_combination", ("a", "b")),
        Check("bc", "t", "unique_combination", ("b", "c")), Check("nn_b", "t", "not_null", ("b",)), Check("in_c", "t", "accepted_values", ("c",), {"values": ["x", "y"]}),
        Check("expr", "t", "expression", (), {"expr": "a < 30"}), Check("child", "t", "relationships", ("a",), {"to": "p", "field": "k"}),
        Check("again", "t", "relationships", ("b",), {"to": "p", "field": "k"}, "warn"), Check("self", "t", "relationships", ("b",), {"to": "t", "field": "a"}),
        Check("parent", "p", "unique", ("k",)), Check("nn_k", "p", "not_null", ("k",))]


def alone(tables, check):
    return failing_rows(tables, check).count()


def tables_of(spark, tmp_path, rows, parents):
    spark.createDataFrame(rows, "a int, b int, c string, `check` int, n int").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame(parents, "k long, n int").write.parquet(str(tmp_path / "p"))
    return {"t": spark.read.parquet(str(tmp_path / "t")), "p": spark.read.parquet(str(tmp_path / "p"))}


def test_same_answers_as_each_check_alone(spark, tmp_path):
    rng = random.Random(1)
    some = lambda n: rng.choice([None, *range(n)])
    rows = [(7 if k % 3 == 0 else some(40), some(60), rng.choice(["x", "y", "z", None]), 1, 1) for k in range(150)]
    tables = tables_of(spark, tmp_path, rows, [(some(25), 0) for _ in range(30)])
    got = {r["check"]: (r["failures"], r["severity"], r["status"]) for r in run_checks(tables, KEYS).collect()}
    for c in KEYS:
        n = alone(tables, c)
        assert got[c.name] == (n, c.severity, "pass" if n == 0 else "warn" if c.severity == "warn" else "fail"), c.name
    assert sum(n > 0 for n, *_ in got.values()) > 8


def test_every_table_is_scanned_once(spark, tmp_path):
    tables = tables_of(spark, tmp_path, [(1, 1, "x", 1, 1)], [(1, 0)])
    plan = run_checks(tables | {"same": tables["t"]}, [*KEYS, Check("other", "same", "unique", ("c",))])._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sorted(re.sub(r"#\d+L?", "", s) for s in scans) == ["a,b,c", "k"]


def test_empty_tables_pass(spark, tmp_path):
    got = run_checks(tables_of(spark, tmp_path, [], []), KEYS).collect()
    assert len(got) == len(KEYS) and all(r["failures"] == 0 and r["status"] == "pass" for r in got)


def test_the_whole_list_is_declared():
    checks = contracts.project_checks()
    assert len({c.name for c in checks}) == len(checks) == 56
    kinds = [c.kind for c in checks]
    assert (kinds.count("accepted_values"), kinds.count("relationships"), kinds.count("unique_combination")) == (5, 2, 6)
    assert [c.name for c in checks if c.severity == "warn"] == ["relationship_fct_time_entries_employee_id"]
