"""Summarise the physical plan of every registered query (as planned before
execution; AQE may still coalesce partitions, split skew and switch joins).

Usage: python tools/plan_report.py [sf_dir] [query ...] > PLANS.md (without names: all queries
of the library that are one plan; those that write and read back in several jobs, and the
operators on texts, whose plans the check tool lists, are left out)
Per query: shuffles by kind, broadcasts, join strategies, Python evaluation nodes,
whole-stage codegen spans and scans with pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "shuffled hash joins": r"ShuffledHashJoin",
    "nested-loop/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python nodes": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF",
    "codegen stages": r"\*\(\d+\)",
    "scans": r"FileScan|Scan JDBCRelation|Scan ExistingRDD",
    "scans w/ pushed filters": r"PushedFilters: \[[^\]]",
}


def plan_text(df) -> str:
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    # the initial plan of an adaptive query, with its codegen stage markers
    try:
        plan = plan.initialPlan()
    except Exception:  # noqa: BLE001 - not adaptive
        pass
    return plan.toString()


def summarise(df) -> dict[str, int]:
    text = plan_text(df)
    return {k: len(re.findall(p, text)) for k, p in COUNTS.items() if k != "codegen stages"}


def _top_level_fields(struct: str) -> int:
    depth, n = 0, 1
    for ch in struct:
        depth += ch == "<"
        depth -= ch == ">"
        n += ch == "," and depth == 0
    return n


def pruned_scans(spark, text: str) -> str:
    """``pruned/all`` parquet scans: a scan is pruned when it reads fewer columns
    than its files hold."""
    scans = re.findall(r"Location: InMemoryFileIndex\(\d+ paths\)\[([^\],]+)[^\n]*?"
                       r"ReadSchema: struct<(.*?)>(?:,|$)", text, re.M)
    scans += [(loc, schema) for loc, schema in re.findall(
        r"Location: InMemoryFileIndex \[([^\],]+)\][^\n]*\n(?:.*\n)*?ReadSchema: struct<(.*)>", text)]
    pruned = total = 0
    for loc, schema in scans:
        if not loc.endswith(".parquet"):
            continue
        total += 1
        pruned += _top_level_fields(schema) < len(spark.read.parquet(loc).columns)
    return f"{pruned}/{total}"


def codegen_stages(spark, build) -> int:
    """Whole-stage codegen spans, from the same query planned without AQE (an
    adaptive plan gets its codegen stages only when each stage runs)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return len(set(re.findall(r"\*\((\d+)\)", text)))


def main() -> None:
    from strata.plans import roundtrips
    from strata.plans.registry import queries
    from strata.session import build_session

    import tempfile
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="strata-plans-")
    spark = build_session("strata-plans", "local[8]", 16, {
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.sql.maxMetadataStringLength": "10000"})   # whole ReadSchema in plan text
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir.rstrip('/'))})\n")
    print("Generated by `tools/plan_report.py`; counts are taken from the plan Spark chose "
          "before running (AQE may still coalesce partitions, split skewed ones, or turn a "
          "sort-merge join into a broadcast once sizes are measured).\n")
    cols = list(COUNTS) + ["pruned source scans"]
    print("| query | " + " | ".join(cols) + " |")
    print("|" + " --- |" * (len(cols) + 1))
    qs = queries()
    for name in sys.argv[2:] or [n for n in qs if n not in roundtrips.queries()]:
        q = qs[name]
        df = q(spark, sf_dir)
        s = summarise(df)
        s["codegen stages"] = codegen_stages(spark, lambda: q(spark, sf_dir))
        s["pruned source scans"] = pruned_scans(spark, plan_text(df))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
