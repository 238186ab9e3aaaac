"""Summarize the physical plan of every registered query into PLANS.md:
shuffles, join strategies, aggregation kinds, pushed filters and the
columns each scan reads.

    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.split("\n")
    exchanges = [ln for ln in lines if "Exchange" in ln and "BroadcastExchange" not in ln
                 and "ReusedExchange" not in ln]
    kinds = []
    for ln in exchanges:
        m = re.search(r"Exchange (\w+)", ln)
        kinds.append(m.group(1) if m else "?")
    joins = sorted({m for ln in lines for m in re.findall(r"(\w+Join)\b", ln) if m != "Join"})
    aggs = sorted({m for ln in lines for m in re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b", ln)})
    pushed = sorted({p.strip() for ln in lines for p in re.findall(r"PushedFilters: \[([^\]]*)\]", ln) if p.strip()})
    scans = []
    for ln in lines:
        m = re.search(r"Scan (parquet|csv|ExistingRDD)", ln) or re.search(r"FileScan (\w+)", ln)
        if m:
            rs = re.search(r"ReadSchema: struct<(.*)>", ln)
            ncols = len(re.findall(r":", rs.group(1))) if rs else None
            scans.append(f"{m.group(1)}({ncols} cols)" if ncols is not None else m.group(1))
    return {"exchanges": kinds, "joins": joins, "aggs": aggs, "pushed": pushed, "scans": scans,
            "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
            "sorts": sum(1 for ln in lines if re.search(r"[+*(\s]Sort \[|\+- Sort|^\*?\(?\d*\)? ?Sort", ln)),
            "python": "Python" in plan or "ArrowEval" in plan}


FULL = ["clean_pipeline", "dedup_by_key"]  # queries whose full formatted plan is appended


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from roadframe.plans import catalog
    from roadframe.session import build_session
    spark = build_session(extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="roadframe-plans-")})
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated ReadSchema
    out = ["# Physical plans", "",
           f"Generated by `scripts/plan_report.py` on `{sf_dir}` with adaptive execution off (static plans;",
           "at run time AQE may still coalesce partitions or turn joins into broadcasts). Model queries list",
           "the plan of their final frame only (metrics or pairs); fits run as Spark ML jobs.", "",
           "| query | shuffles | sorts | joins | aggregates | scans (columns read) | pushed filters | codegen stages | Python |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf_dir)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        out.append(f"| `{name}` | {len(s['exchanges'])} {'(' + ', '.join(s['exchanges']) + ')' if s['exchanges'] else ''} "
                   f"| {s['sorts']} "
                   f"| {', '.join(s['joins']) or '-'} | {', '.join(s['aggs']) or '-'} | {', '.join(s['scans']) or '-'} "
                   f"| {'; '.join(s['pushed']) or '-'} | {s['codegen_stages']} | {'yes' if s['python'] else 'no'} |")
    for name in FULL:
        df = catalog.QUERIES[name](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        out += ["", f"## `{name}`: formatted plan", "", "```", text.strip(), "```"]
    print("\n".join(out))


if __name__ == "__main__":
    main()
