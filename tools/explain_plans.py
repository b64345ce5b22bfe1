"""Write PLANS.md: the physical plan of every report over the lake and of
the ETL, trimmed to the operator tree and the scan details.

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quadra import model as M  # noqa: E402
from quadra.operators import reports as R  # noqa: E402
from quadra.plans import catalog, etl  # noqa: E402
from quadra.session import fresh_path, local_session  # noqa: E402
from quadra.sources import adapter, lake  # noqa: E402

KEEP = re.compile(r"^(PartitionFilters|PushedFilters|ReadSchema|Location|Arguments: (hashpartitioning|rangepartitioning|SinglePartition|HashedRelationBroadcastMode))")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = buf.getvalue().splitlines()
    out, in_tree = [], True
    for line in lines:
        if line.startswith("== Physical Plan =="):
            continue
        if in_tree and not line.strip():
            in_tree = False
            continue
        if in_tree:
            out.append(line)
        elif re.match(r"^\(\d+\) ", line):
            out.append(line)
        elif KEEP.match(line):
            out.append("    " + line[:220])
        elif line.startswith("===== Subqueries"):
            out.append(line)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    print("# Physical plans\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}`, local[8], AQE on "
          "(initial plans; AQE may still coalesce partitions or turn a join into a broadcast at run time).\n")
    landing = adapter.landing_incidents(spark, sf_dir)
    print("## ETL: landing rows -> transformed layer\n\n```")
    print(plan_text(etl.transformed_layer(etl.raw_layer(landing))))
    print("```\n")
    root = fresh_path(spark, "plans-lake")
    lake.write_layer(etl.incidents(spark, sf_dir), root)
    inc = lake.read_layer(spark, root, schema=M.layer_schema())
    keys = fresh_path(spark, "plans-keys")
    lake.write_layer(R.partition_keys(inc), keys)
    parts = R.partition_counts_from_stats(lake.read_layer(spark, keys))
    cmp = R.resolve_comparison(parts)
    reports = {name: report(inc) for name, report in catalog.REPORTS.items()}
    reports |= {name: report(parts) for name, report in catalog.KEY_REPORTS.items()}
    reports |= {name: report(inc, cmp) for name, report in catalog.COMPARED_REPORTS.items()}
    for name, report in reports.items():
        print(f"## {name}\n\n```")
        print(plan_text(report))
        print("```\n")


if __name__ == "__main__":
    main()
