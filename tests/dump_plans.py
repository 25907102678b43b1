"""Write PLANS.md: condensed final (post-AQE) physical plans of representative
queries at sf0.01 -- exchanges, joins, windows, aggregates, scans with pushed
filters. Usage: python tests/dump_plans.py [sf_dir]"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from readerflow.plans.registry import load_all  # noqa: E402
from readerflow.session import local_session  # noqa: E402

NAMES = [
    "default_chapters", "extraction_prompt", "infer_cache", "filter_dialogues", "empty_fallback", "prev_next",
    "word_overlap", "avg_accuracy", "chat_history", "analysis_prompt", "catalog_lookup", "book_scan_fallback",
    "voice_manifest", "batch_infer",
]
KEEP = ("Exchange", "Join", "Window", "Aggregate", "Scan", "Generate", "MapInPandas", "Reused", "AQEShuffleRead")


def condense(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "", line)
            out.append(line.rstrip()[:170])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    reg = load_all()
    parts = ["# Physical plans (final, after AQE) at " + os.path.basename(sf), "",
             "Generated by `tests/dump_plans.py`; operators only (projections/filters omitted).", ""]
    for name in NAMES:
        df = reg[name].build(spark, sf)
        df.collect()  # run this DataFrame's own plan so AQE finalises it (small at sf0.01)
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "```", *condense(plan), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
