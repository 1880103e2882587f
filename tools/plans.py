"""Write the physical plans of the headline queries to PLANS.md.

usage: python tools/plans.py [SF_DIR]   (default /root/testdata/sf0.1)
Stage tables a query writes while it is built (vocabulary, set-tagged
documents) appear as parquet scans of the checkpoint folder.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexiflow.plans.catalog import QUERIES  # noqa: E402
from lexiflow.session import local_session  # noqa: E402

NAMES = ["word_count_raw", "inverted_index", "inverted_index_tf", "preprocess_documents",
         "similar_pairs_prefix", "similar_pairs_naive"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` at `{sf_dir}` (before AQE re-planning; AQE may "
           "still coalesce partitions, split skewed ones or turn a shuffle join into a "
           "broadcast from measured sizes).", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r"file:[^\],]*checkpoint[^\],]*", "<checkpoint folder>", plan)
        plan = re.sub(r"\[plan_id=\d+\]", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
