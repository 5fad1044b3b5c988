"""Print the formatted physical plans of the headline operators (for plan review).

Usage: python scripts/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tq.config import LISTINGS, InjectionConfig  # noqa: E402
from tq.operators import explore as X  # noqa: E402
from tq.operators.clean import clean  # noqa: E402
from tq.operators.expect import build_rules, evaluate  # noqa: E402
from tq.operators.inject import corrupt, eligibility, error_types, usable_types  # noqa: E402
from tq.operators.normalize import minimal_typing  # noqa: E402
from tq.operators.profile import profile, table_summary  # noqa: E402
from tq.session import local_session  # noqa: E402
from tq.sources.tables import dirty  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = local_session(8, 8, "explain")
    spark.sparkContext.setLogLevel("ERROR")
    raw = dirty(spark, sf_dir)
    result = clean(raw, LISTINGS)
    before = minimal_typing(raw, LISTINGS)
    types = usable_types(raw.columns, error_types(LISTINGS))
    sample = spark.createDataFrame([(1, "1", "price_x100")], "id bigint, key_text string, error_type string")
    plans = {
        "clean_reasoned": lambda: result.reasoned,
        "clean_metrics": lambda: result.metrics(),
        "profile": lambda: profile(raw),
        "table_summary": lambda: table_summary(raw, key="id"),
        "validation_suite": lambda: evaluate(before, build_rules(before.columns, LISTINGS)),
        "explore_extremes": lambda: X.extremes(raw, ["beds", "minimum_nights"], "id", exact=False),
        "injection_eligibility": lambda: eligibility(raw, result.clean.select("id"), "id", types),
        "injection_corrupt": lambda: corrupt(raw, sample, LISTINGS, InjectionConfig(n=500), types),
    }
    for name, build in plans.items():
        if wanted and name not in wanted:
            continue
        print(f"\n===== {name} =====")
        build().explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
