"""tq — table quality on Spark: profile, clean + quarantine, validate, inject and measure."""

from tq.config import LISTINGS, Bound, InjectionConfig, Limit, QualityConfig  # noqa: F401
from tq.operators.clean import CleanResult, clean  # noqa: F401
from tq.operators.expect import (  # noqa: F401
    Between,
    NotMatchRegex,
    NotNull,
    PairOrder,
    Unique,
    build_rules,
    evaluate,
    unexpected_rows,
    validate,
)
from tq.operators.normalize import minimal_typing, normalize  # noqa: F401
from tq.operators.profile import profile, table_summary  # noqa: F401
from tq.plans.experiment import run_experiment  # noqa: F401
from tq.plans.steps import run as run_steps  # noqa: F401

__version__ = "0.1.0"
