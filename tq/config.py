"""Configuration: column roles, thresholds and rule parameters.

Everything that the cleaning, validation and injection operators need to know
about a table lives here, so the operators themselves carry no table-specific
names.  ``LISTINGS`` is the preset for wide, all-text listing tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Bound:
    """Closed numeric interval ``[low, high]`` on one column."""

    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Limit:
    """Upper limit on one column; rows above it are quarantined as ``<column>_too_high``."""

    column: str
    high: float

    @property
    def reason(self) -> str:
        return f"{self.column}_too_high"


@dataclass(frozen=True)
class Relation:
    """A rule over several columns: a row is quarantined with ``reason`` where ``condition`` (SQL on the typed
    columns) is TRUE."""

    reason: str
    columns: tuple[str, ...]
    condition: str


@dataclass(frozen=True)
class Ratio:
    """``numerator`` (per ``denominator``, if given) must lie within ``cutoff`` median absolute deviations of the median of
    the rows with the same ``by`` columns; learned from trusted rows, for groups of at least ``least`` of them."""

    numerator: str
    denominator: str | None = None
    by: tuple[str, ...] = ()
    cutoff: float = 4.0
    least: int = 20

    @property
    def name(self) -> str:
        return self.numerator if self.denominator is None else f"{self.numerator}_per_{self.denominator}"

    @property
    def reason(self) -> str:
        return "_".join([self.name, "unusual", *(["for", *self.by] if self.by else [])])

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.numerator, *([self.denominator] if self.denominator else []), *self.by)


@dataclass(frozen=True)
class Nearby:
    """At least ``least`` other rows lie within ``radius`` of a row's coordinates."""

    x: str
    y: str
    radius: float
    least: int = 20
    reason: str = "coordinates_isolated"


@dataclass(frozen=True)
class QualityConfig:
    """Column roles and thresholds.

    Column roles (a column is used only if it exists in the table):

    * ``key``: 64-bit identifier (BIGINT, never through DOUBLE); rows with a
      null/invalid key are quarantined, duplicate keys are removed.
    * ``currency``: text such as ``$1,200.50``; ``$`` and ``,`` are stripped
      then parsed as DOUBLE.
    * ``numeric``: DOUBLE columns.
    * ``dates``: DATE columns.
    * ``flags``: ``'t'`` / ``'f'`` text parsed to BOOLEAN.
    * ``score_prefix``: every column whose name starts with it is a DOUBLE
      score, range checked by ``score_range``; with ``score_zero_is_missing``
      a score of 0 is set to null.
    * ``digit_only_text``: free text columns in which a value made only of
      digits, blanks and ``.,+-`` is removed (phone numbers, post codes).
    """

    key: str | None = None
    currency: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    score_prefix: str | None = None
    score_range: tuple[float, float] = (0.0, 5.0)
    score_zero_is_missing: bool = True
    # the score that error injection raises above the range
    main_score: str | None = None
    digit_only_text: tuple[str, ...] = ()
    digit_only_pattern: str = r"^[0-9\s.,+-]+$"
    # price column checked for ``<= 0`` and ``> max_price``; flagged when missing
    price: str | None = None
    max_price: float | None = None
    limits: tuple[Limit, ...] = ()
    # (earlier, later): quarantined when earlier > later
    date_order: tuple[str, str] | None = None
    # coordinates must lie inside every bound (three-valued logic, see rules.py)
    box: tuple[Bound, ...] = ()
    box_reason: str = "coordinates_outside_box"
    # (column, limit): adds flag_<column>_gt_<limit>, never quarantines
    long_stay: tuple[str, float] | None = None
    # rules over several columns, groups and neighbours (operators/consistency.py); none by default
    relations: tuple[Relation, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    nearby: Nearby | None = None
    # text literals recognised as booleans
    true_text: str = "t"
    false_text: str = "f"

    def with_(self, **changes) -> "QualityConfig":
        return replace(self, **changes)

    @property
    def long_stay_flag(self) -> str | None:
        if self.long_stay is None:
            return None
        column, limit = self.long_stay
        return f"flag_{column}_gt_{int(limit) if float(limit).is_integer() else limit}"

    @property
    def missing_flag(self) -> str | None:
        return f"{self.price}_missing" if self.price else None

    def score_columns(self, columns) -> list[str]:
        if not self.score_prefix:
            return []
        return [c for c in columns if c.startswith(self.score_prefix)]


# --- fixed values: thresholds and column roles of the listing preset -------------------------
# These constants must equal the published cleaning / validation settings.
LISTING_MAX_PRICE = 10_000
LISTING_MAX_BEDS = 20
LISTING_MAX_BEDROOMS = 15
LISTING_MAX_BATHROOMS = 10
LISTING_LATITUDE = (48.7, 49.0)
LISTING_LONGITUDE = (2.1, 2.6)
LISTING_LONG_STAY_NIGHTS = 365
LISTING_COMPLETENESS = 0.95
LISTING_DIGIT_ONLY_PATTERN = r"^[0-9\s.,+-]+$"
LISTING_NUMERIC = (
    "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights", "maximum_nights",
    "number_of_reviews", "latitude", "longitude", "price_quote_total_price",
    "price_quote_price_per_night", "estimated_revenue_l365d",
)
LISTING_DATES = ("first_review", "last_review")
LISTING_FLAGS = ("host_is_superhost", "host_has_profile_pic", "host_identity_verified", "has_availability")
# --- end of fixed values -------------------------------------------------------------------------


LISTINGS = QualityConfig(
    key="id",
    currency=("price",),
    numeric=LISTING_NUMERIC,
    dates=LISTING_DATES,
    flags=LISTING_FLAGS,
    score_prefix="review_scores_",
    score_range=(0.0, 5.0),
    score_zero_is_missing=True,
    main_score="review_scores_rating",
    digit_only_text=("host_about",),
    digit_only_pattern=LISTING_DIGIT_ONLY_PATTERN,
    price="price",
    max_price=LISTING_MAX_PRICE,
    limits=(
        Limit("beds", LISTING_MAX_BEDS),
        Limit("bedrooms", LISTING_MAX_BEDROOMS),
        Limit("bathrooms", LISTING_MAX_BATHROOMS),
    ),
    date_order=("first_review", "last_review"),
    box=(Bound("latitude", *LISTING_LATITUDE), Bound("longitude", *LISTING_LONGITUDE)),
    long_stay=("minimum_nights", LISTING_LONG_STAY_NIGHTS),
)


# the same, with rules that compare columns and look at the local distribution
CONSISTENT_LISTINGS = LISTINGS.with_(
    relations=(Relation("beds_far_above_bedrooms", ("beds", "bedrooms"), "beds > 2 * bedrooms + 10"),),
    ratios=(
        Ratio("price", by=("bedrooms",)),
        Ratio("price", "bedrooms", by=("bedrooms",)),
        Ratio("beds", by=("bedrooms",)),
    ),
    # about 0.9 km of latitude
    nearby=Nearby("latitude", "longitude", radius=0.008, least=100),
)


@dataclass(frozen=True)
class InjectionConfig:
    """Parameters of the error-injection experiment."""

    n: int = 500
    seed: int = 42
    # "xxhash64" (default, as a Spark user would write) or "md5" (portable to other engines)
    hash: str = "xxhash64"
    # first-stage hash buckets of the candidate ranking (None: grows with the input's split count)
    buckets: int | None = None
    # buckets merged per stage of the ranking tree
    fanout: int = 64
    types: tuple[str, ...] | None = None  # None = every registered type, registry order
    # first hash threshold of a type: ``oversample * n * t + slack`` expected keys (widened if it keeps too few)
    oversample: float = 2.0
    slack: int = 1000
    # the greedy chain runs in one task over ``n * T * (T + 1) / 2`` keys at most; beyond this many it is refused
    max_candidates: int = 5_000_000
