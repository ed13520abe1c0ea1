"""Column names, thresholds and model parameters, with their published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

FEATURES = (
    "total_amount",
    "part_count",
    "avg_part_amount",
    "max_part_amount",
    "min_part_amount",
    "std_part_amount",
    "amount_range",
    "coeff_variation",
    "log_total_amount",
)

# Spark column names ignore case, so a table with predictions (``is_fraud``) keeps the known label as ``truth``.
TRUTH = "truth"


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    test_ratio: float = 0.2
    sample_size: int | None = None

    merge_keys: tuple[str, ...] = ("REFERENCE_NUM", "VEHICLE_MODEL_CODE", "CLAIMNO")
    survey_part: str = "TXT_PARTS_NAME"
    garage_part: str = "PARTDESCRIPTION"
    claim_id: str = "CLAIMNO"
    amount: str = "TOTAL_AMOUNT"
    part_code: str = "NUM_PART_CODE"
    label: str = "IS_FRAUD"

    cap_quantile: float = 0.99
    cap_factor: float = 10.0
    cap_floor: float = 100_000.0

    fuzzy_threshold: int = 80
    cosine_threshold: float = 0.15
    ngram_range: tuple[int, int] = (1, 2)
    max_terms: int = 5000
    synonyms: dict[str, str] | None = None  # words of part names to be replaced before matching

    min_support: float = 0.01
    min_confidence: float = 0.1
    min_lift: float = 1.0

    components: int = 10
    top_n: int = 5
    coverage_score: float = 0.5

    contamination: float = 0.10
    iso_trees: int = 200
    iso_samples: int = 256

    rf_trees: int = 300
    rf_depth: int = 12
    rf_min_split: int = 5
    cv_splits: int = 5
    cv_repeats: int = 3
    grid: dict = field(
        default_factory=lambda: {
            "trees": [200, 300, 500],
            "depth": [8, 12, 16, None],
            "min_split": [2, 5, 10],
        }
    )


DEFAULTS = Settings()
