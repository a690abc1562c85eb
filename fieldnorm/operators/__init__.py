from fieldnorm.operators.fingerprint import Fingerprint, compare, compare_groups, fingerprint, fingerprint_of
from fieldnorm.operators.normalize import normalize, preview
from fieldnorm.operators.quality import (
    QualityError,
    counted_output_quality,
    filled,
    output_quality,
    quality_pass,
    require_clean,
    source_quality,
)
from fieldnorm.operators.reconcile import reconcile

__all__ = [
    "Fingerprint",
    "QualityError",
    "compare",
    "compare_groups",
    "counted_output_quality",
    "filled",
    "fingerprint",
    "fingerprint_of",
    "normalize",
    "output_quality",
    "preview",
    "quality_pass",
    "reconcile",
    "require_clean",
    "source_quality",
]
