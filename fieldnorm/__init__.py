"""Normalise legacy transaction fields with Spark and publish the result safely."""

from fieldnorm.operators import (
    QualityError,
    compare,
    fingerprint,
    normalize,
    output_quality,
    preview,
    quality_pass,
    reconcile,
    require_clean,
    source_quality,
)
from fieldnorm.plans import PublishError, Recovery, publish_swap, recover, refresh_backup, run_job, stage_verified
from fieldnorm.session import tune
from fieldnorm.spec import ATM_SPECS, POS_SPECS, SENTINELS, FieldSpec, output_widths

__all__ = [
    "ATM_SPECS",
    "POS_SPECS",
    "SENTINELS",
    "FieldSpec",
    "PublishError",
    "QualityError",
    "Recovery",
    "compare",
    "fingerprint",
    "normalize",
    "output_quality",
    "output_widths",
    "preview",
    "publish_swap",
    "quality_pass",
    "reconcile",
    "recover",
    "refresh_backup",
    "require_clean",
    "run_job",
    "source_quality",
    "stage_verified",
    "tune",
]
