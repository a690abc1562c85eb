from fieldnorm.plans.job import run_job
from fieldnorm.plans.partitions import BackupRefresh, refresh_backup_partitions
from fieldnorm.plans.publish import PublishError, publish_swap, refresh_backup, stage_verified
from fieldnorm.plans.recovery import Recovery, recover

__all__ = ["BackupRefresh", "PublishError", "Recovery", "publish_swap", "recover", "refresh_backup", "refresh_backup_partitions", "run_job", "stage_verified"]
