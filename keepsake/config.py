"""Policy configuration, passed explicitly into every job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults.
YOUNG_OLD_THRESHOLD_MONTHS = 7
GRACE_PERIOD_AFTER_DELETION_MONTHS = 7
YOUNG_VERSIONS_TO_KEEP = 10
COPY_RETRY_LIMIT = 6
RETRYABLE_COPY_REASONS = ("backendError", "internalError", "quotaExceeded")
LATENCY_X_DAYS = (4, 5, 7)
SNAPSHOT_MARKER = "SNAPSHOT_MARKER"
UNPARTITIONED = "__UNPARTITIONED__"
NONE_SENTINEL = "None"
DEFAULT_LOCATION = "US"
CREATE_DISPOSITIONS = ("CREATE_IF_NEEDED", "CREATE_NEVER")
WRITE_DISPOSITIONS = ("WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_EMPTY")
STATUS_IN_PROGRESS = "In Progress"
STATUS_DONE = "Done"
STATUS_FAILED = "Failed"
MAX_BACKUP_TABLE_ID = 1024
MAX_COPY_REQUEST_KEY = 500


@dataclass(frozen=True)
class Config:
    as_of: dt.datetime
    young_months: int = YOUNG_OLD_THRESHOLD_MONTHS
    grace_months: int = GRACE_PERIOD_AFTER_DELETION_MONTHS
    keep_young: int = YOUNG_VERSIONS_TO_KEEP
    backup_project: str = "backup"
    restoration_project: str = "restoration"
    custom_projects: tuple[str, ...] = ()
    projects_to_skip: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        # The reference refuses retention periods below one month.
        if self.young_months < 1 or self.grace_months < 1:
            raise ValueError("retention periods must be at least one month")

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()
