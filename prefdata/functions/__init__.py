"""Row-local building blocks: functions from columns to a column."""
