"""File scans, rule files, the batch-keyed store and published snapshots."""
