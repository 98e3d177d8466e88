"""The end-to-end plan and the daily job."""
