"""Runnable jobs: ``python -m jobs.model_inputs`` and ``python -m jobs.cohort_ingest``; each has a JSON file of settings beside it."""
