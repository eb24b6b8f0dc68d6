"""Operators of a training-data pipeline: near-duplicate joins, URL filters, decontamination,
personal data, exact and substring deduplication, license scans, toxicity, source mixing and
token counts. Nothing outside this subpackage imports it."""
