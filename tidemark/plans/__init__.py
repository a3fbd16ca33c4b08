"""Whole queries assembled from operators: ad-hoc questions, dashboard charts, guarded reads."""
