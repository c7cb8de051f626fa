"""Whole plans: layouts, reports, batch prediction."""
