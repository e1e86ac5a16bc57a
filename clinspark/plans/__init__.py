"""Whole-study plan and analytic queries."""
