"""Composite jobs and the named analytic queries."""
