"""Data cleaning and data quality for tabular registries, as Spark plans.

A :class:`~pulcra.profile.Profile` says what each column means; the operators
turn any DataFrame plus a profile into profiles, repairs with an audit log,
duplicate reviews, rule violations, before/after metrics and a checked
publication.
"""

from pulcra.profile import Profile

__all__ = ["Profile"]
