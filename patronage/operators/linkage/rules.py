"""Weights and thresholds of the match score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MatchRules:
    """How a pair is scored and judged.

    ``blank_emails_agree``: two records without an email count as having the
    same one. It makes every such pair within a block a candidate, n * (n - 1) / 2
    of them for n records without email, so a missing email agrees with nothing
    unless this is asked for.

    ``blocking``: records are compared that agree on any of these fields (``first_letter``, ``zip_code``).
    """

    name_weight: float = 0.4
    email_weight: float = 0.4
    phone_weight: float = 0.2
    match_threshold: float = 0.85
    uncertain_threshold: float = 0.6
    blank_emails_agree: bool = False
    blocking: tuple[str, ...] = ("first_letter",)

    def score(self, name: Column, email: Column, phone: Column) -> Column:
        """Weighted sum, added in this order: some sums lie right on a threshold."""
        return name * self.name_weight + email * self.email_weight + phone * self.phone_weight

    @property
    def best_without_email(self) -> float:
        """The score of equal names and equal phones when the emails differ."""
        return 1.0 * self.name_weight + 0.0 * self.email_weight + 1.0 * self.phone_weight

    def label(self, score: Column) -> Column:
        return (
            F.when(score >= self.match_threshold, "match")
            .when(score >= self.uncertain_threshold, "uncertain")
            .otherwise("non_match")
        )

    def emails_agree(self, left: Column, right: Column) -> Column:
        same = left == right
        return same if self.blank_emails_agree else same & (left != "")
