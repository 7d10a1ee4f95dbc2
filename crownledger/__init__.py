"""Crownledger: revenue-cycle analytics for practice groups, written as Spark DataFrame operators."""
