"""Whole plans: the warehouse build, analyst queries, queries over the test star."""
