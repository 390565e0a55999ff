"""Reusable Spark operators for cleaning, cohort tables, screens, sentiment and forecasts."""
