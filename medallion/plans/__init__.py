"""The pipeline: cleaning, models, KPIs, reports and quality checks."""
