"""riskmart: credit-risk data marts and model monitoring as set-based Spark jobs."""
