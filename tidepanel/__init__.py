"""Panel forecasting analytics as Spark jobs: panels, checks, features, back-tests, intervals, scores."""
