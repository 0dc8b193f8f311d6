"""The four jobs: publish, score, retrain and dashboard. Each runs by spark-submit."""
