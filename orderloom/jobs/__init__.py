"""Entry points for spark-submit: first Silver, then Gold."""
