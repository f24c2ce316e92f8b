"""Support-ticket analytics on Spark: stage, clean, model, analyse and report."""
