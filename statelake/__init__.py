"""statelake: sampled-state panels, event tapes and holder books on Spark."""
