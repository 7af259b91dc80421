"""Query plans: the registered per-key queries (Spark side and oracle SQL)
and composite reports built from several operators."""
