"""Query plans: the registered queries, their SQL twins, the serving view and
the end-to-end pipeline."""
