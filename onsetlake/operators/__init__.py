"""DataFrame -> DataFrame operators of the outbreak-onset analytics."""
