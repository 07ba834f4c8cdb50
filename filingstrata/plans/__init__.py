"""Table-level plans: bronze to silver, silver to gold, and the run over all layers."""
