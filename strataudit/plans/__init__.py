"""Plans built from the operators: the seven checks, diagnosis, run history and reports."""
