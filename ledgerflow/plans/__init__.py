"""Run state and the three kinds of run: period load, report, chain."""
