"""Whole jobs: the operators in the order a run needs them."""
