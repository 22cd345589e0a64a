"""Whole computations put together from operators, and the jobs around them."""
