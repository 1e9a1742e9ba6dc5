"""Column-returning functions; none of them needs a Python worker."""
