"""Column expressions, argument checks and the numpy kernels run inside tasks."""
