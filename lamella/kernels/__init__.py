"""Numeric kernels on arrays of one image or one field. They run in tasks, on bounded pieces, and know nothing of Spark."""
