"""Reading landing files, loading them once, and binding tables to paths."""
