"""End-to-end jobs and result pages built from the operators."""
