"""Batch jobs for seafloor geodesy on Spark."""
