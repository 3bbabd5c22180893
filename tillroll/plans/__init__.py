"""Whole batch jobs: each strings operators together and writes its tables."""
