"""DataFrame operators: plain functions from tables to tables."""
