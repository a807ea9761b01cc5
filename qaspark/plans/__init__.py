"""Distributed building blocks shared by the operators: row numbers, top-k, size-checked broadcast."""
