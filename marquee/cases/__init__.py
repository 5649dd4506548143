"""Registered queries: each runs an operator over whole given tables; its SQL twin, where there is one, stands beside it."""
