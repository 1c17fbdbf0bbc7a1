"""Registered queries, one module per operator group."""

from importlib import import_module

GROUPS = (
    "sources profile relational metrics series sampling sets scalars corpus features boxes augment streams user_code"
).split()


def load_all(groups=GROUPS) -> None:
    for group in groups:
        import_module(f"sparrowmill.plans.{group}")
