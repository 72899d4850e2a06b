"""Registered queries (``QUERIES``); their SQL equivalents live in
``textmine.plans.oracle`` and are imported only when asked for."""

from textmine.plans.queries import QUERIES

__all__ = ["QUERIES"]
