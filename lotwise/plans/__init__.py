"""Registered queries, each over the whole given tables, with the matching SQL where there is one."""

from __future__ import annotations

from importlib import import_module

GROUPS = ["files", "profiles", "cleaning", "features", "splits", "encoding", "evaluation", "training", "scoring", "streams",
          "attribution", "linear", "sketches", "rates", "ranks"]


def load() -> dict:
    from lotwise.plans.registry import PLANS

    for name in GROUPS:
        import_module(f"lotwise.plans.{name}")
    return PLANS
