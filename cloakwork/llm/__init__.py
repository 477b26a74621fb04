"""Operators for preparing training text; nothing else in the library imports them."""

from __future__ import annotations

from cloakwork.llm.common import ORACLES, QUERIES


def load_all() -> None:
    from cloakwork.llm import (  # noqa: F401
        decontaminate,
        divergence,
        language,
        licences,
        middles,
        mixture,
        near,
        personal,
        ring,
        rules,
        secrets,
        spans,
        urls,
    )


__all__ = ["ORACLES", "QUERIES", "load_all"]
