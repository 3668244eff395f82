"""Typed errors raised by gates and contract checks."""

from __future__ import annotations


class ContractError(ValueError):
    """A frame does not have the columns or types a stage requires."""


class GateError(RuntimeError):
    """A data-quality gate failed; ``report`` holds the failing rule rows."""

    def __init__(self, gate: str, failures: list[dict]):
        self.gate = gate
        self.failures = failures
        detail = "; ".join(
            f"{f['rule']}: {f['violations']} violation(s)" for f in failures
        )
        super().__init__(f"gate {gate!r} failed: {detail}")
