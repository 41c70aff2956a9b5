"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass

from factorfall import rules
from factorfall.schemas import canonical


@dataclass(frozen=True)
class Parameters:
    """``n_quarters`` None means: as many as the inputs hold; ``dedupe`` keeps one segment per lookup key."""

    q0: str = "Mar 2025"
    keys: tuple[tuple[rules.KeyField, ...], ...] = rules.WATERFALL_KEYS
    n_quarters: int | None = None
    dedupe: bool = False


def key_fields(definitions: list[dict]) -> tuple[tuple[rules.KeyField, ...], ...]:
    """Waterfall keys from configuration: business headers per field."""
    return tuple(
        tuple(
            rules.KeyField(
                canonical(field["convergence_col"]),
                None if field.get("pivot_only") else canonical(field["outlook_col"]),
                bool(field.get("int_str")),
            )
            for field in definition["fields"]
        )
        for definition in definitions
    )


def parameters(section: dict) -> Parameters:
    """From the ``parameters`` section of a configuration, however it was read."""
    keys = section.get("waterfall_keys")
    return Parameters(
        q0=section.get("Q0", Parameters.q0),
        keys=key_fields(keys) if keys else rules.WATERFALL_KEYS,
        n_quarters=section.get("n_quarters"),
        dedupe=bool(section.get("dedupe", False)),
    )
