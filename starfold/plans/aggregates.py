"""Aggregates that are stored and refreshed after loads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..sinks.versions import Load, VersionedLayer


@dataclass(frozen=True)
class StoredAggregate:
    """A table ``name`` of a layer with the aggregate of its table ``of``, beside a note of the loads it holds.

    ``compute`` aggregates rows of ``of`` (given the load, to read dimensions through
    it), ``combine`` adds up two such results. Where it can add up rows as well, ``lines`` gives
    those of ``of`` in the form of the aggregate, so that new ones are not grouped twice.
    """

    name: str
    of: str
    compute: Callable[[Load, DataFrame], DataFrame]
    combine: Callable[[DataFrame, DataFrame], DataFrame]
    lines: Callable[[Load, DataFrame], DataFrame] | None = None

    def refresh(self, load: Load, mode: str = "incremental") -> str:
        """Bring the aggregate up to what ``load`` reads; what was done: ``current``, ``incremental`` or ``full``.

        An incremental refresh reads the loads that the aggregate does not hold yet. When
        the table was rebuilt, so that held loads are gone, or nothing is stored yet, it
        is computed anew, as it is in mode ``full``.
        """
        if mode not in ("incremental", "full"):
            raise ValueError(f"unknown mode {mode}")
        now = load.loads(self.of)
        held = load.note(self.name).get("loads") if self.name in load else None
        if mode == "full" or held is None or not set(held) <= set(now):
            load.replace(self.name, self.compute(load, load.read(self.of)), note={"loads": now})
            return "full"
        missing = [one for one in now if one not in set(held)]
        if not missing:
            return "current"
        delta = (self.lines or self.compute)(load, load.read(self.of, missing))
        load.replace(self.name, self.combine(load.read(self.name), delta), note={"loads": now})
        return "incremental"

    def refresh_layer(self, layer: VersionedLayer, mode: str = "incremental") -> str:
        """Refresh and publish; nothing is published when the aggregate is current."""
        load = layer.load()
        done = self.refresh(load, mode)
        if done != "current":
            load.commit()
        return done
