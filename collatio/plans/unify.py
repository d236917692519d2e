"""One lean search table from many differently shaped catalogues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from collatio.operators import aggregates, projections


@dataclass(frozen=True)
class Source:
    """The columns of a catalogue that stand for the canonical fields; the first that is filled counts."""

    tcg: str
    id: tuple[str, ...]
    name: tuple[str, ...]
    rarity: tuple[str, ...] = ()


def all_cards(frames: dict[str, DataFrame], sources: tuple[Source, ...]) -> DataFrame:
    """PRJ-01, SET-01: (tcg, cardId, cardName, rarity) of all catalogues. Ids are unique within a tcg only (Q-22)."""
    return aggregates.union_all(*[projections.remapped(frames[s.tcg], s.tcg, cardId=s.id, cardName=s.name, rarity=s.rarity) for s in sources])
