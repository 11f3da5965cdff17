"""Rule registry: label banks in routing order, the generic bank, and all extractors.

A :class:`RuleSet` is what the engine runs. ``DEFAULT`` holds the built-in banks;
a new document type is a new bank (and any new extractors) in a new rule set -
``DEFAULT.with_bank(bank, extractors)`` - passed to ``apply_rules`` / ``extract``,
without editing the engine.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from docsift.operators.rules import generic, oab, sistema
from docsift.operators.rules.bank import Alt, Extractor, Rule, RuleBank


@dataclass(frozen=True)
class RuleSet:
    label_banks: tuple[RuleBank, ...]       # routing order: first matching keyword wins
    generic_bank: RuleBank
    extractors: dict[str, Extractor] = field(hash=False)

    def __post_init__(self):
        for bank in self.all_banks:
            for rule in bank.rules:
                if rule.extractor not in self.extractors:
                    raise ValueError(f"rule {bank.family}.{rule.name}: unknown extractor {rule.extractor}")

    @property
    def all_banks(self) -> tuple[RuleBank, ...]:
        return self.label_banks + (self.generic_bank,)

    @cached_property
    def extractor_ids(self) -> tuple[str, ...]:
        return tuple(self.extractors)

    @cached_property
    def extractor_index(self) -> dict[str, int]:
        return {k: i for i, k in enumerate(self.extractor_ids)}

    @cached_property
    def rules(self) -> tuple[tuple[str, Rule], ...]:
        return tuple((b.family, r) for b in self.all_banks for r in b.rules)

    @cached_property
    def rule_index(self) -> dict[tuple[str, str], int]:
        return {(fam, r.name): i for i, (fam, r) in enumerate(self.rules)}

    @cached_property
    def rule_names(self) -> tuple[str, ...]:
        return tuple(f"{fam}.{r.name}" for fam, r in self.rules)

    @cached_property
    def rule_extractor(self) -> tuple[int, ...]:
        return tuple(self.extractor_index[r.extractor] for _fam, r in self.rules)

    def with_bank(self, bank: RuleBank, extractors: dict[str, Extractor] | None = None,
                  first: bool = False) -> "RuleSet":
        """A new rule set with ``bank`` routed after (or, ``first=True``, before) the existing ones."""
        banks = (bank,) + self.label_banks if first else self.label_banks + (bank,)
        return RuleSet(banks, self.generic_bank, {**self.extractors, **(extractors or {})})


# Routing order matters: a label containing both keywords goes to the first bank.
DEFAULT = RuleSet((oab.BANK, sistema.BANK), generic.BANK,
                  {**oab.EXTRACTORS, **sistema.EXTRACTORS, **generic.EXTRACTORS})

# Shorthands for the default rule set.
LABEL_BANKS = DEFAULT.label_banks
GENERIC_BANK = DEFAULT.generic_bank
EXTRACTORS = DEFAULT.extractors
EXTRACTOR_IDS = DEFAULT.extractor_ids
EXTRACTOR_INDEX = DEFAULT.extractor_index

__all__ = ["Alt", "Extractor", "Rule", "RuleBank", "RuleSet", "DEFAULT", "LABEL_BANKS", "GENERIC_BANK",
           "EXTRACTORS", "EXTRACTOR_IDS", "EXTRACTOR_INDEX"]
